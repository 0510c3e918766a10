"""tallyhouse: a Spark-native retail warehouse build.

Layers: ``sources`` (scans, CSV, sinks), ``functions`` (column
expressions), ``operators`` (rules, lookups, keys, SCD2, audit),
``plans`` (extracts, validation, dimensions, facts, reports, pipeline).
"""

__version__ = "0.1.0"
