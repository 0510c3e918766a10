"""Column expressions (JVM-side, codegen friendly); no Python UDFs."""

from tallyhouse.functions.dates import (  # noqa: F401
    date_key, month_key, month_start, parse_date, iso_weekday, month_name,
    month_short_name, weekday_name, seconds_between, first_of_month,
)
from tallyhouse.functions.text import (  # noqa: F401
    concat_blank, classify_contains, map_values, clean_trim,
)
from tallyhouse.functions.numeric import (  # noqa: F401
    amount, pct, safe_pct, half_sum, to_decimal,
)
