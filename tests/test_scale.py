"""Hot keys and plan shapes: results stay whole and exact under skew."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.functions.dates import date_key, parse_date, seconds_between
from tallyhouse.operators.rules import Dedup, apply_rules
from tallyhouse.operators.scd2 import as_of_join, as_of_join_by_month, versions_of
from tallyhouse.plans import dims


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_with_hot_key(spark):
    n = 30000
    # a third of all rows share one key
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(-1))
                               .otherwise(F.col("id")).alias("k"))
    out = apply_rules(df, [Dedup("dup", ["k"], ["id"])])
    counts = {r["stg_status"]: r["count"] for r in out.groupBy("stg_status").count().collect()}
    assert counts[C.REJECTED] == n // 3 - 1
    assert counts[C.VALID] == n - (n // 3 - 1)
    survivor = out.where("k = -1 AND stg_status = 'VALID'").collect()
    assert [r["id"] for r in survivor] == [0]
    assert "Window" not in _plan(out)


def test_as_of_with_hot_key_is_exact(spark):
    ev = spark.range(20000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7))
                                   .otherwise(F.col("id") % 50).alias("k"),
                                   F.date_add(F.lit("2024-01-01").cast("date"),
                                              (F.col("id") % 60).cast("int")).alias("d"))
    dim = spark.createDataFrame(
        [(1, 7, dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (2, 7, dt.date(2024, 2, 1), None)] +
        [(100 + k, k, dt.date(2024, 1, 1), None) for k in range(50) if k != 7],
        "sk long, k long, valid_from date, valid_to date")
    out = as_of_join(ev, dim, "k", "k", "d", {"sk": "sk"})
    assert out.count() == 20000                      # every event matches exactly one version
    hot = {r["sk"]: r["count"] for r in out.where("k = 7").groupBy("sk").count().collect()}
    assert sum(hot.values()) == ev.where("k = 7").count()
    assert "NestedLoop" not in _plan(out) and "Cartesian" not in _plan(out)


def test_as_of_by_month_equals_as_of(spark):
    d = dt.date
    dim = spark.createDataFrame(
        [(1, 7, d(2024, 1, 1), d(2024, 1, 30)), (2, 7, d(2024, 1, 31), d(2024, 1, 30)),  # an empty version
         (3, 7, d(2024, 1, 31), d(2024, 3, 9)), (4, 7, d(2024, 3, 12), d(2024, 3, 12)), (5, 7, d(2024, 6, 1), None),
         (6, 8, d(2023, 5, 5), d(2023, 6, 1)), (7, 9, d(2020, 2, 29), None), (8, None, d(2020, 1, 1), None)],
        "sk long, k long, valid_from date, valid_to date")
    ev = spark.range(0, 4 * 900).select(
        "id", (F.col("id") % 4 + 7).alias("k"),
        F.date_add(F.lit(d(2023, 1, 1)), (F.col("id") / 4).cast("int")).alias("d"))
    ev = ev.unionAll(spark.createDataFrame([(-1, None, d(2024, 1, 1)), (-2, 7, None)], ev.schema))
    for how in ("inner", "left"):
        one, two = (sorted(map(str, join(ev, dim, "k", "k", "d", {"sk": "sk", "valid_from": "since"}, how=how).collect()))
                    for join in (as_of_join, as_of_join_by_month))
        assert one == two and len(one) > 1000
    assert as_of_join_by_month(ev.limit(0), dim, "k", "k", "d", {"sk": "sk"}).count() == 0
    assert as_of_join_by_month(ev, dim.limit(0), "k", "k", "d", {"sk": "sk"}, how="left").count() == ev.count()


def test_key_with_very_many_versions_spreads_over_tasks(spark):
    n, first = 100_000, F.lit(dt.date(1800, 1, 1))  # one key, a version a day
    days = spark.range(n).select(F.lit(7).alias("k"), F.date_add(first, F.col("id").cast("int")).alias("day"),
                                 F.col("id").alias("price"))
    ev = spark.range(2 * n).select("id", F.lit(7).alias("k"),
                                   F.date_add(first, F.pmod(F.col("id") * 31, F.lit(n)).cast("int")).alias("d"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
            spark.conf.set(k, v)
        out = as_of_join_by_month(ev, versions_of(days, "k", "day"), "k", "k", "d", {"price": "price"})
        assert "NestedLoop" not in _plan(out) and "Cartesian" not in _plan(out)
        per_task = out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("rows"), F.count_if(F.col("price") != F.pmod(F.col("id") * 31, F.lit(n))).alias("wrong"))
        found = per_task.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r["rows"] for r in found) == 2 * n and not any(r["wrong"] for r in found)
    assert len(found) > 1 and max(r["rows"] for r in found) < n


def test_dates_do_not_depend_on_session_time_zone(spark):
    def values():
        df = spark.createDataFrame([("2024-03-09",), ("2024-11-02",)], "s string")
        d = parse_date("s")
        return [tuple(r) for r in df.select(
            date_key(d), seconds_between(d, F.date_add(d, 2))).collect()]
    before = values()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # DST change inside both spans
    try:
        after = values()
        cal = dims.calendar(spark, "2024-03-01", "2024-03-31").where("is_weekend").count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after == [(20240309, 172800), (20241102, 172800)]
    assert cal == 10


def test_top_n_puts_null_keys_last(spark):
    from tallyhouse.operators.aggregate import top_n
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 1)], "id int, k int")
    assert [r["id"] for r in top_n(df, 3, ["k", "id"]).collect()] == [4, 2, 1]
    assert top_n(df, 9, ["k", "id"]).count() == 4
