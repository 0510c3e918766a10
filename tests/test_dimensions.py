"""Calendar, keys, SCD2 scenarios and the as-of join."""

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.operators.keys import assign_keys
from tallyhouse.operators.lookup import insert_new, lookup
from tallyhouse.operators.scd2 import as_of_join, scd2_apply
from tallyhouse.plans import dims

D = dt.date


def test_calendar_default_range(spark):
    cal = dims.calendar(spark, "2024-01-01", "2026-12-31")
    rows = cal.collect()
    assert len(rows) == 1096
    assert sum(1 for r in rows if r["is_weekend"]) == 312
    keys = sorted(r["date_key"] for r in rows)
    assert keys[0] == 20240101 and keys[-1] == 20261231
    first = [r for r in rows if r["date_key"] == 20240101][0]
    assert first["weekday"] == 1 and first["weekday_name"] == "Lunes"
    assert first["month_name"] == "Enero" and first["quarter_name"] == "Q1"
    assert max(r["iso_week"] for r in rows) == 53
    # rerun inserts nothing
    assert dims.calendar(spark, "2024-01-01", "2026-12-31", existing=cal).count() == 0


def test_assign_keys_do_not_depend_on_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).alias("v"))
    small = {r["v"]: r["k"] for r in assign_keys(df, "k", ["v"], start=10).collect()}
    large = {r["v"]: r["k"] for r in assign_keys(df, "k", ["v"], start=10, num_partitions=7).collect()}
    assert small == large
    assert sorted(small.values()) == list(range(10, 5010))
    ordered = [small[v] for v in sorted(small)]
    assert ordered == sorted(ordered)


def test_insert_only_idempotent(spark):
    inc = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    dim = insert_new(None, inc, "id", "sk")
    again = insert_new(dim, inc, "id", "sk")
    assert again.count() == 2
    more = insert_new(dim, spark.createDataFrame([(3, "c"), (1, "zz")], "id int, name string"), "id", "sk")
    got = {r["id"]: (r["sk"], r["name"]) for r in more.collect()}
    assert got == {1: (1, "a"), 2: (2, "b"), 3: (3, "c")}   # never updated (insert-only)


def test_lookup_default_for_null_and_unknown(spark):
    dim = spark.createDataFrame([(5, 50)], "campaign_id int, promotion_key long")
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, campaign_id int")
    out = lookup(df, dim, ("campaign_id", "campaign_id"), {"promotion_key": "pk"}, default=-1, how="left")
    assert {r["id"]: r["pk"] for r in out.collect()} == {1: 50, 2: -1, 3: -1}


SCHEMA = "id int, city string, seg string, geo long"


def _run(spark, dim, rows, run, base="2024-01-01"):
    inc = spark.createDataFrame(rows, SCHEMA)
    return scd2_apply(dim, inc, "sk", "id", ["city", "seg"], ["city", "seg", "geo"], run, base,
                      require=["geo"])


def test_scd2_scenarios(spark):
    d1 = _run(spark, None, [(1, "A", "x", 1), (2, "B", "x", 1), (3, "C", "x", 1), (4, "D", "x", None)],
              "2024-01-01")
    assert d1.count() == 3                        # id 4 has no geography: not inserted
    rows2 = [
        (1, "A", "x", 1),        # unchanged
        (2, "B2", "x", 1),       # tracked change
        (3, "C", None, 1),       # NULL tracked value: not a change
        (5, "E", "x", 1),        # new key -> base date
        (4, "D", "x", 2),        # geography now known: first insert -> base date
    ]                            # (absent keys stay current)
    d2 = _run(spark, d1, rows2, "2024-03-10")
    rows = sorted((r["id"], r["sk"], r["valid_from"], r["valid_to"], r["is_current"]) for r in d2.collect())
    assert rows == sorted([
        (1, 1, D(2024, 1, 1), None, True),
        (2, 2, D(2024, 1, 1), D(2024, 3, 9), False),
        (2, 6, D(2024, 3, 10), None, True),
        (3, 3, D(2024, 1, 1), None, True),
        (4, 4, D(2024, 1, 1), None, True),
        (5, 5, D(2024, 1, 1), None, True),
    ])
    # one current row per key, intervals never overlap
    cur = d2.where("is_current").groupBy("id").count().where("count > 1").count()
    assert cur == 0
    # second run with the same input on the same day is a no-op
    d3 = _run(spark, d2, rows2, "2024-03-10")
    assert sorted(map(tuple, d3.collect())) == sorted(map(tuple, d2.collect()))
    # change on the same day as the version start: empty interval, new version current
    d4 = _run(spark, d2, [(2, "B3", "x", 1)], "2024-03-10")
    closed = [r for r in d4.collect() if r["id"] == 2 and r["valid_from"] == D(2024, 3, 10)]
    assert len(closed) == 2
    assert any(r["valid_to"] == D(2024, 3, 9) and not r["is_current"] for r in closed)


def test_scd2_change_without_geography_keeps_current(spark):
    d1 = _run(spark, None, [(1, "A", "x", 1)], "2024-01-01")
    d2 = _run(spark, d1, [(1, "Z", "x", None)], "2024-02-01")
    rows = [tuple(r) for r in d2.select("id", "city", "is_current").collect()]
    assert rows == [(1, "A", True)]


def test_as_of_boundaries(spark):
    dim = spark.createDataFrame(
        [(1, 10, D(2024, 1, 1), D(2024, 1, 31)), (2, 10, D(2024, 2, 1), None)],
        "sk long, id int, valid_from date, valid_to date")
    ev = spark.createDataFrame(
        [(1, 10, D(2024, 1, 1)), (2, 10, D(2024, 1, 31)), (3, 10, D(2023, 12, 31)),
         (4, 10, D(2024, 2, 1)), (5, 10, D(2030, 1, 1)), (6, 11, D(2024, 1, 5))],
        "e int, id int, d date")
    out = as_of_join(ev, dim, "id", "id", "d", {"sk": "sk"})
    assert {r["e"]: r["sk"] for r in out.collect()} == {1: 1, 2: 1, 4: 2, 5: 2}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upsert_mode_updates_in_place(spark):
    dim = insert_new(None, spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), "id", "sk")
    out = insert_new(dim, spark.createDataFrame([(2, "B"), (3, "c")], "id int, name string"), "id", "sk",
                     mode="upsert")
    assert sorted(map(tuple, out.select("sk", "id", "name").collect())) == [(1, 1, "a"), (2, 2, "B"), (3, 3, "c")]
