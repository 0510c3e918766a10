"""apply_rules against a plain-Python model of the rule semantics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse import constants as C
from tallyhouse.operators.rules import Dedup, Rule, apply_rules

row = st.tuples(st.one_of(st.none(), st.integers(-3, 3)),      # a
                st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),  # b
                st.one_of(st.none(), st.integers(0, 3)))        # dup key


def model(rows):
    """First failing rule wins; duplicates only among rows still pending."""
    msgs = {}
    for i, (a, b, k) in enumerate(rows):
        if a is not None and a <= 0:
            msgs[i] = "r1"
        elif b is not None and b not in ("x", "y"):
            msgs[i] = "r2"
    seen = set()
    for i, (a, b, k) in enumerate(rows):          # order = row id
        if i in msgs:
            continue
        if k in seen:
            msgs[i] = "dup"
        seen.add(k)
    for i, (a, b, k) in enumerate(rows):
        if i not in msgs and a is not None and a == 3:
            msgs[i] = "r3"
    return [msgs.get(i) for i in range(len(rows))]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_matches_model(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a int, b string, k int")
    out = apply_rules(df, [Rule("r1", F.col("a") <= 0), Rule("r2", ~F.col("b").isin("x", "y")),
                           Dedup("dup", ["k"], ["id"]), Rule("r3", F.col("a") == 3)])
    got = {r["id"]: (r["stg_message"], r["stg_status"]) for r in out.collect()}
    want = model(rows)
    assert [got[i][0] for i in range(len(rows))] == want
    assert all((m is None) == (s == C.VALID) for m, s in got.values())


def test_tied_and_identical_rows_keep_one(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, "x"), (2, "y"), (None, "n"), (None, "n")]
    df = spark.createDataFrame(rows, "k int, v string")
    out = apply_rules(df, [Dedup("dup", ["k"], ["k"])]).collect()
    assert len(out) == len(rows)
    for k in (1, 2, None):
        assert sum(r["k"] == k and r["stg_status"] == C.VALID for r in out) == 1
