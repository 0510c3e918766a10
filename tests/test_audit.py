"""Source constraints as audit checks."""

from pyspark.sql import functions as F

from tallyhouse.operators.audit import Check, Domain, ForeignKey, NotNull, Unique, audit, violations


def test_audit_counts_each_constraint(spark):
    df = spark.createDataFrame(
        [(1, "CC", 10, 5, "a"), (2, "XX", -1, 5, "a"), (3, None, None, None, "b"), (3, "NIT", 4, 9, None)],
        "id int, doc string, price int, cost int, code string")
    ref = spark.createDataFrame([(1,), (2,)], "id int")
    got = {r["check_name"]: r["violations"] for r in audit(df, [
        NotNull("code_nn", "code"),
        Check("price_pos", F.col("price") > 0),                 # NULL passes a CHECK
        Check("price_ge_cost", F.col("price") >= F.col("cost")),
        Domain("doc_dom", "doc", ["CC", "NIT"]),                 # NULL passes a domain
        Unique("id_unique", ["id"]),
        Unique("code_unique", ["code"]),                         # NULLs never collide
        ForeignKey("id_fk", ["id"], ref),
    ], "t").collect()}
    assert got == {"code_nn": 1, "price_pos": 1, "price_ge_cost": 2, "doc_dom": 1,
                   "id_unique": 2, "code_unique": 2, "id_fk": 2}


def test_violation_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 9), (None, 9)], "k int, ref_id int")
    ref = spark.createDataFrame([(9,)], "id int")
    assert violations(df, ForeignKey("fk", ["ref_id"], ref, ["id"])).count() == 0
    bad = violations(df, ForeignKey("fk", ["k"], spark.createDataFrame([(1,)], "k int")))
    assert [r["k"] for r in bad.collect()] == [2]              # NULL key is not a violation
