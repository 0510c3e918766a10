"""Every rule fires, texts match whatever their spelling, ratios are exact."""

import os
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyhouse import constants as C
from tallyhouse.functions.numeric import exact_pct
from tallyhouse.functions.text import folded, map_values, same_text
from tallyhouse.operators.lookup import insert_new, resolve
from tallyhouse.operators.rules import Dedup, apply_rules
from tallyhouse.operators.scd2 import scd2_apply
from tallyhouse.plans import extracts, validate
from tests.oracle_check import digest, duck

SMALL = "/root/testdata/sf0.001"
FEEDS = ["outer_sales", "outer_products", "outer_inventory", "outer_returns", "outer_goals", "outer_purchases"]
STAGED = ["validate_products_dedup", "validate_customers", "classify_adjustments", "csv_malformed", "outer_returns"]


def test_every_message_occurs(spark):
    seen = set()
    for name in dict.fromkeys(FEEDS + STAGED + ["validate_returns"]):
        seen |= {r["stg_message"] for r in E.queries()[name](spark, SMALL).select("stg_message").distinct().collect()}
    wanted = {v for m in (C, validate) for k, v in vars(m).items() if k.startswith("MSG_")}
    assert wanted <= seen


@pytest.mark.parametrize("name", FEEDS + [n for n in E.queries() if n.startswith("collated_")])
def test_dirty_feeds_match_sql(spark, name):
    df = E.queries()[name](spark, SMALL)
    cur = duck(SMALL).execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, cur.fetchall())[0]


def test_outer_extraction_marks_the_missing_side(spark):
    lines = spark.createDataFrame([(1, 1, 5), (2, 9, 5), (3, None, 5)], "purchase_line_id long, purchase_id long, quantity int")
    lines = lines.withColumns({"product_id": F.lit(1).cast("long"), "unit_price": F.lit(2).cast("decimal(12,2)")})
    heads = spark.createDataFrame([(1, 70), (2, 71)], "purchase_id long, supplier_id long").withColumns(
        {"purchase_date": F.to_date(F.lit("2024-01-01")), "store_id": F.lit(1), "state": F.lit("x")})
    sup = spark.createDataFrame([(71, "s")], "supplier_id long, name string")
    got = extracts.extract_purchases(heads, lines, sup, "2024-01-01 00:00:00", keep_unmatched=True)
    assert {r["purchase_line_id"]: r["missing_side"] for r in got.collect()} == {1: "supplier", 2: "purchase", 3: None}
    assert extracts.extract_purchases(heads, lines, sup, "2024-01-01 00:00:00").collect() == []


def test_texts_match_whatever_their_spelling(spark):
    df = spark.createDataFrame([("CC", "a1"), ("cc  ", "A1 "), ("Cc", "a2"), (" CC", "a1"), ("Ć", "a1"), (None, "a1")],
                               "t string, n string").withColumn("id", F.monotonically_increasing_id())
    assert df.where(same_text("t", F.lit("cC"))).count() == 3       # leading blanks and accents count
    assert df.where(~folded("t").isin(["CC"])).count() == 2         # NULL passes
    out = apply_rules(df, [Dedup("dup", ["t", "n"], ["id"])]).where("stg_status = 'REJECTED'")
    assert [r["t"] for r in out.collect()] == ["cc  "]
    assert [r[0] for r in spark.range(1).select(map_values(F.lit("CÁLIDO "), {"cálido": "x"})).collect()] == ["x"]
    ref = spark.createDataFrame([("Hogar", 7), ("HOGAR ", 3), ("Otro", 1)], "name string, id int")
    rows = spark.createDataFrame([("hogar",), ("nada",)], "c string")
    assert {r["c"]: r["v"] for r in resolve(rows, ref, ("c", "name"), "id", "v").collect()} == {"hogar": 3, "nada": None}
    dim = insert_new(None, spark.createDataFrame([("Cali", "Valle")], "city string, region string"), ["city", "region"], "k")
    more = spark.createDataFrame([("CALI ", "valle"), ("Cali", "Otro")], "city string, region string")
    assert insert_new(dim, more, ["city", "region"], "k").count() == 2


def test_other_spellings_are_no_change_of_a_dimension(spark):
    schema = "id int, city string, geo int"
    args = dict(sk="sk", key="id", tracked=["city"], attrs=["city"], base_date="2024-01-01", require=["geo"])
    dim = scd2_apply(None, spark.createDataFrame([(1, "Cali", 1), (2, "Pasto", 1)], schema), run_date="2024-01-01", **args)
    nxt = scd2_apply(dim, spark.createDataFrame([(1, "CALI  ", 1), (2, "Neiva", 1)], schema), run_date="2024-02-01", **args)
    assert sorted((r["id"], r["city"], r["is_current"]) for r in nxt.collect()) == [
        (1, "Cali", True), (2, "Neiva", True), (2, "Pasto", False)]


def test_exact_percentages(spark):
    def pct(n, d, *how):
        row = spark.range(1).select(exact_pct(F.lit(Decimal(n)) if n is not None else F.lit(None).cast("decimal(20,2)"),
                                              F.lit(Decimal(d)), *how).alias("x")).first()
        return None if row["x"] is None else str(row["x"])
    # a half cent goes away from zero; a double of 1.005 lies below it
    assert pct("201", "20000", 12, "decimal(5,2)", True) == "1.01"
    assert pct("0.01", "2.00", 15, "decimal(6,2)") == "0.50"
    assert pct("-201", "20000", 12, "decimal(6,2)", True) == "-1.01"
    # cut after six digits before the rounding: 2/3 -> 0.666666, 0.00005 less than needed for a half cent
    assert pct("2", "3", 6, "decimal(6,2)") == "66.67"
    assert pct("0.49", "799.97", 6, "decimal(6,2)") == "0.06"
    assert pct("1", "16000", 6, "decimal(6,2)") == "0.01"           # 0.0000625 -> 0.000062 -> 0.0062
    assert pct("12.34", "0", 6, "decimal(6,2)") is None and pct(None, "3", 6, "decimal(6,2)") is None
    assert pct("500000", "1", 6, "decimal(6,2)") is None            # does not fit
    assert pct("100", "100", 12, "decimal(5,2)", True) == "100.00"


def test_entry_survives_a_missing_library(tmp_path):
    """Without a library that the corpus operators import, the rest is registered."""
    (tmp_path / "sitecustomize.py").write_text(
        "import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[0] == 'zstandard':\n            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, No())\n")
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql();"
            "print(len(q) > 70, set(q) - set(E.LLM_QUERIES) <= set(o), 'pipeline' in q)")
    env = {**os.environ, "PYTHONPATH": f"{tmp_path}:{root}"}
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[:2] == ["True", "True"]
