"""Driver contract: entry() runs, every query has SQL, a sample matches DuckDB."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import digest, duck

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "margin_pct" in df.columns


def test_every_query_has_oracle():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_ORACLE)


@pytest.mark.parametrize("name", ["validate_sales", "scd2_customer", "fact_sales", "fact_inventory",
                                  "fact_returns", "quality_summary", "dense_keys", "audit_check",
                                  "sample_top_n", "dedup_tied_feed", "validate_goals", "optional_rules_returns"])
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SMALL).execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows)[0] == digest(ocols, cur.fetchall())[0]
