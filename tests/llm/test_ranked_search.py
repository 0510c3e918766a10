"""Ranked search against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm.oracle import ORACLE
from tallyhouse.llm.queries import op13_ranked_search
from tallyhouse.llm.ranked_search import needed_lists, rank_documents
from tests.llm.helpers import LOWER, SMALL, odd_documents, texts
from tests.oracle_check import digest, duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    """Counter of (item, rank, doc_id, score); equal ids and scores are equal rows."""
    held = [(i, TERM.findall(t.translate(LOWER))) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n, total = len(held), sum(m for _, _, m in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = Counter()
    for item, terms in asked.items():
        scores = []
        for i, c, m in held:
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                (1000000000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * m * n) // total))) for t in terms if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, i, -s] += 1
    return out


def items_of(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    return items + [(900, None), (901, "..."), (902, "One two, THREE"), (902, "w5 w7 w9 w5"), (903, "absentterm"),
                    (904, "one"), (None, "no id here"), (905, items[0][1])]


@pytest.mark.parametrize("sizes", [{}, {"block": 2, "shard_cells": 20_000}, {"query_rows": 9, "block": 3},
                                   {"k": 3, "block": 1, "shard_cells": 1, "query_rows": 40}])
def test_ranked_search_equals_brute_force(spark, sizes):
    docs = odd_documents(spark)
    items = items_of(spark)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "item_id", "text", "1 as query", "2 as rank", "'x' as doc_id").repartition(3)
    got = rank_documents(docs, bench, **sizes)
    assert Counter(map(tuple, got.collect())) == brute(texts(docs), items, sizes.get("k", 10))


def test_many_equal_scores_and_a_hot_term(spark):
    """2 000 copies of one text: the smallest ids are found, whatever the order."""
    rows = [(i, "common alpha beta") for i in range(2000, 0, -1)]
    rows += [(5000 + i, f"common w{i} gamma " * (i % 7 + 1)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    items = [(1, "alpha"), (2, "common"), (3, "common beta w7 gamma"), (4, "gamma w250 w8")]
    got = rank_documents(docs, spark.createDataFrame(items, "item_id long, text string"), block=16, shard_cells=1500)
    got = Counter(map(tuple, got.collect()))
    assert got == brute(rows, items, 10)
    assert [i for q, _, i, _ in sorted(got) if q == 1] == list(range(1, 11))


def test_ranked_search_empty_tables(spark):
    docs, bench = odd_documents(spark), spark.createDataFrame(items_of(spark), "item_id long, text string")
    assert rank_documents(docs.limit(0), bench).collect() == []
    assert rank_documents(docs, bench.limit(0)).collect() == []
    assert rank_documents(docs.filter("text is null"), bench).collect() == []


def test_needed_lists_keep_what_can_reach_the_threshold():
    class Q:
        terms = [np.array([0, 1, 2, 3])]
    largest = np.array([5, 100, 0, 20])
    assert [x.tolist() for x in needed_lists(Q, largest, np.array([1]))] == [[1, 3, 0]]
    assert [x.tolist() for x in needed_lists(Q, largest, np.array([25]))] == [[1, 3]]
    assert [x.tolist() for x in needed_lists(Q, largest, np.array([26]))] == [[1]]


def test_ranked_search_query_equals_sql(spark):
    df = op13_ranked_search(spark, SMALL)
    cur = duck(SMALL).execute(ORACLE["op13_ranked_search"])
    names = [d[0] for d in cur.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(names, cur.fetchall())[0]
