"""Substring dedup, near-duplicates and decontamination against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.decontaminate import contamination
from tallyhouse.llm.near_dup import components, forest, linked, near_duplicates
from tallyhouse.llm.substring_dedup import remove_repeats
from tests.llm.helpers import ITEM_WORD, LOWER, WORD, odd_documents, texts, window_dict

BIG = 1 << 62


def test_substring_dedup_equals_brute_force(spark):
    docs = odd_documents(spark)
    rows, first = texts(docs), {}
    for i, t in rows:
        for w in window_dict(WORD.findall(t), 13):
            first[w] = min(first.get(w, BIG), BIG if i is None else i)
    want = Counter()
    for i, t in rows:
        words = WORD.findall(t)
        gone = [False] * len(words)
        for k, w in enumerate(window_dict(words, 13)):
            if first[w] < (BIG if i is None else i):
                gone[k:k + 13] = [True] * 13
        want[i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)] += 1
    for small in ({}, {"chunk_bytes": 4000, "bucket_windows": 500}):
        got = Counter(tuple(r) for r in remove_repeats(docs, **small).collect())
        assert got == want


def test_decontamination_equals_brute_force(spark):
    docs = odd_documents(spark)
    items = [(i, r["text"]) for i, r in enumerate(spark.read.parquet(
        "/root/testdata/sf0.001/benchmark.parquet").collect())]
    items += [(900, None), (901, "..."), (902, "Four five SIX"), (903, items[0][1]), (903, items[0][1]),
              (904, " ".join(COPY_WORDS)), (None, "four five six")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("print", F.lit(1))
    wanted = {}
    for i, t in items:
        words = ITEM_WORD.findall((t or "").translate(LOWER))
        n = min(10, len(words))
        for w in window_dict(words, n) if n else []:
            wanted.setdefault(n, {}).setdefault(w, set()).add(i)
    want = Counter()
    for i, t in texts(docs):
        words, hit, ids = ITEM_WORD.findall(t.translate(LOWER)), set(), set()
        for n, known in wanted.items():
            for k, w in enumerate(window_dict(words, n)):
                if w in known:
                    hit |= set(range(k, k + n))
                    ids |= known[w]
        want[i, len(words), len(hit), tuple(sorted(str(x) for x in ids if x is not None)), bool(hit)] += 1
    assert sum(n for k, n in want.items() if k[-1]) >= 3
    for known in (1 << 20, 0):  # with and without the early filter
        got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
                      for r in contamination(docs, bench, max_known=known).collect())
        assert got == want


COPY_WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def brute_components(rows, size, percent):
    sets = {}
    for i, t in rows:
        words = WORD.findall(t.translate(LOWER))
        sets[i] = set(window_dict(words, size)) if len(words) >= size else {tuple(words)} if words else set()
    label = {i: i for i in sets}
    ids = [i for i in sorted(x for x in sets if x is not None) if sets[i]]
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sets, label


@pytest.mark.parametrize("size,small_key", [(2, 16), (2, 1), (5, 1)])
def test_near_duplicates_equal_brute_force(spark, size, small_key):
    rows = texts(odd_documents(spark, 40))
    base = [f"t{i}" for i in range(120)]
    for k in range(30):  # a chain and a cloud of near copies
        words = list(base)
        for j in range(k % 8):
            words[(7 * k + 11 * j) % 120] = f"x{k}_{j}"
        rows.append((2000 + k, " ".join(words)))
    for k in range(12):
        rows.append((3000 + k, " ".join(base[:60] + [f"c{i}" for i in range(k * 4, k * 4 + 60)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, label = brute_components(rows, size, 80)
    got = near_duplicates(docs, shingle=size, small_key=small_key, block=8).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"] == len(sets[r["doc_id"]]) or r["doc_id"] is None)
        assert r["component_id"] == label[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len({r["component_id"] for r in got}) < len({i for i, _ in rows})


def test_components_of_a_chain_and_a_star(spark):
    nodes = spark.range(40)
    edges = spark.createDataFrame([(i + 1, i) for i in range(19)] + [(30, i) for i in range(20, 30)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(nodes, edges).collect()}
    assert got == {i: 0 if i < 20 else 20 if i <= 30 else i for i in range(40)}


def test_components_over_many_tasks(spark):
    """A long chain in random order over 40 tasks, by passes alone and with rounds of hooking."""
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 3000) if i % 100] + [(rnd.randrange(4000, 4500), rnd.randrange(4000, 4500)) for _ in range(300)]
    rnd.shuffle(edges)
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x
    for x, y in edges:
        x, y = sorted((find(x), find(y)))
        label[y] = x
    want = {x: find(x) for x in label if find(x) != x}
    table = spark.createDataFrame(edges, "a long, b long").repartition(40)
    for how in ({}, {"task_edges": 100}, {"task_edges": 40, "patience": 0.0}):
        assert {r["id"]: r["component"] for r in linked(table, **how).collect()} == want
    a, b = forest(np.array([5, 9, 7, 1]), np.array([9, 5, 1, 1]))
    assert dict(zip(a.tolist(), b.tolist())) == {9: 5, 7: 1}


def test_near_duplicates_of_one_id_with_two_texts(spark):
    """Every row out once, each judged by its own text; one keeper a component."""
    t = " ".join(f"t{i}" for i in range(60))
    rows = [(1, "a b c d e"), (1, "f g h i j"), (2, "z y x"), (1, t), (3, t), (3, "unlike all others here"),
            (4, t + " more"), (4, t), (7, "p q r s t u v"), (7, "p q r s t u v"), (None, t), (None, t)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), small_key=1).collect()
    assert len(got) == len(rows)
    shown = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"], r["keeper"]) for r in got)
    assert shown == Counter([(1, 1, 1, True, True), (1, 1, 1, True, True), (2, 1, 2, True, True), (1, 56, 1, True, True),
                             (3, 56, 1, False, False), (3, 1, 3, True, True), (4, 57, 1, False, False),
                             (4, 56, 1, False, False), (7, 3, 7, True, True), (7, 3, 7, True, True),
                             (None, 56, None, True, True), (None, 56, None, True, True)])


def test_near_duplicates_of_a_large_group(spark):
    """600 variants of one text among unrelated rows: crowded keys, brute-force components."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"u{rnd.randrange(5000)}" for _ in range(30))) for i in range(200)]
    for i in range(600):
        words = list(base)
        for _ in range(rnd.randrange(2, 6)):
            words[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((1000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    _, label = brute_components(rows, 2, 80)
    got = near_duplicates(docs, shingle=2, block=32, block_bytes=1 << 13).collect()
    assert len(got) == len(rows) and {r["doc_id"]: r["component_id"] for r in got} == label


def test_empty_tables(spark):
    none = odd_documents(spark).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert remove_repeats(none).count() == 0
    assert near_duplicates(none).count() == 0
    assert contamination(none, bench).count() == 0
    clean = contamination(odd_documents(spark, 5), bench).collect()
    assert len(clean) == 16 and not any(r["contaminated"] for r in clean)
    assert hashlib.sha256(b"").hexdigest() == contamination(odd_documents(spark, 1), bench).select(
        F.sha2(F.array_join("items", ","), 256)).first()[0]


def test_decontamination_across_row_boundaries(spark):
    ten = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(i, ten) for i in range(4)] + [
        (4, "here ends one with red green blue"), (5, "red green blue starts the next one"), (6, "red green blue"),
        (7, "nothing in here"), (8, f"lead in {ten}"), (9, f"{ten} and on")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, ten), (2, "red green blue")], "item_id long, text string")
    for known in (1 << 20, 0):
        got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in contamination(docs, bench, max_known=known).collect()}
        assert got == {**{i: (10, ["1"]) for i in (0, 1, 2, 3, 8, 9)}, **{i: (3, ["2"]) for i in (4, 5, 6)}, 7: (0, [])}


def test_near_duplicates_gets_small_arrow_batches(spark, monkeypatch):
    from tallyhouse.llm import common, near_dup
    key, steps, pin = "spark.sql.execution.arrow.maxRecordsPerBatch", [], near_dup.pin

    def pinned(df, name):
        steps.append((name, int(spark.conf.get(key))))
        return pin(df, name)
    monkeypatch.setattr(near_dup, "pin", pinned)
    rows = [(i, " ".join(f"w{i // 40}x{j}" for j in range(60)) + f" tail{i}") for i in range(80)]
    docs, before = spark.createDataFrame(rows, "doc_id long, text string"), spark.conf.get(key)
    for session, bound in ((before, common.BATCH_ROWS), ("7", 7), ("0", common.BATCH_ROWS)):
        spark.conf.set(key, session)
        try:
            got = near_duplicates(docs)
            assert spark.conf.get(key) == session
        finally:
            spark.conf.set(key, before)
        assert {r["component_id"] for r in got.collect()} == {0, 40}
        assert {n for _, n in steps} == {bound} and {"profiles", "sets", "pairs", "links"} <= {x for x, _ in steps}
        steps.clear()
