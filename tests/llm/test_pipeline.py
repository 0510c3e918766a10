"""The pipeline against its stages done by hand, and the queries that have SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm.oracle import ORACLE
from tallyhouse.llm.queries import QUERIES
from tests.llm.helpers import ITEM_WORD, LOWER, SMALL, WORD, odd_documents, window_dict
from tests.llm.test_dedup import brute_components
from tests.oracle_check import digest, duck


def _documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = odd_documents(spark, 0).select("doc_id", "text").withColumns(
        {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    return docs.unionByName(odd).unionByName(docs.limit(20))


def test_stages_equal_brute_force(spark):
    docs = _documents(spark)
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    assert kept.columns == docs.columns
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    _, label = brute_components(rows, 5, 80)
    single = corpus_pipeline.near_dup(spark, kept, SMALL)
    assert sorted(r["doc_id"] for r in single.collect() if r["doc_id"] is not None) == sorted(
        {i for i, _ in rows if i is not None and label[i] == i})
    single = spark.createDataFrame(single.collect(), docs.schema)
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = ITEM_WORD.findall(r["text"].translate(LOWER))
        windows |= set(window_dict(words, min(10, len(words))))
    clean = corpus_pipeline.decontaminate(spark, single, SMALL)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        r["doc_id"] for r in single.collect()
        if not windows & set(window_dict(ITEM_WORD.findall(r["text"].translate(LOWER)), 10)))
    clean = spark.createDataFrame(clean.collect(), docs.schema)
    safe = corpus_pipeline.secrets(spark, clean, SMALL)
    assert safe.columns == docs.columns and safe.count() == clean.count()
    assert all('token = "' not in r["text"] or "[SECRET]" in r["text"] for r in safe.collect())
    packed = corpus_pipeline.pack(spark, safe, SMALL)
    assert packed.select("doc_id").distinct().count() == safe.select("doc_id").distinct().count()


def test_quality_stage_drops_words_only_with_their_lines(spark):
    docs = _documents(spark)
    before = {r["doc_id"]: set((r["text"] or "").split("\n")) for r in docs.collect()}
    for r in corpus_pipeline.quality(spark, docs, SMALL).collect():
        assert set(r["text"].split("\n")) <= before[r["doc_id"]] and len(WORD.findall(r["text"])) >= 35
        assert r["n_chars"] == len(r["text"])


def test_empty_documents_pass_through(spark):
    none = _documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = spark.createDataFrame([], stage(spark, none, SMALL).schema)
    assert "sequence_id" in none.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SMALL).execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, cur.fetchall())[0]


def test_contaminated_rows_go_by_their_text(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
                if len(ITEM_WORD.findall(r["text"])) >= 10)
    rows = [(None, f"no id {item}"), (None, "no id and clean"), (1, f"an id {item}"), (1, "the same id and clean"),
            (2, "clean"), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "digest": F.lit("x"), "n_chars": F.length("text").cast("long")})
    got = corpus_pipeline.decontaminate(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {x for x in rows if item not in (x[1] or "")}
    assert got.count() == 5


def test_one_id_with_two_texts_loses_no_clean_row(spark):
    """(3, T) is a copy of (1, T); (3, U) is a copy of nothing and stays, as do rows without an id."""
    t, u = (" ".join(f"{x}{i}" for i in range(60)) for x in "tu")
    rows = [(1, t), (3, t), (3, u), (4, t + " more"), (5, u + " other end"), (5, u), (None, t), (None, t), (6, "short"),
            (6, "short"), (7, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "text_hash": F.lit(5), "keeper": F.lit("x"), "n_chars": F.length("text").cast("long")})
    got = corpus_pipeline.near_dup(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert kept == sorted([(1, t), (3, u), (None, t), (None, t), (6, "short"), (7, None), (None, None)], key=str)
