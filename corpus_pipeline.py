"""From raw documents to packed training sequences.

Five stages, in order; each works on all that the one before it kept, and all
but the last return the columns of ``documents``:

1. ``quality``: failing lines are removed; documents that the rules reject go;
2. ``near_dup``: of each group of near-duplicates (five-word shingles,
   similarity 0.8 or more) the document with the smallest id stays (of several
   texts under that id, the one with the smallest hash);
3. ``decontaminate``: documents that share ten consecutive words with a test
   item go (an item of fewer words is one window), each row judged by its text;
4. ``secrets``: secrets are replaced by a mark; the documents stay;
5. ``pack``: the texts are tokenised and packed into sequences.

A stage that changes a text also sets its ``n_chars``.  Rows that repeat an id
with the same text are one document and one of them stays; rows that share an
id but not the text are judged each by its own.  Rows without an id are never
near-duplicates; the other stages treat them like any row.  An empty
``documents`` table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.decontaminate import contamination
from tallyhouse.llm.near_dup import near_duplicates
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.quality_rules import clean_lines
from tallyhouse.llm.secrets import scan_secrets
from tallyhouse.operators.keys import pin


def _carried(docs: DataFrame) -> DataFrame:
    """The documents with their row under one name, which an operator takes as
    the id and hands back, so that no join on ids is needed."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))


def _with_text(rows: DataFrame, columns: list[str], text: str) -> DataFrame:
    changed = F.when(F.col("row.text").eqNullSafe(F.col(text)), F.col("row.n_chars")).otherwise(
        F.length(text).cast("long"))
    return rows.select(*[F.col(text).alias(x) if x == "text" else changed.alias(x) if x == "n_chars"
                         else F.col(f"row.{x}") for x in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # exploding a one-element array keeps the filter above the judgement, which
    # would otherwise be worked out again for every column that the filter needs
    judged = clean_lines(_carried(docs), id_col="row").select(
        F.explode(F.array(F.struct("doc_id", "kept", "clean_text"))).alias("j")).filter("j.kept").select(
        F.col("j.doc_id").alias("row"), F.col("j.clean_text").alias("clean_text"))
    return _with_text(judged, docs.columns, "clean_text")


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a verdict belongs to a row's id and text, so of one id with two texts each is judged
    judged = pin(near_duplicates(docs).groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n"), F.min("keeper").alias("keeper")).filter("doc_id is not null and (not keeper or n > 1)"),
        "judged")
    hashed = docs.select("*", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias(_HASH))
    named = [F.col("doc_id").alias("i"), F.col("text_hash").alias("h")]
    same = lambda d, j: (d["doc_id"].cast("long") == j["i"]) & (d[_HASH] == j["h"])
    gone = judged.filter(~F.col("keeper")).select(*named)
    kept = hashed.join(gone, same(hashed, gone), "left_anti")
    repeated = judged.filter("keeper").select(*named)
    if not repeated.isEmpty():  # rows that repeat id and text: one of them stays
        more = kept.join(repeated, same(kept, repeated), "left_semi").dropDuplicates(["doc_id", _HASH])
        kept = kept.join(repeated, same(kept, repeated), "left_anti").unionAll(more)
    return kept.select(*docs.columns)


_HASH = "hash of the text"


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    # the row rides through the scan, so no text is shuffled and an id is not needed
    judged = contamination(_carried(docs), benchmark, id_col="row")
    return judged.filter(~F.col("contaminated")).select("doc_id.*").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(_carried(docs), id_col="row").withColumnRenamed("doc_id", "row")
    kept = F.when(F.size("secrets") > 0, F.col("redacted_text")).otherwise(F.col("row.text"))
    return _with_text(scanned.withColumn("shown", kept), docs.columns, "shown")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_dup", near_dup), ("decontaminate", decontaminate),
          ("secrets", secrets), ("pack", pack)]

# Near-duplicate components and packing are not expressible in SQL; the
# pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
