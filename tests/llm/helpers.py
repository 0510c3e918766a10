"""Small inputs and brute-force versions that the operators are held against."""

import re
import string

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen. " * 4


def odd_documents(spark, limit=60):
    """Documents of the small set, then null, empty, tiny, long, equal and repeated
    rows, with extra columns whose names the operators use inside."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .orderBy("doc_id").limit(limit).collect()]
    text = " ".join(f"w{i % 977}" for i in range(30_000))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "Word"), (1004, COPY), (1005, COPY),
             (1005, COPY), (1006, COPY + " tail"), (1007, text), (None, "no id here " * 30), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as row", "'x' as chunk", "2 as key", "'y' as bucket", "3 as label", "4 as item")


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def window_dict(words, n):
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
