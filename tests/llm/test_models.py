"""Context trees, the quality classifier, page text and packing."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import common, html_text, packing
from tallyhouse.llm.common import remainder
from tallyhouse.llm.context_model import log_kt, score_texts
from tallyhouse.llm.packing import encoder, pack_documents, plan
from tallyhouse.llm.quality_model import score_quality
from tests.llm.helpers import LOWER, SMALL, WORD, odd_documents, texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- context trees
class BruteTrees:
    """Context-tree weighting node by node."""

    def __init__(self, train, depth):
        self.depth, self.counts = depth, defaultdict(lambda: [0, 0])
        for t in train:
            for context, node, bit in self.bits(t):
                for d in range(depth + 1):
                    self.counts[context[depth - d:], node][bit] += 1
        self.weighted, below = {}, defaultdict(float)
        for key in sorted(self.counts, key=lambda k: -len(k[0])):
            a, b = self.counts[key]
            own = math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
            low = below[key]
            all_ = own if len(key[0]) == depth else max(own, low) + math.log1p(math.exp(-abs(own - low))) - math.log(2)
            self.weighted[key] = own, all_
            if key[0]:
                below[key[0][1:], key[1]] += all_

    def bits(self, t):
        data = b"\xff" * self.depth + t.translate(LOWER).encode() + b"\xff"
        for i in range(self.depth, len(data)):
            for k in range(8):
                yield data[i - self.depth:i], (1 << k) | data[i] >> (8 - k), data[i] >> (7 - k) & 1

    def score(self, t):
        total = 0.0
        for context, node, bit in self.bits(t):
            gathered, left, one = 0.0, 1.0, 0.5
            for d in range(self.depth + 1):
                key = context[self.depth - d:], node
                if key not in self.counts:
                    break
                a, b = self.counts[key]
                p = (b + .5) / (a + b + 1)
                own, all_ = self.weighted[key]
                share = 1.0 if d == self.depth else math.exp(own - math.log(2) - all_)
                one = gathered + left * p
                gathered, left = gathered + left * share * p, left * (1 - share)
            total += math.log10(one if bit else 1 - one)
        return total


def brute_base(rows, train):
    tokens = [(i, WORD.findall(t.translate(LOWER)) + [None]) for i, t in rows]
    count = Counter(w for (i, ws) in tokens if train(i) for w in ws)
    n, v = sum(count.values()), len(count)
    return {i: (len(ws), sum(count[w] > 0 for w in ws), n,
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens}


@pytest.mark.parametrize("depth", [3, 5])
def test_context_trees_equal_brute_force(spark, depth):
    rows = [r for r in texts(odd_documents(spark, 25)) if r[0] != 1007 and len(r[1]) < 4000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit("name in use"))
    learned = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2
    trees, base = BruteTrees([t for i, t in rows if learned(i)], depth), brute_base(rows, learned)
    for chunk_bytes in (16 << 20, 3000):
        got = score_texts(docs, train=remainder("doc_id", 7) != 2, depth=depth, chunk_bytes=chunk_bytes).collect()
        assert len(got) == len(rows)
        own = dict(rows)
        for r in got:
            if r["doc_id"] is None:
                continue
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[r["doc_id"]][:3]
            assert r["base_score"] == pytest.approx(base[r["doc_id"]][3], rel=1e-9)
            assert r["score"] == pytest.approx(trees.score(own[r["doc_id"]]), rel=1e-5)


def test_log_kt_is_the_sequential_estimate():
    for a in range(4):
        for b in range(30):
            p, zeros, ones = 0.0, 0, 0
            for bit in [0] * a + [1] * b:
                p += math.log(((ones if bit else zeros) + .5) / (zeros + ones + 1))
                zeros, ones = zeros + 1 - bit, ones + bit
            assert float(log_kt(np.array([a * 1.0]), np.array([b * 1.0]))[0]) == pytest.approx(p, abs=1e-9)


def test_context_model_without_training_texts(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in score_texts(docs, train=F.lit(False)).collect()}
    assert got[1]["score"] == pytest.approx(-3 * 8 * math.log10(2)) and got[2]["n_tokens"] == 1
    assert got[1]["n_known"] == got[1]["train_tokens"] == 0 and got[1]["base_score"] == 0
    assert score_texts(docs.limit(0)).count() == 0


# ----------------------------------------------------------- quality classifier
def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = score_quality(docs, labels, learn=remainder("doc_id", 5) != 0)
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").filter(remainder("doc_id", 5) == 0).collect()
    good = [r["score"] for r in held if r["quality"] == 1]
    bad = [r["score"] for r in held if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) >= 0.97 * len(good) * len(bad)
    assert sum((r["score"] >= 0.3) == r["quality"] for r in held) >= 0.95 * len(held)


def test_quality_paths_agree_and_odd_labels(spark):
    docs = odd_documents(spark, 80)
    labels = spark.createDataFrame(
        [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
        + [(None, 1), (1004, None), (1005, 0), (1005, 1), (1006, 7)], "doc_id long, quality int")
    a = Counter((r["doc_id"], round(r["score"], 9)) for r in score_quality(docs, labels).collect())
    b = Counter((r["doc_id"], round(r["score"], 9)) for r in score_quality(docs, labels, max_known=0).collect())
    assert a == b and sum(a.values()) == docs.count() and all(0 <= s <= 1 for _, s in a)
    one = score_quality(docs, labels.filter("quality = 1")).collect()
    assert {r["score"] for r in one} == {1.0}
    assert {r["score"] for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(docs.limit(0), labels).count() == 0


# -------------------------------------------------------------------- page text
MAIN = "This is the first sentence of a longer paragraph, which says something about the mill and the road."


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<p>" + MAIN, MAIN), ("<!-- cut off <p>" + MAIN, ""),
    (f"<nav><a href=x>Home</a></nav><article><h1>A title</h1><p>{MAIN}</p><p>Short.</p></article>"
     f"<footer>&copy; {MAIN}</footer>", f"A title {MAIN} Short."),
    (f"<div class='cookie-notice'>{MAIN}</div><div id=content><p>{MAIN}</p></div><div class='comments'><p>{MAIN}</p></div>", MAIN),
    (f"<article><p>{MAIN}</p><aside>{MAIN}</aside><form><p>{MAIN}</p></form></article>", MAIN),
    (f"<article><p>a &lt;b&gt; &amp; c&#33;\n\n  d &copy e</p><script>if (a<b) '<p>{MAIN}</p>'</script></article>", "a <b> & c! d © e"),
    (f"<article><p title='a > b'>{MAIN}</p><p>cut <b", f"{MAIN} cut"),
    (f"<p>{MAIN}<p hidden>{MAIN}</p>", MAIN),
    # names are matched whole
    (f"<body class='no-sidebar'><div id=content><p>{MAIN}</p></div></body>", MAIN),
    (f"<div class='page-with-header'><p>{MAIN}</p></div>", MAIN),
    (f"<article><p class='market-share search-results'>{MAIN}</p><p title='display:none'>{MAIN}</p></article>", f"{MAIN} {MAIN}"),
    (f"<article><p>{MAIN}</p><div class='share-buttons ad'>{MAIN}</div><div id=comment-list>{MAIN}</div></article>", MAIN),
    (f"<div class='site-header'>{MAIN}</div><p style='color:red; display: none'>{MAIN}</p><article><p>{MAIN}</p></article>", MAIN),
    # nested articles are judged by what encloses them
    (f"<article><p>{MAIN}</p></article><section id=comments><article><p>{MAIN}</p></article></section>", MAIN),
    (f"<main><p>{MAIN}</p><aside><article><p>{MAIN}</p></article></aside></main>", MAIN),
    (f"<div class=related><div><article><p>{MAIN}</p></article></div></div><article><p>{MAIN}</p></article>", MAIN),
    (f"<form><div><article><p>{MAIN}</p></article></div></form>", MAIN)])
def test_main_text_of_a_page(spark, page, want):
    assert html_text.main_text(page, tree(spark)) == want


def tree(spark, kept=[]):  # noqa: B006  one tree for all cases
    if not kept:
        kept.append(html_text.train(spark))
    return kept[0]


def test_pages_equal_their_articles(spark):
    import html
    import re
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (9999, "u", "")], "page_id long, url string, html string")
    rows = pages.select("page_id", "url", "html").unionByName(odd).unionByName(odd)
    got = html_text.extract_text(rows.withColumn("text", F.lit(1)), tree=tree(spark)).collect()
    assert len(got) == rows.count()
    want = {r["page_id"]: r["html"] or "" for r in rows.collect()}
    for r in got:
        m = re.search(r"<article>(.*?)(</article>|$)", want[r["page_id"]], re.S)
        text = re.sub(r"<[^>]*(>|$)", " ", re.sub(r"</?b>", "", m[1])) if m else ""
        assert r["text"] == " ".join(html.unescape(text).split())


# ---------------------------------------------------------------------- packing
def test_ids_are_those_of_the_tokenizer():
    model = Tokenizer.from_file(VOCABULARY)
    odd = ["", " ", "a  b\n\n c\t", "'s don't I'LL", "naïve café 中文字 🙂", "x" * 5000, "1234 ²³ Ⅷ", "\x85\x1c​᠎ a",
           "<|endoftext|> end",
           "a <|endoftext|> b<|endoftext|><|endoftext", "<|endoftext|>"]
    for t in odd:
        assert np.frombuffer(encoder(VOCABULARY)(t), "<u4").tolist() == model.encode(t, add_special_tokens=False).ids


def test_every_token_has_one_place(spark):
    model, docs = Tokenizer.from_file(VOCABULARY), odd_documents(spark)
    want = Counter()
    for i, t in texts(docs):
        ids = model.encode(t, add_special_tokens=False).ids + [0]
        first, at, k = len(ids) % 256 or 256, 0, 0
        while at < len(ids):
            size = first if not k else 256
            want[i, k, at, size, zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes())] += 1
            at, k = at + size, k + 1
    got = pack_documents(docs, VOCABULARY, capacity=256).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    assert len(by) <= -(-sum(r["length"] for r in got) // 256) + 1
    assert pack_documents(docs.limit(0), VOCABULARY).count() == 0


def test_packing_holds_little_in_a_task(spark, monkeypatch):
    """Texts are read and sent in small batches, the pieces are not sorted for the
    join with their starts, and the session's settings are put back."""
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    asked, pin, before = [], packing.pin, [spark.conf.get(k) for k in keys]

    def seen(df, name):
        asked.append([int(spark.conf.get(k)) for k in keys])
        return pin(df, name)

    monkeypatch.setattr(packing, "pin", seen)
    docs = spark.createDataFrame([(i % 7, "a b c " * (i % 40)) for i in range(1200)], "doc_id long, text string")
    got = pack_documents(docs, VOCABULARY, capacity=64)
    assert asked == [[common.BATCH_ROWS] * 2]
    assert [spark.conf.get(k) for k in keys] == before
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan_text and "SortMergeJoin" not in plan_text
    rows, of = got.collect(), common.id_and_text(docs)
    assert sum(r["length"] for r in rows) == of.count() + sum(
        len(encoder(VOCABULARY)(r["text"])) // 4 for r in of.collect())
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(3, 40), st.dictionaries(st.integers(1, 40), st.integers(1, 60), max_size=12))
def test_plan_places_every_length(capacity, lengths):
    counts = np.zeros(capacity + 1, np.int64)
    for n, k in lengths.items():
        counts[min(n, capacity)] += k
    used, bins = np.zeros(capacity + 1, np.int64), defaultdict(list)
    for length, first, n, each, sequence, offset in sorted(plan(counts, capacity)):
        assert first == used[length]
        used[length] += n
        for k in range(n):
            bins[sequence + k // each].append((offset + k % each * length, length))
    assert (used == counts).all()
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = int((counts * np.arange(capacity + 1)).sum())
    assert len(bins) <= max(2 * -(-total // capacity), 1)


def test_exact_pairs_are_fixed_first():
    counts = np.zeros(11, np.int64)
    counts[[7, 3, 6, 4, 5]] = 5, 5, 2, 2, 4
    assert len({x[4] + k // x[3] for x in plan(counts, 10) for k in range(x[2])}) == 9
