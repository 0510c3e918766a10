"""Whitening against integer brute force, BPE against the tokenizers library."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tallyhouse.llm.byte_pair import Encoder, decode_documents, encode_documents
from tallyhouse.llm.queries import op11_whitening, op12_byte_pair
from tallyhouse.llm.whitening import bit_planes, fit_whitening, scatter, whiten
from tests.llm.helpers import SMALL, odd_documents, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<float>, vector string, n int, i int"


# ------------------------------------------------------------------- whitening
def brute(rows):
    """n, x by row, the exact covariance and the deviation of each row."""
    x = [[math.floor(64 * float(v)) + 1000000 for v in r] for r in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    centred = [[n * v - t for v, t in zip(r, s)] for r in x]
    cov = np.array([[sum(r[i] * r[j] for r in centred) / n ** 3 for j in range(d)] for i in range(d)])
    return n, np.array(centred, float) / n, cov, [sum(v * v for v in r) for r in centred]


@pytest.mark.parametrize("width", [3, 9, 40])
def test_scatter_is_exact(width):
    rng = np.random.default_rng(width)
    y = rng.integers(0, 1 << width, (333, 7)).astype(np.int64)
    y[:, 2], y[:, 3] = 0, y[:, 1]
    into = np.zeros((7, 7), object)
    scatter(y, np.array([int(v).bit_length() for v in y.max(0)]), into)
    for i in range(7):
        for j in range(i, 7):
            assert into[i, j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))
    assert not len(bit_planes(np.zeros((5, 2), np.int64), np.zeros(2, np.int64))[0])


def test_whitening_equals_brute_force(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.orderBy("vec_id").collect()]
    rows += [rows[0], (None, rows[1][1])]
    odd = [(90001, None), (90002, [None] * 64), (90003, [float("nan")] * 64), (90004, [float("inf")] + [0.0] * 63),
           (90005, [0.5] * 3), (90006, []), (90007, [1e30] * 64)]
    table = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows + odd], VECTORS)
    got = whiten(table.repartition(5)).collect()
    n, centred, cov, deviation = brute([v for _, v in rows])
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    key = lambda i: (i is None, i or 0)
    assert sorted((r["vec_id"] for r in got), key=key) == sorted((i for i, _ in rows), key=key)
    by_id = {i: k for k, (i, _) in enumerate(rows)}
    fit = fit_whitening(table)
    shown = np.array([r["whitened"] for r in got])
    for r, w in zip(got, shown):
        k = by_id[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation[k]
        assert np.allclose(r["explained"], values[:32] / np.trace(cov), rtol=1e-9)
        assert np.allclose(np.abs(w), np.abs(centred[k] @ vecs[:, :32]) / np.sqrt(values[:32]), atol=1e-7)
    assert np.abs(shown.T @ shown / n - np.eye(32)).max() < 1e-9 and got[0]["identity_error"] < 1e-9
    assert len(fit.values) == 32


def test_whitening_defined_cases(spark):
    equal = spark.createDataFrame([(i, [1.0, 2.0], "", 0, 0) for i in range(5)], VECTORS)
    assert whiten(equal).count() == 5 and all(r["whitened"] == [] for r in whiten(equal).collect())
    assert whiten(equal.limit(0)).collect() == []
    assert whiten(equal.selectExpr("vec_id", "cast(null as array<float>) as embedding")).collect() == []
    # a dimension that repeats another has no component of its own, a far value is exact
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    rows = [(i, [float(a), float(a), float(b), float(c) * 1e7]) for i, (a, b, c) in enumerate(x)]
    table = spark.createDataFrame([(i, v, "", 0, 0) for i, v in rows], VECTORS.replace("float", "double"))
    got = whiten(table).orderBy("vec_id").collect()
    assert len(got[0]["whitened"]) == len(got[0]["explained"]) < 4
    n, _, _, deviation = brute([v for _, v in rows])
    assert [r["deviation"] for r in got] == [v if v < 1 << 63 else None for v in deviation]


def test_whitening_query(spark):
    got = op11_whitening(spark, SMALL).collect()
    assert Counter(r["component"] for r in got) == {k: 500 for k in range(1, 33)}
    assert max(r["identity_error"] for r in got) < 1e-4
    first = {r["component"]: r["explained"] for r in got}
    assert sorted(first.values(), reverse=True) == [first[k] for k in range(1, 33)]


# ------------------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def check(library, texts_):
    encoder = Encoder(PATH)
    ids, at = encoder.encode(texts_)
    shown = encoder.vocabulary.decode(ids, at)
    for k, (text, e) in enumerate(zip(texts_, library.encode_batch(texts_, add_special_tokens=False))):
        assert ids[at[k]:at[k + 1]].tolist() == e.ids, text[:50]
        assert shown[k] == library.decode(e.ids, skip_special_tokens=False) == text


def test_bpe_equals_library(library):
    rnd = random.Random(5)
    kinds = ["ab", "aab ", "abcdefgh", "0123456789ABCDEF", "  \n\t\r a", "éèaあ́", "a<|endoftext|> ", "=-_", "ÃÂ"]
    made = ["".join(rnd.choice(k) for _ in range(n)) for k in kinds for n in (0, 1, 2, 7, 60, 900, 5000)]
    made += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", "don't WE'LL 's've", "\x00\x1c\x85​",
             " " * 3000, "a" * 3001, "x" * 255 + "yy" * 400, "\U0001F600 \U00020000", "e" * 256 + "the" * 300]
    check(library, made)


def test_bpe_every_character_class(library):
    step = ["x" + chr(a) + " " + chr(a) + "1" for a in range(0, 0x3000) if not 0xD800 <= a < 0xE000]
    check(library, step)


def test_bpe_operator_defined_cases(spark, library):
    docs = odd_documents(spark)
    encoded = encode_documents(docs, PATH)
    want = Counter((i, tuple(library.encode(t, add_special_tokens=False).ids), t) for i, t in texts(docs))
    got = Counter((r["doc_id"], tuple(r["ids"]), r["text"]) for r in decode_documents(encoded, PATH).collect())
    assert got == want
    assert encode_documents(docs.limit(0), PATH).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [64, None, -5, 99999, 50256]), (4, [127, 64])],
                                "doc_id long, ids array<int>")
    assert [r["text"] for r in decode_documents(odd, PATH).orderBy("doc_id").collect()] == [
        "", "", "a<|endoftext|>", library.decode([127, 64], skip_special_tokens=False)]


def test_bpe_query(spark, library):
    want = Counter()
    for i, t in texts(spark.read.parquet(f"{SMALL}/documents.parquet")):
        ids = library.encode(t, add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(t.encode()).hexdigest()] += 1
    assert Counter(map(tuple, op12_byte_pair(spark, SMALL).collect())) == want


def test_bpe_refuses_other_vocabularies():
    with pytest.raises(ValueError):
        Encoder(public_tokenizers.path("word_bpe_49k.json"))
