"""Byte-level BPE: encoding by batched rounds of merges, and decoding.

Texts are cut into words as the vocabulary file says.  The distinct new words
of a slice of texts are encoded together: the symbols of all of them stand in
one flat array, the rank of every neighbouring pair is found by binary search
over the sorted keys of the merges, and in each round every word merges its
lowest-ranked pair, wherever it stands in the word.  Words without a pair that
merges leave the array.

A very long word is cut into units of at least twice the longest token, and a
unit merges only while neither neighbour holds a lower rank.  A lower-ranked
merge elsewhere can reach a pair only through a token that spans the distance,
so this gives the ids of merging strictly by rank, with many merges a round.

Ids and texts go through ``mapInArrow`` in slices of bounded size; the words
kept between slices are bounded as well.  Nothing is shuffled.

Defined cases: a null or empty text has no ids and decodes to an empty text;
strings of added tokens in a text become their ids; unknown ids are skipped
when decoding, and bytes that are no UTF-8 become U+FFFD; repeated rows are
encoded each; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import common as c

_SLICE = 1 << 20
_KEPT_BYTES = 1 << 26  # words and ids kept between slices
_NONE = np.int64(1) << 40  # the rank of a pair that does not merge
# fixed value: how byte-level BPE cuts a text before merging
_WORDS = regex.compile(r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    same = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [x for x in range(256) if x not in same]
    return {chr(x): x for x in same} | {chr(0x100 + i): x for i, x in enumerate(other)}


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of the ranges [start, start + length), one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Vocabulary:
    """A byte-level BPE vocabulary in the JSON form of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        model, cut = stored["model"], stored.get("pre_tokenizer") or {}
        plain = (model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                 and not model.get("byte_fallback") and stored.get("normalizer") is None
                 and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                 and not cut.get("add_prefix_space") and not stored.get("post_processor"))
        added = stored.get("added_tokens") or []
        if not plain or any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        byte_of, ids = _byte_of(), dict(model["vocab"])
        words = {i: bytes(byte_of[x] for x in w) for w, i in ids.items() if all(x in byte_of for x in w)}
        self.first = np.array([ids[x] for x in sorted(byte_of, key=byte_of.get)], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.product = np.array([ids[a + b] for a, b in merges], np.int64)
        made = np.full(max([*ids.values(), 0]) + 1, -1, np.int64)
        made[self.product] = np.arange(len(merges))
        if (np.maximum(made[left], made[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge uses a symbol before the merge that makes it")
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int64)
        self.unit = 2 * max([len(w) for w in words.values()] or [1])
        self.added = {x["content"]: x["id"] for x in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        words.update({i: w.encode() for w, i in self.added.items()})
        self.n_ids = max([*words, -1]) + 1
        shown = [words.get(i, b"") for i in range(self.n_ids)]
        self.bytes = np.frombuffer(b"".join(shown), np.uint8)
        self.lengths = np.array([len(w) for w in shown], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    # ------------------------------------------------------------------ encoding
    def words_in(self, text: str) -> list[str]:
        """The words of a text; added tokens are words of their own."""
        if self.split is None:
            return _WORDS.findall(text)
        found = []
        for k, part in enumerate(self.split.split(text)):
            found += [part] if k % 2 else _WORDS.findall(part)
        return found

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, by binary search over the keys."""
        if not len(self.keys):
            return np.full(len(a), _NONE)
        wanted = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of[at], _NONE)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and each word's start in them (one more at the end)."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        # units are numbered over all words; short words are one unit
        inside = flat_ranges(np.zeros(len(words), np.int64), sizes) // self.unit
        unit = inside + np.repeat(np.cumsum(-(-sizes // self.unit)) - (-(-sizes // self.unit)), sizes)
        rank = np.full(len(symbol), _NONE)
        pair = np.flatnonzero(word[1:] == word[:-1])
        rank[pair] = self.ranks(symbol[pair], symbol[pair + 1])
        done_word, done_symbol = [], []
        while len(symbol):
            starts = np.flatnonzero(np.diff(unit, prepend=-1))
            least, of = np.minimum.reduceat(rank, starts), word[starts]
            same = of[1:] == of[:-1]
            go = least < _NONE
            go[1:] &= ~same | (least[1:] <= least[:-1])
            go[:-1] &= ~same | (least[:-1] <= least[1:])
            if not go.any():
                break
            size = np.diff(starts, append=len(symbol))
            merge = rank == np.repeat(np.where(go, least, -1), size)
            at = np.flatnonzero(merge)
            at = self._without_overlaps(at, rank, merge)
            symbol[at] = self.product[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word, unit, rank = symbol[keep], word[keep], unit[keep], rank[keep]
            at -= np.arange(len(at))
            near = np.concatenate((at, at[at > 0] - 1))
            inner = near[near + 1 < len(symbol)]
            inner = inner[word[inner] == word[inner + 1]]
            rank[at] = _NONE
            rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
            # words in which nothing merges any more leave
            left = np.zeros(len(words), bool)
            left[word[rank < _NONE]] = True
            over = ~left[word]
            if 4 * np.count_nonzero(over) > len(symbol):
                done_word.append(word[over])
                done_symbol.append(symbol[over])
                symbol, word, unit, rank = symbol[~over], word[~over], unit[~over], rank[~over]
        word, symbol = np.concatenate([*done_word, word]), np.concatenate([*done_symbol, symbol])
        order = np.argsort(word, kind="stable")
        return symbol[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    @staticmethod
    def _without_overlaps(at: np.ndarray, rank: np.ndarray, merge: np.ndarray) -> np.ndarray:
        """Of merges that share a symbol (equal symbols in a row) the first, third
        and so on.  A run that begins in a unit that has to wait waits with it."""
        if len(at) < 2 or not (np.diff(at) == 1).any():
            joined = at[at > 0]
            return np.setdiff1d(at, joined[(rank[joined - 1] == rank[joined])], assume_unique=True)
        head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        run = np.repeat(np.arange(len(head)), np.diff(head, append=len(at)))
        first = at[head]
        waits = (first > 0) & (rank[np.maximum(first - 1, 0)] == rank[first]) & ~merge[np.maximum(first - 1, 0)]
        return at[((at - first[run]) % 2 == 0) & ~waits[run]]

    # ------------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of rows of ids (``offsets``: each row's start, one more at the end)."""
        known = (ids >= 0) & (ids < self.n_ids)
        safe = np.where(known, ids, 0)
        lengths = np.where(known, self.lengths[safe], 0)
        data = self.bytes[flat_ranges(self.starts[safe], lengths)].tobytes()
        at = np.concatenate(([0], np.cumsum(lengths)))[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


class Encoder:
    """Encodes texts and keeps the ids of the words it has met, in bounded space."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.kept = 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and each text's start in them (one more at the end)."""
        if self.kept > _KEPT_BYTES:
            self._forget()
        found = [self.vocabulary.words_in(t) for t in texts]
        new = [w for w in dict.fromkeys(w for words in found for w in words) if w not in self.known]
        if new:
            self._learn(new)
        counts = np.array([len(words) for words in found], np.int64)
        at = np.fromiter((self.known[w] for words in found for w in words), np.int64, int(counts.sum()))
        ids = self.ids[flat_ranges(self.starts[at], self.lengths[at])]
        ends = np.concatenate(([0], np.cumsum(self.lengths[at])))
        return ids, ends[np.concatenate(([0], np.cumsum(counts)))]

    def _learn(self, new: list[str]) -> None:
        added = self.vocabulary.added
        plain = [w for w in new if w not in added]
        ids, at = self.vocabulary.encode_words([w.encode() for w in plain]) if plain else (
            np.zeros(0, np.int64), np.zeros(1, np.int64))
        special = [w for w in new if w in added]
        ids = np.concatenate((ids, np.array([added[w] for w in special], np.int64)))
        lengths = np.concatenate((np.diff(at), np.ones(len(special), np.int64)))
        for w in (*plain, *special):
            self.known[w] = len(self.known)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids))
        self.kept += sum(100 + len(w) for w in new) + 8 * len(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, read once in a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(path)
        for batch in batches:
            _, offsets = c.utf8(batch.column("text"))
            for a, b in c.row_slices(offsets, _SLICE):
                ids, at = use.encode(batch.column("text").slice(a, b - a).to_pylist())
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))})
    return encode


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path).vocabulary
        for batch in batches:
            column = batch.column("ids")
            lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
            for a, b in c.row_slices(np.concatenate(([0], np.cumsum(lengths))), _SLICE // 4):
                part = column.slice(a, b - a)
                at = np.concatenate(([0], np.cumsum(lengths[a:b])))
                texts = vocabulary.decode(part.flatten().to_numpy().astype(np.int64), at)
                yield pa.record_batch([batch.column(x).slice(a, b - a) for x in ("doc_id", "ids")]
                                      + [pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])
    return decode


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array of int).  ``path``: the
    vocabulary file, which every machine must have there."""
    rows = c.id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode(path), f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ids: doc_id, ids, text (null ids: empty, null entries skipped)."""
    ids = F.filter(F.coalesce(F.col(ids_col), F.array().cast("array<int>")), lambda x: x.isNotNull())
    rows = encoded.select(F.col(id_col).alias("doc_id"), ids.cast("array<int>").alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_decode(path), f"doc_id {kind}, ids array<int>, text string")
