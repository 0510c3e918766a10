"""Line-first cleaning of documents, in DataFrame functions only.

Each line of a text is judged by itself: symbol-laden lines, lines of
punctuation, shouted lines, lines that repeat one word, menu lines and
boilerplate lines fail, and so do the lines of a vertical menu: a run of short
lines none of which ends as a sentence does.  Failing
lines are removed, and a document that loses more than ``max_lost`` of its
words that way is rejected, next to the base limits (too short, or mostly
repeated three-word windows).

Defined cases: a null text has no words and is rejected as too short; lines
without a word are neither kept nor counted as lost; lines end at ``\\n`` only;
repeated rows are judged each on their own; an empty table gives an empty
result; columns other than id and text are not read.  Work per row is n log n
in the words of the row and nothing is shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_and_text, let

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# fixed values: phrases of boilerplate lines (lower case)
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use",
               "terms of service", "enable javascript", "click here", "sign up for our newsletter",
               "is licensed under", "lorem ipsum", "powered by")
SHORT_LINE = 20  # words up to which one phrase makes a line boilerplate
ENTRY_WORDS, MENU_LINES = 3, 6  # words of a menu entry at most, and lines of a menu at least
PUNCTUATION = "!-/:-@\\[-`{-~"
SENTENCE_END = r"[.!?:;,…。！？][\"'»”’)\]]*[\x20\x09-\x0D]*$"


def only(text: Column, inside: str) -> Column:
    """The characters of ``text`` that the class ``inside`` lists."""
    return F.regexp_replace(text, f"[^{inside}]+", "")


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """How many words lie in windows of ``size`` words that occur at least twice.

    Windows are compared by a 64-bit hash inside one text.  Equal hashes stand
    side by side after a sort, so long texts cost n log n."""
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - size),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            found = F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]).eqNullSafe(True)
                             | (e["h"] == F.get(s, j + 1)["h"]).eqNullSafe(True))
            return let(F.sort_array(F.transform(found, lambda e: e["i"])), spread)

        def spread(at: Column) -> Column:
            widths = F.transform(at, lambda p, j: F.least(
                F.lit(size), F.coalesce(F.get(at, j + 1) - p, F.lit(size))))
            return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, twice))

    return F.when(F.size(words) < size + 1, F.lit(0)).otherwise(let(hashes(words), covered)).cast("long")


def line_fails(line: Column, words: Column, max_symbols: float = 0.5,
               max_shout: float = 0.6) -> Column:
    """Whether a line with words is symbol-laden (symbols per word), shouted
    (capitals per ASCII letter), three words at most over and over, a menu, or
    boilerplate.  The cheap tests come first; the others run only behind them."""
    def many_symbols(n: Column) -> Column:
        return F.length(only(line, SYMBOLS)) > max_symbols * n

    def shouted() -> Column:
        return let(F.length(only(line, "A-Z")), lambda capitals: (capitals >= 6) & (
            capitals > max_shout * F.length(only(line, "A-Za-z"))))

    def menu(n: Column) -> Column:
        return F.size(F.filter(words, lambda x: x.isin("|", ">", "»", "·", "/"))) * 3 >= n

    def punctuation(n: Column) -> Column:
        return (n >= 3) & (2 * F.length(only(line, PUNCTUATION)) > F.length(F.array_join(words, "")))

    def repeats(n: Column) -> Column:
        return (n >= 15) & (F.size(F.array_distinct(words)) <= 3)

    def boilerplate(n: Column) -> Column:
        def phrase_words(low: Column) -> Column:
            return reduce(add, ((F.length(low) - F.length(F.replace(low, F.lit(x)))) / len(x) * len(x.split())
                                for x in BOILERPLATE))

        return let(F.lower(line), lambda low: reduce(or_, (low.contains(x) for x in BOILERPLATE)) & (
            (n <= SHORT_LINE) | (phrase_words(low) * 5 >= n)))

    return let(F.size(words), lambda n: ((n >= 5) & (
        shouted() | many_symbols(n) | menu(n) | repeats(n))) | punctuation(n) | boilerplate(n))


def in_vertical_menu(entries: Column, lines: int = MENU_LINES) -> Column:
    """For flags of short lines without a sentence end (an array): which of them
    stand in a run of at least ``lines``."""
    def begins(e: Column, i: Column) -> Column:
        return reduce(lambda a, b: a & b, (F.coalesce(F.get(e, i + k), F.lit(False)) for k in range(lines)))

    def near(first: Column) -> Column:
        return F.transform(first, lambda x, i: reduce(or_, (
            F.coalesce(F.get(first, i - k), F.lit(False)) for k in range(lines))))

    none = F.transform(entries, lambda x: F.lit(False))
    return F.when(F.size(F.filter(entries, lambda x: x)) < lines, none).otherwise(
        let(F.transform(entries, lambda x, i: begins(entries, i)), near))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_lost: float = 0.3, min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """One row per input row: doc_id, counts, base_failed, n_lost_words,
    kept, and clean_text (the lines that passed, joined by ``\\n``)."""
    # a line end is white space, so the words of the text are those of its lines
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.struct(
        x.alias("line"), word_list(x).alias("words"))), lambda e: F.size(e["words"]) > 0)

    def judged(parts: Column, words: Column) -> Column:
        entries = F.transform(parts, lambda e: (F.size(e["words"]) <= ENTRY_WORDS) & ~e["line"].rlike(SENTENCE_END))
        marks = let(let(entries, in_vertical_menu), lambda menu: F.transform(parts, lambda e, i: F.struct(
            e["line"].alias("line"), F.size(e["words"]).alias("n"),
            (F.get(menu, i) | line_fails(e["line"], e["words"])).alias("fails"))))
        return let(marks, lambda m: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.size(parts) - F.size(F.array_distinct(F.transform(parts, lambda e: e["line"])))
             ).cast("long").alias("n_dup_lines"),
            repeated_window_words(words).alias("n_repeat_words"),
            F.aggregate(m, F.lit(0).cast("long"),
                        lambda a, e: a + F.when(e["fails"], e["n"]).otherwise(0)).alias("n_lost_words"),
            F.array_join(F.transform(F.filter(m, lambda e: ~e["fails"]), lambda e: e["line"]), "\n"
                         ).alias("clean_text")))

    found = let(lines, lambda parts: let(F.flatten(F.transform(parts, lambda e: e["words"])),
                                         lambda words: judged(parts, words)))
    out = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.length(only(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"), found.alias("r"))
    base_failed = (F.col("r.n_words") < min_words) | (
        100 * F.col("r.n_repeat_words") > max_repeat_pct * F.col("r.n_words"))
    return out.select(
        "doc_id", "r.n_words", "r.word_chars", "n_symbols", "r.n_dup_lines", "r.n_repeat_words",
        base_failed.alias("base_failed"), "r.n_lost_words", "r.clean_text",
        (~base_failed & (F.col("r.n_lost_words") <= max_lost * F.col("r.n_words"))).alias("kept"))
