"""Personal data: fixed patterns, and terms that reveal them.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers.
They are the protected entities.  Which other terms give an entity away is
estimated from the corpus, after the information-theoretic model: the
disclosure of entity e by term t is their pointwise mutual information
log2(p(e,t) / (p(e) p(t))), and t exceeds the threshold if that is at least
``alpha`` times the information content -log2 p(e) of the entity itself.  All
three probabilities count documents, over all documents: those with the
entity, with the term, with both anywhere in them.  ``min_documents`` is the
evidence asked for: an estimate from fewer shared documents is none (in one
document alone, each word that is found nowhere else would reveal everything).
A term is a run of three or more letters or digits, compared in lower case; a
run inside a match of a pattern is part of the entity and no term.

Terms that exceed the threshold for an entity are spans of kind ``term``,
wherever they stand in a document with that entity.  In the sanitised text a
pattern gives way to its kind, a term with a digit is generalised to NUMBER, a
capitalised one to NAME, and others are removed.

DataFrame functions only.  Counting pairs: as both together are at most the
documents with e, a term in more than N^(1-alpha) * df(e)^alpha documents can
not reach the threshold and meets e nowhere; entities that stand in the same
documents are one class, and so are terms, and only classes are paired.  All
counts are partial before they are shuffled, and what is gathered by row is
the terms and spans of one text.

Defined cases: a null or empty text has no spans; matches that fail their
check are dropped and not searched again; kinds may overlap; repeated rows are
documents of their own, each searched and counted; an entity in every document
has no content and nothing reveals it; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_and_text, let
from tallyhouse.operators.keys import pin

KINDS = ("email", "ip", "card", "phone")
TERM = r"[\p{L}\p{N}]{3,}"
_M, _OTHER = "\ue000", "\ue001"  # stands for an inner dot or separator, one for one
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_SPANS = "array<struct<start:int,end:int,kind:int>>"
_BLOCK = 128  # terms that are searched for spans together


def matches(text: Column, pattern: str) -> Column:
    """Start and end (code points, end exclusive) of the matches, from the
    lengths of the matches and of what lies between them."""
    def walk(found: Column, gaps: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

        def step(acc: Column, pair: Column) -> Column:
            start = acc["at"] + F.length(pair["gap"])
            return F.struct((start + F.length(pair["hit"])).alias("at"), F.concat(acc["out"], F.array(
                F.struct(start.alias("start"), (start + F.length(pair["hit"])).alias("end")))).alias("out"))

        pairs = F.transform(found, lambda hit, i: F.struct(hit.alias("hit"), F.get(gaps, i).alias("gap")))
        return F.aggregate(pairs, zero, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:int,end:int>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda gaps: walk(found, gaps))))


def _part(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check sum that doubles every second one from the right."""
    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, 1).cast("int")
        return F.when(i % 2 == 0, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def base_spans(text: Column) -> Column:
    """All valid pattern matches, by start and then kind.

    Java repeats a group by recursion, so the dots inside a domain and the
    separators inside a number are first replaced one for one by a mark; then
    a plain character class describes the whole run, however long it is."""
    plain = F.when(text.contains(_M), F.replace(text, F.lit(_M), F.lit(_OTHER))).otherwise(text)
    none = F.array().cast("array<struct<start:int,end:int>>")

    def email() -> Column:
        dots = F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _M)
        local = f"A-Za-z0-9._%+{_M}-"
        pattern = rf"(?:\G|(?<![{local}]))[{local}]++@[A-Za-z0-9-]++{_M}[A-Za-z0-9{_M}-]*+"
        return F.when(text.contains("@"), let(dots, lambda t: matches(t, pattern))).otherwise(none)

    def ip() -> Column:
        found = matches(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
        return F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(found, lambda s: _part(text, s).rlike(
            rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))).otherwise(none)

    def card() -> Column:
        joined = F.regexp_replace(plain, "(?<=[0-9])[ -](?=[0-9])", _M)
        pattern = f"(?<![0-9{_M}])[0-9][0-9{_M}]{{13,36}}(?![0-9{_M}])"

        def valid(s: Column) -> Column:
            return let(_digits(_part(text, s)), lambda d: F.length(d).between(14, 19) & luhn(d))

        return F.when(text.rlike("[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
                      F.filter(let(joined, lambda t: matches(t, pattern)), valid)).otherwise(none)

    def phone() -> Column:
        found = matches(text, r"\+[0-9][\x20().0-9-]+[0-9]")
        return F.when(text.rlike(r"\+[0-9]"), F.filter(
            found, lambda s: F.length(_digits(_part(text, s))).between(10, 15))).otherwise(none)

    def of_kind(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    kinds = [of_kind(f(), k) for k, f in enumerate((email, ip, card, phone))]
    return F.sort_array(F.concat(*kinds)).cast(_SPANS)


def _replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """The text with each span replaced by its label (overlaps become one)."""
    def step(acc: Column, s: Column) -> Column:
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(
            F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), label(s))).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(spans, zero, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced by what it is generalised to."""
    def label(s: Column) -> Column:
        word = _part(text, s)
        return reduce(lambda rest, k: F.when(s["kind"] == k, F.lit(f"[{KINDS[k].upper()}]")).otherwise(rest),
                      range(len(KINDS)), F.when(word.rlike("[0-9]"), F.lit("[NUMBER]")).when(
                          word.rlike(r"^\p{Lu}"), F.lit("[NAME]")).otherwise(F.lit("")))

    return _replaced(text, spans, label)


def _masked(text: Column, spans: Column) -> Column:
    """The text with spaces in place of its spans, at unchanged positions."""
    return F.when(F.size(spans) == 0, text).otherwise(_replaced(
        text, spans, lambda s: F.repeat(F.lit(" "), s["end"] - s["start"])))


def _hashed(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), _hashed))


def _term_spans(text: Column, wanted: Column) -> Column:
    """The spans of the terms whose hash is wanted, found block by block: a
    list that grows by one in each step is copied each time, so it is kept short."""
    def in_block(words: Column, gaps: Column, start: Column) -> Column:
        def step(acc: Column, pair: Column) -> Column:
            left = acc["at"] + F.length(pair["gap"])
            right = left + F.length(pair["word"])
            return F.struct(right.alias("at"), F.when(
                F.array_contains(wanted, _hashed(pair["word"])), F.concat(acc["out"], F.array(F.struct(
                    left.alias("start"), right.alias("end"), F.lit(len(KINDS)).alias("kind"))))
            ).otherwise(acc["out"]).alias("out"))

        zero = F.struct(start.alias("at"), F.array().cast(_SPANS).alias("out"))
        pairs = F.zip_with(words, gaps, lambda w, g: F.struct(w.alias("word"), g.alias("gap")))
        return F.aggregate(pairs, zero, step, lambda acc: acc["out"])

    def walk(words: Column, gaps: Column) -> Column:
        def block(of: Column, i: Column) -> Column:
            return F.slice(of, i * _BLOCK + 1, F.least(F.lit(_BLOCK), F.size(words) - i * _BLOCK))

        def length(i: Column) -> Column:
            joined = F.concat(block(words, i), block(gaps, i))
            return F.aggregate(joined, F.lit(0), lambda a, x: a + F.length(x))

        numbers = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / _BLOCK).cast("int"))
        starts = F.aggregate(F.transform(numbers, length), F.array(F.lit(0)),
                             lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return let(starts, lambda at: F.flatten(F.transform(
            numbers, lambda i: in_block(block(words, i), block(gaps, i), F.get(at, i)))))

    return let(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda words: F.when(
        F.size(words) == 0, F.array().cast(_SPANS)).otherwise(
        let(F.split(text, TERM, -1), lambda gaps: walk(words, gaps))))


def _revealing_terms(found: DataFrame, docs: DataFrame, alpha: float, min_documents: int) -> DataFrame | None:
    """The terms of each row that exceed the threshold for an entity of it:
    row, wanted (hashes).  None where no entity has evidence enough."""
    where = F.bit_xor(F.xxhash64("row"))  # with a count: the same for the same set of rows
    mentions = found.select("row", F.explode("entities").alias("entity"))
    entities = (mentions.groupBy("entity").agg(F.count("*").alias("e_df"), where.alias("rows"))
                .filter(F.col("e_df") >= min_documents)
                .select("entity", "e_df", F.xxhash64("e_df", "rows").alias("e_class")))
    held = pin(mentions.join(entities, "entity").select("row", "e_class", "e_df").distinct(), "held")
    top = held.agg(F.max("e_df")).first()[0]
    if top is None:
        return None
    total = float(found.count())

    def reach(e_df: Column) -> Column:
        return F.lit(total ** (1 - alpha) * (1 + 1e-9)) * F.pow(e_df.cast("double"), F.lit(alpha))

    said = (found.join(held.select("row").distinct(), "row", "left_semi")
            .select("row", F.explode("terms").alias("term")))
    beside = (said.groupBy("term").agg(F.count("*").alias("m_df"), where.alias("rows"))
              .filter((F.col("m_df") >= min_documents) & (F.col("m_df") <= reach(F.lit(top)))))
    everywhere = (docs.select(F.explode(_terms(F.col("text"))).alias("term"), F.lit(1).alias("n"))
                  .unionAll(found.select(F.explode("inside").alias("term"), F.lit(-1).alias("n")))
                  .groupBy("term").agg(F.sum("n").alias("t_df"))
                  .filter((F.col("t_df") >= min_documents) & (F.col("t_df") <= reach(F.lit(top)))))
    candidates = pin(beside.join(everywhere, "term").select(
        "term", "t_df", F.xxhash64("t_df", "m_df", "rows").alias("t_class")), "candidates")
    spoken = pin(said.join(candidates, "term").select("row", "term", "t_class", "t_df"), "spoken")
    met = (held.join(spoken.select("row", "t_class", "t_df").distinct(), "row")
           .filter(F.col("t_df") <= reach(F.col("e_df"))))
    content = -F.log2(F.col("e_df") / total)
    revealing = pin(
        met.groupBy("e_class", "t_class", "e_df", "t_df").agg(F.count("*").alias("together"))
        .filter((F.col("together") >= min_documents) & (F.col("e_df") < total) & (
            F.log2(F.col("together") * total / F.col("e_df") / F.col("t_df")) >= alpha * content))
        .select("e_class", "t_class"), "revealing")
    classes = met.join(revealing, ["e_class", "t_class"], "left_semi").select("row", "t_class").distinct()
    return spoken.join(classes, ["row", "t_class"], "left_semi").groupBy("row").agg(
        F.collect_set("term").alias("wanted"))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.75,
                       min_documents: int = 3) -> DataFrame:
    """One row per input row: doc_id, base and spans (arrays of start, end,
    kind; kind ``len(KINDS)`` is a term), sanitised_text (null: unchanged)."""
    docs = id_and_text(docs, id_col, text_col)
    rows = docs.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    hit = F.size("base") > 0
    entity = F.transform("base", lambda s: F.xxhash64(s["kind"], F.lower(_part(F.col("text"), s))))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", *[
        F.when(hit, value).alias(name) for name, value in (
            ("text", F.col("text")), ("entities", F.array_distinct(entity)),
            ("terms", _terms(_masked(F.col("text"), F.col("base")))))])
    found = pin(rows.withColumn("inside", F.when(F.col("text").isNotNull(), F.array_except(
        _terms(F.col("text")), "terms"))), "mentions")
    wanted = _revealing_terms(found, docs, alpha, min_documents)
    if wanted is None:
        marked = found.withColumn("spans", F.col("base"))
    else:
        marked = found.join(wanted, "row", "left").withColumn("spans", F.when(
            F.col("wanted").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", _term_spans(
                _masked(F.col("text"), F.col("base")), F.col("wanted"))))))
    return marked.select("doc_id", "base", "spans", F.when(
        F.size("spans") > 0, sanitised(F.col("text"), F.col("spans"))).alias("sanitised_text"))


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*[F.lit(x) for x in (*KINDS, "term")])
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
