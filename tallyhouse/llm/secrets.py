"""Secret scan whose false positives a random forest removes.

Candidates are long tokens that mix letters and digits, and values that are
assigned to something.  Each is described by its length, its character
transitions (changes between character classes, letter pairs as in words,
distinct characters), how much of it dictionary words cover, whether it looks
like a path, and the words beside it.  A random forest trained on labelled
findings votes; a candidate with at least ``min_votes`` of the trees is a
secret and is redacted.

The labelled findings are written out by rule (see ``labelled_findings``), so
their number is bounded.  The trained trees become one DataFrame expression,
so scanning is a single pass with no join or shuffle, and no Python.

Defined cases: a null or empty text has no candidates; candidates that begin
at the same place are one, the longer; repeated rows are scanned each; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import id_and_text, let, read_trees
from tallyhouse.llm.pii import matches

# a token may follow "=" (KEY=value), and takes it along as padding at its end only
TOKEN = (r"(?<![A-Za-z0-9_+/-])(?:[A-Za-z0-9_+/-]{16,}+(?:={1,2}(?![A-Za-z0-9_+/=-]))?+"
         r"|[A-Za-z0-9_+/-]{15}={1,2}(?![A-Za-z0-9_+/=-])|[A-Za-z0-9_+/-]{14}==(?![A-Za-z0-9_+/=-]))")
ASSIGNED = "(?<=[=:] {0,2}[\"']{0,1})[^\\s\"'=:,;<>|]{8,}+"
NEXT_PARAMETER = "&(?=(?:amp;)?[A-Za-z0-9_.%-]{1,64}=)"
BESIDE = 48

# fixed values: words that name a secret, words that name something harmless,
# and words that placeholders and identifiers are made of
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "credential", "apikey", "api_key",
                "api-key", "access_key", "private_key", "auth", "bearer")
HARMLESS_WORDS = ("commit", "sha1", "sha256", "md5", "checksum", "digest", "etag", "revision", "uuid",
                  "guid", "hash", "fingerprint", "build", "order", "invoice", "path", "file", "url", "http")
DICTIONARY = ("access", "account", "admin", "apikey", "auth", "change", "client", "code", "config",
              "content", "customer", "data", "default", "document", "dummy", "enter", "example", "fake",
              "file", "function", "get", "handler", "here", "image", "index", "insert", "item", "key",
              "library", "list", "local", "main", "manager", "module", "name", "number", "object",
              "package", "password", "path", "placeholder", "public", "redacted", "request", "response",
              "sample", "secret", "server", "service", "session", "set", "site", "static", "string",
              "system", "table", "test", "token", "type", "user", "usr", "value", "version", "view", "your")


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(F.length(whole), F.lit(1))


def _kept(value: Column, inside: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{inside}]+", ""))


def _count(value: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)))


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return F.greatest(*[text.contains(w).cast("double") for w in words])


def features(value: Column, before: Column, after: Column) -> dict[str, Column]:
    """The forest's inputs, by name (all double)."""
    low, near = F.lower(value), F.lower(before)
    last = F.lower(F.regexp_extract(before, r"([\p{L}\p{N}_-]+)[^\p{L}\p{N}]*$", 1))
    found = {
        "length": F.length(value),
        "class_changes": _share(_count(value, "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]"), value),
        "word_pairs": _share(_count(low, "[aeiou][bcdfghklmnprstvwy]|[bcdfghklmnprstvwy][aeiou]") * 2, value),
        "distinct": _share(F.size(F.array_distinct(F.split(value, ""))), value),
        "digits": _share(_kept(value, "0-9"), value),
        "capitals": _share(_kept(value, "A-Z"), value),
        "hex": value.rlike("^[0-9a-f]+$|^[0-9A-F]+$").cast("double"),
        "dictionary": 1 - _share(F.length(F.regexp_replace(low, "|".join(
            sorted(DICTIONARY, key=lambda w: (-len(w), w))), "")), value),
        "slashes": _share(_count(value, "[/.]"), value),
        "separators": _share(_count(value, "[_-]"), value),
        "under_path": before.rlike("[/\\\\.]$").cast("double"),
        "assigned": before.rlike("[=:]\\s*[\"']?$").cast("double"),
        "quoted": (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double"),
        "secret_beside": _any(last, SECRET_WORDS),
        "secret_near": _any(near, SECRET_WORDS),
        "harmless_beside": _any(last, HARMLESS_WORDS),
        "harmless_near": _any(near, HARMLESS_WORDS),
        "issued": value.rlike("^(?:AKIA|ASIA|ghp_|gho_|sk_live_|xox[abp]-|glpat-|AIza)").cast("double"),
    }
    return {k: v.cast("double") for k, v in found.items()}


def labelled_findings(spark: SparkSession, per_kind: int = 60) -> DataFrame:
    """``per_kind`` findings (value, before, after, label) of each kind, by rule."""
    r = F.sha2(F.concat_ws(":", "kind", "id"), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(F.concat(r, r))), "=+$", "")
    size = F.element_at(F.array(*map(F.lit, (20, 24, 32, 40, 40, 64))), (F.col("id") % 6 + 1).cast("int"))

    def pick(words: tuple[str, ...], salt: int) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(
            len(words))) + 1).cast("int"))

    def words(n: int, sep: str) -> Column:
        return F.concat_ws(sep, *[pick(DICTIONARY, 10 + i) for i in range(n)])

    key = F.concat(pick(("the ", "my ", "", "in config "), 1), pick(SECRET_WORDS, 2))
    eq = pick((' = "', ': "', "=", ": ", " = '"), 3)
    close = F.when(F.col("id") % 2 == 0, '"').otherwise(" ")
    plain = pick(("see ", "of ", "and ", "from the ", "id ", "at "), 4)
    uuid = F.concat_ws("-", *[F.substring(r, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    hexes, mixed = F.substring(r, F.lit(1), size), F.substring(b64, F.lit(1), size)
    issued = F.concat(pick(("AKIA", "ghp_", "sk_live_", "xoxb-", "glpat-", "AIza"), 5), F.substring(b64, 1, 24))
    digits = F.substring(F.regexp_replace(F.concat(r, r), "[^0-9]", ""), 1, 20)
    kinds = [
        (key, eq, hexes, 1), (key, eq, mixed, 1), (key, eq, F.upper(hexes), 1),
        (plain, F.lit(""), issued, 1), (key, eq, issued, 1), (key, F.lit(" "), mixed, 1),
        (pick(HARMLESS_WORDS, 6), eq, hexes, 0), (pick(HARMLESS_WORDS, 6), F.lit(" "), hexes, 0),
        (plain, F.lit(""), uuid, 0), (pick(("uuid", "id", "guid"), 7), eq, uuid, 0),
        (key, eq, words(3, "_"), 0), (key, eq, F.repeat(pick(("x", "0", "*", "a"), 8), 20), 0),
        (plain, F.lit("/"), words(4, "/"), 0), (plain, F.lit(""), F.concat(words(3, "_"), F.substring(r, 1, 2)), 0),
        (plain, F.lit(""), digits, 0), (pick(HARMLESS_WORDS, 6), F.lit("://"), F.concat(words(3, "/"), F.lit("1")), 0),
        (key, eq, F.concat(F.lit("your-"), words(2, "-"), F.lit("-here1")), 0),
        (plain, F.lit(""), F.concat(words(2, "-"), F.lit("-2024-01-31")), 0),
    ]
    rows = spark.range(0, per_kind, 1, 1)
    parts = [rows.withColumn("kind", F.lit(i)).select(
        "kind", "id", value.alias("value"), F.concat(before, sep).alias("before"), close.alias("after"),
        F.lit(float(label)).alias("label")) for i, (before, sep, value, label) in enumerate(kinds)]
    return reduce(DataFrame.unionAll, parts).coalesce(1)


def train(findings: DataFrame, trees: int = 25, depth: int = 6, seed: int = 11) -> list[list]:
    """Trees as nested [feature, threshold, left, right] with votes as leaves."""
    inputs = features(F.col("value"), F.col("before"), F.col("after"))
    rows = findings.select("label", *[v.alias(k) for k, v in inputs.items()])
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    model = forest.fit(VectorAssembler(inputCols=list(inputs), outputCol="features").transform(rows))
    return read_trees(model.toDebugString, list(inputs))


def votes(trees: list[list], inputs: Column) -> Column:
    """The share of trees that vote for a secret.  ``let`` keeps the nested
    branches out of generated code, which they would make too large."""
    def vote(tree: list | float, x: Column) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        name, threshold, left, right = tree
        return F.when(x[name] <= threshold, vote(left, x)).otherwise(vote(right, x))
    return let(inputs, lambda x: reduce(add, (vote(t, x) for t in trees)) / len(trees))


def candidates(text: Column) -> Column:
    """Start and end of every candidate, by start; of those that begin at the
    same place the longest, and none that lies inside an earlier one."""
    spans = "array<struct<start:int,end:int>>"
    mixed = F.filter(matches(text, TOKEN), lambda s: F.substring(
        text, s["start"] + 1, s["end"] - s["start"]).rlike("[0-9][^0-9]|[^0-9][0-9]"))
    token = F.when(text.rlike(TOKEN), mixed).otherwise(F.array().cast(spans))
    # in a query string the next parameter ends the value; one character for another keeps the places
    plain = F.when(text.contains("&"), F.regexp_replace(text, NEXT_PARAMETER, " ")).otherwise(text)
    value = F.when(text.rlike("[=:]"), let(plain, lambda t: matches(t, ASSIGNED))).otherwise(F.array().cast(spans))

    def outer(all_spans: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))
        return F.aggregate(all_spans, zero, lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
            s["end"].alias("at"), F.concat(a["out"], F.array(F.struct(
                s["start"].alias("start"), s["end"].alias("end")))).alias("out"))), lambda a: a["out"])

    ordered = F.array_sort(F.concat(token, value), lambda a, b: F.when(
        a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(b["end"] - a["end"]))
    return let(ordered, outer)


def redacted(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(secrets, zero, lambda a, s: F.struct(s["end"].alias("at"), F.concat(
        a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_votes: float = 0.5,
                 trees: list[list] | None = None) -> DataFrame:
    """All input columns but the id and text under other names are dropped:
    doc_id, found (start, end, votes of every candidate), secrets (those with
    enough votes), redacted_text."""
    trees = trees or train(labelled_findings(docs.sparkSession))
    text = F.col("text")

    def judged(s: Column) -> Column:
        at = F.greatest(s["start"] - BESIDE, F.lit(0))
        parts = features(F.substring(text, s["start"] + 1, s["end"] - s["start"]),
                         F.substring(text, at + 1, s["start"] - at), F.substring(text, s["end"] + 1, F.lit(8)))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), votes(
            trees, F.struct(*[v.alias(k) for k, v in parts.items()])).alias("votes"))

    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.transform(candidates(text), judged).alias("found"))
    secrets = F.filter("found", lambda s: s["votes"] >= min_votes)
    return rows.select("doc_id", "text", "found", secrets.alias("secrets")).select(
        "doc_id", "found", "secrets", F.when(F.size("secrets") > 0, redacted(text, F.col("secrets")))
        .otherwise(text).alias("redacted_text"))
