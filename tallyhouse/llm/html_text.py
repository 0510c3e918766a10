"""Main text of web pages from flat text blocks.

A page is cut into blocks of text at block-level tags.  Each block is
described by its word count and link density, those of the blocks before and
after it, and what encloses it (page furniture, an article, a heading).  A
decision tree trained on the small labelled table below says which blocks are
main text; these are joined in page order.

Every page is handled by itself, in one pass, with no shuffle.

Defined cases: a null or empty page has no text; a page cut off inside a tag
or comment loses that tag only; unclosed elements end with the element around
them; character references are decoded as browsers do, unknown ones stay;
class names count as furniture only as whole names or with parts that say where;
an article inside comments, a sidebar or a menu is part of them; pages without
any main block give an empty text; repeated rows are extracted
each; columns other than the three named are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import read_trees

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "furniture", "article", "heading", "sentence")

# fixed values: labelled blocks (the features in the order above, then 1 for main text)
LABELLED = (
    # menus, headers, footers, sidebars, notices, adverts, forms, comments
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0, 0), (9, 0.0, 2, 1.0, 12, 0.0, 1, 0, 0, 1, 0),
    (14, 0.0, 80, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (40, 0.1, 60, 0.0, 0, 0.0, 1, 0, 0, 1, 0),
    (3, 0.0, 70, 0.0, 60, 0.0, 1, 0, 0, 1, 0), (30, 0.0, 60, 0.0, 0, 0.0, 1, 0, 0, 0, 0),
    (12, 0.0, 40, 0.0, 30, 0.0, 1, 0, 0, 1, 0), (80, 0.0, 70, 0.0, 40, 0.1, 1, 0, 0, 1, 0),
    (25, 0.0, 1, 1.0, 70, 0.0, 1, 0, 0, 1, 0), (60, 0.0, 30, 0.0, 20, 0.0, 1, 0, 0, 1, 0),
    (35, 0.0, 50, 0.0, 35, 0.0, 1, 1, 0, 1, 0), (6, 0.0, 90, 0.0, 80, 0.0, 1, 1, 0, 1, 0),
    (4, 0.0, 1, 1.0, 30, 0.0, 1, 0, 1, 0, 0), (3, 0.0, 60, 0.0, 20, 0.0, 1, 1, 1, 0, 0),
    (18, 0.0, 0, 0.0, 3, 1.0, 1, 0, 0, 1, 0), (8, 0.4, 40, 0.0, 0, 0.0, 1, 0, 0, 0, 0),
    # the same without an element that names them
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0),
    (3, 1.0, 1, 1.0, 8, 0.0, 0, 0, 0, 0, 0), (5, 0.8, 4, 0.9, 5, 0.8, 0, 0, 0, 0, 0),
    (2, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0, 0), (4, 0.0, 70, 0.0, 1, 1.0, 0, 0, 0, 0, 0),
    (6, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (12, 0.9, 30, 0.0, 10, 0.9, 0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 40, 0.0, 0, 0, 0, 0, 0), (2, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (4, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 0, 0),
    (3, 0.0, 2, 0.5, 3, 0.6, 0, 0, 0, 0, 0), (9, 0.5, 60, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    # links inside an article
    (4, 1.0, 60, 0.0, 3, 1.0, 0, 1, 0, 0, 0), (3, 1.0, 4, 1.0, 0, 0.0, 0, 1, 0, 0, 0),
    (10, 0.9, 80, 0.0, 9, 0.9, 0, 1, 0, 0, 0), (2, 1.0, 30, 0.0, 40, 0.0, 0, 1, 0, 0, 0),
    # main text in an article, short blocks too
    (90, 0.0, 9, 0.0, 70, 0.0, 0, 1, 0, 1, 1), (60, 0.1, 90, 0.0, 40, 0.0, 0, 1, 0, 1, 1),
    (2, 0.0, 60, 0.0, 50, 0.0, 0, 1, 0, 1, 1), (1, 0.0, 40, 0.0, 30, 0.0, 0, 1, 0, 1, 1),
    (5, 0.0, 60, 0.0, 12, 0.0, 0, 1, 0, 1, 1), (30, 0.3, 60, 0.0, 50, 0.1, 0, 1, 0, 1, 1),
    (11, 0.0, 20, 0.0, 70, 0.0, 0, 1, 1, 0, 1), (4, 0.0, 60, 0.0, 80, 0.0, 0, 1, 1, 0, 1),
    (60, 0.0, 0, 0.0, 50, 0.0, 0, 1, 0, 1, 1), (12, 0.0, 0, 0.0, 60, 0.0, 0, 1, 1, 0, 1),
    (7, 0.0, 0, 0.0, 9, 0.0, 0, 1, 0, 0, 1), (40, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 1, 1),
    (50, 0.0, 60, 0.0, 40, 0.0, 0, 1, 0, 0, 1), (20, 0.0, 30, 0.0, 2, 0.0, 0, 1, 0, 0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 0, 1), (3, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0, 0, 1),
    (1, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 1), (9, 0.1, 40, 0.0, 20, 0.2, 0, 1, 0, 0, 1),
    (3, 0.0, 5, 0.0, 14, 0.0, 0, 1, 0, 0, 1), (7, 0.0, 90, 0.0, 10, 0.0, 0, 1, 0, 0, 1),
    (1, 0.0, 1, 1.0, 0, 0.0, 0, 1, 0, 1, 1), (12, 0.0, 2, 1.0, 60, 0.0, 0, 1, 1, 1, 1),
    # main text without an element that names it
    (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 1), (60, 0.0, 0, 0.0, 50, 0.0, 0, 0, 0, 1, 1),
    (8, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1, 0, 1), (6, 0.0, 0, 0.0, 70, 0.0, 0, 0, 1, 0, 1),
    (15, 0.0, 0, 0.0, 20, 0.0, 0, 0, 0, 1, 1), (22, 0.1, 0, 0.0, 5, 0.0, 0, 0, 0, 1, 1),
    (90, 0.0, 1, 1.0, 70, 0.0, 0, 0, 0, 1, 1), (45, 0.1, 60, 0.0, 80, 0.0, 0, 0, 0, 1, 1),
    (25, 0.0, 30, 0.0, 3, 1.0, 0, 0, 0, 1, 1), (14, 0.0, 70, 0.0, 60, 0.0, 0, 0, 0, 1, 1),
    (8, 0.0, 50, 0.0, 40, 0.0, 0, 0, 0, 1, 1), (9, 0.0, 2, 1.0, 80, 0.0, 0, 0, 1, 0, 1),
    (4, 0.0, 60, 0.0, 70, 0.0, 0, 0, 0, 1, 1), (70, 0.2, 40, 0.0, 0, 0.0, 0, 0, 0, 1, 1),
    (16, 0.0, 8, 0.0, 30, 0.1, 0, 0, 0, 1, 1), (5, 0.0, 30, 0.0, 45, 0.0, 0, 0, 1, 0, 1),
)
# fixed values: names of elements and of classes
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup "
    "option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style noscript template iframe svg math object audio video canvas".split())
RAW = frozenset("script style textarea title noscript iframe".split())
FURNITURE = frozenset("nav header footer aside form menu dialog head select button textarea fieldset".split())
# elements that may hold an article although they are furniture by themselves
WEAK = frozenset("form header fieldset".split())
# the page and its article keep their text whatever their class says
NEVER = frozenset("html body main article".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice notification pager pagination popup promo promoted promotion recommended related replies search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)|[^<]++|<", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_SENTENCE = re.compile(r"[.!?…。！？][\"'»”’)]*$")
# parts of compound names that say where a name belongs, not what it describes
_PLACES = frozenset("site page main top bottom left right global primary secondary post article js u c l is the "
                    "block box area section wrapper container inner list item content bar links".split())


def _named(value: str) -> bool:
    """Whether a class, id or role is the name of page furniture: the whole name, or
    a compound whose other parts only say where (``site-header``, ``comment-list``).
    ``no-sidebar``, ``page-with-header`` and ``market-share`` are other names."""
    for name in value.lower().split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        known = [p in FURNITURE_NAMES for p in parts]
        if any(known) and all(k or p in _PLACES for k, p in zip(known, parts)):
            return True
    return False


def _furniture(tag: str, attributes: str) -> int:
    """2 if an element is furniture by its tag, a name of its own, or hidden; 1 if
    by a tag that may hold an article; else 0."""
    if tag in FURNITURE - WEAK:
        return 2
    named = False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if (name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and _NONE.search(value)):
            return 2
        named |= name in ("class", "id", "role") and tag not in NEVER and _named(value)
    return 2 if named else int(tag in WEAK)


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Text, words, linked words, and whether furniture, article or a heading
    encloses it, for every block of a page with a word."""
    found: list[tuple[str, int, int, bool, bool, bool]] = []
    # open elements: name, furniture, article, heading, in a link, dropped
    top = ("", 0, False, False, False, False)
    stack, parts, state, at = [top], [], top, 0

    def close() -> None:
        if parts:
            # one reference may stand in two pieces only if a tag cuts it
            words = references.unescape("".join(t for t, _ in parts)).split()
            if words:
                linked = sum(len(references.unescape(t).split()) for t, link in parts if link)
                found.append((" ".join(words), len(words), min(linked, len(words)), bool(state[1]), state[2], state[3]))
            parts.clear()

    end = len(page)
    while at < end:
        m = _PIECE.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            text = m[0]
            if not state[5] and not (text[0] == "<" and len(text) > 1):
                parts.append((text, state[4]))
            continue
        tag, attributes = tag.lower(), m[3] or m[6] or ""
        if m[2] is None and not m[0].endswith(">"):
            break  # the page ends inside a tag
        if m[1] or m[4]:
            if tag in BLOCKS:
                close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            state = stack[-1]
            continue
        if tag in BLOCKS:
            close()
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        _, furniture, article, heading, link, dropped = state
        named = _furniture(tag, attributes)
        if tag in ("article", "main") and max(furniture, named) < 2:
            furniture, article, heading = 0, True, False  # inside comments or a sidebar it stays furniture
        elif tag == "header" and article and not furniture:
            named = 0 if named < 2 else named  # the heading of an article
        state = (tag, max(furniture, named), article, heading or tag in HEADINGS, link or tag == "a",
                 dropped or tag in DROPPED)
        stack.append(state)
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            text, at = page[at:stop.start() if stop else end], stop.start() if stop else end
            if not state[5]:
                parts.append((text, False))
    close()
    return found


def describe(found: list[tuple]) -> list[tuple]:
    """The tree's inputs for each block of a page."""
    sizes = [(0, 0.0), *[(n, linked / n) for _, n, linked, *_ in found], (0, 0.0)]
    return [(*sizes[i + 1], *sizes[i], *sizes[i + 2], float(b[3]), float(b[4]), float(b[5]),
             float(bool(_SENTENCE.search(b[0])))) for i, b in enumerate(found)]


def train(spark: SparkSession, labelled: tuple = LABELLED, depth: int = 6) -> list:
    rows = spark.createDataFrame([tuple(map(float, x)) for x in labelled], [*FEATURES, "label"]).coalesce(1)
    tree = DecisionTreeClassifier(maxDepth=depth, seed=5)
    model = tree.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    return read_trees(model.toDebugString, [str(i) for i in range(len(FEATURES))])[0]


def main_text(page: str | None, tree: list | float) -> str:
    found = blocks(page or "")
    kept = []
    for block, values in zip(found, describe(found)):
        node = tree
        while isinstance(node, list):
            node = node[2] if values[int(node[0])] <= node[1] else node[3]
        if node:
            kept.append(block[0])
    return " ".join(kept)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 tree: list | None = None) -> DataFrame:
    """One row per page: page_id, url, text."""
    tree = tree if tree is not None else train(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                yield pa.record_batch({
                    "page_id": part.column("page_id"), "url": part.column("url"),
                    "text": pa.array([main_text(x.as_py(), tree) for x in part.column("html")], pa.string())})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string")
