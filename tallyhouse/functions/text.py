"""Text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# fixed value: texts are compared without regard to case and trailing blanks;
# accents count
COLLATION = "UTF8_LCASE_RTRIM"


def folded(x) -> Column:
    """The text under the warehouse's collation: for comparing, joining and grouping."""
    return F.collate(_c(x), COLLATION)


def same_text(a, b) -> Column:
    return folded(a) == folded(b)


def clean_trim(x) -> Column:
    """Strip leading/trailing blanks only (tabs and newlines are kept)."""
    return F.trim(_c(x))


def concat_blank(*parts, sep: str = " ") -> Column:
    """Concatenate with NULL treated as the empty string."""
    cols = [F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]
    out = cols[0]
    for c in cols[1:]:
        out = F.concat(out, F.lit(sep), c)
    return out


def classify_contains(x, patterns: list[tuple[str, str]], otherwise: str | None) -> Column:
    """First (substring -> label) whose substring occurs, case-insensitively.

    ``patterns`` is in priority order.  Lower-casing both sides keeps the
    test portable (accents stay significant).
    """
    low = F.lower(_c(x))
    expr = None
    for sub, label in patterns:
        cond = low.contains(sub.lower())
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr


def map_values(x, mapping: dict[str, str], passthrough: bool = True) -> Column:
    """Simple CASE as a value map (case and trailing blanks do not matter);
    unmapped values pass through (or NULL)."""
    src = _c(x)
    if not mapping:
        return src if passthrough else F.lit(None).cast("string")
    key = folded(src)
    expr = reduce(lambda acc, kv: acc.when(key == F.lit(kv[0]), F.lit(kv[1])),
                  list(mapping.items())[1:],
                  F.when(key == F.lit(next(iter(mapping))), F.lit(next(iter(mapping.values())))))
    return expr.otherwise(src if passthrough else F.lit(None).cast("string"))
