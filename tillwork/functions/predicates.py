"""Row predicates as ``Column`` expressions (null-safe: a null input is false)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.util import to_col

# Unicode-aware surrounding whitespace (Python's ``str.strip`` strips every
# Unicode space, Spark's ``trim`` only ASCII blanks).
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def is_one_of(col, values: Iterable[str]) -> Column:
    """F1 – ``isin`` with null → false."""
    return F.coalesce(to_col(col).isin(list(values)), F.lit(False))


def contains_text(col, text: str, ignore_case: bool = True, unicode: bool = False) -> Column:
    """F2/F3 – literal substring test; null → false.  ``unicode`` compares by collation, so
    that composed and decomposed accents are equal."""
    c = to_col(col).cast("string")
    if unicode:
        name = "UNICODE_CI" if ignore_case else "UNICODE"
        hit = F.contains(F.collate(c, name), F.collate(F.lit(text), name))
    elif ignore_case:
        hit = F.contains(F.lower(c), F.lit(text.lower()))
    else:
        hit = F.contains(c, F.lit(text))
    return F.coalesce(hit, F.lit(False))


def contains_any(col, texts: Iterable[str] | str, ignore_case: bool = True) -> Column:
    """F4 – regex alternation contains.

    ``texts`` is either a list of literals (escaped and joined by ``|``) or
    one regular expression."""
    if isinstance(texts, str):
        pattern = texts
    else:
        pattern = "|".join(re.escape(t) for t in texts)
    if ignore_case:
        pattern = "(?i)" + pattern
    return F.coalesce(to_col(col).cast("string").rlike(pattern), F.lit(False))


def not_contains(col, text: str, ignore_case: bool = False) -> Column:
    """F3 negated with null kept (``~str.contains(..., na=False)``)."""
    return ~contains_text(col, text, ignore_case)


def is_empty(col) -> Column:
    """F6 – null, or blank after stripping Unicode whitespace."""
    c = to_col(col)
    stripped = F.regexp_replace(c.cast("string"), _EDGE_SPACE, "")
    return c.isNull() | (stripped == F.lit(""))


def is_positive(col) -> Column:
    return F.coalesce(to_col(col) > 0, F.lit(False))


def is_negative(col) -> Column:
    return F.coalesce(to_col(col) < 0, F.lit(False))
