"""Small helpers shared by the column-expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(c) -> Column:
    """Accept a column name or a ``Column``."""
    return F.col(c) if isinstance(c, str) else c


def bound(value, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once a row, however often ``fn`` refers to it: Spark
    shares no expression across conditional branches, so each mention there computes it again."""
    return F.get(F.transform(F.array(to_col(value)), lambda x: fn(x)), F.lit(0))


def typed_null(data_type) -> Column:
    """A NULL literal with a concrete type (an untyped ``VOID`` null never
    matches under ``<=>``)."""
    return F.lit(None).cast(data_type)
