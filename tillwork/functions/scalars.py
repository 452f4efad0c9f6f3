"""String, number, date and conditional scalars as ``Column`` expressions.

All of them are built-in Spark expressions (whole-stage codegen), no UDFs.
ANSI mode stays on: every conversion of dirty text goes through ``try_cast``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.predicates import _EDGE_SPACE, is_empty
from tillwork.functions.util import bound, to_col

# --- fixed values of the reference job (must stay equal for equal results) ---
LOCAL_TZ = "Asia/Ho_Chi_Minh"
DATE_TEXT = "yyyy/MM/dd"
DATETIME_TEXT = "yyyy/MM/dd HH:mm:ss"
KIOSK_ACCOUNT = "iPOS-O2O"
DEFAULT_MEMBERSHIP = "Thành viên mặc định"
CUSTOMER_RETAIL = "Khách lẻ"
CUSTOMER_NEW = "Khách mới"
CUSTOMER_RETURNING = "Khách quay lại"
TOPPING_PRICES = [
    ("+ Topping Hạt đác", 15000.0),
    ("+ Topping Trân Châu Ô Long", 10000.0),
    ("+ Topping Trân Châu Trắng", 10000.0),
    ("+ Không lấy Topping", 0.0),
]
# -----------------------------------------------------------------------------


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# C1 / C3 --------------------------------------------------------------------
def epoch_ms_to_local(col_ms, tz: str = LOCAL_TZ) -> Column:
    """Epoch milliseconds → wall-clock ``TIMESTAMP_NTZ`` in ``tz``.

    Computed on NTZ values, so the result does not depend on the session
    time zone."""
    utc_wall = F.timestamp_add("MILLISECOND", to_col(col_ms).cast("bigint"), _epoch_ntz())
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def local_time_text(col_ms, tz: str = LOCAL_TZ, fmt: str = DATE_TEXT) -> Column:
    """C1 – epoch ms → local date/time text (``yyyy/MM/dd`` by default)."""
    return F.date_format(epoch_ms_to_local(col_ms, tz), fmt)


def parse_time(col, data_type: str) -> Column:
    """C3 – text or epoch-ms column → ``TIMESTAMP_NTZ``; unparsable → null.

    ``data_type`` is the column's simple type name (``df.schema[c].dataType
    .simpleString()``); the branch is chosen on the schema, as the original
    chose on the pandas dtype."""
    c = to_col(col)
    if data_type in ("string",):
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    if data_type in ("timestamp_ntz",):
        return c
    if data_type in ("timestamp",):
        return c.cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", c.cast("bigint"), _epoch_ntz())


# C2 -------------------------------------------------------------------------
def _whole_number(col) -> Column:
    """``int(float(x))``: text/float/int → truncated int; anything else → null."""
    as_double = to_col(col).cast("string").try_cast("double")
    return as_double.try_cast("int")


def time_of_day(hour, minute) -> Column:
    """C2 – hour + minute → ``HH:MM:00``; any unusable part → ``00:00:00``."""
    h, m = _whole_number(hour), _whole_number(minute)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return (F.when(h.isNull() | m.isNull(), F.lit("00:00:00"))
            .when(h.between(0, 99) & m.between(0, 99), F.concat(two(h), F.lit(":"), two(m), F.lit(":00")))
            .otherwise(F.format_string("%02d:%02d:00", h, m)))


# C4 -------------------------------------------------------------------------
def calendar_parts(ts) -> dict[str, Column]:
    """C4 – ``date`` dd/MM/yyyy, ``year``, ``month`` MM-yyyy and ISO ``week``
    WW-YYYY (ISO week-numbering year: 2024-12-30 → ``01-2025``)."""
    t = to_col(ts)
    week = F.concat(F.lpad(F.weekofyear(t).cast("string"), 2, "0"), F.lit("-"), F.extract(F.lit("YEAROFWEEK"), t).cast("string"))
    return {
        "date": F.date_format(t, "dd/MM/yyyy"),
        "year": F.year(t),
        "month": F.date_format(t, "MM-yyyy"),
        "week": F.when(t.isNotNull(), week),
    }


# C5 / C6 --------------------------------------------------------------------
def to_number(col, default: float | None = 0.0, truncate: bool = False) -> Column:
    """C5 – bad or missing → ``default``; ``truncate`` → whole number (toward 0).
    Only a plain decimal number counts: ``nan``, ``inf`` and suffixed forms such as
    ``1d`` are bad, and a truncated bad value is the default too."""
    text = strip(to_col(col).cast("string"))
    read = F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
    # the branch goes by the column's type, before any row: a number needs no text
    number = to_col(col).try_cast("double")
    c = F.when(F.typeof(to_col(col)).isin("double", "bigint", "int"), F.when(F.abs(number) < float("inf"), number)).otherwise(read)
    if truncate:
        c = c.try_cast("bigint")
    if default is not None:
        c = F.coalesce(c, F.lit(float(default)).cast("bigint" if truncate else "double"))
    return c


def signum(col) -> Column:
    return F.signum(to_col(col))


def absolute(col) -> Column:
    return F.abs(to_col(col))


# C7 / C8 / C14 --------------------------------------------------------------
def strip(col) -> Column:
    """Strip Unicode whitespace at both ends (Python ``str.strip``)."""
    # a long text is searched only if there is a space at one of its ends
    ends = lambda x: F.concat(F.substring(x, 1, 1), F.substring(x, -1, 1))
    return bound(to_col(col).cast("string"), lambda x: F.when(ends(x).rlike(r"(?U)\s"), F.regexp_replace(x, _EDGE_SPACE, "")).otherwise(x))


def starts_with(col, prefix: str) -> Column:
    return F.coalesce(strip(col).startswith(prefix), F.lit(False))


def last_chars(col, n: int) -> Column:
    """Last ``n`` characters, null read as ``''``."""
    return F.right(F.coalesce(to_col(col).cast("string"), F.lit("")), F.lit(n))


def blank_to_null(col) -> Column:
    """C8 – exact empty text → null."""
    return F.nullif(to_col(col), F.lit(""))


def nan_to_null(col) -> Column:
    """C8 – NaN → null for floating columns."""
    return F.nanvl(to_col(col), F.lit(None).cast("double"))


def as_text(col, null_text: str | None = None) -> Column:
    """C14 – cast to text; optionally render null as ``null_text`` (``nan``)."""
    c = to_col(col).cast("string")
    return c if null_text is None else F.coalesce(c, F.lit(null_text))


# C9 / C10 -------------------------------------------------------------------
def text_between(col, after: str, before: str, unicode: bool = False) -> Column:
    """C9 – text after the last ``after`` and before the first ``before``,
    stripped.  A missing marker leaves the whole text (as ``str.split``).  ``unicode`` finds
    the markers in any case and with composed or decomposed accents."""
    if unicode:
        def cut(c, mark, n):
            return F.call_function("substring_index", F.collate(c, "UNICODE_CI"), F.collate(F.lit(mark), "UNICODE_CI"), F.lit(n)).cast("string")
        return strip(cut(strip(cut(to_col(col).cast("string"), after, -1)), before, 1))
    tail = F.substring_index(to_col(col), after, -1)
    return strip(F.substring_index(strip(tail), before, 1))


def capture(col, pattern: str, group: int = 1) -> Column:
    """C10 – first regex match group, or null."""
    return F.nullif(F.regexp_extract(to_col(col), pattern, group), F.lit(""))


# C11 ------------------------------------------------------------------------
def classify_customer(name, phone, membership, kiosk_name: str = KIOSK_ACCOUNT,
                      default_member: str = DEFAULT_MEMBERSHIP,
                      labels: Sequence[str] = (CUSTOMER_RETAIL, CUSTOMER_NEW, CUSTOMER_RETURNING)) -> Column:
    """C11 – first match wins: retail (kiosk account, or blank name/phone),
    new (no or default membership), else returning."""
    n, m = to_col(name), to_col(membership)
    retail = F.coalesce(n == F.lit(kiosk_name), F.lit(False)) | is_empty(n) | is_empty(phone)
    new = is_empty(m) | F.coalesce(m == F.lit(default_member), F.lit(False))
    return (F.when(retail, F.lit(labels[0]))
            .when(new, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


# C12 / C13 ------------------------------------------------------------------
def override_price(item, price, rules: Sequence[tuple[str, float]] = TOPPING_PRICES,
                   regex: bool = True) -> Column:
    """C12 – the price of the *last* rule whose pattern occurs in ``item``;
    unchanged when none does.  Patterns are regular expressions with the
    literal ``+`` escaped (the original's behaviour); ``regex=False`` treats
    them as plain text."""
    out = to_col(price)
    chain = None
    for pattern, value in reversed(list(rules)):
        if regex:
            hit = to_col(item).rlike(pattern.replace("+", r"\+"))
        else:
            hit = F.contains(to_col(item), F.lit(pattern))
        hit = F.coalesce(hit, F.lit(False))
        chain = F.when(hit, F.lit(value).cast("double")) if chain is None else chain.when(hit, F.lit(value).cast("double"))
    return out if chain is None else chain.otherwise(out.cast("double"))


def order_value(qty, unit_price) -> Column:
    """C13 – quantity × unit price."""
    return to_col(qty) * to_col(unit_price)


def escape_regex(text: str) -> str:
    return re.escape(text)
