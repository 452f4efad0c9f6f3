"""Ordered scans (fill, running count, running sum) that never put one key —
or the whole table — into a single task.

Direct form: ``Window.partitionBy(keys).orderBy(order)`` with a running
frame.  It shuffles once on ``keys`` but a key holding a third of all rows
is sorted by one task, and with no keys at all Spark moves the table into
one partition.

Two-phase form (used whenever ``bucket`` is given): ``bucket`` is a
coarse column, or columns from coarse to fine, that never decrease along
``order`` inside a key — e.g. the (date, store, page-group) prefix of the
order key, or the day and minute of a timestamp.

1. scan inside each (keys, bucket) segment — bounded work per task;
2. reduce every segment to its final scan value (one row per segment, an
   aggregate that is combined map-side, so no row is shuffled for it);
3. carry over the segments level by level: inside one (key, coarser
   buckets) group along the finest bucket, then over the groups' own end
   values, and so on up to the coarsest bucket;
4. join the carry back on (keys, bucket) and combine.

No window of step 3 sees more rows than one bucket column has values inside
one value of the coarser ones: with (day, minute) a global scan sorts 1440
rows a day and then the days, however many rows a minute holds.  AQE
broadcasts the segment table when its measured size allows.

Where the data name no bucket, :func:`ranged` makes one: the frame is dealt out by sampled
quantiles of (keys, order), so that one hot key spans as many ranges as its rows fill.

Only the rows of large keys are cut by buckets: a key is large if more than
``LARGE`` rows share its cell of ``CELLS`` hash values, which one narrow
aggregate over the key columns counts first.  Any other key is a segment of
its own that carries nothing, so steps 2 to 4 cost what the large keys hold,
and nothing where there are none.  Both forms give the same rows.  Rows whose result is null by rule (a null
key under ``null_keys="null"``) are dealt out by a hash of their order, not
gathered under one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tillwork.functions.util import to_col
from tillwork.session import written

#: rows that the keys of one cell may have without being cut by buckets
LARGE = 100_000
CELLS = 1 << 16
_KINDS = ("last", "count", "sum", "max", "max_before")


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return list(cols)


#: bucket column of :func:`ranged`
RANGE = "__tw_range"


def ranged(df: DataFrame, keys=(), order=("ord",), ranges: int | None = None) -> DataFrame:
    """``df`` with a bucket ``RANGE`` for scans along ``order`` inside ``keys``.

    Rows are dealt into ``ranges`` (default: the session's shuffle partitions) by sampled
    quantiles of (keys, order) and written once with their range's number, which never falls
    along the order of a key: a bill with a third of all rows fills a third of the ranges, and
    small bills lie whole in one.  Written, because a second sample would cut elsewhere; it
    takes the place of the checkpoint a frame needs before a scan.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[to_col(c) for c in [*_names(keys), *_names(order)]])
    return written(dealt.withColumn(RANGE, F.spark_partition_id()))


def _cell(keys) -> Column:
    return F.pmod(F.xxhash64(*[to_col(k) for k in keys]), F.lit(CELLS))


def large_cells_of(df: DataFrame, *key_sets) -> list[list[int]]:
    """For each set of keys the cells that hold more than ``LARGE`` rows (at most ``CELLS``
    numbers), counted in one pass over the key columns."""
    cells = F.array(*[F.struct(F.lit(i).alias("of"), _cell(k).alias("cell")) for i, k in enumerate(key_sets)])
    counts = df.select(F.explode(cells).alias("c")).groupBy("c.of", "c.cell").agg(F.count("*").alias("n"))
    out: list[list[int]] = [[] for _ in key_sets]
    for r in counts.where(F.col("n") > LARGE).collect():
        out[r["of"]].append(r["cell"])
    return out


def large_cells(df: DataFrame, keys) -> list[int]:
    """:func:`large_cells_of` for one set of keys."""
    return large_cells_of(df, keys)[0]


def ranged_if_large(df: DataFrame, keys, order=("ord",)) -> tuple[DataFrame, str | None]:
    """``df`` and the bucket for scans inside ``keys``: none, and ``df`` as it is, unless some
    key is large; then :func:`ranged` makes one.  ``df`` is read twice, so it should be a table."""
    return (ranged(df, keys, order), RANGE) if large_cells(df, _names(keys)) else (df.withColumn(RANGE, F.lit(0)), None)


def _order_cols(order, descending: bool) -> list[Column]:
    out = []
    for c in _names(order):
        c = to_col(c)
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return out


def _local_expr(kind: str, src: str | None, w: WindowSpec) -> Column:
    """Running value inside a segment; ``w`` has no frame yet."""
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "last":
        return F.last(F.col(src), ignorenulls=True).over(upto)
    if kind == "count":
        return F.count(F.lit(1)).over(upto)
    if kind == "sum":
        return F.sum(F.col(src)).over(upto)
    if kind == "max":
        return F.max(F.col(src)).over(upto)
    if kind == "max_before":
        return F.max(F.col(src)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    raise ValueError(f"unknown scan kind {kind!r}")


def _segment_end(kind: str, src: str | None, at: Column, descending: bool) -> Column:
    """Aggregate of a segment's rows: the running value of its final row."""
    if kind == "count":
        return F.count(F.lit(1))
    if kind == "sum":
        return F.sum(F.col(src))
    if kind == "last":
        return (F.min_by if descending else F.max_by)(F.col(src), F.when(F.col(src).isNotNull(), at))
    return F.max(F.col(src))


def _group_end(kind: str, src: str, along: str, descending: bool) -> Column:
    """Aggregate of a group of segments: what it hands on to the later groups."""
    if kind == "last":
        return (F.min_by if descending else F.max_by)(F.col(src), F.when(F.col(src).isNotNull(), F.struct(along)))
    return F.max(F.col(src)) if kind.startswith("max") else F.sum(F.col(src))


def _joined(kind: str, near: Column, far: Column) -> Column:
    """Value of a segment under what earlier ones hand on."""
    if kind == "last":
        return F.coalesce(near, far)
    return F.greatest(near, far) if kind.startswith("max") else F.coalesce(near + far, near, far)


def _carried(segments: DataFrame, specs, keys: list[str], buckets: list[str], descending: bool) -> DataFrame:
    """``segments`` (one row per keys + buckets with its end values ``__tw_s_*``) with the
    value ``__tw_c_*`` that all earlier segments of the key carry into each."""
    *outer, inner = buckets
    group = keys + outer
    along = F.col(inner).desc_nulls_last() if descending else F.col(inner).asc_nulls_first()
    w = (Window.partitionBy(*group) if group else Window).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    cols, ends = {}, []
    for o, k, _ in specs:
        s = F.col(f"__tw_s_{o}")
        over = F.last(s, ignorenulls=True) if k == "last" else F.max(s) if k.startswith("max") else F.sum(s)
        cols[f"__tw_c_{o}"] = over.over(w)
        # what the whole group hands on, one level up
        ends.append(_group_end(k, f"__tw_s_{o}", inner, descending).alias(f"__tw_s_{o}"))
    out = segments.withColumns(cols)
    if not outer:
        return out
    level, up = f"__tw_g{len(outer)}", {f"__tw_c_{o}": f"__tw_a{len(outer)}_{o}" for o, _, _ in specs}
    above = _carried(segments.groupBy(*group).agg(*ends), specs, keys, outer, descending)
    above = above.select(F.struct(*group).alias(level), *[F.col(c).alias(n) for c, n in up.items()])
    out = out.join(above, F.struct(*group) == F.col(level), "left")
    combined = {f"__tw_c_{o}": _joined(k, F.col(f"__tw_c_{o}"), F.col(up[f"__tw_c_{o}"])) for o, k, _ in specs}
    return out.withColumns(combined).drop(level, *up.values())


def scan(df: DataFrame, specs: Sequence[tuple[str, str, str | None]], keys=(), order=("ord",),
         bucket=None, descending: bool = False, null_keys: str = "group") -> DataFrame:
    """Add one column per ``(out, kind, src)`` spec.

    ``kind``: ``last`` – last non-null ``src`` up to and including the row;
    ``count`` – running row count (1-based, = ``row_number``);
    ``sum`` – running sum of ``src``; ``max`` – greatest ``src`` so far;
    ``max_before`` – the same without the row itself.  ``descending`` scans from the end.
    ``null_keys="null"`` gives rows whose key has a null the result null
    (pandas ``groupby`` drops such rows); ``"group"`` treats null as a key.
    """
    keys = _names(keys)
    buckets = _names(bucket)
    for _, kind, _ in specs:
        if kind not in _KINDS:
            raise ValueError(f"unknown scan kind {kind!r}")
    if not keys and not buckets:
        raise ValueError("an ordered scan without keys needs a bucket column (no single-partition windows)")

    if null_keys == "null" and keys:
        has_null = F.lit(False)
        for k in keys:
            has_null = has_null | to_col(k).isNull()
        spread = F.when(has_null, F.xxhash64(*[to_col(c) for c in _names(order)])).otherwise(F.lit(0))
        out = scan(df.withColumn("__tw_spread", spread), specs, [*keys, "__tw_spread"], order, bucket, descending)
        return out.withColumns({o: F.when(~has_null, F.col(o)) for o, _, _ in specs}).drop("__tw_spread")
    if null_keys not in ("group", "null"):
        raise ValueError(f"unknown null_keys rule {null_keys!r}")

    order_cols = _order_cols(order, descending)
    large = large_cells(df, keys) if keys and buckets else []
    if not buckets or keys and not large:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumns({o: _local_expr(k, s, w) for o, k, s in specs})

    # A segment is one struct: nulls inside it compare as values, so that window, aggregate
    # and join share one exchange (a null-safe join on columns would shuffle all rows again).
    names = [f"__tw_k{i}" for i in range(len(keys))], [f"__tw_b{i}" for i in range(len(buckets))]
    is_large = _cell(keys).isin(large) if keys else F.lit(True)
    parts = [to_col(c).alias(n) for c, n in zip(keys, names[0])]
    parts += [(F.when(is_large, to_col(c)) if keys else to_col(c)).alias(n) for c, n in zip(buckets, names[1])]
    w = Window.partitionBy("__tw_seg").orderBy(*order_cols)
    work = df.withColumn("__tw_seg", F.struct(*parts))
    at = F.struct(*[to_col(c) for c in _names(order)])
    ends = work.where(is_large).groupBy("__tw_seg").agg(*[_segment_end(k, s, at, descending).alias(f"__tw_s_{o}") for o, k, s in specs])
    # All local values come from one projection: a spec may overwrite the source of another.
    work = work.withColumns({f"__tw_l_{o}": _local_expr(k, s, w) for o, k, s in specs})
    ends = ends.select("__tw_seg.*", *[f"__tw_s_{o}" for o, _, _ in specs])
    carried = _carried(ends, specs, *names, descending)
    carried = carried.select(F.struct(*names[0], *names[1]).alias("__tw_of"), *[f"__tw_c_{o}" for o, _, _ in specs])
    joined = work.join(carried, F.col("__tw_seg") == F.col("__tw_of"), "left")
    out = joined.withColumns({o: _joined(k, F.col(f"__tw_l_{o}"), F.col(f"__tw_c_{o}")) for o, k, _ in specs})
    return out.drop("__tw_seg", "__tw_of", *[f"__tw_{x}_{o}" for x in "lc" for o, _, _ in specs])
