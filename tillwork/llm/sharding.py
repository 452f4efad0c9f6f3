"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group.  Groups of a noticeable share are items of their own, those of a
large share are split into pieces, all others meet in ``BUNDLES`` hashed bundles; so there
are a few ten thousand items at most, whatever the input.  Items, the largest first, go to
the shard where the dot product of their vector with the residual capacity is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tillwork.llm.spark_util import materialise

BUNDLES = 4096
#: of the whole, in any dimension: above it a group of equal texts is split
SPLIT_SHARE = 1 / 128


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item; ``vectors`` are shares of the whole by dimension."""
    capacity = np.full((shards, vectors.shape[1]), 1.0 / shards)
    order = np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1, initial=0)))
    out = np.zeros(len(vectors), np.int32)
    for i in order:
        out[i] = to = int(np.argmax(np.round(capacity @ vectors[i], 15)))
        capacity[to] -= vectors[i]
    return out


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, size, tokens, text_crc32, law, shard, slot, grown_shard``.

    size: UTF-8 bytes of the text (null: 0) plus 1; tokens: its words.  The law is ``bytes``:
    the shards' sizes are near equal, each as near as the least item allows.  Slots count from
    0 in each shard, by item and doc_id, without gaps; grown_shard is null under this law.
    Equal rows are rows of one group; a null or empty text is the empty text; a null doc_id
    is placed like any other; an empty table gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("text_md5"),
        F.monotonically_increasing_id().alias("row")))
    dims = ("size", "tokens", "n")
    groups = rows.groupBy("text_md5").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    total = [max(x or 0, 1) for x in groups.agg(*(F.sum(d) for d in dims)).first()]
    share = F.greatest(*(F.col(d) / F.lit(float(t)) for d, t in zip(dims, total)))
    own = groups.where(share > 1 / BUNDLES).select("text_md5", F.when(share > SPLIT_SHARE, F.least(F.ceil(share * BUNDLES), F.col("n"))).otherwise(1).cast("int").alias("pieces"))
    # at most one such group for each bundle and dimension, so its size is bounded
    item = F.when(F.col("pieces").isNotNull(), F.concat_ws("/", "text_md5", F.pmod(F.xxhash64("row"), F.col("pieces")))).otherwise(
        F.concat(F.lit("bundle "), F.pmod(F.xxhash64("text_md5"), F.lit(BUNDLES))))
    rows = materialise(rows.join(F.broadcast(own), "text_md5", "left").withColumn("item", item).drop("text_md5", "pieces"))
    items = sorted(tuple(r) for r in rows.groupBy("item").agg(F.sum("size"), F.sum("tokens"), F.count("*")).collect())
    vectors = np.array([x[1:] for x in items], float).reshape(-1, 3) / np.array(total, float)
    to = place(vectors, shards)
    start, placed = [0] * shards, []
    for (name, _, _, n), shard in zip(items, to.tolist()):
        placed.append((name, shard, start[shard]))
        start[shard] += n
    placed = spark.createDataFrame(placed, "item string, shard int, start long")
    within = F.row_number().over(Window.partitionBy("item").orderBy("doc_id", "row")) - 1
    return rows.withColumn("within", within).join(F.broadcast(placed), "item").select(
        "doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
