"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded
buckets, star-shaped candidate edges, links confirmed on the full shingle sets.

How links stay whole.  Copies with one word sequence are one node (its smallest doc_id).
With 64 bands of 6 rows a pair at the threshold 0.8 shares no bucket with probability
(1 - 0.8^6)^64 < 4e-9.  In a bucket a member is first compared with one centre only: the
member that shares most buckets with others, so a text that many copies derive from.
Most buckets then lie in one component.  In a bucket that still spans components, the
pairs between them are compared too: its members are dealt into blocks, each pair of
blocks is one task group, and a pair goes on to the exact check, once, only if the two
signatures share at least two bands and the bit sets of their shingles allow the
threshold: each differing bit proves a shingle that only one of the two has, so no pair at
the threshold fails this.  No list of all pairs is made, and none is capped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.components import connected_components
from tillwork.llm.spark_util import materialise
from tillwork.llm.words import STEP, U, Words, mix, powers, row_chunks, shingles, utf8

BANDS, ROWS = 64, 6
#: members of a block in a bucket that spans components
BLOCK = 4096
#: at the threshold a pair shares 17 of 64 bands on average, under two with probability 1e-7
LEAST_BANDS = 2
#: bits of a shingle set's occupancy map
MAP_BITS = 4096


def one_permutation(doc: np.ndarray, value: np.ndarray, n_docs: int, bins: int) -> np.ndarray:
    """(n_docs, bins) signature: one hash per shingle, the least per bin; an empty bin takes
    the value of the first filled bin in its own fixed random order (optimal densification)."""
    sig = np.full(n_docs * bins, np.iinfo(np.uint64).max, U)
    np.minimum.at(sig, doc * bins + (value % U(bins)).astype(np.int64), mix(value))
    sig = sig.reshape(n_docs, bins)
    filled = sig != np.iinfo(np.uint64).max
    row, bin_ = np.nonzero(~filled & filled.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        order = mix(np.arange(bins, dtype=U) * STEP + U(attempt * 0x51ED27))
        source = (order % U(bins)).astype(np.int64)[bin_]
        hit = filled[row, source]
        sig[row[hit], bin_[hit]] = sig[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return sig


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sig.reshape(len(sig), bands, rows) * powers(STEP, rows + 1)[1:]
    return mix(part.sum(axis=2, dtype=U) + mix(np.arange(1, bands + 1, dtype=U)))


def sequence_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's whole word sequence."""
    n = len(words.count)
    place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.count)
    out = []
    for step in (STEP, U(0xA24BAED4963EE407)):
        term = words.hash * powers(step, int(words.count.max(initial=0)) + 1)[place]
        total = np.concatenate((np.zeros(1, U), np.cumsum(term)))
        out.append(mix(total[words.first[1:]] - total[words.first[:-1]] + words.count.astype(U)) if n else np.empty(0, U))
    return out[0], out[1]


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands) per row; bands is empty without shingles."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = utf8(batch.column(1))
            for lo, hi in row_chunks(off):
                words = Words(raw, off[lo : hi + 1], lower=True)
                doc, value = shingles(words, width)
                n = np.bincount(doc, minlength=hi - lo)
                hashes = band_hashes(one_permutation(doc, value, hi - lo, bands * rows), bands, rows)[n > 0]
                k1, k2 = sequence_keys(words)
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.ravel().view(np.int64)))],
                    ["doc_id", "n_shingles", "k1", "k2", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, shingles, bits): the full set as 64-bit hashes, and its occupancy map."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = utf8(batch.column(1))
            for lo, hi in row_chunks(off):
                doc, value = shingles(Words(raw, off[lo : hi + 1], lower=True), width)
                ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=hi - lo)))).astype(np.int32)
                on = np.zeros((hi - lo, MAP_BITS), bool)
                on[doc, (mix(value ^ STEP) % U(MAP_BITS)).astype(np.int64)] = True
                bits = [row.tobytes() for row in np.packbits(on, axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(value.view(np.int64))),
                     pa.array(bits, pa.binary())],
                    ["doc_id", "shingles", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, shingles array<long>, bits binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= percent * union."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (pairs.join(a, "u").join(b, "v")
            .where(100 * both >= percent * (F.size("a") + F.size("b") - both)).select("u", "v"))


def star_edges(members: DataFrame) -> DataFrame:
    """(member, centre) of each bucket; the centre is the member with most bucket company."""
    centre = members.groupBy("bucket").agg(F.max(F.struct("company", F.negative("node").alias("back"))).alias("top"))
    return (members.join(centre.select("bucket", F.negative("top.back").alias("v")), "bucket")
            .where("node <> v").select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct())


def cross_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components inside the buckets that still span some, compared block
    against block on their bands and occupancy maps; a pair comes out of its first common bucket."""
    tagged = (members.select("bucket", "node").join(labels, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    open_ = (tagged.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
             .where("lo < hi").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("k")))
    dealt = (tagged.join(open_, "bucket").join(nodes, "node")
             .withColumn("mine", F.pmod(F.xxhash64("node", "bucket"), F.col("k")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select("bucket", "node", "component", "bands", "bits", "n_shingles", "mine",
                     F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")))

    def compare(_, table):
        import pyarrow as pa

        node, comp, size, bucket = (table[c].to_numpy() for c in ("node", "component", "n_shingles", "bucket"))
        mine, x, y = (table[c].to_numpy() for c in ("mine", "x", "y"))
        bands = np.asarray(table["bands"].combine_chunks().flatten()).reshape(len(node), -1)
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), U).reshape(len(node), -1)
        left, right = np.flatnonzero(mine == x[0]), np.flatnonzero(mine == y[0])
        us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in left:
            to = right[(comp[right] != comp[i]) & ((node[right] > node[i]) | (x[0] != y[0]))]
            apart = np.bitwise_count(bits[to] ^ bits[i]).sum(axis=1, dtype=np.int64)
            to = to[apart * (100 + percent) <= (size[to] + size[i]) * (100 - percent)]
            same = bands[to] == bands[i]
            first = bands[i][same.argmax(axis=1)] == bucket[0]
            to = to[first & (same.sum(axis=1) >= LEAST_BANDS)]
            us.append(np.maximum(node[to], node[i]))
            vs.append(np.minimum(node[to], node[i]))
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return dealt.groupBy("bucket", "x", "y").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    A document's set: distinct ``width``-word shingles of its lower-cased (A-Z) words, its
    whole word sequence where it has fewer; a null, empty or blank text has none and links
    with nothing.  Documents are linked at ``100 * intersection >= percent * union``;
    component_id is the smallest doc_id reachable, kept is ``doc_id = component_id``.
    Rows with one doc_id are one document; a row without doc_id has no component and is
    kept.  Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sig = materialise(signatures(docs, "doc_id", "text", width, bands, rows))
    groups = sig.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    groups = materialise(groups)
    nodes = (sig.where("n_shingles > 0").join(groups.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
             .select(F.col("doc_id").alias("node"), "bands", "n_shingles"))
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    full = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    shared = placed.join(full.select("bucket", "n"), "bucket").distinct()
    shared = materialise(shared)
    company = shared.groupBy("node").agg(F.sum(F.col("n") - 1).alias("company"))
    members = shared.join(company, "node").select("bucket", "node", "company")
    ids = company.select(F.col("node").alias("doc_id"))
    sets = materialise(shingle_sets(docs.join(ids, "doc_id", "left_semi"), "doc_id", "text", width)
                       .groupBy("doc_id").agg(F.first("shingles").alias("shingles"), F.first("bits").alias("bits")))
    links = materialise(confirmed(star_edges(members), sets, percent))
    labels = connected_components(links).select("node", "component")
    known = nodes.join(sets.select(F.col("doc_id").alias("node"), "bits"), "node").dropDuplicates(["node"])
    more = confirmed(cross_pairs(members, known, labels, percent), sets, percent)
    found = labels.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    final = connected_components(found.union(more))
    of_key = groups.join(final, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "k1", "k2").join(of_key, ["k1", "k2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
