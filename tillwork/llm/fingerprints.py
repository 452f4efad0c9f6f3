"""Document fingerprints by consistent weighted sampling.

A text is its words weighted by their counts.  For each of the samples, a word w with weight
S draws r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1) from hashes of (w, sample) alone, and takes
t = floor(ln S / r + b), ln a = ln c - r (t - b) - r; the sample is the (w, t) with least a.
Two texts agree in a sample with the probability of their generalised Jaccard similarity,
sum of least weights over sum of greatest weights.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.words import CHUNK_BYTES, STEP, U, Words, mix, row_chunks, utf8

SAMPLES = 64
PART_BYTES = 8_000_000
#: ranges of doc_id at most; beyond that they grow, and are sorted and streamed in place
PARTS = 10_000
LEAST_ID = -(1 << 63)


def _uniforms(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers above 0 and at most 1 from the halves of 64 bits."""
    scale = np.float32(2.0**-32)
    return ((x >> U(32)).astype(np.float32) + np.float32(0.5)) * scale, (x.astype(np.uint32).astype(np.float32) + np.float32(0.5)) * scale


def weighted_samples(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n_docs: int, samples: int = SAMPLES) -> np.ndarray:
    """(n_docs, samples) 16-bit samples of weighted terms, sorted by ``doc``; 0 without terms."""
    out = np.zeros((n_docs, samples), np.uint16)
    if not len(doc):
        return out
    # equal (term, weight) draw alike in every text, so each is drawn once
    kind, first, of = np.unique(mix(term + weight.astype(U) * STEP), return_index=True, return_inverse=True)
    term, log_weight = term[first], np.log(weight[first]).astype(np.float32)
    present, begin = np.unique(doc, return_index=True)
    tiny = np.float32(1e-7)
    for k in range(samples):
        x = mix(term ^ mix(np.full(1, k + 1, U)))
        y = mix(x + STEP)
        u1, u2 = _uniforms(x)
        u3, u4 = _uniforms(y)
        beta, _ = _uniforms((x ^ (y >> U(7))) * STEP)
        r, c = np.maximum(-np.log(u1 * u2), tiny), np.maximum(-np.log(u3 * u4), tiny)
        t = np.floor(log_weight / r + beta)
        bits = (np.log(c) - r * (t - beta) - r).view(np.uint32)
        rising = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))  # unsigned order is float order
        name = ((y ^ t.astype(np.int64).view(U)) * STEP) >> U(32)
        drawn = (rising.astype(U) << U(32)) | name
        out[present, k] = np.minimum.reduceat(drawn[of], begin).astype(np.uint16)
    return out


def fingerprint_texts(texts, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, has any word) of an Arrow string array."""
    raw, off = utf8(texts)
    words = Words(raw, off)
    doc, term = words.doc, words.hash
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    begin = np.flatnonzero(new)
    weight = np.diff(begin, append=len(doc))
    return weighted_samples(doc[begin], term[begin], weight, len(texts), samples), words.count > 0


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Share of equal samples; texts without words are alike among themselves only."""
    return np.where(some_a & some_b, (a == b).mean(axis=1), (some_a == some_b).astype(np.float64))


def hex_rows(sig: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sig]


def in_id_order(docs: DataFrame) -> DataFrame:
    """``(part, ghost, doc_id, text)`` sorted inside each partition, so that the row after a
    document is the next one by (doc_id, text); after the last of a part comes a copy of the
    next part's first row (``ghost``), after the last part the first part's.

    Only cut points and first ids of the parts, at most ``PARTS`` of either, reach the driver.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(LEAST_ID)))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(PARTS, math.ceil(size / PART_BYTES) or 1)
    cuts = sorted(set(docs.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10 * parts)).first()[0] or [])) if parts > 1 else []

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), key.to_numpy(np.int64), "right").astype(np.int32))

    docs = docs.withColumn("part", part_of("key")) if cuts else docs.withColumn("part", F.lit(0))
    heads = sorted(tuple(r) for r in docs.groupBy("part").agg(F.min("key")).collect())
    before = spark.createDataFrame([(heads[i - 1][0], key) for i, (_, key) in enumerate(heads)], "target int, key long")
    ghosts = (docs.join(F.broadcast(before), "key").groupBy("target", "key", "doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
              .select(F.col("target").alias("part"), F.lit(1).alias("ghost"), "key", "doc_id", "text"))
    rows = docs.select("part", F.lit(0).alias("ghost"), "key", "doc_id", "text").union(ghosts)
    # each part its own task: a hash of part numbers would put several into one
    return rows.repartitionById(parts, "part").sortWithinPartitions("part", "ghost", "key", "text").select("part", "ghost", "doc_id", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document by doc_id, after the last the first; a null doc_id comes
    first, equal ids go by text.  A null text is empty; texts without words have the
    fingerprint 0 and are alike (1.0) among themselves only.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch], batch.schema).combine_chunks()
            off = utf8(table["text"].combine_chunks())[1] if table.num_rows else np.zeros(1, np.int64)
            for lo, hi in row_chunks(off[:-1], limit=CHUNK_BYTES) if table.num_rows > 1 else ():
                part = table.slice(lo, hi - lo + 1)  # with the row after
                text = [x or "" for x in part["text"].to_pylist()]
                mine = np.flatnonzero(np.array(part["ghost"].to_pylist()[:-1]) == 0)
                edited = [text[i][: len(text[i]) - len(text[i]) // 2] + text[i + 1][: len(text[i]) // 2] for i in mine]
                sig, some = fingerprint_texts(pa.array(text + edited, pa.large_string()), samples)
                own, after, changed = sig[mine], sig[mine + 1], sig[len(text) :]
                some_own, some_after, some_changed = some[mine], some[mine + 1], some[len(text) :]
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"].combine_chunks().take(pa.array(mine)),
                    pa.array([len(text[i]) for i in mine], pa.int64()),
                    pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited], pa.string()),
                    pa.array(hex_rows(own), pa.string()), pa.array(hex_rows(changed), pa.string()),
                    pa.array(likeness(own, some_own, changed, some_changed)), pa.array(likeness(own, some_own, after, some_after)),
                ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            held = table.slice(table.num_rows - 1).to_batches()[0] if table.num_rows else None

    return in_id_order(docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
