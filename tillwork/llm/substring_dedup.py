"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Documents are dealt into blocks of bounded text.  A block hashes each of its windows (64
bits from one rolling hash, 15 more from a second) and keeps the distinct ones, so that a
passage in a third of all documents is one entry per block.  The entries go, packed and
sorted, to hash ranges; a range counts them and answers each block with those that start
anywhere else too.  The block then merges its repeated windows into maximal intervals.
Blocks and ranges are as many as the bytes of the input ask for, so each stays small.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.words import STEP, U, Words, row_chunks, utf8

STEP2 = U(0xA24BAED4963EE407)
BLOCK_BYTES = 8_000_000
#: about 250,000 windows
RANGE_BYTES = 1_600_000


def window_keys(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, 64-bit hash, 15-bit tag) of every window."""
    _, begin = words.windows(width)
    return begin, words.rolling(begin, width), (words.rolling(begin, width, STEP2) >> U(49)).astype(np.uint16)


def pack(key: np.ndarray, tag: np.ndarray) -> bytes:
    """Ascending keys as differences, byte plane by byte plane (the high planes are zeros,
    which the shuffle's compression removes), then the tags."""
    step = np.diff(key, prepend=U(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes() + tag.tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 10
    step = np.ascontiguousarray(np.frombuffer(blob, np.uint8, 8 * n).reshape(8, n).T).view(U).ravel()
    return np.cumsum(step, dtype=U), np.frombuffer(blob, np.uint16, n, 8 * n)


def tally(key: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group number in that order, size of each group) of equal (key, tag)."""
    order = np.lexsort((tag, key))
    key, tag = key[order], tag[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
    group = np.cumsum(new) - 1
    return order, group, np.bincount(group) if len(key) else np.empty(0, np.int64)


def listed(key: np.ndarray, tag: np.ndarray, keys: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which (key, tag) are in the list (keys ascending; one key may have more than one tag)."""
    found = np.zeros(len(key), bool)
    if len(keys):
        at = np.searchsorted(keys, key)
        while True:
            open_ = ~found & (at < len(keys))
            open_[open_] = keys[at[open_]] == key[open_]
            if not open_.any():
                return found
            found[open_] = tags[at[open_]] == tag[open_]
            at = at + 1
    return found


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, removed, kept_text``.

    Words are the runs without space and ASCII control 9 to 13.  A window is ``window``
    consecutive words of one document; each word covered by a window whose words also start
    anywhere else, the same document included, goes.  ``removed`` has the maximal word
    intervals [start, stop), ``kept_text`` the other words joined by one space.  A null,
    empty or short text loses nothing; two equal rows are two documents; a null doc_id stays
    null; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, ranges = math.ceil(size / BLOCK_BYTES) or 1, math.ceil(size / RANGE_BYTES) or 1
    blocked = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def hashed(_, table):
        import pyarrow as pa

        raw, off = utf8(table["text"].combine_chunks())
        parts = [window_keys(Words(raw, off[lo : hi + 1]), window)[1:] for lo, hi in row_chunks(off)]
        key = np.concatenate([k for k, _ in parts])
        order, group, n = tally(key, tag := np.concatenate([t for _, t in parts]))
        first = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64) if len(n) else order
        key, tag = key[order][first], (tag[order][first] << 1) | (n > 1).astype(np.uint16)
        part = ((key >> U(32)) * U(ranges)) >> U(32)
        full, begin = np.unique(part, return_index=True)  # of the ranges, those with windows here
        cut = np.append(begin, len(part))
        return pa.table({"range": pa.array(full.astype(np.int64)), "block": pa.array(np.repeat(table["block"][0].as_py(), len(full)), pa.int64()),
                         "entries": pa.array([pack(key[lo:hi], tag[lo:hi]) for lo, hi in zip(cut, cut[1:])], pa.binary())})

    def counted(_, table):
        import pyarrow as pa

        parts = [unpack(x) for x in table["entries"].to_pylist()]
        ends = np.cumsum([0, *(len(k) for k, _ in parts)])
        key, tag = np.concatenate([k for k, _ in parts]), np.concatenate([t for _, t in parts])
        order, group, n = tally(key, tag >> 1)
        again = np.zeros(len(n), bool)
        again[group[(tag[order] & 1) == 1]] = True
        again |= n > 1
        hit = np.empty(len(key), bool)
        hit[order] = again[group]
        rows = [(b, pack(key[lo:hi][hit[lo:hi]], tag[lo:hi][hit[lo:hi]] >> 1))
                for b, lo, hi in zip(table["block"].to_pylist(), ends, ends[1:]) if hit[lo:hi].any()]
        return pa.table({"block": pa.array([b for b, _ in rows], pa.int64()), "entries": pa.array([e for _, e in rows], pa.binary())})

    def cut_out(left, right):
        import pyarrow as pa

        parts = sorted((unpack(x) for x in right["entries"].to_pylist()), key=lambda p: p[0][0])
        keys = np.concatenate([np.empty(0, U), *(k for k, _ in parts)])
        tags = np.concatenate([np.empty(0, np.uint16), *(t for _, t in parts)])
        raw, off = utf8(left["text"].combine_chunks())
        ids, out = left["doc_id"].combine_chunks(), []
        for lo, hi in row_chunks(off):
            words = Words(raw, off[lo : hi + 1])
            begin, key, tag = window_keys(words, window)
            begin = begin[listed(key, tag, keys, tags)]
            cover = np.bincount(begin, minlength=len(words.start) + 1) - np.bincount(begin + window, minlength=len(words.start) + 1)
            gone = np.cumsum(cover)[:-1] > 0
            out.append(pa.table(kept(words, gone, ids.slice(lo, hi - lo))).combine_chunks())
        return pa.concat_tables(out)

    repeated = (blocked.groupBy("block").applyInArrow(hashed, "range long, block long, entries binary")
                .groupBy("range").applyInArrow(counted, "block long, entries binary"))
    return blocked.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        cut_out, "doc_id long, n_words long, n_removed long, removed array<struct<start: long, stop: long>>, kept_text string")


def kept(words: Words, gone: np.ndarray, ids) -> dict:
    """Result columns of a chunk, of which the words ``gone`` go."""
    import pyarrow as pa

    n, first, doc = len(words.count), words.first, words.doc
    before = np.concatenate(([False], gone[:-1])) if len(gone) else gone
    after = np.concatenate((gone[1:], [False])) if len(gone) else gone
    head, tail = np.zeros(len(gone) + 1, bool), np.zeros(len(gone) + 1, bool)
    head[first[:-1]], tail[first[1:]] = True, True
    start = np.flatnonzero(gone & (~before | head[:-1]))
    stop = np.flatnonzero(gone & (~after | tail[1:])) + 1
    spans = pa.StructArray.from_arrays([pa.array(start - first[doc[start]]), pa.array(stop - first[doc[start]])], ["start", "stop"])
    n_spans = np.bincount(doc[start], minlength=n)
    stay = np.flatnonzero(~gone)
    delta = np.bincount(words.start[stay], minlength=len(words.raw) + 1) - np.bincount(words.end[stay], minlength=len(words.raw) + 1)
    take = np.cumsum(delta)[:-1] > 0
    space = words.end[stay[:-1][doc[stay[1:]] == doc[stay[:-1]]]]  # between two kept words of one text
    buffer = words.raw.copy()
    buffer[space], take[space] = 32, True
    ends = np.concatenate(([0], np.cumsum(take)))[words.off]
    text = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(buffer[take])])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n_spans))).astype(np.int32)), spans)
    return {"doc_id": ids, "n_words": pa.array(words.count), "n_removed": pa.array(np.bincount(doc[gone], minlength=n)),
            "removed": lists, "kept_text": text}
