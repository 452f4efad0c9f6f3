"""Fill-in-the-middle documents, cut at word boundaries through a learned rank index.

The boundaries of all texts of a chunk are one ascending list of byte offsets.  It is fitted by
straight segments: each goes as far as one line stays within ``ERROR`` bytes of every boundary
(the cone of possible slopes, narrowed boundary by boundary, is not yet empty).  A boundary is
predicted from its rank by its segment and corrected by its stored residual, which is exact.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.words import Words, row_chunks, utf8

#: bytes that a prediction may be away from its boundary; residuals take one signed byte
ERROR = 96
#: boundaries that are tried at once for a segment; doubled while the line holds
AHEAD = 512
P, S, M = b"<P>", b"<S>", b"<M>"


@dataclass
class RankIndex:
    """Offsets by rank: ``first`` rank, ``base`` offset and ``slope`` of each segment, and the
    ``residual`` of each rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, rank, "right") - 1
        return self.base[at] + np.rint(self.slope[at] * (rank - self.first[at])).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        return self.predict(rank) + self.residual[rank]


def fit_ranks(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of ascending ``offsets``; no prediction is off by more than ``error``, rounded."""
    first, base, slope, lo, n = [], [], [], 0, len(offsets)
    while lo < n:
        low, high, at, step, end = -np.inf, np.inf, lo + 1, AHEAD, n
        while at < n:
            run = np.arange(1, min(step, n - at) + 1) + (at - lo - 1)
            rise = offsets[at : at + len(run)] - offsets[lo]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            shut = np.flatnonzero(lows > highs)
            good = shut[0] if len(shut) else len(run)
            if good:
                low, high = lows[good - 1], highs[good - 1]
            if len(shut):
                end = at + good
                break
            at, step = at + len(run), 2 * step
        first.append(lo)
        base.append(offsets[lo])
        slope.append(0.0 if end == lo + 1 else (low + high) / 2)
        lo = end
    index = RankIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope, np.float64), np.zeros(n, np.int16))
    index.residual = (offsets - index.predict(np.arange(n))).astype(np.int16) if n else index.residual
    return index


def boundaries(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte offsets of all unit boundaries of the texts, units of each text).

    A unit is a word with the white space before it; white space at the end is a unit of its
    own.  Each text begins with its boundary 0.
    """
    words = Words(raw, off)
    begin, stop, some = words.off[:-1], words.off[1:], words.count > 0
    last = begin.copy()
    last[some] = words.end[words.first[1:][some] - 1]
    rest = last < stop  # white space at the end, or the whole text
    units = words.count + rest
    rank = np.concatenate(([0], np.cumsum(units + 1)))
    out = np.empty(rank[-1], np.int64)
    out[rank[:-1]] = begin
    out[np.arange(len(words.end)) + 1 + (rank[:-1] - words.first[:-1])[words.doc]] = words.end
    out[rank[1:][rest] - 1] = stop[rest]
    return out, units


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the SHA-256 of ``seed:doc_id`` (a null id is empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4))


def arrange(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return b"".join((P, prefix, S, suffix, M, middle))
    return b"".join((S, suffix, P, prefix, M, middle))


def restore(form: str, output: bytes) -> bytes:
    """The text from which ``output`` was arranged."""
    if form == "plain":
        return output
    head, middle = output.split(M, 1)
    if form == "psm":
        prefix, suffix = head[len(P) :].split(S, 1)
    else:
        suffix, prefix = head[len(S) :].split(P, 1)
    return prefix + middle + suffix


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """One row per row: ``doc_id, n, form, prefix_chars, middle_chars, output, restored``.

    A text of ``n`` units is cut at two boundaries drawn from a hash of (seed, doc_id); ``rate``
    of 100 documents are arranged, ``spm`` of 100 of those suffix first.  A text that is null,
    empty or holds a mark stays plain; ``restored`` is rebuilt from output and form alone.
    Equal rows get equal rows, a null doc_id stays null and draws as an empty one; a very long
    text is a chunk of its own; other columns are ignored.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw_all, off_all = utf8(batch.column(1))
            for lo, hi in row_chunks(off_all):
                off = off_all[lo : hi + 1]
                raw = raw_all[off[0] : off[-1]]
                data, text_off = raw.tobytes(), off - off[0]
                offsets, units = boundaries(raw_all, off)
                index = fit_ranks(offsets)
                ids = batch.column(0).slice(lo, hi - lo)
                drawn = np.array([draws(seed, i) for i in ids.to_pylist()], np.int64).reshape(-1, 4)
                one, two = drawn[:, 0] % (units + 1), drawn[:, 1] % (units + 1)
                start_rank = np.concatenate(([0], np.cumsum(units + 1)))[:-1]
                cut1 = index.offset(start_rank + np.minimum(one, two))
                cut2 = index.offset(start_rank + np.maximum(one, two))
                chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                n_prefix, n_middle = chars[cut1] - chars[text_off[:-1]], chars[cut2] - chars[cut1]
                form, output, restored = [], [], []
                for k, (a, b) in enumerate(zip(text_off[:-1], text_off[1:])):
                    text = data[a:b]
                    if not text or drawn[k, 2] % 100 >= rate or P in text or S in text or M in text:
                        form.append("plain")
                        output.append(text)
                    else:
                        form.append("spm" if drawn[k, 3] % 100 < spm else "psm")
                        output.append(arrange(form[-1], data[a : cut1[k]], data[cut1[k] : cut2[k]], data[cut2[k] : b]))
                    restored.append(restore(form[-1], output[-1]))
                plain = np.array([f == "plain" for f in form], bool)
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(units, pa.int64()), pa.array(form, pa.string()), pa.array(n_prefix, pa.int64(), mask=plain),
                    pa.array(n_middle, pa.int64(), mask=plain), pa.array(output, pa.binary()).cast(pa.string()), pa.array(restored, pa.binary()).cast(pa.string()),
                ], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string")


def duckdb_sql(table: str, seed: int = 42, rate: int = 50, spm: int = 80) -> str:
    """The same in DuckDB SQL, with digests of the texts."""
    space = r"[\x20\x09-\x0D]"
    unit = rf"{space}*[^\x20\x09-\x0D]+|{space}+"
    group = lambda i: f"CAST('0x' || substr(hash, {8 * i + 1}, 8) AS BIGINT)"
    mark = " OR ".join(f"contains(text, '{m.decode()}')" for m in (P, S, M))
    return f"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
         regexp_extract_all(coalesce(text, ''), '{unit}') AS units FROM {table}), c AS (
  SELECT *, len(units) AS n, {group(0)} % (len(units) + 1) AS one, {group(1)} % (len(units) + 1) AS two,
         CASE WHEN text = '' OR {mark} OR {group(2)} % 100 >= {rate} THEN 'plain' WHEN {group(3)} % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM d), p AS (
  SELECT doc_id, n, form, text, array_to_string(units[1:least(one, two)], '') AS prefix, array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""
