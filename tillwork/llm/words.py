"""Words, word hashes and window hashes of whole Arrow text batches, in numpy.

A batch is worked in chunks of about ``CHUNK_BYTES`` of text (one long text is
a chunk of its own), so memory is bounded by the longest text, not the batch.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 2_000_000
U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
STEP = U(0xD6E8FEB86659FD93)

#: separators of a word: space and the ASCII control characters 9 to 13
SPACES = bytes([32, *range(9, 14)])
#: for letter tokens: every ASCII byte that is no letter separates
NON_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def utf8(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; a null text is empty."""
    import pyarrow as pa

    array = array.cast(pa.large_string()).fill_null("")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, off


def row_chunks(off: np.ndarray, limit: int = CHUNK_BYTES):
    """Consecutive row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """Words of the texts ``lo..hi`` of a batch.

    start, end -- byte spans in ``raw``; first -- index of each text's first
    word, with the total at the end; hash -- 64-bit hash of each word's bytes.
    """

    def __init__(self, raw: np.ndarray, off: np.ndarray, separators: bytes = SPACES, lower: bool = False):
        self.off = off - off[0]
        self.raw = raw[off[0] : off[-1]]
        self.lower = lower
        n = len(self.raw)
        table = np.ones(256, bool)
        table[np.frombuffer(separators, np.uint8)] = False
        self.inside = inside = table[self.raw]
        edge = np.zeros(n + 1, bool)
        edge[self.off] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.concatenate((inside[1:], [False])) if n else inside
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.count = np.diff(self.first)
        self._hash = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self._hashes()
        return self._hash

    def _hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.empty(0, U)
        code = np.arange(1, 257, dtype=U)
        if self.lower:
            code[65:91] += U(32)
        length = self.end - self.start
        power = np.cumprod(np.full(int(length.max()), BASE, U))
        at = np.zeros(len(self.raw), np.int32)
        at[self.start] = self.start
        np.maximum.accumulate(at, out=at)
        place = np.arange(len(self.raw), dtype=np.int32) - at
        value = code[self.raw]
        value[~self.inside] = 0
        np.minimum(place, len(power) - 1, out=place)
        value *= power[place]
        return mix(np.add.reduceat(value, self.start) + length.astype(U))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text index, index of the first word) of every window of ``width`` words."""
        n = np.maximum(self.count - width + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        begin = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + self.first[:-1][doc]
        return doc, begin

    def rolling(self, begin: np.ndarray, width: int, step: np.uint64 = STEP) -> np.ndarray:
        """Rabin-Karp hash of each window: the polynomial in ``step`` over its word hashes,
        taken from one running sum (step is odd, so it can be divided out modulo 2^64)."""
        if not len(begin):
            return np.empty(0, U)
        inverse = U(pow(int(step), -1, 1 << 64))
        total = np.concatenate((np.zeros(1, U), np.cumsum(self.hash * powers(step, len(self.hash)))))
        return mix((total[begin + width] - total[begin]) * powers(inverse, len(self.hash))[begin])


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.cumprod(out)


def distinct_pairs(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs, by text and value."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    keep = np.ones(len(doc), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[keep], value[keep]


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text as (text, hash) pairs; a text with
    fewer words has its whole sequence as its only shingle; one without words has none."""
    doc, begin = words.windows(width)
    value = words.rolling(begin, width)
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    if len(short):
        whole = [mix(words.rolling(words.first[short[words.count[short] == k]], k) + U(k)) for k in range(1, width)]
        which = [short[words.count[short] == k] for k in range(1, width)]
        doc, value = np.concatenate([doc, *which]), np.concatenate([value, *whole])
    return distinct_pairs(doc, value)
