"""SentencePiece encoding and decoding as paths through a lexicon transducer.

The lexicon is a trie of the pieces, each with its weight; a word is composed with it into a
lattice of pieces.  The normaliser (space marks and the leading mark) is string replacement, and
the byte fallback (a character that no piece holds, as its UTF-8 bytes) a table: both map every
character in one way only, so as transducers they would add arcs but no choice of path.

* unigram models: the weight of a piece is its negative score; the encoding is the shortest path
  in the tropical semiring.
* BPE models: a fourth transducer, composed lazily, accepts two neighbouring pieces only if
  merging by rank keeps the boundary between them.  A sequence whose neighbours all do is what
  merging the whole makes of it, so exactly one path is left and every search finds it; the
  search goes depth first by the number of pieces and remembers dead states.

No piece holds a space mark after another character, so marks cut an input into words, which
are composed and searched one by one; those that come again are remembered.
"""

from __future__ import annotations

import dataclasses
import math
import re
import sys
import types
from array import array
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.spark_util import free_name
from tillwork.llm.words import row_chunks, utf8

MARK = "▁"
MEMO = 150_000
#: marks of words that came once, by their hash
SEEN = 1 << 22
PAIRS = 800_000
FINAL = ""
#: weight of an unknown character above that of the worst piece
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Spec:
    """What a model file says."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    types: tuple[int, ...]
    bpe: bool
    byte_fallback: bool
    unknown: int
    dummy_prefix: bool
    collapse_spaces: bool


NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def read_model(path: str) -> Spec:
    """Read a ``.model`` file on the driver."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules, trainer = model.normalizer_spec, model.trainer_spec
    spec = Spec(tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces), tuple(p.type for p in model.pieces),
                trainer.model_type == trainer.BPE, trainer.byte_fallback, next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN),
                rules.add_dummy_prefix, rules.remove_extra_whitespaces)
    if rules.precompiled_charsmap or not rules.escape_whitespaces or trainer.treat_whitespace_as_suffix or trainer.model_type not in (trainer.BPE, trainer.UNIGRAM):
        raise ValueError(f"{path}: models with a character map, space suffixes or other types than BPE and unigram are not supported")
    if USER_DEFINED in spec.types or UNUSED in spec.types:
        raise ValueError(f"{path}: models with user-defined or unused pieces are not supported")
    if any(MARK in p.lstrip(MARK) for p in spec.pieces):
        raise ValueError(f"{path}: a piece goes over a word boundary")
    return spec


class Transducers:
    """The compiled model; encodes words and decodes ids."""

    def __init__(self, spec: Spec):
        self.spec = spec
        normal = [(p, i) for i, (p, t) in enumerate(zip(spec.pieces, spec.types)) if t == NORMAL]
        self.id = dict(normal)
        self.score = spec.scores
        self.known = set("".join(self.id))
        self.alone = {p for p in self.id if len(p) == 1}
        self.unknown_weight = UNKNOWN_PENALTY - min((spec.scores[i] for i in self.id.values()), default=0.0)
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(spec.pieces, spec.types)) if t == BYTE}
        self.surface = [b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN else bytes([int(p[3:5], 16)]) if t == BYTE
                        else p.replace(MARK, " ").encode() for p, t in zip(spec.pieces, spec.types)]
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)
        # the lexicon: nested dicts of characters, a final state has its piece's id under FINAL; a
        # BPE piece that merging never makes is on no path
        self.lexicon: dict = {}
        self.longest = max(map(len, self.id), default=0)
        for piece, i in self.id.items():
            if not spec.bpe or self.merged(piece) == [piece]:
                state = self.lexicon
                for char in piece:
                    state = state.setdefault(char, {})
                state[FINAL] = i
        # a line break and any other unknown character is a word of its own at the least
        self.cut = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+" if "\n" not in self.known else f"{MARK}*[^{MARK}]+|{MARK}+")

    # -- the normaliser

    def normalise(self, text: str) -> str:
        if self.spec.collapse_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        text = text.replace(" ", MARK)
        return MARK + text if self.spec.dummy_prefix and text else text

    # -- the lattice of a word

    def arcs(self, word: str, at: int) -> list[tuple[int, int]]:
        """(end, id) of the pieces that start here, the shortest first."""
        out, state = [], self.lexicon
        for end in range(at, len(word)):
            state = state.get(word[end])
            if state is None:
                break
            if FINAL in state:
                out.append((end + 1, state[FINAL]))
        return out

    def fallback(self, char: str) -> list[int]:
        if not self.spec.byte_fallback:
            return [self.spec.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def merged(self, text: str) -> list[str]:
        """What merging by score, the leftmost of equals first, makes of the characters."""
        parts = list(text)
        while len(parts) > 1:
            best, where = -math.inf, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and self.score[i] > best:
                    best, where = self.score[i], k
            if where < 0:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Arc of the neighbour transducer: the boundary survives the merging of both."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        a, b = self.spec.pieces[left], self.spec.pieces[right]
        self.pairs[left << 32 | right] = found = self.merged(a + b) == [a, b]
        return found

    def bpe_path(self, word: str) -> list[int]:
        """The one path through the lattice and the neighbour transducer."""
        n, known, lexicon, most = len(word), self.pairs.get, self.lexicon, self.longest
        path: list[int] = []
        ends, choices, dead = [0], [], set()
        last = None
        while ends[-1] < n:
            if len(choices) < len(ends):  # the arcs from here
                choice, state, end = [], lexicon, ends[-1]
                for char in word[end : end + most]:
                    state = state.get(char)
                    if state is None:
                        break
                    end += 1
                    if FINAL in state:
                        choice.append((end, state[FINAL]))
                choices.append(choice)
            else:
                choice = choices[-1]
            while choice:
                end, piece = choice.pop()  # the longest piece first
                if last is not None:
                    stays = known(last << 32 | piece)
                    if not (self.stays(last, piece) if stays is None else stays):
                        continue
                if dead and (piece, end) in dead:
                    continue
                path.append(piece)
                ends.append(end)
                last = piece
                break
            else:
                dead.add((path.pop(), ends.pop()))  # no path from here, whatever came before
                choices.pop()
                last = path[-1] if path else None
        return path

    def unigram_path(self, word: str) -> list[str]:
        """Viterbi: least sum of negative scores, of equals the one with the longest last piece."""
        n = len(word)
        cost, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for at in range(n):
            steps = [(end, -self.score[i]) for end, i in self.arcs(word, at)]
            if word[at] not in self.id:
                steps.append((at + 1, self.unknown_weight))
            for end, weight in steps:
                if cost[at] + weight < cost[end]:
                    cost[end], back[end] = cost[at] + weight, at
        path, end = [], n
        while end:
            path.append(word[back[end] : end])
            end = back[end]
        return path[::-1]

    def encode_word(self, word: str) -> list[int]:
        if not self.spec.bpe:
            return [i for p in self.unigram_path(word) for i in ([self.id[p]] if p in self.id else self.fallback(p))]
        if self.alone.issuperset(word):
            return self.bpe_path(word)
        out, start = [], 0
        for at, char in enumerate(word + "\0"):  # runs of characters that stand for themselves
            if at == len(word) or char not in self.id:
                out += self.bpe_path(word[start:at])
                out += self.fallback(char) if at < len(word) else []
                start = at + 1
        return out

    # -- texts

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        if len(self.memo) > MEMO:  # words that come again soon are taken over, the others forgotten
            self.memo, self.older, self.seen = {}, self.memo, bytearray(SEEN)
        memo, older, seen, out = self.memo, self.older, self.seen, []
        for word in self.cut.findall(self.normalise(text)):
            ids = memo.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is not None:
                    memo[word] = ids
                else:
                    ids = array("i", self.encode_word(word)).tobytes()
                    slot = hash(word) % SEEN
                    if seen[slot]:  # most words that come once never come again
                        memo[word] = ids
                    seen[slot] = 1
            out.append(ids)
        return b"".join(out)

    def decode(self, ids) -> str:
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        if self.spec.dummy_prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


def compiled(spec: Spec) -> Transducers:
    """The model of this Python worker: compiled once, its memory kept from task to task."""
    kept = sys.modules.setdefault("_tillwork_compiled_models", types.ModuleType("_tillwork_compiled_models")).__dict__
    key = str(hash(spec))
    if key not in kept:
        kept[key] = Transducers(spec)
    return kept[key]


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``ids array<int>, n_tokens long, round_trip boolean`` (underscores appended
    where ``docs`` has such a column); round_trip: decoding gives the text again.

    A null or empty text has no ids (and round-trips as the empty text); equal texts get equal
    ids; other columns stay as they are.
    """
    spec, columns, names = read_model(model_path), docs.columns, free_name(docs, out, "n_tokens", "round_trip")
    sent = docs.sparkSession.sparkContext.broadcast(dataclasses.astuple(spec))
    place = columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        model = compiled(Spec(*sent.value))  # plain tuples travel: executors need no copy of this package
        for batch in batches:
            for lo, hi in row_chunks(utf8(batch.column(place))[1]):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(place).to_pylist()]
                encoded = [model.encode(t) for t in texts]
                n = [len(e) // 4 for e in encoded]
                flat = np.frombuffer(b"".join(encoded), np.int32)
                ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                ids = flat.tolist()
                same = [model.decode(ids[a:b]) == t for t, a, b in zip(texts, ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(n, pa.int64()), pa.array(same)], [*columns, *names])

    kinds = ("array<int>", "long", "boolean")
    return docs.mapInArrow(run, docs.select("*", *(F.lit(None).cast(k).alias(c) for k, c in zip(kinds, names))).schema)


def decode_ids(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``out`` (null for null); bytes that are no UTF-8 become U+FFFD."""
    spec, columns, (name,) = read_model(model_path), df.columns, free_name(df, out)
    sent = df.sparkSession.sparkContext.broadcast(dataclasses.astuple(spec))
    place = columns.index(ids_col)

    def run(batches):
        import pyarrow as pa

        model = compiled(Spec(*sent.value))  # plain tuples travel: executors need no copy of this package
        for batch in batches:
            text = [None if ids is None else model.decode(ids) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], [*columns, name])

    return df.mapInArrow(run, df.select("*", F.lit(None).cast("string").alias(name)).schema)
