"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean query over the trigrams that any of its
matches must hold, in lower case: an OR of ANDs.  A block of documents is indexed by those
trigrams (trigram -> the documents that hold it), postings are intersected and united, and
only the candidates are verified with the expression.  A rule whose matches need no
trigram is run on every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.words import row_chunks, utf8

#: a set of exact strings or a query with more members is given up for a weaker, still sound one
MOST = 64
#: a character class with more members is taken as any character
CLASS = 16


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds and further well-known token formats, in the order of their report.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_RULES = (
    Rule("assign", ASSIGN, group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a run of 16 or more; shorter runs never start or extend a match
)
MORE_RULES = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

# -- trigram queries: None is "any document"; else a set of alternatives, each a set of trigrams


def _least(query):
    """Without alternatives that another one implies."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _and(p, q):
    if p is None or q is None:
        return q if p is None else p
    both = _least({a | b for a in p for b in q})
    return both if len(both) <= MOST else min(p, q, key=len)


def _or(queries):
    if any(q is None for q in queries):
        return None
    either = _least(frozenset().union(*queries))
    return either if len(either) <= MOST else None


def _of_strings(strings):
    """The query of texts that hold one of the strings."""
    grams = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return None if not all(grams) else _or([frozenset([g]) for g in grams])


def _members(node) -> list[str] | None:
    """The characters of a class, lower-cased; None for a large or negated one."""
    found: set[int] = set()
    for op, value in node:
        name = str(op)
        if name == "LITERAL":
            found.add(value)
        elif name == "RANGE" and value[1] - value[0] < 2 * CLASS:
            found.update(range(value[0], value[1] + 1))
        else:
            return None
    strings = {_fold(chr(c)) for c in found}
    return sorted(strings) if len(strings) <= CLASS else None


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _walk(tree):
    """(exact strings or None, query) of a parsed expression."""
    run, query = {""}, None  # strings that the items since the last inexact one can be
    exact = True
    for op, value in tree:
        name, strings, part = str(op), None, None
        if name == "LITERAL":
            strings = {_fold(chr(value))}
        elif name == "IN":
            strings = _members(value)
        elif name == "SUBPATTERN":
            strings, part = _walk(value[-1])
        elif name == "BRANCH":
            ways = [_walk(x) for x in value[1]]
            part = _or([q if s is None else _of_strings(s) for s, q in ways])
            if all(s is not None for s, _ in ways):
                strings = set().union(*(s for s, _ in ways))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            once, part = _walk(inner)
            if once is not None and high == 1:
                strings = set(once) | ({""} if low == 0 else set())
            elif once is not None and low:
                part = _of_strings(once)
            part = part if low else None
        elif name == "AT":
            strings = {""}
        if strings is not None and len(strings) * len(run) <= MOST:
            run = {a + b for a in run for b in strings}
        else:
            exact = False
            query = _and(_and(query, _of_strings(run)), _of_strings(strings) if strings is not None else part)
            run = {""}
    if exact:
        return run, None
    return None, _and(query, _of_strings(run))


def trigram_query(pattern: str):
    """The OR of ANDs of lower-case trigrams that every match holds; None if there is none."""
    strings, query = _walk(re._parser.parse(pattern, re.ASCII))
    return query if strings is None else _of_strings(strings)


class Scanner:
    """The compiled rules, applied to blocks of texts."""

    def __init__(self, rules=RULES):
        self.rules = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
        grams = sorted({g.encode() for _, _, q in self.rules if q is not None for a in q for g in a if g.isascii()})
        self.grams = {g.decode(): i + 1 for i, g in enumerate(grams)}
        self.slot = np.zeros(1 << 24, np.uint16)
        for i, g in enumerate(grams):
            self.slot[g[0] << 16 | g[1] << 8 | g[2]] = i + 1

    def postings(self, raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """For each trigram of the rules, the texts of the block that hold it."""
        fold = np.arange(256, dtype=np.uint32)
        fold[65:91] += 32
        text = fold[raw[off[0] : off[-1]]]
        off = off - off[0]
        slot = self.slot[text[:-2] << 16 | text[1:-1] << 8 | text[2:]] if len(text) > 2 else np.empty(0, np.uint16)
        at = np.flatnonzero(slot)
        doc = np.searchsorted(off, at, "right") - 1
        inside = at + 3 <= off[doc + 1]
        slot, doc = slot[at[inside]], doc[inside]
        pairs = np.unique(slot.astype(np.int64) << 32 | doc)
        cut = np.searchsorted(pairs >> 32, np.arange(len(self.grams) + 2))
        return [pairs[lo:hi] & 0xFFFFFFFF for lo, hi in zip(cut, cut[1:])]

    def candidates(self, query, postings, n: int) -> np.ndarray:
        if query is None:
            return np.arange(n)
        found = np.empty(0, np.int64)
        for grams in query:
            lists = sorted((postings[self.grams[g]] if g in self.grams else np.arange(n) for g in grams), key=len)
            hits = lists[0]
            for other in lists[1:]:
                hits = np.intersect1d(hits, other, assume_unique=True)
            found = np.union1d(found, hits)
        return found

    def spans(self, texts) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of each text of an Arrow string array, in order; code points."""
        raw, off = utf8(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        postings = self.postings(raw, off)
        text = [x or "" for x in texts.to_pylist()]
        for number, (rule, pattern, query) in enumerate(self.rules):
            for i in self.candidates(query, postings, len(text)):
                for m in pattern.finditer(text[i]):
                    if len(m[rule.group]) >= rule.least:
                        out[i].append((m.start(), number, m.end()))
        for row in out:
            row.sort()
        return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per row: ``doc_id, spans`` with ``spans array<struct<kind, start, stop>>`` by start,
    then rule; code points, stop exclusive.  A null or empty text has none, equal rows get
    equal rows, a null doc_id stays null; other columns are ignored."""

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(rules)
        kinds = [r.kind for r in rules]
        for batch in batches:
            _, off = utf8(batch.column(1))
            for lo, hi in row_chunks(off):
                found = scanner.spans(batch.column(1).slice(lo, hi - lo))
                flat = [x for row in found for x in row]
                spans = pa.StructArray.from_arrays([
                    pa.array([kinds[k] for _, k, _ in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int64()),
                    pa.array([b for _, _, b in flat], pa.int64())], ["kind", "start", "stop"])
                ends = np.concatenate(([0], np.cumsum([len(row) for row in found]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), spans)], ["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, stop: long>>")


def redact_secrets(docs: DataFrame, text_col: str = "text", rules=RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each maximal run of overlapping spans in ``text_col`` replaced by ``mark``;
    every other column, and a null text, stays as it is."""
    place = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(rules)
        for batch in batches:
            _, off = utf8(batch.column(place))
            for lo, hi in row_chunks(off):
                part = batch.slice(lo, hi - lo)
                text = part.column(place).to_pylist()
                for i, spans in enumerate(scanner.spans(part.column(place))):
                    if spans:
                        text[i] = cut(text[i], spans, mark)
                columns = list(part.columns)
                columns[place] = pa.array(text, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def cut(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, end = [], 0
    for start, _, stop in spans:
        if start >= end:
            out += [text[end:start], mark]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")
