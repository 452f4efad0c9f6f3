"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, names and units are typed placeholders whose values
are slots, other words are lower-cased without outer punctuation, bare punctuation goes.
Scripts without spaces are cut into letters.  Windows of template tokens are hash-joined with
the benchmark's; an item without one is joined as a whole.  A document holds an item
if enough windows of one occurrence match with consistent slots: one slot value of the item
stands for one value there and the other way round, so a question with other numbers counts and
a chance template match does not.  Several variants of an item in one document do not mix.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from copy import copy
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.spark_util import free_name
from tillwork.llm.words import U, Words, mix, row_chunks, utf8

WIDTH = 8
#: a window needs this many words that are no placeholders
PLAIN = 4
#: windows of the benchmark that are broadcast at most; more are joined by shuffle
BROADCAST_WINDOWS = 200_000
#: an item counts from this share of its windows, or from a run of 13 tokens
SHARE, RUN = 0.5, 13
MEMO = 150_000

# Number words and units.
NUMBER_WORDS = frozenset("""zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion""".split())
UNITS = frozenset("""kg mg km cm mm ml lb lbs oz mph kmh kwh kw mb gb tb hz khz mhz ghz gram grams kilogram kilograms
meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet yard yards liter
liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
cent cents dollar dollars euro euros pound pounds percent degree degrees""".split())

NUMBER = re.compile(r"[$€£+-]*(\d[\d.,:/]*)(%|[a-z]+)?")
OUTER = re.compile(r"^[^\w$€£%+-]+|[^\w%]+$")
#: a letter, with its marks, of a script without spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, Han, kana
UNSPACED = re.compile(
    "[\u0e01-\u0e4f\u0e5a-\u0ecf\u0edc-\u0f1f\u0f34-\u103f\u104a-\u108f\u109a-\u109f\u1780-\u17df\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"
    "[\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u0eb1\u0eb4-\u0ebc\u0ec8-\u0ece\u0f71-\u0f87\u0f8d-\u0fbc\u102b-\u103e\u1056-\u1060\u1062-\u1064"
    "\u1067-\u106d\u1071-\u1074\u1082-\u108f\u109a-\u109d\u17b4-\u17d3\u3099\u309a\uff9e\uff9f\ufe00-\ufe0f]*")
PLAIN_KIND, NUM_KIND, UNIT_KIND, SKIP_KIND = 0, 1, 2, 3


def classify(word: str) -> tuple[int, str, str, bool, bool]:
    """(kind, template token, slot value, capitalised, ends a sentence) of a word."""
    if word.isalpha():  # most words: nothing to strip, no end of a sentence
        low = word if word.islower() else word.lower()
        if low not in NUMBER_WORDS and low not in UNITS:
            return PLAIN_KIND, low, low, low is not word and word[0].isupper() and word[1:].islower(), False
    if UNSPACED.fullmatch(word) and word[0].isalnum():  # its marks are part of it
        return PLAIN_KIND, word, word, False, False
    ends = word.rstrip("\"')]”’").endswith((".", "!", "?", ":"))
    core = OUTER.sub("", word)
    low = core.lower()
    if not any(c.isalnum() for c in core):
        return SKIP_KIND, "", "", False, ends
    m = NUMBER.fullmatch(low)
    if m and (m[2] is None or m[2] == "%" or m[2] in UNITS):
        return NUM_KIND, "<num>" if m[2] is None else "<num><unit>", low.strip("$€£+"), False, ends
    if low in NUMBER_WORDS:
        return NUM_KIND, "<num>", low, False, ends
    if low in UNITS:
        return UNIT_KIND, "<unit>", low, False, ends
    return PLAIN_KIND, low, low, core[0].isupper() and core[1:].islower(), ends


def words_of(text: str) -> list[str]:
    """The words between spaces; scripts that put none between words are cut into letters."""
    if not text.isascii() and UNSPACED.search(text):
        text = UNSPACED.sub(r" \g<0> ", text)
    return text.split()


def code_of(token: str) -> int:
    data = token.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 32 | zlib.crc32(b"#" + data[::-1])


class Vocabulary(dict):
    """Word -> index into the arrays of what classify() says; forgotten when it gets large."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.rows: list[tuple] = []
        self.arrays = [np.empty(0, t) for t in (U, np.int8, np.int8, np.int8, U)]

    def columns(self) -> list[np.ndarray]:
        """(code, kind, capital, ends, code of the value) by index."""
        new = self.rows[len(self.arrays[0]) :]
        self.arrays = [np.concatenate((a, np.array([r[k] for r in new], a.dtype))) for k, a in enumerate(self.arrays)]
        return self.arrays

    def __missing__(self, word):
        kind, token, value, capital, ends = classify(word)
        code = code_of(token)
        self.rows.append((code, kind, capital, ends, code if value == token else code_of(value), value))
        self[word] = len(self.rows) - 1
        return len(self.rows) - 1


NAME_CODE = 0x6E616D65


class Templates(Words):
    """Template tokens of some texts, with the windows and rolling hashes of ``Words``."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        if len(vocabulary) > MEMO:
            vocabulary.forget()
        split = [words_of(t) for t in texts]
        at = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(split)), np.int64)
        code, kind, capital, ends = (column[at] for column in vocabulary.columns()[:4])
        count = np.array([len(ws) for ws in split], np.int64)
        first = np.concatenate(([0], np.cumsum(count)))
        opens = np.concatenate(([1], ends[:-1])) if len(at) else ends
        opens[first[:-1][count > 0]] = 1
        name = (capital == 1) & (opens == 0)
        code[name] = NAME_CODE
        stay = kind != SKIP_KIND
        self.at, self.vocabulary = at[stay], vocabulary
        self.plain, self.slot = ((kind == PLAIN_KIND) & ~name)[stay], ((kind != PLAIN_KIND) | name)[stay]
        self._hash = mix(code[stay])
        self.first = np.concatenate(([0], np.cumsum(stay)))[first]
        self.count = np.diff(self.first)

    def matching_windows(self, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first token, hash) of the windows with enough plain words."""
        doc, begin = self.windows(width)
        plain = np.concatenate(([0], np.cumsum(self.plain)))
        keep = plain[begin + width] - plain[begin] >= min(PLAIN, width)
        doc, begin, value = doc[keep], begin[keep], self.rolling(begin, width)[keep]
        return doc, begin, value

    def whole_hash(self, begin: np.ndarray, form: int) -> np.ndarray:
        """Hash of the sequences of ``form // 2`` tokens, of their values if ``form`` is odd."""
        view = copy(self)
        if form % 2:
            view._hash = mix(self.vocabulary.columns()[4][self.at])
        return mix(view.rolling(begin, form // 2) + U(form))

    def item_windows(self) -> tuple[np.ndarray, ...]:
        """(text, first token, form, hash) of the matching windows, form 0.  A text that has none
        has its whole sequence as its only window; its form is twice the number of its tokens,
        and one more if few words are plain and the values must be equal."""
        doc, begin, value = self.matching_windows()
        plain = np.concatenate(([0], np.cumsum(self.plain)))
        rest = np.setdiff1d(np.flatnonzero(self.count > 0), doc)
        few = plain[self.first[rest + 1]] - plain[self.first[rest]] < PLAIN
        form = 2 * self.count[rest] + few
        parts = [(doc, begin, np.zeros(len(doc), np.int64), value)]
        for f in np.unique(form):
            which = rest[form == f]
            parts.append((which, self.first[which], np.full(len(which), f, np.int64), self.whole_hash(self.first[which], int(f))))
        return tuple(map(np.concatenate, zip(*parts)))

    def document_windows(self, forms: list[int]) -> tuple[np.ndarray, ...]:
        """(text, first token, form, hash) of the matching windows and of every sequence of the forms."""
        doc, begin, value = self.matching_windows()
        parts = [(doc, begin, np.zeros(len(doc), np.int64), value)]
        for f in forms:
            doc, begin = self.windows(f // 2)
            parts.append((doc, begin, np.full(len(doc), f, np.int64), self.whole_hash(begin, f)))
        return tuple(map(np.concatenate, zip(*parts)))

    def slots(self, begin: int, form: int = 0) -> list[str]:
        rows = self.vocabulary.rows
        return [rows[self.at[i]][5] if self.slot[i] else "" for i in range(begin, begin + (form // 2 or WIDTH))]


def window_table(docs: DataFrame, id_col: str, text_col: str, key: list[str] = [], forms: list[int] | None = None) -> DataFrame:  # noqa: B006
    """(id, *key, pos, form, hash, slots) of every window, for the join by shuffle (with the forms
    of the benchmark's whole items) and for the benchmark (without)."""

    def run(batches):
        import pyarrow as pa

        vocabulary = Vocabulary()
        for batch in batches:
            for lo, hi in row_chunks(utf8(batch.column(1))[1]):
                t = Templates([x or "" for x in batch.column(1).slice(lo, hi - lo).to_pylist()], vocabulary)
                doc, begin, form, value = t.item_windows() if forms is None else t.document_windows(forms)
                index = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(index), *(batch.column(2 + k).take(index) for k in range(len(key))), pa.array(begin - t.first[doc]),
                    pa.array(form), pa.array(value.view(np.int64)), pa.array([t.slots(b, f) for b, f in zip(begin.tolist(), form.tolist())], pa.list_(pa.string()))],
                    ["id", *key, "pos", "form", "hash", "slots"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *key).mapInArrow(
        run, "id long, " + "".join(f"{k} long, " for k in key) + "pos long, form long, hash long, slots array<string>")


def consistent_windows(found: list[tuple[int, int, list]], seed: int | None = None) -> int:
    """Number of item positions whose slots fit one mapping of values, voted for by the hits
    (alignment, item position, slot pairs); those nearer to the alignment ``seed`` vote first."""
    votes = Counter((0 if seed is None else abs(shift - seed), p) for shift, _, pairs in found for p in pairs)
    to, back = {}, {}
    for (_, (a, b)), _ in sorted(votes.items(), key=lambda v: (v[0][0], -v[1], v[0][1])):
        if a not in to and b not in back:
            to[a], back[b] = b, a
    return len({pos for _, pos, pairs in found if all(to.get(a) == b for a, b in pairs)})


def held_items(hits: list[tuple], windows: dict[int, int]) -> dict[int, float]:
    """Items that a document holds, with the share of their windows it holds.

    hits -- (item, item position, the item's slots, the document's slots, document position) of
    matching windows; without the last they lie in the document as in the item;
    windows -- the number of windows of each item.

    Every occurrence is judged by itself: its windows lie at one alignment of document and item,
    and words put in or left out move it by less than the item's length.  The windows of the
    whole text are judged together, too, for an item whose parts lie far apart.
    """
    by_item = defaultdict(list)
    for item, pos, theirs, ours, *at in hits:
        by_item[item].append(((at[0] if at else pos) - pos, pos, [(a, b) for a, b in zip(theirs, ours) if a or b]))
    out = {}
    for item, found in by_item.items():
        least, most = min(RUN - WIDTH + 1, SHARE * windows[item]), len({pos for _, pos, _ in found})
        if most < least:
            continue
        n = consistent_windows(found)
        if n < most:
            found.sort(key=lambda f: f[:2])
            shifts, reach = [f[0] for f in found], max(f[1] for f in found) + WIDTH - 1
            for shift, _ in Counter(shifts).most_common():
                near = found[bisect_left(shifts, shift - reach) : bisect_right(shifts, shift + reach)]
                if len({f[1] for f in near}) > n:
                    n = max(n, consistent_windows(near, shift))
                if n == most:
                    break
        if n >= least:
            out[item] = min(1.0, n / windows[item])
    return out


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` with ``contaminated boolean, items array<long>, coverage double`` (underscores
    appended where ``docs`` has such a column): the benchmark items each row's text holds,
    ascending, and the largest share of an item's windows found.

    A null or empty text holds none.  An item without a window (fewer than ``WIDTH`` template
    tokens, or nowhere ``PLAIN`` plain words in one) is found where its whole sequence of tokens
    comes, however short; with fewer than ``PLAIN`` plain words in all the values must be equal.
    Items of a null id or text, or of punctuation only, are never found; equal items are all reported; equal
    rows get equal results; an empty benchmark flags nothing.
    """
    spark = docs.sparkSession
    theirs = window_table(benchmark.where(F.col(item_col).isNotNull()).dropDuplicates([item_col, item_text_col]), item_col, item_text_col)
    names = free_name(docs, "contaminated", "items", "coverage")
    if theirs.count() <= broadcast_windows:
        return _flag_by_broadcast(docs, text_col, names, sorted(tuple(r) for r in theirs.select("hash", "id", "pos", "slots", "form").collect()))
    counts = theirs.groupBy("id").agg(F.count("*").alias("windows"))
    rid, rkey = free_name(docs, "row_id", "row_key")
    keyed = docs.withColumn(rid, F.xxhash64(text_col)).withColumn(rkey, F.hash(text_col).cast("long"))
    # equal texts hold equal items: a text is judged once, by two hashes of it
    texts = keyed.dropDuplicates([rid, rkey]).select(F.col(rid).alias("row_id"), F.col(rkey).alias("row_key"), F.col(text_col).alias("text"))
    forms = sorted(r[0] for r in theirs.where("form > 0").select("form").distinct().collect())
    ours = window_table(texts, "row_id", "text", ["row_key"], forms).drop("form")
    hits = (ours.join(theirs.select("hash", F.col("id").alias("item"), F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots")), "hash")
            .join(counts.withColumnRenamed("id", "item"), "item"))

    def judge(key, table):
        import pyarrow as pa

        rows = table.select(["item", "item_pos", "item_slots", "slots", "pos"]).to_pylist()
        found = held_items([(r["item"], r["item_pos"], r["item_slots"], r["slots"], r["pos"]) for r in rows],
                           dict(zip(table["item"].to_pylist(), table["windows"].to_pylist())))
        rows = [(key[0].as_py(), key[1].as_py(), i, s) for i, s in found.items()]
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                        names=["id", "row_key", "item", "share"])

    # one document and item at a time: bounded by the two texts
    held = (hits.groupBy("id", "row_key", "item").applyInArrow(judge, "id long, row_key long, item long, share double")
            .groupBy("id", "row_key").agg(F.sort_array(F.collect_set("item")).alias("found"), F.max("share").alias("most")))
    joined = keyed.join(held.select(F.col("id").alias(rid), F.col("row_key").alias(rkey), "found", "most"), [rid, rkey], "left")
    empty = F.array().cast("array<long>")
    return joined.select(*docs.columns, F.col("found").isNotNull().alias(names[0]), F.coalesce("found", empty).alias(names[1]),
                         F.coalesce("most", F.lit(0.0)).alias(names[2]))


def _flag_by_broadcast(docs: DataFrame, text_col: str, names: list[str], theirs: list[tuple]) -> DataFrame:
    windows, forms = dict(Counter(t[1] for t in theirs)), sorted({t[4] for t in theirs} - {0})
    sent = docs.sparkSession.sparkContext.broadcast((np.array([t[0] for t in theirs], np.int64), [t[:4] for t in theirs], windows))
    columns = docs.columns
    place = columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        keys, theirs, windows = sent.value
        vocabulary = Vocabulary()
        for batch in batches:
            for lo, hi in row_chunks(utf8(batch.column(place))[1]):
                part = batch.slice(lo, hi - lo)
                t = Templates([x or "" for x in part.column(place).to_pylist()], vocabulary)
                doc, begin, form, value = t.document_windows(forms)
                value = value.view(np.int64)
                left, right = np.searchsorted(keys, value, "left"), np.searchsorted(keys, value, "right")
                hits = defaultdict(list)
                for i in np.flatnonzero(right > left):
                    ours, at = t.slots(begin[i], form[i]), int(begin[i] - t.first[doc[i]])
                    hits[doc[i]] += [(*theirs[k][1:], ours, at) for k in range(left[i], right[i])]
                held = {d: held_items(h, windows) for d, h in hits.items()}
                items = [sorted(held.get(i, ())) for i in range(hi - lo)]
                most = [max(held[i].values()) if x else 0.0 for i, x in enumerate(items)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([bool(x) for x in items]), pa.array(items, pa.list_(pa.int64())), pa.array(most, pa.float64())],
                    [*columns, *names])

    kinds = ("boolean", "array<long>", "double")
    schema = docs.select("*", *(F.lit(None).cast(k).alias(n) for k, n in zip(kinds, names))).schema
    return docs.mapInArrow(run, schema)
