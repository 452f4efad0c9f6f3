"""Personal data by information-theoretic sanitisation.  DataFrame functions only.

Emails, IP addresses, card and phone numbers are the protected entities.  A term is a run of
letters, lower-cased.  Counts are of distinct texts, so that copies of a text are one witness:
n(c) texts hold entity c, n(t) term t, n(c, t) have t within ``REACH`` characters of c, of N in
all.  The information of c is IC(c) = log2(N / n(c)); t discloses PMI(c; t) = log2(n(c, t) N /
(n(c) n(t))) bits of it, at most IC(c).  A term that discloses a share ``alpha`` of any entity's
information goes wherever it stands: it is generalised to its first letters if all terms that
begin so disclose less than that share, counted among the texts that tell of any entity, else
removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.spark_util import materialise

#: characters on either side of an entity in which terms count as told with it
REACH = 100
#: share of an entity's information that a term may not disclose
ALPHA = 0.95
#: texts that must hold entity and term together; fewer are chance
SUPPORT = 3
#: letters of the shortest term, and of a generalised one
LEAST_TERM, STEM = 3, 3
#: a list is broadcast up to this many rows of a term or a text's terms; a longer one is joined by shuffle
BROADCAST_ROWS = 200_000
#: elements that a running sum takes at once, code points of a block
BLOCK = 128

# The kinds in the order of their report, their patterns (possessive and anchored,
# so that no text takes quadratic time; the matches are those of the plain patterns), and marks.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: what every match that counts holds
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
GONE = "[…]"
SPAN = "struct<start: long, place: int, stop: long, value: string, near: string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running result of ``op`` over an array of longs, block by block, in linear time."""
    none = F.array().cast("array<long>")

    def scan(block: Column) -> Column:
        def step(done: Column, x: Column) -> Column:
            return F.array_append(done, F.when(F.size(done) == 0, x).otherwise(op(F.try_element_at(done, F.lit(-1)), x)))
        return F.aggregate(block, none, step)

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(v) - 1, F.lit(BLOCK))
        return F.transform(starts, lambda i: scan(F.slice(v, i + 1, BLOCK)))

    def joined(within: Column) -> Column:
        ends = scan(F.transform(within, lambda w: F.try_element_at(w, F.lit(-1))))
        return let(ends, lambda e: F.flatten(F.transform(
            within, lambda w, i: F.when(i == 0, w).otherwise(F.transform(w, lambda x: op(F.get(e, i - 1), x))))))

    return let(values, lambda v: F.when(F.size(v) == 0, none).otherwise(let(blocks(v), joined)))


def add(a: Column, b: Column) -> Column:
    return a + b


def with_places(parts: Column, found: Column, build: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``build(start, match, part before, part after)`` of each match, in code points."""
    lengths = lambda p, m: F.transform(m, lambda x, i: (F.char_length(F.get(p, i)) + F.char_length(x)).cast("long"))
    return let(parts, lambda p: let(found, lambda m: let(running(lengths(p, m), add), lambda ends: F.transform(
        m, lambda x, i: build(F.get(ends, i) - F.char_length(x), x, F.get(p, i), F.get(p, i + 1))))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether up to 20 digits have a Luhn sum divisible by ten."""
    padded = F.lpad(number, 20, "0")

    def step(total: Column, i: Column) -> Column:
        d = F.substring(padded, i, F.lit(1)).try_cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), step) % 10 == 0


def holds(kind: str, value: Column) -> Column:
    """Whether a match counts."""
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    n = F.length(digits(value))
    if kind == "card":
        return (n >= 12) & (n <= 19) & luhn(digits(value))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    """One spelling of a protected value."""
    if kind == "ip":
        return F.regexp_replace(value, r"(?<![0-9])0+(?=[0-9])", "")
    return F.lower(value) if kind == "email" else digits(value)


def spans_of(kind: str, text: Column, reach: int) -> Column:
    """Spans of one kind, with the entity and the text around it, up to the next match of the kind."""
    before = lambda p: F.when(F.char_length(p) > reach, F.regexp_replace(F.right(p, F.lit(reach)), r"^\p{L}+", "")).otherwise(p)
    after = lambda p: F.when(F.char_length(p) > reach, F.regexp_replace(F.left(p, F.lit(reach)), r"\p{L}+$", "")).otherwise(p)
    others = "|".join(PATTERNS[k] for k in ("email", "ip", "phone", "card"))

    def build(start: Column, value: Column, left: Column, right: Column) -> Column:
        near = F.regexp_replace(F.concat_ws(" ", before(left), after(right)), others, " ")
        return F.when(holds(kind, value), F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), (start + F.char_length(value)).alias("stop"),
            F.concat_ws(":", F.lit(kind), entity(kind, value)).alias("value"), near.alias("near")))

    found = with_places(F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), build)
    needed = text.contains(NEEDED[kind]) if kind == "email" else text.rlike(NEEDED[kind])
    return F.when(needed, F.array_compact(found)).otherwise(F.array()).cast(f"array<{SPAN}>")


def base_spans(text: Column, reach: int = REACH) -> Column:
    """Spans of the base kinds by start, then kind."""
    return F.array_sort(F.concat(*(spans_of(kind, text, reach) for kind in KINDS)))


def some_entity(text: Column) -> Column:
    return text.contains("@") | text.rlike("|".join(NEEDED[k] for k in KINDS[1:]))


def terms(text: Column) -> Column:
    return F.filter(F.split(text, r"\P{L}+"), lambda t: F.char_length(t) >= LEAST_TERM)


def _small(df: DataFrame) -> bool:
    return df.count() <= BROADCAST_ROWS


def _narrow(df: DataFrame, listed: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is listed; a list of proven size is broadcast."""
    return df.join(F.broadcast(listed) if _small(listed) else listed, on, "left_semi")


def disclosing_terms(texts: DataFrame, reach: int = REACH, alpha: float = ALPHA, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """((term, generalised), (key, term)): the disclosing terms, with their generalisation or null,
    and the texts that hold them.

    texts -- ``key, text``, of which rows with one key are one text.
    """
    near = (texts.where(some_entity(F.col("text"))).select("key", F.explode(base_spans(F.col("text"), reach)).alias("s"))
            .select("key", F.col("s.value").alias("entity"), F.explode_outer(F.array_distinct(terms(F.col("s.near")))).alias("run"))
            .select("key", "entity", F.lower("run").alias("term")).distinct())
    near = materialise(near)
    total = texts.select("key").distinct().count()
    n_entity = near.select("entity", "key").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    pairs = near.where("term IS NOT NULL").groupBy("entity", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= support)
    least = near.where("term IS NOT NULL").select("term", "key").distinct().groupBy("term").agg(F.count("*").alias("n_t_least"))
    information = F.log2(F.lit(float(total)) / F.col("n_c"))
    told = lambda n: F.log2(F.col("n_ct") * F.lit(float(total)) / (F.col("n_c") * F.col(n)))
    # the texts in which a term is told with any entity are not more than those that hold it
    could = pairs.join(n_entity, "entity").join(least, "term").where(told("n_t_least") >= alpha * information)
    could = materialise(could.select("entity", "term", "n_c", "n_ct"))
    words = texts.select("key", F.explode(F.array_distinct(F.split("text", r"\P{L}+"))).alias("run")).select("key", F.lower("run").alias("term"))
    held = materialise(_narrow(words, could.select("term").distinct(), "term").distinct())
    n_term = held.groupBy("term").agg(F.count("*").alias("n_t"))
    flagged = materialise(could.join(n_term, "term").where(told("n_t") >= alpha * information)
                          .select("entity", "term", "n_c", F.left("term", F.lit(STEM)).alias("stem")))
    # generalised: the first letters, if the terms that begin so disclose less even among the
    # texts that tell of any entity (over all texts they disclose no more)
    stemmed = near.where("term IS NOT NULL").select("entity", F.left("term", F.lit(STEM)).alias("stem"), "key")
    stems = flagged.where(F.char_length("term") > STEM + 1).select("entity", "stem", "n_c").distinct()
    told_stem = stemmed.distinct().join(stems, ["entity", "stem"]).groupBy("entity", "stem", "n_c").agg(F.count("*").alias("n_ct"))
    n_stem = stemmed.select("stem", "key").distinct().groupBy("stem").agg(F.count("*").alias("n_g"))
    worst = told_stem.join(n_stem, "stem").groupBy("stem").agg(F.max((told("n_g") >= alpha * information).cast("int")).alias("worst"))
    general = F.when((F.col("worst") == 0) & (F.col("letters") > STEM + 1), F.concat(F.col("stem"), F.lit("…")))
    listed = (flagged.select("term", "stem", F.char_length("term").alias("letters")).distinct().join(worst, "stem", "left")
              .select("term", general.alias("generalised")))
    return materialise(listed), held.join(flagged.select("term").distinct(), "term", "left_semi")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """One row per row: ``doc_id, spans, sanitised``.

    ``spans array<struct<kind, start, stop, mark>>`` by start, then kind as listed; code points,
    stop exclusive; kinds are the base ones and ``term``.  ``sanitised`` is the text with each
    run of overlapping spans replaced by its first mark: ``[email]``, a term's first letters
    and ``…``, or ``[…]``.  A null or empty text has no spans and stays empty; equal texts get
    equal results; a null doc_id stays null; a very long text is worked in linear time; an
    empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.md5("text"))
    listed, held = disclosing_terms(docs.select("key", "text"), reach, alpha, support)
    mark = F.coalesce("generalised", F.lit(GONE))
    told = materialise(held.join(listed, "term").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("term", mark.alias("mark")))).alias("told")))
    rows = told.agg(F.sum(F.size("told"))).first()[0] or 0
    df = docs.join(F.broadcast(told) if rows <= BROADCAST_ROWS else told, "key", "left")

    span = "array<struct<start: long, place: int, stop: long, mark: string>>"
    text = F.col("text")
    base = F.transform(base_spans(text, reach), lambda s: F.struct(
        s.start.alias("start"), s.place.alias("place"), s.stop.alias("stop"),
        F.concat(F.lit("["), F.get(F.array(*map(F.lit, KINDS)), s.place), F.lit("]")).alias("mark")))
    names = F.transform("told", lambda t: t.term)

    def build(start, run, _, __):
        at = F.array_position(names, F.lower(run)).cast("int")
        return F.struct(start.alias("start"), F.lit(len(KINDS)).alias("place"), (start + F.char_length(run)).alias("stop"),
                        F.when(at > 0, F.get("told", at - 1)["mark"]).alias("mark"))

    runs = with_places(F.split(text, r"\p{L}+", -1), F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0)), build)
    of_terms = F.filter(runs, lambda s: s.mark.isNotNull())
    none = F.array().cast(span)
    base = F.when(some_entity(text), base.cast(span)).otherwise(none)
    df = df.withColumn("__spans", F.array_sort(F.concat(base, F.when(F.col("told").isNotNull(), of_terms.cast(span)).otherwise(none))))
    kinds = F.array(*map(F.lit, (*KINDS, TERM)))
    shown = F.transform("__spans", lambda s: F.struct(F.get(kinds, s.place).alias("kind"), s.start.alias("start"), s.stop.alias("stop"), s.mark.alias("mark")))
    sanitised = F.when(F.size("__spans") == 0, text).otherwise(replaced(text, F.col("__spans")))
    return df.select("doc_id", shown.alias("spans"), sanitised.alias("sanitised"))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans, which are sorted, replaced by its first mark."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def build(cut: Column) -> Column:
        def piece(start: Column, stop: Column) -> Column:
            first = F.floor(start / BLOCK).cast("int")
            some = F.slice(cut, first + 1, (F.floor((stop - 1) / BLOCK).cast("int") - first + 1))
            return F.when(stop > start, F.substring(F.array_join(some, ""), (start % BLOCK + 1).cast("int"), (stop - start).cast("int"))).otherwise(F.lit(""))

        def body(ends: Column) -> Column:
            before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ends, i - 1))
            marked = F.transform(spans, lambda s, i: F.when(s.start >= before(i), F.concat(piece(before(i), s.start), s.mark)).otherwise(F.lit("")))
            last = F.try_element_at(ends, F.lit(-1))
            return F.concat(F.array_join(marked, ""), piece(last, F.char_length(text).cast("long")))
        return let(running(F.transform(spans, lambda s: s.stop), F.greatest), body)
    return let(blocks, build)


def duckdb_sql(table: str, reach: int = REACH, alpha: float = ALPHA, support: int = SUPPORT) -> str:
    """The same in DuckDB SQL, with digests of spans and texts: plain patterns, one row per distinct
    text, positions by running sums over unnested matches."""
    plain = {"email": rf"{LOCAL}+@{LABEL}+(\.{LABEL}+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": PATTERNS["card"].replace("++", "+"), "phone": PATTERNS["phone"]}
    others = "|".join(f"(?:{plain[k]})" for k in ("email", "ip", "phone", "card"))
    found = " UNION ALL ".join(
        f"SELECT key, {place} AS place, '{kind}' AS kind, regexp_extract_all(text, '{plain[kind]}') AS m, regexp_split_to_array(text, '{plain[kind]}') AS p FROM texts"
        for place, kind in enumerate(KINDS))
    digit = "CAST(substr(lpad(d, 20, '0'), CAST(i AS INTEGER), 1) AS INTEGER)"
    return f"""WITH texts AS (SELECT DISTINCT coalesce(text, '') AS text, md5(coalesce(text, '')) AS key FROM {table}),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM texts),
found AS ({found}),
cut AS (SELECT key, place, kind, unnest(m) AS v, unnest(p[1:len(m)]) AS before, unnest(p[2:len(m) + 1]) AS after, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0),
placed AS (SELECT *, sum(length(before) + length(v)) OVER (PARTITION BY key, place ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM cut),
base AS (
  SELECT key, place, kind, CAST(stop - length(v) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
         kind || ':' || CASE kind WHEN 'email' THEN lower(v) WHEN 'ip' THEN array_to_string(list_transform(string_split(v, '.'), lambda x: regexp_replace(x, '^0+([0-9])', '\1')), '.') ELSE d END AS entity,
         regexp_replace(CASE WHEN length(before) > {reach} THEN regexp_replace(right(before, {reach}), '^\p{{L}}+', '') ELSE before END || ' ' ||
                        CASE WHEN length(after) > {reach} THEN regexp_replace(left(after, {reach}), '\p{{L}}+$', '') ELSE after END, '{others}', ' ', 'g') AS near
  FROM placed WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0
    WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, 21), lambda i: CASE WHEN i % 2 = 0 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0
    WHEN 'phone' THEN length(d) BETWEEN 9 AND 15 ELSE true END),
near AS (SELECT DISTINCT key, entity, lower(run) AS term FROM (SELECT key, entity, unnest(regexp_split_to_array(near, '\P{{L}}+')) AS run FROM base) WHERE length(run) >= {LEAST_TERM}),
n_c AS (SELECT entity, count(DISTINCT key) AS n_c FROM base GROUP BY entity),
pairs AS (SELECT entity, term, count(*) AS n_ct FROM near GROUP BY ALL HAVING count(*) >= {support}),
held AS (SELECT DISTINCT key, lower(run) AS term FROM (SELECT key, unnest(regexp_split_to_array(text, '\P{{L}}+')) AS run FROM texts) WHERE lower(run) IN (SELECT term FROM pairs)),
n_t AS (SELECT term, count(*) AS n_t FROM held GROUP BY term),
flagged AS (SELECT entity, term, n_c, left(term, {STEM}) AS stem FROM pairs JOIN n_c USING (entity) JOIN n_t USING (term), total
            WHERE log2(n_ct * total.n / (n_c * n_t)) >= {alpha} * log2(total.n / n_c)),
stems AS (SELECT DISTINCT entity, stem, n_c FROM flagged WHERE length(term) > {STEM + 1}),
near_stem AS (SELECT DISTINCT entity, left(term, {STEM}) AS stem, key FROM near),
n_cg AS (SELECT entity, stem, count(*) AS n_cg FROM near_stem GROUP BY ALL),
n_g AS (SELECT stem, count(DISTINCT key) AS n_g FROM near_stem GROUP BY stem),
worst AS (SELECT stem, bool_or(log2(n_cg * total.n / (n_c * n_g)) >= {alpha} * log2(total.n / n_c)) AS told FROM stems JOIN n_cg USING (entity, stem) JOIN n_g USING (stem), total GROUP BY stem),
listed AS (SELECT DISTINCT term, CASE WHEN length(term) > {STEM + 1} AND NOT told THEN stem || '…' ELSE '{GONE}' END AS mark FROM flagged LEFT JOIN worst USING (stem)),
runs AS (SELECT key, unnest(regexp_extract_all(text, '\\p{{L}}+')) AS v, regexp_split_to_array(text, '\\p{{L}}+') AS p, unnest(range(1, len(regexp_extract_all(text, '\\p{{L}}+')) + 1)) AS i
         FROM texts WHERE key IN (SELECT key FROM held JOIN listed USING (term))),
run_places AS (SELECT key, v, sum(length(p[i]) + length(v)) OVER (PARTITION BY key ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop FROM runs),
spans AS (
  SELECT key, place, kind, start, stop, '[' || kind || ']' AS mark FROM base
  UNION ALL SELECT key, {len(KINDS)}, '{TERM}', CAST(stop - length(v) AS BIGINT), CAST(stop AS BIGINT), mark FROM run_places JOIN listed ON term = lower(v)),
seen AS (SELECT *, coalesce(max(stop) OVER (PARTITION BY key ORDER BY start, place, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM spans),
clean AS (
  SELECT key, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS)},
         coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) FILTER (place < {len(KINDS)}), '') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) AS spans, max(stop) AS done,
         string_agg(CASE WHEN start >= done THEN substr(text, done + 1, start - done) || mark ELSE '' END, '' ORDER BY start, place, stop) AS head
  FROM seen JOIN texts USING (key) GROUP BY key)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       sha256(coalesce(head || substr(text, CAST(done AS BIGINT) + 1), text, '')) AS sanitised_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS key FROM {table}) LEFT JOIN clean USING (key)"""
