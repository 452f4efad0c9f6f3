"""Personal data: base spans, disclosing terms and sanitised texts against a plain model."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from tillwork.llm import pii

SCHEMA = "doc_id long, text string, spans string, key string, sanitised string, told string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, ch in enumerate(reversed(d)):
        v = int(ch) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def counts(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 if kind == "phone" else True


def entity(kind, value):
    if kind == "email":
        return "email:" + value.lower()
    return "ip:" + ".".join(str(int(p)) for p in value.split(".")) if kind == "ip" else f"{kind}:" + re.sub("[^0-9]", "", value)


def base(text, reach):
    """(start, place, stop, entity, near) of each span."""
    out = []
    for place, kind in enumerate(PLAIN):
        found = list(re.finditer(PLAIN[kind], text))
        for i, m in enumerate(found):
            if counts(kind, m.group()):
                left = text[found[i - 1].end() if i else 0 : m.start()]
                right = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)]
                if len(left) > reach:
                    left = regex.sub(r"^\p{L}+", "", left[-reach:])
                if len(right) > reach:
                    right = regex.sub(r"\p{L}+$", "", right[:reach])
                near = re.sub("|".join(f"(?:{PLAIN[k]})" for k in ("email", "ip", "phone", "card")), " ", f"{left} {right}")
                out.append((m.start(), place, m.end(), entity(kind, m.group()), near))
    return sorted(out)


def model(rows, reach=100, alpha=0.95, support=3):
    texts = {t or "" for _, t in rows}
    runs = {t: {w.lower() for w in regex.findall(r"\p{L}+", t)} for t in texts}
    spans = {t: base(t, reach) for t in texts}
    n_c, n_ct, n_cg, n_t, n_g = (defaultdict(set) for _ in range(5))
    for t in texts:
        for _, _, _, c, near in spans[t]:
            n_c[c].add(t)
            for w in (w.lower() for w in regex.findall(r"\p{L}+", near) if len(w) >= 3):
                n_ct[c, w].add(t)
                n_cg[c, w[:3]].add(t)
                n_g[w[:3]].add(t)
        for w in runs[t]:
            n_t[w].add(t)
    total = len(texts)
    tells = lambda c, both, n: math.log2(both * total / (len(n_c[c]) * n)) >= alpha * math.log2(total / len(n_c[c]))
    flagged = {(c, w) for (c, w), both in n_ct.items() if len(both) >= support and tells(c, len(both), len(n_t[w]))}
    bad = {w[:3] for c, w in flagged if len(w) > 4 and tells(c, len(n_cg[c, w[:3]]), len(n_g[w[:3]]))}
    marks = {w: f"{w[:3]}…" if len(w) > 4 and w[:3] not in bad else "[…]" for _, w in flagged}
    out = []
    for i, t in rows:
        t = t or ""
        mine = [(a, k, b, f"[{list(PLAIN)[k]}]") for a, k, b, _, _ in spans[t]]
        mine += [(m.start(), 4, m.end(), marks[m.group().lower()]) for m in regex.finditer(r"\p{L}+", t) if m.group().lower() in marks]
        clean, end = "", 0
        for a, _, b, mark in sorted(mine):
            if a >= end:
                clean += t[end:a] + mark
            end = max(end, b)
        out.append((i, tuple((("email", "ip", "card", "phone", "term")[k], a, b) for a, k, b, _ in sorted(mine)), clean + t[end:]))
    return sorted(out, key=repr), marks


def got(df, **options):
    return sorted(((r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.spans), r.sanitised) for r in pii.sanitise(df, **options).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA)


def told_corpus():
    """Entities told with words of their own, common words, stems that tell and stems that do not."""
    rnd = random.Random(2)
    people = [("Zanthor", "zan.thor@mail.example.com"), ("Quillabeth", "+1 (583) 555-5954"), ("Брунхильда", "10.20.30.40"), ("Wexcombe", "4111 1111 1111 1111")]
    common = ["the", "and", "house", "quiet", "quick", "river", "zander", "market", "übrig", "wexford"]
    texts = []
    for n in range(220):
        words = [rnd.choice(common) for _ in range(rnd.randint(3, 60))]
        if n % 5 == 0:
            name, value = people[n // 5 % 4]
            words[rnd.randrange(len(words)) : 0] = [name + rnd.choice([",", "", "'s"]), rnd.choice(["on", "house"]), value]
        texts.append(" ".join(words) + rnd.choice(["", ".", "\n"]))
    return list(enumerate(texts))


def test_terms_that_tell_an_entity(spark):
    rows = told_corpus()
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(None, rows[10][1]), (7, None), (8, ""), (9, "Zanthor alone, ZANTHOR")]
    want, marks = model(rows)
    assert {"zanthor", "quillabeth", "брунхильда", "wexcombe"} <= set(marks) and not {"the", "house", "river"} & set(marks)
    assert {"[…]", "zan…", "qui…"} & set(marks.values()) >= {"qui…"}
    assert got(frame(spark, rows).repartition(5)) == want
    looser = {"reach": 20, "alpha": 0.5, "support": 2}
    assert got(frame(spark, rows), **looser) == model(rows, **looser)[0]


def test_shuffled_lists_give_the_same(spark, monkeypatch):
    rows = told_corpus()
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert got(frame(spark, rows)) == model(rows)[0]


def odd_texts():
    rnd = random.Random(4)
    bits = ["a@b.c", "a@b", "_d@e.f", ".@x.y", "@", ".", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "001.002.03.4", "4111111111111111", "4111-1111 1111-1111", "4111  1111", "7",
            "+1 (583) 555-5954", "+49 30", "+1.(", "+12345678901234567", "é", "😀", " ", "-", "x", "word", "Ünder", "\n", "0000000000000", "+", "(", "日本"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(400)]


def test_base_spans_of_odd_texts(spark):
    rows = list(enumerate(odd_texts()))
    assert got(frame(spark, rows), support=10**6) == model(rows, support=10**6)[0]


def test_very_long_texts(spark):
    """Linear in the length: the plain patterns take quadratic time on some of these."""
    none = ["1" * 300_000, "a" * 300_000, "a@" * 100_000, "+1" + "(" * 300_000, "1-" * 150_000, "x." * 150_000, "word " * 60_000]
    many = {"1.2.3.4 ": ("ip", 7), "x@y.z,": ("email", 5)}
    rows = list(enumerate(none)) + [(100 + i, t * 30_000) for i, t in enumerate(many)]
    found = {i: (spans, clean) for i, spans, clean in got(frame(spark, rows))}
    for i, text in enumerate(none):
        assert found[i] == ((), text)
    for i, (text, (kind, length)) in enumerate(many.items()):
        assert found[100 + i] == (tuple((kind, k * len(text), k * len(text) + length) for k in range(30_000)), (f"[{kind}]" + text[length:]) * 30_000)


def test_empty_tables(spark):
    assert pii.sanitise(frame(spark, [])).collect() == []
    assert got(frame(spark, [(1, "nothing here"), (2, None)])) == [(1, (), "nothing here"), (2, (), "")]


def test_running(spark):
    n = 5 * pii.BLOCK + 3
    for size in (0, 1, pii.BLOCK, pii.BLOCK + 1, n):
        row = spark.range(1).select(pii.running(F.array(*[F.lit(i % 7).cast("long") for i in range(size)]).cast("array<long>"), pii.add).alias("v")).first()
        want, total = [], 0
        for i in range(size):
            total += i % 7
            want.append(total)
        assert row.v == want


def test_query_columns(spark, tmp_path):
    from tillwork.llm.queries import QUERIES

    rows = told_corpus()
    frame(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: (spans, clean) for i, spans, clean in model(rows)[0]}
    for r in QUERIES["op11_pii"](spark, str(tmp_path)).collect():
        spans, clean = want[r.doc_id]
        lines = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.spans == ",".join(lines)
        assert r.base_sha256 == hashlib.sha256(",".join(x for x in lines if not x.startswith("term")).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in lines) for k in ("email", "ip", "card", "phone")]
        assert r.sanitised_sha256 == hashlib.sha256(clean.encode()).hexdigest()
