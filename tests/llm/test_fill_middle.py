"""Fill-in-the-middle: a plain model of units, cuts and forms; the rank index; odd texts."""

import hashlib
import random
import re

import numpy as np
import pytest

from tillwork.llm import fill_middle as fm

SCHEMA = "doc_id long, text string, n string, form string, output string"


def model(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text, text
    if h4 % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def odd_texts():
    rnd = random.Random(5)
    letters = ["a", "é", "日", "😀", "<", ">", "S", "P", "<S", "P>", " ", "  ", "\t", "\n", "\r\n", "\x0b", " ", " "]
    texts = [None, "", " ", "\n\t ", "x", " x", "x ", "<P>", "a <M> b", "a < S > b", "ü" * 3000, ("wort " * 4000).strip(), "a" * 200_000 + " b " + "c " * 20_000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    return texts


def test_against_a_plain_model(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(None, "no id here"), (-7, "a negative id"), (3, "the same id"), (9, "a <M> b")]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    got = [tuple(r) for r in fm.fill_middle(df).collect()]
    assert sorted(got, key=repr) == sorted((model(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_rates(spark):
    df = spark.createDataFrame([(i, "one two three") for i in range(400)], "doc_id long, text string")
    assert {r.form for r in fm.fill_middle(df, rate=100, spm=0).collect()} == {"psm"}
    assert {r.form for r in fm.fill_middle(df, rate=0).collect()} == {"plain"}
    assert [tuple(r) for r in fm.fill_middle(df, seed=7).orderBy("doc_id").collect()] == [model(i, "one two three", seed=7) for i in range(400)]


def test_empty_table(spark):
    assert fm.fill_middle(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("error", [0, 1, 5, 96])
def test_rank_index_is_bounded_and_exact(error):
    rnd = random.Random(error)
    for n in (0, 1, 2, 3, 700, 20_000):
        offsets = np.cumsum([rnd.choice([0, 1, 2, 3, 9, 30, 4000 if rnd.random() < 0.01 else 1]) for _ in range(n)]).astype(np.int64)
        index = fm.fit_ranks(offsets, error)
        assert (index.offset(np.arange(n)) == offsets).all()
        assert (np.abs(index.residual) <= error + 1).all()
    even = fm.fit_ranks(np.arange(0, 700_000, 7), error)
    assert len(even.first) == 1


def test_restore_needs_output_and_form_only():
    for form in ("psm", "spm"):
        for parts in ((b"", b"", b""), (b"a<", b"<S", b">"), (b"<P", b"P>", b"<M"), (b"x<S", b"M>", b"S>")):
            assert fm.restore(form, fm.arrange(form, *parts)) == b"".join(parts)
