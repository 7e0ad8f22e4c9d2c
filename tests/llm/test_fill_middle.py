"""Fill-in-the-middle against slicing of decoded texts."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlens.llm import fill_middle
from tests.llm.test_operators import LONG, empty_docs, odd_docs


def plainly(doc_id, text, units=list):
    """Form, code points of prefix and middle, output: by slicing a list of units."""
    cut = units(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(cut)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(cut[:a]), "".join(cut[a:b]), "".join(cut[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def word_units(text):
    out = []
    for i, c in enumerate(text):
        if i == 0 or (c not in " \t\n\v\f\r" and text[i - 1] in " \t\n\v\f\r"):
            out.append("")
        out[-1] += c
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \né漢😀́", max_size=90), st.integers(1, 7), st.booleans())
def test_cuts_are_found_in_any_block(text, block, by_words):
    data = np.frombuffer(text.encode(), np.uint8)
    units = word_units(text) if by_words else list(text)
    begins = fill_middle.words(data) if by_words else fill_middle.code_points(data)
    size, fill_middle.BLOCK = fill_middle.BLOCK, block
    try:
        cutter = fill_middle.Cutter(begins, fill_middle.code_points(data))
        assert cutter.n_units == len(units)
        for u in range(len(units) + 1):
            before = "".join(units[:u])
            assert cutter.place(u) == (len(before.encode()), len(before))
    finally:
        fill_middle.BLOCK = size


TEXTS = [None, "", "a", "é😀", "has <P> mark", "<M>", "< P> <", "a<", LONG, "漢字" * 3000, " \n x", "\x00\x01", "<|x|>"] + [f"{'ab' * i} word {i} é" for i in range(300)]


@pytest.mark.parametrize("by_words", [False, True])
def test_forms_equal_slicing(spark, by_words):
    rows = [(None if i == 7 else i % 250, "x", t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([*rows, rows[-1]], "doc_id long, FORM string, text string")
    unit = fill_middle.words if by_words else fill_middle.code_points
    made = fill_middle.fill_in_middle(docs, unit=unit).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]
    found = sorted(map(repr, (tuple(r) for r in made.collect())))
    wanted = [(i, *plainly(i, t or "", word_units if by_words else list), t or "") for i, _, t in [*rows, rows[-1]]]
    assert found == sorted(map(repr, wanted))
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}


def test_odd_tables_and_marks(spark):
    out = fill_middle.fill_in_middle(odd_docs(spark))
    assert out.columns == ["doc_id", "TEXT_", "Severity", "set", "key", "place", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert out.count() == 12 and fill_middle.fill_in_middle(empty_docs(spark)).count() == 0
    made = fill_middle.fill_in_middle(odd_docs(spark), marks=("[pre]", "[suf]", "[mid]"), cut=100, suffix_first=100)
    back = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]")).alias("t"), "form")
    assert {r["form"] for r in back.collect()} == {"plain", "spm"}
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs(spark).collect()}
    assert {r["doc_id"]: r["t"] for r in back.collect()} == texts
    for marks in (("a", "b", "a"), ("aa", "b", "c"), ("ab", "bc", "d"), ("abc", "b", "d"), ("", "b", "c")):
        with pytest.raises(ValueError, match="mark"):
            fill_middle.fill_in_middle(odd_docs(spark), marks=marks)
