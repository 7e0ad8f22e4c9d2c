"""The filter audit against filters that are applied one after the other."""

import collections
import itertools
import re

import numpy as np

from recordlens.llm import filter_audit
from tests.llm.test_operators import LONG, empty_docs, odd_docs


def failed(text, later):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": later,
    }
    return {f for f, fails in tests.items() if fails}


def plainly(rows, labels):
    """Each order applied to each part's documents, filter by filter."""
    texts = collections.defaultdict(list)
    for i, t, _ in rows:
        texts[t or ""].append(i)
    good, toxic = ({i for i, *flags in labels if i is not None and flags[k] == 1} for k in (0, 1))
    docs = collections.defaultdict(list)
    for i, t, part in rows:
        later = i is not None and any(j is not None and j < i for j in texts[t or ""])
        docs[part or ""].append((i, failed(t or "", later)))
    out = {}
    for part, members in docs.items():
        sums = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(members)))
            gone = []
            for step, f in enumerate(order, 1):
                removed = [m for m in left if f in members[m][1]]
                redundant = sum(f in members[m][1] for m in gone)
                left, gone = [m for m in left if f not in members[m][1]], gone + removed
                ids = [members[m][0] for m in removed]
                out[part, "".join(order), step] = [
                    len(left), len(removed), redundant, sum(fails == {f} for _, fails in members), sum(i in good for i in ids), sum(i in toxic for i in ids)
                ]
                sums[f] += len(removed)
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(sums[f])
    return out


def test_audit_equals_filters_in_turn(spark):
    rng = np.random.default_rng(12)
    pool = ["A" * 10, LONG, "", None, " ".join(f"w{i}" for i in range(250)), " ".join(f"w{i}" for i in range(250)) + " $ ", "x " * 300, "Up " * 120 + "| " * 200]
    pool += [" ".join(f"v{rng.integers(400)}" for _ in range(rng.integers(150, 260))) + rng.choice(["", "#", " ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 3]) for _ in range(30)]
    rows = []
    for i in range(400):
        doc_id = None if i % 37 == 5 else int(rng.integers(0, 300))
        rows.append((doc_id, pool[rng.integers(len(pool))] if rng.random() > 0.4 else pool[4], [None, "", "web", "books", "web"][rng.integers(5)]))
    rows += [rows[3]] * 40  # one row often
    labels = [(int(rng.integers(0, 320)), int(rng.integers(2)), int(rng.integers(2))) for _ in range(200)] + [(None, 1, 1), (5, None, 1), (6, 1, None), (6, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as part", "1 as mask")
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    wanted = plainly(rows, labels)
    assert len(found) == len(wanted) == 600 * 3
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found} == wanted


def test_integers_hold_every_outcome_without_carry():
    total = sum(n * filter_audit.packed(code) for code, n in ((0, 2**61), (5, 2**60), (127, 3)))
    fields = filter_audit.unpacked(total)
    names = ["".join(filter_audit.LETTERS[f] for f in order) for order in filter_audit.orders()]
    a_first = fields[names.index("ABCDE")]
    assert fields.shape == (120, 5, 6) and a_first[:, 0].tolist() == [2**61] * 5
    assert a_first[0].tolist() == [2**61, 2**60 + 3, 0, 0, 3, 3] and a_first[2].tolist() == [2**61, 0, 2**60 + 3, 0, 0, 0]


def test_words_of_long_texts_in_pieces(monkeypatch):
    text = b"  one two\nthree " + b"x" * 5000 + b" one\ttwo" + b" y" * 700 + b"\x0b end"
    whole = len(text.split()), len(set(text.split()))
    for size in (1, 2, 7, 100, 3000):
        monkeypatch.setattr(filter_audit, "CHUNK", size)
        assert filter_audit.word_counts(text) == whole
        assert filter_audit.word_counts(text + b" " * 3 * size) == whole


def test_audit_of_odd_tables(spark):
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(odd_docs(spark), labels, part="key").collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {"k"} and all(r["kept"] + r["removed"] <= 12 for r in rows)
    assert filter_audit.audit(empty_docs(spark), labels, part="key").count() == 0
    assert filter_audit.audit(odd_docs(spark), labels.limit(0), part="set").where("good_lost + toxic_lost > 0").count() == 0
