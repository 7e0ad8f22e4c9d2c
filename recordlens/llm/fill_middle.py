"""Fill-in-the-middle: each text cut into prefix, middle and suffix at two of its units, and put in another order.

A text is its UTF-8 bytes in blocks of fixed size. A Fenwick tree over the blocks holds how many units and how many code points begin in each. A
cut is given as a number of units: a descent by halving steps finds the block in which that unit begins and how many code points are before
the block; inside the block the place is found by looking at its bytes. So a cut costs the logarithm of the text's blocks and one block,
whatever the text's length, and a text is never decoded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm.common import slices, utf8

#: Bytes of a block, and bytes of text that are handled at a time.
BLOCK, CHUNK = 1024, 1 << 22
#: Marks in front of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: In percent: texts that are cut, and of those the ones with the suffix first.
CUT, SUFFIX_FIRST = 90, 20
SEED = 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def code_points(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (data & 0xC0) != 0x80


def words(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a word with the white space behind it; white space in front of the first word is a unit of its own."""
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    if len(begins):
        begins[0] = True
    return begins


class Fenwick:
    """Sums over blocks: ``counts`` has a row of numbers for each block; descents go by the first of them."""

    def __init__(self, counts: np.ndarray) -> None:
        sums = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
        np.cumsum(counts, axis=0, out=sums[1:])
        node = np.arange(1, len(counts) + 1)
        self.nodes = [(0,) * counts.shape[1], *map(tuple, (sums[node] - sums[node - (node & -node)]).tolist())]
        self.total = tuple(sums[-1].tolist())

    def descend(self, target: int) -> tuple[int, int, int]:
        """The last block with at most ``target`` units before it (one behind the last, if all are), the units that remain to ``target``, and the code points before the block."""
        block, rest, before = 0, target, 0
        step = 1 << (len(self.nodes) - 1).bit_length()
        while step:
            if block + step < len(self.nodes) and self.nodes[block + step][0] <= rest:
                block += step
                rest -= self.nodes[block][0]
                before += self.nodes[block][1]
            step >>= 1
        return block, rest, before


class Cutter:
    """Finds the places of cuts in one text."""

    def __init__(self, units: np.ndarray, points: np.ndarray) -> None:
        self.units, self.points = units, points
        starts = np.arange(0, len(units), BLOCK)
        counts = [np.add.reduceat(x, starts, dtype=np.int64) if len(x) else np.empty(0, np.int64) for x in (units, points)]
        self.tree = Fenwick(np.stack(counts, 1))
        self.n_units, self.n_points = self.tree.total

    def place(self, unit: int) -> tuple[int, int]:
        """The byte at which unit number ``unit`` begins (the text's end behind the last one), and the code points before it."""
        block, rest, before = self.tree.descend(unit)
        start = block * BLOCK
        if start >= len(self.units):
            return len(self.units), self.n_points
        byte = start + int(np.flatnonzero(self.units[start : start + BLOCK])[rest])
        return byte, before + int(np.count_nonzero(self.points[start:byte]))


def draws(doc_id: object, seed: int) -> list[int]:
    """Four numbers below 2**32 from a hash of the id; a null id counts as empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def _check(marks: Sequence[str]) -> None:
    """Marks can be found again only if none overlaps itself or another one."""
    if len(set(marks)) != 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for a in marks:
        for b in marks:
            if (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"the marks {a!r} and {b!r} overlap")


def _cut(id_at: int, text_at: int, keep: list[int], names: list[str], marks: Sequence[str], unit: Callable, cut: int, suffix_first: int, seed: int):
    p, s, m = (x.encode() for x in marks)
    some_mark = re.compile(b"|".join(re.escape(x) for x in (p, s, m)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(text_at))
            for a, b in slices(offsets, CHUNK):
                low, high = int(offsets[a]), int(offsets[b])
                part = data[low:high]
                points = code_points(part)
                whole, at = part.tobytes(), (offsets[a : b + 1] - low).tolist()
                ids = batch.column(id_at).slice(a, b - a).to_pylist()
                rows: tuple[list, ...] = ([], [], [], [], [])
                for doc_id, start, end in zip(ids, at, at[1:], strict=False):
                    text = whole[start:end]
                    of_text = points[start:end]
                    cutter = Cutter(of_text if unit is code_points else unit(part[start:end]), of_text)
                    h1, h2, h3, h4 = draws(doc_id, seed)
                    form, lengths, out = "plain", (None, None), text
                    if text and h3 % 100 < cut and not some_mark.search(text):
                        ends = sorted((h1 % (cutter.n_units + 1), h2 % (cutter.n_units + 1)))
                        (x, before), (y, until) = map(cutter.place, ends)
                        prefix, middle, suffix = text[:x], text[x:y], text[y:]
                        lengths = before, until - before
                        if h4 % 100 < suffix_first:
                            form, out = "spm", b"".join((s, suffix, p, prefix, m, middle))
                        else:
                            form, out = "psm", b"".join((p, prefix, s, suffix, m, middle))
                    for column, value in zip(rows, (cutter.n_units, form, *lengths, out), strict=True):
                        column.append(value)
                kept = [batch.column(i).slice(a, b - a) for i in keep]
                made = [pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return run


def fill_in_middle(
    docs: DataFrame,
    *,
    unit: Callable[[np.ndarray], np.ndarray] = code_points,
    marks: Sequence[str] = MARKS,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add ``n, form, prefix_chars, middle_chars, output`` to each row of ``docs`` in place of its text. One pass, no shuffle.

    A text of ``n`` units (``unit`` says which bytes begin one: ``code_points`` or ``words``) is cut at two of the ``n + 1`` places between
    them. ``form`` is ``psm`` (prefix, suffix, middle, each behind its mark), ``spm`` (suffix first) or ``plain``: the text as it is, for
    empty ones, those that hold a mark and those that are not drawn. Everything is drawn from a hash of the id, so it does not depend on order or
    partitions and repeated ids are drawn alike. ``prefix_chars`` and ``middle_chars`` count code points, null for ``plain``. Null texts are
    empty, a null id counts as the empty one. All other columns are kept, but those that are called like a new one; an empty table
    gives no rows. ``restored`` gives the text back.
    """
    _check(marks)
    made = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    keep = [i for i, c in enumerate(docs.columns) if c != text and c.lower() not in made]
    schema = T.StructType([*[docs.schema.fields[i] for i in keep], *[T.StructField(c, t) for c, t in made.items()]])
    run = _cut(docs.columns.index(doc_id), docs.columns.index(text), keep, schema.names, marks, unit, cut, suffix_first, seed)
    return docs.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text of an output of ``fill_in_middle``."""
    parts = F.split(output, "|".join("\\Q" + m + "\\E" for m in marks), -1)
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)
