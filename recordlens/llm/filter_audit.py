"""How filters interact: what each of them removes in every order in which they can be applied.

What happens to a document in all orders follows from its mask, the set of filters that it fails, and its labels. So every mask and label is mapped to one
big integer whose fields, ``FIELD`` bits each, hold all outcomes of all steps of all orders, 0 or 1. The integers of a part's documents are
summed and the sum is unpacked once. A field counts documents, so it stays below 2**63 and never carries into the next one. Spark counts
equal masks of a part first, so what is added up for a part is a few products, however many documents it has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm.common import slices, utf8
from recordlens.sources.scratch import materialize

#: The filters' letters; a mask has the bit ``1 << i`` if the filter at place ``i`` fails.
LETTERS = "ABCDE"
#: Limits of A (words), B (percent distinct words), C (percent upper-case letters) and the marks of D.
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER, MARKS = 200, 50, 2, "#$%&*|"
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Bits of a field.
FIELD = 64
#: Bytes of text that are looked at together, and of one long text that are split into words at a time.
CHUNK = 1 << 20
_DUPLICATE, _GOOD, _TOXIC = LETTERS.index("E"), len(LETTERS), len(LETTERS) + 1
_MARKS = np.zeros(256, bool)
_MARKS[list(MARKS.encode())] = True
_SPACES = {b" ", b"\t", b"\n", b"\v", b"\f", b"\r"}


def orders(letters: str = LETTERS) -> list[tuple[int, ...]]:
    return list(permutations(range(len(letters))))


def packed(code: int, letters: str = LETTERS) -> int:
    """The integer of a code: a mask, with the bits behind it for a good and for a toxic label. Field by field: order, step, outcome."""
    mask, good, toxic = code & ((1 << len(letters)) - 1), code >> len(letters) & 1, code >> len(letters) + 1 & 1
    fields = []
    for order in orders(letters):
        alive = True
        for f in order:
            fails = mask >> f & 1
            removed = alive and fails
            redundant = fails and not alive
            alive = alive and not fails
            fields += [alive, removed, redundant, mask == 1 << f, removed and good, removed and toxic]
    return int.from_bytes(np.array(fields, bool).astype(f"<u{FIELD // 8}").tobytes(), "little")


def unpacked(total: int, letters: str = LETTERS) -> np.ndarray:
    """Numbers by order, step and outcome."""
    n, k = len(orders(letters)), len(letters)
    raw = total.to_bytes(n * k * len(OUTCOMES) * FIELD // 8, "little")
    return np.frombuffer(raw, f"<i{FIELD // 8}").reshape(n, k, len(OUTCOMES))


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words, cut at ASCII white space. A long text is taken piece by piece, only its distinct words are held."""
    if len(text) <= 2 * CHUNK:
        found = text.split()
        return len(found), len(set(found))
    n, distinct, rest = 0, set(), b""
    for at in range(0, len(text), CHUNK):
        piece = rest + text[at : at + CHUNK]
        found = piece.split()
        rest = b""
        if found and piece[-1:] not in _SPACES:  # the last word may go on
            rest = found.pop()
        n += len(found)
        distinct.update(found)
    if rest:
        n += 1
        distinct.add(rest)
    return n, len(distinct)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        for a, b in slices(offsets, CHUNK):
            part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]

            def sums(flags: np.ndarray, at: np.ndarray = at) -> np.ndarray:
                total = np.zeros(len(flags) + 1, np.int64)
                np.cumsum(flags, out=total[1:])
                return total[at[1:]] - total[at[:-1]]

            upper, points, marks = sums((part >= 65) & (part <= 90)), sums((part & 0xC0) != 0x80), sums(_MARKS[part])
            whole, ends = part.tobytes(), at.tolist()
            some = [whole[x:y] for x, y in zip(ends, ends[1:], strict=False)]
            n, distinct = np.array([word_counts(t) for t in some], np.int64).reshape(-1, 2).T
            fails = (n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * upper > MOST_UPPER * points, marks > 0)
            mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
            digests = pa.array([hashlib.sha256(t).digest() for t in some], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), digests, pa.array(mask, pa.int32())], names=["doc_id", "part", "digest", "mask"])


def masks(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id, part, mask`` with its ``rows`` for each distinct document row. Runs jobs.

    A text fails E if a row with a smaller id has the same text, found by its SHA-256. Repeated rows of the least id pass; a null id is neither smaller nor larger than any.
    """
    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")]
    seen = materialize(docs.select(*columns).mapInArrow(_masks, "doc_id long, part string, digest binary, mask int"), "masks")
    least = seen.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    # Joined by text and id together, so the copies of one text are spread over the tasks by their ids.
    rows = seen.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("rows"))
    first = rows.where("doc_id is not null").join(least.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    copied = F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(F.lit(1 << _DUPLICATE)))
    return first.select("doc_id", "part", copied.alias("mask"), "rows").unionByName(rows.where("doc_id is null").select("doc_id", "part", "mask", "rows"))


def _flag(name: str) -> Column:
    return F.max(F.coalesce(F.col(name) == 1, F.lit(False))).cast("int").alias(name)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    integers: dict[int, int] = {}
    order_of = orders()
    names = ["".join(LETTERS[f] for f in order) for order in order_of]
    filters = np.array(order_of)
    steps = len(LETTERS)
    for batch in batches:
        for part, codes, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            total = 0
            for code, n in zip(codes, counts, strict=True):
                if code not in integers:
                    integers[code] = packed(code)
                total += n * integers[code]
            fields = unpacked(total)
            removed = fields[:, :, OUTCOMES.index("removed")]
            shapley = np.array([removed[filters == f].sum() for f in range(steps)], np.int64)
            rows = fields.reshape(-1, len(OUTCOMES))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows)),
                    pa.array(np.repeat(names, steps).tolist()),
                    pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(names))),
                    *[pa.array(rows[:, i]) for i in range(len(OUTCOMES))],
                    pa.array(shapley[filters.ravel()]),
                ],
                names=["part", "filter_order", "step", *OUTCOMES, "shapley"],
            )


def audit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, filter_order, step``, the counts ``kept, removed, redundant, unique_fails, good_lost, toxic_lost`` and ``shapley``: 600 rows for each part. Runs jobs.

    The filters: A under ``LEAST_WORDS`` words, B fewer than ``LEAST_DISTINCT`` percent distinct words, C more than ``MOST_UPPER`` percent of code points A-Z, D any of
    ``MARKS``, E the text of a smaller id. Counts are of document rows, repeated ones each. A null part is the empty one, a null text the empty
    text, which fails A and, from the second id on, E. A document is good (toxic) if any row of ``labels`` with its id says so; a null id has no labels. ``shapley`` is
    what the step's filter removes, summed over all orders. An empty table gives no rows.
    """
    per_row = masks(docs, doc_id=doc_id, text=text, part=part)
    flags = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(_flag("quality"), _flag("toxic")).where("quality = 1 or toxic = 1")
    known = per_row.where("doc_id is not null").join(flags, "doc_id", "left")
    label = F.coalesce(F.shiftleft("quality", _GOOD) + F.shiftleft("toxic", _TOXIC), F.lit(0))
    coded = known.select("part", (F.col("mask") + label).alias("code"), "rows").unionByName(per_row.where("doc_id is null").select("part", F.col("mask").alias("code"), "rows"))
    counts = coded.groupBy("part", "code").agg(F.sum("rows").alias("n"))
    # At most one entry for each code: 128.
    lists = counts.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("code", "n"))).alias("all"))
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in (*OUTCOMES, "shapley")]]
    )
    return lists.select("part", F.col("all.code").alias("codes"), F.col("all.n").alias("counts")).mapInArrow(_unpack, schema)
