"""What the searches over vectors share: clean vectors, kinds of equal ones, lists around pivots, and their tiles.

A *kind* is one distinct vector with the least ids of its copies, so copies are searched once. Kinds are dealt into lists of alike ones
around pivots that are fitted on a bounded sample; a list of many kinds is cut into parts, whatever they are. A *tile* is one part
and one block of the queries that ask for its list: what one task holds is bounded by the two.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.sources.scratch import materialize

#: Kinds that pivots are fitted on at most, by hash, and pivots of one length at most.
SAMPLE, MOST_PIVOTS = 8192, 1024
SEED = 23


def clean(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors (a matrix of doubles) of each length; null and empty ones and those that hold null or non-finite components are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component is NaN here
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    for d in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == d)
        matrix = flat[offsets[at][:, None] + np.arange(d)]
        whole = np.isfinite(matrix).all(1)
        if whole.any():
            yield at[whole], matrix[whole]


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish; cosines keep every bit."""
    _, exponents = np.frexp(np.abs(matrix).max(1))
    return np.ldexp(matrix, -exponents[:, None])


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay zero."""
    rows = scaled(matrix)
    norms = np.sqrt((rows * rows).sum(1, keepdims=True))
    return rows / np.where(norms > 0, norms, 1.0)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with that of ``b``, in double precision. Equal rows give equal bits wherever they stand."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def keys(matrix: np.ndarray) -> list[bytes]:
    """128-bit digests that stand for the vectors; 0.0 and -0.0 are equal."""
    rows = np.ascontiguousarray(matrix + 0.0)
    return [hashlib.blake2b(row.data, digest_size=16).digest() for row in rows]


def kinds(vectors: DataFrame, least: int, *values: str) -> DataFrame:
    """``key, ids, counts`` and the ``values`` of each distinct key of ``vectors (key, vec_id, ...)``.

    ``ids`` are the ``least`` smallest distinct ids with that key and ``counts`` how often each is there. As all rows of a kind get the same score and
    ties go to the smaller id, no other row of it can be among the ``least - 1`` best of any query.
    """
    per_id = vectors.groupBy("key", "vec_id").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    first = per_id.withColumn("place", place).where(F.col("place") <= least)
    ids = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("vec_id", "n"))).alias("all"))
    one = vectors.groupBy("key").agg(*[F.first(v).alias(v) for v in values])
    return one.join(ids.select("key", F.col("all.vec_id").alias("ids"), F.col("all.n").alias("counts")), "key")


def sampled(some_kinds: DataFrame, n: int, most: int = SAMPLE, value: str = "v") -> dict[int, np.ndarray]:
    """By length, at most ``most`` of the ``n`` kinds, as unit vectors: those with the least hashes, so always the same ones."""
    share = min(1.0, most / max(n, 1))
    if share < 1:
        some_kinds = some_kinds.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < math.floor(share * (1 << 20)) + 1)
    return {m.shape[1]: unit(m) for _, m in clean(some_kinds.select(value).limit(most).toArrow().column(0))}


def nearest(vectors: np.ndarray, pivots: np.ndarray, strip: int = 4096) -> np.ndarray:
    """The pivot with the greatest inner product for each vector."""
    return np.concatenate([np.argmax(vectors[a : a + strip] @ pivots.T, 1) for a in range(0, len(vectors), strip)])


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """At most ``n`` unit vectors, each the mean direction of the sample's vectors that are nearest to it."""
    n = max(1, min(n, len(sample), MOST_PIVOTS))
    pivots = sample[np.random.Generator(np.random.PCG64(seed)).choice(len(sample), n, replace=False)]
    for _ in range(rounds if n > 1 else 0):
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest(sample, pivots), sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        pivots = np.where(norms > 0, sums / np.where(norms > 0, norms, 1.0), pivots)
    return pivots


def in_lists(some_kinds: DataFrame, pivots: dict[int, np.ndarray], value: str = "v") -> DataFrame:
    """Add ``d`` and ``list``, the number of the nearest pivot of that length (0 where no pivot has it)."""
    at = some_kinds.columns.index(value)
    schema = T.StructType([*some_kinds.schema.fields, T.StructField("d", T.IntegerType()), T.StructField("list", T.IntegerType())])
    sent = some_kinds.sparkSession.sparkContext.broadcast(pivots)  # MOST_PIVOTS of one length at most, all fitted on SAMPLE vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in clean(batch.column(at)):
                d = matrix.shape[1]
                found = nearest(unit(matrix), sent.value[d]) if d in sent.value else np.zeros(len(matrix), int)
                rows = batch.take(pa.array(places))
                columns = [*rows.columns, pa.array(np.full(len(places), d, np.int32)), pa.array(found.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "d", "list"])

    return some_kinds.mapInArrow(run, schema)


def meet(placed: DataFrame, asked: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str, part: int, block: int) -> DataFrame:
    """``search(kinds, queries)`` over all tiles. Runs a job.

    ``placed`` has one row for each kind with its ``key, d, list``; ``asked`` has one row for each ``query_id`` and list (``d, list``) that it asks.
    Lists are cut into parts of about ``part`` kinds and their queries into blocks of about ``block``, by hashes of key and id.
    """
    here = ["d", "list"]
    parts = placed.groupBy(here).agg(F.ceil(F.count(F.lit(1)) / part).alias("parts"))
    blocks = asked.groupBy(here).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    sizes = materialize(parts.join(blocks, here), "lists")  # one row for each list; written, so Spark knows its size
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = placed.join(sizes, here).withColumn("part", F.pmod(F.xxhash64("key"), "parts")).withColumn("block", every("blocks"))
    right = asked.join(sizes, here).withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks")).withColumn("part", every("parts"))
    tile = [*here, "part", "block"]
    left, right = left.drop("parts", "blocks", "key"), right.drop("parts", "blocks")
    return left.groupBy(tile).cogroup(right.groupBy(tile)).applyInArrow(search, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``found (query_id, score, ids, counts)`` by score, then id, without the query's own id."""
    ids = F.explode(F.arrays_zip("ids", "counts")).alias("i")
    each = found.select("query_id", "score", ids).select("query_id", "score", F.col("i.ids").alias("vec_id"), F.col("i.counts").alias("n"))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long"))))
    rows = each.where(F.col("vec_id") != F.col("query_id")).withColumn("copy", copies)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def first_of_each(i: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts the best ``most`` of each ``i`` first by falling score, then rising id; and their ranks from 0."""
    order = np.lexsort((ids, -score, i))
    rank = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    kept = rank < most
    return order[kept], rank[kept]


def least_ids(table: pa.Table) -> np.ndarray:
    """The first id of each row's ``ids``."""
    column = table.column("ids").combine_chunks()
    lists = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return lists.values.to_numpy(zero_copy_only=False)[lists.offsets.to_numpy()[:-1]]
