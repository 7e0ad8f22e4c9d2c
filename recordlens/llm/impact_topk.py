"""Exact top-k inner products with an impact-ordered index, score at a time.

Vectors of integers are kept as postings: for each dimension its vectors in the order of their values, cut into segments of
neighbouring values. A query gives each segment an impact, the most that its own component times a value there can be, rounded up to whole
units. Segments are processed by falling impact, negative ones too, and added up for their vectors. With the
impact of the next segment, which bounds what is still to come of each dimension, that shows which vectors can reach the query's floor. Processing
stops when only few can, and those are scored exactly from their integers.

Alike vectors share a shard, so its segments bound them tightly and a shard that cannot reach the floor is left at once. A query
first meets the shards around it, which give its floor, then all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.llm import vectors
from recordlens.sources.scratch import materialize

#: Kinds of one shard of the index at most; also of a list of alike ones on the average.
SHARD = 8192
#: Queries that meet a shard at a time.
QUERIES = 1024
#: Segments of a dimension, about.
LEVELS = 32
#: The proof is tried whenever about this share of a query's postings has been processed.
STEP = 1 / 16
#: The rest is scored exactly once at most so many vectors, or this share of the shard, can still be among the best.
FEW, FEW_SHARE = 64, 0.1
#: Powers of two beyond which products are not exact in doubles; by which larger components are stored smaller; of a unit of impact at most.
_EXACT, _SHIFT, _UNITS = 53, 64, 40
_FOUND = pa.schema([("query_id", pa.int64()), ("score", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


class Vectors:
    """Rows of integers, each given as doubles and a power of two that they are to be multiplied by."""

    def __init__(self, rows: np.ndarray, shifts: np.ndarray) -> None:
        self.rows, self.shifts = rows, shifts
        self.shift = int(shifts.max(initial=0))
        common = np.ldexp(rows, (shifts - self.shift)[:, None])
        #: The greatest size of a component in units of 2**shift, and all components as shares of it.
        self.top = float(np.abs(common).max(initial=0)) or 1.0
        self.shares = common / self.top

    def integers(self, i: int) -> list[int]:
        shift = int(self.shifts[i])
        return [int(Fraction(x) * (1 << shift)) if shift else int(x) for x in self.rows[i].tolist()]


class Shard(Vectors):
    """The index of some kinds; ``ids`` are their least ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, shifts: np.ndarray) -> None:
        super().__init__(rows, shifts)
        self.ids = ids
        n, d = rows.shape
        self.order = np.ascontiguousarray(np.argsort(self.shares, axis=0, kind="stable").T)
        in_order = np.take_along_axis(self.shares, self.order.T, 0).T
        # Half of the cuts are at equal steps of value and half at equal numbers of vectors, so neither tails nor a dense middle are in wide segments.
        starts = []
        for values in in_order:
            steps = np.searchsorted(values, np.linspace(values[0], values[-1], LEVELS // 2, endpoint=False)[1:])
            starts.append(np.unique(np.concatenate([[0], steps, np.arange(1, LEVELS // 2) * n // (LEVELS // 2)])))
            starts[-1] = starts[-1][starts[-1] < n]
        self.size = np.concatenate([np.diff(x, append=n) for x in starts])
        self.first = np.cumsum([0, *map(len, starts)])[:-1]
        self.dimension, self.start = np.repeat(np.arange(d), list(map(len, starts))), np.concatenate(starts)
        self.low, self.high = in_order[self.dimension, self.start], in_order[self.dimension, self.start + self.size - 1]
        # A sum of d impacts, and behind it the number of dimensions that a vector was met in, fit 63 bits together.
        self.bits = d.bit_length()
        self.unit = 1 << min(_UNITS, 61 - 2 * self.bits)

    def scores(self, places: np.ndarray, query: Vectors, q: int) -> list[int]:
        """The inner products of the query's and the vectors' integers."""
        if not self.shift and not query.shift and self.rows.shape[1] * self.top * query.top < 1 << _EXACT:
            return (self.rows[places] @ query.rows[q]).astype(np.int64).tolist()
        asked = query.integers(q)
        return [sum(map(mul, self.integers(i), asked)) for i in places.tolist()]

    def units(self, score: int, query: Vectors) -> int:
        """A score in units of impact, rounded down."""
        exact = Fraction(score) * self.unit / (Fraction(self.top) * Fraction(query.top))
        return math.floor(exact / (1 << self.shift + query.shift))

    def search(self, query: Vectors, q: int, most: int, floor: int | None) -> tuple[np.ndarray, list[int], float]:
        """Places and scores of the ``most`` best kinds by falling score and rising id, the share of postings processed.

        Kinds that cannot reach ``floor`` may be left out.
        """
        n = len(self.ids)
        share = query.shares[q]
        of_segment = share[self.dimension]
        # Rounded up, and one more for the rounding of the doubles.
        impact = np.ceil(np.maximum(of_segment * self.low, of_segment * self.high) * self.unit).astype(np.int64) + 1
        greatest = np.maximum.reduceat(impact, self.first)[share != 0]
        live = np.flatnonzero(of_segment)
        falling = live[np.argsort(-impact[live], kind="stable")]
        flat, sizes, dimension, start = impact[falling], self.size[falling], self.dimension[falling], self.start[falling]
        processed = np.cumsum(sizes)
        packed = np.zeros(n, np.int64)
        mask = (1 << self.bits) - 1
        needed = None if floor is None else self.units(floor, query)
        if needed is not None and int(greatest.sum()) < needed:
            return np.empty(0, np.int64), [], 0.0
        at, possible = 0, np.arange(n)
        while at < len(flat):
            target = (processed[at - 1] if at else 0) + STEP * processed[-1]
            to = max(at + 1, int(np.searchsorted(processed, target, "right")))
            segments = zip(dimension[at:to].tolist(), start[at:to].tolist(), sizes[at:to].tolist(), strict=True)
            places = np.concatenate([self.order[d, s : s + m] for d, s, m in segments])
            np.add.at(packed, places, np.repeat((flat[at:to] << self.bits) + 1, sizes[at:to]))
            at = to
            # A vector not met in a dimension has no more there than the next impact of all and the dimension's greatest.
            # Dimensions in which any vector was met have a greatest impact that is not below the next one.
            ahead = int(flat[at]) if at < len(flat) else 0
            rest = int(np.minimum(greatest, ahead).sum()) if at < len(flat) else 0
            bound = (packed >> self.bits) - (packed & mask) * ahead + rest
            if floor is None and n > most:
                best = np.argpartition(-bound, most - 1)[:most]
                lowest = min(self.scores(best, query, q))
                needed = max(self.units(lowest, query), needed if needed is not None else -(1 << 62))
            if needed is not None:
                possible = np.flatnonzero(bound >= needed)
                if len(possible) <= max(FEW, FEW_SHARE * n):
                    break
        scores = self.scores(possible, query, q)
        first = sorted(zip([-s for s in scores], self.ids[possible].tolist(), possible.tolist(), strict=True))[:most]
        return np.array([p for _, _, p in first], np.int64), [-s for s, _, _ in first], float(processed[at - 1] / processed[-1]) if at else 0.0


def quantised(matrix: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` of finite components as doubles, which hold them exactly, and each row's power of two: 0, or where a product overflows ``_SHIFT``."""
    with np.errstate(over="ignore"):
        whole = np.floor(matrix * scale)
    shifts = np.where(np.isfinite(whole).all(1), 0, _SHIFT).astype(np.int32)
    for i in np.flatnonzero(shifts):
        whole[i] = [float(math.floor(Fraction(scale) * Fraction(x)) / Fraction(1 << _SHIFT)) for x in matrix[i].tolist()]
    return whole + 0.0, shifts


def _quantise(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in vectors.clean(batch.column(1)):
                rows, shifts = quantised(matrix, scale)
                n, d = rows.shape
                taken = batch.select(["vec_id", "q"]).take(pa.array(places))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d, dtype=np.int32)), pa.array(rows.ravel()))
                digests = vectors.keys(np.column_stack([rows, shifts]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(digests, pa.binary()), lists, pa.array(shifts)], names=["vec_id", "q", "key", "v", "shift"])

    return run


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    (_, rows), = vectors.clean(table.column("v"))
    return rows, table.column("shift").to_numpy().astype(np.int64)


def _meet(k: int):
    most = k + 1  # kinds: a query's own one may hold no other row

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        shard, query = Shard(vectors.least_ids(left), *_rows(left)), Vectors(*_rows(right))
        asked, found, values = [], [], []
        for q, floor in enumerate(right.column("floor").to_pylist()):
            places, scores, _ = shard.search(query, q, most, floor)
            asked.append(np.full(len(places), q))
            found.append(places)
            values += scores
        if any(not -(1 << 63) <= s < 1 << 63 for s in values):
            raise OverflowError("a score does not fit 64 bits")
        kinds = left.select(["ids", "counts"]).take(pa.array(np.concatenate(found)))
        ids = right.column("query_id").take(pa.array(np.concatenate(asked)))
        return pa.table([ids, pa.array(values, pa.int64()), kinds.column("ids"), kinds.column("counts")], names=_FOUND.names).cast(_FOUND)

    return run


def _homes(pivots_of):
    """Add the nearest list and all others of the query's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in vectors.clean(batch.column(1)):
                n, d = matrix.shape
                pivots = pivots_of.value.get(d, np.zeros((1, d)))
                order = np.argsort(-(vectors.unit(matrix) @ pivots.T), axis=1, kind="stable").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, len(pivots), dtype=np.int32)), pa.array(order.ravel()))
                rows = batch.take(pa.array(places))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(n, d, np.int32)), lists], names=[*rows.schema.names, "d", "lists"])

    return run


def top_k(rows: DataFrame, is_query: Column, *, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest integer inner products for each query row. Runs jobs.

    ``is_query`` says which rows are queries; all rows but those with the query's own id are candidates, those of the queries too.
    Components are ``floor(scale * x)``. Equal scores rank by ascending id. Vectors that are null, empty or hold null or non-finite components, and rows with
    a null id, take no part; vectors of another length than the query's are no candidates. Of repeated query ids the one with the least quantised vector counts; repeated
    candidates are ranked each. A query with fewer candidates than ``k`` has them all. An empty table gives no rows. Components of any size count
    whole; a score among the best of a shard that does not fit 64 bits is an error.

    Equal quantised vectors are one kind. Kinds are dealt into lists of alike ones, around pivots that are fitted on a bounded sample, and lists into
    shards of at most about ``SHARD``, whatever the input's size; each shard, indexed in its task, meets its queries in blocks of about ``QUERIES``. Every query meets
    every shard, its own list first, and each gives back the best few kinds. So the work is that of the stated queries against all rows, in blocks.
    """
    source = rows.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("x"), F.coalesce(is_query, F.lit(False)).alias("q"))
    table = materialize(source.mapInArrow(_quantise(scale), "vec_id long, q boolean, key binary, v array<double>, shift int"), "vectors")
    kinds = materialize(vectors.kinds(table, k + 1, "v", "shift"), "kinds")
    n = kinds.count()
    sample = vectors.sampled(kinds, n)
    total = max(1, sum(map(len, sample.values())))
    pivots = {d: vectors.fit_pivots(m, -(-n * len(m) // (total * SHARD))) for d, m in sample.items()}
    placed = materialize(vectors.in_lists(kinds, pivots), "placed")

    one = table.where("q").groupBy("vec_id").agg(F.min(F.struct("v", "shift")).alias("least")).select(F.col("vec_id").alias("query_id"), "least.v", "least.shift")
    sent = rows.sparkSession.sparkContext.broadcast(pivots)
    asked = materialize(one.mapInArrow(_homes(sent), "query_id long, v array<double>, shift int, d int, lists array<int>"), "queries")
    schema = "query_id long, score long, ids array<long>, counts array<long>"
    near = asked.select("query_id", "v", "shift", "d", F.col("lists")[0].alias("list"), F.lit(None).cast("long").alias("floor"))
    home = materialize(vectors.meet(placed, near, _meet(k), schema, SHARD, QUERIES), "home")
    floors = vectors.ranked(home, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    away = asked.join(floors, "query_id", "left").select("query_id", "v", "shift", "d", "floor", F.explode(F.slice("lists", 2, 1 << 30)).alias("list"))
    rest = vectors.meet(placed, materialize(away, "asked"), _meet(k), schema, SHARD, QUERIES)
    return vectors.ranked(home.unionByName(rest), k)
