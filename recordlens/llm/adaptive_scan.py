"""Approximate nearest neighbours by cosine: lists around pivots, scanned in column blocks with early tests.

For unit vectors the greatest cosine is the least squared distance. All vectors are rotated at random, so the part of a distance
that the first ``t`` of ``d`` columns hold estimates the whole: about ``t / d`` of it, with a relative error of about ``1 / sqrt(t)``. A list is scanned
block of columns by block of columns; after each a test asks whether a candidate's partial distance can, but for errors
of ``CONFIDENCE`` such deviations, still belong to one within the query's reach, and abandons it if not. What is left after the last
column has its whole distance, and is scored by the cosine of the original vectors.

A query first scans the list nearest to it, which gives its reach, then the others that it probes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.llm import vectors
from recordlens.llm.pigeonhole import rotation
from recordlens.sources.scratch import materialize

#: Kinds of a list on the average, up to ``vectors.MOST_PIVOTS`` lists, and of a part at most.
LIST, PART = 1024, 8192
#: Queries that meet a part at a time.
QUERIES = 1024
#: So many lists are probed that this share of the nearest neighbours inside the sample are in them. Neighbours are farther apart in a
#: sample than in all rows, so it errs towards more lists.
FOUND = 0.98
#: Queries of the sample that this is measured with.
TRIED = 256
#: Columns of a block, and deviations that a test allows.
WIDTH, CONFIDENCE = 16, 2.1
#: Candidates and queries of one step, and the share of live pairs from which they are followed one by one.
STRIP, ROWS, SPARSE = 2048, 256, 0.25
_ROUNDING = 1e-9
_FOUND_SCHEMA = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def survivors(queries: np.ndarray, candidates: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, candidate) of rotated unit vectors that no test abandons, with their squared distances.

    ``reach`` is the squared distance that matters to each query; all pairs within it survive but for the tests' errors.
    """
    d = queries.shape[1]
    alive, partial, pairs = None, np.zeros((len(queries), len(candidates))), None
    for low in range(0, d, WIDTH):
        high = min(low + WIDTH, d)
        limit = reach * (1 + _ROUNDING) if high == d else reach * (high / d) * (1 + CONFIDENCE / np.sqrt(high)) ** 2
        limit = limit + _ROUNDING
        a, b = queries[:, low:high], candidates[:, low:high]
        if pairs is None:
            partial += (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
            within = partial <= limit[:, None]
            alive = within if alive is None else alive & within
            if high == d or np.count_nonzero(alive) < SPARSE * alive.size:
                pairs = np.nonzero(alive)
                partial = partial[pairs]
        else:
            i, j = pairs
            for at in range(0, len(i), 1 << 17):
                some = slice(at, at + (1 << 17))
                gap = a[i[some]] - b[j[some]]
                partial[some] += (gap * gap).sum(1)
            kept = partial <= limit[i]
            pairs, partial = (i[kept], j[kept]), partial[kept]
    return *pairs, partial


def nearest_kinds(queries: np.ndarray, candidates: np.ndarray, reach: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, candidates and cosines of the ``most`` best candidates of each query within its reach.

    The reach shrinks as candidates are met, strip by strip; the first strip is short where nothing is known yet.
    """
    d = queries.shape[1]
    turn = rotation(d)
    turned_q, turned_c = vectors.unit(queries) @ turn, vectors.unit(candidates) @ turn
    near_q, near_c = vectors.scaled(queries), vectors.scaled(candidates)
    found = []
    for top in range(0, len(queries), ROWS):
        rows = np.arange(top, min(top + ROWS, len(queries)))
        far = reach[rows].copy()
        i, j, score = np.empty(0, int), np.empty(0, int), np.empty(0)
        first = 0
        while first < len(candidates):
            step = STRIP if np.isfinite(far).all() else max(64, 4 * most)
            x, y, distance = survivors(turned_q[rows], turned_c[first : first + step], far)
            # Only what can be among the best of this strip is scored.
            order, rank = vectors.first_of_each(x, -distance, y, most)
            bound = np.full(len(rows), np.inf)
            last = rank == most - 1
            bound[x[order[last]]] = distance[order[last]]
            few = distance <= bound[x] + _ROUNDING
            x, y = x[few], y[few] + first
            i, j = np.concatenate([i, x]), np.concatenate([j, y])
            score = np.concatenate([score, vectors.cosines(near_q[rows[x]], near_c[y])])
            order, rank = vectors.first_of_each(i, score, ids[j], most)
            i, j, score = i[order], j[order], score[order]
            full = rank == most - 1
            far[i[full]] = np.minimum(far[i[full]], np.maximum(2 - 2 * score[full], 0))
            first += step
        found.append((rows[i], j, score))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _scan(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND_SCHEMA.empty_table()
        (_, candidates), = vectors.clean(left.column("v"))
        (_, queries), = vectors.clean(right.column("v"))
        reach = right.column("reach").to_numpy().astype(float)
        # One more than k kinds, as a query's own one may hold no other row.
        i, j, score = nearest_kinds(queries, candidates, reach, vectors.least_ids(left), k + 1)
        kinds = left.select(["ids", "counts"]).take(pa.array(j))
        columns = [right.column("query_id").take(pa.array(i)), pa.array(score), kinds.column("ids"), kinds.column("counts")]
        return pa.table(columns, names=_FOUND_SCHEMA.names).cast(_FOUND_SCHEMA)

    return run


def probes(sample: np.ndarray, pivots: np.ndarray, k: int, share: float = FOUND) -> int:
    """How many of the nearest lists hold ``share`` of the ``k`` nearest neighbours of the sample's first vectors, inside the sample."""
    asked = sample[:TRIED]
    if len(sample) <= k or len(pivots) == 1:
        return len(pivots)
    close = asked @ sample.T
    close[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argpartition(-close, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-(asked @ pivots.T), axis=1, kind="stable"), axis=1, kind="stable")
    rank = np.sort(np.take_along_axis(place, vectors.nearest(sample, pivots)[near], 1).ravel())
    return int(rank[int(np.ceil(share * len(rank))) - 1]) + 1


def _probed(pivots_of, counts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in vectors.clean(batch.column(1)):
                d = matrix.shape[1]
                if d in counts:
                    close = vectors.unit(matrix) @ pivots_of.value[d].T
                    lists = np.argsort(-close, axis=1, kind="stable")[:, : counts[d]].astype(np.int32)
                else:
                    lists = np.zeros((len(matrix), 1), np.int32)
                width = lists.shape[1]
                offsets = pa.array(np.arange(0, lists.size + 1, width, dtype=np.int32))
                rows = batch.take(pa.array(places))
                columns = [*rows.columns, pa.array(np.full(len(places), d, np.int32)), pa.ListArray.from_arrays(offsets, pa.array(lists.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, "d", "lists"])

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for places, matrix in vectors.clean(batch.column(1)):
            some = matrix.any(1)
            rows = batch.take(pa.array(places[some]))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(vectors.keys(matrix[some]), pa.binary())], names=["vec_id", "v", "q", "key"])


def nearest_neighbours(rows: DataFrame, is_query: Column, *, k: int = 5, found: float = FOUND, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row the ``k`` rows found with the greatest cosine. Runs jobs.

    ``is_query`` says which rows are queries; all rows but those with the query's own id are candidates. Scores are cosines of the original vectors in double
    precision; equal scores rank by ascending id. Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no part;
    vectors of another length than the query's are no candidates. Of repeated query ids the one with the least vector counts; repeated candidates
    are ranked each. A query with fewer than ``k`` candidates in its lists has those. An empty table gives no rows.

    All rows are indexed. Bounded, and documented as such: the sample of ``vectors.SAMPLE`` distinct vectors that the pivots
    and the number of probed lists are fitted on, and ``vectors.MOST_PIVOTS`` lists; lists beyond ``PART`` kinds are cut into parts that are all scanned.
    """
    source = rows.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    kind = source.schema["v"].dataType.simpleString()
    table = materialize(source.mapInArrow(_keyed, f"vec_id long, v {kind}, q boolean, key binary"), "vectors")
    kinds = materialize(vectors.kinds(table, k + 1, "v"), "kinds")
    n = kinds.count()
    sample = vectors.sampled(kinds, n)
    wanted = -(-n // LIST)
    pivots = {d: vectors.fit_pivots(m, -(-wanted * len(m) // max(1, sum(map(len, sample.values()))))) for d, m in sample.items()}
    counts = {d: probes(sample[d], p, k, found) for d, p in pivots.items()}
    placed = materialize(vectors.in_lists(kinds, pivots), "placed")

    one = table.where("q").groupBy("vec_id").agg(F.min("v").alias("v"))
    sent = rows.sparkSession.sparkContext.broadcast(pivots)
    asked = materialize(one.mapInArrow(_probed(sent, counts), f"vec_id long, v {kind}, d int, lists array<int>").withColumnRenamed("vec_id", "query_id"), "queries")
    schema = "query_id long, score double, ids array<long>, counts array<long>"
    near = asked.select("query_id", "v", "d", F.col("lists")[0].alias("list"), F.lit(float("inf")).alias("reach"))
    home = materialize(vectors.meet(placed, near, _scan(k), schema, PART, QUERIES), "home")
    known = vectors.ranked(home, k).where(F.col("rank") == k).select("query_id", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("known"))
    others = asked.join(known, "query_id", "left").select(
        "query_id", "v", "d", F.coalesce("known", F.lit(float("inf"))).alias("reach"), F.explode(F.slice("lists", 2, 1 << 30)).alias("list")
    )
    away = vectors.meet(placed, materialize(others, "asked"), _scan(k), schema, PART, QUERIES)
    return vectors.ranked(home.unionByName(away), k)
