"""Near-duplicate vectors by a subspace pigeonhole join.

For unit vectors a cosine of at least ``c`` is a squared distance of at most ``2 - 2c``. The vectors are rotated at random
and cut into blocks of few dimensions. If the squared distance of two vectors is within the budget, that of at least
one block is within the block's share of it. So a range join in each block finds every pair, and what any of
them finds is checked exactly.

The range join of a block is by its first coordinate, in slabs as wide as its radius, and inside a pair of slabs by a
sweep along its second one, then by the block's whole distance. A pair is counted in the first block that finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm import vectors as vector_rows
from recordlens.llm.common import components
from recordlens.sources.scratch import materialize

COSINE = 0.95
BLOCKS = 8
#: Vectors of one side of a tile.
TILE = 8192
#: Vectors of one side that are compared at a time.
STRIP = 512
SEED = 11
#: Room for rounding in the blocks' budgets; the exact test has none.
_SLACK = 1e-6
#: Room for rounding around the blocks' tests, which all go by the same numbers.
_MARGIN = 1e-9


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_edges(dimensions: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dimensions, min(blocks, dimensions) + 1).round().astype(int)


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors, the same to the bit whatever rows they are rotated with.

    Both factors are rounded to 26 bits, so that all sums are of integers below 2**53 and exact in any order.
    """
    whole = np.rint(vector_rows.unit(vectors) * 2.0**26) @ np.rint(rotation(vectors.shape[1]) * 2.0**26)
    return whole * 2.0**-52


class Blocks:
    """The blocks of ``d`` dimensions: their edges, budgets of squared distance, and widths of their slabs, for all steps alike."""

    def __init__(self, d: int, blocks: int, cosine: float) -> None:
        self.edges = block_edges(d, blocks)
        self.budgets = (2 - 2 * cosine) * np.diff(self.edges) / d + _SLACK
        # Vectors within a block's budget are in one slab or in neighbouring ones.
        self.widths = np.sqrt(self.budgets) * (1 + _MARGIN)

    def slabs(self, rows: np.ndarray) -> np.ndarray:
        return np.floor(rows[:, self.edges[:-1]] / self.widths).astype(np.int64)

    def within(self, rows: np.ndarray, i: np.ndarray, j: np.ndarray, block: int) -> np.ndarray:
        """Which pairs are within the budget of a block; the same answer in whatever tile it is asked."""
        total = np.zeros(len(i))
        for c in range(self.edges[block], self.edges[block + 1]):
            gap = rows[i, c] - rows[j, c]
            total += gap * gap
        return total <= self.budgets[block]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the key of each vector; null, and no vector, for those that take no part."""
    for batch in batches:
        found: list[bytes | None] = [None] * len(batch)
        for places, matrix in vector_rows.clean(batch.column(1)):
            some = matrix.any(1)
            for i, key in zip(places[some].tolist(), vector_rows.keys(matrix[some]), strict=True):
                found[i] = key
        key = pa.array(found, pa.binary())
        vector = pc.if_else(key.is_valid(), batch.column(1), pa.scalar(None, batch.column(1).type))
        yield pa.RecordBatch.from_arrays([batch.column(0), vector, key], names=["vec_id", "vector", "key"])


def _slabs(cosine: float, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in vector_rows.clean(batch.column(1)):
                n, d = matrix.shape
                slab = Blocks(d, blocks, cosine).slabs(turned(matrix))
                k = slab.shape[1]
                at = pa.array(np.repeat(places, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(n * k, d)), pa.array(np.tile(np.arange(k), n)), pa.array(slab.ravel())],
                    names=["kind", "vector", "d", "block", "slab"],
                )

    return run


def _tile(cosine: float, blocks: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        d, block = int(frame["d"].iloc[0]), int(frame["block"].iloc[0])
        matrix = np.stack(frame["vector"].to_numpy()).astype(float)
        vectors, rows = vector_rows.unit(matrix), turned(matrix)
        kinds, copies = frame["kind"].to_numpy(), frame["copies"].to_numpy()
        cut = Blocks(d, blocks, cosine)
        low, high = cut.edges[block], cut.edges[block + 1]
        radius, budget = cut.widths[block], cut.budgets[block] + _MARGIN
        # Both sides in the order of the sweep. A tile of a part with itself has one side.
        sweep = rows[:, low + 1] if high - low > 1 else rows[:, low]
        one = bool(frame["single"].iloc[0])
        side = frame["side"].to_numpy()
        a = np.flatnonzero(side == 0)
        b = a if one else np.flatnonzero(side == 1)
        a, b = a[np.argsort(sweep[a], kind="stable")], b[np.argsort(sweep[b], kind="stable")]
        links, found_a, found_b = np.zeros(len(frame), np.int64), [], []
        parts = rows[:, low:high]
        squares = (parts**2).sum(1)
        label = np.arange(len(frame))
        for first in range(0, len(a), STRIP):
            left = a[first : first + STRIP]
            start, end = np.searchsorted(sweep[b], [sweep[left[0]] - radius, sweep[left[-1]] + radius])
            for middle in range(start, end, 4 * STRIP):
                right = b[middle : min(end, middle + 4 * STRIP)]
                near = squares[left][:, None] + squares[right][None, :] - 2 * parts[left] @ parts[right].T <= budget
                if one:
                    near &= (first + np.arange(len(left)))[:, None] < (middle + np.arange(len(right)))[None, :]
                x, y = np.nonzero(near)
                for at in range(0, len(x), 1 << 16):
                    i, j = left[x[at : at + (1 << 16)]], right[y[at : at + (1 << 16)]]
                    close = np.einsum("ij,ij->i", vectors[i], vectors[j]) >= cosine
                    i, j = i[close], j[close]
                    # Of the blocks that find this pair only the first counts it.
                    mine = cut.within(rows, i, j, block)
                    for k in range(block):
                        mine &= ~cut.within(rows, i, j, k)
                    i, j = i[mine], j[mine]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    # Only links between what is not yet together here are kept: a forest.
                    while len(i):
                        u, v = label[i], label[j]
                        apart = u != v
                        i, j, u, v = i[apart], j[apart], u[apart], v[apart]
                        if not len(i):
                            break
                        top, bottom = np.maximum(u, v), np.minimum(u, v)
                        _, pick = np.unique(top, return_index=True)
                        found_a.append(i[pick])
                        found_b.append(j[pick])
                        label[top[pick]] = bottom[pick]
                        while True:
                            follow = label[label]
                            if (follow == label).all():
                                break
                            label = follow
        some = np.flatnonzero(links)
        ends = (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.empty(0, int), np.empty(0, int))
        return pd.DataFrame(
            {
                "kind": np.concatenate([kinds[some], kinds[ends[0]]]),
                "links": np.concatenate([links[some], np.zeros(len(ends[0]), np.int64)]),
                "other": pd.array([None] * len(some) + kinds[ends[1]].tolist(), "Int64"),
            }
        )

    return run


def near_vectors(rows: DataFrame, *, cosine: float = COSINE, blocks: int = BLOCKS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row. Runs jobs.

    Two vectors are linked if the cosine of both, in double precision, is at least ``cosine``. ``n_links`` counts the other
    rows that a row is linked with, ``component_id`` is the least id that links lead to. Rows whose vector is null, empty, zero or
    holds null or non-finite components are linked with nothing, as are vectors of different lengths. Rows of equal ids count each. A null id is larger than all others. An empty table gives no rows.

    Equal vectors are one kind with a number of copies, so copies are never compared. Each kind goes to the tiles of
    its slab and the next one in every block; slabs of more than ``TILE`` kinds are cut into parts, and each pair of
    parts is a tile, so no task holds more than two parts, however many vectors are alike. A tile gives back counts and a forest of links,
    never its pairs. Equal vectors are found by a 128-bit digest. The number of tiles of a slab grows with the square of its parts, as any exact join by these budgets does where vectors are not spread out.
    """
    source = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    keyed = materialize(source.mapInArrow(_keyed, f"vec_id long, vector {source.schema['vector'].dataType.simpleString()}, key binary"), "vectors")
    kinds = keyed.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"), F.first("vector").alias("vector"))
    kinds = materialize(kinds.withColumn("kind", F.monotonically_increasing_id()), "kinds")  # written once, so numbers stay
    placed = kinds.select("kind", "vector").mapInArrow(_slabs(cosine, blocks), f"kind long, vector {source.schema['vector'].dataType.simpleString()}, d long, block long, slab long")
    placed = materialize(placed, "slabs")
    # One row for each slab of each block: few, unless the cosine is near 1. Written, so Spark knows the size and broadcasts it or not.
    sizes = materialize(placed.groupBy("d", "block", "slab").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts")), "sizes")
    parts = sizes
    following = sizes.select("d", "block", (F.col("slab") - 1).alias("slab"), F.col("parts").alias("next"))
    before = sizes.select("d", "block", (F.col("slab") + 1).alias("slab"), F.col("parts").alias("last"))
    key = ["d", "block", "slab"]
    dealt = placed.join(parts, key).join(following, key, "left").join(before, key, "left").withColumn("part", F.pmod(F.xxhash64("kind"), F.col("parts")))
    none = F.expr("cast(array() as array<struct<home:bigint,x:bigint,y:bigint,side:int,single:boolean>>)")
    # Tiles (home slab, x, y): two parts of one slab, or part x of it with part y of the next (numbered behind its own).
    own = "transform(sequence(0L, parts - 1), p -> named_struct('home', slab, 'x', least(part, p), 'y', greatest(part, p), 'side', if(part > p, 1, 0), 'single', part = p))"
    ahead = "transform(sequence(0L, next - 1), p -> named_struct('home', slab, 'x', part, 'y', parts + p, 'side', 0, 'single', false))"
    back = "transform(sequence(0L, last - 1), p -> named_struct('home', slab - 1, 'x', p, 'y', last + part, 'side', 1, 'single', false))"
    tiles = F.concat(F.expr(own), F.coalesce(F.expr(f"if(next is null, null, {ahead})"), none), F.coalesce(F.expr(f"if(last is null, null, {back})"), none))
    tiled = dealt.withColumn("tile", F.explode(tiles)).select("kind", "vector", "d", "block", "tile.*")
    counted = tiled.join(kinds.select("kind", "copies"), "kind")
    found = materialize(counted.groupBy("d", "block", "home", "x", "y").applyInPandas(_tile(cosine, blocks), "kind long, links long, other long"), "tiles")

    links = found.groupBy("kind").agg(F.sum("links").alias("links"))
    whole = components(found.where("other is not null").selectExpr("kind as a", "other as b"))
    named = (
        kinds.select("key", "kind", "copies", "least")
        .join(links, "kind", "left")
        .join(whole, F.col("kind") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "kind"))
    )
    named = materialize(named.select("key", "copies", "least", "links", "component"), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_kind = named.join(least, "component").select("key", "copies", "links", "component_id")
    out = keyed.select("vec_id", "key").join(by_kind, "key", "left")
    taken = F.col("key").isNotNull()
    n = F.when(taken, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long")
    own_id = F.when(taken, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", n.alias("n_links"), own_id.alias("component_id"), F.col("vec_id").eqNullSafe(own_id).alias("kept"))
