"""The searches over vectors against brute force."""

import collections

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlens.llm import adaptive_scan, vectors
from tests.llm.test_operators import odd_vectors, table


def nearest_of(rows, k, is_query):
    """Ranked (id, score) lists of the first row by vector of each query id."""
    clean = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i in sorted({i for i, _ in clean if is_query(i)}):
        q = np.array(min(v.tolist() for j, v in clean if j == i))
        scored = [(j, float((q * v).sum() / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum())))) for j, v in clean if j != i and len(v) == len(q)]
        out[i] = sorted(scored, key=lambda s: (-s[1], s[0]))[:k]
    return out


def lists_of(found):
    out = collections.defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, wanted):
    hits = sum(len({i for i, _ in wanted[q]} & {i for i, _ in found.get(q, [])}) for q in wanted)
    return hits / max(1, sum(map(len, wanted.values())))


@pytest.mark.parametrize(("in_list", "part", "block"), [(1024, 8192, 1024), (40, 16, 5)])
def test_neighbours_reach_the_recall(spark, medium, monkeypatch, in_list, part, block):
    for name, value in (("LIST", in_list), ("PART", part), ("QUERIES", block)):
        monkeypatch.setattr(adaptive_scan, name, value)
    rows = [(int(i), v.tolist()) for i, v in zip(*(table(medium, "embeddings")[c] for c in ("vec_id", "embedding")), strict=True)]
    rows += [(1000 + i, (np.array(rows[0][1]) + 1e-3 * np.random.default_rng(i).normal(size=64)).tolist()) for i in range(250)]  # a third near copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found, wanted = lists_of(adaptive_scan.nearest_neighbours(df, F.col("vec_id") % 50 == 0)), nearest_of(rows, 5, lambda i: i % 50 == 0)
    assert found.keys() == wanted.keys() and all(len(v) == 5 for v in found.values())
    assert recall(found, wanted) >= 0.95
    exact = {q: dict(nearest_of([r for r in rows if r[0] != q or True], len(rows), lambda i, q=q: i == q)[q]) for q in list(found)[:4]}
    assert all(abs(s - exact[q][i]) < 1e-12 for q in exact for i, s in found[q])


def test_neighbours_of_odd_vectors(spark):
    rows, df = odd_vectors(spark)
    rows = [*rows, (5, [1.0] * 16, 0), (309, [-0.0, 3.0], 0), (310, [0.0, 5.0], 0), (311, [1e200, 1e200], 0), (312, [1e-200, 1e-200], 0), (320, [1.0, None], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as score", "2 as list", "3 as key")
    found = lists_of(adaptive_scan.nearest_neighbours(df, F.col("vec_id") % 5 == 0, k=6))
    wanted = nearest_of([r for r in rows if r[0] not in (311, 312)], 6, lambda i: i % 5 == 0)
    for q in (q for q in wanted if q not in (300, 305, 310)):
        assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in wanted[q]], rtol=0, atol=1e-12)
    assert [i for i, _ in found[310]][:1] == [309] and {i for i, _ in found[310]} == {306, 307, 309, 311, 312}
    assert set(found) == set(wanted)
    assert adaptive_scan.nearest_neighbours(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert adaptive_scan.nearest_neighbours(df, F.lit(None).cast("boolean")).count() == 0


def test_tests_abandon_early_and_keep_what_is_near():
    rng = np.random.default_rng(13)
    centre = rng.normal(size=(20, 64))
    points = vectors.unit(np.repeat(centre, 200, 0) + 0.4 * rng.normal(size=(4000, 64)))
    asked = points[::200] @ adaptive_scan.rotation(64)
    turned = points @ adaptive_scan.rotation(64)
    distance = 2 - 2 * asked @ turned.T
    reach = np.sort(distance, 1)[:, 5]
    i, j, found = adaptive_scan.survivors(asked, turned, reach)
    assert np.allclose(found, distance[i, j], atol=1e-9) and (found <= reach[i] + 1e-8).all()
    assert len(i) >= 0.95 * (distance <= reach[:, None]).sum()
    first = ((asked[:, None, :16] - turned[None, :, :16]) ** 2).sum(2) <= (reach * 16 / 64 * (1 + 2.1 / 4) ** 2)[:, None]
    assert first.mean() < 0.2  # most candidates are gone after a quarter of the columns


def test_clean_vectors_of_slices():
    column = pa.array([[1.0, 2.0], None, [], [None, 1.0], [float("nan"), 1.0], [3.0], [4.0, 5.0], [float("inf")]], pa.list_(pa.float32()))
    found = {m.shape[1]: (at.tolist(), m.tolist()) for at, m in vectors.clean(column)}
    assert found == {1: ([5], [[3.0]]), 2: ([0, 6], [[1.0, 2.0], [4.0, 5.0]])}
    assert [(at.tolist(), m.tolist()) for at, m in vectors.clean(column.slice(4, 3))] == [([1], [[3.0]]), ([2], [[4.0, 5.0]])]
    assert not list(vectors.clean(column.slice(1, 2))) and not list(vectors.clean(pa.chunked_array([], column.type)))


def test_recall_of_the_query(spark, medium):
    from recordlens.llm import queries

    rows = duckdb.sql(f"select vec_id, embedding from '{medium}/embeddings.parquet'").fetchall()
    assert recall(lists_of(queries.op11_adaptive_scan(spark, medium)), nearest_of(rows, 5, lambda i: i % 50 == 0)) >= 0.95
