"""What several of the operators need: distinct column names, running totals, Arrow text, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.sources.scratch import materialize


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The values of a text column; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def parts(batch: pa.RecordBatch, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows, so that few of its texts are Python objects at a time."""
    return (batch.slice(at, rows) for at in range(0, len(batch), rows))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and the offsets of the texts in them; null is the empty text."""
    filled = column.cast(pa.large_string()).fill_null("")
    if not len(filled):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cut texts into runs (first, last + 1) of about ``size`` bytes, or of one text that is longer."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = max(first + 1, min(n, last))
        yield first, last
        first = last


def running(df: DataFrame, order: Iterable[Column], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows that come before, in the given order. Runs jobs.

    The rows are sorted over all tasks; each task adds up its own rows and notes its place, the rows are
    written once, and the sums of the tasks, one row for each, are added up and joined back. ``df`` should
    be cheap to read twice, as the sort samples it first. Equal rows keep an arbitrary order among them.
    """
    part, before = unused(df, "part"), unused(df, "before")
    schema = T.StructType([*df.schema.fields, T.StructField(part, T.LongType()), T.StructField(before, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = total + np.cumsum(values)
            columns = [*batch.columns, pa.array(np.full(len(values), task)), pa.array(sums - values)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, part, before])
            total = int(sums[-1]) if len(sums) else total

    placed = materialize(df.orderBy(*order).mapInArrow(add, schema), "running")
    sums = placed.groupBy(part).agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select(part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_first"))
    # One row for each task of the sort, whose number is bounded by spark.sql.shuffle.partitions.
    return (
        placed.join(F.broadcast(firsts), part)
        .withColumn(name, F.col(before) + F.col("_first"))
        .drop(part, before, "_first")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges (a, b)``; a component is named by its least node. Runs jobs.

    Each round maps every node to the least of itself and its neighbours and joins the edges' ends to their
    new names; edges inside one name vanish. At most half of the nodes of a component keep their name, so
    the rounds are at most the logarithm of its size. All rounds are written tables; nothing is collected
    but whether edges are left.
    """
    both = edges.where("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct()
    graph, names = materialize(both, "edges"), None
    while not graph.isEmpty():
        ends = graph.unionByName(graph.selectExpr("b as a", "a as b"))
        least = materialize(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "names")
        step = least.selectExpr("a as node", "to as component")
        if names is None:
            names = step
        else:
            later = least.selectExpr("a as component", "to as _to")
            names = materialize(
                names.join(later, "component", "left").selectExpr("node", "coalesce(_to, component) as component"),
                "names",
            )
        to_a, to_b = least.selectExpr("a", "to as _a"), least.selectExpr("a as b", "to as _b")
        moved = graph.join(to_a, "a").join(to_b, "b").where("_a <> _b")
        graph = materialize(moved.selectExpr("least(_a, _b) as a", "greatest(_a, _b) as b").distinct(), "edges")
    if names is None:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    # A node that no later edge names already stands for its component; others are followed to the end.
    return names
