"""Summaries of tables that grow: a state for each part, stored, and merged into the summary of all parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def summary_state(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """What merging needs of each column, one struct for each, in one row, or one row for each value of ``by``.

    ``rows`` and ``n`` count rows and present values, ``k`` the numbers among them, with their ``mean`` and ``squares``, the sum of their squared
    differences from it; ``least`` and ``greatest`` keep the column's type. One scan, one aggregate.
    """
    types = {field.name: field.dataType for field in df.schema}
    names = [c for c in types if c not in by] if columns is None else list(columns)

    def state(name: str) -> Column:
        col = F.col(f"`{name}`")
        number = col.cast("double") if _is_number(types[name]) else col.cast("string").try_cast("double")
        k = F.count(number)
        return F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count(col).alias("n"),
            k.alias("k"),
            F.avg(number).alias("mean"),
            F.when(k > 0, F.var_pop(number) * k).alias("squares"),
            F.min(col).alias("least"),
            F.max(col).alias("greatest"),
        ).alias(name)

    grouped = df.groupBy(*by) if by else df
    return grouped.agg(*[state(name) for name in names])


def add_state(states: DataFrame, path: str) -> None:
    """Store the states of new parts beside those that are at ``path``. Runs a job, over the new parts only."""
    states.write.mode("append").parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_summary(states: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The table that ``profile.summary`` gives for all rows behind ``states``, from the states alone. Runs a job.

    The means of all parts are merged first, then the squared differences are moved to the common mean, so no large sums cancel.
    ``position`` is the column's place among the states. Without states there are no rows behind them: counts are 0.
    """
    kinds = {f.name: f.dataType["least"].dataType for f in states.schema if isinstance(f.dataType, T.StructType) and "least" in f.dataType.names}
    names = list(kinds) if columns is None else list(columns)
    part = {name: F.col(f"`{name}`") for name in names}
    sums = [F.sum(part[name]["k"] * part[name]["mean"]) / F.sum(F.when(part[name]["k"] > 0, part[name]["k"])) for name in names]
    # One number for each column.
    means = states.agg(*[s.alias(f"mean_{i}") for i, s in enumerate(sums)]).first()
    aggregates = []
    for i, name in enumerate(names):
        p, mean = part[name], F.lit(means[i]).cast("double")
        moved = p["squares"] + p["k"] * (p["mean"] - mean) * (p["mean"] - mean)
        aggregates += [
            F.coalesce(F.sum(p["rows"]), F.lit(0)).alias(f"rows_{i}"),
            F.coalesce(F.sum(p["n"]), F.lit(0)).alias(f"n_{i}"),
            F.sum(p["k"]).alias(f"k_{i}"),
            F.sum(moved).alias(f"squares_{i}"),
            F.min(p["least"]).cast("string").alias(f"min_{i}"),
            F.max(p["greatest"]).cast("string").alias(f"max_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(i).alias("position"),
            F.lit(kinds[name].simpleString()).alias("type"),
            F.col(f"n_{i}").alias("n"),
            (F.col(f"rows_{i}") - F.col(f"n_{i}")).alias("n_null"),
            F.lit(means[i]).cast("double").alias("mean"),
            F.when(F.col(f"k_{i}") > 1, F.sqrt(F.col(f"squares_{i}") / (F.col(f"k_{i}") - 1))).alias("stddev"),
            F.col(f"min_{i}").alias("min"),
            F.col(f"max_{i}").alias("max"),
        )
        for i, name in enumerate(names)
    ]
    return states.agg(*aggregates).select(F.inline(F.array(*rows)))
