"""Profiling operators: counts, summaries and frequency tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.operators.words import top

# Spread of the first of the two ranking steps in ``top_values``.
_RANK_BUCKETS = 64


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _is_number(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.NumericType)


def summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: position, type, present and missing values, mean, deviation, least, greatest.

    All columns are summarised in one aggregate over one scan. Mean and deviation of a text column
    cover its values that parse as numbers. ``min`` and ``max`` are given as text because the
    columns differ in type.
    """
    fields = {field.name: (position, field.dataType) for position, field in enumerate(df.schema)}
    columns = list(fields) if columns is None else list(columns)
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(columns):
        col, data_type = F.col(name), fields[name][1]
        number = col.cast("double") if _is_number(data_type) else col.cast("string").try_cast("double")
        aggregates += [
            F.count(col).alias(f"n_{i}"),
            F.avg(number).alias(f"mean_{i}"),
            F.stddev_samp(number).alias(f"stddev_{i}"),
            F.min(col).cast("string").alias(f"min_{i}"),
            F.max(col).cast("string").alias(f"max_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(fields[name][0]).alias("position"),
            F.lit(fields[name][1].simpleString()).alias("type"),
            F.col(f"n_{i}").alias("n"),
            (F.col("n_rows") - F.col(f"n_{i}")).alias("n_null"),
            F.col(f"mean_{i}").alias("mean"),
            F.col(f"stddev_{i}").alias("stddev"),
            F.col(f"min_{i}").alias("min"),
            F.col(f"max_{i}").alias("max"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """How often each value, or each combination of values, occurs."""
    return df.groupBy(*columns).count()


def top_counts(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values or combinations; equal counts in value order."""
    return top(value_counts(df, *columns), k, list(columns))


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values of each column: ``column, value, count, rank``.

    All frequency tables come from one scan and one aggregate over (column, value). The values are
    ranked first within hash buckets and then among the bucket winners, so no task sorts the
    whole frequency table of a column, however many distinct values it has.
    """
    named = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    counts = named.unpivot([], list(columns), "column", "value").groupBy("column", "value").count()
    order = [F.desc("count"), F.col("value").asc_nulls_first()]

    def best(rows: DataFrame, *keys: str | Column) -> DataFrame:
        ranks = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("rank", ranks).where(F.col("rank") <= k)

    bucket = F.pmod(F.hash("value"), F.lit(_RANK_BUCKETS))
    winners = best(counts, "column", bucket).drop("rank")
    return best(winners, "column")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(column).dropDuplicates()


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct combinations of several columns."""
    return df.select(*columns).distinct()


def first_rows(df: DataFrame, n: int, keys: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*([keys] if isinstance(keys, str) else keys)).limit(n)


def schema_table(df: DataFrame) -> DataFrame:
    """The columns of ``df`` with position and type, as a table."""
    rows = [(i, field.name, field.dataType.simpleString(), field.nullable) for i, field in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")
