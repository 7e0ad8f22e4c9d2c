"""Column types from the values of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How numbers, dates and times are written. From narrow to wide.
_WHOLE = r"^[+-]?[0-9]{1,19}$"
_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"
TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")


def fits(col: Column, kind: str) -> Column:
    """Whether a text is written as a value of one of ``TYPES`` and is in its range; null for null."""
    text = F.trim(col)
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    pattern = {"int": _WHOLE, "bigint": _WHOLE, "double": _DECIMAL, "date": _DATE, "timestamp": _TIME}[kind]
    return text.rlike(pattern) & text.try_cast(kind).isNotNull()


def infer_types(df: DataFrame, columns: Sequence[str] | None = None, *, least_share: float = 1.0) -> DataFrame:
    """``column, position, type, n, n_null, n_fit, share``: the narrowest type that ``least_share`` of a column's values fit.

    All values of all rows are tested in one aggregate over one scan; nothing is sampled. ``n`` counts the values that are not null, ``n_fit``
    those that fit the type, ``share`` is their quotient, null where there are no values. A text column whose values fit
    nothing else, or that has none, is a ``string``; columns of another type keep it.
    """
    if not 0 < least_share <= 1:
        raise ValueError("least_share must be above 0 and at most 1")
    fields = {field.name: (position, field.dataType) for position, field in enumerate(df.schema)}
    columns = list(fields) if columns is None else list(columns)
    texts = [name for name in columns if isinstance(fields[name][1], T.StringType)]
    # The types that a value fits, as bits; equal bits of a column are counted in each task before they are shuffled.
    value = F.col("value")
    bits = sum((F.when(fits(value, kind), 1 << i).otherwise(0) for i, kind in enumerate(TYPES)), F.lit(0))
    long = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in columns]).unpivot([], [f"`{name}`" for name in columns], "column", "value")
    tested = long.select("column", F.when(value.isNotNull(), F.when(F.col("column").isin(texts), bits).otherwise(0)).alias("bits"))
    counts = tested.groupBy("column", "bits").count().groupBy("column").agg(
        F.sum("count").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("bits").isNotNull(), F.col("count"))), F.lit(0)).alias("n"),
        *[F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) > 0, F.col("count"))), F.lit(0)).alias(f"n_{kind}") for i, kind in enumerate(TYPES)],
    )
    known = df.sparkSession.createDataFrame([(name, fields[name][0], fields[name][1].simpleString()) for name in columns], "column string, position int, own string")
    n = F.coalesce("n", F.lit(0))
    choices = [F.when((n > 0) & (F.col(f"n_{kind}") >= F.lit(least_share) * n), F.struct(F.lit(kind).alias("type"), F.col(f"n_{kind}").alias("n_fit"))) for kind in TYPES]
    found = F.coalesce(*choices, F.struct(F.col("own").alias("type"), n.alias("n_fit")))
    rows = known.join(counts, "column", "left").withColumns({"found": found, "n": n, "n_null": F.coalesce(F.col("n_rows") - n, F.lit(0))})
    return rows.select("column", "position", "found.type", "n", "n_null", "found.n_fit", F.when(F.col("n") > 0, F.col("found.n_fit") / F.col("n")).alias("share"))
