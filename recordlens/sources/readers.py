"""Readers for text lines, CSV with quoted text, and parquet."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.operators.clean import cast_columns, cast_text
from recordlens.operators.infer import infer_types
from recordlens.sources.scratch import materialize


def read_text(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """One row per line in a single ``value STRING`` column.

    Without ``line_sep`` a line ends at ``\\r``, ``\\n`` or ``\\r\\n``. Files are split by size, so a
    large file is read by many tasks.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    types: Mapping[str, str] | None = None,
    *,
    others: bool = False,
    escape: str = '"',
    quote: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, columns taken by their names in it, as text and then narrowed to ``types``.

    The names are read from the first line of one file; no pass infers types. The rows have ``columns`` in the given
    order (all without it) and, with ``others``, whatever else the header names behind them. A wanted column that the header lacks
    is a ``ValueError``, and a file whose header differs from the first one's fails when it is read. A doubled
    quote inside quoted text is a literal quote (``escape``). Text that does not parse as the wanted type becomes null.
    ``multi_line`` allows line breaks inside quoted text, but each file is then read by one task, so leave it off for large files.
    Fields beyond the header's are dropped and missing ones are null; ``read_csv_checked`` sets such rows apart.
    """
    options = {"header": True, "escape": escape, "quote": quote, "multiLine": multi_line}
    found, wanted = _header(spark, path, options, columns)
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in found])
    raw = spark.read.schema(schema).options(**options, enforceSchema=False).csv(path)
    rest = [name for name in found if name not in wanted] if others else []
    raw = raw.select(*[f"`{name}`" for name in [*wanted, *rest]])
    return cast_columns(raw, types) if types else raw


def _header(spark: SparkSession, path: str | list[str], options: Mapping, columns: Iterable[str] | None) -> tuple[list[str], list[str]]:
    """The columns that the header names, and those that are wanted of them."""
    found = spark.read.options(**options).csv(path).columns
    wanted = list(found if columns is None else columns)
    if missing := [name for name in wanted if name not in found]:
        raise ValueError(f"the header names no column {', '.join(missing)}")
    return found, wanted


class Checked(NamedTuple):
    """The rows of a CSV that are as its header says, and the others."""

    good: DataFrame
    rejected: DataFrame


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    types: Mapping[str, str] | None = None,
    *,
    strict: bool = False,
    escape: str = '"',
    quote: str = '"',
    multi_line: bool = False,
) -> Checked:
    """Like ``read_csv``, with malformed rows set apart instead of cut or filled up. Runs a job.

    ``rejected`` has the columns ``file, line, n_fields, reason``: rows of more or fewer fields than the header. A quote that does not end takes
    the rest of its line, so it shows as too few fields, and is named as the reason. With ``strict`` also rows whose text does not parse as the wanted type of ``types``; of those the line is
    written anew from its fields. Every row is in exactly one of both tables. An empty line is no row, as for ``read_csv``. The file is parsed once, into a
    scratch table that both read.
    """
    options = {"header": True, "escape": escape, "quote": quote, "multiLine": multi_line}
    found, wanted = _header(spark, path, options, columns)
    broken, file = (_unused(found, name) for name in ("_broken", "_file"))
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in [*found, broken]])
    reader = spark.read.schema(schema).options(**options, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=broken)
    rows = materialize(reader.csv(path).select("*", F.col("_metadata.file_path").alias(file)), "parsed")

    line, fits = F.col(f"`{broken}`"), F.lit(True)
    reasons = []
    if strict and types:
        for name, kind in types.items():
            unfit = F.col(f"`{name}`").isNotNull() & cast_text(F.col(f"`{name}`"), kind).isNull()
            reasons.append(F.when(unfit, F.lit(f"{name} is no {kind}")))
            fits &= ~unfit
    good = rows.where(line.isNull() & fits).select(*[f"`{name}`" for name in wanted])
    written = F.to_csv(F.struct(*[f"`{name}`" for name in found]), {"escape": escape, "quote": quote})
    n, shape = _fields(line, escape, quote), len(found)
    malformed = (
        F.when(n.isNull(), "a quote does not end").when(n > shape, "too many fields").when(n < shape, "too few fields").otherwise("malformed")
    )
    rejected = rows.where(line.isNotNull() | ~fits).select(
        F.col(f"`{file}`").alias("file"),
        F.coalesce(line, written).alias("line"),
        F.when(line.isNull(), F.lit(shape)).otherwise(n).alias("n_fields"),
        F.when(line.isNotNull(), malformed).otherwise(F.concat_ws("; ", *reasons)).alias("reason"),
    )
    return Checked(cast_columns(good, {k: v for k, v in types.items() if k in wanted}) if types else good, rejected)


def _unused(taken: Iterable[str], name: str) -> str:
    names = {t.lower() for t in taken}
    while name.lower() in names:
        name = f"_{name}"
    return name


def _fields(line: Column, escape: str, quote: str, sep: str = ",") -> Column:
    """The number of fields of a line: separators outside of quotes, and one; null if a quote does not end."""
    q, e = re.escape(quote), re.escape(escape)
    inside = f"(?:[^{q}]++|{q}{q})*+" if escape == quote else f"(?:[^{q}{e}]++|{e}.)*+"
    outside = F.regexp_replace(line, f"(?s){q}{inside}{q}", "")
    count = F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1
    return F.when(~F.contains(outside, F.lit(quote)), count)


def read_csv_inferred(spark: SparkSession, path: str | list[str], *, least_share: float = 1.0, **options) -> DataFrame:
    """``read_csv`` of all columns with the types that ``infer_types`` finds over all rows. Runs a job.

    With a ``least_share`` below 1 the values that do not fit their column's type become null.
    """
    raw = read_csv(spark, path, **options)
    # One row for each column.
    types = {row["column"]: row["type"] for row in infer_types(raw, least_share=least_share).collect() if row["type"] != "string"}
    return cast_columns(raw, types)


def read_parquet(spark: SparkSession, path: str | list[str], *, merge_schema: bool = False) -> DataFrame:
    """Parquet file, folder or glob.

    ``merge_schema`` takes the union of the columns of all part files; it reads every footer, so it is off by default.
    """
    paths = [path] if isinstance(path, str) else path
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)
