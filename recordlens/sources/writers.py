"""Writers. Each one runs a job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from recordlens.sources import files


def write_parquet(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """Write ``df`` as parquet; an existing path is replaced with ``overwrite`` and refused without.

    A table is replaced only once the new one is complete: it is written beside the old one and takes its
    place by two renames. So a job that fails leaves the old table as it was, and a table may be replaced by what is
    read from it. Where a store copies files to rename them, that costs a copy. If the driver dies between the
    renames the old table stands beside ``path``; the next overwrite, or ``restore_interrupted``, puts it back.
    """
    if not overwrite:
        df.write.mode("errorifexists").parquet(path)
        return
    spark = df.sparkSession
    restore_interrupted(spark, path)
    new = files.beside(path, f"new-{uuid.uuid4().hex}")
    try:
        df.write.mode("errorifexists").parquet(new)
        _swap(spark, new, path)
    except BaseException:
        files.delete(spark, new)
        raise


def _swap(spark: SparkSession, new: str, path: str) -> None:
    old = files.beside(path, f"old-{uuid.uuid4().hex}")
    if files.exists(spark, path):
        files.rename(spark, path, old)
    try:
        files.rename(spark, new, path)
    except BaseException:
        if files.exists(spark, old):
            files.rename(spark, old, path)
        raise
    files.delete(spark, old)
    spark.catalog.refreshByPath(path)


def restore_interrupted(spark: SparkSession, path: str) -> bool:
    """Put back the table that an overwrite had moved aside when its driver died; says whether there was one."""
    if files.exists(spark, path):
        return False
    aside = files.siblings(spark, path, files.beside(path, "old-").rpartition("/")[2])
    if aside:
        files.rename(spark, aside[0], path)
    return bool(aside)


def write_csv(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    """Write CSV with a header, doubling quotes inside quoted text, as ``read_csv`` expects it."""
    (
        df.write.mode("overwrite" if overwrite else "errorifexists")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_text(df: DataFrame, column: str, path: str, *, overwrite: bool = False) -> None:
    """Write one text column as lines; null is written as an empty line."""
    df.select(column).write.mode("overwrite" if overwrite else "errorifexists").option("lineSep", "\n").text(path)
