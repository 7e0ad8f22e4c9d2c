"""Scratch tables in the folder that the cluster shares between its executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from recordlens.sources.files import delete

_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def _root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, or under the warehouse where that is not set."""
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a scratch table and return the table. Runs a job.

    Used where several jobs read the same intermediate rows: it survives the loss of executors,
    needs no executor memory, and later readers still get column pruning and filter pushdown.
    Inside a ``scope`` the table is deleted when that ends; outside it stays, like a checkpoint.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Own the scratch tables that are made inside and delete them at the end, also after an error.

    A scope inside another owns its own tables. What leaves a scope must not read them any more.
    """
    paths: list[str] = []
    before = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(before)
        for path in paths:
            delete(spark, path)


def materialize_last(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` what ``make`` gives and delete the scratch tables that it wrote on the way. Runs jobs."""
    path = scratch_path(spark, name)
    with scope(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def lasting() -> Iterator[None]:
    """Tables that are made inside belong to no scope and stay like checkpoints: those behind a model that is given back."""
    before = _owned.set(None)
    try:
        yield
    finally:
        _owned.reset(before)


def scoped(function: Callable) -> Callable:
    """Run a function whose first argument is a DataFrame, and whose result reads no scratch table, in a scope."""

    @wraps(function)
    def run(df: DataFrame, *args, **kwargs):
        with scope(df.sparkSession):
            return function(df, *args, **kwargs)

    return run
