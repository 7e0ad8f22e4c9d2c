"""Files and folders through Hadoop's FileSystem, in whatever store a path is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole folder; nothing happens if it is not there."""
    system, place = _at(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder inside one store."""
    system, place = _at(spark, old)
    if not system.rename(place, _at(spark, new)[1]):
        raise OSError(f"{old} could not be renamed to {new}")


def siblings(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The paths beside ``path`` whose names begin with ``prefix``, the latest first."""
    system, place = _at(spark, path)
    parent = place.getParent()
    if parent is None or not system.exists(parent):
        return []
    found = [f for f in system.listStatus(parent) if f.getPath().getName().startswith(prefix)]
    return [f.getPath().toString() for f in sorted(found, key=lambda f: -f.getModificationTime())]


def beside(path: str, mark: str) -> str:
    """A path in the same folder whose leading underscore hides it from readers of that folder."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{mark}" if parent else f"_{name}.{mark}"
