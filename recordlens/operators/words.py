"""Word counting over a text column.

One explode feeds one hash aggregate with map-side partial counts, so a word that makes up a large
share of the text costs one partial row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.functions import folded, java_split_words, split_words


def words(
    df: DataFrame,
    text: str = "value",
    *,
    fold: bool = False,
    drop_empty: bool = False,
    java_split: bool = False,
) -> DataFrame:
    """One ``word`` row per space-separated word of ``text``."""
    source = folded(F.col(text)) if fold else F.col(text)
    parts = java_split_words(source) if java_split else split_words(source)
    if drop_empty:
        parts = F.array_remove(parts, "")
    return df.select(F.explode(parts).alias("word"))


def count_words(
    df: DataFrame,
    text: str = "value",
    *,
    fold: bool = False,
    drop_empty: bool = False,
    java_split: bool = False,
) -> DataFrame:
    """``word, count`` over all rows; with ``fold`` upper and lower case count together."""
    return words(df, text, fold=fold, drop_empty=drop_empty, java_split=java_split).groupBy("word").count()


def fold_counts(counts: DataFrame) -> DataFrame:
    """Merge the counts of words that differ in case only.

    For counts that exist already. From text, ``count_words(fold=True)`` gives the same rows with
    one shuffle less.
    """
    return counts.groupBy(folded(F.col("word")).alias("word")).agg(F.sum("count").alias("count"))


def ranked(counts: DataFrame, keys: str | Sequence[str] = "word") -> DataFrame:
    """Highest count first; equal counts in key order."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return counts.orderBy(F.desc("count"), *keys)


def top(counts: DataFrame, k: int, keys: str | Sequence[str] = "word") -> DataFrame:
    """The ``k`` highest counts; each task keeps only its own ``k`` best."""
    return ranked(counts, keys).limit(k)
