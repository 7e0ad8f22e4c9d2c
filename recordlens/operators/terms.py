"""Text and category features in relational (long) form.

One row per (document, term) or per label instead of one vector per document. Nothing here is held
on the driver, so vocabularies and label sets may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens.functions import STOP_WORDS, term_counts, tokens, without_stop_words
from recordlens.sources.scratch import materialize

# monotonically_increasing_id() keeps the row number within a partition in its lower 33 bits.
_ROW_BITS = 33


def add_tokens(df: DataFrame, text: str = "text", name: str = "tokens", *, unicode: bool = False) -> DataFrame:
    """Add the token list of a text column."""
    return df.withColumn(name, tokens(F.col(text), unicode=unicode))


def remove_stop_words(
    df: DataFrame,
    column: str = "tokens",
    name: str = "filtered",
    *,
    stop_words=STOP_WORDS,
    case_sensitive: bool = False,
) -> DataFrame:
    """Add the token list without stop words. Tokens that are lower case already may be compared as they are."""
    return df.withColumn(name, without_stop_words(F.col(column), stop_words, case_sensitive=case_sensitive))


def count_tokens(df: DataFrame, column: str = "tokens", name: str = "n_tokens") -> DataFrame:
    """Add the length of a token list."""
    return df.withColumn(name, F.size(column))


def term_frequencies(df: DataFrame, key: str, column: str = "filtered") -> DataFrame:
    """``key, term, tf``: how often each term occurs in its document. No shuffle."""
    return df.select(key, F.inline(term_counts(F.col(column))))


def vocabulary(
    df: DataFrame, column: str = "filtered", *, min_df: float = 1, max_terms: int | None = None
) -> DataFrame:
    """``term, count, df``: occurrences and number of documents of each term.

    ``min_df`` keeps terms of at least so many documents, or, below 1, of at least that share of
    them. ``max_terms`` keeps the most frequent terms, which runs jobs. Terms are counted
    inside each document first, then per task, and only then shuffled.
    """
    terms = _of_postings(df.select(F.inline(term_counts(F.col(column)))))
    return _kept(terms, df, min_df, max_terms)


def _of_postings(postings: DataFrame) -> DataFrame:
    """``term, count, df`` of one row for each term of each document."""
    return postings.groupBy("term").agg(F.sum("tf").alias("count"), F.count(F.lit(1)).alias("df"))


def _kept(terms: DataFrame, df: DataFrame, min_df: float, max_terms: int | None) -> DataFrame:
    """Terms of at least ``min_df`` documents or that share of ``df``, or the ``max_terms`` most frequent of them, which runs jobs."""
    if min_df > 1:
        terms = terms.where(F.col("df") >= min_df)
    elif 0 < min_df < 1:
        n_documents = df.agg(F.count(F.lit(1))).scalar()
        terms = terms.where(F.col("df") >= n_documents * min_df)
    return terms if max_terms is None else most_frequent(terms, max_terms)


def most_frequent(terms: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms of the highest counts; equal counts in term order.

    The rows are numbered in a distributed sort, whatever ``k`` and their number. Runs jobs.
    """
    counted = materialize(terms, "terms")
    return global_index(counted, F.desc("count"), F.col("term")).where(F.col("index") < k).drop("index")


def idf(n_documents: Column, df: Column) -> Column:
    """Inverse document frequency ``ln((N + 1) / (df + 1))``."""
    return F.log((n_documents + 1.0) / (df + 1.0))


def term_weights(
    df: DataFrame, key: str, column: str = "filtered", *, min_df: float = 1, max_terms: int | None = None
) -> DataFrame:
    """``key, term, tf, df, tfidf`` for every term of every document. Runs jobs.

    The terms of each document are counted once and written to a scratch table, as are the vocabulary's counts over it. The join of both
    carries no hint: Spark sees the vocabulary's size and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``. Otherwise both sides are shuffled for this join alone,
    which is what lets ``spark.sql.adaptive.skewJoin`` split a term that most documents hold.
    """
    n_documents = df.agg(F.count(F.lit(1))).scalar()
    postings = materialize(term_frequencies(df, key, column), "postings")
    known = materialize(_kept(_of_postings(postings), df, min_df, max_terms).select("term", "df"), "vocabulary")
    return (
        postings.join(known, "term")
        .select(key, "term", "tf", "df", (F.col("tf") * idf(n_documents, F.col("df"))).alias("tfidf"))
    )


def global_index(df: DataFrame, *order: Column, name: str = "index") -> DataFrame:
    """Number the rows 0, 1, 2, … in the given order. Runs a job.

    ``row_number`` over the whole table would move it into one task. Here the sorted rows are
    written once with their partition and place in it, and the partitions' first numbers, one row
    for each of them, are joined back.
    """
    placed = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "index")
    part = F.shiftright("_place", _ROW_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(firsts), "_part")
        .withColumn(name, F.col("_first") + in_part)
        .drop("_place", "_part", "_first")
    )


def label_index(df: DataFrame, column: str) -> DataFrame:
    """``label, count, index``: labels numbered by falling frequency, equal ones in label order. Runs a job.

    Null is no label.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label")).count()
    return global_index(counts, F.desc("count"), F.col("label"))


def one_hot(indexed: DataFrame, *, drop_last: bool = True) -> DataFrame:
    """``label, index, position, value`` of the non-zero one-hot entries of a label index.

    With ``drop_last`` the last label has no entry.
    """
    entries = indexed.select("label", "index", F.col("index").alias("position"), F.lit(1.0).alias("value"))
    if drop_last:
        last = indexed.agg(F.max("index")).scalar()
        entries = entries.where(F.col("index") < last)
    return entries


def index_rows(df: DataFrame, column: str, indexed: DataFrame, name: str | None = None) -> DataFrame:
    """Add each row's label index; a label that is not in ``indexed`` gets null."""
    lookup = indexed.select(F.col("label").alias(column), F.col("index").alias(name or f"{column}_indexed"))
    return df.join(lookup, column, "left")
