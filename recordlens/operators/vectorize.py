"""Sparse term vectors from tables: for vocabularies of any size, of which the driver holds a fixed number of the most frequent terms at most.

The terms are numbered in a written table. The first of them are counted inside each row by Spark ML's counter; the counts of the others are joined
to the table and put together to one vector for each row. So the vectors are those of a count vectorizer with the same terms in the same order,
and may go to any Spark ML stage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.functions import term_counts
from recordlens.operators.features import counter_of
from recordlens.operators.terms import global_index, idf, vocabulary
from recordlens.sources.scratch import materialize, materialize_last, scope, scratch_path

#: Most frequent terms that are counted inside the rows; the others, however many, are joined.
HEAD_TERMS = 1 << 17


def fit_term_table(df: DataFrame, column: str = "filtered", *, min_df: float = 1, vocab_size: int | None = None) -> DataFrame:
    """``term, count, df, position, idf`` of the terms of all documents, in a written table. Runs jobs.

    Positions go by falling count, equal counts in term order, as those of ``features.fit_count_vectorizer``; the terms are sorted over all tasks. ``min_df`` keeps
    terms of so many documents, or below 1 of that share of them, ``vocab_size`` the most frequent ones.
    """

    def ranked() -> DataFrame:
        n_documents = df.count()
        counted = materialize(vocabulary(df, column, min_df=min_df), "terms")
        found = global_index(counted, F.desc("count"), F.col("term"), name="position")
        if vocab_size is not None:
            found = found.where(F.col("position") < vocab_size)
        return found.withColumn("idf", idf(F.lit(n_documents), F.col("df")))

    return materialize_last(df.sparkSession, "term-table", ranked)


def entries_of(vector: Column) -> tuple[Column, Column, Column]:
    """Size, positions and values of a vector's stored form (``unwrap_udt``), dense or sparse."""
    size, values = F.coalesce(vector["size"], F.size(vector["values"])), vector["values"]
    return size, F.coalesce(vector["indices"], F.sequence(F.lit(0), F.greatest(F.size(values), F.lit(1)) - 1)), values


def _sparse(size: Column, indices: Column, values: Column) -> Column:
    """The stored form of a sparse vector."""
    return F.struct(F.lit(0).cast("byte").alias("type"), size.cast("int").alias("size"), indices.alias("indices"), values.alias("values"))


def _written_vectors(spark: SparkSession, name: str, kept: T.StructType, names: list[str], make: Callable[[], DataFrame]) -> DataFrame:
    """Write what ``make`` gives. A vector is stored as that struct, so the written table is read again with vectors in place of structs."""
    path = scratch_path(spark, name)
    with scope(spark):
        make().write.parquet(path)
    schema = T.StructType([*kept.fields, *[T.StructField(column, VectorUDT()) for column in names]])
    return spark.read.schema(schema).parquet(path)


def free(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until no column has it."""
    while name in df.columns:
        name = f"_{name}"
    return name


def rest_entries(df: DataFrame, terms: DataFrame, row: str, tokens: str, head: int) -> DataFrame:
    """``term, position, tf, idf`` of each ``row`` for its terms from place ``head`` on. The join carries no hint."""
    rest = terms.where(F.col("position") >= head).select("term", F.col("position").cast("int").alias("position"), "idf")
    tail = df.select(row, F.inline(term_counts(F.col(tokens))))
    if head:
        tail = tail.join(F.broadcast(terms.where(F.col("position") < head).select("term")), "term", "left_anti")
    return tail.join(rest, "term")


def first_vectors(df: DataFrame, terms: DataFrame, tokens: str, counts: str, weights: str, head: int) -> DataFrame:
    """Add vectors of the counts and weights of the first ``head`` terms, counted inside each row. Runs a job."""
    known = terms.where(F.col("position") < head).orderBy("position").select("term", "idf").collect()
    scale = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in known]), inputCol=counts, outputCol=weights)
    made = scale.transform(counter_of([r["term"] for r in known], tokens, counts).transform(df))
    return made.withMetadata(counts, {}).withMetadata(weights, {})


def add_term_vectors(
    df: DataFrame,
    terms: DataFrame,
    column: str = "filtered",
    raw: str = "rawFeatures",
    weighted: str | None = "features",
    *,
    head: int | None = None,
    first: str | None = None,
    keep: Sequence[str] | None = None,
    behind: dict[str, str] | None = None,
) -> DataFrame:
    """Add the vectors of term counts and of counts times ``idf`` of a token list, in a written table. Runs jobs.

    ``terms`` is a table of ``fit_term_table``. Rows keep all their columns, or those of ``keep``, and may repeat. A row without known terms, or with null tokens, has empty vectors.
    The first ``head`` terms (``HEAD_TERMS``) are counted inside the row; ``first`` names a column for the vector of these alone. Only (row, term, count) of the others
    is shuffled for the join, which carries no hint: Spark broadcasts the terms if they are small and else splits a term that most rows hold
    (``spark.sql.adaptive.skewJoin``). Then a row's joined entries are put together and set behind those of its first terms. Without a name ``weighted`` only counts are made;
    ``behind`` names vectors to be set behind the weighted ones, by the column for both. What is written on the way is deleted.
    """
    size, head = terms.count(), HEAD_TERMS if head is None else head
    if size == 0:
        raise ValueError("no term occurs in enough documents")
    if size >= 1 << 31:
        raise ValueError(f"{size} terms are more than a vector has places")
    kept = df.columns if keep is None else list(keep)
    row, tokens, counts, weights = (free(name, df) for name in ("_row", "_tokens", "_counts", "_weights"))
    outs = [(counts, raw), (weights, weighted)][: 1 if weighted is None else 2]
    behind = behind or {}
    names = [*[out for _, out in outs], *([] if first is None else [first]), *behind]

    def made() -> DataFrame:
        rows = df if size <= head else materialize(df.withColumn(row, F.monotonically_increasing_id()), "rows")
        whole, none = rows.withColumn(tokens, F.coalesce(F.col(column), F.array().cast("array<string>"))), F.array()
        empty = _sparse(F.lit(size), none.cast("array<int>"), none.cast("array<double>"))
        of_first = {counts: empty, weights: empty}
        joined = {counts: [], weights: []}
        if size > head:
            values = {counts: F.col("tf").cast("double").alias("tf"), weights: (F.col("tf") * F.col("idf")).alias("tfidf")}
            entry = F.struct("position", *[values[name] for name, _ in outs])
            found = rest_entries(whole, terms, row, tokens, head).groupBy(row).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
            whole = whole.join(found.withColumnRenamed(row, "_of"), F.col(row) == F.col("_of"), "left")
            kind = "array<struct<position:int,tf:double,tfidf:double>>" if weighted else "array<struct<position:int,tf:double>>"
            entries = F.coalesce("_entries", F.array().cast(kind))
            joined = {name: [entries["position"], entries[value]] for (name, _), value in zip(outs, ("tf", "tfidf"))}
        if head:
            # After the join, whose shuffle then moves no vectors.
            whole = first_vectors(whole, terms, tokens, counts, weights, head)
            of_first = {name: F.unwrap_udt(F.col(name)) for name in (counts, weights)}
        stored = {
            out: _sparse(F.lit(size), F.concat(of_first[name]["indices"], *joined[name][:1]), F.concat(of_first[name]["values"], *joined[name][1:]))
            for name, out in outs
        }
        columns = [vector.alias(out) for out, vector in stored.items()]
        if first is not None:
            columns.append(of_first[counts].alias(first))
        columns += [_appended([stored[weighted], F.unwrap_udt(F.col(other))]).alias(out) for out, other in behind.items()]
        return whole.select(*kept, *columns)

    return _written_vectors(df.sparkSession, "vectors", df.select(*kept).schema, names, made)


def _appended(vectors: list[Column]) -> Column:
    """The stored form of one sparse vector of several. Zeros are not stored."""

    def moved(entries: Column, by: Column) -> Column:
        return F.transform(entries, lambda e: F.struct((e["i"] + by).alias("i"), e["v"].alias("v")))

    start, indices, values = F.lit(0), [], []
    for vector in vectors:
        size, places, held = entries_of(vector)
        stored = F.filter(moved(F.arrays_zip(places.alias("i"), held.alias("v")), start), lambda e: e["v"] != 0)
        indices, values, start = [*indices, stored["i"]], [*values, stored["v"]], start + size
    return _sparse(start, F.concat(*indices), F.concat(*values))
