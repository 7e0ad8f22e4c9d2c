"""Feature stages: Spark ML transformers and estimators with the settings this library uses.

What Spark ML holds on the driver and sends to the executors is bounded here: the vocabulary and
the labels of a category by a check. Beyond that use hashed terms, which need no
vocabulary, or the long form in ``recordlens.operators.terms``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    OneHotEncoder,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.operators.terms import most_frequent, vocabulary
from recordlens.sources.scratch import materialize, scoped

#: The plain Spark stage's setting; ``fit_count_vectorizer`` cuts nothing unless asked to.
VOCAB_SIZE = 1 << 18
#: Terms that a fitted vocabulary, which Spark ML holds on the driver, may have.
DRIVER_TERMS = 1 << 20
HASH_BUCKETS = 20_000
MAX_LABELS = 100_000


class TooManyTerms(ValueError):
    """More terms than the driver may hold."""


def tokenizer(text: str = "text", out: str = "tokens", *, unicode: bool = False) -> RegexTokenizer:
    """Lower-case and split at non-word characters; empty tokens are dropped."""
    return RegexTokenizer(
        inputCol=text, outputCol=out, pattern=r"(?U)\W+" if unicode else r"\W+", gaps=True, toLowercase=True
    )


def stop_word_remover(column: str = "tokens", out: str = "filtered") -> StopWordsRemover:
    """Remove the English stop words, ignoring case."""
    return StopWordsRemover(inputCol=column, outputCol=out, caseSensitive=False, locale="en")


def count_vectorizer(
    column: str = "filtered", out: str = "rawFeatures", *, min_df: float = 1.0, vocab_size: int = VOCAB_SIZE
) -> CountVectorizer:
    """Term counts over a vocabulary ordered by corpus frequency."""
    return CountVectorizer(inputCol=column, outputCol=out, minDF=min_df, vocabSize=vocab_size)


def counter_of(terms: Sequence[str], column: str = "filtered", out: str = "rawFeatures") -> CountVectorizerModel:
    """Term counter over given terms, in the given order.

    The same model as ``CountVectorizerModel.from_vocabulary`` makes, which sends every term to the JVM in a call of its own (0.2 ms each,
    40 seconds for 200,000 terms). Here they go as one string, joined by a character that none of them holds.
    """
    if not terms:
        raise ValueError("a term counter needs terms")
    held = set().union(*terms)
    mark = next(c for c in map(chr, range(1, 0xD800)) if c not in held)
    java = SparkSession.active().sparkContext._jvm.java.util.regex.Pattern
    words = java.compile(mark, java.LITERAL).split(mark.join(terms), -1)
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", words)
    model._set(vocabSize=len(terms))
    return model.setInputCol(column).setOutputCol(out)


@scoped
def fit_count_vectorizer(
    df: DataFrame,
    column: str = "filtered",
    out: str = "rawFeatures",
    *,
    min_df: float = 1.0,
    vocab_size: int | None = None,
) -> CountVectorizerModel:
    """Fit ``count_vectorizer`` on a corpus of any size. Runs jobs.

    Terms are counted and ranked over all tasks, equal counts in term order, so the same corpus gives the same
    vocabulary however it is partitioned. Nothing is cut unless ``vocab_size`` asks for it. More terms than the
    driver may hold are an error: ``vectorize.add_term_vectors`` makes the same vectors without holding any.
    """
    kept = ranked_terms(vocabulary(df, column, min_df=min_df), vocab_size).collect()
    return counter_of([row["term"] for row in kept], column, out)


def ranked_terms(terms: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """The terms that a model is to know, most frequent first; checked to fit the driver. Runs jobs."""
    kept = materialize(terms if vocab_size is None else most_frequent(terms, vocab_size), "kept-terms")
    n = kept.count()
    if n == 0:
        raise ValueError("no term occurs in enough documents")
    if n > DRIVER_TERMS:
        raise TooManyTerms(f"{n} terms are more than {DRIVER_TERMS}: name a vocab_size, use hashed terms or vectorize.add_term_vectors")
    return kept.orderBy(F.desc("count"), "term")


def hashing_tf(column: str = "filtered", out: str = "rawFeatures", *, buckets: int = HASH_BUCKETS) -> HashingTF:
    """Term counts over hash buckets; terms of one bucket count together."""
    return HashingTF(inputCol=column, outputCol=out, numFeatures=buckets)


def idf(column: str = "rawFeatures", out: str = "features") -> IDF:
    """Scale term counts by ``ln((N + 1) / (df + 1))``."""
    return IDF(inputCol=column, outputCol=out, minDocFreq=0)


def string_indexer(columns: Sequence[str], out: Sequence[str], *, unseen: str = "error") -> StringIndexer:
    """Number labels by falling frequency, equal ones in label order; all columns in one pass.

    ``unseen`` is what happens to labels that the fit did not see: ``error``, ``keep`` or ``skip``.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=list(out), stringOrderType="frequencyDesc", handleInvalid=unseen
    )


def check_labels(df: DataFrame, columns: Sequence[str], max_labels: int = MAX_LABELS) -> None:
    """Refuse categories of more labels than the driver should hold and a one-hot vector should have. Runs a job."""
    if not columns:
        return
    counts = df.agg(*[F.count_distinct(name).alias(name) for name in columns]).first()
    for name in columns:
        if counts[name] > max_labels:
            raise ValueError(f"{name} has {counts[name]} labels, more than max_labels={max_labels}")


def one_hot_encoder(columns: Sequence[str], out: Sequence[str], *, drop_last: bool = True) -> OneHotEncoder:
    """Turn label numbers into one-hot vectors, by default without the last label."""
    return OneHotEncoder(inputCols=list(columns), outputCols=list(out), dropLast=drop_last, handleInvalid="error")


def assembler(columns: Sequence[str], out: str = "join_features") -> VectorAssembler:
    """Join numbers and vectors into one vector; nulls are an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")


def vector_entries(df: DataFrame, key: str, column: str, name: str = "value") -> DataFrame:
    """``key, position, value`` of the stored entries of a vector column.

    Sparse vectors are taken apart as stored, never spread out to their full size.
    """
    parts = df.select(key, F.unwrap_udt(F.col(column)).alias("_v"))
    positions = F.coalesce(F.col("_v.indices"), F.sequence(F.lit(0), F.size("_v.values") - 1))
    return parts.select(key, F.inline(F.arrays_zip(positions.alias("position"), F.col("_v.values").alias(name))))


def vocabulary_table(model: CountVectorizerModel, df: DataFrame) -> DataFrame:
    """``position, term`` of a fitted vocabulary, at most ``vocab_size`` rows.

    It is handed over as one Arrow table, whose size Spark knows when it plans a join.
    """
    words = model.vocabulary
    columns = {"position": pa.array(range(len(words)), pa.int32()), "term": pa.array(words, pa.string())}
    return df.sparkSession.createDataFrame(pa.table(columns))
