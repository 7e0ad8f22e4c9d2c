"""Quality by importance resampling: documents drawn by how much likelier target text would make them than raw text.

Two bag models of hashed word and word-pair counts are fitted: one of the target (documents labelled good), one of all raw
text. A document's weight is the ratio of the probabilities that they give its n-grams. Resampling without
replacement takes the documents with the highest ``log weight + Gumbel noise``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm import hashing
from recordlens.llm.common import running, slices, utf8
from recordlens.sources.scratch import materialize

BUCKETS = 1 << 16
#: The weight is that of a document of so many n-grams with the document's mean log ratio, so that length does not decide.
EFFECTIVE_LENGTH = 64
#: As many documents are drawn as have the weight that this share of the good ones reaches.
RECALL = 0.998
#: Counts that are added to what is seen and to what is expected in each bucket, so that rare n-grams say little.
SHRINK = 10.0
SEED = 17
CHUNK = 1 << 18
_REPEAT = np.uint64(0x5EEDED)
# Classes of bytes: 0 white space and control, 1 letters, digits and all beyond ASCII, 2 other marks.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[:33] = 0
_CLASS[127] = 0
_CLASS[128:] = 1
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), 95]] = 1


def gram_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words and word pairs, with the texts they are of.

    Words are runs of letters and digits or runs of marks, A-Z as a-z; a word that repeats the one before counts as a repeat, whatever it is.
    """
    long = len(offsets) == 2 and len(data) > 2 * CHUNK
    if long:
        words = hashing.run_hashes(data, _CLASS, CHUNK)
        owner = np.zeros(len(words), np.int64)
    else:
        starts, ends, owner = hashing.spans(_CLASS[data], offsets)
        words = hashing.span_hashes(data, starts, ends)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    words = np.where(same, _REPEAT, words)
    if long:
        pairs = hashing.long_gram_hashes(words, 2, CHUNK)
        pair_owner = np.zeros(len(pairs), np.int64)
    else:
        pairs, pair_owner = hashing.gram_hashes(words, owner, 2)
    grams = np.concatenate([hashing.mix(words), pairs])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([owner, pair_owner])


def _counted(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for a, b in slices(offsets, CHUNK):
                grams, _ = gram_buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], buckets)
                total += np.bincount(grams, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def _bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in a column of texts. Runs a job that gives one row for each bucket."""
    rows = texts.mapInArrow(_counted(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(buckets)
    counts[rows["bucket"]] = rows["n"]
    return counts


def _weighed(ratios_of, length: int, column: str, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = ratios_of.value
        for batch in batches:
            data, offsets = utf8(batch.column(text_at))
            out = np.zeros(len(batch))
            for a, b in slices(offsets, CHUNK):
                grams, owner = gram_buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], len(ratios))
                counts = np.bincount(owner, minlength=b - a)
                out[a:b] = np.bincount(owner, ratios[grams], b - a) / np.maximum(counts, 1) * length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, column])

    return run


def labelled_ids(labels: DataFrame, flag: str) -> DataFrame:
    """``doc_id, flag`` of all labelled ids; of several labels the least counts."""
    return labels.where(f"doc_id is not null and {flag} is not null").groupBy("doc_id").agg(F.min(flag).alias(flag))


def _fold(i: int) -> Column:
    """Good labelled documents, half for the target model and half for the threshold."""
    return (F.col("quality") == 1) & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == i)


def weigh(docs: DataFrame, labels: DataFrame, name: str, text: str = "text", *, buckets: int = BUCKETS, effective_length: int = EFFECTIVE_LENGTH) -> tuple[DataFrame, DataFrame]:
    """Add the log weight ``name`` to each row of ``docs``; also give the labelled ids. Runs jobs.

    The raw model counts all n-grams of all rows, the target model those of one half of the good labelled ones, however many. Without any all weights are 0.
    The join to the labelled ids carries no hint: Spark broadcasts them if they are few and else deals out the texts by id.
    """
    spark = docs.sparkSession
    known = materialize(labelled_ids(labels, "quality"), "labelled")
    good = materialize(known.where(_fold(0)).select("doc_id"), "target")
    raw = _bucket_counts(docs.select(text), buckets)
    target = _bucket_counts(docs.select("doc_id", text).join(good, "doc_id", "left_semi").select(text), buckets)
    n_raw, n_target = raw.sum(), target.sum()
    if n_target == 0 or n_raw == 0:
        ratios = np.zeros(buckets)
    else:
        expected = raw * (n_target / n_raw)
        ratios = np.log((target + SHRINK) / (expected + SHRINK))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    sent = spark.sparkContext.broadcast(ratios)  # one number for each bucket
    return docs.mapInArrow(_weighed(sent, effective_length, name, docs.columns.index(text)), schema), known


def _percentile(df: DataFrame, column: str, share: float) -> float | None:
    """What ``F.percentile`` gives, which gathers all values in one task; here they are sorted over all tasks and two are taken. Runs jobs."""
    n = df.count()
    if n == 0:
        return None
    at = (n - 1) * share
    low, high = math.floor(at), math.ceil(at)
    # Equal values are told apart, so that they need not be in one task.
    numbered = df.select(column, F.monotonically_increasing_id().alias("row"), F.lit(1).alias("one"))
    ranked = running(numbered, [F.col(column), F.col("row")], "one", "ahead")
    found = {r["ahead"]: r[column] for r in ranked.where(F.col("ahead").isin(low, high)).collect()}
    return found[low] if low == high else (high - at) * found[low] + (at - low) * found[high]


def resample(docs: DataFrame, labels: DataFrame, text: str = "text", *, keep_text: bool = True, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """Add ``log_weight, gumbel_key, kept`` to each row of ``docs``. Runs jobs.

    As many rows are drawn as have a weight that ``recall`` of the good labelled ones reach which the model has not been
    fitted to; all if there is none. Drawn are the rows with the highest keys, equal ones by ascending ``doc_id`` (null last);
    rows equal to the last one in both are drawn with it. The noise is a hash of the id, so a repeated run draws the same. Null and empty texts
    have the weight 0. Columns of ``docs`` that are called like a new one are replaced; all others are kept, the text
    only with ``keep_text``. Only keys and ids are sorted, never texts.
    """
    new = ("log_weight", "gumbel_key", "kept")
    base = docs.select(*[c for c in docs.columns if c.lower() not in new])
    weighed, known = weigh(base, labels, "log_weight", text)
    if not keep_text:
        weighed = weighed.drop(text)
    # 53 bits of a hash as a number between 0 and 1, never either.
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    keyed = materialize(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "weighed")
    # Documents that the model has not seen, as it favours those that it has.
    good = known.where(_fold(1)).select("doc_id")
    reached = _percentile(materialize(keyed.select("doc_id", "log_weight").join(good, "doc_id", "left_semi").select("log_weight"), "reached"), "log_weight", 1 - recall)
    if reached is None:
        return keyed.withColumn("kept", F.lit(True))
    drawn = keyed.where(F.col("log_weight") >= reached).count()
    narrow = keyed.select("gumbel_key", "doc_id", F.lit(1).alias("one"))
    ranked = running(narrow, [F.col("gumbel_key").desc(), F.col("doc_id").asc_nulls_last()], "one", "ahead")
    last = ranked.where(F.col("ahead") == drawn - 1).first()
    key, id_ = F.col("gumbel_key"), F.col("doc_id")
    before = F.lit(True) if last["doc_id"] is None else F.coalesce(id_ <= last["doc_id"], F.lit(False))
    return keyed.withColumn("kept", (key > last["gumbel_key"]) | ((key == last["gumbel_key"]) & before))
