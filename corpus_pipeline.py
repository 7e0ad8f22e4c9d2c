"""Documents to packed training sequences: toxicity, quality, near-duplicates, packing.

Each stage takes (spark, docs, folder of the tables) and gives a DataFrame; all but the last keep the columns of their
documents. ``run`` writes what each stage gives and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlens.llm import importance, packing, superminhash, toxicity
from recordlens.llm.common import unused
from recordlens.llm.vocabularies import public_path
from recordlens.sources.scratch import materialize

#: SQL can't express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose expected severity is below ``toxicity.REJECT_FROM``; repeated rows stay repeated."""
    model = toxicity.model_of_flags(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    severity = unused(docs, "severity")
    scored = toxicity.score(docs, model, severity)
    return scored.where(F.col(severity) < toxicity.REJECT_FROM).select(*docs.columns)


def draw_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents drawn by importance resampling towards the labelled good ones."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    named = inner.withColumnsRenamed({at["doc_id"]: "doc_id", at["text"]: "text"})
    drawn = importance.resample(named, spark.read.parquet(f"{folder}/labels.parquet")).where("kept")
    order = [{"doc_id": "doc_id", "text": "text"}.get(c, at[c]) for c in docs.columns]
    return drawn.select(*order).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates by five-word shingles, similarity 0.8 or more.

    The one with the least id stays (null is larger than all). Of rows with that id and equal sets of shingles one stays too;
    documents without words have no shingles and all stay.
    """
    found = superminhash.near_duplicates(docs, words=5, percent=80, bands=32, slots=5)
    lead = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "set_id")).alias("lead")
    leads = found.where("n_shingles > 0").groupBy("component").agg(lead)
    key, mark, number, place = (unused(docs, n) for n in ("key", "set", "number", "place"))
    id_key = F.xxhash64(F.col("doc_id").cast("long"))  # also for a null id
    kept = leads.select(F.col("lead.doc_id").alias("doc_id"), F.col("lead.set_id").alias(mark)).withColumn(key, id_key)
    kept = materialize(kept.select(key, mark, F.lit(True).alias("_kept")), "kept")
    signed = superminhash.with_set_ids(docs, mark, words=5).withColumn(key, id_key)
    found_rows = signed.join(kept, [key, mark], "left")
    # Repeated rows of one id and set: the first in text order stays. The rows are already together for it.
    alone = F.when(F.col(mark).isNull(), F.monotonically_increasing_id()).otherwise(-1)
    first = Window.partitionBy(key, mark, place).orderBy("text")
    stay = found_rows.where(F.col("_kept") | F.col(mark).isNull()).withColumn(place, alone)
    return stay.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack_documents(docs, public_path("byte_bpe_50k.json"), 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", draw_good),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``; what each stage but the last gives is written and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
