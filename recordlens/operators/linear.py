"""Scores of a linear model from a table of weights: no vector for a row, no coefficients in the executors' memory.

A row's margin is the intercept and the sum of weight times value over its features. The terms of all rows are joined to their weights and
summed by row, so a model may know any number of terms.
"""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, IDFModel, OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.functions import term_counts, tokens, without_stop_words
from recordlens.operators.evaluate import threshold_decision
from recordlens.operators.training import Recipe, TableModel
from recordlens.sources.scratch import materialize

WEIGHTS = "feature string, name string, weight double"


def _table_weights(spark: SparkSession, model: TableModel, recipe: Recipe) -> DataFrame:
    """The weights of a model in tables: those of its terms are joined from them."""
    terms, n_terms = model.features.terms, model.features.terms.count()
    joined = terms.withColumn("position", F.col("position").cast("int")).join(model.coefficients, "position")
    found = joined.select(F.lit(recipe.text).alias("feature"), F.col("term").alias("name"), (F.col("coefficient") * F.col("idf")).alias("weight"))
    if model.recipe.features != "join_features":
        return found
    by_type = {type(stage): stage for stage in model.features.stages}
    encoder, labels = by_type[OneHotEncoderModel], by_type[StringIndexerModel].labelsArray
    names = [(number, None) for number in recipe.numbers]
    for category, of_category, size in zip(recipe.categories, labels, encoder.categorySizes, strict=True):
        names += [(category, label) for label in [*of_category, None][: size - encoder.getDropLast()]]
    columns = {"position": pa.array(range(n_terms, n_terms + len(names)), pa.int32()), "feature": pa.array([f for f, _ in names], pa.string()), "name": pa.array([n for _, n in names], pa.string())}
    others = spark.createDataFrame(pa.table(columns)).join(model.coefficients.where(F.col("position") >= n_terms), "position")
    return found.union(others.select("feature", "name", F.col("coefficient").alias("weight")))


def weight_table(spark: SparkSession, model: PipelineModel | TableModel, recipe: Recipe) -> tuple[DataFrame, float]:
    """``feature, name, weight`` of a fitted model, and its intercept. Runs a job.

    ``feature`` is a column of the recipe and ``name`` a term or a label; a number has no name. A term's weight holds its document frequency weight. Labels without a slot have no row.
    """
    if isinstance(model, TableModel):
        return materialize(_table_weights(spark, model, recipe), "weights"), model.intercept
    by_type = {type(stage): stage for stage in model.stages}
    learned: LogisticRegressionModel = by_type[LogisticRegressionModel]
    if CountVectorizerModel not in by_type:
        raise ValueError("a hashed model has no terms")
    terms = by_type[CountVectorizerModel].vocabulary
    scale = by_type[ElementwiseProduct].getScalingVec() if ElementwiseProduct in by_type else by_type[IDFModel].idf
    values = learned.coefficients.toArray()
    names: list[tuple[str, list]] = [(recipe.text, terms)]
    if learned.getFeaturesCol() == by_type[VectorAssembler].getOutputCol():
        encoder, labels = by_type[OneHotEncoderModel], by_type[StringIndexerModel].labelsArray
        names += [(number, [None]) for number in recipe.numbers]
        for category, of_category, size in zip(recipe.categories, labels, encoder.categorySizes, strict=True):
            slots = size - encoder.getDropLast()
            # A slot behind the last label is that of unseen ones.
            names.append((category, [*of_category, None][:slots]))
    weights = values.copy()
    weights[: len(terms)] *= scale.toArray()
    columns = {
        "feature": pa.array(list(chain.from_iterable([feature] * len(some) for feature, some in names)), pa.string()),
        "name": pa.array(list(chain.from_iterable(some for _, some in names)), pa.string()),
        "weight": pa.array(weights, pa.float64()),
    }
    return materialize(spark.createDataFrame(pa.table(columns)), "weights"), float(learned.intercept)


def score_by_weights(df: DataFrame, weights: DataFrame, intercept: float, recipe: Recipe) -> DataFrame:
    """Add ``margin``, ``p1`` and ``predictions`` to rows of ``training.training_input``. Runs a job.

    ``weights`` may be of any size; its joins carry no hint, so Spark broadcasts it if it is small and else splits terms and labels that most rows hold.
    Unknown terms and labels weigh nothing. Rows may repeat.
    """
    if recipe.hashed:
        raise ValueError("a hashed recipe has no terms")
    row, text = "_row", "_text"
    rows = materialize(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    kept = without_stop_words(tokens(F.col(recipe.text), unicode=recipe.unicode), case_sensitive=True)
    of_terms = weights.where(F.col("feature") == recipe.text).select(F.col("name").alias("term"), "weight")
    sums = rows.select(row, F.inline(term_counts(kept))).join(of_terms, "term").groupBy(row).agg(F.sum(F.col("tf") * F.col("weight")).alias(text))
    scored = rows.join(sums, row, "left")
    margin = F.lit(intercept) + F.coalesce(text, F.lit(0.0))
    # One row for each number of the recipe.
    numbers = {r["feature"]: r["weight"] for r in weights.where(F.col("feature").isin(list(recipe.numbers)) & F.col("name").isNull()).collect()}
    for name, weight in numbers.items():
        margin = margin + F.lit(weight) * F.col(name)
    for i, category in enumerate(recipe.categories):
        label = weights.where((F.col("feature") == category) & F.col("name").isNotNull()).select(F.col("name").alias(f"_label{i}"), F.col("weight").alias(f"_weight{i}"))
        scored = scored.join(label, F.col(category) == F.col(f"_label{i}"), "left")
        margin = margin + F.coalesce(f"_weight{i}", F.lit(0.0))
    scored = scored.select(*df.columns, margin.alias("margin"))
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
    return scored.withColumn("p1", p1).withColumn("predictions", threshold_decision(F.col("p1"), recipe.thresholds))
