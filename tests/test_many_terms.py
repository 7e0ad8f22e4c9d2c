"""Queries over more terms than the driver may hold give what they give below that bound."""

from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from recordlens.operators import features, linear, training, vectorize, wide
from recordlens.plans.queries import DOCUMENT_RECIPE, QUERIES
from recordlens.plans.tables import labelled
from recordlens.sources import scratch


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of common, rare and repeated words, one of them empty, and their labels."""
    path = str(tmp_path_factory.mktemp("many"))
    rows = []
    for i in range(120):
        words = [f"w{i % 3}", f"w{i % 7}", f"only{i}", f"pair{i // 2}", f"w{i % 3}", "every"]
        text = "" if i == 6 else " ".join(words[: 2 + i % 5])
        rows.append((i, text, f"l{i % 3}", f"s{i % 4}", len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 == 0), 0) for i in range(0, 120) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(spark, folder, name):
    found = QUERIES[name](spark, folder)
    return sorted((tuple(row) for row in found.select(*sorted(found.columns)).collect()), key=repr)


@pytest.mark.parametrize("name", ["count_vectors", "idf_vectors", "term_table_vectors", "term_table_agreement"])
def test_vectors_of_more_terms_than_the_driver_may_hold(spark, folder, monkeypatch, name):
    wanted = rows_of(spark, folder, name)
    monkeypatch.setattr(features, "DRIVER_TERMS", 20)
    monkeypatch.setattr(vectorize, "HEAD_TERMS", 5)
    assert rows_of(spark, folder, name) == wanted


@pytest.mark.parametrize("name", ["assembled_vectors", "assembled_slots", "heldout_scores"])
def test_training_on_more_terms_than_the_driver_may_hold(spark, folder, monkeypatch, name):
    wanted = rows_of(spark, folder, name)
    monkeypatch.setattr(features, "DRIVER_TERMS", 20)
    monkeypatch.setattr(vectorize, "HEAD_TERMS", 5)
    assert rows_of(spark, folder, name) == wanted


@pytest.mark.parametrize("column", ["join_features", "features"])
def test_coefficients_in_tables_are_those_of_spark(spark, folder, monkeypatch, tmp_path, column):
    recipe = replace(DOCUMENT_RECIPE, features=column, reg_param=0.01, tol=1e-7)
    rows = training.training_input(labelled(spark, folder), recipe)
    by_spark = training.score(training.fit(rows, recipe), rows)
    monkeypatch.setattr(features, "DRIVER_TERMS", 20)
    monkeypatch.setattr(vectorize, "HEAD_TERMS", 5)
    model = training.fit(rows, recipe)
    assert isinstance(model, training.TableModel)
    training.save_model(model, str(tmp_path / "model"))
    again = training.score(training.load_model(str(tmp_path / "model")), rows)
    weights, intercept = linear.weight_table(spark, model, recipe)
    by_weights = linear.score_by_weights(rows, weights, intercept, recipe)
    p1 = vector_to_array("probability")[1]
    wanted, ours, loaded = ({r["doc_id"]: r["p"] for r in s.select("doc_id", p1.alias("p")).collect()} for s in (by_spark, training.score(model, rows), again))
    assert len(wanted) == rows.count() and ours == pytest.approx(wanted, abs=5e-3)  # both stop by a tolerance
    assert loaded == pytest.approx(ours, abs=1e-12)
    assert {r["doc_id"]: r["p1"] for r in by_weights.collect()} == pytest.approx(ours, abs=1e-9)


@pytest.mark.parametrize("name, tables", [("assembled_slots", 5), ("term_table_agreement", 4)])
def test_vector_queries_keep_only_the_tables_they_read(spark, folder, monkeypatch, tmp_path, name, tables):
    monkeypatch.setattr(features, "DRIVER_TERMS", 20)
    monkeypatch.setattr(vectorize, "HEAD_TERMS", 5)
    monkeypatch.setattr(scratch, "_root", lambda spark: str(tmp_path))
    assert rows_of(spark, folder, name)
    assert len([path for path in tmp_path.iterdir() if path.is_dir()]) <= tables


def test_slots_of_repeated_and_null_ids(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 8")
    ids = F.when(F.col("doc_id") < 3, 1).when(F.col("doc_id") > 5, None).otherwise(F.col("doc_id")).cast("long")
    docs.withColumn("doc_id", ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = training.training_input(spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("quality", F.lit(0)), DOCUMENT_RECIPE)
    made = training.fit_features(training.token_rows(rows, DOCUMENT_RECIPE), DOCUMENT_RECIPE).transform(training.token_rows(rows, DOCUMENT_RECIPE))
    entries, counted = {}, 0
    for r in made.collect():
        vector = r["join_features"]
        entries.setdefault((r["doc_id"], r["doc_id"] is None and id(r)), []).append({i: v for i, v in enumerate(vector.toArray()) if v})
    different = 0
    for (doc_id, _), held in entries.items():
        for place in set().union(*held):
            values = [h[place] for h in held if place in h]
            # Each row's entry meets those of all rows of its id; null ids meet none.
            counted += len(values) ** 2 if doc_id is not None else len(values)
            different += sum(x != y for x in values for y in values) if doc_id is not None else 2 * len(values)
    found = QUERIES["assembled_slots"](spark, str(tmp_path)).first()
    assert (found["n_entries"], found["n_different"]) == (counted, different)


def test_steps_of_the_regression_write_numbers_only(spark, folder, monkeypatch):
    monkeypatch.setattr(features, "DRIVER_TERMS", 20)
    monkeypatch.setattr(vectorize, "HEAD_TERMS", 5)
    written, put = [], wide._Steps.put
    monkeypatch.setattr(wide._Steps, "put", lambda self, df: (written.append(df.schema), put(self, df))[1])
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    training.fit_each(training.training_input(labelled(spark, folder), DOCUMENT_RECIPE), replace(DOCUMENT_RECIPE, max_iter=2), ("join_features", "features"))
    assert len(written) > 2 and {f.dataType.simpleString() for schema in written for f in schema} <= {"bigint", "double"}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
