"""Token and term operators against Spark ML and against counting by hand."""

import math
import re
from collections import Counter
from contextlib import contextmanager

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F
from recordlens.functions import STOP_WORDS, term_counts, tokens, without_stop_words
from recordlens.operators import features, terms, vectorize
from recordlens.plans.queries import QUERIES, filtered_documents
from recordlens.plans.tables import documents


def test_stop_words_are_those_of_spark(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(STOP_WORDS) == 181


@pytest.mark.parametrize(
    ("text", "found", "kept"),
    [
        ("Café Don't stop-it_now 3D", ["caf", "don", "t", "stop", "it_now", "3d"], ["caf", "stop", "it_now", "3d"]),
        ("", [], []),
        ("!!!", [], []),
        (None, [], []),
        ("The THE cat", ["the", "the", "cat"], ["cat"]),
    ],
)
def test_tokens(spark, text, found, kept):
    df = spark.createDataFrame([(text,)], "text string")
    row = df.select(tokens(F.col("text")), without_stop_words(tokens(F.col("text")))).first()
    assert (row[0], row[1]) == (found, kept)


def test_unicode_tokens_and_least_length(spark):
    df = spark.createDataFrame([("Café au lait",)], "text string")
    assert df.select(tokens(F.col("text"), unicode=True)).first()[0] == ["café", "au", "lait"]
    assert df.select(tokens(F.col("text"), min_length=3)).first()[0] == ["caf", "lait"]


def test_stop_words_with_case(spark):
    df = spark.createDataFrame([(["The", "the", "Cat"],)], "t array<string>")
    assert df.select(without_stop_words(F.col("t"))).first()[0] == ["Cat"]
    assert df.select(without_stop_words(F.col("t"), case_sensitive=True)).first()[0] == ["The", "Cat"]
    assert df.select(without_stop_words(F.col("t"), ["Cat"])).first()[0] == ["The", "the"]


def test_tokens_equal_the_ml_stages(spark, small):
    docs = documents(spark, small).select("doc_id", "text")
    ours = terms.remove_stop_words(terms.add_tokens(docs)).select("doc_id", "tokens", "filtered")
    theirs = features.stop_word_remover().transform(features.tokenizer().transform(docs))
    assert ours.exceptAll(theirs.select("doc_id", "tokens", "filtered")).isEmpty()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("a b c dd é Z 1".split()), max_size=30), min_size=1, max_size=8))
def test_term_counts_equal_counting(spark, lists):
    df = spark.createDataFrame([(i, words) for i, words in enumerate(lists)], "id int, t array<string>")
    for row in df.select("t", term_counts(F.col("t")).alias("c")).collect():
        assert {(e["term"], e["tf"]) for e in row["c"]} == set(Counter(row["t"]).items())
        assert len(row["c"]) == len(set(row["t"]))


def test_term_frequencies_need_no_shuffle(spark, small):
    docs = filtered_documents(spark.read.parquet(f"{small}/documents.parquet"))
    assert "Exchange" not in terms.term_frequencies(docs, "doc_id")._jdf.queryExecution().executedPlan().toString()


def test_vocabulary_limits(spark, small):
    docs = filtered_documents(documents(spark, small))
    all_terms = {row["term"]: row for row in terms.vocabulary(docs).collect()}
    words = [t for row in docs.select("filtered").collect() for t in row[0]]
    assert {term: row["count"] for term, row in all_terms.items()} == Counter(words)
    order = sorted(all_terms.values(), key=lambda row: (-row["count"], row["term"]))
    assert {row["term"] for row in terms.vocabulary(docs, max_terms=30).collect()} == {r["term"] for r in order[:30]}
    n = docs.count()
    by_share = {row["term"] for row in terms.vocabulary(docs, min_df=0.1).collect()}
    assert by_share == {row["term"] for row in order if row["df"] >= 0.1 * n}


def test_a_vocabulary_does_not_depend_on_partitions(spark, small):
    docs = filtered_documents(documents(spark, small)).select("filtered").cache()
    one = features.fit_count_vectorizer(docs.coalesce(1), min_df=3)
    many = features.fit_count_vectorizer(docs.repartition(7), min_df=3)
    assert one.vocabulary == many.vocabulary
    by_spark = features.count_vectorizer(min_df=3).fit(docs)
    assert set(by_spark.vocabulary) == set(one.vocabulary)
    assert features.fit_count_vectorizer(docs, min_df=3, vocab_size=40).vocabulary == one.vocabulary[:40]


def test_more_terms_than_the_driver_may_hold_are_an_error(spark, small, monkeypatch):
    docs = filtered_documents(documents(spark, small)).select("filtered")
    monkeypatch.setattr(features, "DRIVER_TERMS", 10)
    with pytest.raises(ValueError, match="more than 10"):
        features.fit_count_vectorizer(docs)


def test_weights_equal_idf_of_spark(spark, small):
    docs = filtered_documents(documents(spark, small)).select("doc_id", "filtered")
    counter = features.count_vectorizer(min_df=3).fit(docs)
    counted = counter.transform(docs)
    weighted = features.idf().fit(counted).transform(counted)
    theirs = features.vector_entries(weighted, "doc_id", "features").join(
        features.vocabulary_table(counter, docs), "position"
    )
    theirs = {(row["doc_id"], row["term"]): row["value"] for row in theirs.collect()}
    ours = {
        (row["doc_id"], row["term"]): row["tfidf"]
        for row in terms.term_weights(docs, "doc_id", min_df=3).collect()
    }
    assert ours.keys() == theirs.keys()
    assert all(math.isclose(ours[key], theirs[key], abs_tol=1e-9) for key in ours)


def test_weights_count_the_terms_of_a_document_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(1, ["a", "b", "a"]), (2, ["a"]), (2, ["a"]), (None, ["c", "b"]), (3, [])]
    spark.createDataFrame(rows, "doc_id long, filtered array<string>").write.parquet(path)
    weights = terms.term_weights(spark.read.parquet(path), "doc_id", min_df=0.4)
    assert not [name for name in weights.inputFiles() if path in name]  # the join reads the counted terms, not the documents again
    found = [(r["doc_id"], r["term"], r["tf"], r["df"]) for r in weights.collect()]
    assert sorted(found, key=repr) == sorted([(1, "a", 2, 3), (1, "b", 1, 2), (2, "a", 1, 3), (2, "a", 1, 3), (None, "b", 1, 2)], key=repr)


@contextmanager
def small_skewed_partitions(spark):
    """No broadcast joins, and partitions count as skewed from a few kilobytes on."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(key)


def test_weights_split_a_term_that_most_documents_hold(spark):
    # One term is in every document, the rest are rare.
    rare = F.concat(F.lit("t"), (F.col("id") % 3000).cast("string"))
    docs = spark.range(0, 60000, 1, 4).select(
        F.col("id").alias("doc_id"), F.array(F.lit("common"), rare).alias("filtered")
    )
    with small_skewed_partitions(spark):
        weights = terms.term_weights(docs, "doc_id")
        rows = weights.collect()
        plan = weights._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 120000
    assert {row["df"] for row in rows} == {60000, 20}
    assert "SortMergeJoin(skew=true)" in plan


def test_indexing_splits_a_label_that_most_rows_hold(spark):
    label = F.when(F.col("id") % 3 > 0, "common").otherwise(F.concat(F.lit("rare"), F.col("id")))
    rows = spark.range(0, 90000, 1, 4).select("id", label.alias("x"))
    with small_skewed_partitions(spark):
        indexed = terms.index_rows(rows, "x", terms.label_index(rows, "x"), "i")
        found = indexed.collect()
        plan = indexed._jdf.queryExecution().executedPlan().toString()
    assert len(found) == 90000 and {row["i"] for row in found if row["x"] == "common"} == {0}
    assert len({row["i"] for row in found}) == 30001
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_global_index_numbers_all_rows_in_order(spark, partitions):
    df = spark.range(0, 997, 1, partitions).select((F.col("id") * 7919 % 997).alias("v"))
    rows = terms.global_index(df, F.desc("v")).collect()
    assert sorted((row["index"], row["v"]) for row in rows) == [(i, 996 - i) for i in range(997)]


def test_label_index_breaks_ties_by_label_and_skips_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    rows = {row["label"]: row["index"] for row in terms.label_index(df, "x").collect()}
    assert rows == {"c": 0, "a": 1, "b": 2}
    indexed = terms.index_rows(df, "x", terms.label_index(df, "x"), "i")
    assert {(row["x"], row["i"]) for row in indexed.collect()} == {("b", 2), ("a", 1), ("c", 0), (None, None)}


def test_label_index_and_one_hot_equal_the_ml_stages(spark, small):
    docs = documents(spark, small).select("doc_id", "source")
    model = features.string_indexer(["source"], ["i"]).fit(docs)
    ours = terms.label_index(docs, "source")
    assert [row["label"] for row in ours.orderBy("index").collect()] == list(model.labelsArray[0])
    encoded = features.one_hot_encoder(["i"], ["v"]).fit(model.transform(docs)).transform(model.transform(docs))
    theirs = features.vector_entries(encoded.dropDuplicates(["source"]), "source", "v")
    entries = terms.one_hot(ours)
    assert {tuple(row) for row in entries.select("label", "position", "value").collect()} == {
        tuple(row) for row in theirs.collect()
    }
    assert terms.one_hot(ours, drop_last=False).count() == entries.count() + 1


def test_indexed_rows_count_like_labels(spark, small):
    docs = documents(spark, small).select("doc_id", "lang")
    indexed = terms.index_rows(docs, "lang", terms.label_index(docs, "lang"))
    assert indexed.count() == docs.count()
    counts = {row["lang_indexed"]: row["count"] for row in indexed.groupBy("lang_indexed").count().collect()}
    assert list(counts) and sorted(counts.values(), reverse=True) == [counts[i] for i in range(len(counts))]


def test_vector_entries_of_dense_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    vectors = [Vectors.dense([1.0, 0.0]), Vectors.sparse(5, {3: 2.0}), Vectors.sparse(5, {})]
    df = spark.createDataFrame(list(enumerate(vectors, 1)), ["k", "v"])
    rows = {tuple(row) for row in features.vector_entries(df, "k", "v").collect()}
    assert rows == {(1, 0, 1.0), (1, 1, 0.0), (2, 3, 2.0)}


def test_hashed_terms_keep_every_token(spark, small):
    docs = filtered_documents(documents(spark, small))
    hashed = features.hashing_tf(buckets=50).transform(docs)
    sums = features.vector_entries(hashed, "doc_id", "rawFeatures").agg(F.sum("value")).first()[0]
    assert sums == docs.agg(F.sum(F.size("filtered"))).first()[0]
    assert features.hashing_tf().getNumFeatures() == 20000


def test_plain_regex_gives_the_same_tokens(spark, small):
    for row in terms.add_tokens(documents(spark, small)).select("text", "tokens").limit(50).collect():
        wanted = [t for t in re.split(r"\W+", row["text"].lower(), flags=re.ASCII) if t]
        assert row["tokens"] == wanted


# Vectors from tables


@pytest.mark.parametrize(("min_df", "size"), [(1, None), (3, None), (0.05, 40)])
def test_vectors_from_tables_equal_the_count_vectorizer(spark, small, min_df, size):
    docs = filtered_documents(documents(spark, small)).select("doc_id", "filtered").cache()
    model = features.fit_count_vectorizer(docs, min_df=min_df, vocab_size=size)
    known = vectorize.fit_term_table(docs, min_df=min_df, vocab_size=size)
    assert [r["term"] for r in known.orderBy("position").collect()] == model.vocabulary
    made = vectorize.add_term_vectors(docs, known, raw="ours")
    both = made.join(model.transform(docs).select("doc_id", "rawFeatures"), "doc_id").collect()
    assert len(both) == docs.count() and all(r["ours"] == r["rawFeatures"] for r in both)
    counted = model.transform(docs)
    weighted = {r["doc_id"]: r["features"] for r in features.idf().fit(counted).transform(counted).collect()}
    for r in both:
        assert r["features"].indices.tolist() == weighted[r["doc_id"]].indices.tolist()
        assert r["features"].values == pytest.approx(weighted[r["doc_id"]].values)


def test_vectors_of_odd_rows(spark):
    rows = [(1, ["a", "b", "a"], "x"), (1, ["a", "b", "a"], "x"), (2, [], "y"), (3, None, "z"), (None, ["zz"], "w"), (4, ["b"], None)]
    docs = spark.createDataFrame(rows, "id int, filtered array<string>, _row string")
    known = vectorize.fit_term_table(docs.where("id < 5"))
    found = [(r["id"], r["_row"], r["rawFeatures"].size, dict(zip(r["rawFeatures"].indices.tolist(), r["rawFeatures"].values.tolist()))) for r in vectorize.add_term_vectors(docs, known).collect()]
    assert sorted(found, key=repr) == sorted([(1, "x", 2, {0: 2.0, 1: 1.0})] * 2 + [(2, "y", 2, {}), (3, "z", 2, {}), (None, "w", 2, {}), (4, None, 2, {1: 1.0})], key=repr)
    assert vectorize.add_term_vectors(docs.limit(0), known).count() == 0
    with pytest.raises(ValueError, match="no term"):
        vectorize.add_term_vectors(docs, vectorize.fit_term_table(docs, min_df=50))


def test_vectors_go_to_spark_ml_beyond_the_drivers_bound(spark, small, monkeypatch):
    monkeypatch.setattr(features, "DRIVER_TERMS", 10)
    docs = filtered_documents(documents(spark, small)).select("doc_id", "filtered", (F.col("doc_id") % 2).cast("double").alias("label"))
    made = vectorize.add_term_vectors(docs, vectorize.fit_term_table(docs))
    from pyspark.ml.classification import NaiveBayes

    assert NaiveBayes().fit(made.select("label", "features")).transform(made).count() == docs.count()


def test_vectors_split_a_term_that_most_documents_hold(spark):
    rare = F.concat(F.lit("t"), (F.col("id") % 3000).cast("string"))
    docs = spark.range(0, 60000, 1, 4).select(F.col("id").alias("doc_id"), F.array(F.lit("common"), rare).alias("filtered"))
    known = vectorize.fit_term_table(docs)
    with small_skewed_partitions(spark):
        rows = docs.select("doc_id", F.inline(term_counts(F.col("filtered")))).join(known.select("term", "position"), "term")
        assert rows.count() == 120000
        made = vectorize.add_term_vectors(docs, known)
        found = rows.select("position")
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert made.where(F.size(F.unwrap_udt(F.col("rawFeatures"))["indices"]) != 2).count() == 0
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("known", [["b", "a"], ["one"], ["", "x"], ["a\x01b", "\n", "|", "é", "\U0001f600", "\\E"]])
def test_counter_of_terms_is_that_of_spark(spark, known):
    ours, plain = features.counter_of(known), features.CountVectorizerModel.from_vocabulary(known, "filtered", "rawFeatures")
    assert ours.vocabulary == plain.vocabulary == known
    assert ours.getVocabSize() == plain.getVocabSize() == len(known)
    rows = spark.createDataFrame([([*known, "other", known[0]],), ([],)], "filtered array<string>")
    assert ours.transform(rows).collect() == plain.transform(rows).collect()


def test_a_counter_needs_terms(spark):
    with pytest.raises(ValueError, match="needs terms"):
        features.counter_of([])


def test_hashed_buckets_are_compared_without_a_join_by_term(spark, tmp_path):
    rows = [(1, "alpha beta alpha"), (1, "alpha gamma"), (2, ""), (3, "beta beta delta"), (None, "xi omega")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["hashed_term_buckets"](spark, str(tmp_path))
    # A repeated id has two counts of alpha against their sum, and a null id meets nothing.
    assert found.collect() == [(10, 6, 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate [term" not in plan
