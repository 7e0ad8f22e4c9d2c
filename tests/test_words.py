"""Word counting."""

import pytest
from pyspark.sql import functions as F
from recordlens.functions import java_split_words, split_words
from recordlens.operators import words
from recordlens.plans.tables import documents

CASES = {
    "a b ": (["a", "b", ""], ["a", "b"]),
    "": ([""], [""]),
    "a  b": (["a", "", "b"], ["a", "", "b"]),
    "   ": (["", "", "", ""], []),
    " a": (["", "a"], ["", "a"]),
    "a\t": (["a\t"], ["a\t"]),
}


@pytest.mark.parametrize("text", CASES)
def test_splits(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    row = df.select(split_words(F.col("value")), java_split_words(F.col("value"))).first()
    assert (row[0], row[1]) == CASES[text]


def test_null_line_has_no_words(spark):
    df = spark.createDataFrame([(None,), ("a",)], "value string")
    for java_split in (False, True):
        assert words.count_words(df, java_split=java_split).count() == 1


def test_counts_add_up_to_all_words(spark, small):
    docs = documents(spark, small)
    total = docs.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert words.count_words(docs, "text").agg(F.sum("count")).first()[0] == total


def test_folding_first_equals_folding_counts(spark, small):
    docs = documents(spark, small)
    first = words.count_words(docs, "text", fold=True)
    after = words.fold_counts(words.count_words(docs, "text"))
    assert first.exceptAll(after).isEmpty() and after.exceptAll(first).isEmpty()


def test_drop_empty_drops_only_empty_words(spark):
    df = spark.createDataFrame([("a  b ",)], "value string")
    assert {row["word"] for row in words.count_words(df, drop_empty=True).collect()} == {"a", "b"}


def test_ranking_breaks_ties_by_word(spark):
    df = spark.createDataFrame([("b a c c d",)], "value string")
    rows = words.top(words.count_words(df), 3).collect()
    assert [(row["word"], row["count"]) for row in rows] == [("c", 2), ("a", 1), ("b", 1)]


def test_top_is_one_shuffle_and_a_top_k(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = words.top(words.count_words(docs, "text", fold=True), 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan
