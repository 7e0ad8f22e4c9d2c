"""Profiling operators against Spark's own describe and against counting by hand."""

import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F
from recordlens.operators import infer, profile, states
from recordlens.plans.queries import typed_campaigns


def test_summary_agrees_with_describe(spark, small):
    records = typed_campaigns(spark, small)
    columns = ["goal", "backers_count", "final_status", "country", "keywords"]
    found = {row["column"]: row for row in profile.summary(records, columns).collect()}
    described = {row["summary"]: row for row in records.select(columns).describe().collect()}
    for name in columns:
        row = found[name]
        assert str(row["n"]) == described["count"][name]
        assert row["min"] == described["min"][name] and row["max"] == described["max"][name]
        for mine, theirs in (("mean", "mean"), ("stddev", "stddev")):
            wanted = described[theirs][name]
            if wanted is None:
                assert row[mine] is None
            else:
                assert row[mine] == pytest.approx(float(wanted))
    assert found["goal"]["type"] == "int" and found["country"]["type"] == "string"
    assert found["goal"]["n_null"] == records.where("goal is null").count()


def test_summary_is_one_pass(spark, small):
    records = spark.read.parquet(f"{small}/orders.parquet")
    plan = profile.summary(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_values_agree_with_counting(spark, k):
    rows = [(i % 7, "x" if i % 3 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    found = {}
    for row in profile.top_values(df, ["a", "b", "c"], k).collect():
        found.setdefault(row["column"], {})[row["rank"]] = (row["value"], row["count"])
    for position, name in enumerate("abc"):
        counts = Counter(None if row[position] is None else str(row[position]) for row in rows)
        order = sorted(counts.items(), key=lambda item: (-item[1], item[0] is not None, item[0] or ""))
        assert [found[name][rank] for rank in sorted(found[name])] == order[:k]


def test_top_values_limits_before_it_shuffles(spark, small):
    records = spark.read.parquet(f"{small}/orders.parquet")
    plan = profile.top_values(records, ["o_custkey", "o_orderstatus"], 10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert text.count("WindowGroupLimit") == 4


def test_counts_and_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "x string, y int")
    assert profile.row_count(df).first()["n_rows"] == 3
    assert profile.distinct_values(df, "x").count() == 2
    assert profile.distinct_rows(df, "x", "y").count() == 2
    assert {tuple(row) for row in profile.value_counts(df, "x", "y").collect()} == {("a", 1, 2), ("b", None, 1)}
    assert [row["x"] for row in profile.first_rows(df.select("x").distinct(), 1, "x").collect()] == ["a"]


def test_schema_table(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert [tuple(row)[:3] for row in profile.schema_table(df).orderBy("position").collect()] == [
        (0, "n", "int"),
        (1, "s", "string"),
    ]


def test_summary_of_booleans_and_dates(spark):
    df = spark.range(3).select((F.col("id") > 0).alias("b"), F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("d"))
    found = {row["column"]: row for row in profile.summary(df).collect()}
    assert (found["b"]["min"], found["b"]["max"]) == ("false", "true")
    assert (found["d"]["min"], found["d"]["max"]) == ("2020-01-01", "2020-01-03")


# Types and states


def test_types_of_all_values(spark):
    rows = [("1", "1", "2020-01-01", "true", "a", None, 1), ("+2", "2.", "2020-01-01 10:00", "False", "2", None, 2), (" 3 ", "-1E5", "2020-13-01", None, "3", None, 3), (None, "99999999999", None, "true", "4", None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, `f.x` string, g int").repartition(3)
    found = {r["column"]: tuple(r)[1:] for r in infer.infer_types(df).collect()}
    assert found == {
        "a": (0, "int", 3, 1, 3, 1.0),
        "b": (1, "double", 4, 0, 4, 1.0),
        "c": (2, "string", 3, 1, 3, 1.0),
        "d": (3, "boolean", 3, 1, 3, 1.0),
        "e": (4, "string", 4, 0, 4, 1.0),
        "f.x": (5, "string", 0, 4, 0, None),
        "g": (6, "int", 3, 1, 3, 1.0),
    }
    loose = {r["column"]: (r["type"], r["n_fit"], r["share"]) for r in infer.infer_types(df, ["e", "c"], least_share=0.6).collect()}
    assert loose == {"e": ("int", 3, 0.75), "c": ("timestamp", 2, 2 / 3)}
    assert [(r["type"], r["n"], r["n_null"]) for r in infer.infer_types(df.limit(0)).collect()] == [("string", 0, 0)] * 6 + [("int", 0, 0)]
    with pytest.raises(ValueError):
        infer.infer_types(df, least_share=0)


def as_summary(df):
    return {r["column"]: tuple(round(v, 6) if isinstance(v, float) else v for v in tuple(r)[1:]) for r in df.collect()}


def test_merged_states_equal_one_summary(spark, tmp_path):
    rows = [(i, 1e9 + i % 7 if i % 5 else None, f"{i}" if i % 3 else "x", i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, big double, text string, part int")
    path = f"{tmp_path}/states"
    for part in range(4):
        states.add_state(states.summary_state(df.where(f"part = {part}"), ["id", "big", "text"]), path)
    stored = states.read_states(spark, path)
    assert stored.count() == 4
    assert as_summary(states.merged_summary(stored)) == as_summary(profile.summary(df, ["id", "big", "text"]))
    by_part = states.summary_state(df, ["id", "big"], by=["part"])
    assert by_part.count() == 4 and as_summary(states.merged_summary(by_part, ["big", "id"]))["big"][1:] == as_summary(profile.summary(df, ["big"]))["big"][1:]


def test_a_new_part_does_not_read_the_old_ones(spark, tmp_path):
    path, old = f"{tmp_path}/states", f"{tmp_path}/old"
    spark.range(10).write.parquet(old)
    states.add_state(states.summary_state(spark.read.parquet(old)), path)
    shutil.rmtree(old)
    states.add_state(states.summary_state(spark.range(10, 20)), path)
    assert as_summary(states.merged_summary(states.read_states(spark, path))) == as_summary(profile.summary(spark.range(20)))


def test_states_of_empty_and_null_parts(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "x double, y string")
    parts = [states.summary_state(df), states.summary_state(df.limit(0)), states.summary_state(spark.createDataFrame([(2.0, "7")], df.schema))]
    merged = as_summary(states.merged_summary(parts[0].union(parts[1]).union(parts[2])))
    assert merged == {"x": (0, "double", 1, 2, 2.0, None, "2.0", "2.0"), "y": (1, "string", 2, 1, 7.0, None, "7", "a")}
    assert as_summary(states.merged_summary(parts[1])) == as_summary(profile.summary(df.limit(0)))
    assert as_summary(states.merged_summary(parts[0].limit(0)))["x"][2:4] == (0, 0)
