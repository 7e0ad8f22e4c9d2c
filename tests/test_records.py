"""Cleaning operators on small tables of edge cases."""

import pytest
from pyspark.sql import functions as F
from recordlens.functions import epoch_span, valid_code
from recordlens.operators import clean

CODES = [
    ("False", "US"),
    ("US", "USD"),
    ("US", "dollars"),
    (None, "dollars"),
    ("US", None),
    ("False", None),
    ("USA", "USD"),
    (None, None),
]


def column(df, name):
    return [row[name] for row in df.collect()]


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame(CODES, "country string, currency string").coalesce(1)


def test_full_code_rule(codes):
    fixed = clean.repair_codes(codes)
    assert column(fixed, "country2") == ["US", "US", "US", None, "US", None, None, None]
    assert column(fixed, "currency2") == [None, "USD", None, None, None, None, "USD", None]
    assert fixed.columns == ["country2", "currency2"]


def test_short_code_rule_leaves_currency_of_missing_country(codes):
    fixed = clean.repair_codes(codes, rule="short")
    assert column(fixed, "country2") == ["US", "US", "US", None, "US", None, "USA", None]
    assert column(fixed, "currency2") == [None, "USD", None, "dollars", None, None, "USD", None]


def test_unknown_rule_is_refused(codes):
    with pytest.raises(ValueError):
        clean.repair_codes(codes, rule="other")


def test_valid_code_with_other_guard(spark):
    df = spark.createDataFrame([("ab", 1), ("abc", 1), ("abc", None)], "c string, g int")
    assert column(df.select(valid_code(F.col("c"), 2, F.col("g")).alias("c")), "c") == ["ab", None, "abc"]


@pytest.mark.parametrize(
    ("text", "as_int", "as_bigint"),
    [
        ("20", 20, 20),
        ("20.7", 20, 20),
        ("-20.7", -20, -20),
        (".5", 0, 0),
        ("7.", 7, 7),
        (" 42 ", 42, 42),
        ("abc", None, None),
        ("1.2.3", None, None),
        ("", None, None),
        (None, None, None),
        ("3000000000", None, 3000000000),
        ("9007199254740993", None, 9007199254740993),
        ("9007199254740993.9", None, 9007199254740993),
        ("99999999999999999999", None, None),
    ],
)
def test_text_casts(spark, text, as_int, as_bigint):
    df = spark.createDataFrame([(text, text)], "a string, b string")
    row = clean.cast_columns(df, {"a": "int", "b": "bigint"}).first()
    assert (row.a, row.b) == (as_int, as_bigint)


def test_number_casts_keep_range_and_cut_fractions(spark):
    df = spark.createDataFrame([(20.7,), (1e10,), (float("nan"),), (None,)], "a double")
    assert column(clean.cast_columns(df, {"a": "int"}), "a") == [20, None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi_mode(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("abc",), ("5",)], "a string").coalesce(1)
        assert column(clean.cast_columns(df, {"a": "int"}), "a") == [None, 5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_spans(spark):
    rows = [(1435162500, 1434931111), (100, 300), (None, 1), (2**31 - 1, -(2**31))]
    df = spark.createDataFrame(rows, "e int, s int").coalesce(1)
    days = column(df.select(epoch_span(F.col("e"), F.col("s"), 86400).alias("d")), "d")
    assert days[:3] == [2.678, -0.002, None]
    assert days[3] == round((2**32 - 1) / 86400, 3)


def test_fill_is_typed(spark):
    df = spark.createDataFrame([(None, None, None), (1.5, 2, "FR")], "d double, g int, c string").coalesce(1)
    filled = clean.fill_missing(df, ["d", "g"], ["c"])
    assert [tuple(row) for row in filled.collect()] == [(-1.0, -1, "Unknown"), (1.5, 2, "FR")]
    assert [field.dataType.simpleString() for field in filled.schema] == ["double", "int", "string"]
    # Filling numbers with text does nothing in Spark, which is why the number is typed here.
    assert df.na.fill("-1", ["d", "g"]).first()[:2] == (None, None)


def test_label_missing_equals_fill(spark):
    df = spark.createDataFrame([(None,), ("FR",)], "c string").coalesce(1)
    assert (
        column(clean.label_missing(df, ["c"], "x"), "c")
        == column(clean.fill_missing(df, texts=["c"], text="x"), "c")
        == ["x", "FR"]
    )


def test_drop_missing(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 2)], "c string, n int")
    assert clean.drop_missing(df).count() == 1
    assert clean.drop_missing(df, ["n"]).count() == 2


def test_joined_text_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string").coalesce(1)
    assert column(clean.add_text(df, ["x", "y", "z"]), "text") == ["a c", ""]


def test_filters(codes):
    assert clean.rows_equal(codes, "country", "False").count() == 2
    assert clean.rows_present(codes, "country").count() == 6
