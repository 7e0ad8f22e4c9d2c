"""The cleaning job: raw campaign records to a table ready for the classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlens.operators import clean
from recordlens.sources import read_csv, write_parquet

# The raw columns, and the types of those that are not text.
RAW_COLUMNS = (
    "name",
    "desc",
    "goal",
    "keywords",
    "disable_communication",
    "country",
    "currency",
    "deadline",
    "state_changed_at",
    "created_at",
    "launched_at",
    "backers_count",
    "final_status",
)
TYPES = {
    "goal": "int",
    "deadline": "bigint",
    "state_changed_at": "bigint",
    "created_at": "bigint",
    "launched_at": "bigint",
    "backers_count": "int",
    "final_status": "int",
}

NEAR_CONSTANT = ("disable_communication",)
KNOWN_AFTERWARDS = ("backers_count", "state_changed_at")
TEXTS = ("name", "desc", "keywords")
SPANS = {
    "days_campaign": ("deadline", "launched_at", 86400),
    "hours_prepa": ("launched_at", "created_at", 3600),
}
FILLED_NUMBERS = ("days_campaign", "hours_prepa", "goal")
FILLED_TEXTS = ("country2", "currency2")


def prepare_records(raw: DataFrame, *, code_rule: str = "full", label: str = "Unknown") -> DataFrame:
    """Cast, prune, repair, derive and fill.

    Every step is narrow: the whole job is one stage without a shuffle, and columns that are dropped
    are never read from a columnar source. Further columns of ``raw`` pass through.
    """
    df = clean.cast_columns(raw, TYPES)
    df = clean.drop_columns(df, NEAR_CONSTANT + KNOWN_AFTERWARDS)
    df = clean.repair_codes(df, rule=code_rule)
    df = clean.add_spans(df, SPANS)
    df = clean.drop_columns(df, ("launched_at", "created_at", "deadline"))
    df = clean.fold_columns(df, TEXTS)
    df = clean.add_text(df, TEXTS)
    return clean.fill_missing(df, FILLED_NUMBERS, FILLED_TEXTS, text=label)


def run(spark: SparkSession, csv_path: str, out_path: str, *, columns=RAW_COLUMNS, code_rule: str = "full") -> None:
    """CSV in, prepared parquet out, replacing what is there. Further columns of the CSV pass through."""
    raw = read_csv(spark, csv_path, columns, others=True)
    write_parquet(prepare_records(raw, code_rule=code_rule), out_path, overwrite=True)
