"""Cleaning operators. Each one is a projection or a filter, so a chain of them is one stage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.functions import epoch_span, folded, joined_text, repair_shifted, valid_code, whole_number

_WHOLE_TYPES = {"tinyint", "smallint", "int", "integer", "bigint"}


def cast_text(col: Column, target: str) -> Column:
    """Text as a type; what does not fit is null."""
    return whole_number(col, target) if target.lower() in _WHOLE_TYPES else col.try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place, e.g. ``{"goal": "int"}``; values that do not fit become null."""
    texts = {field.name for field in df.schema if isinstance(field.dataType, T.StringType)}
    casts = {name: cast_text(F.col(name), to) if name in texts else F.col(name).try_cast(to) for name, to in types.items()}
    return df.withColumns(casts)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove columns: near-constant ones, ones known only after the outcome, used-up ones."""
    return df.drop(*columns)


def rows_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column holds the value."""
    return df.where(F.col(column) == value)


def rows_present(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is not null."""
    return df.where(F.col(column).isNotNull())


def repair_codes(
    df: DataFrame,
    country: str = "country",
    currency: str = "currency",
    *,
    sentinel: str = "False",
    country_length: int = 2,
    currency_length: int = 3,
    rule: str = "full",
) -> DataFrame:
    """Replace the two code columns by repaired ``<name>2`` columns.

    Where the country is the sentinel, the true country slipped into the currency column. The
    ``full`` rule also nulls codes of a wrong length. The ``short`` rule does not check the country's
    length and leaves a currency unchecked where the country is null.
    """
    if rule not in ("full", "short"):
        raise ValueError(f"unknown rule {rule!r}")
    place, money = F.col(country), F.col(currency)
    full = rule == "full"
    return df.withColumns(
        {
            f"{country}2": repair_shifted(place, money, sentinel, country_length if full else None),
            f"{currency}2": valid_code(money, currency_length, None if full else place),
        }
    ).drop(country, currency)


def add_spans(df: DataFrame, spans: Mapping[str, tuple[str, str, int]], digits: int = 3) -> DataFrame:
    """Add time spans: ``{name: (end column, start column, seconds per unit)}`` over epoch seconds."""
    return df.withColumns(
        {name: epoch_span(F.col(end), F.col(start), unit, digits) for name, (end, start, unit) in spans.items()}
    )


def fold_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Lower-case text columns in place."""
    return df.withColumns({name: folded(F.col(name)) for name in columns})


def add_text(df: DataFrame, columns: Iterable[str], name: str = "text", sep: str = " ") -> DataFrame:
    """Add one text column joined from several; nulls are skipped."""
    return df.withColumn(name, joined_text(*[F.col(c) for c in columns], sep=sep))


def fill_missing(
    df: DataFrame,
    numbers: Iterable[str] = (),
    texts: Iterable[str] = (),
    *,
    number: float = -1,
    text: str = "Unknown",
) -> DataFrame:
    """Fill nulls: numeric columns with ``number`` (typed, so they are filled), text ones with ``text``."""
    numbers, texts = list(numbers), list(texts)
    if numbers:
        df = df.na.fill(number, numbers)
    if texts:
        df = df.na.fill(text, texts)
    return df


def label_missing(df: DataFrame, columns: Iterable[str], label: str = "unknown") -> DataFrame:
    """Put a label where a text column is null, written as a column expression."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(label)) for name in columns})


def drop_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (default: in any column)."""
    return df.na.drop(subset=None if columns is None else list(columns))
