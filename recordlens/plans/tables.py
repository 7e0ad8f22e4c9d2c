"""The tables that the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.sources import read_parquet

# o_orderdate has no time zone, so its epoch is put together from its parts, whatever the session's zone.
_EPOCH = (
    "(unix_date(cast(o_orderdate as date)) * 86400L"
    " + hour(o_orderdate) * 3600L + minute(o_orderdate) * 60L + cast(second(o_orderdate) as bigint))"
)

_CAMPAIGNS = {
    "id": "o_orderkey",
    "name": "concat('Order ', cast(o_orderkey as string))",
    "desc": """concat('Status ', o_orderstatus, ' of "class", ', o_orderpriority)""",
    "keywords": "case when o_orderkey % 13 = 0 then null else replace(o_orderpriority, ' ', '-') end",
    "goal": """case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then 'abc'
        when o_orderkey % 41 = 0 then concat(cast(cast(floor(o_totalprice) as bigint) as string), '.75')
        else cast(cast(floor(o_totalprice) as bigint) as string) end""",
    "launched_at": f"case when o_orderkey % 29 = 0 then null else {_EPOCH} end",
    "created_at": f"{_EPOCH} - (o_orderkey * 7919 % 2592000)",
    "deadline": f"{_EPOCH} + (o_custkey * 104729 % 5184000)",
    "state_changed_at": f"{_EPOCH} + (o_custkey * 104729 % 5184000)",
    "backers_count": "o_custkey % 500",
    "disable_communication": "case when o_orderkey % 97 = 0 then 'True' else 'False' end",
    "country": """case when o_orderkey % 11 = 0 then 'False' when o_orderkey % 23 = 0 then 'USA'
        when o_orderkey % 31 = 0 then null when o_orderkey % 37 = 0 then 'US'
        when o_custkey % 3 = 0 then 'US' when o_custkey % 3 = 1 then 'GB' else 'FR' end""",
    "currency": """case when o_orderkey % 11 = 0 then 'US' when o_orderkey % 23 = 0 then 'USD'
        when o_orderkey % 31 = 0 then 'dollars' when o_orderkey % 37 = 0 then 'dollars'
        when o_custkey % 3 = 0 then 'USD' when o_custkey % 3 = 1 then 'GBP' else 'EUR' end""",
    "final_status": "case when o_orderstatus = 'F' then 1 else 0 end",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/documents.parquet")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, value``: the lines of all documents. A null text is one empty line."""
    parts = F.split(F.coalesce("text", F.lit("")), "\n")
    return documents(spark, folder).select("doc_id", F.explode(parts).alias("value"))


def spaced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines, some of them with trailing or doubled spaces, of nothing but spaces, or empty."""
    return lines(spark, folder).selectExpr(
        """case when doc_id % 7 = 0 then concat(value, '  ') when doc_id % 7 = 1 then replace(value, ' ', '  ')
        when doc_id % 7 = 2 then '' when doc_id % 7 = 3 then '   ' else value end as value"""
    )


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """Campaign records derived from ``orders``, with a share of broken codes and missing values."""
    orders = table(spark, folder, "orders")
    return orders.selectExpr(*[f"{expression} as `{name}`" for name, expression in _CAMPAIGNS.items()])


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have labels, with them."""
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
