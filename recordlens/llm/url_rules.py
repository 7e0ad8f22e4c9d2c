"""Which rule of a list of (host, path) rules decides on a url: a sort-merge range join.

Hosts are turned round, ``www.example.com`` to ``com.example.www.``, so that a host and all its subdomains are an
interval of keys. Urls and rules are put in the order of their keys and swept once. A stack holds the rules
whose intervals are open; they are nested, as intervals of prefixes are. A url looks at the stack only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm.common import unused

#: Keys of urls that are fetched to place the borders between ranges, about, for each range; twice as many at most.
SAMPLED, SEED = 50, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels of a host turned round, each with a dot behind it; the empty host has the empty key."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host, path, rule, verdict`` to each row of ``urls``. Runs a job.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains if the url's path starts
    with the rule's path. Of those that fit the longest (host and path together) decides, then the one with the
    longer host, then the least in text order; the verdict of repeated rules is the least. ``rule`` is its host and
    path in one text. Urls that no rule fits have the verdict ``default`` and a null rule. Null urls and urls
    without ``://`` have an empty host and path, which no rule fits. Rules with a null or empty host fit nothing; a null path is
    empty. Columns of ``urls`` that are called like a new one are replaced.

    The rows are dealt into ranges of keys. A key that fills several ranges (a host, or one url, with a third of all rows) has its
    rows dealt over them, and rules go to every range that their interval touches, so neither side is
    gathered and no task needs a whole host. A task holds its stack only.
    """
    spark = urls.sparkSession
    kept = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    base = urls.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    names = {n: unused(base, n) for n in ("key", "range", "kind", "rule", "verdict")}
    key, range_, kind, rule, verdict = (names[n] for n in ("key", "range", "kind", "rule", "verdict"))
    keyed = base.withColumn(key, host_key(F.col("host")))

    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # Rows are drawn one by one, so a url that a third of all rows hold fills a third of the sample.
    share = min(1.0, SAMPLED * n_ranges / max(urls.count(), 1))
    drawn = keyed.select(key).sample(share, SEED).limit(2 * SAMPLED * n_ranges).collect()
    sample = sorted((row[0] for row in drawn), key=lambda k: k.encode())
    borders = [sample[len(sample) * i // n_ranges] for i in range(1, n_ranges)] if sample else []

    def first_range(column: Column) -> Column:
        return F.expr("0") if not borders else _place(column, borders, lambda b, k: b < k)

    def last_range(column: Column) -> Column:
        return F.expr("0") if not borders else _place(column, borders, lambda b, k: b <= k)

    low, high = first_range(F.col(key)), last_range(F.col(key))
    # Dealt by row, not by url, so the copies of one url are spread like any others. Which range a row is in changes no verdict.
    dealt = keyed.withColumn(range_, low + F.pmod(F.xxhash64(F.monotonically_increasing_id()), high - low + 1).cast("int"))

    known = (
        rules.where("host is not null and host <> ''")
        .select(F.translate("host", _UPPER, _LOWER).alias("_host"), F.coalesce("path", F.lit("")).alias("_path"), "verdict")
        .groupBy("_host", "_path")
        .agg(F.min("verdict").alias("_verdict"))
        .withColumn("_key", host_key(F.col("_host")))
    )
    # '/' is the next character after '.', so the interval of a key ends before the key with '/' for its last '.'.
    end = F.concat(F.expr("substring(_key, 1, length(_key) - 1)"), F.lit("/"))
    spread = known.withColumn("_range", F.explode(F.sequence(first_range(F.col("_key")), last_range(end))))

    schema = T.StructType(dealt.schema.fields + [T.StructField(kind, T.IntegerType()), T.StructField(rule, T.StringType()), T.StructField(verdict, T.StringType())])
    events = dealt.select("*", F.lit(1).alias(kind), F.lit(None).cast("string").alias(rule), F.lit(None).cast("string").alias(verdict))
    fill = {"host": F.col("_host"), "path": F.col("_path"), key: F.col("_key"), range_: F.col("_range"), kind: F.lit(0), verdict: F.col("_verdict")}
    opened = spread.select(*[fill.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    # The order of the sweep: a rule stands before the urls of its key.
    swept = (
        events.unionByName(opened)
        .repartition(n_ranges, range_)
        .sortWithinPartitions(range_, key, kind)
        .mapInArrow(_sweep(key, range_, kind, rule, verdict, default), schema)
    )
    columns = [F.col(c) for c in kept] + [F.col("host"), F.col("path"), F.col(rule).alias("rule"), F.col(verdict).alias("verdict")]
    return swept.select(*columns)


def _place(key: Column, borders: list[str], before) -> Column:
    """The number of borders before a key, by binary search: as many comparisons as the logarithm of their number."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(before(F.lit(borders[mid]), key), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(borders))


def _sweep(key: str, range_: str, kind: str, rule: str, verdict: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, dict[int, dict[str, tuple]]]] = []
        at = None
        for batch in batches:
            names = batch.schema.names
            get = {n: batch.column(names.index(n)).to_pylist() for n in ("host", "path", key, range_, kind, verdict)}
            found, said, keep = [], [], []
            for i, (host, path, k, r, what, own) in enumerate(zip(*get.values(), strict=True)):
                if r != at:
                    stack, at = [], r
                while stack and not k.startswith(stack[-1][0]):
                    stack.pop()
                if what == 0:
                    if not stack or stack[-1][0] != k:
                        stack.append((k, {}))
                    stack[-1][1].setdefault(len(path), {})[path] = (host, own)
                    continue
                best = None
                for _, by_length in stack:
                    for n, paths in by_length.items():
                        if n <= len(path) and (hit := paths.get(path[:n])):
                            name = hit[0] + path[:n]
                            rank = (-len(name), -len(hit[0]), name)
                            if best is None or rank < best[0]:
                                best = (rank, name, hit[1])
                keep.append(i)
                found.append(best and best[1])
                said.append(best[2] if best else default)
            out = batch.take(pa.array(keep, pa.int64()))
            columns = list(out.columns)
            columns[names.index(rule)] = pa.array(found, pa.string())
            columns[names.index(verdict)] = pa.array(said, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run
