"""Time the headline queries on the tables in $BENCH_SF_DIR and print one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from recordlens.plans.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Each query runs once to warm up and then REPEATS times; the best time counts.
REPEATS = 1
HEADLINE = (
    "word_count",
    "word_count_folded",
    "top_words",
    "top_words_folded",
    "word_count_java_split",
    "word_count_of_lines",
    "csv_round_trip",
    "parquet_overwrite",
    "cast_records",
    "repaired_codes",
    "time_spans",
    "prepared_records",
    "summary_of_numbers",
    "pair_frequencies",
    "top_values",
    "distinct_deadlines",
    "document_tokens",
    "filtered_tokens",
    "term_frequencies",
    "vocabulary",
    "term_weights",
    "label_index",
    "count_vectors",
    "idf_vectors",
    "hashed_term_vectors",
    "string_indexer",
    "assembled_vectors",
    "summary_of_texts",
    "split_sizes",
    "weighted_f1",
)
# Training runs once, without a warm-up.
TRAINING = ("heldout_scores", "heldout_f1", "saved_model_agreement", "grid_report", "campaign_models")


#: The test tables are single files, which one task reads; the documents are dealt into so many before anything is timed.
FILES = 8


def dealt_tables(spark: SparkSession) -> str:
    """A folder with all tables of ``FOLDER``, the documents among them as ``FILES`` files."""
    folder = Path(tempfile.mkdtemp(prefix="bench-"))
    for path in Path(FOLDER).glob("*.parquet"):
        if path.stem != "documents":
            (folder / path.name).symlink_to(path)
    spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(FILES).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("recordlens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = dealt_tables(spark)
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(min(seconds(spark, name, folder) for _ in range(REPEATS)), 3)
    for name in TRAINING:
        times[name] = round(seconds(spark, name, folder), 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
