"""Readers, writers and scratch tables."""

from recordlens.sources.readers import Checked, read_csv, read_csv_checked, read_csv_inferred, read_parquet, read_text
from recordlens.sources.scratch import materialize, scope, scratch_path
from recordlens.sources.writers import restore_interrupted, write_csv, write_parquet, write_text

__all__ = [
    "Checked",
    "materialize",
    "read_csv",
    "read_csv_checked",
    "read_csv_inferred",
    "read_parquet",
    "read_text",
    "restore_interrupted",
    "scope",
    "scratch_path",
    "write_csv",
    "write_parquet",
    "write_text",
]
