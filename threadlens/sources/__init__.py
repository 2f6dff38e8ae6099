"""Readers and writers."""

from threadlens.sources.readers import read_csv, read_json, read_parquet, read_two_row_csv
from threadlens.sources.writers import write_csv, write_json_gzip, write_parquet, write_two_row_csv

__all__ = [
    "read_csv", "read_json", "read_parquet", "read_two_row_csv", "write_csv", "write_json_gzip", "write_parquet", "write_two_row_csv",
]
