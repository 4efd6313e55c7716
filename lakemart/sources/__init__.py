"""Readers: raw edition CSVs, parquet layers, field dictionaries."""

from lakemart.sources.csv import read_editions, read_raw_csv, read_split_csv
from lakemart.sources.dictionary import dictionary_from_rows, read_dictionary
from lakemart.sources.footers import footer_counts, stored_null_profile
from lakemart.sources.parquet import read_leaf, read_table, read_tables

__all__ = ["read_raw_csv", "read_split_csv", "read_editions", "read_table", "read_tables", "read_leaf",
           "read_dictionary", "dictionary_from_rows", "footer_counts", "stored_null_profile"]
