"""Readers and writers. Parquet is the working format; CSV and JSON are for exchange."""
