"""Readers (parquet tables, CSV, text streams) and batch sinks."""
