"""Sinks: Parquet, CSV and JSON-lines output folders."""
