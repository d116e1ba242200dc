"""Readers and writers: raw CSV, Parquet tables, saved metric reports, summary sinks, the star-schema view."""
