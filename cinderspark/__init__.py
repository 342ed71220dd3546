"""Spark-first engine for gridded and building-level risk data."""
