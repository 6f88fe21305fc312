"""Fareloom: a batch and incremental trip-analytics engine written on the Spark DataFrame API."""
