"""Spark operators that turn classified-listing pages and records into daily reporting tables."""
