"""Rates and bond time-series analytics as lazy Spark DataFrame transformations."""
