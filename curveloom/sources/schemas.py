"""Declared schemas of the input tables."""

from collections.abc import Sequence

from pyspark.sql import types as T

RISK = "date date, security string, variable string, value double"
PRICES = "date date, security string, PX_LAST double"


def panel(columns: Sequence[str]) -> T.StructType:
    """Wide date x series table."""
    return T.StructType([T.StructField("date", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in columns])


def quotes(tenors: Sequence[str]) -> T.StructType:
    """One side's quote file: ``Date`` as text and a column per tenor."""
    return T.StructType([T.StructField("Date", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in tenors])
