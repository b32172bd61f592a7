"""Column expressions shared by the operators."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, rather than an error or infinity, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def first_token(text: Column, separator: str = " ") -> Column:
    return F.substring_index(text, separator, 1)


def last_token(text: Column, separator: str) -> Column:
    return F.substring_index(text, separator, -1)


def capitalized_token(text: Column, separator: str = "_") -> Column:
    return F.initcap(first_token(text, separator))


def null_nans(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so that missing has one form from here on."""
    floating = (T.DoubleType, T.FloatType)
    fixes = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, floating)
    }
    return df.withColumns(fixes) if fixes else df


def row_mean(columns: Sequence[str]) -> Column:
    """Mean over the present values of one row; NULL if all are missing."""
    total = " + ".join(f"coalesce(`{c}`, 0D)" for c in columns)
    return ratio(F.expr(total), present_count(columns))


def present_count(columns: Sequence[str]) -> Column:
    return F.expr(" + ".join(f"if(`{c}` IS NULL, 0, 1)" for c in columns))
