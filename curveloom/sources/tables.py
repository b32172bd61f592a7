"""Readers. Each applies its declared schema, turns NaN into NULL and dates into ``DateType``.

Dates saved as nanosecond timestamps, as pandas does, need ``spark.sql.legacy.parquet.nanosAsLong`` in the session.
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curveloom.functions.scalar import last_token, null_nans
from curveloom.sources import schemas

NANOS_PER_DAY = 86_400_000_000_000


def read_risk(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Deliverable risk, one Parquet file or folder per security."""
    return null_nans(_dated(spark.read.parquet(*paths), schemas.RISK))


def read_prices(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return null_nans(_dated(spark.read.parquet(*paths), schemas.PRICES))


def read_panel(spark: SparkSession, paths: Sequence[str], series: Sequence[str]) -> DataFrame:
    """Wide date x series panel: yields per tenor, or prices per ticker."""
    ddl = ", ".join(["date date", *[f"`{c}` double" for c in series]])
    return null_nans(_dated(spark.read.parquet(*paths), ddl))


def read_quote_files(
    spark: SparkSession, folder: str, tenors: Sequence[str], pattern: str = "historical_*", unlisted: str = "raise",
) -> DataFrame:
    """JSON quote files, one per side, as ``date, quote`` and a column per tenor.

    Files, and folders of part files, named like ``pattern`` are read; the side is the second last ``_`` token of that
    name. Records that don't parse are an error, and so is a folder without any such name. So is a tenor that is not among
    ``tenors``, unless ``unlisted`` says to ``keep`` it, as a column behind the others, or to ``drop`` it.
    """
    if unlisted not in ("raise", "keep", "drop"):
        raise ValueError(f"unlisted is raise, keep or drop, not {unlisted}")
    path = f"{folder.rstrip('/')}/{pattern}"
    if unlisted != "drop":
        more = unlisted_keys(spark, path, ["Date", *tenors])
        if more and unlisted == "raise":
            raise ValueError(f"quote files have tenors that are not listed: {', '.join(more)}")
        tenors = [*tenors, *more]
    raw = spark.read.schema(schemas.quotes(tenors)).option("multiLine", True).option("mode", "FAILFAST").json(path)
    side = F.element_at(F.split(_named(_expression(pattern)), "_"), -2)
    return null_nans(raw.select(F.to_date("Date").alias("date"), side.alias("quote"), *[F.col(f"`{t}`") for t in tenors]))


def unlisted_keys(spark: SparkSession, path: str, listed: Sequence[str]) -> list[str]:
    """Keys of JSON records, sorted, that are not listed. A job over all records; as many results as there are such keys."""
    files = spark.read.text(path, wholetext=True)
    records = files.select(F.explode(F.from_json("value", "array<map<string,string>>", {"mode": "FAILFAST"})).alias("record"))
    keys = records.select(F.explode(F.array_except(F.map_keys("record"), F.array(*map(F.lit, listed)))).alias("key"))
    return [r["key"] for r in keys.distinct().orderBy("key").collect()]


def read_observed(spark: SparkSession, folder: str, index_columns: Sequence[str] = ()) -> DataFrame:
    """Parquet files, or folders of part files, whose names have six ``_`` tokens, tagged with their vintage.

    The vintage is the name's stem after ``usts_``. A column that one vintage lacks is NULL there. A folder without
    any such name is an error; other tables in it are not opened.
    """
    rows = spark.read.option("mergeSchema", True).parquet(f"{folder.rstrip('/')}/*_*_*_*_*_*")
    stem = F.substring_index(_named("[^_.]+(_[^_.]+){5}([.].*)?"), ".", 1)
    named = rows.select("*", stem.alias("_stem")).where(F.col("_stem").isNotNull())
    return null_nans(named.withColumn("group", last_token(F.col("_stem"), "usts_")).drop("_stem", *index_columns))


def read_indexed(spark: SparkSession, path: str, schema: str, index_columns: Sequence[str]) -> DataFrame:
    """A saved CSV table without its leading row-number columns. Another header, or a cell that doesn't parse, is an error."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.csv(path).drop(*index_columns)


def _expression(pattern: str) -> str:
    """The expression of a file pattern with stars."""
    return ".*".join(map(re.escape, pattern.split("*")))


def _named(expression: str) -> Column:
    """The last part of a row's path, be it a file or a folder above it, that matches a whole expression; NULL if none."""
    parts = F.filter(F.split(F.col("_metadata.file_path"), "/"), lambda part: part.rlike(f"^(?:{expression})$"))
    return F.try_element_at(parts, F.lit(-1))


def _dated(df: DataFrame, ddl: str) -> DataFrame:
    """Project to the declared columns and types; a timestamp, or its nanoseconds, becomes a date."""
    if isinstance(df.schema["date"].dataType, T.LongType):
        df = df.withColumn("date", F.date_from_unix_date(F.floor(F.col("date") / NANOS_PER_DAY).cast("int")))
    fields = [part.strip().rsplit(" ", 1) for part in ddl.split(",")]
    return df.select(*[F.col(name).cast(kind).alias(name.strip("`")) for name, kind in fields])
