"""The test tables saved in the layouts the readers expect, read back, and worked on from there.

Every call writes to a folder of its own in the shared folder.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.config import QUOTE_SIDES
from curveloom.operators import auctions, quotes, returns
from curveloom.plans import adapters as a
from curveloom.plans import stored
from curveloom.sources import tables
from curveloom.sources.store import own_path, write_table


def risk_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Deliverable risk, a Parquet folder for each variable."""
    at, risk = own_path(spark, "risk"), a.risk(spark, folder)
    paths = [f"{at}/{variable}" for variable in a.RISK_VARIABLES]
    for variable, path in zip(a.RISK_VARIABLES, paths):
        write_table(risk.where(F.col("variable") == variable), path)
    return returns.deliverable_panel(tables.read_risk(spark, paths))


def daily_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Daily quotes, a folder of JSON arrays for each side, one a month, in long form; a tenor that a day lacks is missing."""
    at = own_path(spark, "quotes")
    cells = [F.max(f"`{t}`").alias(t) for t in a.QUOTE_TENORS]
    daily = a.quotes_wide(spark, folder).groupBy(F.to_date("date").cast("string").alias("Date"), "quote").agg(*cells)
    record = F.struct("Date", *[F.col(f"`{t}`") for t in a.QUOTE_TENORS])
    arrays = daily.groupBy("quote", F.substring("Date", 1, 7).alias("month")).agg(F.to_json(F.collect_list(record)).alias("value"))
    for side in QUOTE_SIDES:
        one_a_file = arrays.where(F.col("quote") == side).select("value").write.option("maxRecordsPerFile", 1)
        one_a_file.text(f"{at}/historical_ct_yields_{side}_side")
    return quotes.quotes_long(tables.read_quote_files(spark, at, a.QUOTE_TENORS))


def observed(spark: SparkSession, folder: str) -> DataFrame:
    """Observed securities, a Parquet folder for each vintage, reconciled."""
    at = own_path(spark, "observed")
    for vintage, rows in a.vintages(spark, folder).items():
        write_table(rows, f"{at}/market_observed_usts_{vintage}")
    return auctions.reconcile_observed(tables.read_observed(spark, at))


def saved_auctions(spark: SparkSession, folder: str) -> DataFrame:
    """Auctions as a CSV table with leading row numbers."""
    at, raw = own_path(spark, "auctions"), a.auctions_raw(spark, folder)
    raw.write.option("header", True).csv(at)
    schema = ", ".join(f"{name} {kind}" for name, kind in raw.dtypes)
    return auctions.typed_auctions(tables.read_indexed(spark, at, schema, a.AUCTION_INDEX))


def built_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic returns, built from saved risk and yields and read from the table they were stored in."""
    at = own_path(spark, "rates")
    write_table(a.risk(spark, folder), f"{at}/risk")
    write_table(a.yields(spark, folder), f"{at}/yields")
    return stored.synthetic_returns(spark, at, [f"{at}/risk"], [f"{at}/yields"], a.universe(spark, folder))


def appended_returns(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic returns, built up to the end of 1996 from saved risk and yields, and extended when the later ones are there too."""
    at = own_path(spark, "rates")
    for name, rows in (("risk", a.risk(spark, folder)), ("yields", a.yields(spark, folder))):
        late = F.col("date") >= F.lit("1997-01-01").cast("date")
        write_table(rows.where(~late), f"{at}/early/{name}")
        write_table(rows.where(late), f"{at}/late/{name}")
    built = None
    for parts in (["early"], ["early", "late"]):
        paths = [[f"{at}/{part}/{name}" for part in parts] for name in ("risk", "yields")]
        built = stored.extended_returns(spark, at, *paths, a.universe(spark, folder))
    return built


def stored_yields(spark: SparkSession, folder: str) -> DataFrame:
    """Yields in long form within the risk panel's span, from a panel stored by year, of which only the span's years are opened."""
    at = own_path(spark, "panel")
    write_table(a.yields(spark, folder), f"{at}/yields")
    panel = stored.yield_panel(spark, at, [f"{at}/yields"], a.YIELD_SERIES)
    span = returns.date_range(returns.deliverable_panel(a.risk(spark, folder)))
    return returns.yields_long(returns.within_range(panel, span).drop("year"))
