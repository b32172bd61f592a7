"""The main tables, built on first use and read from storage after that.

Each function returns the table in ``folder``, building it and the stored tables it rests on if need be. A
folder is any path that all executors share, such as ``store.shared_path(spark, "rates")``.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.config import TENOR_PREFIX, UNIVERSE, VINTAGES, ZSCORE_CUTOFF, ZSCORE_WINDOW
from curveloom.functions.reshape import assert_unique
from curveloom.functions.scalar import first_token
from curveloom.operators import auctions, flies, quotes, returns, spreads, universe
from curveloom.sources import tables
from curveloom.sources.store import extend, kept, materialize

TENORS = tuple(f"{TENOR_PREFIX}{maturity}" for maturity in UNIVERSE.values())


def synthetic_returns(
    spark: SparkSession, folder: str, risk_paths: Sequence[str], yield_paths: Sequence[str],
    securities: DataFrame | None = None, tenors: Sequence[str] = TENORS, refresh: bool = False,
) -> DataFrame:
    """``tenors`` are the columns to read from the yield panel. Repeated risk values are an error."""
    def build() -> DataFrame:
        risk, yields = tables.read_risk(spark, risk_paths), tables.read_panel(spark, yield_paths, tenors)
        # As the panel keys them: securities by their first token.
        assert_unique(risk.withColumn("security", first_token(F.col("security"))), ["date", "security", "variable"])
        assert_unique(yields, ["date"])
        return returns.synthetic_returns(risk, yields, _universe(spark, securities))
    return materialize(spark, f"{folder}/synthetic_returns", build, refresh=refresh)


def extended_returns(
    spark: SparkSession, folder: str, risk_paths: Sequence[str], yield_paths: Sequence[str],
    securities: DataFrame | None = None, tenors: Sequence[str] = TENORS,
) -> DataFrame:
    """Synthetic returns, with only the dates computed that the stored table doesn't reach yet.

    The result is that of building all dates at once: each security's last yield is stored with the table, so the
    first new change starts from it. Rows that come later for dates already stored are not seen.
    """
    def build(since: dt.date | None, earlier: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        risk, yields = tables.read_risk(spark, risk_paths), tables.read_panel(spark, yield_paths, tenors)
        if since is not None:
            risk, yields = (df.where(F.col("date") > F.lit(since)) for df in (risk, yields))
        assert_unique(yields, ["date"])
        panel = returns.with_maturity(returns.deliverable_panel(risk), _universe(spark, securities))
        curve = kept(returns.curve_join(panel, returns.yields_long(yields)), "curve")
        daily = returns.return_terms(returns.yield_differences(curve, earlier=earlier))
        return daily, returns.last_yields(curve, earlier=earlier)
    return extend(spark, f"{folder}/extended_returns", build)


def yield_panel(
    spark: SparkSession, folder: str, yield_paths: Sequence[str], tenors: Sequence[str] = TENORS, refresh: bool = False,
) -> DataFrame:
    """The wide yield panel, partitioned by ``year``, so that ``returns.within_range`` opens only the years of a span."""
    def build() -> DataFrame:
        yields = tables.read_panel(spark, yield_paths, tenors).withColumn("year", F.year("date"))
        return yields.repartition("year")
    return materialize(spark, f"{folder}/yield_panel", build, ["year"], refresh)


def steepeners(
    spark: SparkSession, folder: str, daily: DataFrame, securities: DataFrame | None = None, refresh: bool = False,
) -> DataFrame:
    """All steepeners of the stored returns, one partition each."""
    pairs = universe.tenor_pairs(_universe(spark, securities))
    return materialize(spark, f"{folder}/steepeners", lambda: spreads.steepener_panel(daily, pairs), ["steepener"], refresh)


def fly_strategies(
    spark: SparkSession, folder: str, daily: DataFrame, securities: DataFrame | None = None, refresh: bool = False,
) -> DataFrame:
    """All flies of the stored returns, one partition each."""
    triples = universe.tenor_triples(_universe(spark, securities))
    return materialize(spark, f"{folder}/flies", lambda: flies.fly_panel(daily, triples), ["fly"], refresh)


def filtered_auctions(
    spark: SparkSession, folder: str, path: str, schema: str, index_columns: Sequence[str], refresh: bool = False,
) -> DataFrame:
    def build() -> DataFrame:
        return auctions.typed_auctions(tables.read_indexed(spark, path, schema, index_columns))
    return materialize(spark, f"{folder}/filtered_auctions", build, refresh=refresh)


def historical_auctions(
    spark: SparkSession, folder: str, left: DataFrame, right: DataFrame, auction_columns: Sequence[str],
    refresh: bool = False,
) -> DataFrame:
    """Two raw histories reconciled to ``ids, variable, value``."""
    def build() -> DataFrame:
        return auctions.reconcile_auctions(*[auctions.auction_long(h, auction_columns) for h in (left, right)])
    return materialize(spark, f"{folder}/historical_auctions", build, refresh=refresh)


def observed_securities(
    spark: SparkSession, source: str, index_columns: Sequence[str] = (), vintages: Sequence[str] = VINTAGES,
    as_text: bool = True,
) -> DataFrame:
    """Observed securities of all vintage files in ``source``, reconciled. Not stored."""
    return auctions.reconcile_observed(tables.read_observed(spark, source, index_columns), vintages, as_text)


def raw_quotes(
    spark: SparkSession, folder: str, source: str, tenors: Sequence[str], refresh: bool = False, unlisted: str = "raise",
) -> DataFrame:
    """``date, quote, tenor, value, tenor_days`` of all quote files in ``source``. Repeated quotes are an error, and so are
    tenors that are not listed, unless ``unlisted`` says to ``keep`` or ``drop`` them."""
    def build() -> DataFrame:
        files = tables.read_quote_files(spark, source, tenors, unlisted=unlisted)
        assert_unique(files, ["date", "quote"])
        return quotes.with_tenor_days(quotes.quotes_long(files))
    return materialize(spark, f"{folder}/raw_quotes", build, refresh=refresh)


def cleaned_quotes(raw: DataFrame, window_rows: int = ZSCORE_WINDOW, cutoff: float = ZSCORE_CUTOFF) -> DataFrame:
    """Cleaned quotes of the stored raw ones. Not stored."""
    return quotes.cleaned_quotes(raw, window_rows, cutoff)


def _universe(spark: SparkSession, securities: DataFrame | None) -> DataFrame:
    return universe.universe_table(spark) if securities is None else securities
