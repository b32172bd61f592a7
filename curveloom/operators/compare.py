"""Cash returns against futures and ETFs."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.functions.reshape import to_long
from curveloom.functions.scalar import first_token
from curveloom.functions.series import cumulative_growth, cumulative_sum, series, with_pct_change


def futures_cash_panel(prices: DataFrame, returns: DataFrame, universe: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Front-contract prices (``date, security, PX_LAST``) joined to the synthetic returns of their tenor."""
    named = prices.withColumn("security", first_token(F.col("security")))
    return named.join(universe.select("security", "yield_tenor"), "security").join(returns, [*by, "date", "yield_tenor"])


def futures_vs_cash(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compounded futures return and summed cash return per tenor, over the joined dates."""
    window = series([*by, "yield_tenor"])
    moved = with_pct_change(panel.select(*by, "date", "yield_tenor", "PX_LAST", "bnd_rtn"), "PX_LAST", "_change", window)
    return moved.select(
        *by, "date", "yield_tenor",
        cumulative_growth(F.col("_change"), window).alias("fut_rtn"),
        cumulative_sum(F.col("bnd_rtn"), window).alias("ctd_rtn"),
    )


def etf_daily_returns(prices: DataFrame, etfs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide prices -> ``date, ticker, etf_rtn, yield_tenor``, changes taken over the full price calendar."""
    long = to_long(prices, [*by, "date"], variable="ticker", value="_price")
    moved = with_pct_change(long, "_price", "etf_rtn", series([*by, "ticker"])).drop("_price")
    return moved.join(etfs, "ticker").dropna("any")


def etf_panel(etf_returns: DataFrame, futures_cash: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return etf_returns.join(futures_cash, [*by, "date", "yield_tenor"])


def etf_vs_futures_vs_cash(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative ETF, futures and cash returns per ticker; the other columns are kept."""
    window = series([*by, "ticker"], ("date", "yield_tenor"))
    return with_pct_change(panel, "PX_LAST", "fut_rtn", window).withColumns({
        "etf_rtn": cumulative_growth(F.col("etf_rtn"), window),
        "fut_rtn": cumulative_growth(F.col("fut_rtn"), window),
        "bnd_rtn": cumulative_sum(F.col("bnd_rtn"), window),
    })


def comparison_long(compared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``date, ticker, yield_tenor, series, value`` with the series named ETF, FUT and BND."""
    long = compared.unpivot([*by, "date", "ticker", "yield_tenor"], ["etf_rtn", "fut_rtn", "bnd_rtn"], "series", "value")
    return long.withColumn("series", F.upper(first_token(F.col("series"), "_")))
