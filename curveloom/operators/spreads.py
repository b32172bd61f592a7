"""Steepeners: every pair of tenors, weighted by inverse duration."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.config import RETURN_VARIABLES
from curveloom.functions.reshape import stacked
from curveloom.functions.scalar import capitalized_token, ratio
from curveloom.functions.series import cumulative_sum, series
from curveloom.operators.legs import leg, required, strategy_legs

POSITIONS = ("long", "short")


def weighted_pairs(
    returns: DataFrame, pairs: DataFrame, variables: Sequence[str] = RETURN_VARIABLES, by: Sequence[str] = (),
) -> DataFrame:
    """Legs with ``long_weight`` and ``short_weight`` from the previous row's durations.

    The lag runs over the union of both legs' dates, before rows without weights are dropped.
    """
    legs = strategy_legs(returns, pairs, "steepener", POSITIONS, required(variables), by)
    window = series([*by, "steepener"])
    inverse = {p: ratio(F.lit(1.0), F.col(leg(p, "duration"))) for p in POSITIONS}
    lagged = legs.withColumns({f"_{p}": F.lag(inverse[p]).over(window) for p in POSITIONS})
    total = F.col("_long") + F.col("_short")
    return (
        lagged.dropna("any", subset=["_long", "_short"])
        .withColumns({f"{p}_weight": ratio(F.col(f"_{p}"), total) for p in POSITIONS})
        .drop("_long", "_short")
    )


def pair_weights(returns: DataFrame, pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``date, steepener, yield_tenor, weight``: both legs on every date of the pair."""
    weighted = weighted_pairs(returns, pairs, ("duration",), by)
    legs = stacked([{"yield_tenor": p, "weight": f"{p}_weight"} for p in POSITIONS])
    return weighted.join(pairs, "steepener").select(*by, "date", "steepener", legs)


def steepener_panel(
    returns: DataFrame, pairs: DataFrame, variables: Sequence[str] = RETURN_VARIABLES, by: Sequence[str] = (),
) -> DataFrame:
    """One row per steepener, date and variable. A leg absent on the date has no weight and no values."""
    weighted = weighted_pairs(returns, pairs, variables, by)
    weights = [F.expr(f"if({leg(p, 'duration')} IS NULL, NULL, {p}_weight) AS {p}_weight") for p in POSITIONS]
    values = stacked([{"var": f"'{v}'", **{f"{p}_val": leg(p, v) for p in POSITIONS}} for v in variables])
    return weighted.select(*by, "date", *weights, values, "steepener")


def weighted_legs(panel: DataFrame, variable: str, long_name: str, short_name: str, by: Sequence[str] = ()) -> DataFrame:
    """``weight * value`` of both legs for one variable of the panel."""
    return panel.where(F.col("var") == variable).selectExpr(
        *by, "date", "steepener", f"long_weight * long_val AS {long_name}", f"short_weight * short_val AS {short_name}")


def duration_legs(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return weighted_legs(panel, "duration", "weighted_long", "weighted_short", by)


def duration_exposure(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return duration_legs(panel, by).selectExpr(
        *by, "date", "steepener", "weighted_long - weighted_short AS duration_exposure")


def return_legs(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return weighted_legs(panel, "bnd_rtn", "long_rtn", "short_rtn", by)


def cumulative_legs(legs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``date, steepener, leg, cum_rtn``: running return of the long and the short leg."""
    window = series([*by, "steepener"])
    names = ["long_rtn", "short_rtn"]
    summed = legs.withColumns({c: cumulative_sum(F.col(c), window) for c in names})
    long = summed.unpivot([*by, "date", "steepener"], names, "leg", "cum_rtn")
    return long.withColumn("leg", capitalized_token(F.col("leg")))


def cumulative_spread(legs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running net return of the steepener."""
    net = legs.withColumn("spread_rtn", F.col("long_rtn") - F.col("short_rtn"))
    window = series([*by, "steepener"])
    return net.select(*by, "date", "steepener", cumulative_sum(F.col("spread_rtn"), window).alias("spread_rtn"))
