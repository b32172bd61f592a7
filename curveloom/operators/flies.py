"""Flies: every triple of tenors, a barbell of the outer two against the bullet in the middle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.config import RETURN_VARIABLES
from curveloom.functions.reshape import stacked
from curveloom.functions.series import cumulative_sum, series
from curveloom.operators.legs import leg, required, strategy_legs

POSITIONS = ("short", "bullet", "long")
WEIGHTS = ("short_weight", "long_weight", "bullet_weight")


def weighted_flies(
    returns: DataFrame, triples: DataFrame, variables: Sequence[str] = RETURN_VARIABLES, by: Sequence[str] = (),
) -> DataFrame:
    """Legs with weights from the previous complete row.

    Dates lacking a leg are dropped before the lag, the opposite order to the pairs.
    """
    legs = strategy_legs(returns, triples, "fly", POSITIONS, required(variables), by)
    short, bullet, long = durations = [leg(p, "duration") for p in POSITIONS]
    weights = [
        f"try_divide(0.5D * ({long} - {bullet}), {long} - {short}) AS short_weight",
        f"try_divide(0.5D * ({bullet} - {short}), {long} - {short}) AS long_weight",
        "0.5D AS bullet_weight",
    ]
    window = series([*by, "fly"])
    weighted = legs.dropna("any", subset=durations).selectExpr("*", *weights)
    return weighted.withColumns({w: F.lag(w).over(window) for w in WEIGHTS}).dropna("any", subset=list(WEIGHTS))


def fly_weights(returns: DataFrame, triples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return weighted_flies(returns, triples, ("duration",), by).select(*by, "date", *WEIGHTS, "fly")


def fly_panel(
    returns: DataFrame, triples: DataFrame, variables: Sequence[str] = RETURN_VARIABLES, by: Sequence[str] = (),
) -> DataFrame:
    """One row per fly, date and variable, where all three legs have the variable."""
    rows = stacked([{"variable": f"'{v}'", **{f"{p}_val": leg(p, v) for p in POSITIONS}} for v in variables])
    return (
        weighted_flies(returns, triples, variables, by)
        .select(*by, "date", rows, *WEIGHTS, "fly")
        .dropna("any", subset=[f"{p}_val" for p in POSITIONS])
    )


def weighted_positions(panel: DataFrame, variable: str, by: Sequence[str] = ()) -> DataFrame:
    """``weight * value`` of the three legs for one variable of the panel."""
    return panel.where(F.col("variable") == variable).selectExpr(
        *by, "date", "fly", *[f"{p}_weight * {p}_val AS {p}" for p in POSITIONS])


def duration_legs(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return weighted_positions(panel, "duration", by)


def barbell_and_bullet(positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return positions.selectExpr(*by, "date", "fly", "long + short AS Barbell", "bullet AS Bullet")


def duration_exposure(positions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return barbell_and_bullet(positions, by).selectExpr(*by, "date", "fly", "Barbell - Bullet AS duration_exposure")


def return_legs(panel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return barbell_and_bullet(weighted_positions(panel, "bnd_rtn", by), by)


def cumulative_legs(legs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``date, fly, leg, cum_rtn``: running return of the barbell and of the bullet."""
    window = series([*by, "fly"])
    names = ["Barbell", "Bullet"]
    summed = legs.withColumns({c: cumulative_sum(F.col(c), window) for c in names})
    return summed.unpivot([*by, "date", "fly"], names, "leg", "cum_rtn")


def cumulative_fly(legs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running return of the barbell over the bullet."""
    net = legs.withColumn("fly_rtn", F.col("Barbell") - F.col("Bullet"))
    return net.select(*by, "date", "fly", cumulative_sum(F.col("fly_rtn"), series([*by, "fly"])).alias("fly_rtn"))
