"""Synthetic bond returns: deliverable risk joined to the yield curve.

Every function takes ``by``, extra key columns (such as a curve or book id) that separate otherwise equal
panels. They lead each grouping, join and window key, so more curves mean more parallel groups.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.config import CARRY_DAYS, RISK_VARIABLES, TENOR_PREFIX
from curveloom.functions.reshape import to_long, to_wide
from curveloom.functions.scalar import first_token, last_token
from curveloom.functions.series import difference, series


def deliverable_panel(risk: DataFrame, variables: Mapping[str, str] = RISK_VARIABLES, by: Sequence[str] = ()) -> DataFrame:
    """Long risk -> one row per date and security, complete rows only."""
    named = risk.withColumn("security", first_token(F.col("security")))
    return to_wide(named, [*by, "date", "security"], "variable", "value", variables).dropna("any")


def with_maturity(panel: DataFrame, universe: DataFrame) -> DataFrame:
    return panel.join(universe.select("security", "maturity"), "security")


def date_range(panel: DataFrame) -> DataFrame:
    return panel.agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))


def within_range(df: DataFrame, span: DataFrame, year: str = "year") -> DataFrame:
    """Rows dated within a one-row ``start_date, end_date`` table, as a filter on two scalar subqueries.

    A table that is partitioned by a ``year`` column is filtered by the span's years too, so the scan opens only those folders.
    """
    start, end = (span.select(c).scalar() for c in ("start_date", "end_date"))
    if year in df.columns:
        df = df.where(F.col(year).between(*[span.select(F.year(c)).scalar() for c in ("start_date", "end_date")]))
    return df.where(F.col("date").between(start, end))


def yields_long(wide: DataFrame, tenors: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Wide curve -> ``date, yield_tenor, yield, maturity``; holidays keep their NULL."""
    long = to_long(wide, [*by, "date"], tenors, "yield_tenor", "yield")
    return long.withColumn("maturity", last_token(F.col("yield_tenor"), TENOR_PREFIX[-1]).cast("int"))


def curve_join(panel: DataFrame, yields: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return panel.join(yields, [*by, "date", "maturity"])


def yield_differences(curve: DataFrame, by: Sequence[str] = (), earlier: DataFrame | None = None) -> DataFrame:
    """Yield as a fraction and its change per security; rows without a change are dropped afterwards.

    ``earlier`` are the ``last_yields`` of dates before those of the curve: the first change of a series starts from them.
    """
    window = series([*by, "security"])
    fraction = curve.withColumn("yld", F.col("yield") / 100).drop("yield")
    if earlier is None:
        return fraction.withColumn("yld_diff", difference(F.col("yld"), window)).dropna("any")
    both = fraction.withColumn("_new", F.lit(True)).unionByName(earlier.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    changed = both.withColumn("yld_diff", difference(F.col("yld"), window)).where("_new").drop("_new")
    return changed.select(*fraction.columns, "yld_diff").dropna("any")


def last_yields(curve: DataFrame, by: Sequence[str] = (), earlier: DataFrame | None = None) -> DataFrame:
    """``by, security, date, yld`` of each series' last row, be its yield missing; series without new rows keep their earlier one."""
    rows = curve.select(*by, "security", "date", (F.col("yield") / 100).alias("yld"))
    rows = rows if earlier is None else rows.unionByName(earlier)
    last = rows.groupBy(*by, "security").agg(F.max(F.struct("date", "yld")).alias("_last"))
    return last.select(*by, "security", "_last.*")


def return_terms(differences: DataFrame) -> DataFrame:
    """Duration, convexity and total return; one day of carry per row."""
    return differences.drop("security", "maturity").selectExpr(
        "*",
        "-yld_diff * duration AS dur_rtn",
        "0.5D * (yld_diff * yld_diff) * convexity AS cvx_rtn",
        f"yld / {CARRY_DAYS} + dur_rtn + cvx_rtn AS bnd_rtn",
    )


def synthetic_returns(
    risk: DataFrame, yields: DataFrame, universe: DataFrame, variables: Mapping[str, str] = RISK_VARIABLES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Risk table and wide yields -> daily carry, duration and convexity returns per tenor.

    The inner join on the date already limits the curve to the panel's span.
    """
    panel = with_maturity(deliverable_panel(risk, variables, by), universe)
    return return_terms(yield_differences(curve_join(panel, yields_long(yields, by=by), by), by))
