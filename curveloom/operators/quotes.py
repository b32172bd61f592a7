"""Quote histories: ingest to long form, imputation, rolling z-scores and outlier replacement.

From the side pivot to the final unpivot a row is one tenor and date with the four sides side by side, so
imputation, the "any bad side" test and the replacement mean are row-wise expressions, and the rolling
statistics of all sides share one shuffle per tenor.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.config import CARRY_DAYS, DAYS_PER_WEEK, IMPUTED_SIDES, QUOTE_SIDES, ZSCORE_CUTOFF, ZSCORE_WINDOW
from curveloom.functions.long_series import LongSeries, cut, rolling_zscores
from curveloom.functions.reshape import stacked, to_long, to_wide
from curveloom.functions.scalar import first_token, last_token, present_count, row_mean
from curveloom.functions.series import with_rolling_zscores
from curveloom.sources.store import kept

KEYS = ("date", "tenor_days", "tenor")


def quotes_long(wide: DataFrame) -> DataFrame:
    """``date, quote`` and a column per tenor -> ``date, quote, tenor, value``."""
    return to_long(wide, ["date", "quote"], variable="tenor")


def tenor_days(tenor: Column) -> Column:
    """Days of labels such as ``4-Week`` or ``10-Year``. Every unit but the week counts 360 days, months too."""
    unit = F.when(last_token(tenor, "-") == "Week", DAYS_PER_WEEK).otherwise(CARRY_DAYS)
    return first_token(tenor, "-").cast("int") * unit


def tenor_dimension(quotes: DataFrame) -> DataFrame:
    return quotes.select("tenor").distinct().withColumn("tenor_days", tenor_days(F.col("tenor")))


def with_tenor_days(quotes: DataFrame) -> DataFrame:
    """The tenor's days on every row. An expression on the row gives what joining the dimension would."""
    return quotes.withColumn("tenor_days", tenor_days(F.col("tenor")))


def sides_wide(quotes: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """One row per date and tenor with a column per side and the number of missing sides."""
    wide = with_tenor_days(to_wide(quotes, ["date", "tenor"], "quote", "value", sides))
    return wide.select(*KEYS, *sides, (F.lit(len(sides)) - present_count(sides)).alias("n_missing"))


def partial_rows(wide: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """Rows with at least one side, by a true count of the missing ones."""
    return wide.where(F.col("n_missing") < len(sides)).drop("n_missing")


def all_missing_rows(wide: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    return wide.where(F.col("n_missing") == len(sides)).drop("n_missing")


def imputed(partial: DataFrame, sides: Sequence[str] = QUOTE_SIDES, impute_sides: Sequence[str] = IMPUTED_SIDES) -> DataFrame:
    """Missing values of ``impute_sides`` replaced by the mean of the sides present that day."""
    filled = {s: F.coalesce(F.col(s), F.col("_mean")) for s in impute_sides}
    return partial.withColumn("_mean", row_mean(sides)).withColumns(filled).drop("_mean")


def imputed_long(filled: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    return filled.unpivot(list(KEYS), list(sides), "variable", "value")


def with_zscores(
    filled: DataFrame, window_rows: int = ZSCORE_WINDOW, sides: Sequence[str] = QUOTE_SIDES,
    history: LongSeries | None = None,
) -> DataFrame:
    """Adds a ``z_<side>`` column per side.

    One task sorts one tenor's rows, one per date. For finer clocks give the ``history`` to cut in slices.
    """
    if history is not None:
        return rolling_zscores(filled, history, {_z(s): s for s in sides}, window_rows)
    return with_rolling_zscores(filled, ["tenor"], {_z(s): s for s in sides}, window_rows)


def zscores_long(scored: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """Rows that have a z-score: ``date, tenor_days, tenor, variable, value, z_score``."""
    rows = stacked([{"variable": f"'{s}'", "value": s, "z_score": _z(s)} for s in sides])
    return scored.select(*KEYS, rows).where(F.col("z_score").isNotNull())


def bad_date_rows(scored: DataFrame, cutoff: float = ZSCORE_CUTOFF, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """Scored rows of every tenor and date on which some side is an outlier."""
    return zscores_long(scored.where(_any_bad(cutoff, sides)), sides)


def good_date_rows(scored: DataFrame, cutoff: float = ZSCORE_CUTOFF, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    return zscores_long(scored.where(~_any_bad(cutoff, sides)), sides)


def replaced(scored: DataFrame, cutoff: float = ZSCORE_CUTOFF, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """``date, tenor_days, tenor, variable, value, replace_value``.

    An outlier takes the mean of that day's sides below the cutoff, or keeps its value if there is none. A
    tenor with any outlier keeps only the rows that have a z-score; one without keeps all rows. A z-score
    equal to the cutoff is neither replaced nor part of the mean.

    The tenors with outliers are aggregated map-side and joined back, so no task holds a tenor for them. ``scored``
    is read twice, so hand in a ``kept`` one.
    """
    any_bad = F.max(_any_bad(cutoff, sides))
    bad = scored.groupBy(F.col("tenor").alias("_of")).agg(any_bad.alias("_tenor_has_bad"))
    flagged = scored.join(bad, F.col("tenor").eqNullSafe(F.col("_of"))).drop("_of")
    flagged = flagged.withColumn("_good_mean", _good_mean(cutoff, sides))
    rows = stacked([
        {
            "variable": f"'{s}'",
            "value": s,
            "replace_value": f"if({_z(s)} > {float(cutoff)}D, coalesce(_good_mean, {s}), {s})",
            "_scored": f"{_z(s)} IS NOT NULL",
        }
        for s in sides
    ])
    kept = F.col("_scored") | ~F.col("_tenor_has_bad")
    return flagged.select(*KEYS, "_tenor_has_bad", rows).where(kept).drop("_scored", "_tenor_has_bad")


def cleaned_quotes(
    quotes: DataFrame, window_rows: int = ZSCORE_WINDOW, cutoff: float = ZSCORE_CUTOFF,
    sides: Sequence[str] = QUOTE_SIDES, impute_sides: Sequence[str] = IMPUTED_SIDES,
) -> DataFrame:
    """Long quotes -> cleaned quotes, end to end."""
    filled = imputed(partial_rows(sides_wide(quotes, sides), sides), sides, impute_sides)
    return replaced(kept(with_zscores(filled, window_rows, sides), "scored"), cutoff, sides)


def cleaned_long_history(
    quotes: DataFrame, window_rows: int = ZSCORE_WINDOW, cutoff: float = ZSCORE_CUTOFF,
    sides: Sequence[str] = QUOTE_SIDES, impute_sides: Sequence[str] = IMPUTED_SIDES,
    slices: int | None = None,
) -> DataFrame:
    """As ``cleaned_quotes``, for tenors with histories too long for one task.

    The imputed and the scored rows are each read more than once, so both are kept in the shared folder.
    """
    filled = kept(imputed(partial_rows(sides_wide(quotes, sides), sides), sides, impute_sides), "imputed")
    history = cut(filled, ["tenor"], "date", slices)
    scored = kept(with_zscores(filled, window_rows, sides, history), "scored")
    return replaced(scored, cutoff, sides)


def cleaned_wide(cleaned: DataFrame, sides: Sequence[str] = QUOTE_SIDES) -> DataFrame:
    """Replacement values per tenor and date, one column per side."""
    return to_wide(cleaned, ["tenor", "date"], "variable", "replace_value", sides)


def _z(side: str) -> str:
    return f"z_{side}"


def _any_bad(cutoff: float, sides: Sequence[str]) -> Column:
    return F.coalesce(F.greatest(*[F.col(_z(s)) for s in sides]) > cutoff, F.lit(False))


def _good_mean(cutoff: float, sides: Sequence[str]) -> Column:
    """Mean of the sides below the cutoff; NULL if there is none."""
    total = " + ".join(f"if({_z(s)} < {float(cutoff)}D, {s}, 0D)" for s in sides)
    count = " + ".join(f"if({_z(s)} < {float(cutoff)}D, 1, 0)" for s in sides)
    return F.expr(f"try_divide({total}, {count})")
