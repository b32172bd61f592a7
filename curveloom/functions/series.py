"""Ordered-series expressions over a window of one series.

They sort one series in one task, which is right where a series has at most one row per calendar date (or
another bounded clock): a century of dates is under 40,000 rows however large the table is, and a larger
table means more series. For series of unbounded length see ``long_series``.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from curveloom.functions.scalar import ratio


SHORT_FRAME = 64


def series(keys: Sequence[str], order: Sequence[str] = ("date",)) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def running(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def difference(value: Column, window: WindowSpec) -> Column:
    """Change from the previous row. A missing value leaves both its own row and the next without one."""
    return value - F.lag(value).over(window)


def cumulative_sum(value: Column, window: WindowSpec) -> Column:
    """Running sum that skips missing values and leaves their rows missing."""
    return F.when(value.isNotNull(), F.sum(value).over(running(window)))


def cumulative_growth(rate: Column, window: WindowSpec) -> Column:
    """Compounded return of the rates so far; missing rates are skipped and stay missing."""
    return F.when(rate.isNotNull(), F.product(1 + rate).over(running(window)) - 1)


def with_pct_change(df: DataFrame, value: str, out: str, window: WindowSpec) -> DataFrame:
    """Relative change from the previous row, gaps first padded with the last known value."""
    padded = F.last(value, ignorenulls=True).over(running(window))
    change = ratio(F.col("_padded"), F.lag("_padded").over(window)) - 1
    return df.withColumn("_padded", padded).withColumn(out, change).drop("_padded")


def rolling_zscore(value: Column, window: WindowSpec, rows: int) -> Column:
    """|z| of the value against the trailing ``rows`` rows, itself included.

    NULL unless all of those rows hold a value, and NULL where they are all equal.
    """
    frame = window.rowsBetween(-(rows - 1), Window.currentRow)
    z = F.abs(ratio(value - F.avg(value).over(frame), F.stddev_samp(value).over(frame)))
    return F.when(F.count(value).over(frame) == rows, z)


def with_rolling_zscores(
    df: DataFrame, keys: Sequence[str], scores: Mapping[str, str], rows: int, order: Sequence[str] = ("date",),
) -> DataFrame:
    """Adds ``rolling_zscore`` of several values (``output name -> column``), in time that doesn't grow with ``rows``.

    Frames of few rows are read as they are, which takes less than merging the parts of two runs.
    """
    if rows <= SHORT_FRAME:
        window = series(keys, order)
        return df.select(*[c for c in df.columns if c not in scores],
                         *[rolling_zscore(F.col(value), window, rows).alias(out) for out, value in scores.items()])
    numbered = df.withColumn("_row", F.row_number().over(series(keys, order)) - 1)
    return zscores_by_runs(numbered, keys, "_row", scores, rows).select(*[c for c in df.columns if c not in scores], *scores)


def zscores_by_runs(df: DataFrame, keys: Sequence[str], index: str, scores: Mapping[str, str], rows: int) -> DataFrame:
    """``rolling_zscore`` of the rows that ``index`` numbers without gaps within ``keys``.

    The frame of a row is the end of one run of ``rows`` rows and the start of the next. Its statistics are
    those of the two parts merged, each a running aggregate, so the work per row does not grow with ``rows``.
    """
    runs = Window.partitionBy(*keys, "_run")
    # All three windows use one shuffle on the keys, the last two also the same sort.
    ended = running(runs.orderBy(F.desc(index)))
    started = running(runs.orderBy(index))
    whole = series(keys, ["_run", index])
    parts = (
        df.withColumn("_run", F.floor(F.col(index) / rows))
        .withColumns({f"_end_{out}": _moments(value, ended) for out, value in scores.items()})
        .withColumns({f"_start_{out}": _moments(value, started) for out, value in scores.items()})
        .withColumns({f"_end_{out}": F.lag(f"_end_{out}", rows - 1).over(whole) for out in scores})
    )
    whole_run = (F.col(index) + 1) % rows == 0
    frames = parts.withColumns({
        f"_all_{out}": F.when(whole_run, F.col(f"_start_{out}")).otherwise(
            _merged(F.col(f"_end_{out}"), F.col(f"_start_{out}")))
        for out in scores
    })
    results = [_zscore(F.col(value), F.col(f"_all_{out}"), rows).alias(out) for out, value in scores.items()]
    return frames.select(*[c for c in df.columns if c not in scores], *results)


def _moments(value: str, frame: WindowSpec) -> Column:
    n = F.count(value).over(frame)
    return F.struct(
        n.alias("n"), F.avg(value).over(frame).alias("mean"), (F.var_pop(value).over(frame) * n).alias("m2"),
        F.min(value).over(frame).alias("low"), F.max(value).over(frame).alias("high"))


def _zscore(value: Column, frame: Column, rows: int) -> Column:
    z = F.abs(ratio(value - frame["mean"], F.sqrt(frame["m2"] / (rows - 1))))
    # Means of two parts of one repeated value may differ in their last bits, so equality is that of the extremes.
    return F.when((frame["n"] == rows) & (frame["low"] < frame["high"]), z)


def _merged(a: Column, b: Column) -> Column:
    """Count, mean and squared deviations of two parts together. ``n`` tells if values are missing from either."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    mean = a["mean"] + delta * ratio(b["n"], n)
    m2 = a["m2"] + b["m2"] + delta * delta * ratio(a["n"] * b["n"], n)
    low, high = F.least(a["low"], b["low"]), F.greatest(a["high"], b["high"])
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"), low.alias("low"), high.alias("high"))
