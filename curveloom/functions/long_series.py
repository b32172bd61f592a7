"""Ordered-series operations for series too long to sort in one task.

A tick history may hold a third of a table under one key. Here every series is cut into slices along its
order, and no task ever sorts more than one slice (or one block) of one series:

* running sums, compounding, differences and padded changes sort each slice alone and add what the earlier
  slices carry in, a value per slice from a map-side-combined aggregation: one shuffle of the rows;
* rolling statistics need the exact preceding rows, so rows get their position in the series (slice offset
  plus rank in the slice), are cut into blocks of equal length, and the last rows of a block are copied to the
  next: two shuffles of the rows, and copies bounded by frame length / block length.

The results equal those of the plain windows in ``series``, up to the last bits of floating sums. The input is
read several times (cuts, slice totals, rows), so hand in a stored table or a ``kept`` one.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curveloom.functions.scalar import ratio
from curveloom.functions.series import cumulative_growth, cumulative_sum, zscores_by_runs
from curveloom.sources.store import kept

SERIES, SLICE, INDEX, BLOCK = "_series", "_slice", "_index", "_block"


ROWS_PER_SLICE = 1_000_000  # what one task sorts
SAMPLED_ROWS_PER_SLICE = 50
# Cuts that the driver and every task hold, however long the table is; the cuts between them are a table.
COARSE_CUTS = 1000


@dataclass(frozen=True)
class LongSeries:
    """How a table's series are cut; made by ``cut``.

    ``keys`` name a series, missing ones one of their own; ``order`` is one column, complete and unique within a series.
    A series goes by the struct of its keys, which is never missing, so joins and windows treat it alike.
    ``cuts`` part the order column into buckets; ``fine`` has a row for each bucket with the ``_cuts`` that part it further,
    up to ``fine_cuts`` of them.
    """

    keys: Sequence[str]
    order: str
    cuts: Sequence[float]
    rows_per_slice: int
    fine: DataFrame | None = None
    fine_cuts: int = 0

    def across_slices(self) -> WindowSpec:
        """The slices of a series: as many rows as it has slices."""
        return Window.partitionBy(SERIES).orderBy(SLICE)

    def within_slice(self) -> WindowSpec:
        return Window.partitionBy(SERIES, SLICE).orderBy(self.order)


def cut(
    df: DataFrame, keys: Sequence[str], order: str, slices: int | None = None, rows_per_slice: int = ROWS_PER_SLICE,
    coarse: int = COARSE_CUTS,
) -> LongSeries:
    """Chooses the cuts: quantiles of the order column over the whole table, so that slices hold equal counts.

    No key can bring more rows to a slice than the slice holds, and neither bursts nor stray far-off values of
    the order column unbalance the slices. This runs a count and a scan of that one column. The quantiles come
    from a sample of it, as those of range partitioning do; they decide where a task's work ends, never a result.

    Up to ``coarse`` cuts come to the driver and into the plan. A longer table has cuts between those, made by one
    aggregation over their buckets and kept as a table.
    """
    rows = df.count()
    slices = slices or max(1, ceil(rows / rows_per_slice))
    buckets = min(slices, coarse + 1)
    at = df.select(_position(df, order).alias("at"))
    cuts = _sampled(at, rows, buckets).approxQuantile("at", [i / buckets for i in range(1, buckets)], 0.25 / buckets) if buckets > 1 else []
    spec = LongSeries(keys, order, sorted(set(cuts)), ceil(rows / slices))
    per_bucket = ceil(slices / buckets)
    if per_bucket == 1:
        return spec
    sampled = _with_buckets(_sampled(at, rows, slices).withColumn("_at", F.col("at")), spec)
    quantiles = F.percentile_approx("at", [i / per_bucket for i in range(1, per_bucket)], 40 * per_bucket)
    fine = sampled.groupBy(SLICE).agg(F.array_sort(F.array_distinct(quantiles)).alias("_cuts"))
    return replace(spec, fine=kept(fine, "cuts"), fine_cuts=per_bucket - 1)


def _sampled(at: DataFrame, rows: int, slices: int) -> DataFrame:
    return at.sample(min(1.0, SAMPLED_ROWS_PER_SLICE * slices / max(rows, 1)), seed=0)


def with_slices(df: DataFrame, spec: LongSeries) -> DataFrame:
    """Adds the series and the slice number, found by binary search in the coarse and then in the fine cuts."""
    sliced = _with_buckets(df.withColumn(SERIES, F.struct(*spec.keys)).withColumn("_at", _position(df, spec.order)), spec)
    if spec.fine is None:
        return sliced.drop("_at")
    # A row for each bucket; Spark chooses the join by its measured size. A bucket without a sampled row has no cuts.
    joined = sliced.join(spec.fine, SLICE, "left")
    cuts = F.coalesce(F.col("_cuts"), F.array().cast("array<double>"))
    place = F.col(SLICE) * (spec.fine_cuts + 1) + _cuts_below(cuts, F.col("_at"), spec.fine_cuts)
    return joined.withColumn(SLICE, place.cast("int")).drop("_at", "_cuts")


def _with_buckets(df: DataFrame, spec: LongSeries) -> DataFrame:
    """Adds the number of the coarse bucket that holds ``_at``, as the slice."""
    if not spec.cuts:
        return df.withColumn(SLICE, F.lit(0))
    cutter = Bucketizer(splits=[-float("inf"), *spec.cuts, float("inf")], inputCol="_at", outputCol=SLICE)
    return cutter.transform(df).withColumn(SLICE, F.col(SLICE).cast("int"))


def _cuts_below(cuts: Column, at: Column, most: int) -> Column:
    """How many of the sorted cuts are not above ``at``: a binary search, by halving steps that a fold takes."""
    steps = [F.lit(1 << k) for k in reversed(range(most.bit_length()))]
    return F.aggregate(F.array(*steps), F.lit(0), lambda found, step: F.when(
        F.coalesce(F.get(cuts, found + step - 1) <= at, F.lit(False)), found + step).otherwise(found))


def difference(df: DataFrame, spec: LongSeries, value: str, out: str) -> DataFrame:
    """Change from the previous row; a missing value leaves its own and the next row without one."""
    sliced = with_slices(df, spec)
    last = F.max_by(value, spec.order)
    carried = _carried(sliced, spec, {"_last": last}, {"_last": F.lag("_last").over(spec.across_slices())})
    within = spec.within_slice()
    previous = F.when(F.row_number().over(within) == 1, F.col("_last")).otherwise(F.lag(value).over(within))
    return carried.withColumn(out, F.col(value) - previous).drop(SERIES, SLICE, "_last")


def pct_change(df: DataFrame, spec: LongSeries, value: str, out: str) -> DataFrame:
    """Relative change from the previous row, gaps first padded with the last known value."""
    sliced = with_slices(df, spec)
    known = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(spec.order)))
    earlier = F.last("_known", ignorenulls=True).over(_before(spec.across_slices()))
    carried = _carried(sliced, spec, {"_known": known}, {"_known": earlier})
    previous = F.coalesce(F.last(value, ignorenulls=True).over(_before(spec.within_slice())), "_known")
    moved = carried.withColumn("_previous", previous)
    change = ratio(F.coalesce(value, "_previous"), F.col("_previous")) - 1
    return moved.withColumn(out, change).drop(SERIES, SLICE, "_known", "_previous")


def cumulative(
    df: DataFrame, spec: LongSeries, sums: Mapping[str, str] = {}, growths: Mapping[str, str] = {},
) -> DataFrame:
    """Running sums and compounded rates (``output name -> column``); missing values are skipped and stay missing."""
    sliced = with_slices(df, spec)
    across, within = _before(spec.across_slices()), spec.within_slice()
    totals = {f"_{out}": F.sum(c) for out, c in sums.items()}
    totals |= {f"_{out}": F.product(1 + F.col(c)) for out, c in growths.items()}
    before = {f"_{out}": F.coalesce(F.sum(f"_{out}").over(across), F.lit(0.0)) for out in sums}
    before |= {f"_{out}": F.coalesce(F.product(f"_{out}").over(across), F.lit(1.0)) for out in growths}
    carried = _carried(sliced, spec, totals, before)
    results = {out: F.col(f"_{out}") + cumulative_sum(F.col(c), within) for out, c in sums.items()}
    results |= {out: F.col(f"_{out}") * (cumulative_growth(F.col(c), within) + 1) - 1 for out, c in growths.items()}
    return carried.withColumns(results).drop(SERIES, SLICE, *totals)


def with_index(df: DataFrame, spec: LongSeries) -> DataFrame:
    """Adds each row's 0-based position in its series."""
    offset = {"_offset": F.coalesce(F.sum("_offset").over(_before(spec.across_slices())), F.lit(0))}
    carried = _carried(with_slices(df, spec), spec, {"_offset": F.count(F.lit(1))}, offset)
    position = F.col("_offset") + F.row_number().over(spec.within_slice()) - 1
    return carried.withColumn(INDEX, position).drop(SERIES, SLICE, "_offset")


def rolling_zscores(df: DataFrame, spec: LongSeries, scores: Mapping[str, str], rows: int) -> DataFrame:
    """|z| of each value against its trailing ``rows`` rows, itself included (``output name -> column``).

    NULL unless all of those rows hold a value, and NULL where they are all equal.
    """
    block_rows = rows * ceil(max(spec.rows_per_slice, 1) / rows)
    indexed = with_index(df, spec).withColumn(SERIES, F.struct(*spec.keys))
    blocks = _with_blocks(indexed, block_rows, rows).repartition(SERIES, BLOCK)
    scored = zscores_by_runs(blocks, [SERIES, BLOCK], INDEX, scores, rows)
    return scored.where(F.col(BLOCK) == F.floor(F.col(INDEX) / block_rows)).select(
        *[c for c in df.columns if c not in scores], *scores)


def _with_blocks(indexed: DataFrame, block_rows: int, halo: int) -> DataFrame:
    """Adds the block number; each block's last ``halo`` rows also appear in the next block."""
    own = F.floor(F.col(INDEX) / block_rows)
    both = F.when(F.col(INDEX) % block_rows >= block_rows - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return indexed.select("*", F.explode(both).alias(BLOCK))


def _carried(sliced: DataFrame, spec: LongSeries, totals: Mapping[str, Column], before: Mapping[str, Column]) -> DataFrame:
    """Joins to every row what the earlier slices of its series amount to.

    ``totals`` aggregate a slice; ``before`` are windows over the slices that use the totals by name. How to join is
    Spark's choice by the measured size of the side with a row per series and slice.
    """
    keys = [SERIES, SLICE]
    per_slice = sliced.groupBy(*keys).agg(*[c.alias(name) for name, c in totals.items()])
    carry = per_slice.select(*keys, *[c.alias(name) for name, c in before.items()])
    return sliced.join(carry, keys)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _position(df: DataFrame, order: str) -> Column:
    """A double that never falls where the order column rises, whatever the session's time zone."""
    kind, column = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.TimestampNTZType):
        minute = (F.unix_date(column.cast("date")).cast("long") * 24 + F.hour(column)) * 60 + F.minute(column)
        return minute.cast("double") * 60 + F.extract(F.lit("SECOND"), column).cast("double")
    if isinstance(kind, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, T.DateType):
        column = F.unix_date(column)
    return column.cast("double")
