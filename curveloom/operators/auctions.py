"""Auction tables and observed securities: typing, long form, reconciliation of overlapping copies."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.config import VINTAGES
from curveloom.functions.reshape import cell, stacked, to_long

DATE_COLUMNS = ("auction_date", "issue_date", "record_date")
HISTORY_IDS = ("record_date", "security_term")
OBSERVED_IDS = ("Action", "Description", "group", "last_updated")


def typed_auctions(table: DataFrame, index_columns: Sequence[str] = ()) -> DataFrame:
    """The table without its saved row numbers, its date columns as dates."""
    kept = table.drop(*index_columns)
    return kept.withColumns({c: F.to_date(c) for c in kept.columns if c in DATE_COLUMNS})


def auction_long(history: DataFrame, auction_columns: Sequence[str], index_columns: Sequence[str] = ()) -> DataFrame:
    """One row per auction and measure, complete rows only.

    ``auction_columns`` are those of the typed auction table; with the record date and the security term they
    identify a row. Measures of any type become strings, the one type they share.
    """
    ids = [*auction_columns, *HISTORY_IDS]
    return to_long(typed_auctions(history, index_columns), ids, as_text=True).dropna("any")


def reconcile_auctions(
    left: DataFrame, right: DataFrame, with_conflict: bool = False, with_repeats: bool = False,
) -> DataFrame:
    """Two long histories by auction and measure: the left value, else the right one.

    Both sides go through one aggregation by every column but ``value``; those are complete. Values that disagree also
    resolve to the left; ``with_conflict`` adds a column that marks them. A key is one row, however often a side has it: the
    first of a side's values is the smallest, and ``with_repeats`` adds a column that marks such keys.
    """
    keys = [c for c in left.columns if c != "value"]
    both = _tagged(left, right, keys, ["value"]).groupBy(*keys).agg(*_sides("value"))
    value = F.coalesce("_left", "_right").alias("value")
    conflict = F.coalesce(F.col("_left") != F.col("_right"), F.lit(False)).alias("conflict")
    return both.select(*keys, value, *([conflict] if with_conflict else []),
                       *([(F.col("_most") > 1).alias("repeated")] if with_repeats else []))


def reconcile_histories(left: DataFrame, right: DataFrame, auction_columns: Sequence[str], with_repeats: bool = False) -> DataFrame:
    """As ``reconcile_auctions(..., with_conflict=True)`` on the long forms, but aggregated before the unpivot.

    For typed wide histories: one row per auction and side enters the shuffle instead of one per measure.
    """
    ids = [*auction_columns, *HISTORY_IDS]
    texts = [df.dropna("any", subset=ids).select(*ids, *[F.col(c).cast("string").alias(c) for c in df.columns if c not in ids])
             for df in (left, right)]
    measures = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in ids]
    sides = [_sides(m, f"{k}_") for k, m in enumerate(measures)]
    both = _tagged(*texts, ids, measures).groupBy(*ids).agg(*[c for side in sides for c in side])
    repeats = {"repeated": "`{k}__most` > 1"} if with_repeats else {}
    long = stacked([{
        "variable": f"'{m}'", "value": f"coalesce(`{k}__left`, `{k}__right`)",
        "conflict": f"coalesce(`{k}__left` != `{k}__right`, false)", **{n: sql.format(k=k) for n, sql in repeats.items()},
    } for k, m in enumerate(measures)])
    return both.select(*ids, long).where("value IS NOT NULL")


def _tagged(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Both sides' rows, told apart by ``_is_left``; a column that a side lacks is missing there."""
    tagged = [df.withColumn("_is_left", F.lit(is_left)) for df, is_left in ((left, True), (right, False))]
    return tagged[0].unionByName(tagged[1], allowMissingColumns=True).select(*keys, *values, "_is_left")


def _sides(value: str, prefix: str = "") -> list[Column]:
    """The first value of each side, and how many values the side has that has more."""
    left, right = [f"FILTER (WHERE {side})" for side in ("_is_left", "NOT _is_left")]
    return [
        F.expr(f"min(`{value}`) {left} AS `{prefix}_left`"), F.expr(f"min(`{value}`) {right} AS `{prefix}_right`"),
        F.expr(f"greatest(count(`{value}`) {left}, count(`{value}`) {right}) AS `{prefix}_most`"),
    ]


def observed_union(vintages: Mapping[str, DataFrame]) -> DataFrame:
    """All vintages by column name, tagged with their group; a column one lacks is NULL there."""
    tagged = [df.withColumn("group", F.lit(name)) for name, df in vintages.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def observed_long(union: DataFrame, as_text: bool = False) -> DataFrame:
    return to_long(union, OBSERVED_IDS, as_text=as_text).dropna("any")


def observed_dedup(long: DataFrame) -> DataFrame:
    return long.dropDuplicates()


def observed_first(long: DataFrame) -> DataFrame:
    """One value per key and vintage. "First" is defined as the smallest, which combines map-side."""
    return long.groupBy(*OBSERVED_IDS, "variable").agg(F.min("value").alias("value"))


def reconcile_observed(union: DataFrame, vintages: Sequence[str] = VINTAGES, as_text: bool = False) -> DataFrame:
    """Per security and measure, the value of the first vintage that has one.

    De-duplication, first-per-vintage and the column per vintage are one map-side-combined aggregation of the
    wide rows: the smallest value is the same with or without duplicates, and missing ones never count. Only
    its result is unpivoted.
    """
    keys = [c for c in OBSERVED_IDS if c != "group"]
    measures = [c for c in union.columns if c not in OBSERVED_IDS]
    firsts = [cell("min", "group", v, c, f"{c}__{v}") for c in measures for v in vintages]
    known = union.dropna("any", subset=list(OBSERVED_IDS))
    # A vintage that has no rank among the others is an error, not a row to leave out.
    ranked = F.assert_true(F.col("group").isin(list(vintages)), F.concat(F.lit("unknown vintage "), "group")).isNull()
    known = known.where(ranked)
    best = [F.coalesce(*[f"{c}__{v}" for v in vintages]).alias(c) for c in measures]
    wide = known.groupBy(*keys).agg(*firsts).select(*keys, *best)
    return to_long(wide, keys, value="new_val", as_text=as_text).where("new_val IS NOT NULL")
