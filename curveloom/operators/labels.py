"""Labels of the strategies that a table of returns gives rows to, without building the strategies."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.config import TENOR_PREFIX
from curveloom.operators.universe import choices

# One entry for each leg of a strategy whose legs are all there on a date, and one without a label for each tenor.
_ENTRY = "struct<kind:string,label:string,tenor:string,weighted:boolean>"


def strategy_labels(returns: DataFrame, universe: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``label`` of every steepener and fly whose panel has rows, sorted.

    A date is one row with an array of its tenors, so the returns are read once; from there a strategy's legs are the choices
    from that array. A steepener has rows if its legs were together, with weights, before the last date of either; a fly if its
    legs were together, with weights, before the last date on which they are. A tenor that repeats on a date is an error.
    """
    legs = returns.join(universe.select("yield_tenor", "maturity").distinct(), "yield_tenor")
    daily = legs.groupBy(*by, "date").agg(F.sort_array(F.collect_list(F.struct("maturity", "yield_tenor", "duration"))).alias("held"))
    once = F.size("held") == F.size(F.array_distinct(F.transform("held", lambda leg: leg["yield_tenor"])))
    daily = daily.where(F.assert_true(once, F.concat(F.lit("repeated tenor on "), F.col("date").cast("string"))).isNull())
    entries = F.concat(
        F.transform("held", lambda leg: _entry(F.lit(None), F.lit(None), leg, F.lit(False))),
        F.flatten(F.transform(choices(F.col("held"), 2), _steepener)),
        F.flatten(F.transform(choices(F.col("held"), 3), _fly)),
    )
    found = daily.select(*by, "date", F.explode(entries).alias("entry")).select(*by, "date", "entry.*")
    # As many rows as strategies have legs: dates are gone.
    spans = found.groupBy(*by, "kind", "label", "tenor").agg(
        F.expr("min(date) FILTER (WHERE weighted)").alias("first"), F.max("date").alias("last"))
    of_tenor = F.expr(f"max(last) OVER (PARTITION BY {', '.join([*by, 'tenor'])})")
    ends = spans.withColumn("_tenor_last", of_tenor).where("label IS NOT NULL").groupBy(*by, "kind", "label").agg(
        F.min("first").alias("first"), F.max(F.when(F.col("kind") == "fly", F.col("last")).otherwise(F.col("_tenor_last"))).alias("last"))
    return ends.where("first < last").select(*by, "label").distinct().orderBy(*by, "label")


def _entry(kind: Column, label: Column, leg: Column, weighted: Column) -> Column:
    return F.struct(kind.alias("kind"), label.alias("label"), leg["yield_tenor"].alias("tenor"), weighted.alias("weighted")).cast(_ENTRY)


def _years(leg: Column) -> Column:
    return F.replace(leg["yield_tenor"], F.lit(TENOR_PREFIX), F.lit(""))


def _steepener(legs: Column) -> Column:
    label = F.concat(_years(legs[0]), F.lit("s"), _years(legs[1]), F.lit("s steepener"))
    inverse = [F.try_divide(F.lit(1.0), leg["duration"]) for leg in (legs[0], legs[1])]
    weighted = inverse[0].isNotNull() & inverse[1].isNotNull()
    return F.transform(legs, lambda leg: _entry(F.lit("steepener"), label, leg, weighted))


def _fly(legs: Column) -> Column:
    label = F.concat(*[part for k in range(3) for part in (_years(legs[k]), F.lit("s"))])
    complete = legs[0]["duration"].isNotNull() & legs[1]["duration"].isNotNull() & legs[2]["duration"].isNotNull()
    entries = F.transform(legs, lambda leg: _entry(F.lit("fly"), label, leg, legs[2]["duration"] != legs[0]["duration"]))
    return F.when(complete, entries).otherwise(F.expr(f"CAST(array() AS array<{_ENTRY}>)"))
