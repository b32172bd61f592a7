"""One row per strategy and date, holding each leg's values side by side.

All strategies are built in one job: the table of combinations is joined to the returns once, instead of
rescanning the returns per combination. The shuffle is on the strategy, which the leg aggregation and the
lag windows that follow share, so neither adds another one.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from curveloom.functions.reshape import cell, cell_counts, with_single_cells


def strategy_legs(
    returns: DataFrame, combos: DataFrame, label: str, positions: Sequence[str], variables: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """``label, date`` and a ``<position>_<variable>`` column per leg, over the union of the legs' dates.

    A strategy has one row per date. Two rows of a tenor on one date (two securities of that tenor) are an error.
    """
    legs = combos.unpivot([label], list(positions), "position", "yield_tenor")
    cells = [cell("max", "position", p, v, leg(p, v)) for p in positions for v in variables]
    wide = (
        returns.select(*by, "date", "yield_tenor", *variables)
        .join(legs, "yield_tenor")
        .repartition(*by, label)
        .groupBy(*by, label, "date")
        .agg(*cells, *cell_counts("position", positions))
    )
    return with_single_cells(wide, [*by, label, "date"])


def leg(position: str, variable: str) -> str:
    return f"{position}__{variable}"


def required(variables: Sequence[str]) -> list[str]:
    """The asked-for variables plus the duration, which the weights are made of."""
    return list(dict.fromkeys(["duration", *variables]))
