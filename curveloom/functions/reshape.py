"""Long <-> wide reshaping with static schemas, and the duplicate guard that goes with it."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, variable: str = "variable",
    value: str = "value", as_text: bool = False,
) -> DataFrame:
    """Unpivot ``values`` (default: every column not in ``ids``).

    Columns of different types have no common long form; ``as_text`` casts them to strings first.
    """
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    if as_text:
        df = df.withColumns({c: F.col(c).cast("string") for c in values})
    return df.unpivot(list(ids), values, variable, value)


def to_wide(
    df: DataFrame, keys: Sequence[str], column: str, value: str, names: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """One row per key, one column per name: a single map-side-combined aggregation.

    ``names`` lists the variables to keep, or maps them to output names, so the schema never depends on data.
    A cell of more than one row is an error, be its values equal or missing; the same aggregation finds it.
    """
    names = names if isinstance(names, Mapping) else {n: n for n in names}
    cells = [cell("max", column, name, value, out) for name, out in names.items()]
    wide = df.where(F.col(column).isin(list(names))).groupBy(*keys).agg(*cells, *cell_counts(column, list(names)))
    return with_single_cells(wide, keys)


BITS = 62  # names that one long has a bit for


def cell_counts(column: str, names: Sequence[str]) -> list[Column]:
    """Aggregates beside a group's cells: its rows, and a bit for each name that it has. As many of both: no repeats."""
    seen = []
    for at in range(0, len(names), BITS):
        cases = " ".join(f"WHEN '{name}' THEN {1 << k}L" for k, name in enumerate(names[at:at + BITS]))
        seen.append(F.expr(f"bit_or(CASE `{column}` {cases} ELSE 0L END) AS `_seen_{at}`"))
    return [F.count(F.lit(1)).alias("_rows"), *seen]


def with_single_cells(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The pivoted rows without their ``cell_counts``, which raise where a cell had more than one row."""
    seen = [c for c in wide.columns if c.startswith("_seen_")]
    different = F.expr(" + ".join(f"bit_count(`{c}`)" for c in seen))
    message = F.concat(F.lit("repeated value for key "), F.to_json(F.struct(*keys)))
    return wide.where(F.assert_true(F.col("_rows") == different, message).isNull()).drop("_rows", *seen)


def cell(aggregate: str, column: str, name: str, value: str, out: str) -> Column:
    """``aggregate`` of ``value`` over the group's rows whose ``column`` equals ``name``."""
    return F.expr(f"{aggregate}(`{value}`) FILTER (WHERE `{column}` = '{name}') AS `{out}`")


def stacked(rows: Sequence[Mapping[str, str]]) -> Column:
    """Generator that emits one row per mapping of names to SQL expressions; use inside ``select``."""
    structs = [", ".join(f"{sql} AS `{name}`" for name, sql in row.items()) for row in rows]
    return F.expr(f"inline(array({', '.join(f'struct({s})' for s in structs)}))")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key repeats. Runs a job: meant for ingest and tests, not for query plans."""
    example = duplicates(df, keys).take(1)
    if example:
        raise ValueError(f"duplicate rows for key {example[0].asDict()}")
