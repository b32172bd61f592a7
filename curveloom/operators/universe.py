"""The instrument universe and the ordered tenor combinations built from it."""

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.config import ETF_TICKERS, TENOR_PREFIX, UNIVERSE


def universe_table(spark: SparkSession, securities: Mapping[str, int] = UNIVERSE) -> DataFrame:
    """``security, maturity, yield_tenor`` as an in-plan table, whose exact size Catalyst knows."""
    table = pa.table({
        "security": pa.array(securities.keys(), pa.string()),
        "maturity": pa.array(securities.values(), pa.int32()),
    })
    # One partition, so that gathering its few rows needs no shuffle.
    return spark.createDataFrame(table).coalesce(1).withColumn("yield_tenor", tenor_label(F.col("maturity")))


def etf_table(spark: SparkSession, tickers: Mapping[str, str] = ETF_TICKERS) -> DataFrame:
    return spark.createDataFrame(pa.table({"yield_tenor": list(tickers.keys()), "ticker": list(tickers.values())}))


def tenor_label(maturity: Column) -> Column:
    return F.format_string(f"{TENOR_PREFIX}%d", maturity)


def observed_universe(risk_panel: DataFrame, universe: DataFrame) -> DataFrame:
    """The part of the universe that the panel holds. Bounded by the universe, whatever the panel's size."""
    held = risk_panel.select("security").distinct()
    return universe.join(held, "security", "left_semi")


def tenor_pairs(universe: DataFrame) -> DataFrame:
    """``steepener, long, short``: every pair of tenors, the shorter maturity being the long leg."""
    pairs = combinations(universe, ["long", "short"])
    return pairs.selectExpr(f"{_years('long')} || 's' || {_years('short')} || 's steepener' AS steepener", "long", "short")


def tenor_triples(universe: DataFrame) -> DataFrame:
    """``fly, short, bullet, long``: every triple of tenors in order of maturity."""
    positions = ["short", "bullet", "long"]
    label = " || ".join(f"{_years(p)} || 's'" for p in positions)
    return combinations(universe, positions).selectExpr(f"{label} AS fly", *positions)


def combinations(universe: DataFrame, positions: Sequence[str]) -> DataFrame:
    """A row for each choice of as many tenors as there are positions, which name the columns in order of maturity.

    The universe is gathered into one array, as long as it has tenors, and expanded from there: whatever it is made from is
    read once. A tenor that two securities have counts once, and tenors of equal maturity are never chosen together.
    """
    held = universe.agg(F.sort_array(F.collect_set(F.struct("maturity", "yield_tenor"))).alias("held"))
    chosen = held.select(F.explode(choices(F.col("held"), len(positions))).alias("legs"))
    return chosen.select(*[F.col("legs")[k]["yield_tenor"].alias(p) for k, p in enumerate(positions)])


def choices(held: Column, k: int) -> Column:
    """All arrays of ``k`` of the array's structs, each of a longer maturity than the one before."""
    def extended(picked: list[Column]) -> Column:
        if len(picked) == k:
            return F.array(F.array(*picked))
        rest = F.filter(held, lambda x: x["maturity"] > picked[-1]["maturity"]) if picked else held
        return F.flatten(F.transform(rest, lambda x: extended([*picked, x])))
    return extended([])


def _years(tenor: str) -> str:
    return f"replace({tenor}, '{TENOR_PREFIX}', '')"
