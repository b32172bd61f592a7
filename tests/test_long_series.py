"""Sliced series against the plain windows, for slices far smaller than the series."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from curveloom.functions import long_series as ls
from curveloom.functions import series as ss

SLICES = [1, 40, None]
def w():
    return ss.series(["k"], ["t"])



@pytest.fixture(scope="module")
def ticks(spark):
    """One key holds two thirds of the rows; values have gaps and times are bursty."""
    rng = random.Random(3)
    data, t = [], 0
    for i in range(600):
        t += rng.choice([1, 1, 1, 2, 400])
        key = "hot" if i % 3 else rng.choice("abcdef")
        data.append((key, t, None if rng.random() < 0.15 else round(rng.uniform(1, 9), 3)))
    return spark.createDataFrame(data, "k string, t long, x double").cache()


def same(actual, expected, column):
    got = {(r.k, r.t): r[column] for r in actual.collect()}
    want = {(r.k, r.t): r[column] for r in expected.collect()}
    assert got.keys() == want.keys() and len(got) == expected.count() == actual.count()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value, rel=1e-9, abs=1e-12)), key


@pytest.mark.parametrize("slices", SLICES)
def test_difference(ticks, slices):
    spec = ls.cut(ticks, ["k"], "t", slices)
    same(ls.difference(ticks, spec, "x", "d"), ticks.withColumn("d", ss.difference(F.col("x"), w())), "d")


@pytest.mark.parametrize("slices", SLICES)
def test_pct_change(ticks, slices):
    spec = ls.cut(ticks, ["k"], "t", slices)
    same(ls.pct_change(ticks, spec, "x", "p"), ss.with_pct_change(ticks, "x", "p", w()), "p")


@pytest.mark.parametrize("slices", SLICES)
def test_cumulative(ticks, slices):
    rated = ticks.withColumn("r", F.col("x") / 1000)
    actual = ls.cumulative(rated, ls.cut(rated, ["k"], "t", slices), {"s": "x"}, {"g": "r"})
    assert set(actual.columns) == {"k", "t", "x", "r", "s", "g"}
    same(actual, rated.withColumn("s", ss.cumulative_sum(F.col("x"), w())), "s")
    same(actual, rated.withColumn("g", ss.cumulative_growth(F.col("r"), w())), "g")


@pytest.mark.parametrize("slices", SLICES)
def test_index_counts_every_row_once(ticks, slices):
    got = ls.with_index(ticks, ls.cut(ticks, ["k"], "t", slices)).collect()
    for key in {r.k for r in got}:
        of_key = sorted((r.t, r[ls.INDEX]) for r in got if r.k == key)
        assert [i for _, i in of_key] == list(range(len(of_key)))


@pytest.mark.parametrize("slices", SLICES)
@pytest.mark.parametrize("rows", [2, 30])
def test_zscore(ticks, slices, rows):
    spec = ls.cut(ticks, ["k"], "t", slices)
    actual = ls.rolling_zscores(ticks, spec, {"z": "x"}, rows)
    same(actual, ticks.withColumn("z", ss.rolling_zscore(F.col("x"), w(), rows)), "z")


def test_several_zscores_and_equal_values(spark):
    df = spark.createDataFrame([("a", i, 5.0, float(i * i)) for i in range(40)], "k string, t long, x double, y double")
    actual = ls.rolling_zscores(df, ls.cut(df, ["k"], "t", 6), {"zx": "x", "zy": "y"}, 6)
    assert {r.zx for r in actual.collect()} == {None}
    same(actual, df.withColumn("zy", ss.rolling_zscore(F.col("y"), w(), 6)), "zy")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double"])
def test_order_types(spark, kind):
    start = dt.datetime(2024, 3, 30, 23, 0)
    times = [start + dt.timedelta(days=i) if kind == "date" else start + dt.timedelta(seconds=i * 13) for i in range(200)]
    raw = spark.createDataFrame([("a", t, i, float(i % 7)) for i, t in enumerate(times)], "k string, t timestamp, n int, x double")
    df = raw.withColumn("t", (F.unix_micros("t") / 1e6 if kind == "double" else F.col("t").cast(kind)))
    same(
        ls.cumulative(df, ls.cut(df, ["k"], "t"), {"s": "x"}),
        df.withColumn("s", ss.cumulative_sum(F.col("x"), w())), "s")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_positions_rise_across_clock_changes(spark, kind):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = [at * 1_000_000 + 5 for start in (1710048000, 1730602800) for at in range(start, start + 6 * 3600, 600)]
        df = spark.createDataFrame([(m,) for m in micros], "m long").withColumn("t", F.timestamp_micros("m"))
        df = df.withColumn("t", F.col("t").cast(kind))
        at = ls._position(df, "t")
        found = [(r.t, r.at) for r in df.select("t", at.alias("at")).collect()]
        if kind == "timestamp":
            assert [p for _, p in found] == [float(m) for m in micros]
        else:
            assert [p for _, p in sorted(found)] == sorted(p for _, p in found)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("stray", [False, True])
def test_slices_bound_the_rows_of_a_hot_key(spark, stray):
    """Equal counts per slice for one key, with bursts and with an order value far off the others."""
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.pow(F.col("id"), 3).alias("t"))
    if stray:
        df = df.union(spark.createDataFrame([("hot", 1e30), ("hot", -1e30)], "k string, t double"))
    sizes = ls.with_slices(df, ls.cut(df, ["k"], "t", rows_per_slice=100)).groupBy("k", ls.SLICE).count().collect()
    assert 100 <= len(sizes) <= 101 and max(r["count"] for r in sizes) <= 200


@pytest.mark.parametrize("value", [0.1, 4.37, 0.7])
def test_runs_of_one_value_have_no_zscore(spark, value):
    rng = random.Random(1)
    data = [("a", i, value) for i in range(900)] + [("a", 900 + i, rng.uniform(1, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "k string, t long, x double")
    actual = ls.rolling_zscores(df, ls.cut(df, ["k"], "t", 5), {"z": "x"}, 200)
    assert not [r for r in actual.where("t < 900").collect() if r.z is not None]
    same(actual.where("t >= 1100"), df.where("t >= 901").withColumn("z", ss.rolling_zscore(F.col("x"), w(), 200)).where("t >= 1100"), "z")


def test_rows_without_a_key_are_a_series_of_their_own(spark):
    data = [(k, i, float(i)) for i in range(6) for k in ("a", None)]
    df = spark.createDataFrame(data, "k string, t long, x double")
    spec = ls.cut(df, ["k"], "t", 3)
    same(ls.difference(df, spec, "x", "d"), df.withColumn("d", ss.difference(F.col("x"), w())), "d")
    assert ls.cumulative(df, spec, {"s": "x"}).count() == ls.rolling_zscores(df, spec, {"z": "x"}, 2).count() == 12


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t long, x double")
    spec = ls.cut(df, ["k"], "t")
    assert ls.difference(df, spec, "x", "d").count() == ls.rolling_zscores(df, spec, {"z": "x"}, 5).count() == 0


@pytest.mark.parametrize("coarse", [0, 1, 4])
def test_fine_cuts_come_from_a_table(ticks, coarse):
    """Few coarse cuts reach the driver; the slices are as short as without that bound, and the results the same."""
    spec = ls.cut(ticks, ["k"], "t", 40, coarse=coarse)
    assert len(spec.cuts) <= coarse and spec.fine_cuts > 0 and spec.fine.count() <= coarse + 1
    sizes = [r["count"] for r in ls.with_slices(ticks, spec).groupBy(ls.SLICE).count().collect()]
    assert sum(sizes) == 600 and len(sizes) > 25 and max(sizes) < 60
    same(ls.difference(ticks, spec, "x", "d"), ticks.withColumn("d", ss.difference(F.col("x"), w())), "d")
    rated = ticks.withColumn("r", F.col("x") / 1000)
    same(ls.cumulative(rated, spec, {"s": "x"}), rated.withColumn("s", ss.cumulative_sum(F.col("x"), w())), "s")
    index = {(r.k, r.t): r[ls.INDEX] for r in ls.with_index(ticks, spec).collect()}
    for key in {k for k, _ in index}:
        assert [index[k] for k in sorted(index) if k[0] == key] == list(range(sum(k[0] == key for k in index)))


def test_cuts_below_are_found_by_halving(spark):
    rows = [([1.0, 2.0, 2.5, 9.0, 10.0], x) for x in (0.0, 1.0, 1.5, 2.0, 2.7, 9.0, 11.0)] + [([], 5.0), ([7.0], 7.0)]
    df = spark.createDataFrame(rows, "c array<double>, x double")
    found = [r[0] for r in df.select(ls._cuts_below(F.col("c"), F.col("x"), 5)).collect()]
    assert found == [sum(c <= x for c in cuts) for cuts, x in rows]
