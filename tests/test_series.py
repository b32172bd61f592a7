import pytest
from pyspark.sql import functions as F

from helpers import by_date, day
from curveloom.functions import series as ss

def w():
    return ss.series(["k"])



def frame(spark, values, key="a"):
    return spark.createDataFrame([(key, day(i), v) for i, v in enumerate(values, 1)], "k string, date date, x double")


def test_difference_does_not_skip_gaps(spark):
    df = frame(spark, [1.0, 3.0, None, 4.0, 6.0]).withColumn("d", ss.difference(F.col("x"), w()))
    assert by_date(df, "d") == {day(1): (None,), day(2): (2.0,), day(3): (None,), day(4): (None,), day(5): (2.0,)}


def test_series_do_not_mix(spark):
    df = frame(spark, [1.0, 2.0]).union(frame(spark, [10.0, 30.0], "b")).withColumn("d", ss.difference(F.col("x"), w()))
    assert sorted((r.k, r.d) for r in df.collect() if r.d is not None) == [("a", 1.0), ("b", 20.0)]


def test_cumulative_sum_skips_missing_and_leaves_it_missing(spark):
    df = frame(spark, [None, 1.0, None, 2.0]).withColumn("s", ss.cumulative_sum(F.col("x"), w()))
    assert by_date(df, "s") == {day(1): (None,), day(2): (1.0,), day(3): (None,), day(4): (3.0,)}


def test_cumulative_growth_compounds(spark):
    df = frame(spark, [None, 0.5, None, 1.0]).withColumn("g", ss.cumulative_growth(F.col("x"), w()))
    assert by_date(df, "g") == {day(1): (None,), day(2): (0.5,), day(3): (None,), day(4): (2.0,)}


def test_pct_change_pads_gaps(spark):
    df = ss.with_pct_change(frame(spark, [None, 10.0, None, 20.0]), "x", "p", w())
    assert by_date(df, "p") == {day(1): (None,), day(2): (None,), day(3): (0.0,), day(4): (1.0,)}
    assert "_padded" not in df.columns


def test_pct_change_from_zero_is_null(spark):
    df = ss.with_pct_change(frame(spark, [0.0, 5.0]), "x", "p", w())
    assert by_date(df, "p")[day(2)] == (None,)


def test_zscore_needs_a_full_frame_of_values(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0, 6.0, 11.0]).withColumn("z", ss.rolling_zscore(F.col("x"), w(), 3))
    found = by_date(df, "z")
    assert [found[day(i)][0] for i in range(1, 6)] == [None] * 5
    # mean 7, sample deviation sqrt(13)
    assert found[day(6)][0] == pytest.approx(4 / 13**0.5)


def test_zscore_of_equal_values_is_null(spark):
    df = frame(spark, [5.0] * 25).withColumn("z", ss.rolling_zscore(F.col("x"), w(), 20))
    assert {v for (v,) in by_date(df, "z").values()} == {None}


@pytest.mark.parametrize("rows_in_frame", [2, 3, 7])
def test_scores_by_runs_equal_those_of_the_frame(spark, rows_in_frame):
    values = [None if i % 11 == 5 else 0.1 if 30 <= i < 45 else (i * 37 % 17) / 10 for i in range(70)]
    df = frame(spark, values)
    want = by_date(df.withColumn("z", ss.rolling_zscore(F.col("x"), w(), rows_in_frame)), "z")
    found = by_date(ss.with_rolling_zscores(df, ["k"], {"z": "x"}, rows_in_frame), "z")
    assert found == {d: (None if z is None else pytest.approx(z, abs=1e-9),) for d, (z,) in want.items()}
    assert any(z is not None for (z,) in want.values())
