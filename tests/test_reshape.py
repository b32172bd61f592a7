import pytest
from pyspark.errors import AnalysisException

from helpers import rows
from curveloom.functions import reshape
from curveloom.functions.scalar import null_nans, row_mean


def test_to_wide_has_a_static_schema(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0), (2, "z", 9.0)], "k int, v string, x double")
    wide = reshape.to_wide(df, ["k"], "v", "x", {"a": "first", "b": "second", "c": "third"})
    assert wide.columns == ["k", "first", "second", "third"]
    assert rows(wide, "k") == [(1, 5.0, None, None), (2, None, 6.0, None)]


def test_to_long_of_mixed_types_needs_text(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "k int, a string, b double")
    with pytest.raises(AnalysisException):
        reshape.to_long(df, ["k"]).collect()
    assert rows(reshape.to_long(df, ["k"], as_text=True), "variable") == [(1, "a", "x"), (1, "b", "2.5")]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, v string")
    assert rows(reshape.duplicates(df, ["k"])) == [(1, 2)]
    reshape.assert_unique(df, ["k", "v"])
    with pytest.raises(ValueError):
        reshape.assert_unique(df, ["k"])


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan"), 2.0)], "k int, a double, b double")
    assert rows(null_nans(df)) == [(1, None, 2.0)]


def test_row_mean_of_present_values(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(row_mean(["a", "b", "c"])).collect()] == [2.5, None]


@pytest.mark.parametrize("repeat", [("a", 9.0), ("a", 1.0), ("a", None)])
def test_a_repeated_cell_is_an_error(spark, repeat):
    df = spark.createDataFrame([("k", "a", 1.0), ("k", "b", 2.0), ("j", "a", 3.0), ("k", "other", 1.0), ("k", "other", 2.0)], "k string, v string, x double")
    assert rows(reshape.to_wide(df, ["k"], "v", "x", ["a", "b"])) == [("j", 3.0, None), ("k", 1.0, 2.0)]
    twice = df.unionByName(spark.createDataFrame([("k", *repeat)], "k string, v string, x double"))
    with pytest.raises(Exception, match='repeated value for key .*"k":"k"'):
        reshape.to_wide(twice, ["k"], "v", "x", ["a", "b"]).collect()


def test_cells_of_more_names_than_a_long_has_bits(spark):
    names = [f"n{i}" for i in range(130)]
    df = spark.createDataFrame([(1, n, 1.0) for n in names], "k int, v string, x double")
    assert reshape.to_wide(df, ["k"], "v", "x", names).count() == 1
    with pytest.raises(Exception, match="repeated"):
        reshape.to_wide(df.unionByName(df.where("v = 'n129'")), ["k"], "v", "x", names).collect()
