import itertools

from helpers import day, rows
from curveloom.config import VINTAGES
from curveloom.operators import auctions

LONG = "cusip string, variable string, value string"


def test_index_columns_go_and_dates_are_parsed(spark):
    raw = spark.createDataFrame([(0, 7, "c", "2024-01-02", "2024-01-05")], "a int, b int, cusip string, auction_date string, issue_date string")
    assert rows(auctions.typed_auctions(raw, ["a", "b"])) == [("c", day(2), day(5))]


def test_long_history_keeps_complete_rows_as_text(spark):
    history = spark.createDataFrame(
        [(0, "c", "2024-01-02", "2024-01-03", "2024-01-04", "Note", 5, 2.5), (1, "d", None, "2024-01-03", "2024-01-04", "Note", 5, None)],
        "row int, cusip string, auction_date string, issue_date string, record_date string, security_term string, size int, rate double")
    long = auctions.auction_long(history, ["cusip", "auction_date", "issue_date"], ["row"])
    assert rows(long) == [
        ("c", day(2), day(3), day(4), "Note", "rate", "2.5"), ("c", day(2), day(3), day(4), "Note", "size", "5")]


def test_conflicts_resolve_to_the_left(spark):
    left = spark.createDataFrame([("same", "v", "1"), ("differ", "v", "1"), ("left", "v", "1")], LONG)
    right = spark.createDataFrame([("same", "v", "1"), ("differ", "v", "2"), ("right", "v", "2")], LONG)
    assert rows(auctions.reconcile_auctions(left, right, with_conflict=True)) == [
        ("differ", "v", "1", True), ("left", "v", "1", False), ("right", "v", "2", False), ("same", "v", "1", False)]
    assert auctions.reconcile_auctions(left, right).columns == ["cusip", "variable", "value"]


def test_wide_and_long_reconciliation_agree(spark):
    ids = ["cusip", "record_date", "security_term"]
    schema = "cusip string, record_date date, security_term string, a int"
    left = spark.createDataFrame([("x", day(1), "n", 1, 5.0), ("y", day(1), "n", None, None), (None, day(1), "n", 1, 1.0)],
                                 schema + ", b double")
    right = spark.createDataFrame([("x", day(1), "n", 2, "q"), ("y", day(1), "n", 4, None), ("z", day(2), "n", 7, "r")],
                                  schema + ", c string")
    wide = auctions.reconcile_histories(left, right, ["cusip"])
    long = auctions.reconcile_auctions(*[auctions.auction_long(df, ["cusip"]) for df in (left, right)], with_conflict=True)
    assert rows(wide.select(*ids, "variable", "value", "conflict")) == rows(long.select(*ids, "variable", "value", "conflict"))
    assert wide.count() == 6


def test_repeated_keys_are_one_row(spark):
    left = spark.createDataFrame([("x", "v", "2"), ("x", "v", "1"), ("y", "v", "5")], LONG)
    right = spark.createDataFrame([("x", "v", "3"), ("x", "v", "1"), ("z", "v", "4")], LONG)
    found = auctions.reconcile_auctions(left, right, with_conflict=True, with_repeats=True)
    assert rows(found) == [("x", "v", "1", False, True), ("y", "v", "5", False, False), ("z", "v", "4", False, False)]
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_repeated_histories_are_one_row_a_measure(spark):
    schema = "cusip string, record_date date, security_term string, a int, b int"
    left = spark.createDataFrame([("x", day(1), "n", 1, 5), ("x", day(1), "n", 2, None)], schema)
    right = spark.createDataFrame([("x", day(1), "n", 1, 6)], schema)
    wide = auctions.reconcile_histories(left, right, ["cusip"], with_repeats=True)
    long = auctions.reconcile_auctions(*[auctions.auction_long(df, ["cusip"]) for df in (left, right)], True, True)
    columns = ["variable", "value", "conflict", "repeated"]
    assert rows(wide.select(*columns)) == rows(long.select(*columns)) == [("a", "1", False, True), ("b", "5", True, False)]


def vintages(spark):
    """Every pattern of presence over three vintages, each with values of its own."""
    data = {v: [] for v in VINTAGES}
    for number, present in enumerate(itertools.product([True, False], repeat=3)):
        for position, (v, held) in enumerate(zip(VINTAGES, present), 1):
            data[v].append(("Buy", f"s{number}", "now", float(position) if held else None))
    return {v: spark.createDataFrame(r, "Action string, Description string, last_updated string, price double") for v, r in data.items()}


def test_first_vintage_with_a_value_wins(spark):
    found = auctions.reconcile_observed(auctions.observed_union(vintages(spark)))
    values = {r.Description: r.new_val for r in found.collect()}
    assert values == {"s0": 1.0, "s1": 1.0, "s2": 1.0, "s3": 1.0, "s4": 2.0, "s5": 2.0, "s6": 3.0}
    assert found.columns == ["Action", "Description", "last_updated", "variable", "new_val"]


def test_missing_columns_of_a_vintage_are_filled(spark):
    from pyspark.sql import functions as F
    tables = vintages(spark)
    tables[VINTAGES[2]] = tables[VINTAGES[2]].withColumn("coupon", F.lit(4.0))
    long = auctions.observed_long(auctions.observed_union(tables))
    assert {(r.group, r.variable) for r in long.where("variable = 'coupon'").collect()} == {(VINTAGES[2], "coupon")}


def test_repeated_rows_and_the_smallest_value_per_key(spark):
    data = [("Buy", "s", "g", "now", "price", v) for v in (3.0, 2.0, 2.0)]
    long = spark.createDataFrame(data, "Action string, Description string, group string, last_updated string, variable string, value double")
    assert auctions.observed_dedup(long).count() == 2
    assert [r.value for r in auctions.observed_first(long).collect()] == [2.0]
