"""Every registered query against its SQL, and the shape of the plans."""

import datetime as dt
import math
import re

import duckdb
import pytest

import __spark_entry__ as contract
from curveloom.operators import quotes
from curveloom.plans import adapters, catalog, oracle

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def scale(request):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{request.param}/{t}.parquet'")
    return f"{DATA}/{request.param}", con


def plain(value):
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    return None if isinstance(value, float) and math.isnan(value) else value


def table(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, scale, name):
    folder, con = scale
    df = QUERIES[name](spark, folder)
    cursor = con.execute(SQL[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and SQL.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(spark, name, scale="sf0.01"):
    return QUERIES[name](spark, f"{DATA}/{scale}")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_engine(spark, name):
    text = plan(spark, name)
    assert "Python" not in text and "CartesianProduct" not in text
    # One row of the first and last date, and one of the universe's tenors.
    single = ("panel_date_range", "pair_universe", "triple_universe")
    assert "Exchange SinglePartition" not in re.sub(r"(?s)Subquery.*?FileScan[^\n]*", "", text) or name in single


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(spark, "spread_cumulative")
    schemas = set(re.findall(r"ReadSchema: (struct<.*?>)", text))
    assert schemas == {
        "struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>",
        "struct<l_linenumber:int,l_extendedprice:double,l_shipdate:timestamp_ntz>"}


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan(spark, "observed_union"))


def test_quotes_come_from_every_event(spark, scale):
    folder, _ = scale
    events = spark.read.parquet(f"{folder}/events.parquet")
    assert adapters.tick_quotes(spark, folder).count() == events.count()
    assert re.search(r"events.parquet\][^\n]*PushedFilters: \[\]", plan(spark, "duplicate_keys"))


def test_all_steepeners_share_one_scan_and_one_shuffle(spark):
    text = plan(spark, "steepener_panel")
    assert text.count("FileScan") == 2
    assert len(re.findall(r"Exchange hashpartitioning\(steepener", text)) == 1


def test_combinations_and_labels_read_each_table_once(spark):
    for name in ("pair_universe", "triple_universe"):
        assert plan(spark, name).count("FileScan") == 1
    text = plan(spark, "strategy_labels")
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning(steepener") == 0
    assert len(re.findall(r"\blag\(", text)) == 1  # that of the yields; the strategies need none


def test_reconciliation_shuffles_once(spark):
    for name in ("auction_reconcile", "auction_reconcile_wide"):
        assert plan(spark, name).count("Exchange") == 1


def test_cleaning_shuffles_a_tenor_once(spark):
    text = plan(spark, "cleaned_quotes")
    assert len(re.findall(r"Exchange hashpartitioning\(tenor#\d+, \d+\)", text)) == 1


def test_replacement_reads_the_scored_rows_from_a_table(spark):
    """Neither the flag of a tenor nor the join of it repeats the scores or gathers a tenor's rows."""
    for name in ("cleaned_quotes", "outlier_replace"):
        text = plan(spark, name)
        assert "Window" not in text and "events" not in text


@pytest.mark.parametrize("rows", [50, 200])
def test_only_short_frames_are_read_whole(spark, rows):
    """Either way a tenor is shuffled and sorted once, and a frame of 200 rows is never read for each row."""
    filled = quotes.imputed(quotes.partial_rows(quotes.sides_wide(quotes.quotes_long(adapters.quotes_wide(spark, f"{DATA}/sf0.01")))))
    text = quotes.with_zscores(filled, rows)._jdf.queryExecution().executedPlan().toString()
    frames = set(re.findall(r"specifiedwindowframe\(RowFrame, -(\d+), currentrow", text)) - {"1"}
    assert frames == ({"49"} if rows == 50 else set())
    assert len(re.findall(r"Exchange hashpartitioning\(tenor#\d+, \d+\)", text)) == 1


def test_rolling_over_ticks_shuffles_the_rows_twice(spark):
    text = plan(spark, "tick_rolling_zscore")
    assert len(re.findall(r"Exchange hashpartitioning\(_series#\d+, _block", text)) == 1
    # rows by slice, and the slices' counts; how the counts are joined is Spark's choice by their size
    assert 2 <= len(re.findall(r"Exchange hashpartitioning\(_series#\d+, _slice", text)) <= 3
