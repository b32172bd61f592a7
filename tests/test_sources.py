import json
import math
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from curveloom.operators import auctions, links, quotes
from curveloom.plans import catalog
from curveloom.sources import store, tables


def test_risk_from_several_files(spark, tmp_path):
    for security in ("TU", "FV"):
        pd.DataFrame({
            "date": [pd.Timestamp("2024-01-01"), pd.Timestamp("2024-01-02")], "security": f"{security}1 Comdty",
            "variable": "v", "value": [1.0, math.nan], "extra": 0,
        }).to_parquet(tmp_path / f"{security}.parquet", index=False)
    found = tables.read_risk(spark, [str(tmp_path / "TU.parquet"), str(tmp_path / "FV.parquet")])
    assert found.dtypes == [("date", "date"), ("security", "string"), ("variable", "string"), ("value", "double")]
    assert rows(found.where("security = 'TU1 Comdty'"), "date") == [
        (day(1), "TU1 Comdty", "v", 1.0), (day(2), "TU1 Comdty", "v", None)]


def test_panel_and_prices(spark, tmp_path):
    pd.DataFrame({"date": [pd.Timestamp("2024-01-01")], "DGS2": [math.nan], "DGS5": [4], "x": [1]}).to_parquet(tmp_path / "y.parquet")
    assert rows(tables.read_panel(spark, [str(tmp_path / "y.parquet")], ["DGS2", "DGS5"])) == [(day(1), None, 4.0)]
    pd.DataFrame({"date": [day(1)], "security": ["TU1 Comdty"], "PX_LAST": [101]}).to_parquet(tmp_path / "p.parquet")
    assert rows(tables.read_prices(spark, [str(tmp_path / "p.parquet")])) == [(day(1), "TU1 Comdty", 101.0)]


def test_quote_side_comes_from_the_file_name(spark, tmp_path):
    def save(name, records):
        (tmp_path / name).write_text(json.dumps(records, indent=1))
    save("historical_ct_yields_bid_side.json", [{"Date": "2024-01-01", "4-Week": 5.1}, {"Date": "2024-01-02", "10-Year": 4.0}])
    save("historical_ct_yields_offer_side.json", [{"Date": "2024-01-01", "4-Week": 5.0, "10-Year": 4.1}])
    save("other_ct_yields_mid_side.json", [{"Date": "2024-01-01", "4-Week": 9.9}])
    wide = tables.read_quote_files(spark, str(tmp_path), ["4-Week", "10-Year"])
    assert rows(wide, "date", "quote") == [
        (day(1), "bid", 5.1, None), (day(1), "offer", 5.0, 4.1), (day(2), "bid", None, 4.0)]
    assert quotes.quotes_long(wide).count() == 6


def test_observed_files_are_tagged_by_vintage(spark, tmp_path):
    base = {"Action": ["Buy"], "Description": ["s"], "last_updated": ["now"], "row": [0]}
    pd.DataFrame({**base, "price": [1.0]}).to_parquet(tmp_path / "market_observed_usts_auctioned_after_2000.parquet", index=False)
    pd.DataFrame({**base, "price": [2.0], "coupon": [3.0]}).to_parquet(
        tmp_path / "market_observed_usts_auctioned_after_2010.parquet", index=False)
    pd.DataFrame({**base, "price": [9.0]}).to_parquet(tmp_path / "something_else.parquet", index=False)
    union = tables.read_observed(spark, str(tmp_path), ["row"])
    found = auctions.reconcile_observed(union)
    assert {(r.variable, r.new_val) for r in found.collect()} == {("price", 1.0), ("coupon", 3.0)}


def test_saved_index_columns_are_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,j,cusip\n0,5,abc\n")
    assert rows(tables.read_indexed(spark, str(tmp_path / "a.csv"), "i int, j int, cusip string", ["i", "j"])) == [("abc",)]


def test_materialize_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))
    assert store.materialize(spark, path, build).count() == 1
    assert store.materialize(spark, path, build).count() == 1
    assert store.materialize(spark, path, build, refresh=True).count() == 2


def test_materialize_rebuilds_after_an_interrupted_write(spark, tmp_path):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    assert store.materialize(spark, str(tmp_path / "t"), lambda: spark.range(3)).count() == 3


def test_materialize_raises_other_errors(spark, tmp_path):
    (tmp_path / "notes.parquet").write_text("no table at all")
    with pytest.raises(Exception, match="notes.parquet"):
        store.materialize(spark, str(tmp_path / "notes.parquet"), lambda: spark.range(1))
    assert (tmp_path / "notes.parquet").read_text() == "no table at all"
    with pytest.raises(RuntimeError):
        def broken():
            raise RuntimeError
        store.materialize(spark, str(tmp_path / "t"), broken)


def test_partitioned_sink(spark, tmp_path):
    store.write_table(spark.range(4).withColumn("p", F.col("id") % 2), str(tmp_path / "t"), ["p"])
    assert sorted(p.name for p in (tmp_path / "t").glob("p=*")) == ["p=0", "p=1"]


def test_shared_path_needs_the_setting():
    def session(settings):
        return SimpleNamespace(conf=settings)
    assert store.shared_path(session({"spark.checkpoint.dir": "/shared/"}), "x") == "/shared/x"
    with pytest.raises(ValueError):
        store.shared_path(session({}), "x")


def test_materialize_rebuilds_a_table_that_lacks_files(spark, tmp_path):
    path = tmp_path / "t"
    store.materialize(spark, str(path), lambda: spark.range(0, 1000, 1, 4))

    def interrupted():
        store._set_finished(spark, str(path), False)
        for part in sorted(path.glob("part-*"))[:2]:
            part.unlink()
    interrupted()
    assert store.materialize(spark, str(path), lambda: spark.range(1000)).count() == 1000
    store.write_table(spark.range(3), str(tmp_path / "u"))
    assert store.materialize(spark, str(tmp_path / "u"), lambda: spark.range(7)).count() == 7


def test_kept_rows_have_no_lineage(spark):
    kept = store.kept(spark.range(5).where("id > 1"), "rows")
    assert [r.id for r in kept.orderBy("id").collect()] == [2, 3, 4]
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def test_a_run_leaves_no_folder_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_path", lambda _, name: f"{tmp_path}/{name}")
    folder = "/root/testdata/sf0.001"
    with store.scratch(spark):
        assert catalog.QUERIES["cleaned_long_history"](spark, folder).count() > 0
        assert catalog.QUERIES["append_returns"](spark, folder).count() > 0
        assert len(list(tmp_path.iterdir())) >= 4
    assert list(tmp_path.iterdir()) == []


def test_links_with_extension(spark):
    html = '<a class="x" href="a/b.xlsx">t</a><A HREF="no.xlsx"><a title="c.xlsx" href="/c.csv"></a><abbr href="d.xlsx">'
    pages = spark.createDataFrame([(1, "https://h.org/p/q?x=1", html), (2, "http://g.net", "none")], "page_id int, url string, html string")
    base = links.site_root(F.col("url"))
    assert rows(links.page_links(pages, base)) == [
        (1, "a/b.xlsx", "https://h.org/a/b.xlsx"), (1, "c.csv", "https://h.org/c.csv"), (1, "no.xlsx", "https://h.org/no.xlsx")]
    assert rows(links.page_links(pages, base, "csv")) == [(1, "c.csv", "https://h.org/c.csv")]
    assert rows(links.page_links(pages, F.lit("https://raw/data"), "xlsx", "title")) == [(1, "c.xlsx", "https://raw/data/c.xlsx")]


def test_links_in_any_quotes(spark):
    html = ("<a href='one.csv'>x</a><a data-href=\"no.csv\" HREF=two.csv class=\"box link\"><a title='href=\"no\"' href=\"3 > 2.csv\">"
            "<a href=\"http://o.org/z.xlsx\"><a href=\"//c.net/y\"><a name=top><a\nhref=\"../up.csv\" >")
    pages = spark.createDataFrame([(1, "https://h.org/p", html)], "page_id int, url string, html string")
    base = links.site_root(F.col("url"))
    assert {(r.file, r.link) for r in links.page_links(pages, base).collect()} == {
        ("one.csv", "https://h.org/one.csv"), ("two.csv", "https://h.org/two.csv"), ("3 > 2.csv", "https://h.org/3 > 2.csv"),
        ("http://o.org/z.xlsx", "http://o.org/z.xlsx"), ("//c.net/y", "//c.net/y"), ("../up.csv", "https://h.org/../up.csv")}
    assert [r.file for r in links.page_links(pages, base, css_class="link").collect()] == ["two.csv"]


def test_links_are_followed_from_the_page(spark):
    """Cases of RFC 3986, section 5.4, and what pages of other shapes need."""
    url = "http://a/b/c/d;p?q"
    expected = {
        "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
        "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s",
        ";x": "http://a/b/c/;x", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g",
        "../..": "http://a/", "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.",
        "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
        "g;x=1/../y": "http://a/b/c/y", "g?y/../x": "http://a/b/c/g?y/../x", "mailto:x@y": "mailto:x@y", "https://o.org/p/../q": "https://o.org/q"}
    html = "".join(f'<a href="{link}">' for link in expected)
    pages = spark.createDataFrame([(1, url, html)], "page_id int, url string, html string")
    assert {r.file: r.link for r in links.resolved_links(pages, F.col("url")).collect()} == expected
    bare = spark.createDataFrame([(1, "https://h.org", '<a href="x.csv?v=1" class="l"><a href="y.csv"><a class="l" href="z.xlsx">')], pages.schema)
    assert [r.link for r in links.resolved_links(bare, F.col("url")).collect()] == [f"https://h.org/{n}" for n in ("x.csv?v=1", "y.csv", "z.xlsx")]
    assert [r.link for r in links.resolved_links(bare, F.col("url"), "csv", css_class="l").collect()] == ["https://h.org/x.csv?v=1"]


def test_tenors_that_are_not_listed(spark, tmp_path):
    records = [{"Date": "2024-01-01", "4-Week": 5.0}, {"Date": "2024-01-02", "4-Week": 5.1, "2-Month": 4.9}]
    (tmp_path / "historical_x_bid_side.json").write_text(json.dumps(records))
    (tmp_path / "historical_x_mid_side.json").write_text(json.dumps([{"Date": "2024-01-01", "7-Year": 4.0, "4-Week": None}]))
    with pytest.raises(ValueError, match="2-Month, 7-Year"):
        tables.read_quote_files(spark, str(tmp_path), ["4-Week"])
    kept = tables.read_quote_files(spark, str(tmp_path), ["4-Week"], unlisted="keep")
    assert kept.columns == ["date", "quote", "4-Week", "2-Month", "7-Year"]
    assert rows(kept, "date", "quote") == [(day(1), "bid", 5.0, None, None), (day(1), "mid", None, None, 4.0), (day(2), "bid", 5.1, 4.9, None)]
    assert tables.read_quote_files(spark, str(tmp_path), ["4-Week"], unlisted="drop").columns == ["date", "quote", "4-Week"]
    assert tables.read_quote_files(spark, str(tmp_path), ["4-Week", "7-Year", "2-Month"]).count() == 3


def test_extended_tables_list_what_is_finished(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []

    def adding(*days):
        def build(since, state):
            seen.append((since, state and sorted(r.date for r in state.collect())))
            new = spark.createDataFrame([(day(d),) for d in days], "date date")
            return (new if since is None else new.where(F.col("date") > F.lit(since))), new.agg(F.max("date").alias("date"))
        return build

    assert store.extend(spark, path, adding()).count() == 0
    assert rows(store.extend(spark, path, adding(1, 2))) == [(day(1),), (day(2),)]
    # An addition that was cut off is there in part, but not listed.
    store.write_table(spark.createDataFrame([(day(9),)], "date date"), f"{path}/added=1")
    assert rows(store.extend(spark, path, adding(1, 2, 3))) == [(day(1),), (day(2),), (day(3),)]
    assert store.extend(spark, path, adding(3)).count() == 3
    assert seen == [(None, None), (None, None), (day(2), [day(2)]), (day(3), [day(3)])]
    assert [(r.number, r.start, r.end) for r in store.finished_ranges(spark, path)] == [(0, day(1), day(2)), (1, day(3), day(3))]
