"""The stored tables end to end, from files of the declared shapes."""

import datetime as dt
import json
import re

import pandas as pd
import pytest

from helpers import day, rows
from curveloom.operators import flies, returns, spreads, universe
from curveloom.plans import stored


def save_inputs(folder):
    data = [(day(d), f"{s} Comdty", v, x + d / 10) for d in range(1, 8) for s, x in (("TU1", 2.0), ("FV1", 4.0), ("WN1", 16.0))
            for v, x in (("CONVENTIONAL_CTD_FORWARD_FRSK", x), ("FUT_EQV_CNVX_NOTL", x * x))]
    pd.DataFrame(data, columns=["date", "security", "variable", "value"]).to_parquet(folder / "risk.parquet")
    wide = pd.DataFrame([(day(d), 3 + d / 50, 3.5 + d / 40, 4 - d / 30) for d in range(1, 8)], columns=["date", "DGS2", "DGS5", "DGS30"])
    wide.to_parquet(folder / "yields.parquet")


def test_returns_and_strategies(spark, tmp_path):
    save_inputs(tmp_path)
    held = universe.universe_table(spark, {"TU1": 2, "FV1": 5, "WN1": 30})
    out = str(tmp_path / "out")
    daily = stored.synthetic_returns(spark, out, [str(tmp_path / "risk.parquet")], [str(tmp_path / "yields.parquet")], held,
                                     ["DGS2", "DGS5", "DGS30"])
    assert daily.count() == 18
    (tmp_path / "risk.parquet").unlink()
    assert stored.synthetic_returns(spark, out, ["gone"], ["gone"], held).count() == 18
    panel = stored.steepeners(spark, out, daily, held)
    assert panel.count() == 3 * 5 * 7
    assert spreads.cumulative_spread(spreads.return_legs(panel)).count() == 15
    strategies = stored.fly_strategies(spark, out, daily, held)
    assert {r.fly for r in strategies.select("fly").distinct().collect()} == {"2s5s30s"}
    assert flies.cumulative_fly(flies.return_legs(strategies)).count() == 5
    assert len(list((tmp_path / "out" / "steepeners").glob("steepener=*"))) == 3


def test_repeated_risk_values_are_refused(spark, tmp_path):
    save_inputs(tmp_path)
    twice = [str(tmp_path / "risk.parquet")] * 2
    with pytest.raises(ValueError, match="duplicate"):
        stored.synthetic_returns(spark, str(tmp_path / "out"), twice, [str(tmp_path / "yields.parquet")], tenors=["DGS2"])


def test_appending_equals_a_rebuild(spark, tmp_path):
    """Additions of any length, with a yield missing on the last day before one, and a security that is away for a while."""
    held = universe.universe_table(spark, {"TU1": 2, "FV1": 5})
    variables = ("CONVENTIONAL_CTD_FORWARD_FRSK", "FUT_EQV_CNVX_NOTL")
    risk = pd.DataFrame([(day(d), f"{s} Comdty", v, d + 1.0) for d in range(1, 11) for s in ("TU1", "FV1") for v in variables
                         if not (s == "FV1" and 4 <= d <= 7)], columns=["date", "security", "variable", "value"])
    yields = pd.DataFrame([(day(d), None if d == 3 else 3 + d / 50, 4 - d * d / 300) for d in range(1, 11)], columns=["date", "DGS2", "DGS5"])

    def extended(out, upto):
        at = tmp_path / f"{out}-{upto}"
        at.mkdir(exist_ok=True)
        risk[risk.date <= day(upto)].to_parquet(at / "risk.parquet")
        yields[yields.date <= day(upto)].to_parquet(at / "yields.parquet")
        return stored.extended_returns(spark, str(tmp_path / out), [str(at / "risk.parquet")], [str(at / "yields.parquet")], held, ["DGS2", "DGS5"])

    whole = rows(extended("whole", 10))
    assert len(whole) == 7 + 5
    for steps in ([3, 10], [1, 2, 3, 4, 6, 8, 9, 10], [5, 5, 10, 10]):
        found = [extended("-".join(map(str, steps)), upto) for upto in steps]
        assert rows(found[-1]) == whole


def test_a_span_opens_only_its_years(spark, tmp_path):
    dates = pd.date_range("2019-11-01", "2024-02-01", freq="MS").date
    pd.DataFrame({"date": dates, "DGS2": range(len(dates))}).astype({"DGS2": float}).to_parquet(tmp_path / "yields.parquet")
    panel = stored.yield_panel(spark, str(tmp_path / "out"), [str(tmp_path / "yields.parquet")], ["DGS2"])
    span = spark.createDataFrame([(dt.date(2020, 3, 1), dt.date(2021, 2, 1))], "start_date date, end_date date")
    found = returns.within_range(panel, span)
    assert rows(found.select("date")) == [(d,) for d in dates if dt.date(2020, 3, 1) <= d <= dt.date(2021, 2, 1)]
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= [^\]]*Subquery", found._jdf.queryExecution().executedPlan().toString())
    assert len(found.inputFiles()) == 6  # the folder's; which are opened is known when the span is


def test_quotes(spark, tmp_path):
    for side, shift in (("bid", -0.1), ("eod", 0.0), ("mid", 0.0), ("offer", 0.1)):
        records = [{"Date": str(day(d)), "4-Week": 5 + d % 3 / 10 + shift, "10-Year": None if d % 2 else 4.0} for d in range(1, 31)]
        (tmp_path / f"historical_ct_yields_{side}_side.json").write_text(json.dumps(records))
    raw = stored.raw_quotes(spark, str(tmp_path / "out"), str(tmp_path), ["4-Week", "10-Year"])
    assert raw.count() == 240 and {r.tenor_days for r in raw.collect()} == {28, 3600}
    cleaned = stored.cleaned_quotes(raw, 20, 6.0)
    assert cleaned.where("tenor = '4-Week'").count() == 120 and cleaned.where("tenor = '10-Year'").count() == 60


def test_auctions_and_observed(spark, tmp_path):
    (tmp_path / "f.csv").write_text("i,j,cusip,auction_date,issue_date\n0,0,x,2024-01-02,2024-01-03\n")
    out = str(tmp_path / "out")
    filtered = stored.filtered_auctions(spark, out, str(tmp_path / "f.csv"),
                                        "i int, j int, cusip string, auction_date string, issue_date string", ["i", "j"])
    assert filtered.dtypes == [("cusip", "string"), ("auction_date", "date"), ("issue_date", "date")]
    schema = "cusip string, auction_date string, issue_date string, record_date string, security_term string, size int"
    left = spark.createDataFrame([("x", "2024-01-02", "2024-01-03", "2024-01-04", "n", 1)], schema)
    right = spark.createDataFrame([("x", "2024-01-02", "2024-01-03", "2024-01-04", "n", 2)], schema)
    found = stored.historical_auctions(spark, out, left, right, filtered.columns).collect()
    assert [(r.cusip, r.variable, r.value) for r in found] == [("x", "size", "1")]
    source = tmp_path / "observed"
    source.mkdir()
    pd.DataFrame({"Action": ["Buy"], "Description": ["s"], "last_updated": ["now"], "price": [1.5], "kind": ["n"]}).to_parquet(
        source / "market_observed_usts_auctioned_after_2005.parquet", index=False)
    found = stored.observed_securities(spark, str(source)).collect()
    assert {(r.variable, r.new_val) for r in found} == {("price", "1.5"), ("kind", "n")}
