import pytest

from helpers import by_date, day, rows
from curveloom.operators import compare, universe

PRICES = "date date, security string, PX_LAST double"
RETURNS = "date date, yield_tenor string, bnd_rtn double"


def prices(spark, data):
    return spark.createDataFrame([(day(d), f"{s} Comdty", p) for d, s, p in data], PRICES)


def cash(spark, data):
    return spark.createDataFrame([(day(d), t, r) for d, t, r in data], RETURNS)


def panel(spark):
    """The futures price of day 2 has no cash return, so the change of day 3 is taken from day 1."""
    px = prices(spark, [(1, "TU1", 100.0), (2, "TU1", 300.0), (3, "TU1", 110.0), (4, "TU1", 121.0)])
    return compare.futures_cash_panel(
        px, cash(spark, [(1, "DGS2", 0.1), (3, "DGS2", 0.2), (4, "DGS2", 0.3)]), universe.universe_table(spark))


def test_futures_changes_run_over_joined_rows(spark):
    got = by_date(compare.futures_vs_cash(panel(spark)), "fut_rtn", "ctd_rtn")
    assert got == {
        day(1): (None, pytest.approx(0.1)), day(3): (pytest.approx(0.1), pytest.approx(0.3)),
        day(4): (pytest.approx(0.21), pytest.approx(0.6))}


def etf_prices(spark, shy, ief):
    data = [(day(i), a, b) for i, (a, b) in enumerate(zip(shy, ief), 1)]
    return spark.createDataFrame(data, "date date, SHY double, IEF double")


def test_etf_returns_pad_gaps_and_start_after_the_listing(spark):
    wide = etf_prices(spark, [None, 10.0, None, 12.0], [1.0, 2.0, 2.0, 3.0])
    found = compare.etf_daily_returns(wide, universe.etf_table(spark))
    got = {(r.date, r.ticker, r.yield_tenor): r.etf_rtn for r in found.collect()}
    assert {d for d, t, _ in got if t == "SHY"} == {day(3), day(4)}
    assert got[day(3), "SHY", "DGS2"] == 0.0 and got[day(4), "SHY", "DGS2"] == pytest.approx(0.2)
    assert {y for _, t, y in got if t == "IEF"} == {"DGS10", "DSG7"}


def test_etf_changes_use_the_full_calendar_but_compound_over_joined_dates(spark):
    wide = etf_prices(spark, [10.0, 20.0, 30.0, 33.0], [1.0] * 4)
    etf = compare.etf_daily_returns(wide, universe.etf_table(spark))
    found = compare.etf_vs_futures_vs_cash(compare.etf_panel(etf, panel(spark)))
    got = by_date(found, "ticker", "etf_rtn", "fut_rtn", "bnd_rtn")
    # day 2 is not joined, so its doubling is lost; day 3 compounds 1.5, day 4 adds 10%
    assert got == {
        day(3): ("SHY", pytest.approx(0.5), None, pytest.approx(0.2)),
        day(4): ("SHY", pytest.approx(0.65), pytest.approx(0.1), pytest.approx(0.5))}
    long = compare.comparison_long(found)
    assert {r.series for r in long.collect()} == {"ETF", "FUT", "BND"}


def test_misspelled_tenor_has_no_etf_until_the_map_is_corrected(spark):
    px = prices(spark, [(d, "TY1", 100.0 + d) for d in (1, 2, 3)])
    joined = compare.futures_cash_panel(px, cash(spark, [(d, "DGS7", 0.1) for d in (1, 2, 3)]), universe.universe_table(spark))
    wide = etf_prices(spark, [1.0] * 3, [1.0, 2.0, 4.0])
    default = compare.etf_daily_returns(wide, universe.etf_table(spark))
    assert compare.etf_panel(default, joined).count() == 0
    corrected = compare.etf_daily_returns(wide, universe.etf_table(spark, {"DGS7": "IEF", "DGS10": "IEF"}))
    assert compare.etf_panel(corrected, joined).count() == 2


def test_series_are_per_ticker_even_over_two_tenors(spark):
    """Two tenors of one ticker share a series, ordered by date and then tenor."""
    data = [(day(d), "IEF", t, 0.0, p, 1.0) for d, t, p in
            ((2, "DGS10", 10.0), (2, "DGS7", 20.0), (3, "DGS10", 40.0), (3, "DGS7", 80.0))]
    both = spark.createDataFrame(data, "date date, ticker string, yield_tenor string, etf_rtn double, PX_LAST double, bnd_rtn double")
    got = rows(compare.etf_vs_futures_vs_cash(both).select("date", "yield_tenor", "fut_rtn", "bnd_rtn"))
    assert got == [(day(2), "DGS10", None, 1.0), (day(2), "DGS7", 1.0, 2.0), (day(3), "DGS10", 3.0, 3.0), (day(3), "DGS7", 7.0, 4.0)]
