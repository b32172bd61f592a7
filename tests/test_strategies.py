"""Returns, steepeners and flies on hand-computed frames."""

import random

import pytest

from helpers import by_date, day, rows
from curveloom.operators import flies, labels, returns, spreads, universe

RISK = "date date, security string, variable string, value double"
RETURNS = "date date, yield_tenor string, duration double, bnd_rtn double"
DUR, CVX = "CONVENTIONAL_CTD_FORWARD_FRSK", "FUT_EQV_CNVX_NOTL"


def risk(spark, days, security="TU1", duration=2.0, convexity=10.0):
    data = [(day(d), f"{security} Comdty", v, x) for d in days for v, x in ((DUR, duration), (CVX, convexity))]
    return spark.createDataFrame(data, RISK)


def tenors(spark):
    return universe.universe_table(spark, {"TU1": 2, "TY1": 7, "WN1": 30})


def returns_frame(spark, data):
    return spark.createDataFrame([(day(d), t, x, r) for d, t, x, r in data], RETURNS)


def test_universe_and_combinations(spark):
    full = universe.universe_table(spark)
    assert ("UXY1", 10, "DGS10") in rows(full)
    assert universe.tenor_pairs(full).count() == universe.tenor_triples(full).count() == 10
    assert rows(universe.tenor_pairs(tenors(spark)), "steepener") == [
        ("2s30s steepener", "DGS2", "DGS30"), ("2s7s steepener", "DGS2", "DGS7"), ("7s30s steepener", "DGS7", "DGS30")]
    assert rows(universe.tenor_triples(tenors(spark))) == [("2s7s30s", "DGS2", "DGS7", "DGS30")]


def test_combinations_of_any_size(spark):
    held = universe.universe_table(spark, {"A1": 2, "B1": 5, "C1": 7, "D1": 7, "E1": 30})
    four = universe.combinations(held, list("wxyz"))
    assert rows(four) == [("DGS2", "DGS5", "DGS7", "DGS30")]
    assert universe.combinations(held, ["only"]).count() == 4 and universe.combinations(held, list("vwxyz")).count() == 0
    assert rows(universe.tenor_pairs(held)) == rows(universe.tenor_pairs(held.where("security <> 'D1'")))
    assert universe.tenor_triples(held.limit(0)).count() == 0


def test_two_securities_of_a_tenor_on_a_date_are_an_error(spark):
    data = [(1, "DGS2", 2.0, 0.1), (1, "DGS7", 6.0, 0.1), (2, "DGS2", 2.0, 0.1), (2, "DGS7", 6.0, 0.1), (1, "DGS2", 2.0, 0.1)]
    twice, combos = returns_frame(spark, data), universe.tenor_pairs(tenors(spark))
    for found in (spreads.steepener_panel(twice, combos, ["duration"]), labels.strategy_labels(twice, universe.universe_table(spark))):
        with pytest.raises(Exception, match="repeated"):
            found.collect()


def test_labels_are_those_of_the_panels(spark):
    tenors, rng = universe.universe_table(spark), random.Random(4)
    names = [r.yield_tenor for r in tenors.collect()]
    for _ in range(6):
        data = [(day(d), n, rng.choice([0.0, 2.0, 2.0, 3.0])) for d in range(1, 5) for n in names if rng.random() < 0.4]
        frame = spark.createDataFrame(data, "date date, yield_tenor string, duration double")
        panels = [spreads.steepener_panel(frame, universe.tenor_pairs(tenors), ["duration"]).selectExpr("steepener AS label"),
                  flies.fly_panel(frame, universe.tenor_triples(tenors), ["duration"]).selectExpr("fly AS label")]
        assert rows(labels.strategy_labels(frame, tenors)) == rows(panels[0].unionByName(panels[1]).distinct())


def test_observed_universe_is_what_the_panel_holds(spark):
    panel = returns.deliverable_panel(risk(spark, [1, 2], "TY1").union(risk(spark, [1], "XX1")))
    assert [r.security for r in universe.observed_universe(panel, tenors(spark)).collect()] == ["TY1"]


def test_panel_drops_incomplete_rows_and_ignores_other_variables(spark):
    more = [(day(3), "TU1 Comdty", DUR, 1.0), (day(1), "TU1 Comdty", "OTHER", 9.0)]
    panel = returns.deliverable_panel(risk(spark, [1, 2]).union(spark.createDataFrame(more, RISK)))
    assert rows(panel) == [(day(1), "TU1", 2.0, 10.0), (day(2), "TU1", 2.0, 10.0)]


def test_synthetic_returns(spark):
    """A missing yield costs its own date and the next one; days off the panel's dates never match."""
    yields = spark.createDataFrame(
        [(day(1), 3.0), (day(2), 3.6), (day(3), None), (day(4), 4.0), (day(5), 4.5), (day(9), 5.0)], "date date, DGS2 double")
    found = returns.synthetic_returns(risk(spark, range(1, 6)), yields, tenors(spark))
    assert set(found.columns) == {
        "date", "yield_tenor", "duration", "convexity", "yld", "yld_diff", "dur_rtn", "cvx_rtn", "bnd_rtn"}
    got = by_date(found, "yield_tenor", "yld", "yld_diff", "dur_rtn", "cvx_rtn", "bnd_rtn")
    assert set(got) == {day(2), day(5)}
    assert got[day(2)] == ("DGS2", pytest.approx(0.036), pytest.approx(0.006), pytest.approx(-0.012),
                           pytest.approx(0.00018), pytest.approx(0.0001 - 0.012 + 0.00018))


def test_extra_key_separates_curves(spark):
    from pyspark.sql import functions as F
    one = risk(spark, [1, 2], duration=2.0).withColumn("curve", F.lit("x"))
    two = risk(spark, [1, 2], duration=4.0).withColumn("curve", F.lit("y"))
    yields = spark.createDataFrame(
        [("x", day(1), 1.0), ("x", day(2), 2.0), ("y", day(1), 1.0), ("y", day(2), 4.0)], "curve string, date date, DGS2 double")
    found = returns.synthetic_returns(one.union(two), yields, tenors(spark), by=["curve"])
    assert {(r.curve, round(r.dur_rtn, 9)) for r in found.collect()} == {("x", -0.02), ("y", -0.12)}


def test_date_range_filter(spark):
    panel = returns.deliverable_panel(risk(spark, [3, 5]))
    yields = spark.createDataFrame([(day(d), float(d)) for d in range(1, 8)], "date date, DGS2 double")
    kept = returns.within_range(returns.yields_long(yields), returns.date_range(panel))
    assert sorted(r.date for r in kept.collect()) == [day(3), day(4), day(5)]


def pair(spark):
    """The long leg is absent on day 3, the short leg on day 5."""
    return returns_frame(spark, [
        (1, "DGS2", 2.0, 0.1), (1, "DGS7", 6.0, 0.2), (2, "DGS2", 2.0, 0.1), (2, "DGS7", 8.0, 0.2),
        (3, "DGS7", 8.0, 0.3), (4, "DGS2", 2.0, 0.1), (4, "DGS7", 6.0, 0.2), (5, "DGS2", 4.0, 0.5)])


def pairs(spark):
    return universe.tenor_pairs(tenors(spark)).where("steepener = '2s7s steepener'")


def test_pair_weights_lag_over_the_union_of_dates(spark):
    """Day 4 has no weights, since day 3 lacks a leg; day 3 has, from day 2."""
    found = spreads.pair_weights(pair(spark), pairs(spark))
    got = {(r.date, r.yield_tenor): r.weight for r in found.collect()}
    assert set(d for d, _ in got) == {day(2), day(3), day(5)}
    assert got[day(2), "DGS2"] == pytest.approx(0.75) and got[day(2), "DGS7"] == pytest.approx(0.25)
    assert got[day(3), "DGS2"] == pytest.approx(0.8)
    for d in (2, 3, 5):
        assert got[day(d), "DGS2"] + got[day(d), "DGS7"] == pytest.approx(1.0)


def test_steepener_keeps_one_legged_dates(spark):
    panel = spreads.steepener_panel(pair(spark), pairs(spark), ["bnd_rtn"])
    got = by_date(panel, "long_weight", "short_weight", "long_val", "short_val")
    assert got[day(3)] == (None, pytest.approx(0.2), None, 0.3)
    assert got[day(5)] == (pytest.approx(0.75), None, 0.5, None)
    legs = spreads.return_legs(panel)
    assert by_date(legs, "long_rtn", "short_rtn")[day(3)] == (None, pytest.approx(0.06))
    net = by_date(spreads.cumulative_spread(legs), "spread_rtn")
    assert net == {day(2): (pytest.approx(0.025),), day(3): (None,), day(5): (None,)}
    cumulative = {(r.date, r.leg): r.cum_rtn for r in spreads.cumulative_legs(legs).collect()}
    assert cumulative[day(3), "Long"] is None and cumulative[day(5), "Long"] == pytest.approx(0.075 + 0.375)
    assert cumulative[day(3), "Short"] == pytest.approx(0.05 + 0.06)


def test_pair_is_duration_neutral_at_the_lagged_durations(spark):
    panel = spreads.weighted_pairs(pair(spark), pairs(spark), ["duration"])
    weights = by_date(panel, "long_weight", "short_weight")
    assert weights[day(2)][0] * 2.0 == pytest.approx(weights[day(2)][1] * 6.0)


def test_zero_duration_gives_no_weight(spark):
    data = returns_frame(spark, [(1, "DGS2", 0.0, 0.1), (1, "DGS7", 6.0, 0.1), (2, "DGS2", 2.0, 0.1), (2, "DGS7", 6.0, 0.1)])
    assert spreads.pair_weights(data, pairs(spark)).count() == 0


def fly(spark):
    """The bullet is absent on day 2."""
    data = [(d, t, x, r) for d in (1, 2, 3, 4) for t, x, r in
            (("DGS2", 2.0, 0.1), ("DGS7", 5.0 + d, 0.2), ("DGS30", 18.0, 0.4)) if (d, t) != (2, "DGS7")]
    return returns_frame(spark, data)


def test_fly_weights_drop_incomplete_dates_before_the_lag(spark):
    """Day 3 takes its weights from day 1, the complete date before it."""
    found = flies.fly_weights(fly(spark), universe.tenor_triples(tenors(spark)))
    got = by_date(found, "short_weight", "long_weight", "bullet_weight")
    assert set(got) == {day(3), day(4)}
    assert got[day(3)] == (pytest.approx(0.5 * 12 / 16), pytest.approx(0.5 * 4 / 16), 0.5)
    assert got[day(4)] == (pytest.approx(0.5 * 10 / 16), pytest.approx(0.5 * 6 / 16), 0.5)
    assert got[day(4)][0] * 2 + got[day(4)][1] * 18 == pytest.approx(0.5 * 8)


def test_fly_panel_and_legs(spark):
    panel = flies.fly_panel(fly(spark), universe.tenor_triples(tenors(spark)), ["bnd_rtn", "duration"])
    assert panel.count() == 4
    legs = flies.return_legs(panel)
    barbell = 0.375 * 0.1 + 0.125 * 0.4
    assert by_date(legs, "Barbell", "Bullet")[day(3)] == (pytest.approx(barbell), pytest.approx(0.1))
    exposure = flies.duration_exposure(flies.duration_legs(panel))
    assert by_date(exposure, "duration_exposure")[day(4)][0] == pytest.approx(0.3125 * 2 + 0.1875 * 18 - 0.5 * 9)
    net = by_date(flies.cumulative_fly(legs), "fly_rtn")
    barbell_4 = 0.3125 * 0.1 + 0.1875 * 0.4
    assert net[day(4)][0] == pytest.approx((barbell - 0.1) + (barbell_4 - 0.1))
    assert {r.leg for r in flies.cumulative_legs(legs).collect()} == {"Barbell", "Bullet"}


def test_fly_panel_drops_incomplete_variables(spark):
    broken = fly(spark).replace({0.2: None}, subset=["bnd_rtn"])
    panel = flies.fly_panel(broken, universe.tenor_triples(tenors(spark)), ["bnd_rtn", "duration"])
    assert {r.variable for r in panel.collect()} == {"duration"}


def test_equal_outer_durations_give_no_fly_weights(spark):
    data = returns_frame(spark, [(d, t, x, 0.1) for d in (1, 2) for t, x in (("DGS2", 5.0), ("DGS7", 6.0), ("DGS30", 5.0))])
    assert flies.fly_weights(data, universe.tenor_triples(tenors(spark))).count() == 0
