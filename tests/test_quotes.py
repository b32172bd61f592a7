import random
import statistics

import pytest

from helpers import day, rows
from curveloom.operators import quotes

SIDES = ("bid", "eod", "mid", "offer")
SCHEMA = "date date, tenor string, bid double, eod double, mid double, offer double"


def long_quotes(spark, data):
    return quotes.to_long(spark.createDataFrame(data, SCHEMA), ["date", "tenor"], variable="quote")


def cleaned(spark, data, window, cutoff, **options):
    found = quotes.cleaned_quotes(long_quotes(spark, data), window, cutoff, **options)
    return {(r.date, r.tenor, r.variable): (r.value, r.replace_value) for r in found.collect()}


def model(data, window, cutoff):
    """The cleaning rule in plain Python, tenor by tenor and side by side."""
    result = {}
    for tenor in {r[1] for r in data}:
        table = sorted(r for r in data if r[1] == tenor and any(v is not None for v in r[2:]))
        values, scores = {}, {}
        for date, _, *quoted in table:
            known = [v for v in quoted if v is not None]
            mean = sum(known) / len(known)
            for side, v in zip(SIDES, quoted):
                values[date, side] = mean if v is None and side in ("bid", "eod") else v
        dates = [r[0] for r in table]
        for side in SIDES:
            for i in range(window - 1, len(dates)):
                frame = [values[d, side] for d in dates[i - window + 1: i + 1]]
                if None not in frame and statistics.stdev(frame) > 0:
                    scores[dates[i], side] = abs(frame[-1] - statistics.mean(frame)) / statistics.stdev(frame)
        bad = {d for (d, _), z in scores.items() if z > cutoff}
        for (date, side), value in values.items():
            z = scores.get((date, side))
            if bad and z is None:
                continue
            new = value
            if bad and z > cutoff:
                good = [values[date, s] for s in SIDES if scores.get((date, s), cutoff) < cutoff]
                new = sum(good) / len(good) if good else value
            result[date, tenor, side] = (value, new)
    return result


def random_quotes():
    """Three tenors: outliers and gaps, gaps only, and outliers on every side at once."""
    rng = random.Random(11)
    data = []
    for d in range(1, 121):
        noise = lambda: round(rng.gauss(3, 0.1), 4)
        gap = lambda v, p: None if rng.random() < p else v
        spike = 40.0 if d in (60, 90) else 0.0
        data.append((day(d), "4-Week", gap(noise() + spike, 0.1), gap(noise(), 0.1), gap(noise(), 0.02), gap(noise(), 0.02)))
        data.append((day(d), "1-Year", gap(noise(), 0.2), gap(noise(), 0.2), gap(noise(), 0.2), gap(noise(), 0.2)))
        data.append((day(d), "10-Year", *[noise() + (30.0 if d == 70 else 0.0) for _ in SIDES]))
    return data


def same(got, want):
    assert got.keys() == want.keys()
    for key, pair in want.items():
        assert got[key] == tuple(None if v is None else pytest.approx(v, rel=1e-9) for v in pair), key


def test_cleaning_against_the_model(spark):
    data = random_quotes()
    want = model(data, 20, 3.5)
    assert any(v != r for v, r in want.values())
    same(cleaned(spark, data, 20, 3.5), want)


@pytest.mark.parametrize("slices", [9, None])
def test_long_history_cleaning_against_the_model(spark, slices):
    data = random_quotes()
    found = quotes.cleaned_long_history(long_quotes(spark, data), 20, 3.5, slices=slices)
    same({(r.date, r.tenor, r.variable): (r.value, r.replace_value) for r in found.collect()}, model(data, 20, 3.5))


def test_tenor_without_outliers_keeps_all_rows(spark):
    data = [(day(d), "4-Week", 1.0 + d % 3, 2.0, None, 3.0) for d in range(1, 26)]
    got = cleaned(spark, data, 20, 6.0)
    assert len(got) == 100 and got[day(1), "4-Week", "mid"] == (None, None)


def test_outlier_without_a_good_side_keeps_its_value(spark):
    data = [(day(d), "4-Week", 1.0 + d % 2 if d < 25 else 100.0, None, None, None) for d in range(1, 26)]
    got = cleaned(spark, data, 20, 4.0, impute_sides=("bid",))
    assert got[day(25), "4-Week", "bid"] == (100.0, 100.0)
    assert min(d for d, _, _ in got) == day(20)


def test_only_bid_and_eod_are_filled(spark):
    data = [(day(1), "4-Week", None, None, None, 3.0), (day(2), "4-Week", 1.0, None, 2.0, None)]
    filled = quotes.imputed(quotes.partial_rows(quotes.sides_wide(long_quotes(spark, data))))
    assert rows(filled.select("date", *SIDES)) == [(day(1), 3.0, 3.0, None, 3.0), (day(2), 1.0, 1.5, 2.0, None)]


def test_completeness_counts_missing_sides(spark):
    """Four quotes that add up to four are not missing."""
    data = [(day(1), "4-Week", 1.0, 1.0, 1.0, 1.0), (day(2), "4-Week", None, None, None, None), (day(3), "4-Week", None, 3.0, None, None)]
    wide = quotes.sides_wide(long_quotes(spark, data))
    assert [(r.date, r.n_missing) for r in wide.orderBy("date").collect()] == [(day(1), 0), (day(2), 4), (day(3), 3)]
    assert [r.date for r in quotes.partial_rows(wide).orderBy("date").collect()] == [day(1), day(3)]
    assert [r.date for r in quotes.all_missing_rows(wide).collect()] == [day(2)]


def test_score_equal_to_the_cutoff_is_neither_replaced_nor_averaged(spark):
    data = [(day(1), "4-Week", 28, 9.0, 1.0, 5.0, 7.0, 9.0, 3.0, 1.0, None)]
    schema = ("date date, tenor string, tenor_days int, bid double, eod double, mid double, offer double, "
              "z_bid double, z_eod double, z_mid double, z_offer double")
    found = quotes.replaced(spark.createDataFrame(data, schema), 3.0)
    assert {r.variable: r.replace_value for r in found.collect()} == {"bid": 5.0, "eod": 1.0, "mid": 5.0}


def test_bad_and_good_dates_split_the_scored_rows(spark):
    scored = quotes.with_zscores(quotes.imputed(quotes.partial_rows(quotes.sides_wide(long_quotes(spark, random_quotes())))), 20)
    bad, good = quotes.bad_date_rows(scored, 3.5), quotes.good_date_rows(scored, 3.5)
    assert {r.date for r in bad.collect()} >= {day(60), day(70)}
    assert bad.count() + good.count() == quotes.zscores_long(scored).count()
    assert good.join(bad, ["date", "tenor"], "left_semi").count() == 0


def test_tenor_days(spark):
    df = spark.createDataFrame([("4-Week",), ("6-Month",), ("10-Year",), ("10-Year",)], "tenor string")
    assert {r.tenor: r.tenor_days for r in quotes.tenor_dimension(df).collect()} == {"4-Week": 28, "6-Month": 2160, "10-Year": 3600}
