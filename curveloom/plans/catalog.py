"""One callable per operator, over the test tables: ``(spark, folder) -> DataFrame``.

Sums and products over a window are rounded, since engines add in different orders; row-wise arithmetic is not.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.config import QUOTE_SIDES
from curveloom.functions import long_series, reshape
from curveloom.operators import auctions, compare, flies, labels, links, quotes, returns, spreads, universe
from curveloom.plans import adapters as a
from curveloom.plans import files
from curveloom.sources.store import kept

Query = Callable[[SparkSession, str], DataFrame]

# The test tables are short, so the outlier rule that shows both of its branches on them is a tighter one.
SHORT_WINDOW, SHORT_CUTOFF = 50, 4.0
TICK_WINDOW = 200


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Inputs shared by several queries.

def _panel(spark, folder):
    return returns.deliverable_panel(a.risk(spark, folder))


def _observed_universe(spark, folder):
    return universe.observed_universe(_panel(spark, folder), a.universe(spark, folder))


def _returns(spark, folder):
    return returns.synthetic_returns(a.risk(spark, folder), a.yields(spark, folder), a.universe(spark, folder))


def _nation_returns(spark, folder):
    risk, yields = a.risk(spark, folder, by_nation=True), a.yields(spark, folder, by_nation=True)
    return returns.synthetic_returns(risk, yields, a.universe(spark, folder), by=["curve"])


def _pairs(spark, folder):
    return universe.tenor_pairs(a.universe(spark, folder))


def _triples(spark, folder):
    return universe.tenor_triples(a.universe(spark, folder))


def _curve(spark, folder):
    panel = returns.with_maturity(_panel(spark, folder), a.universe(spark, folder))
    return returns.curve_join(panel, returns.yields_long(a.yields(spark, folder)))


def _steepeners(variables: Sequence[str]) -> Query:
    return lambda spark, folder: spreads.steepener_panel(_returns(spark, folder), _pairs(spark, folder), variables)


def _flies(variables: Sequence[str]) -> Query:
    return lambda spark, folder: flies.fly_panel(_returns(spark, folder), _triples(spark, folder), variables)


_steepener_durations, _steepener_returns = _steepeners(["duration"]), _steepeners(["bnd_rtn"])
_fly_durations, _fly_returns = _flies(["duration"]), _flies(["bnd_rtn"])


def _spread_legs(spark, folder):
    return spreads.return_legs(_steepener_returns(spark, folder))


def _fly_legs(spark, folder):
    return flies.return_legs(_fly_returns(spark, folder))


def _futures_cash(spark, folder):
    return compare.futures_cash_panel(a.front_prices(spark, folder), _returns(spark, folder), a.universe(spark, folder))


def _etf_returns(spark, folder):
    return compare.etf_daily_returns(a.etf_prices(spark, folder), a.etfs(spark, folder))


def _etf_panel(spark, folder):
    return compare.etf_panel(_etf_returns(spark, folder), _futures_cash(spark, folder))


def _etf_compared(spark, folder):
    return compare.etf_vs_futures_vs_cash(_etf_panel(spark, folder))


def _auctions(spark, folder):
    return auctions.typed_auctions(a.auctions_raw(spark, folder), a.AUCTION_INDEX)


def _history(source: Query) -> Query:
    return lambda spark, folder: auctions.auction_long(source(spark, folder), a.AUCTION_COLUMNS, ["row"])


_history_a, _history_b = _history(a.history_a), _history(a.history_b)


def _observed_union(spark, folder):
    return auctions.observed_union(a.vintages(spark, folder))


def _observed(spark, folder):
    return auctions.observed_long(_observed_union(spark, folder))


def _quotes(spark, folder):
    return quotes.quotes_long(a.quotes_wide(spark, folder))


def _sides(spark, folder):
    return quotes.sides_wide(_quotes(spark, folder))


def _imputed(spark, folder):
    return quotes.imputed(quotes.partial_rows(_sides(spark, folder)))


def _scored(spark, folder):
    return quotes.with_zscores(_imputed(spark, folder), SHORT_WINDOW)


# Queries that need more than one call.

def _yield_long(spark, folder):
    span = returns.date_range(_panel(spark, folder))
    return returns.within_range(returns.yields_long(a.yields(spark, folder)), span)


def _nation_spread_cumulative(spark, folder):
    by = ["curve"]
    panel = spreads.steepener_panel(_nation_returns(spark, folder), _pairs(spark, folder), ["bnd_rtn"], by)
    return _rounded(spreads.cumulative_spread(spreads.return_legs(panel, by), by), "spread_rtn")


def _strategy_labels(spark, folder):
    return labels.strategy_labels(_returns(spark, folder), a.universe(spark, folder))


def _etf_vs_fut_vs_cash(spark, folder):
    return _rounded(_etf_compared(spark, folder), "etf_rtn", "fut_rtn", "bnd_rtn", digits=6)


def _etf_comparison_long(spark, folder):
    return _rounded(compare.comparison_long(_etf_compared(spark, folder)), "value", digits=6)


def _auction_reconcile(spark, folder):
    return auctions.reconcile_auctions(_history_a(spark, folder), _history_b(spark, folder), with_conflict=True)


def _auction_reconcile_wide(spark, folder):
    left, right = (auctions.typed_auctions(h(spark, folder), ["row"]) for h in (a.history_a, a.history_b))
    return auctions.reconcile_histories(left, right, a.AUCTION_COLUMNS)


def _quote_completeness(spark, folder):
    sides = _sides(spark, folder)
    return sides.withColumn("all_missing", F.col("n_missing") == len(QUOTE_SIDES))


def _cleaned_quotes(spark, folder):
    return _rounded(quotes.cleaned_quotes(_quotes(spark, folder)), "replace_value")


def _cleaned_long_history(spark, folder):
    cleaned = quotes.cleaned_long_history(_quotes(spark, folder), SHORT_WINDOW, SHORT_CUTOFF)
    return _rounded(cleaned, "replace_value")


def _quote_wide_by_variable(spark, folder):
    cleaned = quotes.cleaned_quotes(_quotes(spark, folder), SHORT_WINDOW, SHORT_CUTOFF)
    return _rounded(quotes.cleaned_wide(cleaned), *QUOTE_SIDES)


def _page_links(spark, folder):
    return links.page_links(a.pages(spark, folder), links.site_root(F.col("url")))


def _page_file_links(spark, folder):
    return links.resolved_links(a.listings(spark, folder), F.col("url"), "xlsx", css_class="primary")


def _ticks(spark, folder, coarse=long_series.COARSE_CUTS):
    """All ticks and how their series, one per event type, are cut."""
    ticks = a.ticks(spark, folder)
    return ticks, long_series.cut(ticks, ["event_type"], "event_id", rows_per_slice=1000, coarse=coarse)


def _tick_diff(spark, folder):
    return long_series.difference(*_ticks(spark, folder), "value", "diff")


def _tick_diff_fine(spark, folder):
    """As ``tick_diff``, with so few coarse cuts that most come from a table, as those of a very long one do."""
    return long_series.difference(*_ticks(spark, folder, 3), "value", "diff")


def _tick_pct_change(spark, folder):
    return long_series.pct_change(*_ticks(spark, folder), "value", "change")


def _tick_cumulative(spark, folder):
    ticks, series = _ticks(spark, folder)
    rated = ticks.withColumn("rate", (F.col("value") - 5e1) / 1e5)
    total = long_series.cumulative(rated, series, {"cum_value": "value"}, {"growth": "rate"})
    return _rounded(total.drop("rate"), "cum_value", "growth", digits=6)


def _tick_zscore(spark, folder):
    scored = long_series.rolling_zscores(*_ticks(spark, folder), {"z_score": "value"}, TICK_WINDOW)
    return _rounded(scored, "z_score", digits=6)


QUERIES: dict[str, Query] = {
    # Risk, curve and synthetic returns
    "deliverable_panel": _panel,
    "universe": _observed_universe,
    "risk_with_maturity": lambda s, f: returns.with_maturity(_panel(s, f), a.universe(s, f)),
    "panel_date_range": lambda s, f: returns.date_range(_panel(s, f)),
    "yield_long": _yield_long,
    "curve_join": _curve,
    "yield_diff": lambda s, f: returns.yield_differences(_curve(s, f)),
    "synthetic_returns": _returns,
    "nation_returns": _nation_returns,
    # Steepeners
    "pair_universe": lambda s, f: universe.tenor_pairs(_observed_universe(s, f)),
    "pair_weights": lambda s, f: spreads.pair_weights(_returns(s, f), _pairs(s, f)),
    "steepener_panel": lambda s, f: spreads.steepener_panel(_returns(s, f), _pairs(s, f)),
    "spread_duration_legs": lambda s, f: spreads.duration_legs(_steepener_durations(s, f)),
    "spread_duration_exposure": lambda s, f: spreads.duration_exposure(_steepener_durations(s, f)),
    "spread_return_legs": _spread_legs,
    "spread_leg_cumulative": lambda s, f: _rounded(spreads.cumulative_legs(_spread_legs(s, f)), "cum_rtn"),
    "spread_cumulative": lambda s, f: _rounded(spreads.cumulative_spread(_spread_legs(s, f)), "spread_rtn"),
    "nation_spread_cumulative": _nation_spread_cumulative,
    # Flies
    "triple_universe": lambda s, f: universe.tenor_triples(_observed_universe(s, f)),
    "fly_weights": lambda s, f: flies.fly_weights(_returns(s, f), _triples(s, f)),
    "fly_panel": lambda s, f: flies.fly_panel(_returns(s, f), _triples(s, f)),
    "fly_duration_legs": lambda s, f: flies.duration_legs(_fly_durations(s, f)),
    "fly_duration_barbell": lambda s, f: flies.barbell_and_bullet(flies.duration_legs(_fly_durations(s, f))),
    "fly_duration_exposure": lambda s, f: flies.duration_exposure(flies.duration_legs(_fly_durations(s, f))),
    "fly_return_legs": _fly_legs,
    "fly_leg_cumulative": lambda s, f: _rounded(flies.cumulative_legs(_fly_legs(s, f)), "cum_rtn"),
    "fly_cumulative": lambda s, f: _rounded(flies.cumulative_fly(_fly_legs(s, f)), "fly_rtn"),
    "strategy_labels": _strategy_labels,
    # Futures and ETFs
    "fut_cash_panel": _futures_cash,
    "fut_vs_cash": lambda s, f: _rounded(compare.futures_vs_cash(_futures_cash(s, f)), "fut_rtn", "ctd_rtn", digits=6),
    "etf_daily_return": _etf_returns,
    "etf_panel": _etf_panel,
    "etf_vs_fut_vs_cash": _etf_vs_fut_vs_cash,
    "etf_comparison_long": _etf_comparison_long,
    # Auctions and observed securities
    "auction_filtered": _auctions,
    "auction_long": _history_a,
    "auction_reconcile": _auction_reconcile,
    "auction_reconcile_wide": _auction_reconcile_wide,
    "observed_union": _observed_union,
    "observed_dedup": lambda s, f: auctions.observed_dedup(_observed(s, f)),
    "observed_first": lambda s, f: auctions.observed_first(_observed(s, f)),
    "observed_reconcile": lambda s, f: auctions.reconcile_observed(_observed_union(s, f)),
    # Quotes
    "quote_ingest_long": _quotes,
    "tenor_dimension": lambda s, f: quotes.tenor_dimension(_quotes(s, f)),
    "quote_with_days": lambda s, f: quotes.with_tenor_days(_quotes(s, f)),
    "duplicate_keys": lambda s, f: reshape.duplicates(a.tick_quotes(s, f), ["date", "quote", "tenor"]),
    "quote_completeness": _quote_completeness,
    "quote_impute": lambda s, f: quotes.imputed_long(_imputed(s, f)),
    "rolling_zscore": lambda s, f: _rounded(quotes.zscores_long(_scored(s, f)), "z_score"),
    "outlier_bad_dates": lambda s, f: _rounded(quotes.bad_date_rows(_scored(s, f), SHORT_CUTOFF), "z_score"),
    "outlier_good_dates": lambda s, f: _rounded(quotes.good_date_rows(_scored(s, f), SHORT_CUTOFF), "z_score"),
    "outlier_replace": lambda s, f: _rounded(quotes.replaced(kept(_scored(s, f), "scored"), SHORT_CUTOFF), "replace_value"),
    "cleaned_quotes": _cleaned_quotes,
    "cleaned_long_history": _cleaned_long_history,
    "quote_wide_by_variable": _quote_wide_by_variable,
    # Pages
    "page_links": _page_links,
    "page_file_links": _page_file_links,
    # The same through saved files and the readers
    "read_risk_panel": files.risk_panel,
    "read_daily_quotes": files.daily_quotes,
    "read_observed": files.observed,
    "read_auctions": files.saved_auctions,
    "build_returns": files.built_returns,
    "append_returns": files.appended_returns,
    "yield_long_stored": files.stored_yields,
    # The series operators on tick histories, whose few keys each hold a large part of the rows
    "tick_diff": _tick_diff,
    "tick_diff_fine": _tick_diff_fine,
    "tick_pct_change": _tick_pct_change,
    "tick_cumulative": _tick_cumulative,
    "tick_rolling_zscore": _tick_zscore,
}
