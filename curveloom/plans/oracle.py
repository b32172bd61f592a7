"""SQL that states each query independently of the DataFrame code, for the cross-engine check.

It is written the long way round (long tables, correlated flags, windows per side) where the DataFrames
work on wide rows.
"""

# Shared tables: name -> (tables it reads, definition).
TABLES: dict[str, tuple[str, str]] = {
    "universe": ("", """
        SELECT * FROM (VALUES ('TU1', 2, 'DGS2'), ('FV1', 5, 'DGS5'), ('TY1', 7, 'DGS7'), ('UXY1', 10, 'DGS10'),
            ('WN1', 30, 'DGS30')) AS t(security, maturity, yield_tenor)"""),
    "etfs": ("", """
        SELECT * FROM (VALUES ('DGS2', 'SHY'), ('DGS10', 'IEF'), ('DGS5', 'IEI'), ('DGS30', 'TLT'), ('DSG7', 'IEF'))
            AS t(yield_tenor, ticker)"""),
    "daily": ("", """
        SELECT cast(o_orderdate AS date) AS date,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'TU1 Comdty' WHEN '2-HIGH' THEN 'FV1 Comdty'
                WHEN '3-MEDIUM' THEN 'TY1 Comdty' WHEN '4-NOT SPECIFIED' THEN 'UXY1 Comdty' ELSE 'WN1 Comdty' END AS security,
            CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 5 WHEN '3-MEDIUM' THEN 7
                WHEN '4-NOT SPECIFIED' THEN 10 ELSE 30 END AS years,
            max(o_totalprice) AS high, min(o_totalprice) AS low
        FROM orders GROUP BY 1, 2, 3"""),
    "risk": ("daily", """
        SELECT date, security, 'CONVENTIONAL_CTD_FORWARD_FRSK' AS variable, years * 8e-1 + high / 1e6 AS value FROM daily
        UNION ALL
        SELECT date, security, 'FUT_EQV_CNVX_NOTL', years * years / 1e2 + low / 1e6 FROM daily
        WHERE NOT (years = 30 AND day(date) = 1)"""),
    "panel": ("risk", """
        SELECT d.date, split_part(d.security, ' ', 1) AS security, d.value AS duration, c.value AS convexity
        FROM risk d JOIN risk c ON c.date = d.date AND c.security = d.security
        WHERE d.variable = 'CONVENTIONAL_CTD_FORWARD_FRSK' AND c.variable = 'FUT_EQV_CNVX_NOTL'"""),
    "panel_maturity": ("panel universe", """
        SELECT p.*, u.maturity FROM panel p JOIN universe u ON u.security = p.security"""),
    "yields": ("", """
        SELECT date, 'DGS' || n AS yield_tenor, min(price) / 2e4 + 1e-1 AS yield, n AS maturity
        FROM (SELECT d.date, s.n, l.l_extendedprice AS price
            FROM (SELECT DISTINCT cast(l_shipdate AS date) AS date FROM lineitem) d
            CROSS JOIN (VALUES (0, 2), (1, 5), (2, 7), (3, 10), (4, 30)) AS s(k, n)
            LEFT JOIN lineitem l ON cast(l.l_shipdate AS date) = d.date AND l.l_linenumber % 5 = s.k)
        GROUP BY date, n"""),
    "curve": ("panel_maturity yields", """
        SELECT p.date, p.maturity, p.security, p.duration, p.convexity, y.yield_tenor, y.yield
        FROM panel_maturity p JOIN yields y ON y.date = p.date AND y.maturity = p.maturity"""),
    "diffs": ("curve", """
        SELECT * FROM (
            SELECT date, maturity, security, duration, convexity, yield_tenor, yield / 100 AS yld,
                yield / 100 - lag(yield / 100) OVER (PARTITION BY security ORDER BY date) AS yld_diff FROM curve)
        WHERE yld IS NOT NULL AND yld_diff IS NOT NULL"""),
    "rets": ("diffs", """
        SELECT *, yld / 360 + dur_rtn + cvx_rtn AS bnd_rtn FROM (
            SELECT date, duration, convexity, yield_tenor, yld, yld_diff, -yld_diff * duration AS dur_rtn,
                0.5::DOUBLE * (yld_diff * yld_diff) * convexity AS cvx_rtn FROM diffs)"""),
    "held": ("universe panel", "SELECT * FROM universe WHERE security IN (SELECT security FROM panel)"),
    "pairs": ("universe", """
        SELECT a.maturity || 's' || b.maturity || 's steepener' AS steepener, a.yield_tenor AS long, b.yield_tenor AS short
        FROM universe a JOIN universe b ON a.maturity < b.maturity"""),
    "pair_dates": ("pairs rets", """
        SELECT DISTINCT p.*, r.date FROM pairs p JOIN rets r ON r.yield_tenor IN (p.long, p.short)"""),
    "pair_lags": ("pair_dates rets", """
        SELECT d.*, lag(1 / l.duration) OVER w AS inv_long, lag(1 / s.duration) OVER w AS inv_short
        FROM pair_dates d LEFT JOIN rets l ON l.date = d.date AND l.yield_tenor = d.long
            LEFT JOIN rets s ON s.date = d.date AND s.yield_tenor = d.short
        WINDOW w AS (PARTITION BY d.steepener ORDER BY d.date)"""),
    "pair_w": ("pair_lags", """
        SELECT date, steepener, long, short, inv_long / (inv_long + inv_short) AS w_long, inv_short / (inv_long + inv_short) AS w_short
        FROM pair_lags WHERE inv_long IS NOT NULL AND inv_short IS NOT NULL"""),
    "nation_daily": ("", """
        SELECT c.c_nationkey AS curve, cast(o.o_orderdate AS date) AS date,
            CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 5 WHEN '3-MEDIUM' THEN 7
                WHEN '4-NOT SPECIFIED' THEN 10 ELSE 30 END AS years,
            max(o_totalprice) AS high, min(o_totalprice) AS low
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2, 3"""),
    "nation_yields": ("", """
        SELECT curve, date, n AS years, min(price) / 2e4 + 1e-1 AS yield
        FROM (SELECT d.curve, d.date, s.n, l.l_extendedprice AS price
            FROM (SELECT DISTINCT s_nationkey AS curve, cast(l_shipdate AS date) AS date
                FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) d
            CROSS JOIN (VALUES (0, 2), (1, 5), (2, 7), (3, 10), (4, 30)) AS s(k, n)
            LEFT JOIN (SELECT * FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) l
                ON l.s_nationkey = d.curve AND cast(l.l_shipdate AS date) = d.date AND l.l_linenumber % 5 = s.k)
        GROUP BY curve, date, n"""),
    "nation_rets": ("nation_daily nation_yields", """
        SELECT *, yld / 360 + dur_rtn + cvx_rtn AS bnd_rtn FROM (
            SELECT *, -yld_diff * duration AS dur_rtn, 0.5::DOUBLE * (yld_diff * yld_diff) * convexity AS cvx_rtn FROM (
                SELECT d.curve, d.date, d.years * 8e-1 + d.high / 1e6 AS duration,
                    d.years * d.years / 1e2 + d.low / 1e6 AS convexity, 'DGS' || d.years AS yield_tenor, y.yield / 100 AS yld,
                    y.yield / 100 - lag(y.yield / 100) OVER (PARTITION BY d.curve, d.years ORDER BY d.date) AS yld_diff
                FROM nation_daily d JOIN nation_yields y ON y.curve = d.curve AND y.date = d.date AND y.years = d.years
                WHERE NOT (d.years = 30 AND day(d.date) = 1))
            WHERE yld IS NOT NULL AND yld_diff IS NOT NULL)"""),
    "nation_lags": ("nation_rets pairs", """
        SELECT d.*, l.bnd_rtn AS long_rtn, s.bnd_rtn AS short_rtn, lag(1 / l.duration) OVER w AS inv_long,
            lag(1 / s.duration) OVER w AS inv_short
        FROM (SELECT DISTINCT p.*, r.curve, r.date FROM pairs p JOIN nation_rets r ON r.yield_tenor IN (p.long, p.short)) d
            LEFT JOIN nation_rets l ON l.curve = d.curve AND l.date = d.date AND l.yield_tenor = d.long
            LEFT JOIN nation_rets s ON s.curve = d.curve AND s.date = d.date AND s.yield_tenor = d.short
        WINDOW w AS (PARTITION BY d.curve, d.steepener ORDER BY d.date)"""),
    "nation_spreads": ("nation_lags", """
        SELECT curve, date, steepener, inv_long / (inv_long + inv_short) * long_rtn
            - inv_short / (inv_long + inv_short) * short_rtn AS net
        FROM nation_lags WHERE inv_long IS NOT NULL AND inv_short IS NOT NULL"""),
    "ret_long": ("rets", """
        SELECT * FROM rets UNPIVOT (value FOR var IN (duration, convexity, yld, yld_diff, dur_rtn, cvx_rtn, bnd_rtn))"""),
    "steepeners": ("pair_w ret_long", """
        SELECT w.date, max(CASE WHEN r.yield_tenor = w.long THEN w_long END) AS long_weight,
            max(CASE WHEN r.yield_tenor = w.short THEN w_short END) AS short_weight, r.var,
            max(CASE WHEN r.yield_tenor = w.long THEN r.value END) AS long_val,
            max(CASE WHEN r.yield_tenor = w.short THEN r.value END) AS short_val, w.steepener
        FROM pair_w w JOIN ret_long r ON r.date = w.date AND r.yield_tenor IN (w.long, w.short)
        GROUP BY w.date, w.steepener, r.var"""),
    "spread_legs": ("steepeners", """
        SELECT date, steepener, long_weight * long_val AS long_rtn, short_weight * short_val AS short_rtn
        FROM steepeners WHERE var = 'bnd_rtn'"""),
    "triples": ("universe", """
        SELECT a.maturity || 's' || b.maturity || 's' || c.maturity || 's' AS fly, a.yield_tenor AS short,
            b.yield_tenor AS bullet, c.yield_tenor AS long
        FROM universe a JOIN universe b ON a.maturity < b.maturity JOIN universe c ON b.maturity < c.maturity"""),
    "fly_durations": ("triples rets", """
        SELECT t.*, s.date, s.duration AS s, b.duration AS b, l.duration AS l
        FROM triples t JOIN rets s ON s.yield_tenor = t.short
            JOIN rets b ON b.yield_tenor = t.bullet AND b.date = s.date
            JOIN rets l ON l.yield_tenor = t.long AND l.date = s.date"""),
    "fly_w": ("fly_durations", """
        SELECT * FROM (
            SELECT fly, short, bullet, long, date, lag(0.5::DOUBLE * (l - b) / (l - s)) OVER w AS short_weight,
                lag(0.5::DOUBLE * (b - s) / (l - s)) OVER w AS long_weight, lag(0.5::DOUBLE) OVER w AS bullet_weight
            FROM fly_durations WINDOW w AS (PARTITION BY fly ORDER BY date))
        WHERE bullet_weight IS NOT NULL"""),
    "flies": ("fly_w ret_long", """
        SELECT w.date, b.var AS variable, b.value AS bullet_val, l.value AS long_val, s.value AS short_val,
            w.short_weight, w.long_weight, w.bullet_weight, w.fly
        FROM fly_w w JOIN ret_long b ON b.date = w.date AND b.yield_tenor = w.bullet
            JOIN ret_long l ON l.date = w.date AND l.yield_tenor = w.long AND l.var = b.var
            JOIN ret_long s ON s.date = w.date AND s.yield_tenor = w.short AND s.var = b.var"""),
    "fly_dur": ("flies", """
        SELECT date, fly, bullet_weight * bullet_val AS bullet, long_weight * long_val AS long,
            short_weight * short_val AS short FROM flies WHERE variable = 'duration'"""),
    "fly_legs": ("flies", """
        SELECT date, fly, bullet_weight * bullet_val AS "Bullet",
            long_weight * long_val + short_weight * short_val AS "Barbell" FROM flies WHERE variable = 'bnd_rtn'"""),
    "prices": ("", """
        SELECT cast(l_shipdate AS date) AS date, CASE l_linenumber % 5 WHEN 0 THEN 'TU1' WHEN 1 THEN 'FV1' WHEN 2 THEN 'TY1'
            WHEN 3 THEN 'UXY1' ELSE 'WN1' END AS security, max(l_extendedprice) / 1e3 AS "PX_LAST"
        FROM lineitem GROUP BY 1, 2"""),
    "fut": ("prices universe rets", """
        SELECT p.security, p."PX_LAST", r.* FROM prices p JOIN universe u ON u.security = p.security
            JOIN rets r ON r.date = p.date AND r.yield_tenor = u.yield_tenor"""),
    "etf_px": ("", """
        SELECT date, ticker, max(CASE WHEN ticker <> 'TLT' OR NOT (date < DATE '1996-01-01'
            OR date BETWEEN DATE '1998-03-10' AND DATE '1998-03-20') THEN l_extendedprice END) / 1e3 AS price
        FROM (SELECT d.date, t.ticker, l.l_extendedprice
            FROM (SELECT DISTINCT cast(l_shipdate AS date) AS date FROM lineitem) d
            CROSS JOIN (VALUES (0, 'SHY'), (1, 'IEI'), (2, 'IEF'), (3, 'TLT')) AS t(k, ticker)
            LEFT JOIN lineitem l ON cast(l.l_shipdate AS date) = d.date AND l.l_suppkey % 4 = t.k)
        GROUP BY date, ticker"""),
    "etf_ret": ("etf_px etfs", """
        SELECT r.date, r.ticker, r.etf_rtn, e.yield_tenor FROM (
            SELECT date, ticker, p / lag(p) OVER (PARTITION BY ticker ORDER BY date) - 1 AS etf_rtn FROM (
                SELECT date, ticker, last_value(price IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date) AS p
                FROM etf_px)) r
            JOIN etfs e ON e.ticker = r.ticker WHERE r.etf_rtn IS NOT NULL"""),
    "etf_joined": ("etf_ret fut", """
        SELECT e.ticker, e.etf_rtn, f.* FROM etf_ret e JOIN fut f ON f.date = e.date AND f.yield_tenor = e.yield_tenor"""),
    "etf_cum": ("etf_joined", """
        SELECT * EXCLUDE (etf_rtn, bnd_rtn, move), round(product(1 + etf_rtn) OVER w - 1, 6) AS etf_rtn,
            CASE WHEN move IS NOT NULL THEN round(product(1 + move) OVER w - 1, 6) END AS fut_rtn,
            round(sum(bnd_rtn) OVER w, 6) AS bnd_rtn
        FROM (SELECT *, "PX_LAST" / lag("PX_LAST") OVER (PARTITION BY ticker ORDER BY date) - 1 AS move FROM etf_joined)
        WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)"""),
    "auction_ids": ("", """
        SELECT *, cast(p_partkey AS varchar) AS cusip, DATE '2000-01-01' + p_size AS auction_date,
            DATE '2000-01-01' + p_size + 3 AS issue_date, DATE '2024-01-01' AS record_date, p_type AS security_term,
            cast(round(p_retailprice * 100) AS bigint) AS cents FROM part"""),
    "history_a": ("auction_ids", """
        SELECT cusip, auction_date, issue_date, record_date, security_term, 'size' AS variable,
            cast(p_size AS varchar) AS value FROM auction_ids
        UNION ALL SELECT cusip, auction_date, issue_date, record_date, security_term, 'price', cast(cents AS varchar)
        FROM auction_ids WHERE p_type <> 'ECONOMY'"""),
    "history_b": ("auction_ids", """
        SELECT cusip, auction_date, issue_date, record_date, security_term, 'size' AS variable,
            cast(p_size AS varchar) AS value FROM auction_ids WHERE p_brand <> 'Brand#4'
        UNION ALL SELECT cusip, auction_date, issue_date, record_date, security_term, 'price',
            cast(cents + CASE WHEN p_size <= 10 THEN 1 ELSE 0 END AS varchar) FROM auction_ids WHERE p_type <> 'PROMO'"""),
    "observed_orders": ("", """
        SELECT *, cast(o_custkey AS varchar) AS cust, cast(year(o_orderdate) AS double) AS yr,
            cast(month(o_orderdate) AS double) AS mon FROM orders"""),
    "observed_wide": ("observed_orders", """
        SELECT o_orderstatus AS "Action", cust AS "Description", o_orderpriority AS last_updated, yr AS year,
            CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price, cast(NULL AS double) AS month,
            'auctioned_after_2000' AS "group" FROM observed_orders WHERE o_orderdate >= DATE '1995-01-01'
        UNION ALL SELECT o_orderstatus, cust, o_orderpriority, yr,
            o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END, NULL, 'auctioned_after_2005'
        FROM observed_orders WHERE o_orderdate >= DATE '1997-01-01'
        UNION ALL SELECT o_orderstatus, cust, o_orderpriority, yr, o_totalprice, mon, 'auctioned_after_2010'
        FROM observed_orders WHERE o_orderdate >= DATE '1999-01-01'"""),
    "observed": ("observed_wide", """
        SELECT * FROM observed_wide UNPIVOT (value FOR variable IN (year, price, month))"""),
    "observed_one": ("observed", """
        SELECT "Action", "Description", "group", last_updated, variable, value FROM (
            SELECT *, row_number() OVER (PARTITION BY "Action", "Description", "group", last_updated, variable
                ORDER BY value) AS rn FROM (SELECT DISTINCT * FROM observed)) WHERE rn = 1"""),
    "tick_quotes": ("", """
        SELECT date_trunc('hour', ts) AS date, CASE event_id % 4 WHEN 0 THEN 'bid' WHEN 1 THEN 'eod'
            WHEN 2 THEN 'mid' ELSE 'offer' END AS quote,
            CASE user_id % 4 WHEN 0 THEN '4-Week' WHEN 1 THEN '1-Year' WHEN 2 THEN '10-Year' ELSE '30-Year' END AS tenor, value
        FROM events"""),
    "quotes": ("tick_quotes", """
        SELECT d.date, d.quote, t.tenor, max(q.value) AS value FROM (SELECT DISTINCT date, quote FROM tick_quotes) d
            CROSS JOIN (VALUES ('4-Week'), ('1-Year'), ('10-Year'), ('30-Year')) AS t(tenor)
            LEFT JOIN tick_quotes q ON q.date = d.date AND q.quote = d.quote AND q.tenor = t.tenor
        GROUP BY d.date, d.quote, t.tenor"""),
    "days": ("quotes", """
        SELECT DISTINCT tenor, cast(split_part(tenor, '-', 1) AS int)
            * CASE WHEN split_part(tenor, '-', 2) = 'Week' THEN 7 ELSE 360 END AS tenor_days FROM quotes"""),
    "sides": ("quotes days", """
        SELECT q.date, d.tenor_days, q.tenor, max(CASE WHEN quote = 'bid' THEN value END) AS bid,
            max(CASE WHEN quote = 'eod' THEN value END) AS eod, max(CASE WHEN quote = 'mid' THEN value END) AS mid,
            max(CASE WHEN quote = 'offer' THEN value END) AS offer, cast(4 - count(value) AS int) AS n_missing
        FROM quotes q JOIN days d ON d.tenor = q.tenor GROUP BY q.date, d.tenor_days, q.tenor"""),
    "side_avg": ("sides", """
        SELECT *, (coalesce(bid, 0) + coalesce(eod, 0) + coalesce(mid, 0) + coalesce(offer, 0)) / (4 - n_missing) AS avg
        FROM sides WHERE n_missing < 4"""),
    "filled": ("side_avg", """
        SELECT date, tenor_days, tenor, 'bid' AS variable, coalesce(bid, avg) AS value FROM side_avg
        UNION ALL SELECT date, tenor_days, tenor, 'eod', coalesce(eod, avg) FROM side_avg
        UNION ALL SELECT date, tenor_days, tenor, 'mid', mid FROM side_avg
        UNION ALL SELECT date, tenor_days, tenor, 'offer', offer FROM side_avg"""),
}


def _scores(name: str, rows: int, cutoff: str) -> dict[str, tuple[str, str]]:
    """Tables for one outlier rule: z-scores, flagged rows, replaced rows."""
    return {
        f"z_{name}": ("filled", f"""
            SELECT date, tenor_days, tenor, variable, value, CASE WHEN n = {rows} AND sd > 0 THEN abs((value - mean) / sd) END AS z
            FROM (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd FROM filled
                WINDOW w AS (PARTITION BY tenor, variable ORDER BY date ROWS {rows - 1} PRECEDING))"""),
        f"flags_{name}": (f"z_{name}", f"""
            SELECT *, coalesce(max(z) OVER (PARTITION BY tenor, date) > {cutoff}, false) AS bad,
                avg(CASE WHEN z < {cutoff} THEN value END) OVER (PARTITION BY tenor, date) AS good_mean FROM z_{name}"""),
        f"replaced_{name}": (f"flags_{name}", f"""
            SELECT date, tenor_days, tenor, variable, value,
                round(CASE WHEN z > {cutoff} THEN coalesce(good_mean, value) ELSE value END, 9) AS replace_value
            FROM (SELECT *, bool_or(bad) OVER (PARTITION BY tenor) AS tenor_bad FROM flags_{name})
            WHERE z IS NOT NULL OR NOT tenor_bad"""),
    }


TABLES |= _scores("short", 50, "4") | _scores("long", 200, "6")

_Z = "date, tenor_days, tenor, variable, value, round(z, 9) AS z_score"
_TICKS = "SELECT event_type, event_id, CASE WHEN value >= 1 THEN value END AS value FROM events"
_BY_EVENT = "PARTITION BY event_type ORDER BY event_id"

# Query name -> (shared tables it reads, final select).
SELECTS: dict[str, tuple[str, str]] = {
    "deliverable_panel": ("panel", "SELECT * FROM panel"),
    "universe": ("held", "SELECT * FROM held"),
    "risk_with_maturity": ("panel_maturity", "SELECT * FROM panel_maturity"),
    "panel_date_range": ("panel", "SELECT min(date) AS start_date, max(date) AS end_date FROM panel"),
    "yield_long": ("panel yields", """
        SELECT * FROM yields WHERE date BETWEEN (SELECT min(date) FROM panel) AND (SELECT max(date) FROM panel)"""),
    "curve_join": ("curve", "SELECT * FROM curve"),
    "yield_diff": ("diffs", "SELECT * FROM diffs"),
    "synthetic_returns": ("rets", "SELECT * FROM rets"),
    "nation_returns": ("nation_rets", "SELECT * FROM nation_rets"),
    "nation_spread_cumulative": ("nation_spreads", """
        SELECT curve, date, steepener, CASE WHEN net IS NOT NULL THEN round(sum(net)
            OVER (PARTITION BY curve, steepener ORDER BY date ROWS UNBOUNDED PRECEDING), 9) END AS spread_rtn
        FROM nation_spreads"""),
    "pair_universe": ("held", """
        SELECT a.maturity || 's' || b.maturity || 's steepener' AS steepener, a.yield_tenor AS long, b.yield_tenor AS short
        FROM held a JOIN held b ON a.maturity < b.maturity"""),
    "pair_weights": ("pair_w", """
        SELECT date, steepener, long AS yield_tenor, w_long AS weight FROM pair_w
        UNION ALL SELECT date, steepener, short, w_short FROM pair_w"""),
    "steepener_panel": ("steepeners", "SELECT * FROM steepeners"),
    "spread_duration_legs": ("steepeners", """
        SELECT date, steepener, long_weight * long_val AS weighted_long, short_weight * short_val AS weighted_short
        FROM steepeners WHERE var = 'duration'"""),
    "spread_duration_exposure": ("steepeners", """
        SELECT date, steepener, long_weight * long_val - short_weight * short_val AS duration_exposure
        FROM steepeners WHERE var = 'duration'"""),
    "spread_return_legs": ("spread_legs", "SELECT * FROM spread_legs"),
    "spread_leg_cumulative": ("spread_legs", """
        SELECT date, steepener, leg, CASE WHEN r IS NOT NULL THEN
            round(sum(r) OVER (PARTITION BY steepener, leg ORDER BY date ROWS UNBOUNDED PRECEDING), 9) END AS cum_rtn
        FROM (SELECT date, steepener, 'Long' AS leg, long_rtn AS r FROM spread_legs
            UNION ALL SELECT date, steepener, 'Short', short_rtn FROM spread_legs)"""),
    "spread_cumulative": ("spread_legs", """
        SELECT date, steepener, CASE WHEN long_rtn - short_rtn IS NOT NULL THEN round(sum(long_rtn - short_rtn)
            OVER (PARTITION BY steepener ORDER BY date ROWS UNBOUNDED PRECEDING), 9) END AS spread_rtn FROM spread_legs"""),
    "triple_universe": ("held", """
        SELECT a.maturity || 's' || b.maturity || 's' || c.maturity || 's' AS fly, a.yield_tenor AS short,
            b.yield_tenor AS bullet, c.yield_tenor AS long
        FROM held a JOIN held b ON a.maturity < b.maturity JOIN held c ON b.maturity < c.maturity"""),
    "fly_weights": ("fly_w", "SELECT date, short_weight, long_weight, bullet_weight, fly FROM fly_w"),
    "fly_panel": ("flies", "SELECT * FROM flies"),
    "fly_duration_legs": ("fly_dur", "SELECT * FROM fly_dur"),
    "fly_duration_barbell": ("fly_dur", """
        SELECT date, fly, long + short AS "Barbell", bullet AS "Bullet" FROM fly_dur"""),
    "fly_duration_exposure": ("fly_dur", "SELECT date, fly, long + short - bullet AS duration_exposure FROM fly_dur"),
    "fly_return_legs": ("fly_legs", "SELECT * FROM fly_legs"),
    "fly_leg_cumulative": ("fly_legs", """
        SELECT date, fly, leg, round(sum(r) OVER (PARTITION BY fly, leg ORDER BY date ROWS UNBOUNDED PRECEDING), 9) AS cum_rtn
        FROM (SELECT date, fly, 'Barbell' AS leg, "Barbell" AS r FROM fly_legs
            UNION ALL SELECT date, fly, 'Bullet', "Bullet" FROM fly_legs)"""),
    "fly_cumulative": ("fly_legs", """
        SELECT date, fly, round(sum("Barbell" - "Bullet") OVER (PARTITION BY fly ORDER BY date ROWS UNBOUNDED PRECEDING), 9)
            AS fly_rtn FROM fly_legs"""),
    "strategy_labels": ("steepeners flies", """
        SELECT steepener AS label FROM steepeners UNION SELECT fly FROM flies ORDER BY label"""),
    "fut_cash_panel": ("fut", "SELECT * FROM fut"),
    "fut_vs_cash": ("fut", """
        SELECT date, yield_tenor, CASE WHEN move IS NOT NULL THEN round(product(1 + move) OVER w - 1, 6) END AS fut_rtn,
            round(sum(bnd_rtn) OVER w, 6) AS ctd_rtn
        FROM (SELECT *, "PX_LAST" / lag("PX_LAST") OVER (PARTITION BY yield_tenor ORDER BY date) - 1 AS move FROM fut)
        WINDOW w AS (PARTITION BY yield_tenor ORDER BY date ROWS UNBOUNDED PRECEDING)"""),
    "etf_daily_return": ("etf_ret", "SELECT * FROM etf_ret"),
    "etf_panel": ("etf_joined", "SELECT * FROM etf_joined"),
    "etf_vs_fut_vs_cash": ("etf_cum", "SELECT * FROM etf_cum"),
    "etf_comparison_long": ("etf_cum", """
        SELECT date, ticker, yield_tenor, 'ETF' AS series, etf_rtn AS value FROM etf_cum
        UNION ALL SELECT date, ticker, yield_tenor, 'FUT', fut_rtn FROM etf_cum
        UNION ALL SELECT date, ticker, yield_tenor, 'BND', bnd_rtn FROM etf_cum"""),
    "auction_filtered": ("auction_ids", "SELECT cusip, auction_date, issue_date FROM auction_ids"),
    "auction_long": ("history_a", "SELECT * FROM history_a"),
    "auction_reconcile": ("history_a history_b", """
        SELECT coalesce(a.cusip, b.cusip) AS cusip, coalesce(a.auction_date, b.auction_date) AS auction_date,
            coalesce(a.issue_date, b.issue_date) AS issue_date, coalesce(a.record_date, b.record_date) AS record_date,
            coalesce(a.security_term, b.security_term) AS security_term, coalesce(a.variable, b.variable) AS variable,
            coalesce(a.value, b.value) AS value, coalesce(a.value <> b.value, false) AS conflict
        FROM history_a a FULL JOIN history_b b ON a.cusip = b.cusip AND a.auction_date = b.auction_date
            AND a.issue_date = b.issue_date AND a.record_date = b.record_date AND a.security_term = b.security_term
            AND a.variable = b.variable"""),
    "observed_union": ("observed_wide", "SELECT * FROM observed_wide"),
    "observed_dedup": ("observed", "SELECT DISTINCT * FROM observed"),
    "observed_first": ("observed_one", "SELECT * FROM observed_one"),
    "observed_reconcile": ("observed_one", """
        SELECT k."Action", k."Description", k.last_updated, k.variable, coalesce(a.value, b.value, c.value) AS new_val
        FROM (SELECT DISTINCT "Action", "Description", last_updated, variable FROM observed_one) k
            LEFT JOIN observed_one a ON a."group" = 'auctioned_after_2000' AND a."Action" = k."Action"
                AND a."Description" = k."Description" AND a.last_updated = k.last_updated AND a.variable = k.variable
            LEFT JOIN observed_one b ON b."group" = 'auctioned_after_2005' AND b."Action" = k."Action"
                AND b."Description" = k."Description" AND b.last_updated = k.last_updated AND b.variable = k.variable
            LEFT JOIN observed_one c ON c."group" = 'auctioned_after_2010' AND c."Action" = k."Action"
                AND c."Description" = k."Description" AND c.last_updated = k.last_updated AND c.variable = k.variable"""),
    "quote_ingest_long": ("quotes", "SELECT * FROM quotes"),
    "tenor_dimension": ("days", "SELECT * FROM days"),
    "quote_with_days": ("quotes days", "SELECT q.*, d.tenor_days FROM quotes q JOIN days d ON d.tenor = q.tenor"),
    "duplicate_keys": ("tick_quotes", """
        SELECT date, quote, tenor, count(*) AS n_rows FROM tick_quotes GROUP BY date, quote, tenor HAVING count(*) > 1"""),
    "quote_completeness": ("sides", "SELECT *, n_missing = 4 AS all_missing FROM sides"),
    "quote_impute": ("filled", "SELECT * FROM filled"),
    "rolling_zscore": ("z_short", f"SELECT {_Z} FROM z_short WHERE z IS NOT NULL"),
    "outlier_bad_dates": ("flags_short", f"SELECT {_Z} FROM flags_short WHERE z IS NOT NULL AND bad"),
    "outlier_good_dates": ("flags_short", f"SELECT {_Z} FROM flags_short WHERE z IS NOT NULL AND NOT bad"),
    "outlier_replace": ("replaced_short", "SELECT * FROM replaced_short"),
    "cleaned_quotes": ("replaced_long", "SELECT * FROM replaced_long"),
    "cleaned_long_history": ("replaced_short", "SELECT * FROM replaced_short"),
    "quote_wide_by_variable": ("replaced_short", """
        SELECT tenor, date, max(CASE WHEN variable = 'bid' THEN replace_value END) AS bid,
            max(CASE WHEN variable = 'eod' THEN replace_value END) AS eod,
            max(CASE WHEN variable = 'mid' THEN replace_value END) AS mid,
            max(CASE WHEN variable = 'offer' THEN replace_value END) AS offer FROM replaced_short GROUP BY tenor, date"""),
    "page_links": ("", r"""
        SELECT page_id, ltrim(found, '/') AS file, regexp_extract(url, '^(https?://[^/]+)', 1) || '/' || ltrim(found, '/') AS link
        FROM (SELECT page_id, url, split_part(split_part(' ' || tag, ' href="', 2), '"', 1) AS found FROM (
            SELECT page_id, url, split_part(unnest(string_split(html, '<a ')[2:]), '>', 1) AS tag FROM pages)
            WHERE contains(' ' || tag, ' href="'))"""),
    "page_file_links": ("", r"""
        WITH placed AS (SELECT page_id, html, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root,
            regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '[^/]*$', '') AS folder FROM pages),
        above AS (SELECT *, CASE WHEN folder IN ('', '/') THEN '/' ELSE regexp_replace(folder, '[^/]+/$', '') END AS up FROM placed)
        SELECT page_id, '../files/./' || w || '.xlsx' AS file, root || up || 'files/' || w || '.xlsx' AS link
        FROM (SELECT *, unnest(regexp_extract_all(html, '<a href="/([a-m][^"?#/]*)">', 1)) AS w FROM above)
        UNION ALL
        SELECT page_id, '/top/../../' || w || '.xlsx?v=2#end', root || '/' || w || '.xlsx?v=2#end'
        FROM (SELECT *, unnest(regexp_extract_all(html, '<a href="/([A-Z][^"?#/]*)">', 1)) AS w FROM above)"""),
    "read_daily_quotes": ("tick_quotes", """
        SELECT d.date, d.quote, t.tenor, max(q.value) AS value
        FROM (SELECT DISTINCT cast(date AS DATE) AS date, quote FROM tick_quotes) d
        CROSS JOIN (SELECT DISTINCT tenor FROM tick_quotes) t
        LEFT JOIN tick_quotes q ON cast(q.date AS DATE) = d.date AND q.quote = d.quote AND q.tenor = t.tenor
        GROUP BY d.date, d.quote, t.tenor"""),
    "tick_diff": ("", f"""
        SELECT *, value - lag(value) OVER ({_BY_EVENT}) AS diff FROM ({_TICKS})"""),
    "tick_pct_change": ("", f"""
        SELECT event_type, event_id, value, p / lag(p) OVER ({_BY_EVENT}) - 1 AS change
        FROM (SELECT *, last_value(value IGNORE NULLS) OVER ({_BY_EVENT}) AS p FROM ({_TICKS}))"""),
    "tick_cumulative": ("", f"""
        SELECT *, CASE WHEN value IS NOT NULL THEN round(sum(value) OVER w, 6) END AS cum_value,
            CASE WHEN value IS NOT NULL THEN round(product(1 + (value - 5e1) / 1e5) OVER w - 1, 6) END AS growth
        FROM ({_TICKS}) WINDOW w AS ({_BY_EVENT} ROWS UNBOUNDED PRECEDING)"""),
    "tick_rolling_zscore": ("", f"""
        SELECT event_type, event_id, value, CASE WHEN n = 200 AND sd > 0 THEN round(abs((value - mean) / sd), 6) END AS z_score
        FROM (SELECT *, count(value) OVER w AS n, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd
            FROM ({_TICKS}) WINDOW w AS ({_BY_EVENT} ROWS 199 PRECEDING))"""),
}


SELECTS["auction_reconcile_wide"] = SELECTS["auction_reconcile"]


def _needed(names: str, seen: dict[str, str]) -> dict[str, str]:
    """The shared tables behind ``names``, each after those it reads."""
    for name in names.split():
        if name not in seen:
            reads, definition = TABLES[name]
            _needed(reads, seen)
            seen[name] = definition
    return seen


# Queries that read saved files give what those give that start from the tables.
FROM_FILES = {
    "read_risk_panel": "deliverable_panel", "read_observed": "observed_reconcile", "read_auctions": "auction_filtered",
    "build_returns": "synthetic_returns", "append_returns": "synthetic_returns", "yield_long_stored": "yield_long",
    "tick_diff_fine": "tick_diff",
}


def oracle_sql() -> dict[str, str]:
    queries = {}
    for name, (reads, select) in SELECTS.items():
        tables = [f"{t} AS ({definition})" for t, definition in _needed(reads, {}).items()]
        queries[name] = (f"WITH {', '.join(tables)} " if tables else "") + select
    return queries | {name: queries[same] for name, same in FROM_FILES.items()}
