"""The test tables, reshaped to the input tables of the operators.

Each reads whole tables and aggregates them map-side before anything is shuffled. Constants are floating
literals and only ``min``/``max`` are used, so any engine gets the same bits.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.config import RISK_VARIABLES, UNIVERSE, VINTAGES
from curveloom.operators.universe import etf_table, universe_table

YIELD_SERIES = ("DGS2", "DGS5", "DGS7", "DGS10", "DGS30")
ETF_SERIES = ("SHY", "IEI", "IEF", "TLT")
QUOTE_TENORS = ("4-Week", "1-Year", "10-Year", "30-Year")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_SIDES = dict(enumerate(("bid", "eod", "mid", "offer")))
VINTAGE_START = dict(zip(VINTAGES, (None, "1997-01-01", "1999-01-01")))
AUCTION_INDEX = ("row", "part")
AUCTION_COLUMNS = ("cusip", "auction_date", "issue_date")


# The columns that are read, so that no job has to open files for the schema.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_suppkey bigint, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def universe(spark: SparkSession, folder: str) -> DataFrame:
    return universe_table(spark)


def etfs(spark: SparkSession, folder: str) -> DataFrame:
    return etf_table(spark)


def risk(spark: SparkSession, folder: str, by_nation: bool = False) -> DataFrame:
    """Order priorities as securities; the ultra-long one has no convexity on the first of a month.

    ``by_nation`` gives each customer nation a panel of its own, told apart by ``curve``.
    """
    orders, by = table(spark, folder, "orders"), ["curve"] if by_nation else []
    security = _choose("o_orderpriority", {p: f"{s} Comdty" for p, s in zip(PRIORITIES, UNIVERSE)})
    years = _choose("o_orderpriority", dict(zip(PRIORITIES, UNIVERSE.values())))
    keys = [F.to_date("o_orderdate").alias("date"), security.alias("security"), years.alias("years")]
    extremes = [F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low")]
    if by_nation:
        # Two columns of a dimension, which Spark broadcasts if they measure small; the rows then shrink to nations before they move.
        customers = table(spark, folder, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS curve")
        orders = orders.join(customers, "o_custkey")
    daily = orders.groupBy(*by, *keys).agg(*extremes)
    duration, convexity = RISK_VARIABLES
    wide = daily.selectExpr(
        *by, "date", "security",
        f"years * 8e-1 + high / 1e6 AS {duration}",
        f"if(years = 30 AND day(date) = 1, NULL, years * years / 1e2 + low / 1e6) AS {convexity}",
    )
    return wide.unpivot([*by, "date", "security"], [duration, convexity], "variable", "value").where("value IS NOT NULL")


def yields(spark: SparkSession, folder: str, by_nation: bool = False) -> DataFrame:
    """Line numbers as constant-maturity series; ``by_nation`` gives each supplier nation its own."""
    lines, date = table(spark, folder, "lineitem"), F.to_date("l_shipdate").alias("date")
    lows = [F.expr(f"min(l_extendedprice) FILTER (WHERE l_linenumber % 5 = {k}) AS {n}") for k, n in enumerate(YIELD_SERIES)]
    if by_nation:
        suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey AS curve")
        daily = lines.join(suppliers, "l_suppkey").groupBy("curve", date).agg(*lows)
        return daily.select("curve", "date", *[F.expr(f"{n} / 2e4 + 1e-1 AS {n}") for n in YIELD_SERIES])
    return lines.groupBy(date).agg(*lows).select("date", *[F.expr(f"{n} / 2e4 + 1e-1 AS {n}") for n in YIELD_SERIES])


def front_prices(spark: SparkSession, folder: str) -> DataFrame:
    security = _choose("l_linenumber % 5", {k: f"{s} Comdty" for k, s in enumerate(UNIVERSE)})
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"), security.alias("security"))
        .agg((F.max("l_extendedprice") / 1e3).alias("PX_LAST"))
    )


def etf_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as tickers; the last ticker is listed a year late and has a gap in the middle."""
    cells = [
        F.expr(f"max(l_extendedprice) FILTER (WHERE l_suppkey % 4 = {k}) / 1e3 AS {n}") for k, n in enumerate(ETF_SERIES)
    ]
    daily = table(spark, folder, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(*cells)
    unlisted = "date < DATE '1996-01-01' OR date BETWEEN DATE '1998-03-10' AND DATE '1998-03-20'"
    return daily.withColumn("TLT", F.expr(f"if({unlisted}, NULL, TLT)"))


def quotes_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Every event: event numbers as quote sides, users as tenors and hours as dates."""
    events = table(spark, folder, "events")
    side = _choose("event_id % 4", EVENT_SIDES)
    cells = [F.expr(f"max(value) FILTER (WHERE user_id % 4 = {k}) AS `{n}`") for k, n in enumerate(QUOTE_TENORS)]
    return events.groupBy(_hour("ts").alias("date"), side.alias("quote")).agg(*cells)


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a tick of its side, in event order. Ticks below one are missing values."""
    value = F.when(F.col("value") >= 1.0, F.col("value"))
    return table(spark, folder, "events").select("event_type", "event_id", value.alias("value"))


def tick_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Every event by hour, side and tenor, before they are reduced to one per key."""
    events = table(spark, folder, "events")
    side = _choose("event_id % 4", EVENT_SIDES)
    tenor = _choose("user_id % 4", dict(enumerate(QUOTE_TENORS)))
    return events.select(_hour("ts").alias("date"), side.alias("quote"), tenor.alias("tenor"), "value")


def auctions_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as auctions: two saved row numbers, then the auction columns, dates as text."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("row"), F.col("p_size").alias("part"), *_auction_ids())


def history_a(spark: SparkSession, folder: str) -> DataFrame:
    """The price is missing for one part type."""
    price = F.when(F.col("p_type") != "ECONOMY", _cents("p_retailprice"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("row"), *_auction_ids(), *_history_ids(),
        F.col("p_size").cast("bigint").alias("size"), price.alias("price"))


def history_b(spark: SparkSession, folder: str) -> DataFrame:
    """The size is missing for one brand, the price for one part type; small sizes disagree on the price."""
    size = F.when(F.col("p_brand") != "Brand#4", F.col("p_size").cast("bigint"))
    disagreement = F.when(F.col("p_size") <= 10, 1).otherwise(0)
    price = F.when(F.col("p_type") != "PROMO", _cents("p_retailprice") + disagreement)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("row"), *_auction_ids(), *_history_ids(), size.alias("size"), price.alias("price"))


def vintages(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders as observed securities: the later a vintage, the later its first order.

    A customer has many orders, so keys repeat, as whole rows and with other values. The first vintage lacks the
    price of low priority, the second shifts that of one status, and only the last has the month.
    """
    first, second, third = VINTAGES
    price = F.col("o_totalprice")
    extra = {
        first: [F.when(F.col("o_orderpriority") != "5-LOW", price).alias("price")],
        second: [(price + F.when(F.col("o_orderstatus") == "P", 3.0).otherwise(0.0)).alias("price")],
        third: [price.alias("price"), F.month("o_orderdate").cast("double").alias("month")],
    }
    orders = table(spark, folder, "orders")

    def since(start: str | None) -> DataFrame:
        return orders if start is None else orders.where(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))

    return {
        name: since(VINTAGE_START[name]).select(
            F.col("o_orderstatus").alias("Action"), F.col("o_custkey").cast("string").alias("Description"),
            F.col("o_orderpriority").alias("last_updated"),
            F.year("o_orderdate").cast("double").alias("year"), *columns)
        for name, columns in extra.items()
    }


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as directory listings: by their first letter, links of a page's menu get classes, and files above, under or far from it."""
    rules = {
        "[a-m]": """<a class="primary" href="../files/./$1.xlsx">""",
        "[n-z]": """<a title="a > b" class='box primary' href='sub/../$1.csv?raw=1'>""",
        "[A-Z]": """<A HREF="/top/../../$1.xlsx?v=2#end" CLASS="wide  primary">""",
    }
    html = F.col("html")
    for first, tag in rules.items():
        html = F.regexp_replace(html, rf'<a href="/({first}[^"?#/]*)">', tag)
    return pages(spark, folder).select("page_id", "url", html.alias("html"))


def _auction_ids() -> list[Column]:
    auction = F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size"))
    return [
        F.col("p_partkey").cast("string").alias("cusip"),
        auction.cast("string").alias("auction_date"),
        F.date_add(auction, 3).cast("string").alias("issue_date"),
    ]


def _history_ids() -> list[Column]:
    return [F.lit("2024-01-01").alias("record_date"), F.col("p_type").alias("security_term")]


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def _hour(time: str) -> Column:
    return F.date_trunc("hour", time).cast("timestamp_ntz")


def _choose(column: str, results: dict) -> Column:
    """CASE over the column's values; NULL if none matches."""
    cases = " ".join(f"WHEN {case!r} THEN {result!r}" for case, result in results.items())
    return F.expr(f"CASE {column} {cases} END")
