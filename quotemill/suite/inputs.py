"""Frames the registered queries derive from the test tables: files, batches, staged snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import last_version
from ..plans import silver
from ..session import fresh_path, pinned, together
from ..sources import sample
from .scratch import KEYS


def ranking_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies as a ranking file holds them: amounts as text, some blank, some malformed."""
    c = sample.companies_raw(spark, sf_dir)
    profit = F.col("profit_in_millions")
    return c.select(
        F.col("rank").cast("string").alias("Rank"),
        F.concat(F.lit("  "), F.col("company"), F.lit(" ")).alias("Company"),
        F.col("headquarters").alias("Headquarters"),
        F.col("industry").alias("Industry"),
        F.concat(F.lit("$"), F.format_number("sales_in_millions", 2)).alias("Sales ($B)"),
        F.when(profit < 0, F.concat(F.lit("0."), F.col("rank").cast("string"), F.lit(".6")))
        .otherwise(profit.cast("string"))
        .alias("Profit ($B)"),
        F.col("assets_in_millions").cast("string").alias("Assets ($B)"),
        F.when(F.col("industry") != "BUILDING", F.col("market_value_in_millions").cast("bigint").cast("string"))
        .alias("Market Value ($B)"),
    )


def ranking_file(spark: SparkSession, sf_dir: str) -> str:
    path = f"{fresh_path(spark, 'files')}/rankings_2025.csv"
    text = ranking_text(spark, sf_dir)
    writer = text.write.option("header", True).option("sep", ";")
    # Keep the blanks around names: they are for the reader to trim.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def ticker_file(spark: SparkSession, sf_dir: str) -> str:
    """The same as a ``;`` file, with names as the ranking file pads them."""
    path = fresh_path(spark, "tickers")
    rows = ticker_map(spark, sf_dir).select(
        F.col("rank").cast("string").alias("Rank"), F.concat(F.col("company"), F.lit("  ")).alias("Company"), F.col("mapped_ticker").alias("Ticker")
    )
    rows.write.option("header", True).option("sep", ";").option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def quote_feed(spark: SparkSession, sf_dir: str, factor: float = 1.0) -> DataFrame:
    """A feed of many runs, one a day: some quotes are empty, some tickers missing, some asked for twice, one run has no time."""
    orders = sample.table(spark, sf_dir, "orders")
    run = F.date_format("o_orderdate", "yyyy-MM-dd'T22:15:30Z'")
    return orders.select(
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown").otherwise(run).alias("run_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", " ").otherwise(F.concat(F.lit(" T"), F.col("o_custkey").cast("string"))).alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", "{}").otherwise(quote_payload(F.col("o_totalprice") * factor)).alias("info"),
        F.col("o_orderkey").alias("position"),
    )


def ticker_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known tickers by rank and company; companies that made a loss have none."""
    return (
        sample.companies_raw(spark, sf_dir)
        .where(F.col("profit_in_millions") > 0)
        .select("rank", "company", F.col("ticker").alias("mapped_ticker"))
    )


def quote_payload(price: Column) -> Column:
    """A quote as JSON text; NULL fields are left out of it."""
    key = F.col("o_custkey")
    return F.to_json(
        F.struct(
            F.col("o_orderstatus").alias("sector"),
            (price * 0.5).alias("open"),
            price.alias("previousClose"),
            (price * 2).alias("dayHigh"),
            (price * 0.25).alias("dayLow"),
            (F.col("o_orderkey") * 1000.0 + 0.75).alias("marketCap"),
            F.when(key % 4 != 0, "USD").alias("currency"),
            F.when(key % 3 != 0, F.col("o_orderpriority")).alias("exchange"),
            F.when(F.col("o_orderkey") % 5 != 0, price * 0.125).alias("dividendRate"),
        )
    )


def quote_files(spark: SparkSession, sf_dir: str) -> str:
    """The quote feed as JSON lines; orders in status P have an empty quote."""
    path = fresh_path(spark, "feed")
    orders = sample.table(spark, sf_dir, "orders")
    orders.select(
        F.col("o_orderkey").alias("quote_id"),
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.when(F.col("o_orderstatus") == "P", "{}").otherwise(quote_payload(F.col("o_totalprice"))).alias("info"),
    ).write.json(path)
    return path


def stock_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged fact, over views that are written first as the daily run does."""
    companies, stocks = together(
        lambda: pinned(silver.companies_view(sample.companies_raw(spark, sf_dir)), "companies"),
        lambda: pinned(silver.stocks_view(sample.stocks_raw(spark, sf_dir)), "stocks"),
    )
    return silver.fact_stock(stocks, companies, KEYS)


# Snapshots are taken of the orders of three periods, dated at the start of the following year.
# The first has no beginning and the last no end.
Period = tuple[str | None, str | None]
PERIODS: list[Period] = [(None, "1997-01-01"), ("1997-01-01", "1999-01-01"), ("1999-01-01", None)]
TAKEN = ["1997-01-01", "1999-01-01", "2002-01-01"]


def _in_period(value: Column, period: Period, kind: str) -> Column:
    start, end = (p and F.lit(p if kind == "timestamp" else p[:4]).cast(kind) for p in period)
    inside = F.lit(True)
    if start is not None:
        inside = inside & (value >= start)
    return inside if end is None else inside & (value < end)


def staged_companies(versions: DataFrame, period: Period) -> DataFrame:
    """Companies with an order in the period; their industry is that of the last one."""
    inside = versions.where(_in_period(F.col("financial_year"), period, "int"))
    return silver.dim_company(silver.companies_view(inside.withColumn("financial_year", F.lit(0))), KEYS)


def currency_by_status(stocks: DataFrame) -> DataFrame:
    """Quotes whose currency follows the status of the order, so that a ticker's currency changes in time."""
    return stocks.withColumn("currency", F.when(F.col("sector") == "F", "USD").when(F.col("sector") == "O", "EUR"))


def staged_tickers(spark: SparkSession, sf_dir: str, period: Period) -> DataFrame:
    """Tickers quoted in the period; currency follows the status of their last quote."""
    stocks = sample.stocks_raw(spark, sf_dir).where(_in_period(F.col("execution_date_utc"), period, "timestamp"))
    tickers = currency_by_status(stocks).withColumn("sector", F.col("season"))
    key = F.concat_ws("|", "ticker_symbol", F.coalesce("exchange", F.lit("")))
    last = last_version(tickers.withColumn("_k", key), ["_k"], ["_ingested_at"]).drop("_k")
    return silver.dim_ticker(last, KEYS)
