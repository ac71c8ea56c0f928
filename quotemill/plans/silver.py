"""Bronze views and the typed staging models built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_key, surrogate_key
from ..operators.dedup import last_version
from ..operators.joins import lookup_join

VERSION = "_ingested_at"

# Fixed values written into columns the sources do not provide.
SECTOR_PLACEHOLDER = "sector"
TICKER_CLASS = "Equity"

# What the fact takes from a quote.
FACT_COLUMNS = (
    "ticker_symbol", "exchange", "trading_day", "open_price", "close_price", "high_price", "low_price", "market_cap", "dividend",
)


def companies_view(raw: DataFrame, rank_only: bool = False) -> DataFrame:
    """Last version per rank and year, then last per company, headquarters and year.

    ``rank_only`` is the original's form: one row per rank, so that a new year's ranking replaces the year before.
    """
    by_rank = last_version(raw, ["rank"] if rank_only else ["rank", "financial_year"], [VERSION])
    return last_version(by_rank, ["company", "headquarters", "financial_year"], [VERSION]).drop(VERSION)


def stocks_view(raw: DataFrame) -> DataFrame:
    """Last version per ticker and run; one pass serves both dedups, which share their key."""
    return last_version(raw, ["ticker_symbol", "execution_date_utc"], [VERSION], mostly_once=True).drop(VERSION)


def company_key(method: str, company: str = "company", headquarters: str = "headquarters") -> Column:
    return surrogate_key(company, headquarters, method=method)


def ticker_key(method: str, ticker: str = "ticker_symbol", exchange: str = "exchange") -> Column:
    return surrogate_key(ticker, exchange, method=method)


def _loaded(loaded_at: object | None) -> list[Column]:
    return [] if loaded_at is None else [F.lit(loaded_at).cast("timestamp").alias("_load_datetime")]


def dim_company(
    companies: DataFrame, keys: str = "xxhash64", loaded_at: object | None = None
) -> DataFrame:
    """Company attributes, with the load time when one is given; the clock is never read here."""
    return companies.where(F.col("company").isNotNull() & F.col("headquarters").isNotNull()).select(
        company_key(keys).alias("CompanyKey"),
        F.col("company").alias("CompanyName"),
        F.col("headquarters").alias("Headquarters"),
        F.col("industry").alias("Industry"),
        F.lit(SECTOR_PLACEHOLDER).alias("Sector"),
        *_loaded(loaded_at),
    )


def dim_date(stocks: DataFrame) -> DataFrame:
    """One row per trading day; the parts are derived after the days are made distinct."""
    day = F.col("TradingDate")
    return (
        stocks.select(F.col("trading_day").alias("TradingDate"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("DateKey"),
            day,
            F.year(day).cast("int").alias("Year"),
            F.month(day).cast("int").alias("Month"),
            F.dayofmonth(day).cast("int").alias("Day"),
            F.quarter(day).cast("int").alias("Quarter"),
        )
    )


def dim_ticker(
    stocks: DataFrame, keys: str = "xxhash64", distinct: bool = False, loaded_at: object | None = None
) -> DataFrame:
    """Ticker attributes: one row per quote, or one per distinct combination."""
    tickers = stocks.where(F.col("ticker_symbol").isNotNull()).select(
        ticker_key(keys).alias("TickerKey"),
        F.col("ticker_symbol").alias("TickerSymbol"),
        F.coalesce("exchange", F.lit("")).alias("Exchange"),
        F.lit(TICKER_CLASS).alias("Class"),
        F.coalesce("currency", F.lit("")).alias("Currency"),
        F.coalesce("sector", F.lit("")).alias("Sector"),
        *_loaded(loaded_at),
    )
    return tickers.distinct() if distinct else tickers


def last_companies(companies: DataFrame) -> DataFrame:
    """Each company as of its latest year, for staging: one row per key."""
    return last_version(companies, ["company", "headquarters"], ["financial_year"])


def last_tickers(stocks: DataFrame) -> DataFrame:
    """Each ticker as of its latest quote, for staging: one row per key."""
    used = stocks.select(
        "ticker_symbol", F.coalesce("exchange", F.lit("")).alias("exchange"), "currency", "sector", "execution_date_utc"
    )
    return last_version(used, ["ticker_symbol", "exchange"], ["execution_date_utc"])


def fact_financials(companies: DataFrame, keys: str = "xxhash64") -> DataFrame:
    """Measures in whole millions, truncated toward zero."""
    return companies.where(F.col("company").isNotNull()).select(
        company_key(keys).alias("CompanyKey"),
        F.col("financial_year").cast("int").alias("Year"),
        F.col("sales_in_millions").cast("bigint").alias("Sales"),
        F.col("profit_in_millions").cast("bigint").alias("Profit"),
        F.col("assets_in_millions").cast("bigint").alias("Assets"),
        F.col("market_value_in_millions").cast("bigint").alias("MarketValue"),
    )


def fact_rank(companies: DataFrame, keys: str = "xxhash64") -> DataFrame:
    return companies.where(F.col("company").isNotNull()).select(
        surrogate_key("rank", method=keys).alias("ForbesRankKey"),
        company_key(keys).alias("CompanyKey"),
        F.col("financial_year").cast("int").alias("Year"),
        F.col("rank").cast("bigint").alias("ForbesRank"),
    )


def fact_stock(
    stocks: DataFrame, companies: DataFrame, keys: str = "xxhash64", fan_out: bool = False
) -> DataFrame:
    """Quotes joined to the companies that carry their ticker; missing measures become zero.

    A ticker is matched to each distinct company once. ``fan_out`` matches every company row
    instead, so a company listed in two years doubles its quotes.
    """
    listed = companies.where(F.col("ticker").isNotNull()).select(
        F.col("ticker").alias("ticker_symbol"), company_key(keys).alias("CompanyKey")
    )
    if not fan_out:
        listed = listed.distinct()

    def measure(column: str, name: str) -> Column:
        return F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias(name)

    # Keys are computed after the join, which then moves shorter rows.
    quotes = stocks.where(F.col("ticker_symbol").isNotNull()).select(*FACT_COLUMNS)
    return lookup_join(quotes, listed, ["ticker_symbol"]).select(
        date_key("trading_day").alias("DateKey"),
        "CompanyKey",
        ticker_key(keys).alias("TickerKey"),
        F.col("trading_day").alias("TradingDate"),
        measure("open_price", "OpenPrice"),
        measure("close_price", "ClosePrice"),
        measure("high_price", "HighPrice"),
        measure("low_price", "LowPrice"),
        measure("market_cap", "MarketCap"),
        measure("dividend", "Dividend"),
    )
