"""The first form of the star: ranks and figures on the company, money as decimals.

It differs from the gold tables in that DimCompany holds rank and figures, dimensions have no
versions, DimDate has no quarter, prices are exact decimals and Dividend says only whether one was
paid. Sums of decimals are exact, so results do not depend on how rows were distributed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_key
from ..operators.joins import lookup_join
from ..operators.windows import growth, rolling_mean
from ..session import pinned
from .analytics import LIST_SIZE, ROLLING_ROWS, TOP_RANK, ratio, top
from .silver import FACT_COLUMNS, SECTOR_PLACEHOLDER, company_key, dim_date, dim_ticker, ticker_key

MONEY = "decimal(19,2)"

Tables = Mapping[str, DataFrame]


def star(companies: DataFrame, stocks: DataFrame, keys: str = "xxhash64") -> dict[str, DataFrame]:
    """The four tables, from the deduplicated company and stock views."""

    def money(column: str, name: str) -> Column:
        return F.coalesce(F.col(column).cast(MONEY), F.lit(0).cast(MONEY)).alias(name)

    company = companies.select(
        company_key(keys).alias("CompanyKey"),
        F.col("company").alias("CompanyName"),
        F.col("rank").cast("int").alias("ForbesRank"),
        F.col("headquarters").alias("Headquarters"),
        F.col("industry").alias("Industry"),
        F.lit(SECTOR_PLACEHOLDER).alias("Sector"),
        money("sales_in_millions", "Sales"),
        money("profit_in_millions", "Profit"),
        money("assets_in_millions", "Assets"),
        money("market_value_in_millions", "MarketValue"),
    )
    listed = companies.select(F.col("ticker").alias("ticker_symbol"), company_key(keys).alias("CompanyKey"))
    # Keys and decimals are computed after the join, which then moves shorter rows.
    fact = lookup_join(stocks.select(*FACT_COLUMNS), listed.distinct(), ["ticker_symbol"]).select(
        date_key("trading_day").alias("DateKey"),
        ticker_key(keys).alias("TickerKey"),
        money("open_price", "OpenPrice"),
        money("close_price", "ClosePrice"),
        money("high_price", "HighPrice"),
        money("low_price", "LowPrice"),
        money("market_cap", "MarketCap"),
        (F.coalesce("dividend", F.lit(0.0)) > 0).alias("Dividend"),
        "CompanyKey",
    )
    return {
        "DimCompany": company,
        "DimDate": dim_date(stocks).select(
            "DateKey", F.col("TradingDate").alias("TradingDay"), "Year", "Month", "Day"
        ),
        "DimTicker": dim_ticker(stocks, keys, distinct=True).drop("Sector").distinct(),
        "FactStock": fact,
    }


def _closes(fact: DataFrame, *by: Column | str) -> DataFrame:
    """Closes summed and counted, exactly, before anything is joined."""
    return fact.groupBy(*by).agg(F.sum("ClosePrice").alias("_close"), F.count("ClosePrice").alias("_n"))


def rolling_marketcap(t: Tables, rank: int = TOP_RANK, rows: int = ROLLING_ROWS, limit: int = 10) -> DataFrame:
    firms = t["DimCompany"].where(F.col("ForbesRank") <= rank).select("CompanyKey", "Industry")
    symbols = t["DimTicker"].select("TickerKey", "TickerSymbol")
    quotes = t["FactStock"].select("CompanyKey", "DateKey", "TickerKey", "MarketCap")
    listed = lookup_join(lookup_join(quotes, firms, ["CompanyKey"]), symbols, ["TickerKey"]).select(
        "Industry", "DateKey", "TickerSymbol", F.col("MarketCap").cast("double").alias("MarketCap")
    )
    rolled = rolling_mean(
        listed, ["Industry"], "DateKey", ["TickerSymbol", "MarketCap"], "MarketCap", rows, "avg_3m_marketcap"
    )
    out = lookup_join(rolled, t["DimDate"].select("DateKey", "Year", "Month"), ["DateKey"]).select(
        "Industry", "Year", "Month", "avg_3m_marketcap"
    )
    return top(out, limit, F.desc_nulls_last("avg_3m_marketcap"), F.asc("Industry"), F.asc("Year"), F.asc("Month"))


def price_to_earnings(t: Tables, limit: int = 10) -> DataFrame:
    """Mean close over mean profit per company over all days."""
    firms = t["DimCompany"].select("CompanyKey", "CompanyName", "Industry", "Profit")
    grouped = (
        _closes(t["FactStock"], "CompanyKey")
        .join(firms, "CompanyKey")
        .groupBy("CompanyName", "Industry")
        .agg(
            F.sum("_close").alias("_close"),
            F.sum(F.col("Profit") * F.col("_n")).alias("_profit"),
            F.sum("_n").alias("_n"),
        )
        .where(F.col("_profit") > 0)
    )
    pe = ratio(ratio(F.col("_close"), F.col("_n")), ratio(F.col("_profit"), F.col("_n")))
    out = grouped.select("CompanyName", "Industry", pe.alias("pe_ratio"))
    return top(out, limit, F.desc_nulls_last("pe_ratio"), F.asc("CompanyName"), F.asc("Industry"))


def return_on_assets(t: Tables, limit: int = 10) -> DataFrame:
    out = t["DimCompany"].where(F.col("Assets") > 0).select(
        "CompanyName", "Industry", ratio(F.col("Profit"), F.col("Assets")).alias("roa")
    )
    return top(out, limit, F.desc_nulls_last("roa"), F.asc("CompanyName"), F.asc("Industry"))


def peer_pe(t: Tables, rank: int = LIST_SIZE) -> DataFrame:
    """Every company's mean close over mean profit, and its difference from the industry's mean.

    The industry's mean is over quotes of ranked companies whose profit is not zero. The closes
    per company serve both sides and are written once instead of scanning the fact twice.
    """
    firms = t["DimCompany"].select("CompanyKey", "CompanyName", "ForbesRank", "Industry", "Profit")
    priced = pinned(_closes(t["FactStock"], "CompanyKey").join(firms, "CompanyKey"), "closes")
    industry = (
        priced.where((F.col("ForbesRank") <= rank) & (F.col("Profit") != 0))
        .groupBy("Industry")
        .agg(
            ratio(F.sum(ratio(F.col("_close"), F.col("Profit"))), F.sum("_n")).alias("avg_pe")
        )
    )
    company = priced.groupBy("Industry", "CompanyName").agg(
        ratio(ratio(F.sum("_close"), F.sum("_n")), ratio(F.sum(F.col("Profit") * F.col("_n")), F.sum("_n")))
        .alias("company_pe")
    )
    joined = lookup_join(company, pinned(industry, "industry-pe"), ["Industry"])
    return joined.select(
        "Industry", "CompanyName", "company_pe", "avg_pe",
        (F.col("company_pe") - F.col("avg_pe")).alias("delta"),
    ).orderBy(F.desc_nulls_last("delta"), F.asc("Industry"), F.asc("CompanyName"))


def revenue_by_industry(t: Tables, rank: int = LIST_SIZE, limit: int = 20) -> DataFrame:
    out = (
        t["DimCompany"].where(F.col("ForbesRank") <= rank)
        .groupBy("Industry")
        .agg(F.sum("Sales").alias("total_revenue"))
    )
    return top(out, limit, F.desc_nulls_last("total_revenue"), F.asc("Industry"))


def yoy_by_year(t: Tables, rank: int = LIST_SIZE, limit: int = 1) -> DataFrame:
    firms = t["DimCompany"].where(F.col("ForbesRank") <= rank).select("CompanyKey", "Industry")
    year = F.floor(F.col("DateKey") / 10000).cast("int").alias("Year")
    yearly = (
        _closes(t["FactStock"], "CompanyKey", year)
        .join(firms, "CompanyKey")
        .groupBy("Industry", "Year")
        .agg(ratio(F.sum("_close"), F.sum("_n")).alias("avg_close"))
    )
    out = (
        growth(yearly, ["Industry"], ["Year"], "avg_close", "_growth")
        .groupBy("Industry")
        .agg(F.avg("_growth").alias("avg_yoy_growth"))
    )
    return top(out, limit, F.desc_nulls_last("avg_yoy_growth"), F.asc("Industry"))
