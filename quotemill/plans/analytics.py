"""The business questions over the gold tables.

Every function takes a mapping of table name to DataFrame. The dated fact is the only table that
grows daily, so it is reduced before it meets a dimension wherever the measure allows, and heavy
companies are spread by ``lookup_join`` where it does not. Dimension versions that are no longer
valid are left out by default; ``all_versions`` keeps them, which repeats a company's rows once
per version.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.dedup import last_version
from ..operators.joins import broadcast_within, lookup_join, will_broadcast
from ..operators.windows import growth, rolling_mean
from ..schemas import MONTH
from ..session import pinned

Tables = Mapping[str, DataFrame]

# Fixed values of the questions asked.
TOP_RANK = 20
LIST_SIZE = 2000
ROLLING_ROWS = 3


def _versions(dimension: DataFrame, all_versions: bool) -> DataFrame:
    return dimension if all_versions else dimension.where(F.col("ValidTo").isNull())


def companies_of(t: Tables, all_versions: bool = False) -> DataFrame:
    return _versions(t["DimCompany"], all_versions)


def tickers_of(t: Tables, all_versions: bool = False) -> DataFrame:
    return _versions(t["DimTicker"], all_versions)


def _latest_year(fact: DataFrame, *columns: str) -> DataFrame:
    return last_version(fact.select("CompanyKey", "Year", *columns), ["CompanyKey"], ["Year"])


def ranked_keys(t: Tables, rank: int) -> DataFrame:
    """Keys of companies at or above a rank in any year."""
    return t["FactForbesRank"].where(F.col("ForbesRank") <= rank).select("CompanyKey").distinct()


def ranked_companies(t: Tables, rank: int, *columns: str, all_versions: bool = False) -> DataFrame:
    """Companies at or above a rank. The number of ranks is counted before it is broadcast."""
    keys = ranked_keys(t, rank)
    n = keys.count()
    companies = companies_of(t, all_versions).select("CompanyKey", *columns)
    found = companies.join(broadcast_within(keys, n), "CompanyKey")
    return found if all_versions else broadcast_within(found, n)


def earnings(t: Tables, *columns: str, all_versions: bool = False) -> DataFrame:
    """Companies with the profit of their latest year, one row per company and version.

    Written before it meets the fact: the estimate for a join is far too high, and would make
    Spark shuffle the fact for a lookup that may well be small enough to broadcast.
    """
    figures = _latest_year(t["FactFinancials"], "Profit").drop("Year")
    firms = companies_of(t, all_versions).select("CompanyKey", *columns).join(figures, "CompanyKey")
    return pinned(firms, "earnings")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def last_trading_day(t: Tables, until: date | None = None) -> date | None:
    days = t["DimDate"]
    if until is not None:
        days = days.where(F.col("TradingDate") <= F.lit(until))
    return days.agg(F.max("TradingDate").alias("d")).first().d


def on_day(fact: DataFrame, day: date | None) -> DataFrame:
    """Rows of one day; the month is filtered too, so only its partition is listed."""
    rows = fact.where(F.col("TradingDate") == F.lit(day))
    if MONTH in fact.columns and day is not None:
        rows = rows.where(F.col(MONTH) == day.year * 100 + day.month)
    return rows


def up_to(fact: DataFrame, day: date | None) -> DataFrame:
    """Rows on or before a day, listing only the partitions up to its month."""
    rows = fact.where(F.col("TradingDate") <= F.lit(day))
    if MONTH in fact.columns and day is not None:
        rows = rows.where(F.col(MONTH) <= day.year * 100 + day.month)
    return rows


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


# --- valuation ----------------------------------------------------------------------------------


def rolling_marketcap(
    t: Tables, rank: int = TOP_RANK, rows: int = ROLLING_ROWS, limit: int = 10, all_versions: bool = False
) -> DataFrame:
    """Industries by market capitalization averaged over three consecutive quotes.

    Quotes of an industry are ordered by day, ticker and value, which settles ties that year and
    month alone leave open.
    """
    companies = ranked_companies(t, rank, "Industry", all_versions=all_versions)
    quotes = t["FactStock"].select("DateKey", "CompanyKey", "TickerKey", "MarketCap")
    symbols = tickers_of(t, all_versions).select("TickerKey", "TickerSymbol")
    ranked = lookup_join(quotes, companies, ["CompanyKey"])
    if not will_broadcast(symbols):
        # The next join looks at these rows twice; they are few, the fact is not.
        ranked = pinned(ranked, "ranked")
    listed = lookup_join(ranked, symbols, ["TickerKey"])
    rolled = rolling_mean(
        listed.select("Industry", "DateKey", "TickerSymbol", "MarketCap"),
        ["Industry"], "DateKey", ["TickerSymbol", "MarketCap"], "MarketCap", rows, "avg_3m_marketcap",
    )
    year, month = F.floor(F.col("DateKey") / 10000), F.floor(F.col("DateKey") / 100) % 100
    out = rolled.select(
        "Industry", year.cast("int").alias("Year"), month.cast("int").alias("Month"), "avg_3m_marketcap"
    )
    return top(out, limit, F.desc_nulls_last("avg_3m_marketcap"), F.asc("Industry"), F.asc("Year"), F.asc("Month"))


def rolling_marketcap_monthly(
    t: Tables, rank: int = TOP_RANK, months: int = ROLLING_ROWS, limit: int = 10
) -> DataFrame:
    """The same question with true months: the mean of each month, then over three calendar months, of those that
    have quotes."""
    companies = ranked_companies(t, rank, "Industry")
    month = F.floor(F.col("DateKey") / 100).cast("int")
    quotes = t["FactStock"].select("DateKey", "CompanyKey", "MarketCap")
    monthly = (
        lookup_join(quotes, companies, ["CompanyKey"])
        .groupBy("Industry", month.alias("_month"))
        .agg(F.avg("MarketCap").alias("_mean"))
    )
    ordinal = F.floor(F.col("_month") / 100) * 12 + F.col("_month") % 100
    frame = Window.partitionBy("Industry").orderBy(ordinal).rangeBetween(1 - months, Window.currentRow)
    out = monthly.select(
        "Industry",
        F.floor(F.col("_month") / 100).cast("int").alias("Year"),
        (F.col("_month") % 100).cast("int").alias("Month"),
        F.avg("_mean").over(frame).alias("avg_3m_marketcap"),
    )
    return top(out, limit, F.desc_nulls_last("avg_3m_marketcap"), F.asc("Industry"), F.asc("Year"), F.asc("Month"))


def price_to_earnings(t: Tables, limit: int = 10, all_versions: bool = False) -> DataFrame:
    """Highest price to earnings of a day: mean close over mean profit, when that is positive."""
    firms = earnings(t, "CompanyName", "Industry", all_versions=all_versions)
    # Quotes are summed by company and day before names are joined: what is shuffled of the fact are numbers.
    daily = t["FactStock"].groupBy("DateKey", "CompanyKey").agg(
        F.sum("ClosePrice").alias("_sum"), F.count("ClosePrice").alias("_prices"), F.count(F.lit(1)).alias("_quotes")
    )
    earned = F.sum(F.when(F.col("Profit").isNotNull(), F.col("_quotes")))
    grouped = (
        lookup_join(daily, firms, ["CompanyKey"])
        .groupBy("DateKey", "CompanyName", "Industry")
        .agg(
            ratio(F.sum("_sum"), F.sum("_prices")).alias("_close"),
            ratio(F.sum(F.col("Profit") * F.col("_quotes")), earned).alias("_profit"),
        )
        .where(F.col("_profit") > 0)
    )
    day = F.col("DateKey")
    out = grouped.select(
        F.floor(day / 10000).cast("int").alias("Year"),
        (F.floor(day / 100) % 100).cast("int").alias("Month"),
        (day % 100).cast("int").alias("Day"),
        "CompanyName",
        "Industry",
        ratio(F.col("_close"), F.col("_profit")).alias("pe_ratio"),
    )
    return top(
        out, limit, F.desc_nulls_last("pe_ratio"),
        F.asc("CompanyName"), F.asc("Industry"), F.asc("Year"), F.asc("Month"), F.asc("Day"),
    )


def return_on_assets(t: Tables, limit: int = 10, all_versions: bool = False) -> DataFrame:
    """Companies by profit per asset, over every year on file."""
    figures = t["FactFinancials"].where(F.col("Assets") > 0).select("CompanyKey", "Profit", "Assets")
    out = (
        companies_of(t, all_versions).select("CompanyKey", "CompanyName", "Industry")
        .join(figures, "CompanyKey")
        .select("CompanyName", "Industry", ratio(F.col("Profit"), F.col("Assets")).alias("roa"))
    )
    return top(out, limit, F.desc_nulls_last("roa"), F.asc("CompanyName"), F.asc("Industry"))


def profitable(t: Tables, all_versions: bool = False) -> DataFrame:
    return earnings(t, "CompanyName", "Industry", all_versions=all_versions).where(F.col("Profit") > 0)


def company_pe(t: Tables, firms: DataFrame) -> DataFrame:
    """Mean price to earnings of each of the profitable ``firms``.

    Profit is constant per company, so closes are summed per company before any join and the mean
    of the ratios is the sum divided once.
    """
    closes = t["FactStock"].groupBy("CompanyKey").agg(
        F.sum("ClosePrice").alias("_close"), F.count("ClosePrice").alias("_n")
    )
    return (
        closes.join(firms, "CompanyKey")
        .groupBy("Industry", "CompanyName")
        .agg(
            F.sum(ratio(F.col("_close"), F.col("Profit"))).alias("_sum"), F.sum("_n").alias("_n")
        )
        .select("Industry", "CompanyName", ratio(F.col("_sum"), F.col("_n")).alias("company_pe"))
    )


def industry_pe_by_day(
    t: Tables, firms: DataFrame, rank: int = LIST_SIZE, until: date | None = None
) -> DataFrame:
    """Mean price to earnings of each industry on each day, among the ranked of ``firms``."""
    firms = firms.select("CompanyKey", "Industry", "Profit").join(ranked_keys(t, rank), "CompanyKey", "left_semi")
    fact = t["FactStock"] if until is None else up_to(t["FactStock"], until)
    quotes = fact.select("TradingDate", "CompanyKey", "ClosePrice")
    return (
        lookup_join(quotes, firms, ["CompanyKey"])
        .groupBy("Industry", "TradingDate")
        .agg(F.avg(ratio(F.col("ClosePrice"), F.col("Profit"))).alias("avg_pe"))
    )


def peer_pe(
    t: Tables, rank: int = LIST_SIZE, limit: int = 20, until: date | None = None, all_versions: bool = False
) -> DataFrame:
    """Companies against the daily means of their industry, first ``limit`` rows of the listing.

    The listing pairs every company with every day of its industry, ordered by industry and
    descending difference. Only the ``limit`` dearest companies and cheapest days of an industry
    can appear in its first ``limit`` rows, so nothing else is paired.
    """
    dear = Window.partitionBy("Industry").orderBy(F.desc_nulls_last("company_pe"), F.asc("CompanyName"))
    cheap = Window.partitionBy("Industry").orderBy(F.asc_nulls_last("avg_pe"), F.asc("TradingDate"))
    firms = profitable(t, all_versions)
    companies = (
        company_pe(t, firms).withColumn("_i", F.row_number().over(dear)).where(F.col("_i") <= limit)
    )
    days = (
        industry_pe_by_day(t, firms, rank, until)
        .withColumn("_j", F.row_number().over(cheap))
        .where(F.col("_j") <= limit)
    )
    out = companies.join(days, "Industry").select(
        "TradingDate", "Industry", "CompanyName", "company_pe", "avg_pe",
        (F.col("company_pe") - F.col("avg_pe")).alias("delta"),
    )
    return top(
        out, limit, F.asc("Industry"), F.desc_nulls_last("delta"), F.desc_nulls_last("company_pe"),
        F.asc("CompanyName"), F.asc_nulls_last("avg_pe"), F.asc("TradingDate"),
    )


def peer_pe_top(t: Tables, rank: int = LIST_SIZE, until: date | None = None) -> DataFrame:
    """The dearest company of each industry on the last trading day, against that day's mean."""
    day = last_trading_day(t, until)
    quotes = on_day(t["FactStock"], day).select("TradingDate", "CompanyKey", "ClosePrice")
    firms = profitable(t).join(ranked_keys(t, rank), "CompanyKey", "left_semi")
    priced = (
        lookup_join(quotes, firms, ["CompanyKey"])
        .groupBy("TradingDate", "Industry", "CompanyName")
        .agg(
            F.sum(ratio(F.col("ClosePrice"), F.col("Profit"))).alias("_sum"),
            F.count("ClosePrice").alias("_n"),
        )
        .withColumn("company_pe", ratio(F.col("_sum"), F.col("_n")))
    )
    means = priced.groupBy("TradingDate", "Industry").agg(
        ratio(F.sum("_sum"), F.sum("_n")).alias("avg_pe"),
        F.max(F.struct("company_pe", "CompanyName")).alias("_dearest"),
    )
    return means.select(
        "TradingDate", "Industry", F.col("_dearest.CompanyName").alias("CompanyName"),
        F.col("_dearest.company_pe").alias("company_pe"), "avg_pe",
        (F.col("_dearest.company_pe") - F.col("avg_pe")).alias("delta"),
    )


# --- profitability ------------------------------------------------------------------------------


def revenue_by_industry(
    t: Tables, rank: int = LIST_SIZE, limit: int = 20, all_versions: bool = False
) -> DataFrame:
    """Sales summed by industry among ranked companies; figures meet the rank of the same year."""
    ranked = t["FactForbesRank"].where(F.col("ForbesRank") <= rank).select("CompanyKey", "Year")
    sales = t["FactFinancials"].select("CompanyKey", "Year", "Sales").join(ranked, ["CompanyKey", "Year"])
    out = (
        companies_of(t, all_versions).select("CompanyKey", "Industry")
        .join(sales, "CompanyKey")
        .groupBy("Industry")
        .agg(F.sum(F.col("Sales").cast("decimal(20,0)")).alias("total_revenue"))
    )
    return top(out, limit, F.desc_nulls_last("total_revenue"), F.asc("Industry"))


def yoy_by_year(
    t: Tables, rank: int = LIST_SIZE, limit: int = 1, all_versions: bool = False
) -> DataFrame:
    """Industries by mean growth of their yearly mean close.

    Closes are summed per company and year first; what meets the dimensions is that small table.
    """
    year = F.floor(F.col("DateKey") / 10000).cast("int")
    closes = t["FactStock"].groupBy("CompanyKey", year.alias("Year")).agg(
        F.sum("ClosePrice").alias("_close"), F.count("ClosePrice").alias("_n")
    )
    firms = ranked_companies(t, rank, "Industry", all_versions=all_versions)
    yearly = (
        closes.join(firms, "CompanyKey")
        .groupBy("Industry", "Year")
        .agg(ratio(F.sum("_close"), F.sum("_n")).alias("avg_close"))
    )
    out = (
        growth(yearly, ["Industry"], ["Year"], "avg_close", "_growth")
        .groupBy("Industry")
        .agg(F.avg("_growth").alias("avg_yoy_growth"))
    )
    return top(out, limit, F.desc_nulls_last("avg_yoy_growth"), F.asc("Industry"))


def year_before(day: date) -> date:
    """The same day one year earlier; 29 February becomes the 28th."""
    try:
        return day.replace(year=day.year - 1)
    except ValueError:
        return day.replace(year=day.year - 1, day=28)


def _growth_by_industry(pairs: DataFrame, limit: int) -> DataFrame:
    """From one row per company, with the sum of its growths and their number."""
    per_company = pairs.groupBy("Industry", "CompanyKey").agg(
        F.sum("_growth").alias("_growth"), F.sum("_pairs").alias("_pairs")
    )
    out = per_company.groupBy("Industry").agg(
        (ratio(F.sum("_growth"), F.sum("_pairs")) * 100).alias("avg_yoy_growth_pct"),
        F.count(F.lit(1)).alias("company_count"),
    )
    return top(out, limit, F.desc_nulls_last("avg_yoy_growth_pct"), F.asc("Industry"))


def yoy_exact(
    t: Tables, day: date | None = None, limit: int = 10, all_versions: bool = False
) -> DataFrame:
    """Growth of each company's close from exactly one year before the latest day, by industry.

    Each quote of the day is compared with each quote a year before. The sum of those growths over
    all pairs, sum(c/p - 1), equals sum(c) * sum(1/p) - pairs, so each day is reduced to one row
    per company and no pair is formed. A prior price of zero has no growth and is left out.
    """
    day = day or last_trading_day(t)
    fact = t["FactStock"]
    now = on_day(fact, day).groupBy("CompanyKey").agg(
        F.sum("ClosePrice").alias("_now"), F.count("ClosePrice").alias("_m")
    )
    inverse = F.try_divide(F.lit(1.0), F.col("ClosePrice"))
    then = on_day(fact, year_before(day) if day else None).groupBy("CompanyKey").agg(
        F.sum(inverse).alias("_inverse"), F.count(inverse).alias("_k")
    )
    pairs = now.join(then, "CompanyKey").select(
        "CompanyKey",
        (F.col("_now") * F.col("_inverse") - F.col("_m") * F.col("_k")).alias("_growth"),
        (F.col("_m") * F.col("_k")).alias("_pairs"),
    )
    firms = companies_of(t, all_versions).select("CompanyKey", "Industry")
    return _growth_by_industry(pairs.join(firms, "CompanyKey"), limit)


def yoy_asof(t: Tables, day: date | None = None, limit: int = 10, all_versions: bool = False) -> DataFrame:
    """Growth between the last closes on or before the day and on or before one year earlier.

    Both closes of a company come from one pass over the fact and one shuffle. Of several tickers
    quoted on that last day the one with the highest key counts. Day and key are packed into one
    number, because a maximum over numbers is aggregated by hash where one over structs is sorted.
    """
    day = day or last_trading_day(t)
    date_of = F.col("TradingDate")
    recency = F.unix_date(date_of).cast("bigint") * (1 << 46) + F.shiftrightunsigned("TickerKey", 18)
    past = F.when(date_of <= F.lit(year_before(day) if day else None), recency)
    last = up_to(t["FactStock"], day).groupBy("CompanyKey").agg(
        F.max_by("ClosePrice", recency).alias("_now"), F.max_by("ClosePrice", past).alias("_then")
    )
    change = F.try_divide(F.col("_now") - F.col("_then"), F.col("_then"))
    pairs = last.where(F.col("_then").isNotNull()).select(
        "CompanyKey", change.alias("_growth"), F.when(change.isNotNull(), 1).otherwise(0).alias("_pairs")
    )
    firms = companies_of(t, all_versions).select("CompanyKey", "Industry")
    return _growth_by_industry(pairs.join(firms, "CompanyKey"), limit)
