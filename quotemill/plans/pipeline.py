"""The daily run: bronze, silver, snapshots, gold, checks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.dedup import last_version
from ..operators.scd2 import expose, read_snapshot, store_snapshot
from ..operators.sinks import append_typed
from ..operators.upsert import append_absent_months, insert_absent, months_of
from ..schemas import (
    COMPANIES_RAW,
    COMPANY_CHECK_COLUMNS,
    GOLD_COLUMNS,
    MONTH,
    STOCK_KEYS,
    TICKER_CHECK_COLUMNS,
)
from ..session import pinned, together
from . import keychecks, silver
from .warehouse import Warehouse


# What one quote of the fact is known by, whatever company it was matched to.
DAY_KEYS = ["DateKey", "TickerKey"]
TICKER_STATES = "ticker_states"


@dataclass(frozen=True)
class Run:
    """What one run is given. Clocks are never read: ``as_of`` stamps versions and checks."""

    warehouse: Warehouse
    as_of: str
    keys: str = "xxhash64"
    # Companies already on file are skipped, as the daily load does, or appended as new versions.
    companies_once: bool = False
    # Quotes up to the fact's latest day are taken in by replacing their keys, or skipped.
    late_quotes: bool = True


@dataclass(frozen=True)
class Taken:
    """What a run has to look at in bronze: the months of its quotes, and their first and last day. Of a table that was
    new, all of it (no months)."""

    months: list[int] | None = None
    first: object = None
    last: object = None


def load_bronze(run: Run, companies: DataFrame, stocks: DataFrame) -> Taken:
    """Append the batch; returns which part of bronze its quotes lie in."""
    wh = run.warehouse
    if run.companies_once and wh.exists("bronze", "companies_raw"):
        companies = insert_absent(
            wh.read("bronze", "companies_raw"), companies, ["rank"], ["_ingested_at", *companies.columns]
        )
    order = ["_ingested_at", *[c for c in stocks.columns if c != "_ingested_at"]]
    exists = wh.exists("bronze", "stocks_raw")
    if exists:
        stocks = pinned(stocks, "quotes")

    def quotes() -> Taken:
        append_absent_months(
            wh.spark,
            wh.path("bronze", "stocks_raw"),
            stocks,
            ["ticker_symbol", "execution_date_utc"],
            "execution_date_utc",
            order,
            target_exists=exists,
            written=exists,
        )
        if not exists:
            return Taken()
        days = stocks.agg(F.min("trading_day").alias("first"), F.max("trading_day").alias("last")).first()
        return Taken(months_of(stocks, "execution_date_utc"), days["first"], days["last"])

    _, taken = together(
        lambda: append_typed(companies, COMPANIES_RAW, wh.path("bronze", "companies_raw"), run.as_of), quotes
    )
    return taken


def new_quotes(run: Run, taken: Taken) -> DataFrame:
    """Bronze quotes this run has to process: all quotes of the batch's days, from the partitions of its months only.

    Without late quotes the high-water mark applies too. It is put on the bronze scan, before the
    dedup, which is safe because all versions of a quote share their day.
    """
    wh = run.warehouse
    raw = wh.read("bronze", "stocks_raw")
    if taken.months is not None:
        raw = raw.where(F.col(MONTH).isin(taken.months))
        if taken.first is not None:
            day = F.col("trading_day")
            raw = raw.where(day.isNull() | ((day >= F.lit(taken.first)) & (day <= F.lit(taken.last))))
    if wh.exists("gold", "FactStock") and not run.late_quotes:
        mark = wh.months("gold", "FactStock").latest_day()
        if mark is not None:
            raw = raw.where(
                (F.col(MONTH) >= mark.year * 100 + mark.month) & (F.col("trading_day") > F.lit(mark))
            )
    return raw.drop(MONTH)


def build_silver(run: Run, taken: Taken) -> tuple[DataFrame, DataFrame]:
    """The deduplicated views, written because several models use each; stocks of this run only."""
    wh = run.warehouse
    companies, stocks = together(
        lambda: wh.write("silver", "companies", silver.companies_view(wh.read("bronze", "companies_raw"))),
        lambda: wh.write("silver", "stocks", silver.stocks_view(new_quotes(run, taken))),
    )
    return companies, stocks


def ticker_states(run: Run, stocks: DataFrame) -> DataFrame:
    """Of each ticker and exchange the state and time of its last quote, kept from run to run.

    A run merges its quotes into the stored states, so a late quote cannot turn a ticker back, and no run looks at
    quotes of earlier months again. Only a warehouse that has quotes but no states yet reads all of bronze, once.
    """
    wh = run.warehouse
    latest = silver.last_tickers(stocks)
    if wh.exists("silver", TICKER_STATES):
        latest = silver.last_tickers(wh.read("silver", TICKER_STATES, latest.schema).unionByName(latest))
    elif wh.exists("snapshots", "DimTicker"):
        latest = silver.last_tickers(silver.stocks_view(wh.read("bronze", "stocks_raw").drop(MONTH)))
    return wh.write("silver", TICKER_STATES, latest)


def build_snapshots(run: Run, companies: DataFrame, stocks: DataFrame) -> None:
    wh = run.warehouse
    tickers = stocks.select("ticker_symbol", F.coalesce("exchange", F.lit("")).alias("exchange")).distinct()
    concerned = ticker_states(run, stocks).join(tickers, ["ticker_symbol", "exchange"], "left_semi")
    staged = {
        "DimCompany": (
            silver.dim_company(silver.last_companies(companies), run.keys, run.as_of),
            "CompanyKey", COMPANY_CHECK_COLUMNS,
        ),
        "DimTicker": (
            silver.dim_ticker(concerned, run.keys, loaded_at=run.as_of),
            "TickerKey", TICKER_CHECK_COLUMNS,
        ),
    }

    def store(name: str) -> None:
        rows, key, check = staged[name]
        first = not wh.exists("snapshots", name)
        # One row is staged per natural key, so a conflict can only be two of them sharing a hash.
        store_snapshot(wh.spark, wh.path("snapshots", name), rows, key, check, run.as_of, first)

    together(*[lambda name=name: store(name) for name in staged])


def under_stored_companies(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """A quote of a day and ticker that is stored stays with the companies it is stored under, with the batch's values.

    So a company that is renamed keeps its earlier quotes, and a newer quote of a stored day still replaces the older.
    """
    companies = stored.groupBy(*DAY_KEYS).agg(F.collect_set("CompanyKey").alias("_stored"))
    joined = batch.join(companies, DAY_KEYS, "left")
    moved = joined.withColumn("CompanyKey", F.explode(F.coalesce("_stored", F.array("CompanyKey")))).select(*batch.columns)
    # Companies that shared a ticker give equal rows now.
    return moved.dropDuplicates(list(STOCK_KEYS))


def build_marts(run: Run, companies: DataFrame, stocks: DataFrame) -> list[int]:
    """Rebuild the small marts and take the quotes into the fact; returns the months of the fact that changed."""
    wh = run.warehouse

    def versions(name: str) -> DataFrame:
        return expose(read_snapshot(wh.spark, wh.path("snapshots", name)), GOLD_COLUMNS[name])

    def fact() -> list[int]:
        table = wh.months("gold", "FactStock")
        # One row per key: the last quote of a ticker's day. A ticker has one quote of a time, so there are no ties to
        # settle and columns that the fact does not have need not be moved.
        daily = last_version(
            stocks.select(*silver.FACT_COLUMNS, "execution_date_utc"), ["ticker_symbol", "exchange", "trading_day"],
            ["execution_date_utc"], mostly_once=True,
        )
        batch = silver.fact_stock(daily, companies, run.keys)
        if not table.exists():
            table.replace(batch)
            return list(table.locations())
        stored = table.read(months_of(stocks, "trading_day")).select(*DAY_KEYS, "CompanyKey")
        return table.delete_insert(under_stored_companies(batch, stored), STOCK_KEYS)

    def dates() -> None:
        days = silver.dim_date(stocks)
        if wh.exists("gold", "DimDate"):
            days = wh.read("gold", "DimDate").unionByName(days).distinct()
        wh.rebuild_mart("DimDate", days)

    changed, *_ = together(
        fact,
        dates,
        lambda: wh.rebuild_mart("DimTicker", versions("DimTicker")),
        lambda: wh.rebuild_mart("DimCompany", versions("DimCompany")),
        lambda: wh.rebuild_mart("FactFinancials", silver.fact_financials(companies, run.keys)),
        lambda: wh.rebuild_mart("FactForbesRank", silver.fact_rank(companies, run.keys)),
    )
    return changed


def check(run: Run) -> DataFrame:
    """One row per data test with its failures. A failure is reported and blocks nothing."""
    wh = run.warehouse
    gold = wh.gold()
    rows = Q.summary(
        [
            (gold["DimTicker"], {"ticker_not_null": Q.ticker_null(), "currency_format": Q.currency_malformed()}),
            (gold["FactStock"], {"fact_not_null": Q.fact_null(), "nonpositive": Q.nonpositive()}),
            # A table of its own, so that months before the run's are not opened for it.
            (wh.months("gold", "FactStock").from_day(run.as_of[:10]), {"future_date": F.lit(True)}),
        ]
    )
    return rows.unionByName(keychecks.failures(gold, keychecks.kept(wh).read()))


def run_pipeline(run: Run, companies: DataFrame, stocks: DataFrame) -> tuple[Mapping[str, DataFrame], DataFrame]:
    """Staging, snapshots, marts and tests in dependency order; returns gold and the test report."""
    taken = load_bronze(run, companies, stocks)
    companies_view, stocks_view = build_silver(run, taken)
    build_snapshots(run, companies_view, stocks_view)
    keychecks.refresh(run.warehouse, build_marts(run, companies_view, stocks_view))
    return run.warehouse.gold(), check(run)
