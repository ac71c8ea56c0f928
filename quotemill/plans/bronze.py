"""From files to bronze: rankings with their ticker map, and the daily quote feed.

Every record of a file meets its outcome in one pass, which writes the outcomes side by side and counts them on the way;
what follows reads only the outcome it needs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.calendar import date_attributes, run_timestamp
from ..operators.dedup import keep_first
from ..operators.joins import lookup_join, map_left
from ..operators.sinks import append_typed, typed, write_rejects
from ..operators.upsert import append_absent_months, months_of, skip_loaded_days
from ..schemas import COMPANIES_RAW, MONTH, STOCKS_RAW
from ..session import fresh_path, pinned
from ..sources import delimited
from ..sources.documents import QUOTE_COLUMNS, parse_quotes
from .warehouse import Warehouse

OUTCOME = "outcome"
ACCEPTED, REJECTED, NOT_FOUND = "accepted", "rejected", "not_found"
QUOTED, NO_QUOTE, NO_TICKER, REPEATED, NO_RUN, LOADED = "quoted", "no_quote", "no_ticker", "repeated", "no_run", "loaded"


@dataclass(frozen=True)
class Outcomes:
    """Records of a load by outcome, and how many there are of each."""

    rows: DataFrame
    counts: Mapping[str, int]

    def of(self, outcome: str) -> DataFrame:
        return self.rows.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def settle(df: DataFrame, names: tuple[str, ...], label: str) -> Outcomes:
    """Write a frame with an outcome column, a folder per outcome, and count outcomes in the same job."""
    told = Observation(label)
    path = fresh_path(df.sparkSession, label)
    counted = df.observe(told, *[F.count_if(F.col(OUTCOME) == n).alias(n) for n in names])
    counted.write.partitionBy(OUTCOME).parquet(path)
    got = told.get
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    return Outcomes(read, {n: got.get(n) or 0 for n in names})


# --- rankings -----------------------------------------------------------------------------------


def ranking_outcomes(rankings: DataFrame, tickers: DataFrame) -> DataFrame:
    """Parsed rankings with an outcome. A company without a ticker is ``not_found`` besides being accepted or rejected.

    rankings: columns of a ranking file and ``_file``; tickers: Rank, Company, Ticker. They meet on trimmed rank and
    company; a company that the map lists twice is taken once per ticker.
    """
    trimmed = C.trim_strings(rankings)
    known = C.trim_strings(tickers.select("Rank", "Company", "Ticker")).distinct()
    parsed = delimited.parse_rankings(map_left(trimmed, known, ["Rank", "Company"]))
    missing = F.coalesce(F.col("Ticker"), F.lit("")) == ""
    outcomes = F.array(F.when(F.col("Reason").isNull(), ACCEPTED).otherwise(REJECTED), F.when(missing, NOT_FOUND))
    return parsed.withColumn(OUTCOME, F.explode(F.array_compact(outcomes)))


def not_found(rows: DataFrame) -> DataFrame:
    """Rank and company of what has no ticker, as the file lists them."""
    return rows.select("Rank", "Company")


def load_rankings(
    wh: Warehouse, path: str, tickers: DataFrame, as_of: str, rejects: str | None = None, missing: str | None = None
) -> Outcomes:
    """Ranking files to bronze: accepted rows are appended as versions of ``as_of``; rejected rows with their reason and
    companies without a ticker go to ``;`` files if paths are given."""
    found = settle(ranking_outcomes(delimited.read_rankings(wh.spark, path), tickers), (ACCEPTED, REJECTED, NOT_FOUND), "rankings")
    append_typed(delimited.accepted(found.of(ACCEPTED)), COMPANIES_RAW, wh.path("bronze", "companies_raw"), as_of)
    if rejects:
        write_rejects(delimited.rejected(found.of(REJECTED)), rejects)
    if missing:
        write_rejects(not_found(found.of(NOT_FOUND)), missing)
    return found


# --- quotes -------------------------------------------------------------------------------------


def listed_tickers(companies: DataFrame) -> DataFrame:
    """The tickers a run asks for: each once, missing ones left out."""
    ticker = C.strip(F.col("ticker"))
    return companies.where(F.coalesce(ticker, F.lit("")) != "").select(ticker.alias("ticker_symbol")).distinct()


def quote_outcomes(feed: DataFrame, position: str = "position") -> DataFrame:
    """Feed records as stock columns with an outcome.

    feed: run_at (ISO text), ticker, info (quote as JSON) and the position that orders records. In turn: ``no_run`` if
    the run's time cannot be read, ``no_ticker`` if the ticker is missing, ``repeated`` if an earlier record of the run
    has the ticker, ``no_quote`` if the quote is empty or cannot be read, else ``quoted``.
    """
    moment = run_timestamp(F.col("run_at"))
    ticker = C.strip(F.col("ticker"))
    known = feed.select("run_at", ticker.alias("ticker"), "info", F.col(position).alias("_position"), moment.alias("execution_date_utc"))
    usable = (F.coalesce("ticker", F.lit("")) != "") & F.col("execution_date_utc").isNotNull()
    first = keep_first(known.where(usable), ["execution_date_utc", "ticker"], ["_position", "info"])
    first = first.select("execution_date_utc", "ticker", "_position", F.col("info").alias("_info")).withColumn("_first", F.lit(True))
    on = ["execution_date_utc", "ticker", "_position"]
    marked = lookup_join(known, first, on, "left", unique=True)
    marked = marked.withColumn("_first", F.coalesce(F.col("_first") & F.col("info").eqNullSafe(F.col("_info")), F.lit(False))).drop("_info")
    parsed = parse_quotes(marked, F.col("ticker"), F.col("info"), skip_empty=False)
    quote = F.coalesce(*[F.col(c).cast("string") for c in QUOTE_COLUMNS.values()]).isNotNull()
    outcome = (
        F.when(F.col("execution_date_utc").isNull(), NO_RUN)
        .when(F.coalesce("ticker", F.lit("")) == "", NO_TICKER)
        .when(~F.col("_first"), REPEATED)
        .when(~quote, NO_QUOTE)
        .otherwise(QUOTED)
    )
    days: dict[str, Column] = date_attributes(F.col("execution_date_utc"))
    measures = [F.col(c) for c in QUOTE_COLUMNS.values()]
    return parsed.select(
        "run_at", "ticker", "ticker_symbol", *measures, "execution_date_utc", *[e.alias(n) for n, e in days.items()], outcome.alias(OUTCOME)
    )


def load_quotes(wh: Warehouse, feed: DataFrame, as_of: str, companies: DataFrame | None = None, position: str = "position") -> Outcomes:
    """A feed of one run or many to bronze, with the daily load's guards.

    Quotes of a day that bronze has any quote of are ``loaded`` and skipped, so that a run that is repeated adds
    nothing; only that day's month is looked at. With ``companies`` only their tickers are taken. A quote that is stored
    already stays. Returns the outcomes; counts of ``loaded`` and ``quoted`` are those after the guard.
    """
    spark: SparkSession = wh.spark
    if companies is not None:
        feed = lookup_join(feed.withColumn("ticker_symbol", C.strip(F.col("ticker"))), pinned(listed_tickers(companies), "tickers"), ["ticker_symbol"], "left_semi").drop("ticker_symbol")
    found = settle(quote_outcomes(feed, position), (QUOTED, NO_QUOTE, NO_TICKER, REPEATED, NO_RUN), "quotes")
    path = wh.path("bronze", "stocks_raw")
    quotes = typed(found.of(QUOTED), STOCKS_RAW, as_of=as_of)
    exists = wh.exists("bronze", "stocks_raw")
    counts = dict(found.counts) | {LOADED: 0}
    if exists:
        months = months_of(quotes, "execution_date_utc")
        stored = wh.read("bronze", "stocks_raw").where(F.col(MONTH).isin(months)).select("trading_day")
        quotes = pinned(skip_loaded_days(stored, quotes), "new-quotes")
        taken = quotes.count()
        counts |= {LOADED: counts[QUOTED] - taken, QUOTED: taken}
    append_absent_months(
        spark, path, quotes, ["ticker_symbol", "execution_date_utc"], "execution_date_utc", ["_ingested_at", *STOCKS_RAW.names[:-1]], exists, written=exists
    )
    return Outcomes(found.rows, counts)
