"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import cleaning as C
from ..functions import masking as M
from ..functions.calendar import date_attributes, run_timestamp_text, season
from ..functions.keys import surrogate_key
from ..operators import dedup, joins, masking, scd2, sinks, upsert, windows
from ..operators import quality as Q
from ..operators.months import MonthTable
from ..plans import analytics, bronze, classic, keychecks, publish, silver
from ..plans.pipeline import Run, run_pipeline
from ..plans.warehouse import Warehouse
from ..session import fresh_path, pinned
from ..sources import delimited, documents, sample, tables
from ..streaming import jobs
from . import inputs
from .scratch import AS_OF, KEYS, classic_star, database, gold, rounded, shown, warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def register(*names: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        for name in names or (fn.__name__,):
            QUERIES[name] = fn
        return fn

    return add


def _columns(df: DataFrame, *drop: str) -> DataFrame:
    return shown(df.drop("_ingested_at", *drop))


# --- sources ------------------------------------------------------------------------------------


@register()
def src_csv_companies(spark, sf):
    read = delimited.read_rankings(spark, inputs.ranking_file(spark, sf))
    return delimited.accepted(delimited.parse_rankings(read))


@register()
def src_csv_ctas(spark, sf):
    path = fresh_path(spark, "csv")
    customer = sample.table(spark, sf, "customer")
    customer.write.option("header", True).csv(path)
    return delimited.csv_to_table(spark, path, f"{database(spark)}.ctas_customer", customer.schema)


@register()
def src_table_scan(spark, sf):
    name = f"{database(spark)}.scan_companies"
    sinks.create_replace(sample.companies_raw(spark, sf).drop("_ingested_at"), name)
    return tables.scan(spark, name)


@register()
def src_json_project(spark, sf):
    path = fresh_path(spark, "documents")
    docs = sample.companies_raw(spark, sf).drop("_ingested_at")
    docs.withColumn("_id", F.md5("company")).write.json(path)
    return documents.read_documents(spark, path)


@register()
def src_quote_feed(spark, sf):
    feed = spark.read.schema("quote_id long, ticker string, info string").json(inputs.quote_files(spark, sf))
    parsed = documents.parse_quotes(feed, F.col("ticker"), F.col("info"))
    return parsed.drop("ticker", "info")


# --- sinks and load modes -----------------------------------------------------------------------


@register()
def sink_append_typed(spark, sf):
    """Two appends with a column the table does not declare, and without the ingestion time."""
    path = fresh_path(spark, "appended")
    stocks = sample.stocks_raw(spark, sf).withColumn("unknown", F.lit("x")).drop("_ingested_at")
    done = F.col("sector") == "F"
    sinks.append_typed(stocks.where(done), schemas.STOCKS_RAW, path)
    sinks.append_typed(stocks.where(~done), schemas.STOCKS_RAW, path)
    return _columns(spark.read.parquet(path))


@register()
def load_insert_absent_company(spark, sf):
    versions = sample.company_versions(spark, sf)
    target = versions.where(F.col("financial_year") <= 1995)
    batch = versions.where(F.col("financial_year") > 1995)
    return _columns(upsert.insert_absent(target, batch, ["rank"], ["_ingested_at"]))


def _stock_keys() -> list[str]:
    return ["ticker_symbol", "execution_date_utc"]


@register()
def load_insert_absent_stock(spark, sf):
    path = fresh_path(spark, "stocks")
    stocks = sample.stocks_raw(spark, sf)
    early = stocks.where(F.col("trading_day") < F.lit("1998-01-01").cast("date"))
    for batch, exists in ((early, False), (stocks, True)):
        upsert.append_absent_months(
            spark, path, batch, _stock_keys(), "execution_date_utc", ["_ingested_at"], exists
        )
    return _columns(upsert.read_months(spark, path))


def _month_table(spark, schema, day, sort=()):
    """A table of this application that is switched by month."""
    path = fresh_path(spark, "switched")
    return MonthTable(spark, f"{database(spark)}.{path.rsplit('/', 1)[-1].replace('-', '_')}", path, schema, day, tuple(sort))


@register()
def load_skip_existing_day(spark, sf):
    """The stored days come from the months of the batch alone."""
    stocks = sample.stocks_raw(spark, sf)
    table = _month_table(spark, schemas.STOCKS_RAW, "execution_date_utc")
    table.replace(stocks.where(F.col("trading_day") < F.lit("1999-01-01").cast("date")))
    stored = table.read(table.months_of(stocks)).select("trading_day")
    return _columns(upsert.skip_loaded_days(stored, stocks))


@register()
def load_upsert_rank(spark, sf):
    versions = sample.company_versions(spark, sf)
    target = dedup.keep_first(versions, ["rank"], ["_ingested_at"])
    batch = versions.where(F.col("financial_year") >= 2000)
    return _columns(upsert.upsert_whole(target, batch, ["rank"], ["_ingested_at"]))


@register()
def load_full_refresh(spark, sf):
    path = fresh_path(spark, "refreshed")
    sinks.full_refresh(sample.company_versions(spark, sf), path)
    sinks.full_refresh(sample.companies_raw(spark, sf), path)
    return _columns(spark.read.parquet(path))


@register()
def load_delete_keys(spark, sf):
    versions = sample.company_versions(spark, sf)
    losses = sample.companies_raw(spark, sf).where(F.col("profit_in_millions") < 0).select("rank")
    return _columns(upsert.delete_keys(versions, losses, ["rank"]))


@register()
def load_delete_keys_months(spark, sf):
    """Only the months that hold a listed key are rewritten."""
    stocks = sample.stocks_raw(spark, sf)
    table = _month_table(spark, schemas.STOCKS_RAW, "execution_date_utc")
    table.replace(stocks)
    filled = stocks.where((F.year("trading_day") == 1996) & (F.col("sector") == "F"))
    table.delete(filled, _stock_keys())
    return _columns(table.read().drop(schemas.MONTH))


@register()
def load_compact_months(spark, sf):
    """Months that were added to are packed to the last version of each quote; later ones keep their files."""
    stocks = sample.stocks_raw(spark, sf)
    table = _month_table(spark, schemas.STOCKS_RAW, "execution_date_utc")
    table.append(stocks)
    again = stocks.where(F.col("trading_day") < F.lit("1998-01-01").cast("date"))
    later = (F.unix_timestamp("_ingested_at") + 4_000_000_000).cast("timestamp")
    table.append(again.withColumn("close_price", F.col("close_price") * 2).withColumn("_ingested_at", later))
    table.compact(_stock_keys(), ["_ingested_at"])
    return _columns(table.read().drop(schemas.MONTH))


@register()
def load_rankings_file(spark, sf):
    """Ranking and ticker files to bronze: what was accepted."""
    wh = Warehouse(spark, fresh_path(spark, "files"))
    tickers = delimited.read_ticker_map(spark, inputs.ticker_file(spark, sf))
    bronze.load_rankings(wh, inputs.ranking_file(spark, sf), tickers, AS_OF)
    return _columns(wh.read("bronze", "companies_raw"))


@register()
def sink_tickers_not_found(spark, sf):
    """Companies without a ticker, as their file lists them."""
    wh = Warehouse(spark, fresh_path(spark, "files"))
    tickers = delimited.read_ticker_map(spark, inputs.ticker_file(spark, sf))
    path = fresh_path(spark, "not-found")
    bronze.load_rankings(wh, inputs.ranking_file(spark, sf), tickers, AS_OF, missing=path)
    return spark.read.schema("Rank string, Company string").option("header", True).option("sep", ";").csv(path)


@register()
def load_quotes_feed(spark, sf):
    """A feed of the runs before 1998, then one of all runs with other prices: days that were loaded are skipped."""
    wh = Warehouse(spark, fresh_path(spark, "feeds"))
    early = F.col("run_at").like("199%") & (F.col("run_at") < "1998")
    companies = sample.companies_raw(spark, sf)
    bronze.load_quotes(wh, inputs.quote_feed(spark, sf).where(early), AS_OF, companies)
    bronze.load_quotes(wh, inputs.quote_feed(spark, sf, 2.0), AS_OF, companies)
    return _columns(wh.read("bronze", "stocks_raw").drop(schemas.MONTH))


@register()
def load_compact_dedup(spark, sf):
    """A table that was loaded twice, compacted to the last version of each quote."""
    loaded, compacted = fresh_path(spark, "loaded"), fresh_path(spark, "compacted")
    for _ in range(2):
        sample.stocks_raw(spark, sf).write.mode("append").parquet(loaded)
    sinks.compact(spark.read.parquet(loaded), _stock_keys(), ["_ingested_at"], compacted)
    return _columns(spark.read.parquet(compacted))


@register()
def sink_create_replace(spark, sf):
    name = f"{database(spark)}.replaced"
    sinks.create_replace(sample.table(spark, sf, "nation"), name)
    sinks.create_replace(sample.table(spark, sf, "supplier"), name)
    return spark.table(name)


@register()
def sink_ctas_sorted(spark, sf):
    path = fresh_path(spark, "sorted")
    sinks.ctas_sorted(sample.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], path)
    return shown(spark.read.parquet(path))


@register()
def sink_rejects(spark, sf):
    read = delimited.read_rankings(spark, inputs.ranking_file(spark, sf))
    path = fresh_path(spark, "rejects")
    rejects = delimited.rejected(delimited.parse_rankings(read))
    sinks.write_rejects(rejects, path)
    return spark.read.schema(rejects.schema).option("header", True).option("sep", ";").csv(path)


@register()
def sink_month_partition(spark, sf):
    table = _month_table(spark, schemas.STOCKS_RAW, "execution_date_utc", ["ticker_symbol"])
    table.replace(sample.stocks_raw(spark, sf))
    return (
        table.read()
        .groupBy("yyyymm")
        .agg(
            F.count(F.lit(1)).alias("n_quotes"),
            F.min("trading_day").alias("first_day"),
            F.max("trading_day").alias("last_day"),
            F.sum("market_cap").cast("bigint").alias("market_cap"),
        )
    )


# --- cleaning -----------------------------------------------------------------------------------


@register()
def clean_trim(spark, sf):
    turns = sample.table(spark, sf, "conversations")
    padded = turns.withColumn("role", F.concat(F.lit(" \t"), F.col("role"), F.lit("\n "))).withColumn(
        "text", F.concat(F.lit("\r\n "), F.col("text"), F.lit("\t"))
    )
    return C.trim_strings(padded)


@register()
def clean_amount(spark, sf):
    price = F.col("o_totalprice")
    text = (
        F.when(F.col("o_orderstatus") == "P", "  ")
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("0."), F.col("o_custkey").cast("string"), F.lit(".6")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" $"), F.format_number(price, 2)))
        .otherwise(price.cast("string"))
    )
    return sample.table(spark, sf, "orders").select(
        "o_orderkey", C.parse_amount(text).alias("amount"), C.parse_amount(price, numeric=True).alias("from_number")
    )


@register()
def clean_defaults(spark, sf):
    return _columns(sinks.with_defaults(sample.stocks_raw(spark, sf)))


@register()
def clean_nan_null(spark, sf):
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).when(
        F.col("event_type") != "view", F.col("value") * 1000
    )
    return sample.table(spark, sf, "events").select(
        "event_id", C.nan_to_null(value).alias("price"), C.nan_to_null(value, "bigint").alias("market_cap")
    )


@register()
def clean_reject_split(spark, sf):
    read = delimited.read_rankings(spark, inputs.ranking_file(spark, sf))
    return delimited.parse_rankings(read).select(
        F.col("Rank").alias("rank_text"), "Company", "sales_in_millions", "profit_in_millions",
        "market_value_in_millions", "Reason",
    )


@register()
def clean_year_from_file(spark, sf):
    """Rankings of several years, one file name per year; the year is read back from the name."""
    path = fresh_path(spark, "yearly")
    versions = sample.company_versions(spark, sf)
    (
        versions.select(
            F.col("rank").cast("string").alias("Rank"),
            F.col("company").alias("Company"),
            F.concat(F.lit("rankings_"), F.col("financial_year").cast("string"), F.lit(".csv")).alias("file"),
        )
        .hint("rebalance", "file")
        .write.partitionBy("file").option("header", True).option("sep", ";").csv(path)
    )
    read = delimited.read_delimited(
        spark, path, T.StructType.fromDDL("Rank string, Company string"), with_file=True
    )
    return (
        read.select(C.parse_rank(F.col("Rank")).alias("rank"), C.year_from_file(F.col("_file")).alias("financial_year"))
        .groupBy("rank", "financial_year")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@register("date_attributes")
def date_attributes_query(spark, sf):
    moment = F.col("o_orderdate")
    return sample.table(spark, sf, "orders").select(
        "o_orderkey", *[expr.alias(name) for name, expr in date_attributes(moment).items()]
    )


@register()
def date_season(spark, sf):
    orders = sample.table(spark, sf, "orders")
    return orders.groupBy(
        F.month("o_orderdate").cast("int").alias("month"), season(F.col("o_orderdate")).alias("season")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@register()
def filter_missing_ticker(spark, sf):
    ticker = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .when(F.col("o_orderpriority") == "1-URGENT", "  ")
        .when(F.col("o_orderpriority") == "2-HIGH", "")
        .otherwise(F.concat(F.lit("T"), F.col("o_custkey").cast("string")))
    )
    orders = sample.table(spark, sf, "orders").select("o_orderkey", ticker.alias("ticker"))
    return C.with_ticker(orders, "ticker")


@register()
def dedup_keep_first(spark, sf):
    versions = sample.company_versions(spark, sf)
    return _columns(dedup.keep_first(versions, ["ticker"], ["_ingested_at"]))


@register()
def limit_first_n(spark, sf):
    """The first hundred rows by input order, then the first row of each ticker among them."""
    versions = sample.company_versions(spark, sf)
    first = dedup.first_rows(versions, 100, ["_ingested_at"])
    return _columns(dedup.keep_first(first, ["ticker"], ["_ingested_at"]))


@register()
def clean_run_timestamp(spark, sf):
    events = sample.table(spark, sf, "events")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(iso)
    return events.select("event_id", run_timestamp_text(text).alias("execution_date_utc"))


# --- dedup and silver ---------------------------------------------------------------------------


@register()
def dedup_last_version(spark, sf):
    lines = sample.table(spark, sf, "lineitem")
    return shown(dedup.last_version(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@register()
def view_companies(spark, sf):
    return silver.companies_view(sample.company_versions(spark, sf), rank_only=True)


@register()
def view_companies_years(spark, sf):
    return silver.companies_view(sample.company_versions(spark, sf))


def _companies(spark, sf):
    return silver.companies_view(sample.companies_raw(spark, sf))


def _stocks(spark, sf):
    return silver.stocks_view(sample.stocks_raw(spark, sf))


@register()
def view_stocks(spark, sf):
    return shown(_stocks(spark, sf))


@register()
def stg_dim_company(spark, sf):
    return silver.dim_company(_companies(spark, sf), KEYS)


@register()
def stg_dim_date(spark, sf):
    return silver.dim_date(_stocks(spark, sf))


@register()
def stg_dim_ticker(spark, sf):
    return silver.dim_ticker(_stocks(spark, sf), KEYS)


@register()
def stg_dim_ticker_distinct(spark, sf):
    return silver.dim_ticker(_stocks(spark, sf), KEYS, distinct=True)


@register()
def stg_fact_financials(spark, sf):
    return silver.fact_financials(_companies(spark, sf), KEYS)


@register()
def stg_fact_rank(spark, sf):
    return silver.fact_rank(_companies(spark, sf), KEYS)


@register()
def stg_fact_stock(spark, sf):
    return inputs.stock_facts(spark, sf)


@register()
def stg_fact_stock_fan_out(spark, sf):
    """Every company row matches, as when companies are joined before they are deduplicated."""
    return silver.fact_stock(_stocks(spark, sf), sample.company_versions(spark, sf), KEYS, fan_out=True).select(
        "DateKey", "CompanyKey", "TickerKey", "ClosePrice"
    )


@register()
def key_hash(spark, sf):
    companies = sample.companies_raw(spark, sf)
    stocks = sample.stocks_raw(spark, sf).select("ticker_symbol", "exchange").distinct()
    return companies.select(
        F.lit("company").alias("kind"), surrogate_key("company", "headquarters", method=KEYS).alias("key")
    ).unionByName(
        stocks.select(
            F.lit("ticker").alias("kind"), surrogate_key("ticker_symbol", "exchange", method=KEYS).alias("key")
        )
    )


# --- gold loads ---------------------------------------------------------------------------------


@register()
def mart_rebuild(spark, sf):
    wh = Warehouse(spark, fresh_path(spark, "marts"))
    return wh.rebuild_mart("FactFinancials", silver.fact_financials(_companies(spark, sf), KEYS))


def _before(day: str):
    return F.col("TradingDate") < F.lit(day).cast("date")


@register()
def incr_high_watermark(spark, sf):
    """The mark of the stored fact is asked of its files' footers."""
    facts = pinned(inputs.stock_facts(spark, sf), "facts")
    table = _month_table(spark, schemas.GOLD["FactStock"], "TradingDate")
    table.replace(facts.where(_before("2000-06-15")))
    return facts.where(F.col("TradingDate") > F.lit(table.latest_day()))


def _fact_before_1999(spark, sf, table):
    facts = pinned(inputs.stock_facts(spark, sf), "facts")
    table.replace(facts.where(_before("1999-01-01")))
    return facts.where(~_before("1998-07-10")).withColumn("ClosePrice", F.col("ClosePrice") * 2)


@register()
def incr_delete_insert(spark, sf):
    table = _month_table(spark, schemas.GOLD["FactStock"], "TradingDate", schemas.GOLD_SORT_KEYS["FactStock"])
    table.delete_insert(_fact_before_1999(spark, sf, table), schemas.STOCK_KEYS)
    return table.read().drop(schemas.MONTH)


# --- runs ---------------------------------------------------------------------------------------


def _runs(spark, *runs):
    """A warehouse after some runs of (as_of, companies, stocks)."""
    wh = Warehouse(spark, fresh_path(spark, "runs"))
    for as_of, companies, stocks in runs:
        run_pipeline(Run(wh, as_of, keys=KEYS), companies, stocks)
    return wh


def _since(day: str):
    return F.col("trading_day") >= F.lit(day).cast("date")


@register()
def pipeline_three_runs(spark, sf):
    """The fact after early quotes, late ones, and everything once more."""
    companies, stocks = sample.companies_raw(spark, sf), sample.stocks_raw(spark, sf)
    parts = stocks.where(~_since("1997-01-01")), stocks.where(_since("1999-01-01")), stocks
    wh = _runs(spark, *[(f"2025-01-0{i + 2} 00:00:00", companies, part) for i, part in enumerate(parts)])
    return wh.gold()["FactStock"].select(*schemas.GOLD_COLUMNS["FactStock"])


@register()
def pipeline_late_quote(spark, sf):
    """Tickers after a run of late quotes: their state stays that of the last quote."""
    companies, stocks = sample.companies_raw(spark, sf), inputs.currency_by_status(sample.stocks_raw(spark, sf))
    early = ("2025-01-03 00:00:00", companies, stocks.where(~_since("1999-01-01")))
    wh = _runs(spark, ("2025-01-02 00:00:00", companies, stocks.where(_since("1999-01-01"))), early)
    return shown(wh.gold()["DimTicker"])


@register()
def pipeline_renamed_same_day(spark, sf):
    """The fact after all companies are renamed and newer quotes of stored days arrive."""
    companies, stocks = sample.companies_raw(spark, sf), sample.stocks_raw(spark, sf)
    at = F.col("execution_date_utc")
    morning = stocks.where(~_since("1999-01-01")).withColumn("execution_date_utc", at + F.expr("INTERVAL 10 HOURS"))
    evening = stocks.where(F.col("sector") == "F").withColumn("execution_date_utc", at + F.expr("INTERVAL 22 HOURS"))
    renamed = companies.withColumn("company", F.concat("company", F.lit(" Renamed"))).withColumn(
        "_ingested_at", F.lit("2030-01-01").cast("timestamp")
    )
    doubled = evening.withColumn("close_price", F.col("close_price") * 2)
    wh = _runs(spark, ("2025-01-02 00:00:00", companies, morning), ("2025-01-03 00:00:00", renamed, doubled))
    return wh.gold()["FactStock"].select(*schemas.GOLD_COLUMNS["FactStock"])


@register()
def key_hash_star(spark, sf):
    """Gold under the default 64-bit keys, with the keys joined away."""
    wh = Warehouse(spark, fresh_path(spark, "hashed"))
    run_pipeline(Run(wh, AS_OF), sample.companies_raw(spark, sf), sample.stocks_raw(spark, sf))
    t = wh.gold()
    companies = t["DimCompany"].select("CompanyKey", "CompanyName", "Headquarters")
    tickers = t["DimTicker"].select("TickerKey", "TickerSymbol", "Exchange")
    fact = t["FactStock"].select("CompanyKey", "TickerKey", "TradingDate", "ClosePrice", "MarketCap")
    star = joins.lookup_join(joins.lookup_join(fact, companies, ["CompanyKey"]), tickers, ["TickerKey"])
    return star.drop("CompanyKey", "TickerKey")


def _snapshots(spark, staged, key, check):
    path = fresh_path(spark, "versions")
    for i, (rows, taken) in enumerate(zip(staged, inputs.TAKEN)):
        scd2.store_snapshot(spark, path, rows, key, check, taken, first=i == 0)
    return scd2.read_snapshot(spark, path)


def _company_versions(spark, sf):
    versions = pinned(sample.company_versions(spark, sf), "versions")
    staged = [inputs.staged_companies(versions, period) for period in inputs.PERIODS]
    return _snapshots(spark, staged, "CompanyKey", schemas.COMPANY_CHECK_COLUMNS)


@register()
def scd2_company(spark, sf):
    return shown(_company_versions(spark, sf))


@register()
def scd2_ticker(spark, sf):
    staged = [inputs.staged_tickers(spark, sf, period) for period in inputs.PERIODS]
    return shown(_snapshots(spark, staged, "TickerKey", schemas.TICKER_CHECK_COLUMNS))


@register()
def scd2_expose(spark, sf):
    return shown(scd2.expose(_company_versions(spark, sf), schemas.GOLD_COLUMNS["DimCompany"]))


@register()
def scd2_expose_current(spark, sf):
    columns = schemas.GOLD_COLUMNS["DimCompany"]
    return shown(scd2.expose(_company_versions(spark, sf), columns, current_only=True))


# --- joins --------------------------------------------------------------------------------------


@register()
def join_star(spark, sf):
    t = gold(spark, sf)
    fact = t["FactStock"].select("DateKey", "CompanyKey", "TickerKey", "ClosePrice", "MarketCap")
    companies = t["DimCompany"].select("CompanyKey", "CompanyName", "Industry")
    tickers = t["DimTicker"].select("TickerKey", "TickerSymbol", "Exchange")
    dates = t["DimDate"].select("DateKey", "Year", "Quarter")
    star = joins.lookup_join(joins.lookup_join(fact, companies, ["CompanyKey"]), tickers, ["TickerKey"])
    return star.join(dates, "DateKey").drop("CompanyKey", "TickerKey")


@register()
def join_expr_key(spark, sf):
    companies = _companies(spark, sf).select("company", "headquarters", "rank")
    dim = gold(spark, sf)["DimCompany"].select("CompanyKey", "CompanyName", "Industry")
    on = silver.company_key(KEYS) == dim.CompanyKey
    return companies.join(dim, on).select("CompanyKey", "CompanyName", "Industry", "rank")


@register()
def join_left_map(spark, sf):
    companies = sample.companies_raw(spark, sf).select("rank", "company", "industry")
    return joins.map_left(companies, inputs.ticker_map(spark, sf), ["rank", "company"])


@register()
def join_anti_unresolved(spark, sf):
    companies = sample.companies_raw(spark, sf).select("rank", "company")
    return joins.unresolved(companies, inputs.ticker_map(spark, sf), ["rank", "company"])


@register()
def join_semi_existing(spark, sf):
    versions = sample.company_versions(spark, sf)
    target = versions.where(F.col("financial_year") <= 1995)
    companies = sample.companies_raw(spark, sf).select("rank", "company", "ticker")
    return joins.existing(companies, target, ["rank"])


# --- aggregates, windows, subqueries ------------------------------------------------------------


@register()
def agg_rare_groups(spark, sf):
    dim = gold(spark, sf)["DimCompany"]
    counts = dim.groupBy("Headquarters").agg(F.count("CompanyKey").alias("n_companies"))
    return counts.where(F.col("n_companies") < 50)


def _industry_facts(spark, sf, *columns):
    t = gold(spark, sf)
    companies = t["DimCompany"].select("CompanyKey", "Industry")
    return joins.lookup_join(t["FactStock"].select("CompanyKey", *columns), companies, ["CompanyKey"])


@register()
def agg_count_distinct(spark, sf):
    facts = _industry_facts(spark, sf, "TickerKey")
    return facts.groupBy("Industry").agg(
        F.countDistinct("CompanyKey").alias("n_companies"), F.countDistinct("TickerKey").alias("n_tickers")
    )


@register()
def agg_max_date(spark, sf):
    facts = _industry_facts(spark, sf, "TradingDate")
    return facts.groupBy("Industry").agg(F.max("TradingDate").alias("last_day"), F.min("TradingDate").alias("first_day"))


@register()
def agg_avg_of_ratio(spark, sf):
    """Mean of the quotes' own ratios, next to the ratio of the means."""
    t = gold(spark, sf)
    firms = analytics.earnings(t, "Industry")
    facts = joins.lookup_join(t["FactStock"].select("CompanyKey", "ClosePrice"), firms, ["CompanyKey"])
    out = facts.groupBy("Industry").agg(
        F.avg(analytics.ratio(F.col("ClosePrice"), F.col("Profit"))).alias("mean_of_ratios"),
        analytics.ratio(F.avg("ClosePrice"), F.avg("Profit")).alias("ratio_of_means"),
    )
    return rounded(out, mean_of_ratios=6, ratio_of_means=6)


@register()
def win_rolling_avg(spark, sf):
    t = gold(spark, sf)
    facts = _industry_facts(spark, sf, "DateKey", "TickerKey", "MarketCap")
    symbols = t["DimTicker"].select("TickerKey", "TickerSymbol")
    rows = joins.lookup_join(facts, symbols, ["TickerKey"]).select("Industry", "DateKey", "TickerSymbol", "MarketCap")
    return windows.rolling_mean(
        rows, ["Industry"], "DateKey", ["TickerSymbol", "MarketCap"], "MarketCap", 3, "avg_3_rows"
    )


@register()
def win_lag_growth(spark, sf):
    year = F.floor(F.col("DateKey") / 10000).cast("int").alias("Year")
    yearly = _industry_facts(spark, sf, "DateKey", "ClosePrice").groupBy("Industry", year).agg(
        F.avg("ClosePrice").alias("avg_close")
    )
    return rounded(windows.growth(yearly, ["Industry"], ["Year"], "avg_close", "yoy_growth"), avg_close=6, yoy_growth=9)


@register()
def win_group_count(spark, sf):
    dim = gold(spark, sf)["DimCompany"].select("CompanyKey", "CompanyName", "Industry")
    return windows.group_count(dim, ["Industry"], "Industry_count")


@register()
def sub_scalar_max(spark, sf):
    """Quotes of the fact's latest day: its files' footers tell the day, the catalog its month."""
    table = warehouse(spark, sf).months("gold", "FactStock")
    return table.on_day(table.latest_day()).select(*schemas.GOLD_COLUMNS["FactStock"])


# --- scalar functions ---------------------------------------------------------------------------


@register()
def fn_null_handling(spark, sf):
    return sample.stocks_raw(spark, sf).select(
        "market_cap",
        F.coalesce("exchange", F.lit("")).alias("exchange"),
        F.nullif(F.col("currency"), F.lit("USD")).alias("foreign_currency"),
        F.try_divide(F.col("close_price"), F.nullif(F.coalesce("dividend", F.lit(0.0)), F.lit(0.0))).alias("per_dividend"),
        F.concat("ticker_symbol", "exchange").alias("null_if_any"),
    )


@register()
def fn_date_parts(spark, sf):
    day = F.col("o_orderdate")
    return sample.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).cast("int").alias("year"),
        F.month(day).cast("int").alias("month"),
        F.dayofmonth(day).cast("int").alias("day"),
        F.quarter(day).cast("int").alias("quarter"),
        (F.year(day) * 100 + F.month(day)).cast("int").alias("yyyymm"),
    )


@register()
def fn_string_mask(spark, sf):
    return sample.table(spark, sf, "documents").select(
        "doc_id",
        F.substring("text", 1, 3).alias("head"),
        M.mask_prefix(F.col("text")).alias("masked"),
        F.length("text").cast("bigint").alias("n_characters"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
    )


@register()
def fn_int_div(spark, sf):
    return sample.table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("o_orderkey div 100").alias("hundreds"),
        F.expr("o_orderkey div 100 * 100 + 99").cast("string").alias("top"),
    )


@register()
def fn_interval(spark, sf):
    day = F.to_date("o_orderdate")
    return sample.table(spark, sf, "orders").select(
        "o_orderkey", (day - F.expr("INTERVAL 1 YEAR")).cast("date").alias("year_before")
    )


# --- the business questions ---------------------------------------------------------------------


@register()
def q1_rolling_marketcap(spark, sf):
    return analytics.rolling_marketcap(gold(spark, sf))


@register()
def q1_rolling_marketcap_monthly(spark, sf):
    return rounded(analytics.rolling_marketcap_monthly(gold(spark, sf)), avg_3m_marketcap=4)


@register()
def q2_pe_top10(spark, sf):
    return rounded(analytics.price_to_earnings(gold(spark, sf)), pe_ratio=6)


@register("q3_roa_top10", "topk_roa")
def q3_roa_top10(spark, sf):
    return analytics.return_on_assets(gold(spark, sf))


@register()
def q4_peer_pe(spark, sf):
    return rounded(analytics.peer_pe(gold(spark, sf)), company_pe=6, avg_pe=6, delta=6)


@register()
def q4_peer_pe_top1(spark, sf):
    return rounded(analytics.peer_pe_top(gold(spark, sf)), company_pe=6, avg_pe=6, delta=6)


@register()
def q5_revenue(spark, sf):
    out = analytics.revenue_by_industry(gold(spark, sf))
    return out.withColumn("total_revenue", F.col("total_revenue").cast("bigint"))


@register()
def q6_yoy_lag(spark, sf):
    return rounded(analytics.yoy_by_year(gold(spark, sf)), avg_yoy_growth=9)


@register()
def q6_yoy_exact(spark, sf):
    """Quotes are dated at the start of their year: single days are too thin to recur here."""
    t = gold(spark, sf)
    yearly = F.trunc("TradingDate", "year")
    fact = t["FactStock"].withColumn("TradingDate", yearly).drop(schemas.MONTH)
    dates = t["DimDate"].withColumn("TradingDate", yearly)
    out = analytics.yoy_exact({**t, "FactStock": fact, "DimDate": dates})
    return rounded(out, avg_yoy_growth_pct=6)


@register()
def q6_yoy_asof(spark, sf):
    return rounded(analytics.yoy_asof(gold(spark, sf)), avg_yoy_growth_pct=6)


def _classic(spark, sf):
    return classic_star(spark, sf)


@register()
def q1_rolling_marketcap_v1(spark, sf):
    return classic.rolling_marketcap(_classic(spark, sf))


@register()
def q2_pe_top10_v1(spark, sf):
    return classic.price_to_earnings(_classic(spark, sf))


@register()
def q3_roa_top10_v1(spark, sf):
    return classic.return_on_assets(_classic(spark, sf))


@register()
def q4_peer_pe_v1(spark, sf):
    return rounded(classic.peer_pe(_classic(spark, sf)), company_pe=6, avg_pe=6, delta=6)


@register()
def q5_revenue_v1(spark, sf):
    out = classic.revenue_by_industry(_classic(spark, sf))
    return out.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@register()
def q6_yoy_lag_v1(spark, sf):
    return rounded(classic.yoy_by_year(_classic(spark, sf)), avg_yoy_growth=9)


# --- data quality -------------------------------------------------------------------------------


@register()
def dq_ticker_not_null(spark, sf):
    """Over currencies as delivered, before blanks replace the missing ones."""
    tickers = sample.stocks_raw(spark, sf).select(
        surrogate_key("ticker_symbol", "exchange", method=KEYS).alias("TickerKey"),
        F.col("currency").alias("Currency"), "market_cap",
    )
    return tickers.where(Q.ticker_null())


@register()
def dq_fact_not_null(spark, sf):
    """Quotes of companies without earnings have no company here."""
    firms = sample.companies_raw(spark, sf).where(F.col("profit_in_millions") > 0).select(
        F.col("ticker").alias("ticker_symbol"), silver.company_key(KEYS).alias("CompanyKey")
    )
    quotes = sample.stocks_raw(spark, sf).select(
        "ticker_symbol", "market_cap", surrogate_key("ticker_symbol", "exchange", method=KEYS).alias("TickerKey"),
        F.col("trading_day").alias("TradingDate"),
    )
    return joins.map_left(quotes, firms, ["ticker_symbol"]).where(Q.fact_null())


@register()
def dq_currency_format(spark, sf):
    dim = gold(spark, sf)["DimTicker"].select("TickerKey", "TickerSymbol", "Exchange", "Currency")
    return dim.where(Q.currency_malformed())


def _gold_fact(spark, sf):
    return gold(spark, sf)["FactStock"].select(*schemas.GOLD_COLUMNS["FactStock"])


@register()
def dq_future_date(spark, sf):
    later = warehouse(spark, sf).months("gold", "FactStock").from_day("2001-01-01")
    return later.where(Q.in_future("2001-01-01")).select(*schemas.GOLD_COLUMNS["FactStock"])


@register()
def dq_nonpositive(spark, sf):
    return _gold_fact(spark, sf).where(Q.nonpositive())


@register()
def dq_fk_orphans(spark, sf):
    """Against dimensions that lack some members."""
    t = gold(spark, sf)
    earning = t["FactFinancials"].where(F.col("Profit") > 0).select("CompanyKey")
    return Q.orphans(
        t["FactStock"],
        {
            "CompanyKey": t["DimCompany"].join(earning, "CompanyKey", "left_semi"),
            "TickerKey": t["DimTicker"].where(F.col("Exchange") != ""),
            "DateKey": t["DimDate"].where(F.col("Year") < 2001),
        },
    )


@register()
def dq_pk_duplicates(spark, sf):
    return Q.duplicates(sample.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register()
def dq_gold_keys(spark, sf):
    """All key checks, over gold with repeated rows in two facts and members missing in three dimensions."""
    t = gold(spark, sf)
    figures, fact = t["FactFinancials"], t["FactStock"]
    planted = {
        "DimCompany": t["DimCompany"].join(figures.where(F.col("Profit") >= 0).select("CompanyKey"), "CompanyKey", "left_semi"),
        "DimTicker": t["DimTicker"].where(F.col("Exchange") != ""),
        "DimDate": t["DimDate"].where(F.col("Year") < 2001),
        "FactFinancials": figures.unionByName(figures.where(F.col("Profit") < 0)),
        "FactForbesRank": t["FactForbesRank"],
    }
    return keychecks.failures(planted, keychecks.count_keys(fact.unionByName(fact.where(F.year("TradingDate") == 1996))))


@register()
def dq_summary(spark, sf):
    t = gold(spark, sf)
    return Q.summary(
        [
            (t["DimTicker"], {"ticker_not_null": Q.ticker_null(), "currency_format": Q.currency_malformed()}),
            (
                t["FactStock"],
                {
                    "fact_not_null": Q.fact_null(),
                    "future_date": Q.in_future("2001-01-01"),
                    "nonpositive": Q.nonpositive(),
                },
            ),
        ]
    )


# --- privacy ------------------------------------------------------------------------------------


@register()
def mask_prefix(spark, sf):
    return sample.table(spark, sf, "part").select("p_partkey", M.mask_prefix(F.col("p_name")).alias("p_name_masked"))


@register()
def mask_rare(spark, sf):
    dim = gold(spark, sf)["DimCompany"].select("CompanyKey", "Headquarters", "Industry")
    both = masking.mask_rare(dim, "Headquarters", "Headquarters_masked", 50)
    return masking.mask_rare(both, "Industry", "Industry_masked", 300)


@register()
def mask_range(spark, sf):
    return masking.limited_rank(gold(spark, sf)["FactForbesRank"])


@register()
def full_views(spark, sf):
    """The full copies of the three company tables, joined back together."""
    views = publish.publish(warehouse(spark, sf), "analyst_full")
    out = views["v_DimCompany"].join(views["v_FactFinancials"], "CompanyKey")
    return shown(out.join(views["v_FactForbesRank"], ["CompanyKey", "Year"]))


@register()
def limited_views(spark, sf):
    views = publish.publish(warehouse(spark, sf), "analyst_limited", below=300)
    out = views["v_limited_DimCompany"].join(views["v_limited_FactFinancials"], "CompanyKey")
    return shown(out.join(views["v_limited_FactForbesRank"], ["CompanyKey", "Year"]))


@register()
def role_table_set(spark, sf):
    """Tables each role is given, with their row counts."""
    rows = []
    for role, (layer, _) in publish.ROLES.items():
        for name, df in publish.publish(warehouse(spark, sf), role).items():
            rows.append(
                df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                    F.lit(role).alias("role"), F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows"
                )
            )
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


# --- streaming ----------------------------------------------------------------------------------


@register()
def stream_bronze_ingest(spark, sf):
    wh = Warehouse(spark, fresh_path(spark, "stream"))
    feed = f"{wh.root}/feed"
    sample.stocks_raw(spark, sf).write.parquet(feed)
    stream = jobs.read_files(spark, feed, schemas.STOCKS_RAW)
    jobs.ingest_bronze(
        stream, wh, "stocks_raw", _stock_keys(), "execution_date_utc", ["_ingested_at"], f"{wh.root}/checkpoint"
    )
    return _columns(upsert.read_months(spark, wh.path("bronze", "stocks_raw")))


@register()
def stream_gold_upsert(spark, sf):
    wh = Warehouse(spark, fresh_path(spark, "stream"))
    batch = _fact_before_1999(spark, sf, wh.months("gold", "FactStock"))
    feed = f"{wh.root}/feed"
    batch.write.parquet(feed)
    jobs.upsert_gold(
        jobs.read_files(spark, feed, batch.schema), wh, "FactStock", schemas.STOCK_KEYS, "TradingDate",
        f"{wh.root}/checkpoint",
    )
    return wh.read("gold", "FactStock").drop(schemas.MONTH)
