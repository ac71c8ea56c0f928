import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from quotemill import schemas
from quotemill.operators.upsert import read_months
from quotemill.plans import publish
from quotemill.plans.pipeline import Run, run_pipeline
from quotemill.plans.warehouse import Warehouse
from quotemill.session import fresh_path
from quotemill.sources import sample
from quotemill.streaming import jobs

KEYS = ["ticker_symbol", "execution_date_utc"]


@pytest.fixture(scope="module")
def inputs(spark):
    companies, stocks = sample.companies_raw(spark, SMALL), sample.stocks_raw(spark, SMALL)
    sample.assert_schemas(companies, stocks)
    return companies, stocks


@pytest.fixture(scope="module")
def built(spark, inputs):
    """Two runs: quotes before 1999, then all others with some late ones and changed industries."""
    companies, stocks = inputs
    wh = Warehouse(spark, fresh_path(spark, "built"))
    early = stocks.where((F.year("trading_day") < 1999) & (F.col("exchange") != "5-LOW"))
    _, first = run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, early)
    counts = {n: df.count() for n, df in wh.gold().items()}
    changed = companies.withColumn(
        "industry", F.when(F.col("profit_in_millions") < 0, "DISTRESSED").otherwise(F.col("industry"))
    ).withColumn("_ingested_at", F.lit("2025-01-03").cast("timestamp"))
    _, second = run_pipeline(Run(wh, "2025-01-03 00:00:00"), changed, stocks)
    return wh, counts, first, second


def test_row_counts_by_layer(spark, inputs, built):
    companies, stocks = inputs
    wh, counts, first, second = built
    n = companies.count()
    losses = companies.where("profit_in_millions < 0").count()
    quotes = stocks.select(*KEYS).distinct().count()
    assert wh.read("bronze", "companies_raw").count() == 2 * n
    assert wh.read("bronze", "stocks_raw").count() == quotes
    gold = wh.gold()
    assert counts["DimCompany"] == n and gold["DimCompany"].count() == n + losses
    assert gold["DimCompany"].where("ValidTo IS NULL").count() == n
    assert gold["FactStock"].count() == quotes > counts["FactStock"]
    assert gold["DimDate"].count() == stocks.select("trading_day").distinct().count()
    assert gold["FactFinancials"].count() == gold["FactForbesRank"].count() == n
    opened = gold["DimCompany"].where("ValidTo IS NULL AND Industry = 'DISTRESSED'").select("ValidFrom").distinct()
    assert [str(r.ValidFrom) for r in opened.collect()] == ["2025-01-03 00:00:00"]
    failures = {r.test_name: r.failures for r in second.collect()}
    assert {n for n in failures if not n.endswith(("_key", "_orphan"))} == {
        "ticker_not_null", "currency_format", "fact_not_null", "future_date", "nonpositive",
    }
    assert len(failures) == 16 and not any(v for n, v in failures.items() if n.endswith(("_key", "_orphan")))
    for name, columns in schemas.GOLD_COLUMNS.items():
        assert [c for c in gold[name].columns if c != schemas.MONTH] == list(columns)


def test_two_runs_equal_one(spark, inputs, built):
    companies, stocks = inputs
    wh, *_ = built
    once = Warehouse(spark, fresh_path(spark, "once"))
    run_pipeline(Run(once, "2025-01-03 00:00:00"), companies, stocks)
    a, b = (w.gold()["FactStock"].select(*schemas.GOLD_COLUMNS["FactStock"]) for w in (wh, once))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_daily_modes(spark, inputs):
    """Companies on file are skipped and late quotes are left out, as the plain daily load does."""
    companies, stocks = inputs
    wh = Warehouse(spark, fresh_path(spark, "daily"))
    plain = dict(companies_once=True, late_quotes=False)
    run_pipeline(Run(wh, "2025-01-02 00:00:00", **plain), companies, stocks.where("trading_day BETWEEN '1998-01-01' AND '1998-12-31'"))
    before = wh.gold()["FactStock"].count()
    run_pipeline(Run(wh, "2025-01-03 00:00:00", **plain), companies.withColumn("industry", F.lit("X")), stocks)
    gold = wh.gold()
    assert gold["DimCompany"].where("Industry = 'X'").isEmpty() and gold["DimCompany"].count() == companies.count()
    days = gold["FactStock"].agg(F.min("TradingDate").alias("a"), F.max("TradingDate").alias("b")).first()
    assert days.a >= date(1998, 1, 1) and days.b > date(1999, 1, 1) and gold["FactStock"].count() > before


def test_dimensions_follow_the_latest_state(spark, inputs):
    """A ticker changes currency within a month and a company its industry between years."""
    companies, stocks = inputs
    one = stocks.where("ticker_symbol = 'T1'").orderBy("trading_day").limit(1).drop("exchange", "currency")
    quote = lambda day, currency: one.select(
        *[
            {
                "exchange": F.lit("X"), "currency": F.lit(currency), "trading_day": F.lit(day).cast("date"),
                "execution_date_utc": F.lit(day).cast("timestamp"),
            }.get(c, F.col(c) if c in one.columns else None).alias(c)
            for c in stocks.columns
        ]
    )
    years = companies.withColumn("financial_year", F.lit(2024))  # the same ranks again
    both = companies.unionByName(years.withColumn("industry", F.lit("ZZZ")))
    wh = Warehouse(spark, fresh_path(spark, "latest"))
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), both, quote("2024-05-02", "USD").union(quote("2024-05-20", "EUR")))
    run_pipeline(Run(wh, "2025-01-03 00:00:00"), both, quote("2024-05-25", "CHF").union(quote("2024-05-21", "USD")))
    gold = wh.gold()
    assert [(r.Currency, r.ValidTo is None) for r in gold["DimTicker"].orderBy("ValidFrom").collect()] == [("EUR", False), ("CHF", True)]
    assert gold["DimCompany"].where("Industry = 'ZZZ'").isEmpty()
    assert gold["DimCompany"].count() == companies.count() and gold["FactFinancials"].count() == 2 * companies.count()
    assert gold["FactStock"].count() == 4


def test_publish_and_register(spark, built):
    wh, *_ = built
    full, limited = publish.publish(wh, "analyst_full"), publish.publish(wh, "analyst_limited", below=35)
    assert sorted(full) == sorted(f"v_{n}" for n in schemas.GOLD_COLUMNS)
    assert "CompanyName" not in limited["v_limited_DimCompany"].columns
    assert "ForbesRank" not in limited["v_limited_FactForbesRank"].columns
    groups = limited["v_limited_DimCompany"].groupBy("Industry_masked").count().where("Industry_masked <> 'Other'")
    assert groups.where("count < 35").isEmpty()
    for name in ("DimDate", "DimTicker", "FactStock", "FactFinancials"):
        assert limited[f"v_limited_{name}"].count() == full[f"v_{name}"].count()
    assert full["v_FactStock"].columns == list(schemas.GOLD_COLUMNS["FactStock"])
    again = publish.publish(wh, "analyst_full", months=[199801, 199802])
    stored = wh.gold()["FactStock"].drop(schemas.MONTH)
    assert again["v_FactStock"].exceptAll(stored).isEmpty() and stored.exceptAll(again["v_FactStock"]).isEmpty()
    with pytest.raises(KeyError):
        publish.publish(wh, "nobody")
    wh.register(" Gold ", ["DimCompany", "FactStock"], prefix="tests_")
    joined = spark.sql(
        "SELECT count(*) n FROM tests_gold.FactStock f JOIN tests_gold.DimCompany c USING (CompanyKey) WHERE c.ValidTo IS NULL"
    )
    assert joined.first().n == wh.gold()["FactStock"].count()


def test_stream_ingest_in_several_batches_and_again(spark, inputs, path):
    _, stocks = inputs
    wh = Warehouse(spark, path)
    stocks.repartitionByRange(3, "execution_date_utc").write.parquet(f"{path}/feed")

    def ingest():
        stream = jobs.read_files(spark, f"{path}/feed", schemas.STOCKS_RAW, files_per_batch=1)
        jobs.ingest_bronze(stream, wh, "stocks_raw", KEYS, "execution_date_utc", ["_ingested_at"], f"{path}/checkpoint")

    ingest()
    stored = read_months(spark, wh.path("bronze", "stocks_raw"))
    n = stocks.select(*KEYS).distinct().count()
    assert stored.count() == n
    # A late copy of everything adds nothing.
    stocks.coalesce(1).write.mode("append").parquet(f"{path}/feed")
    ingest()
    assert read_months(spark, wh.path("bronze", "stocks_raw")).count() == n


QUOTE = "k string, at timestamp, v int"


def quotes(spark, *items):
    """(key, seconds from now, version) as rows of a feed."""
    now = int(time.time())
    return spark.createDataFrame(items, "k string, s long, v int").select("k", F.timestamp_seconds(F.lit(now) + F.col("s")).alias("at"), "v")


@pytest.fixture
def feed(spark, path, monkeypatch):
    """Batches of frames through the stream; every batch's months that were compared."""
    wh, compared = Warehouse(spark, path), []
    append = jobs.append_absent_months

    def spied(*args, **more):
        compared.append(append(*args, **more))

    monkeypatch.setattr(jobs, "append_absent_months", spied)

    def take(frame, recent="1 day"):
        frame.coalesce(1).write.mode("append").parquet(f"{path}/feed")
        stream = jobs.read_files(spark, f"{path}/feed", frame.schema)
        jobs.ingest_bronze(stream, wh, "q", ["k", "at"], "at", ["v"], f"{path}/checkpoint", recent)
        return sorted((r.k, r.v) for r in read_months(spark, wh.path("bronze", "q")).collect())

    return take, compared, monkeypatch


def test_stream_knows_recent_keys_and_compares_older_ones(spark, feed):
    take, compared, _ = feed
    soon, old = quotes(spark, ("new", 3600, 1)), quotes(spark, ("old", -(10**8), 1))
    assert take(quotes(spark, ("a", -60, 2), ("a", -60, 1), ("b", -60, None))) == [("a", 1), ("b", None)]
    assert take(soon.union(old)) == [("a", 1), ("b", None), ("new", 1), ("old", 1)]
    # Copies stop at the state: nothing is left to compare or to append. Versions that come later are copies too.
    assert take(soon.union(old).withColumn("v", F.lit(0))) == [("a", 1), ("b", None), ("new", 1), ("old", 1)]
    assert len(compared) == 2
    # A key's first row wins, a row without time is compared, a quote newer than any before is not.
    nowhere = quotes(spark, ("c", 0, 1)).withColumn("at", F.lit(None).cast("timestamp"))
    assert ("c", 1) in take(nowhere)
    assert ("far", 1) in take(quotes(spark, ("far", 40 * 86400, 1)))
    past = old.select(F.date_format("at", "yyyyMM").cast("int")).first()[0]
    assert compared == [None, [past], [], []]


def test_stream_batch_that_fails_is_taken_once(spark, feed):
    take, _, monkeypatch = feed
    assert take(quotes(spark, ("a", 0, 1))) == [("a", 1)]
    append = jobs.append_absent_months

    def lost(*args, **more):
        append(*args, **more)
        raise OSError("after the append")

    frame = quotes(spark, ("b", 5000, 1), ("a", 0, 2), ("c", -(10**7), 1))
    monkeypatch.setattr(jobs, "append_absent_months", lost)
    with pytest.raises(Exception, match="after the append"):
        take(frame)
    monkeypatch.setattr(jobs, "append_absent_months", append)
    stored = take(quotes(spark, ("d", 0, 1)))
    assert [s for s in stored if s[0] in "bcd"] == [("b", 1), ("c", 1), ("d", 1)]


def test_stream_keys_of_earlier_spans_are_compared(spark, feed):
    """A quote whose clock runs ahead comes again when the span it arrived in is over and forgotten."""
    take, _, _ = feed
    ahead = quotes(spark, ("a", 30, 1), ("b", -5, 1))
    assert take(ahead, "2 seconds") == [("a", 1), ("b", 1)]
    for _ in range(3):
        time.sleep(2.1)
        assert take(ahead, "2 seconds") == [("a", 1), ("b", 1)]


def test_stream_upsert_replaces_keys(spark, path):
    wh = Warehouse(spark, path)
    schema = "TradingDate date, k int, v string"
    frame = lambda *r: spark.createDataFrame(r, schema)
    day, late = date(2024, 2, 1), date(2024, 1, 5)
    from quotemill.operators.upsert import write_months

    target = wh.path("gold", "T")
    write_months(frame((day, 1, "a"), (late, 2, "a")), target, "TradingDate")
    frame((day, 1, "b"), (late, 3, "b")).coalesce(1).write.parquet(f"{path}/feed")
    stream = jobs.read_files(spark, f"{path}/feed", frame((day, 1, "")).schema)
    jobs.upsert_gold(stream, wh, "T", ["TradingDate", "k"], "TradingDate", f"{path}/checkpoint")
    assert rows(read_months(spark, target)) == [(late, 2, "a"), (late, 3, "b"), (day, 1, "b")]


def quote_of(stocks, day, hour, currency, close=1.0):
    one = stocks.where("ticker_symbol = 'T1'").orderBy("trading_day").limit(1)
    stamp = F.lit(f"{day} {hour}:00:00").cast("timestamp")
    changes = {"exchange": F.lit("X"), "currency": F.lit(currency), "trading_day": F.lit(day).cast("date"), "execution_date_utc": stamp}
    return one.select(*[changes.get(c, F.col(c)).alias(c) for c in stocks.columns])


def test_late_quote_does_not_turn_a_ticker_back(spark, inputs):
    companies, stocks = inputs
    wh = Warehouse(spark, fresh_path(spark, "late"))
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, quote_of(stocks, "2024-05-02", 10, "EUR"))
    run_pipeline(Run(wh, "2025-01-03 00:00:00"), companies, quote_of(stocks, "2023-01-10", 10, "USD"))
    gold = wh.gold()
    assert [(r.Currency, r.ValidTo) for r in gold["DimTicker"].collect()] == [("EUR", None)]
    assert gold["FactStock"].count() == 2


def test_renamed_company_keeps_its_stored_quotes_once(spark, inputs):
    companies, stocks = inputs
    wh = Warehouse(spark, fresh_path(spark, "renamed"))
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, quote_of(stocks, "2024-05-02", 10, "EUR"))
    later = companies.withColumn("company", F.concat("company", F.lit(" Renamed"))).withColumn("_ingested_at", F.lit("2030-01-01").cast("timestamp"))
    run_pipeline(Run(wh, "2025-01-03 00:00:00"), later, quote_of(stocks, "2024-05-15", 10, "EUR"))
    days = [r.DateKey for r in wh.gold()["FactStock"].orderBy("DateKey").collect()]
    assert days == [20240502, 20240515]


def test_two_quotes_of_a_day_give_one_row(spark, inputs):
    companies, stocks = inputs
    wh = Warehouse(spark, fresh_path(spark, "twice"))
    both = quote_of(stocks, "2024-05-02", 10, "EUR").union(quote_of(stocks, "2024-05-02", 22, "EUR"))
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, both)
    assert wh.gold()["FactStock"].count() == 1
