import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from quotemill import schemas
from quotemill.operators import versions
from quotemill.operators.months import NO_MONTH, MonthTable
from quotemill.operators.sinks import create_replace
from quotemill.plans import bronze, keychecks, publish
from quotemill.plans.pipeline import Run, Taken, new_quotes, run_pipeline, ticker_states, under_stored_companies
from quotemill.plans.warehouse import Warehouse
from quotemill.session import fresh_path
from quotemill.sources import sample
from quotemill.streaming import jobs
from quotemill.suite import inputs

SCHEMA = "day date, k int, v string"
JAN, FEB, MAR = date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def files(df) -> set[str]:
    return set(df.inputFiles())


@pytest.fixture
def frame(spark):
    return lambda *r: spark.createDataFrame(list(r), SCHEMA)


@pytest.fixture
def table(spark, path, frame):
    name = "months_" + path.rsplit("-", 1)[-1]
    made = MonthTable(spark, f"tests_months.{name}", f"{path}/T", frame((JAN, 1, "")).schema, "day", ("k",))
    assert not made.exists()
    made.replace(frame((JAN, 1, "a"), (FEB, 2, "b"), (FEB, 3, "c"), (None, 9, "n")))
    return made


def test_only_touched_months_move(table, frame):
    assert table.exists() and list(table.locations()) == [NO_MONTH, 202401, 202402]
    january = files(table.read([202401]))
    assert table.delete_insert(frame((FEB, 2, "B"), (MAR, 4, "d"), (None, 9, "N")), ["day", "k"]) == [NO_MONTH, 202402, 202403]
    want = [(JAN, 1, "a"), (FEB, 2, "B"), (FEB, 3, "c"), (MAR, 4, "d"), (None, 9, "N")]
    assert rows(table.read().drop("yyyymm")) == rows(frame(*want)) and files(table.read([202401])) == january
    table.delete_insert(frame((FEB, 2, "B")), ["day", "k"])
    assert rows(table.read().drop("yyyymm")) == rows(frame(*want))
    assert "PartitionFilters: [isnotnull(yyyymm" in plan(table.from_day(FEB)) and rows(table.from_day(FEB).select("k")) == [(2,), (3,), (4,)]
    assert rows(table.on_day(FEB).select("k")) == [(2,), (3,)]


def test_a_load_that_fails_midway_changes_nothing(spark, table, frame):
    before, places, content = files(table.read()), table.locations(), rows(table.read())
    bad = frame((JAN, 1, "x"), (FEB, 2, "y"), (MAR, 7, "boom")).repartition(3, "k")
    bad = bad.withColumn("v", F.when(F.col("v") == "boom", F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="boom"):
        table.replace(bad, [202401, 202402, 202403])
    assert table.locations() == places and files(table.read()) == before and rows(table.read()) == content
    # A catalog that knows nothing finds the same months, not the failed load's.
    spark.sql(f"DROP TABLE {table.name}")
    assert table.locations() == places and rows(table.read()) == content
    assert all(Path(f.removeprefix("file:")).exists() for f in before)


def test_emptied_months_stay_empty(spark, table, frame):
    assert table.delete(frame((FEB, 2, ""), (FEB, 3, ""), (MAR, 1, "")), ["day", "k"]) == [202402]
    assert rows(table.read().select("k")) == [(1,), (9,)]
    spark.sql(f"DROP TABLE {table.name}")
    assert rows(table.read().select("k")) == [(1,), (9,)] and table.latest_day() == JAN
    assert table.delete(frame((MAR, 1, "")), ["day", "k"]) == []


def test_latest_day_comes_from_footers(table, frame, spark, path):
    assert table.latest_day() == FEB
    table.append(frame((date(2024, 2, 9), 5, "e")))
    assert table.latest_day() == date(2024, 2, 9)
    empty = MonthTable(spark, table.name + "_none", f"{path}/none", table.schema, "day")
    assert empty.latest_day() is None and empty.sizes().count() == 0 and empty.read().count() == 0
    only_unknown = MonthTable(spark, table.name + "_unknown", f"{path}/unknown", table.schema, "day")
    only_unknown.replace(frame((None, 1, "")))
    assert only_unknown.latest_day() is None


def test_compaction_leaves_other_months_alone(table, frame):
    january = files(table.read([202401]))
    for v in "xyz":
        table.append(frame((FEB, 2, v), (MAR, 8, v)))
    assert table.months_to_compact() == [202402, 202403]
    sizes = {r["yyyymm"]: r["n_files"] for r in table.sizes().collect()}
    assert sizes[202402] == 4 and sizes[202403] == 3 and sizes[202401] == 1
    assert table.compact(["day", "k"], ["v"]) == [202402, 202403] and table.compact(["day", "k"], ["v"]) == []
    assert rows(table.read().drop("yyyymm")) == rows(frame((JAN, 1, "a"), (FEB, 2, "z"), (FEB, 3, "c"), (MAR, 8, "z"), (None, 9, "n")))
    assert files(table.read([202401])) == january and len(files(table.read([202402]))) == 1


def test_vacuum_keeps_what_is_looked_at(table, frame, spark, path):
    for v in "pqrs":
        table.delete_insert(frame((FEB, 2, v)), ["day", "k"])
    content = rows(table.read())
    assert len(table.vacuum(keep=1)) == 3 and rows(table.read()) == content  # the first load still holds January
    assert len(versions.versions(spark, f"{path}/T")) == 2


def test_create_replace_reads_what_it_replaces(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tests_months")
    spark.sql("DROP TABLE IF EXISTS tests_months.replaced")
    create_replace(spark.range(5), "tests_months.replaced")
    create_replace(spark.table("tests_months.replaced").where("id > 2"), "tests_months.replaced")
    assert rows(spark.table("tests_months.replaced")) == [(3,), (4,)]
    with pytest.raises(Exception, match="boom"):
        create_replace(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), "tests_months.replaced")
    assert rows(spark.table("tests_months.replaced")) == [(3,), (4,)]
    create_replace(spark.range(1).select(F.lit("a").alias("s")), "tests_months.replaced")
    assert rows(spark.table("tests_months.replaced")) == [("a",)]


# --- runs ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark):
    return sample.companies_raw(spark, SMALL), sample.stocks_raw(spark, SMALL)


@pytest.fixture(scope="module")
def twice(spark, raw):
    """A warehouse after two runs; the second brings the quotes of one month."""
    companies, stocks = raw
    wh = Warehouse(spark, fresh_path(spark, "twice"))
    late = (F.year("trading_day") == 1998) & (F.month("trading_day") == 5)
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, stocks.where(~late))
    before = {n: files(wh.months("gold", "FactStock").read([m])) for n, m in (("april", 199804), ("may", 199805))}
    run_pipeline(Run(wh, "2025-01-03 00:00:00"), companies, stocks.where(late))
    return wh, before


def test_a_run_looks_at_its_months_only(spark, raw, twice):
    wh, before = twice
    run = Run(wh, "2025-01-04 00:00:00")
    first, last = date(1998, 5, 1), date(1998, 5, 31)
    assert re.search(r"PartitionFilters: \[[^]]*yyyymm#\d+ = 199805", plan(new_quotes(run, Taken([199805], first, last))))
    stocks = raw[1].where(F.year("trading_day") == 1998)
    assert "stocks_raw" not in "".join(ticker_states(run, stocks).inputFiles())
    fact = wh.months("gold", "FactStock")
    assert files(fact.read([199804])) == before["april"] and not before["may"] and files(fact.read([199805]))
    counts = keychecks.kept(wh)
    assert set(counts.locations()) == set(fact.locations())


def test_states_hold_the_last_quote(raw, twice):
    wh, _ = twice
    states = wh.read("silver", "ticker_states").select("ticker_symbol", "exchange", "execution_date_utc")
    want = raw[1].groupBy("ticker_symbol", F.coalesce("exchange", F.lit("")).alias("exchange")).agg(F.max("execution_date_utc").alias("execution_date_utc"))
    assert rows(states) == rows(want)


def test_states_of_an_older_warehouse_are_made_from_bronze(spark, raw):
    companies, stocks = raw
    wh = Warehouse(spark, fresh_path(spark, "older"))
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, stocks.where("trading_day >= '1999-01-01'"))
    versions.remove(spark, wh.path("silver", "ticker_states"))
    run_pipeline(Run(wh, "2025-01-03 00:00:00"), companies, stocks.where("trading_day < '1996-01-01'"))
    latest = wh.read("silver", "ticker_states").agg(F.max("execution_date_utc")).first()[0]
    assert latest == stocks.agg(F.max("execution_date_utc")).first()[0]


def test_stored_companies_keep_their_quotes(spark):
    columns = "DateKey int, CompanyKey long, TickerKey long, ClosePrice double"
    batch = spark.createDataFrame([(1, 10, 5, 2.0), (1, 11, 5, 2.0), (2, 10, 5, 3.0), (3, 10, None, 4.0)], columns)
    stored = spark.createDataFrame([(1, 7, 5), (1, 10, 5), (9, 9, 9)], "DateKey int, CompanyKey long, TickerKey long")
    got = rows(under_stored_companies(batch, stored))
    assert got == [(1, 10, 5, 2.0), (1, 7, 5, 2.0), (2, 10, 5, 3.0), (3, 10, None, 4.0)]


def test_nothing_of_the_fact_is_written_to_publish(spark, twice):
    wh, _ = twice
    gold = wh.gold()
    for role, (layer, prefix) in publish.ROLES.items():
        views = publish.publish(wh, role, below=35)
        for name in ("FactStock", "DimDate", "DimTicker", "FactFinancials"):
            assert files(views[prefix + name]) == files(gold[name])
        written = versions.children(spark, f"{wh.root}/{layer}")
        assert written == ([] if role == "analyst_full" else ["v_limited_DimCompany", "v_limited_FactForbesRank"])
    # Published again after a change, with the changed month named.
    fact = wh.months("gold", "FactStock")
    fact.replace(fact.read([199805]).withColumn("ClosePrice", F.lit(1.0)))
    again = publish.publish(wh, "analyst_full", months=[199805])
    assert files(again["v_FactStock"]) == files(wh.gold()["FactStock"])
    assert rows(spark.table(f"{wh.database('gold_full_views')}.v_FactStock").where("yyyymm = 199805").select("ClosePrice").distinct()) == [(1.0,)]


def test_a_new_catalog_finds_the_warehouse(spark, twice):
    wh, _ = twice
    other = Warehouse(spark, wh.root, prefix="tests_again_")
    assert other.gold()["FactStock"].count() == wh.gold()["FactStock"].count() and files(other.gold()["FactStock"]) == files(wh.gold()["FactStock"])
    assert wh.vacuum(keep=1) and other.gold()["DimDate"].count() == wh.gold()["DimDate"].count() > 0


def test_key_checks_count_planted_faults(spark, raw):
    companies, stocks = raw
    wh = Warehouse(spark, fresh_path(spark, "faults"))
    _, report = run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, stocks)
    assert not any(r.failures for r in report.collect() if r.test_name.endswith(("_key", "_orphan")))
    fact = wh.months("gold", "FactStock")
    may = fact.read([199805])
    n = may.count()
    fact.replace(may.unionByName(may).withColumn("CompanyKey", F.when(F.col("ClosePrice") > 0, F.lit(-1)).otherwise(F.col("CompanyKey"))))
    keychecks.refresh(wh, [199805])
    told = {r.test_name: r.failures for r in keychecks.failures(wh.gold(), keychecks.kept(wh).read()).collect()}
    assert told["FactStock_repeated_key"] == n and told["FactStock_CompanyKey_orphan"] == 2 * n and told["FactStock_DateKey_orphan"] == 0


def test_stream_batches_switch_months(spark, raw, path):
    companies, stocks = raw
    wh = Warehouse(spark, path)
    run_pipeline(Run(wh, "2025-01-02 00:00:00"), companies, stocks)
    fact = wh.months("gold", "FactStock")
    may = fact.read([199805]).drop("yyyymm").withColumn("ClosePrice", F.lit(2.0))
    untouched, n = files(fact.read([199804])), fact.read().count()
    may.write.parquet(f"{path}/feed")
    jobs.upsert_gold(jobs.read_files(spark, f"{path}/feed", may.schema), wh, "FactStock", schemas.STOCK_KEYS, "TradingDate", f"{path}/checkpoint")
    assert rows(fact.read([199805]).select("ClosePrice").distinct()) == [(2.0,)]
    assert files(fact.read([199804])) == untouched and fact.read().count() == n


# --- files to bronze ----------------------------------------------------------------------------

FEED = "run_at string, ticker string, info string, position long"


def quote(price, **more):
    return '{"previousClose": %s}' % price


def test_quotes_meet_one_outcome_each(spark, path):
    run = "2024-05-02T22:00:10.5Z"
    feed = [
        (run, " A ", quote(1.5), 1), (run, "A", quote(9), 2), (run, "B", "{}", 3), (run, "C", "no json", 4), (run, "  ", quote(1), 5),
        (run, None, quote(1), 6), ("never", "D", quote(1), 7), (run, "E", quote("NaN"), 8), ("2024-05-03T22:00:00Z", "A", quote(2), 9),
    ]
    df = spark.createDataFrame(feed, FEED)
    wh = Warehouse(spark, path)
    found = bronze.load_quotes(wh, df, "2024-05-04 00:00:00")
    assert found.counts == {"quoted": 2, "no_quote": 3, "no_ticker": 2, "repeated": 1, "no_run": 1, "loaded": 0}
    stored = wh.read("bronze", "stocks_raw")
    first = stored.where("close_price = 1.5").first()
    assert (first.ticker_symbol, str(first.execution_date_utc), first.day_of_week, first.quarter, first.season) == ("A", "2024-05-02 22:00:10", "Thursday", 2, "Spring")
    assert str(first._ingested_at) == "2024-05-04 00:00:00"
    # The same run again, and a new day with it: days that have quotes are skipped whole.
    more = df.unionByName(spark.createDataFrame([(run, "Z", quote(7), 10), ("2024-05-06T22:00:00Z", "Z", quote(8), 11)], FEED))
    found = bronze.load_quotes(wh, more, "2024-05-07 00:00:00")
    assert found.counts["quoted"] == 1 and found.counts["loaded"] == 3
    assert rows(wh.read("bronze", "stocks_raw").select("ticker_symbol", "close_price")) == [("A", 1.5), ("A", 2.0), ("Z", 8.0)]
    listed = spark.createDataFrame([(1, "Y "), (2, None), (3, " "), (4, "Y")], "rank int, ticker string")
    day = "2024-05-08T00:00:00Z"
    bronze.load_quotes(wh, spark.createDataFrame([(day, "Y", quote(3), 1), (day, "X", quote(3), 2)], FEED), "2024-05-09 00:00:00", listed)
    assert rows(wh.read("bronze", "stocks_raw").where("yyyymm = 202405 AND trading_day = '2024-05-08'").select("ticker_symbol")) == [("Y",)]
    assert bronze.load_quotes(wh, df.limit(0), "2024-05-09 00:00:00").counts["quoted"] == 0


def test_rankings_settle_in_one_pass(spark, path):
    wh = Warehouse(spark, path)
    tickers = spark.read.option("header", True).option("sep", ";").csv(inputs.ticker_file(spark, SMALL))
    found = bronze.load_rankings(wh, inputs.ranking_file(spark, SMALL), tickers, "2025-01-01 00:00:00", f"{path}/rejects", f"{path}/missing")
    companies = sample.companies_raw(spark, SMALL)
    losses = companies.where("profit_in_millions < 0").count()
    assert found.counts == {"accepted": companies.count() - losses, "rejected": losses, "not_found": companies.where("profit_in_millions <= 0").count()}
    stored = wh.read("bronze", "companies_raw")
    assert stored.count() == found.counts["accepted"] and stored.where("ticker IS NULL").isEmpty()
    assert {str(r[0]) for r in stored.select("_ingested_at").distinct().collect()} == {"2025-01-01 00:00:00"}
    read = lambda name: spark.read.option("header", True).option("sep", ";").csv(f"{path}/{name}")
    assert read("rejects").columns[-2:] == ["Ticker", "Reason"] and read("rejects").count() == losses
    assert read("missing").columns == ["Rank", "Company"] and read("missing").count() == found.counts["not_found"]


def test_periods_have_open_ends(spark):
    days = spark.createDataFrame([(y,) for y in (1970, 1994, 1997, 1998, 2001, 2002, 2050)], "financial_year int")
    inside = [[r[0] for r in days.where(inputs._in_period(F.col("financial_year"), p, "int")).collect()] for p in inputs.PERIODS]
    assert inside == [[1970, 1994], [1997, 1998], [2001, 2002, 2050]]


def test_each_foreign_key_is_counted_by_itself(spark):
    fact = spark.createDataFrame(
        [(202405, 20240502, 1, 7), (202405, 20240502, 1, 7), (202405, 20240503, 2, None)], "yyyymm int, DateKey int, CompanyKey long, TickerKey long"
    )
    counts = keychecks.count_keys(fact)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and counts.columns == ["yyyymm", "key_name", "key", "n_rows"]
    assert rows(counts.select("key_name", "key", "n_rows")) == rows(
        spark.createDataFrame(
            [("DateKey", 20240502, 2), ("DateKey", 20240503, 1), ("CompanyKey", 1, 2), ("CompanyKey", 2, 1), ("TickerKey", 7, 2), ("primary key", None, 1)],
            "a string, b long, c long",
        )
    )
