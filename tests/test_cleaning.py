import math

from pyspark.sql import functions as F

from conftest import rows
from quotemill import schemas
from quotemill.functions import calendar, cleaning as C
from quotemill.functions.keys import surrogate_key
from quotemill.operators import sinks
from quotemill.sources import delimited, documents


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first().y


def test_amounts(spark):
    cases = {
        "$1,234.5": 1_234_500.0, " ": 0.0, "": 0.0, None: 0.0, "7": 7000.0, "-2.5": -2500.0, " $3 ": 3000.0,
        "0.513.7": None, "$": None, "5d": None, "1e2": 100_000.0, "abc": None, "\t4\n": 4000.0,
    }
    for text, wanted in cases.items():
        assert one(spark, text, "string", C.parse_amount) == wanted, text
    assert one(spark, 2.5, "double", lambda c: C.parse_amount(c, numeric=True)) == 2500.0
    assert one(spark, None, "double", lambda c: C.parse_amount(c, numeric=True)) == 0.0


def test_trim_removes_any_whitespace(spark):
    df = spark.createDataFrame([("  a b\t\r\n", 1)], "s string, n int")
    assert rows(C.trim_strings(df)) == [("a b", 1)]


def test_nan_and_null(spark):
    assert one(spark, math.nan, "double", C.nan_to_null) is None
    assert one(spark, None, "double", C.nan_to_null) is None
    assert one(spark, 12.9, "double", lambda c: C.nan_to_null(c, "bigint")) == 12
    assert one(spark, -12.9, "double", lambda c: C.nan_to_null(c, "bigint")) == -12


def test_defaults_by_type(spark):
    df = spark.createDataFrame([(None, None, None, None)], "s string, n bigint, d double, day date")
    assert rows(sinks.with_defaults(df)) == [("", 0, 0.0, None)]


def test_missing_tickers(spark):
    df = spark.createDataFrame([("A",), ("",), ("  ",), (None,), ("NAN",)], "t string")
    assert rows(C.with_ticker(df, "t")) == [("A",), ("NAN",)]


def test_year_from_file_name(spark):
    for name, year in {
        "x/companies_2025.csv": 2025, "x/companies_2024.csv/part-0.csv": 2024, "companies.csv": None,
        "c_25.csv": None,
    }.items():
        assert one(spark, name, "string", C.year_from_file) == year, name


def test_seasons_and_date_attributes(spark):
    df = spark.sql("SELECT explode(sequence(1, 12)) m").select("m", F.make_date(F.lit(2024), "m", F.lit(1)).alias("d"))
    got = {r.m: r.s for r in df.select("m", calendar.season(F.col("d")).alias("s")).collect()}
    assert [got[m] for m in (12, 1, 2)] == ["Winter"] * 3
    assert [got[m] for m in (3, 4, 5)] == ["Spring"] * 3
    assert [got[m] for m in (6, 7, 8)] == ["Summer"] * 3
    assert [got[m] for m in (9, 10, 11)] == ["Autumn"] * 3
    moment = spark.sql("SELECT timestamp'2025-11-02 22:00:00' t")
    row = moment.select(*[e.alias(n) for n, e in calendar.date_attributes(F.col("t")).items()]).first()
    assert (str(row.trading_day), row.month, row.day_of_week, row.quarter, row.season) == (
        "2025-11-02", 11, "Sunday", 4, "Autumn",
    )


def test_run_timestamp(spark):
    text = calendar.run_timestamp_text
    assert one(spark, "2025-11-02T22:00:00.987654+00:00", "string", text) == "2025-11-02 22:00:00"
    assert one(spark, "2025-11-02T23:30:00+01:30", "string", text) == "2025-11-02 22:00:00"
    assert one(spark, "soon", "string", text) == "soon"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, "2025-11-02T22:00:00+00:00", "string", text) == "2025-11-02 22:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rejects_keep_the_row_and_name_the_first_bad_field(spark, path):
    header = ";".join(schemas.RANKING_FILE.names)
    lines = [
        header,
        "1; Alpha ;Estonia;Banking;$1,000.5;2;3;4",
        "2;Beta;Chile;Banking;7.99;0.513.7;48.42;46.38",
        "x;Gamma;Chile;Retail;1;2;3;4",
        "4;Delta;Chile;Retail;;2;bad;worse",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{path}/ranking_2025.csv")
    parsed = delimited.parse_rankings(delimited.read_rankings(spark, f"{path}/ranking_2025.csv"))
    good = delimited.accepted(parsed).collect()
    assert len(good) == 1
    assert (good[0]["rank"], good[0].company, good[0].sales_in_millions, good[0].financial_year) == (1, "Alpha", 1_000_500.0, 2025)
    out = f"{path}/rejects"
    sinks.write_rejects(delimited.rejected(parsed), out)
    back = spark.read.option("header", True).option("sep", ";").csv(out)
    assert back.columns == [*schemas.RANKING_FILE.names, "Ticker", "Reason"]
    assert {r.Rank: r.Reason for r in back.collect()} == {
        "2": "could not convert string to float: '0.513.7'",
        "x": "invalid literal for int() with base 10: 'x'",
        "4": "could not convert string to float: 'bad'",
    }


def test_quote_feed_renames_and_skips_empty_records(spark):
    feed = spark.createDataFrame(
        [
            ("A", '{"open": 1.5, "previousClose": 2, "dayHigh": 3, "dayLow": 1, "marketCap": 99.9, "extra": 1}'),
            ("B", "{}"), ("C", None), ("D", "not json"), ("E", '{"currency": "USD"}'),
        ],
        "ticker string, info string",
    )
    got = documents.parse_quotes(feed, F.col("ticker"), F.col("info"))
    picked = got.select("ticker_symbol", "open_price", "close_price", "market_cap", "currency", "dividend")
    assert rows(picked) == [("A", 1.5, 2.0, 99, None, None), ("E", None, None, None, "USD", None)]


def test_typed_append_drops_unknown_and_fills_missing(spark, path):
    df = spark.createDataFrame([("7", "x", "y")], "rank string, company string, unknown string")
    sinks.append_typed(df, schemas.COMPANIES_RAW, path)
    sinks.append_typed(df, schemas.COMPANIES_RAW, path)
    back = spark.read.parquet(path)
    assert back.columns == schemas.COMPANIES_RAW.names
    row = back.first()
    assert back.count() == 2 and row["rank"] == 7 and row.ticker is None and row._ingested_at is not None


def test_keys(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), ("A", None), ("A", "")], "a string, b string")
    for method, distinct in (("xxhash64", 3), ("md5", 3), ("narrow", 2)):
        keys = df.select(surrogate_key("a", "b", method=method).alias("k"))
        assert keys.distinct().count() == distinct, method
    narrow = df.select(F.max(surrogate_key("a", "b", method="narrow"))).first()[0]
    assert 0 <= narrow < 2**32
