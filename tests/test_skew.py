"""One ticker holds a third of all quotes."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from quotemill.operators import joins, upsert, windows
from quotemill.plans import silver
from quotemill.session import pinned
from quotemill.sources import sample


@pytest.fixture(scope="module")
def skewed(spark):
    """Quotes at distinct times, a third of them of the first company, and the companies."""
    orders = sample.table(spark, SMALL, "orders")
    heavy = F.xxhash64("o_orderkey") % 3 == 0
    stocks = sample.stocks_raw(spark, SMALL).join(
        orders.select((F.col("o_orderkey") * 1000).alias("market_cap"), heavy.alias("heavy"), "o_orderkey"), "market_cap"
    )
    moved = (
        stocks.withColumn("ticker_symbol", F.when(F.col("heavy"), "T0").otherwise(F.col("ticker_symbol")))
        .withColumn("execution_date_utc", F.timestamp_seconds(F.unix_timestamp("execution_date_utc") + F.col("o_orderkey") % 86400))
        .select(*sample.stocks_raw(spark, SMALL).columns)
    )
    stocks = pinned(moved.repartition(8), "skewed")
    share = stocks.where("ticker_symbol = 'T0'").count() / stocks.count()
    assert 0.3 < share < 0.4
    return stocks, pinned(silver.companies_view(sample.companies_raw(spark, SMALL)), "companies")


@pytest.fixture
def no_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def per_partition(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_fact_join_is_spread_and_whole(spark, skewed, no_broadcast):
    stocks, companies = skewed
    fact = silver.fact_stock(stocks, companies)
    assert "_salt" in fact._jdf.queryExecution().analyzed().toString()
    listed = companies.select(F.col("ticker").alias("ticker_symbol"), silver.company_key("xxhash64").alias("CompanyKey"))
    plain = stocks.join(listed, "ticker_symbol")
    assert fact.count() == plain.count() == stocks.count()
    assert same(fact.select("CompanyKey", "ClosePrice"), plain.select("CompanyKey", F.col("close_price").alias("ClosePrice")))
    quotes = stocks.select("ticker_symbol", "close_price")
    spread = joins.lookup_join(quotes, listed, ["ticker_symbol"])
    assert max(per_partition(spread)) < 0.5 * max(per_partition(quotes.join(listed, "ticker_symbol")))


def test_semi_and_anti_joins_on_a_heavy_key(spark, skewed, no_broadcast):
    stocks, companies = skewed
    some = companies.where("profit_in_millions > 0").select(F.col("ticker").alias("ticker_symbol"))
    kept = upsert.delete_keys(stocks, some, ["ticker_symbol"])
    gone = joins.existing(stocks, some, ["ticker_symbol"])
    assert kept.count() + gone.count() == stocks.count()
    assert same(kept, stocks.join(some, "ticker_symbol", "left_anti").select(*kept.columns))


def test_rolling_mean_splits_a_heavy_group(spark, skewed):
    stocks, _ = skewed
    rows = stocks.select(
        "ticker_symbol", F.date_format("trading_day", "yyyyMMdd").cast("int").alias("day"), "market_cap",
        F.col("close_price").alias("v"),
    )
    got = windows.rolling_mean(rows, ["ticker_symbol"], "day", ["market_cap"], "v", 3, "m")
    rows.createOrReplaceTempView("skewed_rows")
    want = spark.sql(
        """SELECT *, avg(v) OVER (PARTITION BY ticker_symbol ORDER BY day, market_cap
                                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) m FROM skewed_rows"""
    )
    assert same(got.withColumn("m", F.round("m", 6)), want.withColumn("m", F.round("m", 6)))


def test_group_counts_of_a_heavy_group(spark, skewed, no_broadcast):
    stocks, _ = skewed
    counted = windows.group_count(stocks.select("ticker_symbol", "market_cap"), ["ticker_symbol"], "n")
    sizes = stocks.groupBy("ticker_symbol").count()
    assert same(counted.select("ticker_symbol", "n").distinct(), sizes)
    assert counted.count() == stocks.count()


def test_broadcast_threshold_in_any_unit(spark):
    from quotemill.operators.joins import _broadcast_limit

    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        for text, size in (("10m", 10 << 20), ("50MB", 50 << 20), ("104857600", 104857600), ("-1", -1)):
            spark.conf.set(name, text)
            assert _broadcast_limit(spark) == size
    finally:
        spark.conf.set(name, before)
