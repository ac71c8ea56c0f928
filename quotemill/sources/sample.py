"""The warehouse's inputs, derived from the order tables used for testing.

Everything is a plain projection, join or aggregate over whole tables. The ``%`` expressions decide
which values are blank or foreign; they never filter rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_attributes
from ..schemas import COMPANIES_RAW, STOCKS_RAW

FINANCIAL_YEAR = 2025
COMPANIES_LOADED_AT = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def companies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company per customer, with measures summed from its orders."""
    totals = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sales"),
            F.max("o_totalprice").alias("assets"),
            F.count(F.lit(1)).alias("n_orders"),
        )
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        customer.join(nation, "c_nationkey")
        .join(totals, "c_custkey", "left")
        .select(
            (F.col("c_custkey") + 1).alias("rank"),
            F.col("c_name").alias("company"),
            F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
            F.col("n_name").alias("headquarters"),
            F.col("c_mktsegment").alias("industry"),
            F.coalesce("sales", F.lit(0.0)).alias("sales_in_millions"),
            F.col("c_acctbal").alias("profit_in_millions"),
            F.coalesce("assets", F.lit(0.0)).alias("assets_in_millions"),
            F.coalesce(F.col("n_orders") * 1000.0, F.lit(0.0)).alias("market_value_in_millions"),
            F.lit(FINANCIAL_YEAR).cast("int").alias("financial_year"),
            F.lit(COMPANIES_LOADED_AT).cast("timestamp").alias("_ingested_at"),
        )
    )


def company_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many versions per company: each order restates its customer's figures."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    price = F.col("o_totalprice")
    return (
        orders.join(customer.join(nation, "c_nationkey"), "c_custkey")
        .select(
            (F.col("c_custkey") + 1).alias("rank"),
            F.col("c_name").alias("company"),
            F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"),
            F.col("n_name").alias("headquarters"),
            F.col("o_orderpriority").alias("industry"),
            price.alias("sales_in_millions"),
            F.col("c_acctbal").alias("profit_in_millions"),
            (price * 2).alias("assets_in_millions"),
            (price * 0.5).alias("market_value_in_millions"),
            F.year("o_orderdate").cast("int").alias("financial_year"),
            F.timestamp_seconds("o_orderkey").alias("_ingested_at"),
        )
    )


def stocks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order; several orders of a customer on one day are versions of a quote."""
    key, price = F.col("o_custkey"), F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), key.cast("string")).alias("ticker_symbol"),
        F.col("o_orderstatus").alias("sector"),
        (price * 0.5).alias("open_price"),
        price.alias("close_price"),
        (price * 2).alias("high_price"),
        (price * 0.25).alias("low_price"),
        (F.col("o_orderkey") * 1000).alias("market_cap"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "EURO").otherwise("USD").alias("currency"),
        F.when(key % 3 != 0, F.col("o_orderpriority")).alias("exchange"),
        F.when(F.col("o_orderkey") % 5 != 0, price * 0.125).alias("dividend"),
        F.col("o_orderdate").cast("timestamp").alias("execution_date_utc"),
        *[expr.alias(name) for name, expr in date_attributes(F.col("o_orderdate")).items()],
        F.timestamp_seconds("o_orderkey").alias("_ingested_at"),
    )


def assert_schemas(companies: DataFrame, stocks: DataFrame) -> None:
    """Both frames carry exactly the bronze columns and types."""
    for df, wanted in ((companies, COMPANIES_RAW), (stocks, STOCKS_RAW)):
        got = [(f.name, f.dataType) for f in df.schema.fields]
        if got != [(f.name, f.dataType) for f in wanted.fields]:
            raise ValueError(f"schema differs: {got}")
