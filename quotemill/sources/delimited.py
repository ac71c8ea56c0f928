"""Delimited files: rankings, ticker map and CSV from an object store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..schemas import RANKING_FILE, TICKER_MAP_FILE


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", with_file: bool = False
) -> DataFrame:
    """Read a headed file with a declared schema; ``with_file`` adds its path as ``_file``."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.withColumn("_file", F.col("_metadata.file_path")) if with_file else df


def read_rankings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, RANKING_FILE, with_file=True)


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, TICKER_MAP_FILE)


def csv_to_table(
    spark: SparkSession, path: str, table: str, schema: T.StructType | None = None, sep: str = ","
) -> DataFrame:
    """Create or replace ``table`` from CSV under any path Spark can read (``s3a://`` included).

    Without a schema the types are inferred, which reads the file once more; pass one for large
    files.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    reader.csv(path).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


# Ranking column -> (bronze column, how it is parsed).
_AMOUNTS = {
    "Sales ($B)": "sales_in_millions",
    "Profit ($B)": "profit_in_millions",
    "Assets ($B)": "assets_in_millions",
    "Market Value ($B)": "market_value_in_millions",
}


def parse_rankings(df: DataFrame, year: Column | None = None) -> DataFrame:
    """Typed company columns plus ``Reason``, which is NULL for rows that converted.

    One projection serves both outcomes: write it once and read either side with ``accepted`` and
    ``rejected``. The reason names the first field that failed, rank before the amounts.
    """
    df = C.trim_strings(df)
    year = year if year is not None else C.year_from_file(F.col("_file"))
    rank = C.parse_rank(F.col("Rank"))
    amounts = {source: C.parse_amount(F.col(f"`{source}`")) for source in _AMOUNTS}
    reason = F.coalesce(
        F.when(rank.isNull(), F.format_string(C.BAD_INTEGER_REASON, F.coalesce("Rank", F.lit("")))),
        *[
            F.when(parsed.isNull(), F.format_string(C.BAD_NUMBER_REASON, C.amount_text(F.col(f"`{source}`"))))
            for source, parsed in amounts.items()
        ],
    )
    return df.select(
        *[F.col(f"`{c}`") for c in RANKING_FILE.names],
        F.col("Ticker") if "Ticker" in df.columns else F.lit(None).cast("string").alias("Ticker"),
        rank.alias("rank_number"),
        *[parsed.alias(_AMOUNTS[source]) for source, parsed in amounts.items()],
        year.alias("financial_year"),
        reason.alias("Reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that converted, as company documents."""
    return parsed.where(F.col("Reason").isNull()).select(
        F.col("rank_number").alias("rank"),
        F.col("Company").alias("company"),
        F.col("Ticker").alias("ticker"),
        F.col("Headquarters").alias("headquarters"),
        F.col("Industry").alias("industry"),
        *_AMOUNTS.values(),
        "financial_year",
    )


def rejected(parsed: DataFrame) -> DataFrame:
    """Rows that did not convert, as read, with the reason."""
    return parsed.where(F.col("Reason").isNotNull()).select(
        *[F.col(f"`{c}`") for c in RANKING_FILE.names], "Ticker", "Reason"
    )
