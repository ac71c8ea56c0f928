"""Document collections and the quote feed, both as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..schemas import COMPANIES_RAW, QUOTE_RECORD

# Quote field -> stock column. The feed's previous close is stored as the close.
QUOTE_COLUMNS = {
    "sector": "sector",
    "open": "open_price",
    "previousClose": "close_price",
    "dayHigh": "high_price",
    "dayLow": "low_price",
    "marketCap": "market_cap",
    "currency": "currency",
    "exchange": "exchange",
    "dividendRate": "dividend",
}

DOCUMENT_FIELDS = [f for f in COMPANIES_RAW.names if f not in ("financial_year", "_ingested_at")]


def read_documents(
    spark: SparkSession, path: str, fields: list[str] | None = None, schema: T.StructType = COMPANIES_RAW
) -> DataFrame:
    """Scan a collection, keeping only the named fields; only those are parsed from the JSON."""
    fields = fields or DOCUMENT_FIELDS
    return spark.read.schema(T.StructType([schema[f] for f in fields])).json(path)


def parse_quotes(records: DataFrame, ticker: Column, payload: Column, skip_empty: bool = True) -> DataFrame:
    """Quote JSON to stock columns. Records that are empty or cannot be read are skipped, or kept without any value."""
    quote = F.from_json(payload, QUOTE_RECORD)
    present = F.coalesce(*[F.col(f"_quote.{f}").cast("string") for f in QUOTE_COLUMNS]).isNotNull()
    measures = {
        c: C.nan_to_null(F.col(f"_quote.{f}"), "bigint" if c == "market_cap" else "double")
        if isinstance(QUOTE_RECORD[f].dataType, T.DoubleType)
        else F.col(f"_quote.{f}")
        for f, c in QUOTE_COLUMNS.items()
    }
    return (
        records.select("*", ticker.alias("_ticker"), quote.alias("_quote"))
        .where(present if skip_empty else F.lit(True))
        .select(
            *[c for c in records.columns],
            F.col("_ticker").alias("ticker_symbol"),
            *[expr.alias(name) for name, expr in measures.items()],
        )
    )
