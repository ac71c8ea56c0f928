"""Explicit schemas of every layer.

Table and column names are the warehouse's public surface, so they are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Header of the ranking file; amounts stay text until they are parsed.
RANKING_FILE = _struct(
    ("Rank", _S),
    ("Company", _S),
    ("Headquarters", _S),
    ("Industry", _S),
    ("Sales ($B)", _S),
    ("Profit ($B)", _S),
    ("Assets ($B)", _S),
    ("Market Value ($B)", _S),
)

TICKER_MAP_FILE = _struct(("Rank", _S), ("Company", _S), ("Ticker", _S))

COMPANIES_RAW = _struct(
    ("rank", _L),
    ("company", _S),
    ("ticker", _S),
    ("headquarters", _S),
    ("industry", _S),
    ("sales_in_millions", _D),
    ("profit_in_millions", _D),
    ("assets_in_millions", _D),
    ("market_value_in_millions", _D),
    ("financial_year", _I),
    ("_ingested_at", T.TimestampType()),
)

STOCKS_RAW = _struct(
    ("ticker_symbol", _S),
    ("sector", _S),
    ("open_price", _D),
    ("close_price", _D),
    ("high_price", _D),
    ("low_price", _D),
    ("market_cap", _L),
    ("currency", _S),
    ("exchange", _S),
    ("dividend", _D),
    ("execution_date_utc", T.TimestampType()),
    ("trading_day", T.DateType()),
    ("month", _I),
    ("day_of_week", _S),
    ("quarter", _I),
    ("season", _S),
    ("_ingested_at", T.TimestampType()),
)

# One record of the quote feed, named as the feed names its fields.
QUOTE_RECORD = _struct(
    ("sector", _S),
    ("open", _D),
    ("previousClose", _D),
    ("dayHigh", _D),
    ("dayLow", _D),
    ("marketCap", _D),
    ("currency", _S),
    ("exchange", _S),
    ("dividendRate", _D),
)

_T, _DAY = T.TimestampType(), T.DateType()

GOLD: dict[str, T.StructType] = {
    "DimCompany": _struct(
        ("CompanyKey", _L), ("CompanyName", _S), ("Headquarters", _S), ("Industry", _S), ("Sector", _S),
        ("ValidFrom", _T), ("ValidTo", _T),
    ),
    "DimTicker": _struct(
        ("TickerKey", _L), ("TickerSymbol", _S), ("Exchange", _S), ("Class", _S), ("Currency", _S),
        ("Sector", _S), ("ValidFrom", _T), ("ValidTo", _T),
    ),
    "DimDate": _struct(
        ("DateKey", _I), ("TradingDate", _DAY), ("Year", _I), ("Month", _I), ("Day", _I), ("Quarter", _I),
    ),
    "FactFinancials": _struct(
        ("CompanyKey", _L), ("Year", _I), ("Sales", _L), ("Profit", _L), ("Assets", _L), ("MarketValue", _L),
    ),
    "FactForbesRank": _struct(("ForbesRankKey", _L), ("CompanyKey", _L), ("Year", _I), ("ForbesRank", _L)),
    "FactStock": _struct(
        ("DateKey", _I), ("CompanyKey", _L), ("TickerKey", _L), ("TradingDate", _DAY), ("OpenPrice", _D),
        ("ClosePrice", _D), ("HighPrice", _D), ("LowPrice", _D), ("MarketCap", _D), ("Dividend", _D),
    ),
}

GOLD_COLUMNS: dict[str, tuple[str, ...]] = {name: tuple(schema.names) for name, schema in GOLD.items()}

# Dated tables are stored by month; the partition column is not one of their own.
MONTH = "yyyymm"
BY_MONTH = {("bronze", "stocks_raw"), ("gold", "FactStock")}
# Of these, the ones whose months are replaced: schema and the column that tells the month.
SWITCHED: dict[tuple[str, str], tuple[T.StructType, str]] = {("gold", "FactStock"): (GOLD["FactStock"], "TradingDate")}


def _without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


STORED: dict[tuple[str, str], T.StructType] = {
    ("bronze", "companies_raw"): COMPANIES_RAW,
    ("bronze", "stocks_raw"): STOCKS_RAW,
    ("silver", "companies"): _without(COMPANIES_RAW, "_ingested_at"),
    **{("gold", name): schema for name, schema in GOLD.items()},
}


def stored_schema(layer: str, table: str) -> T.StructType | None:
    """Schema a table is read with, so that no file has to be opened to find it out."""
    schema = STORED.get((layer, table))
    if schema is not None and (layer, table) in BY_MONTH:
        schema = T.StructType([*schema.fields, T.StructField(MONTH, _I, True)])
    return schema


# Sort key of each gold table, which is also its declared primary key for the dated facts.
GOLD_SORT_KEYS: dict[str, tuple[str, ...]] = {
    "DimCompany": ("CompanyKey",),
    "DimTicker": ("TickerKey",),
    "DimDate": ("DateKey",),
    "FactFinancials": ("CompanyKey", "Year"),
    "FactForbesRank": ("CompanyKey", "Year"),
    "FactStock": ("DateKey", "CompanyKey", "TickerKey"),
}

STOCK_KEYS = ("DateKey", "CompanyKey", "TickerKey")
COMPANY_CHECK_COLUMNS = ("CompanyName", "Headquarters", "Industry", "Sector")
TICKER_CHECK_COLUMNS = ("TickerSymbol", "Exchange", "Class", "Currency")

LAYERS = ("bronze", "silver", "snapshots", "gold", "gold_full_views", "gold_limited_views")


def layer_name(custom: str) -> str:
    """Database name of a layer: trimmed, lower-cased and without a prefix."""
    return custom.strip().lower()
