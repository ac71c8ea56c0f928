"""For each registered query, SQL that computes the same result from the test tables.

Written for DuckDB, on natural columns where the Spark side uses joins on keys. ``{name}`` pulls in
a shared table expression.
"""

from __future__ import annotations

import re


def key(*columns: str) -> str:
    """The recomputable surrogate key: 60 bits of an md5."""
    text = " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"CAST('0x' || substring(md5({text}), 1, 15) AS BIGINT)"


def ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def date_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


def ints(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"CAST({expr} AS INTEGER) AS {name}" for expr, name in pairs)


COMPANY_COLUMNS = (
    "rank, company, ticker, headquarters, industry, sales_in_millions, profit_in_millions, "
    "assets_in_millions, market_value_in_millions, financial_year"
)
STOCK_COLUMNS = (
    "ticker_symbol, sector, open_price, close_price, high_price, low_price, market_cap, currency, "
    "exchange, dividend, strftime(execution_date_utc, '%Y-%m-%d %H:%M:%S') AS execution_date_utc, "
    "trading_day, month, day_of_week, quarter, season"
)
SEASON = (
    "CASE quarter({0} + INTERVAL 1 MONTH) WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' "
    "WHEN 3 THEN 'Summer' ELSE 'Autumn' END"
)

STOCK_FACT = (
    f"{date_key('trading_day')} AS DateKey, {key('company', 'headquarters')} AS CompanyKey, "
    f"{key('ticker_symbol', 'exchange')} AS TickerKey, trading_day AS TradingDate, open_price AS OpenPrice, "
    "close_price AS ClosePrice, high_price AS HighPrice, low_price AS LowPrice, "
    "CAST(market_cap AS DOUBLE) AS MarketCap, coalesce(dividend, 0) AS Dividend"
)

# Shared table expressions.
SHARED: dict[str, str] = {
    "companies_raw": """
        SELECT c_custkey + 1 AS rank, c_name AS company, 'T' || c_custkey AS ticker,
               n_name AS headquarters, c_mktsegment AS industry,
               coalesce(sales, 0) AS sales_in_millions, c_acctbal AS profit_in_millions,
               coalesce(assets, 0) AS assets_in_millions,
               coalesce(n, 0) * 1000.0::DOUBLE AS market_value_in_millions,
               CAST(2025 AS INTEGER) AS financial_year
        FROM customer
        JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS sales,
                          max(o_totalprice) AS assets, count(*) AS n
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "company_versions": """
        SELECT c_custkey + 1 AS rank, c_name AS company, 'T' || c_custkey AS ticker,
               n_name AS headquarters, o_orderpriority AS industry, o_totalprice AS sales_in_millions,
               c_acctbal AS profit_in_millions, o_totalprice * 2 AS assets_in_millions,
               o_totalprice * 0.5 AS market_value_in_millions,
               CAST(year(o_orderdate) AS INTEGER) AS financial_year, o_orderkey AS version
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "stocks_raw": f"""
        SELECT 'T' || o_custkey AS ticker_symbol, o_orderstatus AS sector,
               o_totalprice * 0.5 AS open_price, o_totalprice AS close_price,
               o_totalprice * 2 AS high_price, o_totalprice * 0.25 AS low_price,
               o_orderkey * 1000 AS market_cap,
               CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'EURO' ELSE 'USD' END AS currency,
               CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority END AS exchange,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 0.125 END AS dividend,
               o_orderdate AS execution_date_utc, CAST(o_orderdate AS DATE) AS trading_day,
               {ints(("month(o_orderdate)", "month"))}, dayname(o_orderdate) AS day_of_week,
               {ints(("quarter(o_orderdate)", "quarter"))}, {SEASON.format("o_orderdate")} AS season,
               o_orderkey AS version
        FROM orders""",
    "stocks_view": """
        SELECT * FROM {stocks_raw}
        QUALIFY row_number() OVER (PARTITION BY ticker_symbol, execution_date_utc ORDER BY version DESC) = 1""",
    "stocks_first": """
        SELECT * FROM {stocks_raw}
        QUALIFY row_number() OVER (PARTITION BY ticker_symbol, execution_date_utc ORDER BY version) = 1""",
    "dim_company": f"""
        SELECT {key("company", "headquarters")} AS CompanyKey, company AS CompanyName,
               headquarters AS Headquarters, industry AS Industry, 'sector' AS Sector
        FROM {{companies_raw}}""",
    "dim_date": f"""
        SELECT {date_key("d")} AS DateKey, d AS TradingDate,
               {ints(("year(d)", "Year"), ("month(d)", "Month"), ("day(d)", "Day"), ("quarter(d)", "Quarter"))}
        FROM (SELECT DISTINCT trading_day AS d FROM {{stocks_raw}})""",
    "tickers": f"""
        SELECT {key("ticker_symbol", "exchange")} AS TickerKey, ticker_symbol AS TickerSymbol,
               coalesce(exchange, '') AS Exchange, 'Equity' AS Class,
               coalesce(currency, '') AS Currency, coalesce(sector, '') AS Sector
        FROM {{stocks_view}}""",
    # The daily load stores the first version of a quote, so gold is built on that.
    "dim_ticker": f"""
        SELECT DISTINCT {key("ticker_symbol", "exchange")} AS TickerKey, ticker_symbol AS TickerSymbol,
               coalesce(exchange, '') AS Exchange, coalesce(currency, '') AS Currency
        FROM {{stocks_first}}""",
    "fact_financials": f"""
        SELECT {key("company", "headquarters")} AS CompanyKey, financial_year AS Year,
               CAST(trunc(sales_in_millions) AS BIGINT) AS Sales,
               CAST(trunc(profit_in_millions) AS BIGINT) AS Profit,
               CAST(trunc(assets_in_millions) AS BIGINT) AS Assets,
               CAST(trunc(market_value_in_millions) AS BIGINT) AS MarketValue
        FROM {{companies_raw}}""",
    "fact_rank": f"""
        SELECT {key("rank")} AS ForbesRankKey, {key("company", "headquarters")} AS CompanyKey,
               financial_year AS Year, rank AS ForbesRank
        FROM {{companies_raw}}""",
    "fact_stock": f"SELECT {STOCK_FACT} FROM {{stocks_view}} JOIN {{companies_raw}} ON ticker = ticker_symbol",
    "gold_stock": f"SELECT {STOCK_FACT} FROM {{stocks_first}} JOIN {{companies_raw}} ON ticker = ticker_symbol",
    # Everything a question needs about a quote, joined on natural columns.
    "quotes": """
        SELECT s.ticker_symbol, s.exchange, s.trading_day, s.close_price, s.market_cap, s.dividend,
               c.company, c.industry, c.rank, trunc(c.profit_in_millions) AS profit
        FROM {stocks_first} s JOIN {companies_raw} c ON c.ticker = s.ticker_symbol""",
    "quotes_last": """
        SELECT s.ticker_symbol, s.trading_day, s.market_cap, c.industry, c.rank
        FROM {stocks_view} s JOIN {companies_raw} c ON c.ticker = s.ticker_symbol""",
    # The first form of the star keeps cents.
    "quotes_v1": """
        SELECT CAST(s.close_price AS DECIMAL(19, 2)) AS close, c.company, c.industry, c.rank,
               CAST(c.profit_in_millions AS DECIMAL(19, 2)) AS profit, year(s.trading_day) AS y
        FROM {stocks_view} s JOIN {companies_raw} c ON c.ticker = s.ticker_symbol""",
    "ranking_text": """
        SELECT CAST(rank AS VARCHAR) AS rank_text, rank, company AS "Company",
               headquarters AS "Headquarters", industry AS "Industry",
               '$' || format('{{:,.2f}}', sales_in_millions) AS "Sales ($B)",
               CASE WHEN profit_in_millions < 0 THEN '0.' || rank || '.6'
                    ELSE CAST(profit_in_millions AS VARCHAR) END AS "Profit ($B)",
               CAST(assets_in_millions AS VARCHAR) AS "Assets ($B)",
               CASE WHEN industry <> 'BUILDING' THEN CAST(CAST(market_value_in_millions AS BIGINT) AS VARCHAR) END
                   AS "Market Value ($B)",
               profit_in_millions < 0 AS bad
        FROM {companies_raw}""",
    "ranking_parsed": """
        SELECT *,
               CAST(replace(replace("Sales ($B)", '$', ''), ',', '') AS DOUBLE) * 1000 AS sales_in_millions,
               CASE WHEN NOT bad THEN CAST("Profit ($B)" AS DOUBLE) * 1000 END AS profit_in_millions,
               CAST("Assets ($B)" AS DOUBLE) * 1000 AS assets_in_millions,
               coalesce(CAST("Market Value ($B)" AS DOUBLE), 0) * 1000 AS market_value_in_millions,
               CASE WHEN bad THEN 'could not convert string to float: ''' || "Profit ($B)" || '''' END AS "Reason"
        FROM {ranking_text}""",
    "upserted": """
        SELECT DateKey, CompanyKey, TickerKey, TradingDate, OpenPrice,
               CASE WHEN TradingDate >= DATE '1998-07-10' THEN ClosePrice * 2 ELSE ClosePrice END AS ClosePrice,
               HighPrice, LowPrice, MarketCap, Dividend
        FROM {fact_stock}""",
    # Staged snapshots of three periods: the last state of each company, or ticker, seen in each.
    "company_states": f"""
        SELECT CASE WHEN financial_year < 1997 THEN TIMESTAMP '1997-01-01'
                    WHEN financial_year < 1999 THEN TIMESTAMP '1999-01-01'
                    ELSE TIMESTAMP '2002-01-01' END AS taken,
               {key("company", "headquarters")} AS CompanyKey, company AS CompanyName,
               headquarters AS Headquarters, industry AS Industry, version
        FROM {{company_versions}}
        QUALIFY row_number() OVER (PARTITION BY CompanyKey, taken ORDER BY version DESC) = 1""",
    "company_changes": """
        SELECT *, row_number() OVER w = 1 OR Industry <> lag(Industry) OVER w AS opens
        FROM {company_states} WINDOW w AS (PARTITION BY CompanyKey ORDER BY taken)""",
    "company_history": """
        SELECT CompanyKey, CompanyName, Headquarters, Industry, 'sector' AS Sector, taken AS valid_from,
               lead(taken) OVER (PARTITION BY CompanyKey ORDER BY taken) AS valid_to
        FROM {company_changes} WHERE opens""",
    "ticker_states": f"""
        SELECT CASE WHEN year(trading_day) < 1997 THEN TIMESTAMP '1997-01-01'
                    WHEN year(trading_day) < 1999 THEN TIMESTAMP '1999-01-01'
                    ELSE TIMESTAMP '2002-01-01' END AS taken,
               {key("ticker_symbol", "exchange")} AS TickerKey, ticker_symbol AS TickerSymbol,
               coalesce(exchange, '') AS Exchange,
               CASE sector WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE '' END AS Currency,
               season AS Sector, version
        FROM {{stocks_raw}}
        QUALIFY row_number() OVER (PARTITION BY TickerKey, taken ORDER BY version DESC) = 1""",
    "ticker_changes": """
        SELECT *, row_number() OVER w = 1 OR Currency <> lag(Currency) OVER w AS opens
        FROM {ticker_states} WINDOW w AS (PARTITION BY TickerKey ORDER BY taken)""",
    "ticker_history": """
        SELECT TickerKey, TickerSymbol, Exchange, 'Equity' AS Class, Currency, Sector, taken AS valid_from,
               lead(taken) OVER (PARTITION BY TickerKey ORDER BY taken) AS valid_to
        FROM {ticker_changes} WHERE opens""",
}

_SHARED_NAME = re.compile(r"\{([a-z_0-9]+)\}")


def _needs(sql: str, seen: list[str]) -> None:
    for name in _SHARED_NAME.findall(sql):
        _needs(SHARED[name], seen)
        if name not in seen:
            seen.append(name)


def complete(sql: str) -> str:
    """The query with the shared table expressions it uses in front, as one statement."""
    names: list[str] = []
    _needs(sql, names)

    def plain(text: str) -> str:
        return _SHARED_NAME.sub(r"\1", text).replace("{{", "{").replace("}}", "}").strip()

    if not names:
        return plain(sql)
    expressions = ",\n".join(f"{n} AS ({plain(SHARED[n])})" for n in names)
    body = plain(sql)
    if body.startswith("WITH "):
        return f"WITH {expressions},\n{body[5:]}"
    return f"WITH {expressions}\n{body}"


ALL_FACT = (
    "DateKey, CompanyKey, TickerKey, TradingDate, OpenPrice, ClosePrice, HighPrice, LowPrice, MarketCap, Dividend"
)
NONPOSITIVE = " OR ".join(
    f"{c} <= 0" for c in ("OpenPrice", "ClosePrice", "HighPrice", "LowPrice", "MarketCap", "Dividend")
)
LOADED = "strftime(TIMESTAMP '2025-01-02', '%Y-%m-%d %H:%M:%S')"
YEAR_MONTH = f"{ints(('year(trading_day)', 'Year'), ('month(trading_day)', 'Month'))}"
BALANCED = "WHERE profit > 0"

ORACLE: dict[str, str] = {
    # sources
    "src_csv_companies": """
        SELECT rank, "Company" AS company, CAST(NULL AS VARCHAR) AS ticker, "Headquarters" AS headquarters,
               "Industry" AS industry, sales_in_millions, profit_in_millions, assets_in_millions,
               market_value_in_millions, CAST(2025 AS INTEGER) AS financial_year
        FROM {ranking_parsed} WHERE NOT bad""",
    "src_csv_ctas": "SELECT * FROM customer",
    "src_table_scan": f"SELECT {COMPANY_COLUMNS} FROM {{companies_raw}}",
    "src_json_project": f"SELECT {COMPANY_COLUMNS.replace(', financial_year', '')} FROM {{companies_raw}}",
    "src_quote_feed": """
        SELECT o_orderkey AS quote_id, 'T' || o_custkey AS ticker_symbol, o_orderstatus AS sector,
               o_totalprice * 0.5 AS open_price, o_totalprice AS close_price, o_totalprice * 2 AS high_price,
               o_totalprice * 0.25 AS low_price, o_orderkey * 1000 AS market_cap,
               CASE WHEN o_custkey % 4 <> 0 THEN 'USD' END AS currency,
               CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority END AS exchange,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 0.125 END AS dividend
        FROM orders WHERE o_orderstatus <> 'P'""",
    # sinks and load modes
    "sink_append_typed": f"SELECT {STOCK_COLUMNS} FROM {{stocks_raw}}",
    "load_insert_absent_company": f"""
        SELECT {COMPANY_COLUMNS} FROM {{company_versions}} v
        WHERE financial_year > 1995 AND NOT EXISTS (
            SELECT 1 FROM {{company_versions}} t WHERE t.rank = v.rank AND t.financial_year <= 1995)
        QUALIFY row_number() OVER (PARTITION BY rank ORDER BY version) = 1""",
    "load_insert_absent_stock": f"SELECT {STOCK_COLUMNS} FROM {{stocks_first}}",
    "load_skip_existing_day": f"""
        SELECT {STOCK_COLUMNS} FROM {{stocks_raw}} WHERE trading_day NOT IN (
            SELECT trading_day FROM {{stocks_raw}} WHERE trading_day < DATE '1999-01-01')""",
    "load_upsert_rank": f"""
        SELECT {COMPANY_COLUMNS} FROM {{company_versions}}
        QUALIFY CASE WHEN max(financial_year) OVER (PARTITION BY rank) >= 2000
                     THEN row_number() OVER (PARTITION BY rank ORDER BY financial_year >= 2000 DESC, version DESC)
                     ELSE row_number() OVER (PARTITION BY rank ORDER BY version) END = 1""",
    "load_full_refresh": f"SELECT {COMPANY_COLUMNS} FROM {{companies_raw}}",
    "load_delete_keys": f"SELECT {COMPANY_COLUMNS} FROM {{company_versions}} WHERE profit_in_millions >= 0",
    "load_compact_dedup": f"SELECT {STOCK_COLUMNS} FROM {{stocks_view}}",
    "load_delete_keys_months": f"""
        SELECT {STOCK_COLUMNS} FROM {{stocks_raw}} s WHERE NOT EXISTS (
            SELECT 1 FROM {{stocks_raw}} k WHERE year(k.trading_day) = 1996 AND k.sector = 'F'
            AND k.ticker_symbol = s.ticker_symbol AND k.execution_date_utc = s.execution_date_utc)""",
    "load_compact_months": f"""
        SELECT {STOCK_COLUMNS} FROM {{stocks_raw}} WHERE trading_day >= DATE '1998-01-01'
        UNION ALL
        SELECT {STOCK_COLUMNS} FROM (
            SELECT * REPLACE (close_price * 2 AS close_price) FROM {{stocks_view}} WHERE trading_day < DATE '1998-01-01')""",
    "load_rankings_file": """
        SELECT rank, "Company" AS company, CASE WHEN profit_in_millions > 0 THEN 'T' || (rank - 1) END AS ticker,
               "Headquarters" AS headquarters, "Industry" AS industry, sales_in_millions, profit_in_millions, assets_in_millions,
               market_value_in_millions, CAST(2025 AS INTEGER) AS financial_year
        FROM {ranking_parsed} WHERE NOT bad""",
    "sink_tickers_not_found": """
        SELECT rank_text AS "Rank", "Company" FROM {ranking_parsed} WHERE bad OR profit_in_millions = 0""",
    "load_quotes_feed": f"""
        SELECT 'T' || o_custkey AS ticker_symbol, o_orderstatus AS sector, p * 0.5 AS open_price, p AS close_price,
               p * 2 AS high_price, p * 0.25 AS low_price, o_orderkey * 1000 AS market_cap,
               CASE WHEN o_custkey % 4 <> 0 THEN 'USD' END AS currency,
               CASE WHEN o_custkey % 3 <> 0 THEN o_orderpriority END AS exchange,
               CASE WHEN o_orderkey % 5 <> 0 THEN p * 0.125 END AS dividend,
               strftime(d, '%Y-%m-%d') || ' 22:15:30' AS execution_date_utc, d AS trading_day,
               {ints(("month(d)", "month"))}, dayname(d) AS day_of_week, {ints(("quarter(d)", "quarter"))},
               {SEASON.format("d")} AS season
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, CASE WHEN year(o_orderdate) < 1998 THEN 1 ELSE 2 END * o_totalprice AS p
              FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
              QUALIFY row_number() OVER (PARTITION BY o_custkey, d ORDER BY o_orderkey) = 1)
        WHERE o_orderstatus <> 'P'""",
    "sink_create_replace": "SELECT * FROM supplier",
    "sink_ctas_sorted": f"SELECT * REPLACE ({ts('l_shipdate')} AS l_shipdate) FROM lineitem",
    "sink_rejects": """
        SELECT rank_text AS "Rank", "Company", "Headquarters", "Industry", "Sales ($B)", "Profit ($B)",
               "Assets ($B)", "Market Value ($B)", CAST(NULL AS VARCHAR) AS "Ticker", "Reason"
        FROM {ranking_parsed} WHERE bad""",
    "sink_month_partition": """
        SELECT CAST(strftime(trading_day, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n_quotes,
               min(trading_day) AS first_day, max(trading_day) AS last_day,
               CAST(sum(market_cap) AS BIGINT) AS market_cap
        FROM {stocks_raw} GROUP BY 1""",
    # cleaning
    "clean_trim": "SELECT conv_id, turn, trim(role) AS role, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM conversations",
    "clean_amount": """
        SELECT o_orderkey, o_totalprice * 1000 AS from_number,
               CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE
                    WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 1000 END AS amount
        FROM orders""",
    "clean_defaults": f"""
        SELECT {STOCK_COLUMNS} FROM (
            SELECT * REPLACE (coalesce(currency, '') AS currency, coalesce(exchange, '') AS exchange,
                              coalesce(dividend, 0) AS dividend)
            FROM {{stocks_raw}})""",
    "clean_nan_null": """
        SELECT event_id, p AS price, CAST(trunc(p) AS BIGINT) AS market_cap
        FROM (SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN value * 1000 END AS p FROM events)""",
    "clean_reject_split": """
        SELECT rank_text, "Company", sales_in_millions, profit_in_millions, market_value_in_millions, "Reason"
        FROM {ranking_parsed}""",
    "clean_year_from_file": "SELECT rank, financial_year, count(*) AS n_rows FROM {company_versions} GROUP BY 1, 2",
    "date_attributes": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trading_day, {ints(("month(o_orderdate)", "month"))},
               dayname(o_orderdate) AS day_of_week, {ints(("quarter(o_orderdate)", "quarter"))},
               {SEASON.format("o_orderdate")} AS season
        FROM orders""",
    "date_season": f"""
        SELECT {ints(("month(o_orderdate)", "month"))}, {SEASON.format("o_orderdate")} AS season, count(*) AS n_rows
        FROM orders GROUP BY 1, 2""",
    "filter_missing_ticker": """
        SELECT o_orderkey, 'T' || o_custkey AS ticker FROM orders
        WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT', '2-HIGH')""",
    "dedup_keep_first": f"""
        SELECT {COMPANY_COLUMNS} FROM {{company_versions}}
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY version) = 1""",
    "limit_first_n": f"""
        SELECT {COMPANY_COLUMNS} FROM (SELECT * FROM {{company_versions}} ORDER BY version LIMIT 100)
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY version) = 1""",
    "clean_run_timestamp": f"""
        SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE {ts("ts")} END AS execution_date_utc
        FROM events""",
    # dedup and silver
    "dedup_last_version": f"""
        SELECT * REPLACE ({ts("l_shipdate")} AS l_shipdate) FROM (
            SELECT * FROM lineitem
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                         l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1)""",
    "view_companies": f"""
        SELECT {COMPANY_COLUMNS} FROM (
            SELECT * FROM {{company_versions}} QUALIFY row_number() OVER (PARTITION BY rank ORDER BY version DESC) = 1)
        QUALIFY row_number() OVER (PARTITION BY company, headquarters, financial_year ORDER BY version DESC) = 1""",
    "view_companies_years": f"""
        SELECT {COMPANY_COLUMNS} FROM (
            SELECT * FROM {{company_versions}}
            QUALIFY row_number() OVER (PARTITION BY rank, financial_year ORDER BY version DESC) = 1)
        QUALIFY row_number() OVER (PARTITION BY company, headquarters, financial_year ORDER BY version DESC) = 1""",
    "view_stocks": f"SELECT {STOCK_COLUMNS} FROM {{stocks_view}}",
    "stg_dim_company": "SELECT * FROM {dim_company}",
    "stg_dim_date": "SELECT * FROM {dim_date}",
    "stg_dim_ticker": "SELECT * FROM {tickers}",
    "stg_dim_ticker_distinct": "SELECT DISTINCT * FROM {tickers}",
    "stg_fact_financials": "SELECT * FROM {fact_financials}",
    "stg_fact_rank": "SELECT * FROM {fact_rank}",
    "stg_fact_stock": "SELECT * FROM {fact_stock}",
    "stg_fact_stock_fan_out": f"""
        SELECT {date_key("trading_day")} AS DateKey, {key("company", "headquarters")} AS CompanyKey,
               {key("ticker_symbol", "exchange")} AS TickerKey, close_price AS ClosePrice
        FROM {{stocks_view}} JOIN {{company_versions}} ON ticker = ticker_symbol""",
    "key_hash": f"""
        SELECT 'company' AS kind, {key("company", "headquarters")} AS key FROM {{companies_raw}}
        UNION ALL
        SELECT 'ticker', {key("ticker_symbol", "exchange")}
        FROM (SELECT DISTINCT ticker_symbol, exchange FROM {{stocks_raw}})""",
    # gold loads
    "mart_rebuild": "SELECT * FROM {fact_financials}",
    "incr_high_watermark": """
        SELECT * FROM {fact_stock} WHERE TradingDate > (
            SELECT max(TradingDate) FROM {fact_stock} WHERE TradingDate < DATE '2000-06-15')""",
    "incr_delete_insert": "SELECT * FROM {upserted}",
    "pipeline_three_runs": f"SELECT {ALL_FACT} FROM {{gold_stock}}",
    "pipeline_late_quote": f"""
        SELECT {key("ticker_symbol", "exchange")} AS TickerKey, ticker_symbol AS TickerSymbol, coalesce(exchange, '') AS Exchange,
               'Equity' AS Class, CASE sector WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE '' END AS Currency,
               coalesce(sector, '') AS Sector, CAST(NULL AS VARCHAR) AS ValidTo,
               CASE WHEN trading_day >= DATE '1999-01-01' THEN '2025-01-02 00:00:00' ELSE '2025-01-03 00:00:00' END AS ValidFrom
        FROM {{stocks_first}}
        QUALIFY row_number() OVER (PARTITION BY ticker_symbol, coalesce(exchange, '') ORDER BY execution_date_utc DESC) = 1""",
    "pipeline_renamed_same_day": f"""
        WITH quoted AS (
            SELECT *, 10 AS hour FROM {{stocks_first}} WHERE trading_day < DATE '1999-01-01'
            UNION ALL
            SELECT * REPLACE (close_price * 2 AS close_price), 22 AS hour FROM (
                SELECT * FROM {{stocks_raw}} WHERE sector = 'F'
                QUALIFY row_number() OVER (PARTITION BY ticker_symbol, execution_date_utc ORDER BY version) = 1)),
        last_quotes AS (
            SELECT *, min(hour) OVER same = 10 AS known FROM quoted
            WINDOW same AS (PARTITION BY ticker_symbol, coalesce(exchange, ''), trading_day)
            QUALIFY row_number() OVER (PARTITION BY ticker_symbol, coalesce(exchange, ''), trading_day ORDER BY hour DESC) = 1)
        SELECT {STOCK_FACT} FROM (
            SELECT q.*, CASE WHEN known THEN company ELSE company || ' Renamed' END AS company, headquarters
            FROM last_quotes q JOIN {{companies_raw}} ON ticker = ticker_symbol)""",
    "key_hash_star": """
        SELECT company AS CompanyName, headquarters AS Headquarters, ticker_symbol AS TickerSymbol, coalesce(exchange, '') AS Exchange,
               trading_day AS TradingDate, close_price AS ClosePrice, CAST(market_cap AS DOUBLE) AS MarketCap
        FROM {stocks_first} JOIN {companies_raw} ON ticker = ticker_symbol""",
    "scd2_company": f"""
        SELECT * REPLACE ({ts("valid_from")} AS valid_from, {ts("valid_to")} AS valid_to) FROM {{company_history}}""",
    "scd2_ticker": f"""
        SELECT * REPLACE ({ts("valid_from")} AS valid_from, {ts("valid_to")} AS valid_to) FROM {{ticker_history}}""",
    "scd2_expose": f"""
        SELECT CompanyKey, CompanyName, Headquarters, Industry, Sector,
               {ts("valid_from")} AS ValidFrom, {ts("valid_to")} AS ValidTo
        FROM {{company_history}}""",
    "scd2_expose_current": f"""
        SELECT CompanyKey, CompanyName, Headquarters, Industry, Sector,
               {ts("valid_from")} AS ValidFrom, {ts("valid_to")} AS ValidTo
        FROM {{company_history}} WHERE valid_to IS NULL""",
    # joins
    "join_star": f"""
        SELECT {date_key("trading_day")} AS DateKey, close_price AS ClosePrice, CAST(market_cap AS DOUBLE) AS MarketCap,
               company AS CompanyName, industry AS Industry, ticker_symbol AS TickerSymbol,
               coalesce(exchange, '') AS Exchange,
               {ints(("year(trading_day)", "Year"), ("quarter(trading_day)", "Quarter"))}
        FROM {{quotes}}""",
    "join_expr_key": """
        SELECT CompanyKey, CompanyName, d.Industry, rank FROM {companies_raw} r JOIN {dim_company} d
        ON d.CompanyName = r.company AND d.Headquarters = r.headquarters""",
    "join_left_map": """
        SELECT rank, company, industry, CASE WHEN profit_in_millions > 0 THEN ticker END AS mapped_ticker
        FROM {companies_raw}""",
    "join_anti_unresolved": "SELECT rank, company FROM {companies_raw} WHERE profit_in_millions <= 0",
    "join_semi_existing": """
        SELECT rank, company, ticker FROM {companies_raw} WHERE rank IN (
            SELECT rank FROM {company_versions} WHERE financial_year <= 1995)""",
    # aggregates, windows, subqueries
    "agg_rare_groups": """
        SELECT headquarters AS "Headquarters", count(*) AS n_companies FROM {companies_raw}
        GROUP BY 1 HAVING count(*) < 50""",
    "agg_count_distinct": """
        SELECT industry AS "Industry", count(DISTINCT company) AS n_companies,
               count(DISTINCT ticker_symbol || '@' || coalesce(exchange, '')) AS n_tickers
        FROM {quotes} GROUP BY 1""",
    "agg_max_date": """
        SELECT industry AS "Industry", max(trading_day) AS last_day, min(trading_day) AS first_day
        FROM {quotes} GROUP BY 1""",
    "agg_avg_of_ratio": """
        SELECT industry AS "Industry", round(avg(close_price / nullif(profit, 0)), 6) AS mean_of_ratios,
               round(avg(close_price) / nullif(avg(profit), 0), 6) AS ratio_of_means
        FROM {quotes} GROUP BY 1""",
    "win_rolling_avg": f"""
        SELECT industry AS "Industry", {date_key("trading_day")} AS DateKey, ticker_symbol AS TickerSymbol,
               CAST(market_cap AS DOUBLE) AS MarketCap,
               avg(market_cap) OVER (PARTITION BY industry ORDER BY trading_day, ticker_symbol
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_3_rows
        FROM {{quotes}}""",
    "win_lag_growth": f"""
        SELECT "Industry", "Year", round(a, 6) AS avg_close,
               round((a - lag(a) OVER w) / nullif(lag(a) OVER w, 0), 9) AS yoy_growth
        FROM (SELECT industry AS "Industry", {ints(("year(trading_day)", "Year"))}, avg(close_price) AS a
              FROM {{quotes}} GROUP BY 1, 2)
        WINDOW w AS (PARTITION BY "Industry" ORDER BY "Year")""",
    "win_group_count": """
        SELECT CompanyKey, CompanyName, Industry, count(*) OVER (PARTITION BY Industry) AS Industry_count
        FROM {dim_company}""",
    "sub_scalar_max": f"""
        SELECT {ALL_FACT} FROM {{gold_stock}} WHERE TradingDate = (SELECT max(TradingDate) FROM {{dim_date}})""",
    # scalar functions
    "fn_null_handling": """
        SELECT market_cap, coalesce(exchange, '') AS exchange, nullif(currency, 'USD') AS foreign_currency,
               close_price / nullif(coalesce(dividend, 0), 0) AS per_dividend,
               CASE WHEN exchange IS NOT NULL THEN ticker_symbol || exchange END AS null_if_any
        FROM {stocks_raw}""",
    "fn_date_parts": f"""
        SELECT o_orderkey,
               {ints(("year(o_orderdate)", "year"), ("month(o_orderdate)", "month"), ("day(o_orderdate)", "day"),
                     ("quarter(o_orderdate)", "quarter"), ("strftime(o_orderdate, '%Y%m')", "yyyymm"))}
        FROM orders""",
    "fn_string_mask": """
        SELECT doc_id, left(text, 3) AS head, left(text, 3) || '***' AS masked, length(text) AS n_characters,
               CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes
        FROM documents""",
    "fn_int_div": """
        SELECT o_orderkey, o_orderkey // 100 AS hundreds, CAST(o_orderkey // 100 * 100 + 99 AS VARCHAR) AS top
        FROM orders""",
    "fn_interval": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS year_before FROM orders",
    # the business questions
    "q1_rolling_marketcap": f"""
        SELECT industry AS "Industry", {YEAR_MONTH},
               avg(market_cap) OVER (PARTITION BY industry ORDER BY trading_day, ticker_symbol
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_3m_marketcap
        FROM {{quotes}} WHERE rank <= 20 ORDER BY 4 DESC NULLS LAST, 1, 2, 3 LIMIT 10""",
    "q1_rolling_marketcap_monthly": f"""
        WITH monthly AS (SELECT industry, {YEAR_MONTH}, avg(market_cap) AS m FROM {{quotes}} WHERE rank <= 20
                         GROUP BY ALL)
        SELECT industry AS "Industry", "Year", "Month",
               round(avg(m) OVER (PARTITION BY industry ORDER BY "Year" * 12 + "Month"
                                  RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS avg_3m_marketcap
        FROM monthly ORDER BY 4 DESC NULLS LAST, 1, 2, 3 LIMIT 10""",
    "q2_pe_top10": f"""
        SELECT {YEAR_MONTH}, {ints(("day(trading_day)", "Day"))}, company AS "CompanyName", industry AS "Industry",
               round(avg(close_price) / nullif(avg(profit), 0), 6) AS pe_ratio
        FROM {{quotes}} GROUP BY ALL HAVING avg(profit) > 0
        ORDER BY avg(close_price) / nullif(avg(profit), 0) DESC NULLS LAST, 4, 5, 1, 2, 3 LIMIT 10""",
    "q3_roa_top10": """
        SELECT company AS "CompanyName", industry AS "Industry",
               trunc(profit_in_millions) / trunc(assets_in_millions) AS roa
        FROM {companies_raw} WHERE trunc(assets_in_millions) > 0
        ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 10""",
    "q4_peer_pe": """
        WITH per_day AS (
            SELECT industry, trading_day, avg(close_price / profit) AS avg_pe
            FROM {quotes} WHERE rank <= 2000 AND profit > 0 GROUP BY 1, 2),
        per_company AS (
            SELECT industry, company, avg(close_price / profit) AS company_pe
            FROM {quotes} WHERE profit > 0 GROUP BY 1, 2)
        SELECT trading_day AS "TradingDate", industry AS "Industry", company AS "CompanyName",
               round(company_pe, 6) AS company_pe, round(avg_pe, 6) AS avg_pe, round(company_pe - avg_pe, 6) AS delta
        FROM per_company JOIN per_day USING (industry)
        ORDER BY industry, per_company.company_pe - per_day.avg_pe DESC, per_company.company_pe DESC, company,
                 per_day.avg_pe, trading_day LIMIT 20""",
    "q4_peer_pe_top1": """
        WITH last AS (
            SELECT trading_day, industry, company, avg(close_price / profit) AS pe, sum(close_price / profit) AS s,
                   count(*) AS n
            FROM {quotes} WHERE rank <= 2000 AND profit > 0
              AND trading_day = (SELECT max(trading_day) FROM {stocks_raw}) GROUP BY 1, 2, 3)
        SELECT trading_day AS "TradingDate", industry AS "Industry", company AS "CompanyName",
               round(pe, 6) AS company_pe, round(sum(s) OVER i / sum(n) OVER i, 6) AS avg_pe,
               round(pe - sum(s) OVER i / sum(n) OVER i, 6) AS delta
        FROM last
        WINDOW i AS (PARTITION BY industry)
        QUALIFY row_number() OVER (PARTITION BY industry ORDER BY pe DESC, company DESC) = 1""",
    "q5_revenue": """
        SELECT industry AS "Industry", CAST(sum(CAST(trunc(sales_in_millions) AS BIGINT)) AS BIGINT) AS total_revenue
        FROM {companies_raw} WHERE rank <= 2000 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "q6_yoy_lag": """
        WITH yearly AS (SELECT industry, year(trading_day) AS y, avg(close_price) AS a FROM {quotes}
                        WHERE rank <= 2000 GROUP BY 1, 2),
        change AS (SELECT industry, (a - lag(a) OVER w) / nullif(lag(a) OVER w, 0) AS g FROM yearly
                   WINDOW w AS (PARTITION BY industry ORDER BY y))
        SELECT industry AS "Industry", round(avg(g), 9) AS avg_yoy_growth
        FROM change GROUP BY 1 ORDER BY avg(g) DESC NULLS LAST, 1 LIMIT 1""",
    "q6_yoy_exact": """
        WITH yearly AS (SELECT *, date_trunc('year', trading_day) AS d FROM {quotes}),
        latest AS (SELECT max(d) AS d FROM yearly)
        SELECT n.industry AS "Industry", round(avg((n.close_price - p.close_price) / p.close_price * 100), 6)
                   AS avg_yoy_growth_pct, count(DISTINCT n.company) AS company_count
        FROM yearly n JOIN yearly p ON p.company = n.company
        WHERE n.d = (SELECT d FROM latest) AND p.d = (SELECT d - INTERVAL 1 YEAR FROM latest)
        GROUP BY 1""",
    "q6_yoy_asof": """
        WITH latest AS (SELECT max(trading_day) AS d FROM {quotes}),
        ends AS (
            SELECT industry, company,
                   max({{'d': trading_day, 'c': close_price}}) AS now,
                   max({{'d': trading_day, 'c': close_price}}) FILTER (
                       trading_day <= (SELECT CAST(d - INTERVAL 1 YEAR AS DATE) FROM latest)) AS past
            FROM {quotes} GROUP BY 1, 2)
        SELECT industry AS "Industry", round(avg((now.c - past.c) / past.c) * 100, 6) AS avg_yoy_growth_pct,
               count(*) AS company_count
        FROM ends WHERE past IS NOT NULL GROUP BY 1""",
    "q1_rolling_marketcap_v1": f"""
        SELECT industry AS "Industry", {YEAR_MONTH},
               avg(market_cap) OVER (PARTITION BY industry ORDER BY trading_day, ticker_symbol
                                     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg_3m_marketcap
        FROM {{quotes_last}} WHERE rank <= 20 ORDER BY 4 DESC NULLS LAST, 1, 2, 3 LIMIT 10""",
    "q2_pe_top10_v1": """
        WITH sums AS (SELECT company, industry, CAST(sum(close) AS DOUBLE) AS c, CAST(sum(profit) AS DOUBLE) AS p,
                             count(*) AS n FROM {quotes_v1} GROUP BY 1, 2)
        SELECT company AS "CompanyName", industry AS "Industry", (c / n) / (p / n) AS pe_ratio
        FROM sums WHERE p > 0 ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 10""",
    "q3_roa_top10_v1": """
        SELECT company AS "CompanyName", industry AS "Industry", profit_in_millions / assets_in_millions AS roa
        FROM {companies_raw} WHERE assets_in_millions > 0 ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 10""",
    "q4_peer_pe_v1": """
        WITH means AS (SELECT industry, avg(CAST(close AS DOUBLE) / nullif(CAST(profit AS DOUBLE), 0)) AS avg_pe
                       FROM {quotes_v1} WHERE rank <= 2000 GROUP BY 1),
        firms AS (SELECT industry, company,
                         (CAST(sum(close) AS DOUBLE) / count(*)) / nullif(CAST(sum(profit) AS DOUBLE) / count(*), 0) AS pe
                  FROM {quotes_v1} GROUP BY 1, 2)
        SELECT industry AS "Industry", company AS "CompanyName", round(pe, 6) AS company_pe,
               round(avg_pe, 6) AS avg_pe, round(pe - avg_pe, 6) AS delta
        FROM firms JOIN means USING (industry)""",
    "q5_revenue_v1": """
        SELECT industry AS "Industry", CAST(sum(CAST(sales_in_millions AS DECIMAL(19, 2))) AS DOUBLE) AS total_revenue
        FROM {companies_raw} WHERE rank <= 2000 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "q6_yoy_lag_v1": """
        WITH yearly AS (SELECT industry, y, CAST(sum(close) AS DOUBLE) / count(*) AS a FROM {quotes_v1}
                        WHERE rank <= 2000 GROUP BY 1, 2),
        change AS (SELECT industry, (a - lag(a) OVER w) / nullif(lag(a) OVER w, 0) AS g FROM yearly
                   WINDOW w AS (PARTITION BY industry ORDER BY y))
        SELECT industry AS "Industry", round(avg(g), 9) AS avg_yoy_growth
        FROM change GROUP BY 1 ORDER BY avg(g) DESC NULLS LAST, 1 LIMIT 1""",
    # data quality
    "dq_ticker_not_null": f"""
        SELECT {key("ticker_symbol", "exchange")} AS TickerKey, currency AS "Currency", market_cap
        FROM {{stocks_raw}} WHERE currency IS NULL""",
    "dq_fact_not_null": f"""
        SELECT ticker_symbol, market_cap, {key("ticker_symbol", "exchange")} AS TickerKey,
               trading_day AS TradingDate, CAST(NULL AS BIGINT) AS CompanyKey
        FROM {{stocks_raw}} JOIN {{companies_raw}} ON ticker = ticker_symbol WHERE profit_in_millions <= 0""",
    "dq_currency_format": "SELECT TickerKey, TickerSymbol, Exchange, Currency FROM {dim_ticker} WHERE strlen(Currency) <> 3",
    "dq_future_date": f"SELECT {ALL_FACT} FROM {{gold_stock}} WHERE TradingDate >= DATE '2001-01-01'",
    "dq_nonpositive": f"SELECT {ALL_FACT} FROM {{gold_stock}} WHERE {NONPOSITIVE}",
    "dq_fk_orphans": f"""
        SELECT 'CompanyKey' AS foreign_key, CompanyKey AS key, count(*) AS n_rows FROM {{gold_stock}}
        WHERE CompanyKey NOT IN (SELECT CompanyKey FROM {{fact_financials}} WHERE Profit > 0) GROUP BY ALL
        UNION ALL
        SELECT 'TickerKey', TickerKey, count(*) FROM {{gold_stock}}
        WHERE TickerKey IN (SELECT TickerKey FROM {{dim_ticker}} WHERE Exchange = '') GROUP BY ALL
        UNION ALL
        SELECT 'DateKey', CAST(DateKey AS BIGINT), count(*) FROM {{gold_stock}}
        WHERE TradingDate >= DATE '2001-01-01' GROUP BY ALL""",
    "dq_pk_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_gold_keys": """
        WITH figures AS (SELECT * FROM {fact_financials} UNION ALL SELECT * FROM {fact_financials} WHERE Profit < 0),
        quotes AS (SELECT * FROM {gold_stock} UNION ALL SELECT * FROM {gold_stock} WHERE year(TradingDate) = 1996),
        firms AS (SELECT CompanyKey FROM {fact_financials} WHERE Profit >= 0),
        listed AS (SELECT TickerKey FROM {dim_ticker} WHERE Exchange <> ''),
        days AS (SELECT DateKey FROM {dim_date} WHERE Year < 2001)
        SELECT 'DimCompany_repeated_key' AS test_name, CAST(0 AS BIGINT) AS failures
        UNION ALL SELECT 'DimTicker_repeated_key', 0
        UNION ALL SELECT 'DimDate_repeated_key', 0
        UNION ALL SELECT 'FactForbesRank_repeated_key', 0
        UNION ALL SELECT 'FactFinancials_repeated_key', count(*) FROM {fact_financials} WHERE Profit < 0
        UNION ALL SELECT 'FactStock_repeated_key', count(*) FROM {gold_stock} WHERE year(TradingDate) = 1996
        UNION ALL SELECT 'FactStock_CompanyKey_orphan', count(*) FROM quotes WHERE CompanyKey NOT IN (SELECT CompanyKey FROM firms)
        UNION ALL SELECT 'FactStock_TickerKey_orphan', count(*) FROM quotes WHERE TickerKey NOT IN (SELECT TickerKey FROM listed)
        UNION ALL SELECT 'FactStock_DateKey_orphan', count(*) FROM quotes WHERE DateKey NOT IN (SELECT DateKey FROM days)
        UNION ALL SELECT 'FactFinancials_CompanyKey_orphan', count(*) FROM figures WHERE CompanyKey NOT IN (SELECT CompanyKey FROM firms)
        UNION ALL SELECT 'FactForbesRank_CompanyKey_orphan', count(*) FROM {fact_rank} WHERE CompanyKey NOT IN (SELECT CompanyKey FROM firms)""",
    "dq_summary": f"""
        SELECT 'ticker_not_null' AS test_name, CAST(0 AS BIGINT) AS failures
        UNION ALL SELECT 'currency_format', count(*) FROM {{dim_ticker}} WHERE strlen(Currency) <> 3
        UNION ALL SELECT 'fact_not_null', CAST(0 AS BIGINT)
        UNION ALL SELECT 'future_date', count(*) FROM {{gold_stock}} WHERE TradingDate >= DATE '2001-01-01'
        UNION ALL SELECT 'nonpositive', count(*) FROM {{gold_stock}} WHERE {NONPOSITIVE}""",
    # privacy
    "mask_prefix": "SELECT p_partkey, left(p_name, 3) || '***' AS p_name_masked FROM part",
    "mask_rare": """
        SELECT CompanyKey, Headquarters, Industry,
               CASE WHEN count(*) OVER (PARTITION BY Headquarters) < 50 THEN 'Other' ELSE Headquarters END
                   AS Headquarters_masked,
               CASE WHEN count(*) OVER (PARTITION BY Industry) < 300 THEN 'Other' ELSE Industry END AS Industry_masked
        FROM {dim_company}""",
    "mask_range": """
        SELECT ForbesRankKey, CompanyKey, Year,
               (ForbesRank // 100 * 100) || '–' || (ForbesRank // 100 * 100 + 99) AS ForbesRank_range
        FROM {fact_rank}""",
    "full_views": f"""
        SELECT c.*, {LOADED} AS ValidFrom, CAST(NULL AS VARCHAR) AS ValidTo, f.* EXCLUDE (CompanyKey),
               r.ForbesRankKey, r.ForbesRank
        FROM {{dim_company}} c JOIN {{fact_financials}} f USING (CompanyKey) JOIN {{fact_rank}} r USING (CompanyKey)""",
    "limited_views": f"""
        SELECT c.CompanyKey, left(CompanyName, 3) || '***' AS CompanyName_masked, Headquarters,
               CASE WHEN count(*) OVER (PARTITION BY Industry) < 300 THEN 'Other' ELSE Industry END AS Industry_masked,
               Sector, {LOADED} AS ValidFrom, CAST(NULL AS VARCHAR) AS ValidTo, f.* EXCLUDE (CompanyKey),
               r.ForbesRankKey,
               (ForbesRank // 100 * 100) || '–' || (ForbesRank // 100 * 100 + 99) AS ForbesRank_range
        FROM {{dim_company}} c JOIN {{fact_financials}} f USING (CompanyKey) JOIN {{fact_rank}} r USING (CompanyKey)""",
    "role_table_set": """
        WITH counts AS (
            SELECT 'DimCompany' AS t, count(*) AS n_rows FROM {dim_company}
            UNION ALL SELECT 'DimTicker', count(*) FROM {dim_ticker}
            UNION ALL SELECT 'DimDate', count(*) FROM {dim_date}
            UNION ALL SELECT 'FactFinancials', count(*) FROM {fact_financials}
            UNION ALL SELECT 'FactForbesRank', count(*) FROM {fact_rank}
            UNION ALL SELECT 'FactStock', count(*) FROM {gold_stock})
        SELECT 'analyst_full' AS role, 'gold_full_views' AS layer, 'v_' || t AS table_name, n_rows FROM counts
        UNION ALL
        SELECT 'analyst_limited', 'gold_limited_views', 'v_limited_' || t, n_rows FROM counts""",
    # streaming
    "stream_bronze_ingest": f"SELECT {STOCK_COLUMNS} FROM {{stocks_first}}",
    "stream_gold_upsert": "SELECT * FROM {upserted}",
}
ORACLE["topk_roa"] = ORACLE["q3_roa_top10"]


def statements() -> dict[str, str]:
    return {name: complete(sql) for name, sql in ORACLE.items()}
