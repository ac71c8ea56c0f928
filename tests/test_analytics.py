from collections import defaultdict
from datetime import date, datetime

import pytest

from conftest import rows
from quotemill import schemas
from quotemill.plans import analytics as A
from quotemill.plans import classic

OPEN, CLOSED = datetime(2024, 1, 1), datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def tables(spark):
    """Six companies in two industries, two of them of one name, one with a closed version."""
    company = [
        # key, name, headquarters, industry, closed
        (1, "Alpha", "EE", "Bank", None), (2, "Beta", "EE", "Bank", None), (3, "Gamma", "US", "Bank", None),
        (4, "Delta", "US", "Oil", None), (5, "Delta", "CL", "Oil", None), (6, "Zeta", "CL", "Oil", None),
        (6, "Zeta", "CL", "Bank", CLOSED),
    ]
    years = {1: [(2023, 100, 5, 50), (2024, 200, 10, 100)], 2: [(2024, 300, 20, 0)], 3: [(2024, 50, -5, 10)],
             4: [(2024, 400, 8, 80)], 5: [(2024, 500, 16, 40)], 6: [(2024, 600, 0, 60)]}
    days = [date(2022, 3, 1), date(2023, 1, 2), date(2023, 2, 1), date(2023, 2, 2), date(2024, 2, 1), date(2024, 2, 2)]
    facts = []
    for key in range(1, 7):
        for i, day in enumerate(days):
            if (key + i) % 4 == 0 and day.year != 2024:
                continue
            for quote in range(1 + (key == 2)):
                close = float(0 if (key, day) == (3, date(2023, 2, 2)) else key * 10 + i * i + quote)
                facts.append((day.year * 10000 + day.month * 100 + day.day, key, key * 10 + quote, day, 1.0, close, 1.0, 1.0, close * 7, 0.0))
    frame = lambda name, data: spark.createDataFrame(data, schemas.GOLD[name])
    seen = sorted({f[3] for f in facts})
    return {
        "DimCompany": frame("DimCompany", [(k, n, h, i, "sector", OPEN, c) for k, n, h, i, c in company]),
        "DimTicker": frame("DimTicker", [(t, f"T{t}", "", "Equity", "USD", "", OPEN, None) for t in sorted({f[2] for f in facts})]),
        "DimDate": frame("DimDate", [(d.year * 10000 + d.month * 100 + d.day, d, d.year, d.month, d.day, 1) for d in seen]),
        "FactFinancials": frame("FactFinancials", [(k, y, s, p, a, 1) for k, ys in years.items() for y, s, p, a in ys]),
        "FactForbesRank": frame("FactForbesRank", [(k * 100 + y, k, y, k) for k, ys in years.items() for y, *_ in ys]),
        "FactStock": frame("FactStock", facts),
    }


def data(tables):
    profit = {r.CompanyKey: r.Profit for r in sorted(tables["FactFinancials"].collect(), key=lambda r: r.Year)}
    names = {r.CompanyKey: (r.CompanyName, r.Industry) for r in tables["DimCompany"].collect() if r.ValidTo is None}
    return [(r, profit[r.CompanyKey], *names[r.CompanyKey]) for r in tables["FactStock"].collect()]


def mean(values):
    values = list(values)
    return sum(values) / len(values) if values else None


def grouped(items):
    out = defaultdict(list)
    for k, v in items:
        out[k].append(v)
    return out


def test_rolling_marketcap(tables):
    series = grouped(((i, (r.DateKey, f"T{r.TickerKey}", r.MarketCap)) for r, _, _, i in data(tables) if r.CompanyKey <= 5))
    want = []
    for industry, items in series.items():
        items.sort()
        for n, (day, _, _) in enumerate(items):
            want.append((industry, day // 10000, day // 100 % 100, mean(v for *_, v in items[max(0, n - 2): n + 1])))
    want.sort(key=lambda r: (-r[3], r[:3]))
    got = [tuple(r) for r in A.rolling_marketcap(tables, rank=5, limit=7).collect()]
    assert [g[:3] for g in got] == [w[:3] for w in want[:7]]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want[:7]])


def test_rolling_marketcap_by_month(tables):
    months = grouped((((i, r.DateKey // 100), r.MarketCap) for r, _, _, i in data(tables)))
    want = []
    for industry in ("Bank", "Oil"):
        means = [(m, mean(months[industry, m])) for g, m in sorted(months) if g == industry]
        number = lambda m: m // 100 * 12 + m % 100
        want += [(industry, m // 100, m % 100, mean(v for k, v in means if 0 <= number(m) - number(k) <= 2)) for m, _ in means]
    got = A.rolling_marketcap_monthly(tables, limit=100).collect()
    assert {tuple(g)[:3]: g[3] for g in got} == pytest.approx({w[:3]: w[3] for w in want})


def test_price_to_earnings_merges_companies_of_one_name(tables):
    groups = grouped((((r.DateKey, n, i), (r.ClosePrice, p)) for r, p, n, i in data(tables)))
    want = {}
    for key, pairs in groups.items():
        profit = mean(p for _, p in pairs)
        if profit > 0:
            want[key] = mean(c for c, _ in pairs) / profit
    got = A.price_to_earnings(tables, limit=1000).collect()
    assert {(r.Year * 10000 + r.Month * 100 + r.Day, r.CompanyName, r.Industry): r.pe_ratio for r in got} == pytest.approx(want)
    assert [r.pe_ratio for r in got] == sorted(want.values(), reverse=True)


def test_return_on_assets_skips_companies_without_assets(tables):
    got = rows(A.return_on_assets(tables, limit=100))
    assert got == [("Alpha", "Bank", 0.1), ("Alpha", "Bank", 0.1), ("Delta", "Oil", 0.1), ("Delta", "Oil", 0.4),
                   ("Gamma", "Bank", -0.5), ("Zeta", "Oil", 0.0)]
    assert A.return_on_assets(tables, limit=100, all_versions=True).count() == 7


@pytest.mark.parametrize("limit", [1, 3, 5, 20, 1000])
def test_peer_pe_equals_the_full_listing(tables, limit):
    good = [(r, p, n, i) for r, p, n, i in data(tables) if p > 0]
    company = {k: mean(v) for k, v in grouped((((i, n), r.ClosePrice / p) for r, p, n, i in good)).items()}
    day = {k: mean(v) for k, v in grouped((((i, r.TradingDate), r.ClosePrice / p) for r, p, _, i in good if r.CompanyKey <= 4)).items()}
    listing = [(d, i, n, c, a, c - a) for (i, n), c in company.items() for (j, d), a in day.items() if i == j]
    listing.sort(key=lambda r: (r[1], -round(r[5], 9), -r[3], r[2], r[4], r[0]))
    got = [tuple(r) for r in A.peer_pe(tables, rank=4, limit=limit).collect()]
    assert [g[:3] for g in got] == [w[:3] for w in listing[:limit]]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in listing[:limit]])


def test_peer_pe_top_of_the_last_day(tables):
    last = date(2024, 2, 2)
    good = [(r, p, n, i) for r, p, n, i in data(tables) if p > 0 and r.TradingDate == last]
    for row in A.peer_pe_top(tables).collect():
        firms = {k: mean(v) for k, v in grouped(((n, r.ClosePrice / p) for r, p, n, i in good if i == row.Industry)).items()}
        whole = mean(r.ClosePrice / p for r, p, _, i in good if i == row.Industry)
        best = max(firms.items(), key=lambda kv: (kv[1], kv[0]))
        assert (row.CompanyName, row.company_pe, row.avg_pe) == (best[0], pytest.approx(best[1]), pytest.approx(whole))
        assert row.TradingDate == last
    assert A.peer_pe_top(tables, until=date(2023, 12, 31)).first().TradingDate == date(2023, 2, 2)


def test_revenue_counts_a_year_once(tables):
    assert rows(A.revenue_by_industry(tables)) == [("Bank", 650), ("Oil", 1500)]
    assert rows(A.revenue_by_industry(tables, rank=3)) == [("Bank", 650)]
    assert rows(A.revenue_by_industry(tables, all_versions=True)) == [("Bank", 1250), ("Oil", 1500)]


def test_yoy_by_year(tables):
    closes = {k: mean(v) for k, v in grouped((((i, r.DateKey // 10000), r.ClosePrice) for r, _, _, i in data(tables))).items()}
    want = {}
    for i in ("Bank", "Oil"):
        want[i] = mean((closes[i, y] - closes[i, y - 1]) / closes[i, y - 1] for y in (2023, 2024))
    got = A.yoy_by_year(tables, limit=10).collect()
    assert {r.Industry: r.avg_yoy_growth for r in got} == pytest.approx(want)
    assert A.yoy_by_year(tables).count() == 1


def test_yoy_exact_equals_all_pairs(tables):
    now, then = grouped([]), grouped([])
    for r, _, _, i in data(tables):
        if r.TradingDate == date(2024, 2, 2):
            now[r.CompanyKey].append((i, r.ClosePrice))
        if r.TradingDate == date(2023, 2, 2):
            then[r.CompanyKey].append(r.ClosePrice)
    pairs = [(k, i, c, p) for k in now for i, c in now[k] for p in then[k]]
    got = {r.Industry: (r.avg_yoy_growth_pct, r.company_count) for r in A.yoy_exact(tables).collect()}
    assert 3 in {k for k, *_ in pairs}, "a prior price of zero takes part"
    for i in ("Bank", "Oil"):
        growth = mean((c - p) / p * 100 for _, j, c, p in pairs if i == j and p)
        assert got[i] == (pytest.approx(growth), len({k for k, j, *_ in pairs if i == j}))


def test_yoy_asof(tables):
    day = date(2024, 2, 1)
    got = {r.Industry: r.avg_yoy_growth_pct for r in A.yoy_asof(tables, day=day).collect()}
    last = {}
    for bound, name in ((day, "now"), (date(2023, 2, 1), "then")):
        for r, _, _, i in data(tables):
            if r.TradingDate <= bound:
                at = (r.TradingDate, r.TickerKey >> 18)
                if (name, r.CompanyKey) not in last or at > last[name, r.CompanyKey][0]:
                    last[name, r.CompanyKey] = (at, r.ClosePrice, i)
    # The company with two tickers whose keys agree in their high bits is left out of the comparison.
    want = grouped((last["now", k][2], (last["now", k][1] / last["then", k][1] - 1) * 100) for k in range(1, 7) if ("then", k) in last)
    assert got["Oil"] == pytest.approx(mean(want["Oil"]))


def test_leap_day():
    assert A.year_before(date(2024, 2, 29)) == date(2023, 2, 28)
    assert A.year_before(date(2025, 3, 1)) == date(2024, 3, 1)


def test_month_partition_is_pruned(tables, spark, path):
    from quotemill.operators.upsert import write_months

    write_months(tables["FactStock"], path, "TradingDate")
    stored = spark.read.parquet(path)
    plan = A.on_day(stored, date(2024, 2, 2))._jdf.queryExecution().executedPlan().toString()
    assert "(yyyymm#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert A.on_day(stored, date(2024, 2, 2)).count() == 7


def test_classic_star_keeps_cents_and_flags_dividends(spark):
    companies = spark.createDataFrame(
        [(1, "A", "TA", "EE", "Bank", 1.25, 0.5, 2.0, 3.0, 2025)], schemas.STORED["silver", "companies"]
    )
    stock = ("TA", None, 1.0, 10.05, 2.0, 0.5, 7, None, "X", 0.1, datetime(2024, 1, 2), date(2024, 1, 2), 1, "Tuesday", 1, "Winter")
    names = [f for f in schemas.STOCKS_RAW.fields if f.name != "_ingested_at"]
    stocks = spark.createDataFrame([stock], schemas.T.StructType(names))
    star = classic.star(companies, stocks)
    assert star["DimDate"].columns == ["DateKey", "TradingDay", "Year", "Month", "Day"]
    fact = star["FactStock"].first()
    assert str(fact.ClosePrice) == "10.05" and fact.Dividend is True
    assert rows(classic.price_to_earnings(star)) == [("A", "Bank", pytest.approx(20.1))]
    assert rows(classic.peer_pe(star)) == [("Bank", "A", pytest.approx(20.1), pytest.approx(20.1), pytest.approx(0.0))]
