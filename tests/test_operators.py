from collections import Counter
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from quotemill.functions import masking as M
from quotemill.operators import dedup, joins, masking, quality as Q, scd2, sinks, upsert, windows
from quotemill.plans import classic, silver
from quotemill.session import pinned


# --- dedup --------------------------------------------------------------------------------------


def test_last_version_does_not_depend_on_order(spark):
    data = [(k, v, x) for k in range(5) for v, x in ((1, "a"), (3, "b"), (3, "c"), (2, "z"), (None, "y"))]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k int, v int, x string").repartition(3)
        assert rows(dedup.last_version(df, ["k"], ["v"])) == [(k, 3, "c") for k in range(5)]


def test_last_version_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = dedup.last_version(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("told", [1_000_000, 0])
def test_keys_that_mostly_come_once(spark, monkeypatch, told):
    """Rows of keys that come once stay where they are; with NULL keys, equal rows and too many repeats the outcome is the same."""
    monkeypatch.setattr(dedup, "TOLD_KEYS", told)
    data = [(k, k, "x") for k in range(50)] + [(3, 9, "a"), (3, 9, "b"), (3, 9, "b"), (None, 1, "n"), (None, 2, "n"), (7, None, "z")]
    df = spark.createDataFrame(data, "k int, v int, x string").repartition(3)
    last = dedup.last_version(df, ["k"], ["v"], mostly_once=True)
    first = dedup.keep_first(df, ["k"], ["v", "x"], mostly_once=True)
    assert rows(last) == rows(dedup.last_version(df, ["k"], ["v"])) and len(rows(last)) == 51
    assert rows(first) == rows(dedup.keep_first(df, ["k"], ["v", "x"]))
    assert ("_hash" in last._jdf.queryExecution().analyzed().toString()) == bool(told)
    single = spark.range(10).selectExpr("id AS k", "id AS v")
    assert "Window" not in dedup.last_version(single, ["k"], ["v"], mostly_once=True)._jdf.queryExecution().analyzed().toString()


def test_views_of_quotes_move_only_repeated_ones(spark):
    quotes = spark.createDataFrame([("A", 1, 1, 2.0), ("A", 1, 2, 3.0), ("B", 1, 1, 4.0)], "ticker_symbol string, t int, i int, close_price double")
    at = {"execution_date_utc": F.timestamp_seconds("t"), "_ingested_at": F.timestamp_seconds("i")}
    view = silver.stocks_view(quotes.withColumns(at).drop("t", "i"))
    plan = view._jdf.queryExecution().analyzed().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert rows(view.select("ticker_symbol", "close_price")) == [("A", 3.0), ("B", 4.0)]


def test_keep_first_and_first_rows(spark):
    df = spark.createDataFrame([("A", 3), ("A", 1), ("B", 2), (None, 4)], "t string, r int")
    assert rows(dedup.keep_first(df, ["t"], ["r"])) == [("A", 1), ("B", 2), (None, 4)]
    assert rows(dedup.first_rows(df, 2, ["r"])) == [("A", 1), ("B", 2)]


# --- joins --------------------------------------------------------------------------------------


def skewed(spark):
    """One key holds more than half of the rows; many of its rows are identical."""
    hot = spark.range(6000).selectExpr("CAST(7 AS INT) AS k", "CAST(id % 3 AS INT) AS v")
    rest = spark.range(5000).selectExpr("CAST(id % 900 AS INT) AS k", "CAST(id AS INT) AS v")
    return hot.unionByName(rest).unionByName(spark.createDataFrame([(None, 1)], "k int, v int"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    large = skewed(spark)
    lookup = spark.range(0, 800, 2).selectExpr("CAST(id AS INT) AS k", "id * 10 AS w").union(
        spark.createDataFrame([(7, 70)], "k int, w bigint")
    )
    hashes, share = joins.heavy_keys(large, ["k"])
    assert len(hashes) == 1 and 0.5 < share < 0.6
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.lookup_join(large, lookup, ["k"], how)
        assert "_salt" in spread._jdf.queryExecution().analyzed().toString()
        assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, large.join(lookup, "k", how).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_spread_join_spreads_the_heavy_key(spark):
    large = skewed(spark).repartition(4)
    hashes, _ = joins.heavy_keys(large, ["k"])
    heavy = joins._key_hash(["k"]).isin(hashes)
    content = F.pmod(F.xxhash64("k", "v"), F.lit(4))
    salts = large.where(heavy).groupBy(F.pmod(content + F.spark_partition_id(), F.lit(4)).alias("s")).count().collect()
    assert len(salts) == 4 and max(r["count"] for r in salts) < 4000


def test_small_lookups_are_left_to_spark(spark):
    lookup = spark.range(7, 8).selectExpr("CAST(id AS INT) AS k", "1 AS w")
    plan = joins.lookup_join(skewed(spark), lookup, ["k"])._jdf.queryExecution().analyzed().toString()
    assert "_salt" not in plan


def test_map_and_unresolved(spark):
    people = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "r int, c string")
    mapping = spark.createDataFrame([(1, "A", "TA"), (2, "X", "TX")], "r int, c string, t string")
    assert rows(joins.map_left(people, mapping, ["r", "c"])) == [(1, "A", "TA"), (2, "B", None), (3, "C", None)]
    assert rows(joins.unresolved(people, mapping, ["r", "c"])) == [(2, "B"), (3, "C")]
    assert rows(joins.existing(people, mapping, ["r"])) == [(1, "A"), (2, "B")]


# --- windows ------------------------------------------------------------------------------------


def brute_rolling(data, size):
    out = []
    groups = {}
    for g, b, o, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        seen = groups.setdefault(g, [])
        seen.append(v)
        frame = [x for x in seen[-size:] if x is not None]
        out.append((g, b, o, v, sum(frame) / len(frame) if frame else None))
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(1, 6), st.one_of(st.none(), st.integers(-50, 50))),
        min_size=1, max_size=40,
    ),
    st.sampled_from([1, 2, 3, 5]),
)
def test_rolling_mean_equals_brute_force(spark, items, size):
    data = [(g, b, i, None if v is None else float(v)) for i, (g, b, v) in enumerate(items)]
    df = spark.createDataFrame(data, "g string, b int, o int, v double")
    got = rows(windows.rolling_mean(df, ["g"], "b", ["o"], "v", size, "m"))
    want = brute_rolling(data, size)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert (a[4] is None and b[4] is None) or abs(a[4] - b[4]) < 1e-9


def test_rolling_mean_shuffles_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 2 AS g", "CAST(id % 50 AS INT) AS b", "id AS o", "id * 1.0D AS v")
    out = windows.rolling_mean(df, ["g"], "b", ["o"], "v", 3, "m")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = out.select("*")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # One shuffle of the rows, used twice; the others carry leftovers of buckets.
    assert "ReusedExchange" in plan and plan.count("Range (") == 1


def test_growth_and_group_count(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, 0.0), ("a", 4, 5.0)], "g string, y int, v double")
    assert [r[3] for r in rows(windows.growth(df, ["g"], ["y"], "v", "d"))] == [None, 0.5, -1.0, None]
    counted = spark.createDataFrame([("x",), ("x",), (None,), ("=",)], "g string")
    assert rows(windows.group_count(counted, ["g"], "n")) == [("=", 1), ("x", 2), ("x", 2), (None, 1)]


# --- loads --------------------------------------------------------------------------------------

SCHEMA = "k int, v string, o int"


def test_insert_absent_first_wins_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old", 0), (1, "older", 0)], SCHEMA)
    batch = spark.createDataFrame([(1, "new", 1), (2, "b", 3), (2, "a", 2), (3, "c", 4)], SCHEMA)
    fresh = upsert.insert_absent(target, batch, ["k"], ["o"])
    assert rows(fresh) == [(2, "a", 2), (3, "c", 4)]
    assert upsert.insert_absent(target.union(fresh), batch, ["k"], ["o"]).isEmpty()
    assert upsert.insert_absent(target.limit(0), batch, ["k"], ["o"]).count() == 3


def test_skip_loaded_days(spark):
    frame = lambda *r: spark.createDataFrame(r, "trading_day date, v int")
    target = frame((date(2024, 1, 1), 1), (date(2024, 1, 1), 2))
    batch = frame((date(2024, 1, 1), 3), (date(2024, 1, 2), 4), (date(2024, 1, 2), 5))
    assert [r[1] for r in rows(upsert.skip_loaded_days(target, batch))] == [4, 5]
    assert upsert.day_is_loaded(target, date(2024, 1, 1)) and not upsert.day_is_loaded(target, date(2024, 1, 2))


def test_upsert_delete_and_watermark(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    batch = spark.createDataFrame([(2, "first", 1), (2, "last", 2), (3, "c", 1)], SCHEMA)
    done = upsert.upsert_whole(target, batch, ["k"], ["o"])
    assert rows(done) == [(1, "a", 1), (2, "last", 2), (3, "c", 1)]
    assert rows(upsert.upsert_whole(done, batch, ["k"], ["o"])) == rows(done)
    assert rows(upsert.delete_keys(target, spark.createDataFrame([(2,), (2,), (9,)], "k int"), ["k"])) == [(1, "a", 1)]
    days = lambda *ds: spark.createDataFrame([(date(2024, 1, d),) for d in ds], "TradingDate date")
    assert rows(upsert.newer_than(days(1, 2, 3), days(2))) == [(date(2024, 1, 3),)]
    assert upsert.newer_than(days(1, 2), days(1).limit(0)).count() == 2


def files(spark, path, month):
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/yyyymm={month}")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(fs_path) if s.getPath().getName().startswith("part"))


def test_month_upsert_rewrites_only_touched_months(spark, path):
    schema = "day date, k int, v string"
    first = [(date(2024, m, d), d, "a") for m in (1, 2, 3) for d in (1, 2)]
    upsert.write_months(spark.createDataFrame(first, schema), path, "day", ["k"])
    untouched = files(spark, path, 202401), files(spark, path, 202403)
    batch = spark.createDataFrame([(date(2024, 2, 1), 1, "b"), (date(2024, 2, 9), 9, "new"), (date(2024, 4, 1), 1, "x")], schema)
    for _ in range(2):
        upsert.delete_insert_months(spark, path, batch, ["day", "k"], "day", ["k"])
        got = rows(upsert.read_months(spark, path))
        assert len(got) == 8 and got.count((date(2024, 2, 1), 1, "b")) == 1 and (date(2024, 2, 1), 1, "a") not in got
    assert (files(spark, path, 202401), files(spark, path, 202403)) == untouched
    plan = spark.read.parquet(path).where(F.col("yyyymm") == 202402)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan


def test_a_written_batch_is_not_written_again(spark, path, monkeypatch):
    batch = pinned(spark.createDataFrame([("a", date(2024, 1, 5), 1), ("b", date(2024, 1, 6), 2)], "k string, day date, v int"), "own")
    upsert.append_absent_months(spark, path, batch.where("k = 'a'"), ["day", "k"], "day", ["v"], target_exists=False)
    labels = []
    monkeypatch.setattr(upsert, "pinned", lambda df, label: labels.append(label) or df)
    assert upsert.append_absent_months(spark, path, batch, ["day", "k"], "day", ["v"], written=True) == [202401]
    assert labels == [] and rows(upsert.read_months(spark, path).select("k", "v")) == [("a", 1), ("b", 2)]


def test_append_absent_months(spark, path):
    schema = "day date, k int, v string"
    frame = lambda *r: spark.createDataFrame(r, schema)
    batch = frame((date(2024, 1, 1), 1, "a"), (date(2024, 1, 1), 1, "b"), (date(2024, 2, 1), 1, "c"))
    assert upsert.append_absent_months(spark, path, batch, ["day", "k"], "day", ["v"], target_exists=False) is None
    later = frame((date(2024, 1, 1), 1, "z"), (date(2024, 1, 2), 2, "d"))
    assert upsert.append_absent_months(spark, path, later, ["day", "k"], "day", ["v"]) == [202401]
    assert [r[2] for r in rows(upsert.read_months(spark, path))] == ["a", "d", "c"]


def test_rewrite_compact_and_sorted_copies(spark, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS rewriting")
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "k int, v int")
    df.write.parquet(f"{path}/t")
    spark.sql("DROP TABLE IF EXISTS rewriting.t")
    spark.catalog.createTable("rewriting.t", path=f"{path}/t", source="parquet")
    sinks.rewrite_table(spark, "rewriting.t", dedup.last_version(spark.table("rewriting.t"), ["k"], ["v"]))
    assert rows(spark.table("rewriting.t")) == sorted([(k, 90 + k) for k in range(10)], key=str)
    sinks.compact(df, ["k"], ["v"], f"{path}/c")
    assert spark.read.parquet(f"{path}/c").count() == 10
    sinks.ctas_sorted(df, ["k", "v"], f"{path}/s")
    sinks.ctas_sorted(df.limit(50), ["k", "v"], f"{path}/s")
    assert spark.read.parquet(f"{path}/s").count() == 50


def test_bucketed_tables_join_without_a_shuffle(spark, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketing")
    df = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    for name in ("a", "b"):
        sinks.bucketed_table(df, f"bucketing.{name}", ["k"], 4, f"{path}/{name}")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketing.a").join(spark.table("bucketing.b"), "k").groupBy("k").count()
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# --- SCD2 ---------------------------------------------------------------------------------------

DIM = "key int, name string, note string"
DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]
SNAPSHOTS = [
    [(1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "d", "x")],
    [(1, "a2", "y"), (2, "b", "y"), (3, "c", "y"), (5, "e", "y")],  # 4 vanished
    [(1, "a", "z"), (2, None, "z"), (3, None, "z"), (4, "d", "z"), (5, "e", "z")],  # 1 reverted
]


def brute_history(snapshots):
    versions = []
    for taken, snap in zip(DAYS, snapshots):
        for key, name, note in snap:
            current = next((v for v in versions if v["key"] == key and v["to"] is None), None)
            if current and current["name"] == name:
                continue
            if current:
                current["to"] = taken
            versions.append({"key": key, "name": name, "note": note, "from": taken, "to": None})
    return sorted(
        [(v["key"], v["name"], v["note"], v["from"], v["to"]) for v in versions],
        key=lambda r: [(v is None, str(v)) for v in r],
    )


def history(df):
    return rows(df.select("key", "name", "note", F.col("valid_from").cast("string"), F.col("valid_to").cast("string")))


def test_snapshots_new_changed_vanished_reverted_null(spark, path):
    versions = None
    for i, (taken, snap) in enumerate(zip(DAYS, SNAPSHOTS)):
        staged = spark.createDataFrame(snap, DIM)
        versions = scd2.snapshot(versions, staged, "key", ["name"], taken)
        scd2.store_snapshot(spark, path, staged, "key", ["name"], taken, first=i == 0)
    want = brute_history(SNAPSHOTS)
    assert history(versions) == want
    assert history(scd2.read_snapshot(spark, path)) == want
    assert scd2.read_snapshot(spark, path, current_only=True).count() == 5
    again = spark.createDataFrame(SNAPSHOTS[-1], DIM)
    scd2.store_snapshot(spark, path, again, "key", ["name"], DAYS[3])
    assert history(scd2.read_snapshot(spark, path)) == want


def test_two_snapshots_on_one_day_keep_both_closings(spark, path):
    frame = lambda *r: spark.createDataFrame(list(r), DIM)
    scd2.store_snapshot(spark, path, frame((1, "a", ""), (2, "b", "")), "key", ["name"], DAYS[0], first=True)
    scd2.store_snapshot(spark, path, frame((1, "a1", "")), "key", ["name"], "2024-01-02 08:00:00")
    scd2.store_snapshot(spark, path, frame((2, "b1", "")), "key", ["name"], "2024-01-02 20:00:00")
    got = history(scd2.read_snapshot(spark, path))
    assert [(r[0], r[1], r[4] is None) for r in got] == [(1, "a", False), (1, "a1", True), (2, "b", False), (2, "b1", True)]


def test_conflicting_staged_rows(spark):
    staged = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", "x"), (2, "c", "y")], DIM)
    with pytest.raises(PySparkException, match="conflicting staged rows for key 1"):
        scd2.one_per_key(staged, "key", ["name"]).collect()
    assert rows(scd2.one_per_key(staged, "key", ["name"], "latest")) == [(1, "b", "x"), (2, "c", "y")]
    assert rows(scd2.one_per_key(staged.where("key = 2"), "key", ["name"])) == [(2, "c", "y")]


# --- quality and masking ------------------------------------------------------------------------


def test_currency_is_three_bytes(spark):
    df = spark.createDataFrame([(1, "USD"), (2, "EURO"), (3, "éuro"[:3]), (4, ""), (5, None)], "TickerKey int, Currency string")
    assert [r[0] for r in rows(df.where(Q.currency_malformed()))] == [2, 3, 4, 5]
    assert [r[0] for r in rows(df.where(Q.ticker_null()))] == [5]


FACT = "CompanyKey int, TickerKey int, TradingDate date, OpenPrice double, ClosePrice double, HighPrice double, LowPrice double, MarketCap double, Dividend double"


def test_fact_checks_and_summary(spark):
    good = (1, 1, date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    bad = [
        (None, 1, date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (1, 1, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        (1, 1, date(2025, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0, 0.0),
        (1, 1, date(2024, 1, 1), 1.0, -1.0, None, 1.0, 1.0, 1.0),
    ]
    fact = spark.createDataFrame([good, *bad], FACT)
    tests = {"fact_not_null": Q.fact_null(), "future_date": Q.in_future("2025-01-01"), "nonpositive": Q.nonpositive()}
    assert {n: fact.where(c).count() for n, c in tests.items()} == {"fact_not_null": 2, "future_date": 1, "nonpositive": 2}
    assert rows(Q.summary([(fact, tests)])) == [("fact_not_null", 2), ("future_date", 1), ("nonpositive", 2)]


def test_orphans_and_duplicates(spark):
    fact = spark.createDataFrame([(1, 5), (1, 5), (2, 6), (None, 5)], "a int, b int")
    dims = {"a": spark.createDataFrame([(2,)], "a int"), "b": spark.createDataFrame([(5,), (6,)], "b int")}
    assert rows(Q.orphans(fact, dims)) == [("a", 1, 2)]
    assert rows(Q.orphan_rows(fact, "a", dims["a"])) == [(1, 5), (1, 5)]
    assert rows(Q.duplicates(fact, ["b"])) == [(5, 3)]


def test_masks(spark):
    names = spark.createDataFrame([("Foxtrot",), ("Al",), ("",), (None,)], "n string")
    assert [r[0] for r in rows(names.select(M.mask_prefix(F.col("n"))))] == ["***", "Al***", "Fox***", None]
    ranks = spark.createDataFrame([(0,), (99,), (100,), (1999,)], "r bigint")
    assert {r[0] for r in ranks.select(M.mask_range(F.col("r"))).collect()} == {"0–99", "100–199", "1900–1999"}


def test_no_rare_group_stays_visible(spark):
    df = spark.createDataFrame([(c,) for c in "a" * 12 + "b" * 9 + "c" * 10 + "d"], "c string")
    masked = masking.mask_rare(df, "c", "m")
    visible = {r.m: r["count"] for r in masked.groupBy("m").count().collect()}
    assert visible == {"a": 12, "c": 10, "Other": 10}


# --- what is moved ------------------------------------------------------------------------------


def _quotes(spark):
    """Two quotes of one company, one of a ticker that no company has."""
    data = [("A", "X", date(2024, 5, 2), 1.5), ("A", None, date(2024, 5, 3), None), ("B", "X", date(2024, 5, 2), 2.0)]
    stocks = spark.createDataFrame(data, "ticker_symbol string, exchange string, trading_day date, open_price double")
    price = F.col("open_price")
    names = ("close_price", "high_price", "low_price", "market_cap", "dividend")
    companies = spark.createDataFrame(
        [("A Inc", "US", "A", 1, "Bank", 1.0, 1.0, 1.0, 1.0)],
        "company string, headquarters string, ticker string, rank int, industry string, sales_in_millions double, "
        "profit_in_millions double, assets_in_millions double, market_value_in_millions double",
    )
    return stocks.withColumns({n: price for n in names} | {"currency": F.lit("USD"), "sector": F.lit("s")}), companies


def test_fact_keys_are_computed_after_the_join(spark):
    stocks, companies = _quotes(spark)
    for fact in (silver.fact_stock(stocks, companies, "md5"), classic.star(companies, stocks, "md5")["FactStock"]):
        plan = fact._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join") :]
        assert "TickerKey" in plan and "DateKey" in plan and "TickerKey" not in below and "DateKey" not in below
        assert [r[0] for r in rows(fact.select("DateKey", "OpenPrice"))] == [20240502, 20240503]
