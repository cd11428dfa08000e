from decimal import Decimal

from pyspark.sql import functions as F

from tickwell.operators.sample import quote_asof
from tickwell.operators.trends import latest_price, market_rollup, market_summary, price_series, price_trend, tick_volume
from tickwell.sources.events import ticks_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan(df):
    return next(line for line in plan(df).split("\n") if "FileScan" in line)


def test_scans_read_what_is_asked(spark, sf_dir):
    ticks = ticks_of(spark.read.parquet(f"{sf_dir}/events.parquet"))
    series = scan(price_series(ticks, ["click"], "2024-01-05", "2024-01-06"))
    for pushed in ("EqualTo(event_type,click)", "GreaterThanOrEqual(ts,2024-01-05", "LessThan(ts,2024-01-06"):
        assert pushed in series, series
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in series
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in scan(tick_volume(ticks))
    assert "LessThanOrEqual(ts,2024-01-15" in scan(quote_asof(ticks, "2024-01-15"))


def test_trends_combine_before_one_shuffle(spark, sf_dir):
    ticks = ticks_of(spark.read.parquet(f"{sf_dir}/events.parquet"))
    for df in (price_trend(ticks), tick_volume(ticks)):
        assert plan(df).count("Exchange") == 1 and "partial_" in plan(df)
    last = [latest_price(ticks, "event_id"), quote_asof(ticks, "2024-01-15", "event_id"), price_trend(ticks, tie="event_id")]
    for df in (price_trend(ticks), *last):
        assert "SortAggregate" not in plan(df) and plan(df).count("HashAggregate") == 2


def test_ties_are_settled_by_the_larger_id(spark):
    rows = [("A", 1.0, 5, 0), ("A", 2.0, 5, -3), ("A", 3.0, 5, 2**62), ("A", 4.0, 4, 9), ("B", 5.0, -(2**50), -(2**63)), ("B", 6.0, -(2**50), 2**63 - 1)]
    df = spark.createDataFrame(rows, "symbol STRING, price DOUBLE, t BIGINT, id BIGINT")
    ticks = df.withColumn("timestamp", F.timestamp_micros("t").cast("timestamp_ntz"))
    assert {r.symbol: r.price for r in latest_price(ticks, "id").collect()} == {"A": 3.0, "B": 6.0}
    named = ticks.withColumn("id", F.lpad((F.col("id").cast("decimal(20,0)") + F.lit(Decimal(2**63))).cast("string"), 20, "0"))
    assert {r.symbol: r.price for r in latest_price(named, "id").collect()} == {"A": 3.0, "B": 6.0}


def test_not_a_number_prices(spark):
    df = spark.sql(
        "SELECT 'A' AS symbol, 'N' AS market, CAST(p AS DOUBLE) AS price, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, i) AS timestamp "
        "FROM VALUES (1, '2'), (2, 'NaN'), (3, '4') AS t(i, p)"
    )
    row = price_trend(df).first()
    assert (row.open, row.close, row.low, row.n_ticks) == (2.0, 4.0, 2.0, 3)
    assert row.high != row.high and row.avg_price != row.avg_price


def test_null_prices_count_as_ticks_only(spark):
    df = spark.range(4).select(
        F.lit("A").alias("symbol"), F.lit("N").alias("market"), F.when(F.col("id") < 3, F.col("id").cast("double")).alias("price")
    )
    row = market_summary(df).first()
    assert (row.n_ticks, row.avg_price, row.n_symbols) == (4, 1.0, 1)
    assert market_rollup(df).count() == 3
