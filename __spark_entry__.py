"""Registered queries over the given tables, and the SQL each must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.functions.clock import moment
from tickwell.functions.codec import decode_ticks, encode_legacy_tick, epoch_millis
from tickwell.functions.numbers import float_of
from tickwell.operators import asof, partials, recurrence, sample, sessions, sketches, trends
from tickwell.operators.keys import already_stored, first_by_key, not_stored, repeats_by_key, stamp_arrivals
from tickwell.operators.validate import accepted, check_lengths, judge, reject_report
from tickwell.plans import sql
from tickwell.plans.ingest import ingest
from tickwell.sources import buckets, filters
from tickwell.sources.events import LEGACY_KINDS, clean_payload, legacy_payload, mixed_payload, records_of, ticks_of
from tickwell.sources.scratch import kept, shared_folder
from tickwell.sources.table import append_prices, compact_history, create_price_table, drop_merged, read_history, read_rejects, write_history
from tickwell.sources.topic import append_topic, follow_topic, read_topic, scan_topic
from tickwell.streaming import live
from tickwell.streaming.ingest import run_id_of, start_ingest
from tickwell.streaming.poll import start_poller
from tickwell.streaming.rollup import trend_stream, unique_stream
from tickwell.streaming.sessions import keyed_state, session_stream, stale_stream

try:  # the corpus operators are an extra; all else works without them
    import corpus_pipeline
    from tickwell.llm import queries as corpus
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "tickwell.llm"):
        raise
    corpus = None

ASOF = "2024-01-15 12:00:00"
HOUR = 3600


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(_events(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", mixed_payload().alias("value"))


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Enough digits to tell results apart, few enough to hide the order in which floats were added."""
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- messages -------------------------------------------------------------


def encode_ticks(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", clean_payload().alias("value"))


def decode(spark, sf_dir):
    return decode_ticks(_mixed(spark, sf_dir)).drop("value")


def valid_ticks(spark, sf_dir):
    return accepted(judge(_mixed(spark, sf_dir))).drop("value")


def rejects_by_reason(spark, sf_dir):
    return reject_report(judge(_mixed(spark, sf_dir)))


def price_coercion(spark, sf_dir):
    events = _events(spark, sf_dir)
    kinds = [F.lit(" 12.5 "), F.lit("abc"), F.lit("1e3"), F.lit(""), F.col("value").cast("string"), F.lit(".5")]
    text = F.get(F.array(*kinds), F.pmod(F.col("event_id"), F.lit(len(kinds))).cast("int"))
    return events.select("event_id", float_of(text).alias("price"))


def default_company(spark, sf_dir):
    return accepted(judge(_mixed(spark, sf_dir))).select("event_id", "symbol", "company")


def default_market(spark, sf_dir):
    return accepted(judge(_mixed(spark, sf_dir))).select("event_id", "market")


def length_check(spark, sf_dir):
    padded = F.concat(
        F.col("event_type"),
        F.expr("repeat('x', int(pmod(event_id, 8)))"),
        F.expr("repeat(' ', int(pmod(event_id, 5)))"),
    )
    named = _events(spark, sf_dir).select(
        "event_id", padded.alias("symbol"), F.lit(None).cast("string").alias("reason")
    )
    return check_lengths(named, {"symbol": 10})


def legacy_encode(spark, sf_dir):
    value = encode_legacy_tick(F.col("value"), F.col("event_type"), F.col("ts"))
    return _events(spark, sf_dir).select("event_id", value.alias("value"))


def epoch_millis_of_events(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", epoch_millis(F.col("ts")).alias("millis"))


def legacy_upgrade(spark, sf_dir):
    """Legacy and current messages, good and bad: what each is read as, or why it is not."""
    messages = _events(spark, sf_dir).select("event_id", legacy_payload(F.col("ts")).alias("value"))
    judged = judge(messages, legacy=True)
    read = ["symbol", "price", "company", "market", "event_time"]
    return judged.select("event_id", *[F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in read], "reason")


def legacy_ingest(spark, sf_dir):
    """Legacy and current messages in one topic, kept under their producer's time or, without one, the record's."""
    records = records_of(_events(spark, sf_dir), legacy_payload(F.date_trunc("minute", "ts")))
    settled = ingest(records, "event_time", legacy=True)
    good = settled.prices.select("partition", "offset", "symbol", "timestamp", F.lit(None).cast("string").alias("reason"))
    bad = settled.rejects.select(
        "partition",
        "offset",
        F.lit(None).cast("string").alias("symbol"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        "reason",
    )
    return good.unionByName(bad)


# --- topic, keys, ingestion -----------------------------------------------


def topic_offsets(spark, sf_dir):
    return records_of(_events(spark, sf_dir), clean_payload()).select("event_id", "partition", "offset")


def topic_scan(spark, sf_dir):
    """A topic of two, written and read from its start."""
    folder = shared_folder(spark, "topic")
    records = records_of(_events(spark, sf_dir), clean_payload())
    append_topic(records, folder)
    append_topic(records.withColumn("topic", F.lit("other")), folder)
    scanned = scan_topic(read_topic(spark, folder))
    return scanned.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def topic_resume(spark, sf_dir):
    """The topic from the offsets a consumer had reached: here none of partition 0, and some of two others."""
    records = records_of(_events(spark, sf_dir), clean_payload())
    return scan_topic(records, starting={1: 100, 3: 50}).select("event_id", "partition", "offset")


def topic_round_trip(spark, sf_dir):
    folder = shared_folder(spark, "topic")
    append_topic(records_of(_events(spark, sf_dir), mixed_payload()), folder)
    return accepted(judge(read_topic(spark, folder))).select("partition", "offset", "symbol", "price", "company", "market")


def _by_hour(spark, sf_dir):
    return _ticks(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))


def pk_dedupe(spark, sf_dir):
    return first_by_key(_by_hour(spark, sf_dir), order=["event_id"])


def pk_repeats(spark, sf_dir):
    return repeats_by_key(_by_hour(spark, sf_dir), order=["event_id"])


def _split_by_month_half(spark, sf_dir):
    """Stored history: the first writer of each hour so far. A batch: all ticks, which it then meets again."""
    ticks = _by_hour(spark, sf_dir)
    history = first_by_key(ticks.filter(F.col("timestamp") < moment(ASOF)), order=["event_id"])
    return first_by_key(ticks, order=["event_id"]), history


def history_new(spark, sf_dir):
    return not_stored(*_split_by_month_half(spark, sf_dir))


def history_filtered(spark, sf_dir):
    """``history_new`` by key filters, which two batches of the history filled."""
    batch, history = _split_by_month_half(spark, sf_dir)
    folder = shared_folder(spark, "filters")
    for n in range(2):
        filters.add_keys(history.filter(F.col("event_id") % 2 == n), folder, "run", n)
    return filters.not_stored_by_filter(batch, folder, lambda days: history.filter(F.to_date("timestamp").isin(days)))


def history_bucketed(spark, sf_dir):
    """``history_new`` by bucketed keys, which two batches of the history filled."""
    batch, history = _split_by_month_half(spark, sf_dir)
    folder = shared_folder(spark, "keys")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    buckets.create_keys(spark, name, folder, buckets=16)
    for n in range(2):
        buckets.append_bucketed(history.filter(F.col("event_id") % 2 == n), name, "run", n)
    return buckets.not_stored_by_bucket(batch, name)


def history_known(spark, sf_dir):
    return already_stored(*_split_by_month_half(spark, sf_dir))


def stamp_unique(spark, sf_dir):
    """Each day's events as one batch that arrives at midnight."""
    ticks = _ticks(spark, sf_dir)
    day = F.date_trunc("day", "timestamp")
    return stamp_arrivals(ticks, day, within=["symbol", "_clock"], order=["event_id"])


def _by_minute(spark, sf_dir):
    records = records_of(_events(spark, sf_dir), mixed_payload())
    return records.withColumn("timestamp", F.date_trunc("minute", "timestamp"))


def ingest_table(spark, sf_dir):
    return ingest(_by_minute(spark, sf_dir), "timestamp").prices


def ingest_rejects(spark, sf_dir):
    rejects = ingest(_by_minute(spark, sf_dir), "timestamp").rejects
    return rejects.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"), "reason")


def history_replay(spark, sf_dir):
    """Batches of the history, all written a second time, as after a failure."""
    folder = _history_in_batches(spark, _settled(spark, sf_dir))
    return read_history(spark, folder).drop("date", "run_id", "batch_id")


def history_compact(spark, sf_dir):
    """The history merged once, a merged batch replayed, folders dropped, a late batch merged as well."""
    prices = _settled(spark, sf_dir)
    folder = _history_in_batches(spark, prices, BATCHES - 1)
    compact_history(spark, folder, ALL_DAYS)
    _write_batches(prices, folder, [1])
    drop_merged(spark, folder)
    _write_batches(prices, folder, [1, BATCHES - 1])
    compact_history(spark, folder, ALL_DAYS)
    return read_history(spark, folder).drop("date", "run_id", "batch_id")


BATCHES = 4
ALL_DAYS = date(2100, 1, 1)


def _settled(spark, sf_dir):
    """All prices, parsed and settled once, however many batches are written of them."""
    return kept(ingest(_by_minute(spark, sf_dir), "timestamp").prices)


def _history_in_batches(spark, prices, batches=BATCHES):
    folder = shared_folder(spark, "history")
    _write_batches(prices, folder, [*range(batches), 0])
    return folder


def _write_batches(prices, folder, numbers):
    for n in numbers:
        write_history(prices.filter(F.col("offset") % BATCHES == n), folder, "run", n)


def append_keyed(spark, sf_dir):
    """All ticks appended twice to a catalog table that takes each key once, and what it did not take."""
    name = f"prices_{uuid.uuid4().hex}"
    create_price_table(spark, name)
    ticks = _by_hour(spark, sf_dir).withColumns({"company": F.col("symbol"), "market": F.lit("NASDAQ")})
    ticks = ticks.withColumn("symbol", F.when(F.col("event_id") % 50 > 0, F.col("symbol")))
    left = [append_prices(ticks, name).select("event_id", "reason").withColumn("turn", F.lit(n)) for n in (1, 2)]
    stored = spark.table(name).select("symbol", "price", "timestamp", F.lit(0).alias("turn"), F.lit("stored").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    counts = left[0].unionByName(left[1]).groupBy("turn", "reason").agg(F.count(F.lit(1)).alias("n"))
    return stored.unionByName(counts, allowMissingColumns=True)


# --- sampling -------------------------------------------------------------


def quote_asof(spark, sf_dir):
    return sample.quote_asof(_ticks(spark, sf_dir), ASOF, tie="event_id")


def poll_sample(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    start, points = sample.whole_grid(ticks, HOUR)
    return sample.poll_sample(ticks, start, points, HOUR, tie="event_id")


def poll_sample_bounded(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    start, _ = sample.whole_grid(ticks, HOUR)
    return sample.poll_sample_bounded(ticks, start, seconds=HOUR, tie="event_id")


def asof_join(spark, sf_dir):
    """Every event asks for a price: at its own instant, an hour before it or on the hour, some for no known symbol or for none."""
    asked = F.when(F.col("event_id") % 50 == 0, "unknown").when(F.col("event_id") % 50 > 1, F.col("symbol"))
    moments = F.when(F.col("event_id") % 3 == 0, F.col("timestamp")).when(F.col("event_id") % 3 == 1, F.col("timestamp") - F.expr("INTERVAL 1 HOUR"))
    on_the_hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    ticks = _ticks(spark, sf_dir)
    probes = ticks.select("event_id", asked.alias("symbol"), F.coalesce(moments, on_the_hour).alias("moment"))
    return asof.asof_join(probes, ticks, tie="event_id")


# --- trends ---------------------------------------------------------------


def price_series(spark, sf_dir):
    return trends.price_series(_ticks(spark, sf_dir))


def price_trend(spark, sf_dir):
    return _rounded(trends.price_trend(_ticks(spark, sf_dir), tie="event_id"), "avg_price", digits=9)


def tick_volume(spark, sf_dir):
    return trends.tick_volume(_ticks(spark, sf_dir))


def latest_price(spark, sf_dir):
    return trends.latest_price(_ticks(spark, sf_dir), tie="event_id")


def price_momentum(spark, sf_dir):
    return _rounded(trends.price_momentum(_ticks(spark, sf_dir), tie="event_id"), "moving_avg", "change")


def price_ewma(spark, sf_dir):
    return _rounded(recurrence.price_ewma(_ticks(spark, sf_dir), 0.1, tie="event_id"), "ewma")


def price_drawdown(spark, sf_dir):
    return _rounded(recurrence.price_drawdown(_ticks(spark, sf_dir), tie="event_id"), "drawdown", digits=9)


SOME_DAYS = "2024-01-06", "2024-01-20"
RANKS = [0.05, 0.5, 0.95]


def _sketched(spark, ticks):
    """Sketches of all days, made of three batches, one of them replayed."""
    folder = shared_folder(spark, "sketches")
    for batch, n in enumerate((2, 0, 0, 1)):
        sketches.fold_sketches(ticks.filter(F.col("event_id") % 3 == n), folder, "run", (0, 1, 1, 2)[batch])
    return folder


def _some_days(ticks):
    return ticks.filter(F.to_date("timestamp").between(*[F.lit(d).cast("date") for d in SOME_DAYS]))


def daily_quantiles(spark, sf_dir):
    """Exact quantiles over some days, and whether the merged sketches of these days agree within their error."""
    ticks = _ticks(spark, sf_dir)
    estimates = sketches.quantiles_between(spark, _sketched(spark, ticks), *SOME_DAYS, RANKS)
    judged = sketches.rank_errors(estimates, _some_days(ticks)).select("symbol", "rank", "n_priced", (F.col("error") <= sketches.QUANTILE_ERROR).alias("agrees"))
    return sketches.exact_quantiles(_some_days(ticks), RANKS).drop("n_priced").join(judged, ["symbol", "rank"], "full")


def daily_symbols(spark, sf_dir):
    """Users as symbols: how many there are over some days, exactly, and whether the merged sketches agree within their error."""
    users = _events(spark, sf_dir).select(F.concat(F.lit("U"), "user_id").alias("symbol"), F.col("ts").alias("timestamp"), F.col("value").alias("price"), "event_id")
    estimate = sketches.symbols_between(spark, _sketched(spark, users), *SOME_DAYS).scalar()
    exact = _some_days(users).agg(F.countDistinct("symbol").alias("n_symbols"))
    return exact.withColumn("agrees", F.abs(estimate - F.col("n_symbols")) <= sketches.DISTINCT_ERROR * F.col("n_symbols"))


def _with_market(spark, sf_dir):
    events = _events(spark, sf_dir)
    market = F.when(F.col("user_id") % 2 == 0, "NASDAQ").otherwise("NYSE")
    return events.select(
        F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("timestamp"), market.alias("market")
    )


def market_summary(spark, sf_dir):
    return _rounded(trends.market_summary(_with_market(spark, sf_dir)), "avg_price")


def market_rollup(spark, sf_dir):
    return _rounded(trends.market_rollup(_with_market(spark, sf_dir)), "avg_price")


def param_query(spark, sf_dir):
    sql.register(_ticks(spark, sf_dir), "stock_prices")
    return sql.query(
        spark,
        "SELECT event_id, symbol, timestamp, price FROM IDENTIFIER(:prices) "
        "WHERE symbol = :symbol AND timestamp >= CAST(:since AS TIMESTAMP_NTZ) AND timestamp < CAST(:until AS TIMESTAMP_NTZ)",
        prices="stock_prices",
        symbol="click",
        since="2024-01-05",
        until=ASOF,
    )


# --- the same, as streams -------------------------------------------------


def _stored_topic(spark, sf_dir):
    folder = shared_folder(spark, "job")
    append_topic(_by_minute(spark, sf_dir), f"{folder}/topic")
    return folder


def _run_ingest(spark, sf_dir, clock):
    folder = _stored_topic(spark, sf_dir)
    start_ingest(
        follow_topic(spark, f"{folder}/topic"), f"{folder}/history", f"{folder}/rejects", f"{folder}/progress", clock
    ).awaitTermination()
    return folder


def stream_ingest(spark, sf_dir):
    """Arrival stamps differ from run to run; that they tell a symbol's prices apart does not."""
    folder = _run_ingest(spark, sf_dir, None)
    # A file holds millions of rows, a task's share of distinct keys should not.
    prices = read_history(spark, f"{folder}/history").hint("rebalance")
    return prices.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.countDistinct("timestamp").alias("n_stamps"),
        F.round(F.sum("price"), 4).alias("sum_price"),
        F.countDistinct("partition", "offset").alias("n_messages"),
    )


def stream_ingest_keyed(spark, sf_dir):
    folder = _run_ingest(spark, sf_dir, "timestamp")
    return read_history(spark, f"{folder}/history").drop("date", "run_id", "batch_id")


def stream_rejects(spark, sf_dir):
    folder = _run_ingest(spark, sf_dir, "timestamp")
    rejects = read_rejects(spark, f"{folder}/rejects").drop("run_id", "batch_id")
    return rejects.withColumn("value", F.col("value").cast("string"))


def stream_trend(spark, sf_dir):
    """The trend of every hour that has closed by the last tick and the time allowed for late ones."""
    folder = shared_folder(spark, "trend")
    schema = _events(spark, sf_dir).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    query = (
        trend_stream(ticks_of(events), tie="event_id")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .option("path", f"{folder}/trend")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _rounded(spark.read.parquet(f"{folder}/trend"), "avg_price", digits=9)


def stream_unique(spark, sf_dir):
    """Which of an hour's ticks is kept follows arrival; that there is one each does not."""
    folder = shared_folder(spark, "unique")
    schema = _events(spark, sf_dir).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    hourly = ticks_of(events).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    query = (
        unique_stream(hourly, "60 days")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/progress")
        .option("path", f"{folder}/ticks")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/ticks").select("symbol", "timestamp")


def stream_poll(spark, sf_dir):
    """One emission of every symbol's last price to a topic, read back."""
    folder = shared_folder(spark, "poll")
    schema = _events(spark, sf_dir).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    start_poller(ticks_of(events), f"{folder}/topic", f"{folder}/progress", seconds=None, tie="event_id").awaitTermination()
    return accepted(judge(read_topic(spark, f"{folder}/topic"))).select("symbol", "price", "company", "market")


def _in_batches(spark, sf_dir, folder, batch, batches):
    """The ticks as a stream of micro-batches: those whose ``batch`` is 0, then 1 and so on."""
    ticks = _ticks(spark, sf_dir)
    for n in batches:
        ticks.filter(batch == n).coalesce(1).write.mode("append").parquet(f"{folder}/ticks")
    return spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/ticks")


def _closed(spark, closing, folder):
    """What a stream with keyed state has emitted when all its ticks are read."""
    with keyed_state(spark):
        writer = closing.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress")
        query = writer.option("path", f"{folder}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def _third_of_month():
    """Three micro-batches that follow each other in time."""
    return F.floor((F.dayofmonth("timestamp") - 1) / 11)


def stream_stale(spark, sf_dir):
    """Every silence of a quarter of an hour, also the last one of a symbol, once the watermark has passed it."""
    folder = shared_folder(spark, "stale")
    ticks = _in_batches(spark, sf_dir, folder, _third_of_month(), range(3))
    return _closed(spark, stale_stream(ticks, 15), folder)


def stream_sessions(spark, sf_dir):
    """Sessions that no tick may extend any more."""
    folder = shared_folder(spark, "sessions")
    ticks = _in_batches(spark, sf_dir, folder, _third_of_month(), range(3))
    return _rounded(_closed(spark, session_stream(ticks, 900, tie="event_id"), folder), "avg_price", digits=9)


def session_trend(spark, sf_dir):
    return _rounded(sessions.session_trend(_ticks(spark, sf_dir), 900, tie="event_id"), "avg_price", digits=9)


def sliding_trend(spark, sf_dir):
    return _rounded(partials.sliding_trend(_ticks(spark, sf_dir), "6 hours", "1 hour", tie="event_id"), "avg_price", digits=9)


def _mixed_up():
    """Three micro-batches: seven of ten ticks, two of ten, one of ten, each over the whole time."""
    return F.when(F.col("event_id") % 10 < 7, 0).when(F.col("event_id") % 10 < 9, 1).otherwise(2)


def _live(spark, sf_dir, batches, late=None):
    folder = shared_folder(spark, "live")
    ticks = _in_batches(spark, sf_dir, folder, _mixed_up(), batches)
    live.start_live(ticks, folder, f"{folder}/progress", late=late, tie="event_id").awaitTermination()
    # As after a failure: the last batch comes again.
    again = _ticks(spark, sf_dir).filter(_mixed_up() == batches[-1])
    live.fold_batch(again, folder, run_id_of(spark, f"{folder}/progress"), len(batches) - 1, late=late, tie="event_id")
    return folder


def stream_late(spark, sf_dir):
    """Trend of the ticks on time, and each late tick with the bucket that had closed without it."""
    folder = _live(spark, sf_dir, [0, 1, 2], "10 minutes")
    trend = _rounded(live.live_trend(spark, folder), "avg_price", digits=9).withColumn("event_id", F.lit(None).cast("bigint"))
    late = live.late_ticks(spark, folder).select("symbol", "bucket", "event_id", F.col("price").alias("open"), F.lit(1).cast("bigint").alias("n_ticks"))
    return trend.unionByName(late, allowMissingColumns=True)


def live_trend(spark, sf_dir):
    return _rounded(live.live_trend(spark, _live(spark, sf_dir, [2, 0, 1])), "avg_price", digits=9)


def live_latest(spark, sf_dir):
    return live.live_latest(spark, _live(spark, sf_dir, [1, 2, 0]))


# --- contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return price_trend(spark, "/root/testdata/sf0.001")


def _corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _corpus_queries() | {
        "encode_ticks": encode_ticks,
        "decode_ticks": decode,
        "valid_ticks": valid_ticks,
        "reject_report": rejects_by_reason,
        "price_coercion": price_coercion,
        "default_company": default_company,
        "default_market": default_market,
        "length_check": length_check,
        "legacy_encode": legacy_encode,
        "epoch_millis": epoch_millis_of_events,
        "legacy_upgrade": legacy_upgrade,
        "legacy_ingest": legacy_ingest,
        "topic_offsets": topic_offsets,
        "topic_scan": topic_scan,
        "topic_resume": topic_resume,
        "topic_round_trip": topic_round_trip,
        "pk_dedupe": pk_dedupe,
        "pk_repeats": pk_repeats,
        "history_new": history_new,
        "history_filtered": history_filtered,
        "history_bucketed": history_bucketed,
        "history_known": history_known,
        "stamp_unique": stamp_unique,
        "ingest_table": ingest_table,
        "ingest_rejects": ingest_rejects,
        "history_replay": history_replay,
        "history_compact": history_compact,
        "append_keyed": append_keyed,
        "quote_asof": quote_asof,
        "poll_sample": poll_sample,
        "poll_sample_bounded": poll_sample_bounded,
        "asof_join": asof_join,
        "price_ewma": price_ewma,
        "price_drawdown": price_drawdown,
        "daily_quantiles": daily_quantiles,
        "daily_symbols": daily_symbols,
        "price_series": price_series,
        "price_trend": price_trend,
        "tick_volume": tick_volume,
        "latest_price": latest_price,
        "price_momentum": price_momentum,
        "market_summary": market_summary,
        "market_rollup": market_rollup,
        "param_query": param_query,
        "stream_ingest": stream_ingest,
        "stream_ingest_keyed": stream_ingest_keyed,
        "stream_rejects": stream_rejects,
        "stream_trend": stream_trend,
        "stream_unique": stream_unique,
        "stream_poll": stream_poll,
        "stream_stale": stream_stale,
        "stream_late": stream_late,
        "stream_sessions": stream_sessions,
        "session_trend": session_trend,
        "sliding_trend": sliding_trend,
        "live_trend": live_trend,
        "live_latest": live_latest,
    }


_MIXED = """
mixed AS (
  SELECT event_id, user_id, ts, event_type, value,
    CASE event_id % 20
      WHEN 0 THEN '{bad'
      WHEN 1 THEN '{"price":' || value || '}'
      WHEN 2 THEN '{"price":null,"symbol":"' || event_type || '"}'
      WHEN 3 THEN '{"price":"' || value || '","symbol":"' || event_type || '","company":"' || event_type || ' Inc","market":"NASDAQ"}'
      WHEN 4 THEN '{"price":"abc","symbol":"' || event_type || '"}'
      WHEN 5 THEN '{"price":' || value || ',"symbol":"' || event_type || '","company":null,"market":"NYSE"}'
      WHEN 6 THEN '[1]'
      WHEN 7 THEN '{"price":true,"symbol":"' || event_type || '"}'
      WHEN 8 THEN '{"symbol":"' || event_type || '"}'
      WHEN 9 THEN '{"price":' || value || ',"symbol":null}'
      WHEN 10 THEN '{"price":' || value || ',"symbol":{"a":"' || event_type || '"}}'
      WHEN 11 THEN '{"price":' || value || ',"symbol":"' || event_type || '-too-long"}'
      WHEN 12 THEN '{"price":' || value || ',"symbol":"' || event_type || '","market":[1]}'
      ELSE '{"price":' || value || ',"symbol":"' || event_type || '","company":"' || event_type || '","market":"NASDAQ"}'
    END AS raw
  FROM events
),
docs AS (
  SELECT *, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN CAST(raw AS JSON) END AS doc FROM mixed
),
fields AS (
  SELECT *,
    doc->>'$.symbol' AS symbol,
    CASE WHEN json_type(doc, '$.price') = 'BOOLEAN' THEN CASE WHEN doc->>'$.price' = 'true' THEN 1.0 ELSE 0.0 END
         ELSE try_cast(doc->>'$.price' AS DOUBLE) END AS price,
    CASE WHEN json_exists(doc, '$.company') THEN doc->>'$.company' ELSE doc->>'$.symbol' END AS company,
    CASE WHEN doc IS NULL THEN NULL WHEN json_exists(doc, '$.market') THEN doc->>'$.market' ELSE 'UNKNOWN' END AS market
  FROM docs
),
decoded AS (
  SELECT *,
    CASE WHEN NOT json_valid(raw) THEN 'malformed'
         WHEN doc IS NULL THEN 'not_object'
         WHEN NOT json_exists(doc, '$.symbol') THEN 'missing_symbol'
         WHEN NOT json_exists(doc, '$.price') THEN 'missing_price'
         WHEN price IS NULL THEN 'bad_price'
         WHEN json_type(doc, '$.symbol') IN ('OBJECT', 'ARRAY') THEN 'bad_symbol'
         WHEN json_type(doc, '$.market') IN ('OBJECT', 'ARRAY') THEN 'bad_market'
         WHEN symbol IS NULL THEN 'null_symbol' END AS unread
  FROM fields
),
judged AS (SELECT *, coalesce(unread, CASE WHEN length(symbol) > 10 THEN 'too_long_symbol' END) AS reason FROM decoded)
"""

_RECORDS = """
placed AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS partition,
    row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
    date_trunc('minute', ts) AS minute
  FROM judged
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, minute ORDER BY partition, "offset") AS nth
  FROM placed WHERE reason IS NULL
)
"""

_INGESTED = f"""
WITH {_MIXED}, {_RECORDS}
SELECT symbol, price, minute AS timestamp, company, market, 'stockprice' AS topic, partition, "offset" FROM firsts WHERE nth = 1
"""

_REJECTED = f"""
WITH {_MIXED}, {_RECORDS}
SELECT 'stockprice' AS topic, partition, "offset", raw AS value, reason FROM placed WHERE reason IS NOT NULL
UNION ALL
SELECT 'stockprice' AS topic, partition, "offset", raw AS value, 'duplicate_key' AS reason FROM firsts WHERE nth > 1
"""

_GRID = """
WITH span AS (
  SELECT floor(epoch_us(min(ts)) / 3600000000)::BIGINT AS lo, ceil(epoch_us(max(ts)) / 3600000000)::BIGINT AS hi FROM events
),
symbols AS (SELECT DISTINCT event_type AS symbol FROM events),
grid AS (
  SELECT symbol, make_timestamp(unnest(generate_series(lo, hi)) * 3600000000) AS poll_ts, lo FROM symbols, span
),
ordered AS (
  SELECT event_type, ts, arg_max(value, event_id) AS value FROM events GROUP BY event_type, ts
)
SELECT g.symbol, g.poll_ts, o.value AS price
FROM grid g ASOF LEFT JOIN ordered o ON g.symbol = o.event_type AND g.poll_ts >= o.ts
"""

_BY_HOUR = """
hourly AS (
  SELECT event_id, event_type AS symbol, value AS price, date_trunc('hour', ts) AS timestamp FROM events
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY event_id) AS nth FROM hourly
)
"""

_TREND = """
  SELECT event_type AS symbol, date_trunc('hour', ts) AS bucket,
    arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, row(ts, event_id)) AS close, round(avg(value), 9) AS avg_price, count(*) AS n_ticks
  FROM events GROUP BY 1, 2
"""

#: Sessions of ticks with at most a quarter of an hour between them.
_SESSIONS = """
WITH ordered AS (
  SELECT event_type AS symbol, ts, event_id, value, ts > lag(ts) OVER w + INTERVAL 15 MINUTE AS breaks, max(ts) OVER () AS final
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
), numbered AS (
  SELECT *, count(*) FILTER (breaks) OVER (PARTITION BY symbol ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM ordered
), sessions AS (
  SELECT symbol, min(ts) AS start, max(ts) AS "end", arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    arg_max(value, row(ts, event_id)) AS close, round(avg(value), 9) AS avg_price, count(*) AS n_ticks, any_value(final) AS final
  FROM numbered GROUP BY symbol, session
)
"""

#: A stream has closed what the last tick less the time allowed for late ones has passed.
_CLOSED = """"end" + INTERVAL 15 MINUTE <= final - INTERVAL 10 MINUTE"""

_MARKET = """
WITH priced AS (
  SELECT event_type AS symbol, value AS price, CASE WHEN user_id % 2 = 0 THEN 'NASDAQ' ELSE 'NYSE' END AS market FROM events
)
"""

_V1_JSON = """
json_object('Price', value, 'Name', event_type, 'Timestamp', CAST(round_even(epoch_us(ts) / 1000.0, 0) AS BIGINT))
"""


def _legacy_sql(clock: str) -> str:
    """``legacy_payload`` stamped with ``clock``: what each kind of message is to be read as."""
    return f"""
kinds AS (
  SELECT *, event_id % {LEGACY_KINDS} AS kind,
    make_timestamp(CAST(round_even(epoch_us({clock}) / 1000.0, 0) AS BIGINT) * 1000) AS clock,
    CASE event_id % {LEGACY_KINDS} WHEN 3 THEN 'bad_timestamp' WHEN 4 THEN 'bad_timestamp' WHEN 5 THEN 'bad_symbol' WHEN 6 THEN 'null_symbol'
      WHEN 8 THEN 'missing_price' WHEN 9 THEN 'bad_price' WHEN 10 THEN 'too_long_symbol' WHEN 11 THEN 'not_object'
      WHEN 12 THEN 'missing_symbol' END AS reason
  FROM events
),
legacy AS (
  SELECT * EXCLUDE (event_type, value), CASE WHEN reason IS NULL THEN event_type END AS symbol,
    CASE WHEN reason IS NULL THEN CASE WHEN kind = 7 THEN 1.0 ELSE value END END AS price
  FROM kinds
)"""


def oracle_sql() -> dict[str, str]:
    return (corpus.oracle_sql() if corpus else {}) | {
        "asof_join": """
WITH probes AS (
  SELECT event_id, CASE event_id % 50 WHEN 0 THEN 'unknown' WHEN 1 THEN NULL ELSE event_type END AS symbol,
    CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 1 HOUR ELSE date_trunc('hour', ts) END AS moment
  FROM events
), ticks AS (SELECT event_type, ts, arg_max(value, event_id) AS value FROM events GROUP BY event_type, ts)
SELECT event_id, symbol, moment, value AS price, ts AS price_at FROM probes ASOF LEFT JOIN ticks ON symbol = event_type AND moment >= ts
""",
        "price_ewma": """
WITH RECURSIVE ordered AS (
  SELECT event_type AS symbol, ts AS timestamp, event_id, value AS price, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events
), steps AS (
  SELECT *, price AS ewma FROM ordered WHERE nth = 1
  UNION ALL
  SELECT o.*, 0.1::DOUBLE * o.price + 0.9::DOUBLE * s.ewma FROM steps s JOIN ordered o ON o.symbol = s.symbol AND o.nth = s.nth + 1
)
SELECT symbol, timestamp, event_id, price, round(ewma, 6) AS ewma FROM steps
""",
        "price_drawdown": """
SELECT symbol, price, timestamp, event_id, peak, round(price / peak - 1, 9) AS drawdown FROM (
  SELECT event_type AS symbol, value AS price, ts AS timestamp, event_id, max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS peak FROM events
)
""",
        "daily_quantiles": """
WITH ordered AS (
  SELECT event_type AS symbol, value AS price, row_number() OVER (PARTITION BY event_type ORDER BY value) AS nth, count(*) OVER (PARTITION BY event_type) AS n_priced
  FROM events WHERE ts::DATE BETWEEN '2024-01-06' AND '2024-01-20'
), ranks AS (SELECT unnest([0.05, 0.5, 0.95])::DOUBLE AS rank)
SELECT symbol, rank, price, n_priced, true AS agrees FROM ordered, ranks WHERE nth = greatest(ceil(rank * n_priced), 1)
""",
        "daily_symbols": "SELECT count(DISTINCT user_id) AS n_symbols, true AS agrees FROM events WHERE ts::DATE BETWEEN '2024-01-06' AND '2024-01-20'",
        "stream_stale": f"""{_SESSIONS} SELECT symbol, "end" AS since, "end" + INTERVAL 15 MINUTE AS stale_at FROM sessions WHERE {_CLOSED}""",
        "stream_sessions": f"{_SESSIONS} SELECT * EXCLUDE (final) FROM sessions WHERE {_CLOSED}",
        "session_trend": f"{_SESSIONS} SELECT * EXCLUDE (final) FROM sessions",
        "sliding_trend": """
WITH spread AS (SELECT *, date_trunc('hour', ts) - to_hours(unnest(range(6))) AS bucket FROM events)
SELECT event_type AS symbol, bucket, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, row(ts, event_id)) AS close, round(avg(value), 9) AS avg_price, count(*) AS n_ticks
FROM spread GROUP BY 1, 2
""",
        "stream_late": """
WITH dealt AS (
  SELECT *, date_trunc('hour', ts) AS bucket, CASE WHEN event_id % 10 < 7 THEN 0 WHEN event_id % 10 < 9 THEN 1 ELSE 2 END AS batch FROM events
), reached AS (SELECT batch, max(ts) - INTERVAL 10 MINUTE AS upto FROM dealt GROUP BY batch),
judged AS (
  SELECT *, coalesce(bucket + INTERVAL 1 HOUR <= (SELECT max(upto) FROM reached r WHERE r.batch < dealt.batch), false) AS late FROM dealt
)
SELECT event_type AS symbol, bucket, NULL::BIGINT AS event_id, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, row(ts, event_id)) AS close, round(avg(value), 9) AS avg_price, count(*) AS n_ticks
FROM judged WHERE NOT late GROUP BY 1, 2
UNION ALL SELECT event_type, bucket, event_id, value, NULL, NULL, NULL, NULL, 1 FROM judged WHERE late
""",
        "live_trend": _TREND,
        "live_latest": "SELECT event_type AS symbol, arg_max(value, row(ts, event_id)) AS price, max(ts) AS timestamp FROM events GROUP BY 1",
        "encode_ticks": """
SELECT event_id,
  CAST(json_object('price', value, 'symbol', event_type, 'company', event_type, 'market', 'NASDAQ') AS VARCHAR) AS value
FROM events
""",
        "decode_ticks": f"WITH {_MIXED} SELECT event_id, price, symbol, company, market, unread AS reason FROM judged",
        "valid_ticks": f"WITH {_MIXED} SELECT event_id, price, symbol, company, market FROM judged WHERE reason IS NULL",
        "reject_report": f"WITH {_MIXED} SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason",
        "price_coercion": """
SELECT event_id, CASE event_id % 6
  WHEN 0 THEN 12.5 WHEN 2 THEN 1000.0 WHEN 4 THEN value WHEN 5 THEN 0.5 END::DOUBLE AS price
FROM events
""",
        "default_company": f"WITH {_MIXED} SELECT event_id, symbol, company FROM judged WHERE reason IS NULL",
        "default_market": f"WITH {_MIXED} SELECT event_id, market FROM judged WHERE reason IS NULL",
        "length_check": """
WITH padded AS (
  SELECT event_id, event_type || repeat('x', event_id % 8) || repeat(' ', event_id % 5) AS symbol FROM events
)
SELECT event_id, CASE WHEN length(symbol) > 10 THEN substr(symbol, 1, 10) ELSE symbol END AS symbol,
  CASE WHEN length(rtrim(symbol, ' ')) > 10 THEN 'too_long_symbol' END AS reason
FROM padded
""",
        "legacy_encode": f"SELECT event_id, CAST({_V1_JSON} AS VARCHAR) AS value FROM events",
        "epoch_millis": "SELECT event_id, CAST(round_even(epoch_us(ts) / 1000.0, 0) AS BIGINT) AS millis FROM events",
        "legacy_upgrade": f"""
WITH {_legacy_sql("ts")}
SELECT event_id, symbol, price, symbol AS company,
  CASE WHEN reason IS NULL THEN CASE WHEN kind = 0 THEN 'NASDAQ' ELSE 'UNKNOWN' END END AS market,
  CASE WHEN reason IS NULL AND kind NOT IN (0, 2) THEN clock END AS event_time, reason
FROM legacy
""",
        "legacy_ingest": f"""
WITH {_legacy_sql("date_trunc('minute', ts)")},
placed AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS partition, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
    CASE WHEN kind IN (0, 2) THEN ts ELSE clock END AS time
  FROM legacy
),
firsts AS (SELECT *, row_number() OVER (PARTITION BY symbol, time ORDER BY partition, "offset") AS nth FROM placed WHERE reason IS NULL)
SELECT partition, "offset", CASE WHEN nth = 1 THEN symbol END AS symbol, CASE WHEN nth = 1 THEN time END AS timestamp,
  CASE WHEN nth > 1 THEN 'duplicate_key' END AS reason
FROM firsts
UNION ALL
SELECT partition, "offset", NULL, NULL, reason FROM placed WHERE reason IS NOT NULL
""",
        "topic_offsets": """
SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition,
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset"
FROM events
""",
        "topic_scan": """
SELECT 'stockprice' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
  CAST(json_object('price', value, 'symbol', event_type, 'company', event_type, 'market', 'NASDAQ') AS VARCHAR) AS value
FROM events
""",
        "topic_resume": """
WITH placed AS (
  SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition,
    row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset"
  FROM events
)
SELECT * FROM placed WHERE "offset" >= CASE partition WHEN 1 THEN 100 WHEN 3 THEN 50 ELSE 0 END
""",
        "topic_round_trip": f"""
WITH {_MIXED}, {_RECORDS} SELECT partition, "offset", symbol, price, company, market FROM placed WHERE reason IS NULL
""",
        "pk_dedupe": f"WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth = 1",
        "pk_repeats": f"WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth > 1",
        "history_new": f"""
WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth = 1 AND timestamp >= TIMESTAMP '{ASOF}'
""",
        "history_filtered": f"""
WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth = 1 AND timestamp >= TIMESTAMP '{ASOF}'
""",
        "history_bucketed": f"""
WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth = 1 AND timestamp >= TIMESTAMP '{ASOF}'
""",
        "history_known": f"""
WITH {_BY_HOUR} SELECT event_id, symbol, price, timestamp FROM numbered WHERE nth = 1 AND timestamp < TIMESTAMP '{ASOF}'
""",
        "stamp_unique": """
SELECT event_id, event_type AS symbol, value AS price,
  date_trunc('day', ts) + to_microseconds(
    row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY event_id) - 1) AS timestamp
FROM events
""",
        "ingest_table": _INGESTED,
        "ingest_rejects": _REJECTED,
        "history_replay": _INGESTED,
        "history_compact": _INGESTED,
        "append_keyed": """
WITH ticks AS (
  SELECT CASE WHEN event_id % 50 > 0 THEN event_type END AS symbol, value AS price, date_trunc('hour', ts) AS timestamp FROM events
),
stored AS (SELECT symbol, min(price) AS price, timestamp FROM ticks WHERE symbol IS NOT NULL GROUP BY symbol, timestamp)
SELECT symbol, price, timestamp, 0 AS turn, 'stored' AS reason, 1 AS n FROM stored
UNION ALL SELECT NULL, NULL, NULL, turn, 'null_key', (SELECT count(*) FROM ticks WHERE symbol IS NULL) FROM (VALUES (1), (2)) v(turn)
UNION ALL SELECT NULL, NULL, NULL, turn, 'duplicate_key',
  (SELECT count(symbol) FROM ticks) - CASE turn WHEN 1 THEN (SELECT count(*) FROM stored) ELSE 0 END FROM (VALUES (1), (2)) v(turn)
""",
        "quote_asof": f"""
SELECT event_type AS symbol, value AS price, ts AS timestamp FROM events WHERE ts <= TIMESTAMP '{ASOF}'
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""",
        "poll_sample": _GRID,
        "poll_sample_bounded": _GRID + " WHERE epoch_us(g.poll_ts) / 3600000000 <= g.lo + 20",
        "price_series": "SELECT event_type AS symbol, ts AS timestamp, value AS price FROM events",
        "price_trend": _TREND,
        "tick_volume": """
SELECT event_type AS symbol, date_trunc('hour', ts) AS bucket, count(*) AS n_ticks FROM events GROUP BY 1, 2
""",
        "latest_price": """
SELECT event_type AS symbol, value AS price, ts AS timestamp FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""",
        "price_momentum": """
SELECT event_type AS symbol, value AS price, ts AS timestamp, event_id,
  round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS moving_avg,
  round(value - lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS change
FROM events
""",
        "market_summary": f"""
{_MARKET} SELECT market, count(*) AS n_ticks, round(avg(price), 6) AS avg_price, count(DISTINCT symbol) AS n_symbols
FROM priced GROUP BY market
""",
        "market_rollup": f"""
{_MARKET} SELECT market, symbol, count(*) AS n_ticks, round(avg(price), 6) AS avg_price
FROM priced GROUP BY ROLLUP (market, symbol)
""",
        "param_query": f"""
SELECT event_id, event_type AS symbol, ts AS timestamp, value AS price FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '{ASOF}'
""",
        "stream_ingest": f"""
WITH {_MIXED}
SELECT symbol, count(*) AS n_ticks, count(*) AS n_stamps, round(sum(price), 4) AS sum_price, count(*) AS n_messages
FROM judged WHERE reason IS NULL GROUP BY symbol
""",
        "stream_ingest_keyed": _INGESTED,
        "stream_rejects": _REJECTED,
        "stream_trend": f"""
WITH trend AS ({_TREND}), mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS closed FROM events)
SELECT trend.* FROM trend, mark WHERE bucket + INTERVAL 1 HOUR <= closed
""",
        "stream_unique": "SELECT DISTINCT event_type AS symbol, date_trunc('hour', ts) AS timestamp FROM events",
        "stream_poll": """
SELECT event_type AS symbol, value AS price, event_type AS company, 'NASDAQ' AS market FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""",
    }
