"""Sessions and silence of a symbol as a stream: state per symbol, closed by event-time timers.

Each micro-batch shrinks to partial sessions per task before it is shuffled, so a hot
symbol sends a few rows per task however many ticks it has. The state of a symbol is its
sessions that may still grow, each as one row; ticks that come out of order extend, join or
precede them. A timer waits at the moment from which no tick on time can extend the first of
them; when the watermark passes it, all sessions that are final go out, whether or not any
tick ever follows, and the timer is set for the next.
"""

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A partial session; times are microseconds, and the first and last tick are told apart from others of their time by a number.
_PARTIAL = "start long, first_tie long, open double, end long, last_tie long, close double, high double, low double, sum_price double, n_priced long, n_ticks long"
_FIELDS = [f.split()[0] for f in _PARTIAL.split(", ")]


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Start queries with keyed state in here: it needs Spark's RocksDB state store, which a query takes when it starts."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _least(a: float | None, b: float | None) -> float | None:
    return b if a is None else a if b is None else min(a, b)


def _most(a: float | None, b: float | None) -> float | None:
    return b if a is None else a if b is None else max(a, b)


def joined(sessions: Iterable[tuple], gap: int) -> list[tuple]:
    """Partial sessions put together wherever no more than ``gap`` microseconds lie between them."""
    out: list[dict] = []
    for row in sorted(sessions, key=lambda s: (s[0], s[1])):
        s = dict(zip(_FIELDS, row, strict=True))
        if not out or s["start"] - out[-1]["end"] > gap:
            out.append(s)
            continue
        t = out[-1]
        if (s["start"], s["first_tie"]) < (t["start"], t["first_tie"]):
            t.update({f: s[f] for f in ("start", "first_tie", "open")})
        if (s["end"], s["last_tie"]) > (t["end"], t["last_tie"]):
            t.update({f: s[f] for f in ("end", "last_tie", "close")})
        t["high"], t["low"], t["sum_price"] = _most(t["high"], s["high"]), _least(t["low"], s["low"]), t["sum_price"] + s["sum_price"]
        t["n_priced"], t["n_ticks"] = t["n_priced"] + s["n_priced"], t["n_ticks"] + s["n_ticks"]
    return [tuple(s[f] for f in _FIELDS) for s in out]


def _shrunk(gap: int):
    """Partial sessions of the ticks of a task, a batch of them at a time."""

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ticks in batches:
            if ticks.empty:
                continue
            ticks = ticks.sort_values(["symbol", "us", "tie"], kind="stable")
            new = (ticks.symbol != ticks.symbol.shift()) | (ticks.us.diff() > gap)
            ticks = ticks.assign(session=new.cumsum(), n_priced=ticks.price.notna())
            each = ticks.groupby("session")
            first, last = each.head(1).set_index("session"), each.tail(1).set_index("session")
            out = pd.DataFrame({"symbol": first.symbol, "start": first.us, "first_tie": first.tie, "open": first.price, "end": last.us, "last_tie": last.tie, "close": last.price})
            out = out.assign(high=each.price.max(), low=each.price.min(), sum_price=each.price.sum(), n_priced=each.n_priced.sum(), n_ticks=each.size())
            yield out.astype(object).where(out.notna(), None)

    return shrink


class SessionState(StatefulProcessor):
    """Open sessions of a symbol, and a timer for the first of them to end."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _PARTIAL)

    def _due(self, session: tuple) -> int:
        """The millisecond by which no tick may extend the session."""
        return -(-(session[3] + self.gap) // 1000)

    def _wait(self, sessions: list[tuple]) -> None:
        """Keep ``sessions``; one timer waits for the first of them to end, as a symbol may have many."""
        due = min(map(self._due, sessions), default=None)
        waiting = set(self.handle.listTimers())
        for at in waiting - {due}:
            self.handle.deleteTimer(at)
        if due is None:
            self.open.clear()
            return
        self.open.put(sessions)
        if due not in waiting:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._wait(joined([*map(tuple, self.open.get()), *(tuple(r[f] for f in _FIELDS) for r in rows)], self.gap))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        reached = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        over, rest = [], []
        for s in map(tuple, self.open.get()):
            (over if self._due(s) <= reached else rest).append(s)
        self._wait(rest)
        for s in over:
            yield Row(symbol=key[0], **dict(zip(_FIELDS, s, strict=True)))

    def close(self) -> None:
        pass


def session_stream(ticks: DataFrame, gap_seconds: float, late: str = "10 minutes", tie: str | None = None) -> DataFrame:
    """``session_trend`` over a stream of ticks; a session is emitted once no tick up to ``late`` may extend it.

    Start the query inside ``keyed_state``. Late ticks count only where they hang together
    with ticks of their micro-batch that are on time. ``tie`` must be an integer.
    """
    if tie is not None and not isinstance(ticks.schema[tie].dataType, IntegralType):
        raise TypeError(f"{tie} must be an integer")
    gap = round(gap_seconds * 1_000_000)
    bare = ticks.dropna(subset=["symbol", "timestamp"]).select(
        "symbol",
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us"),
        (F.lit(0) if tie is None else F.col(tie)).cast("long").alias("tie"),
        F.col("price").cast("double").alias("price"),
    )
    parts = bare.mapInPandas(_shrunk(gap), f"symbol string, {_PARTIAL}")
    timed = parts.withColumn("at", F.timestamp_micros("end")).withWatermark("at", late)
    closed = timed.groupBy("symbol").transformWithState(SessionState(gap), f"symbol string, {_PARTIAL}", "append", "eventTime")
    return closed.select(
        "symbol",
        F.timestamp_micros("start").cast("timestamp_ntz").alias("start"),
        F.timestamp_micros("end").cast("timestamp_ntz").alias("end"),
        "open",
        "high",
        "low",
        "close",
        F.when(F.col("n_priced") > 0, F.col("sum_price") / F.col("n_priced")).alias("avg_price"),
        "n_ticks",
    )


def stale_stream(ticks: DataFrame, minutes: float, late: str = "10 minutes") -> DataFrame:
    """Each time that a symbol has had no tick for ``minutes``: symbol, since (its last tick), stale_at.

    Raised when the watermark passes ``stale_at``, also if no tick ever follows. Start the
    query inside ``keyed_state``.
    """
    silent = session_stream(ticks, minutes * 60, late)
    at = F.timestamp_micros(F.unix_micros(F.col("end").cast("timestamp")) + round(minutes * 60_000_000)).cast("timestamp_ntz")
    return silent.select("symbol", F.col("end").alias("since"), at.alias("stale_at"))
