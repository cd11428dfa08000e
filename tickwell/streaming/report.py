"""What became of each batch: counts kept by the jobs that do the work, no job of their own."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

from tickwell.schema import REASONS

#: The name under which a query's progress tells what arrived.
ARRIVED = "arrived"


@dataclass(frozen=True)
class Report:
    """A complete batch: rows stored, and rows rejected by reason."""

    run_id: str
    batch_id: int
    stored: int
    rejected: dict[str, int]

    def __str__(self) -> str:
        return f"batch {self.batch_id}: {self.stored} stored, {sum(self.rejected.values())} rejected {self.rejected}"


def arrivals() -> list[Column]:
    """Records of a judged stream, and how many of them carry each reason; what repeats a key is not known yet."""
    return [F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS]]


class ArrivalListener(StreamingQueryListener):
    """Tells ``tell`` of each batch of an ingesting query how many records arrived, and how many of them for each reason can't be stored.

    Add it with ``spark.streams.addListener``. A batch is told once it is complete.
    """

    def __init__(self, tell: Callable[[int, dict[str, int]], None]):
        self.tell = tell

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        found = event.progress.observedMetrics.get(ARRIVED)
        if found is not None:
            self.tell(event.progress.batchId, {name: n for name, n in found.asDict().items() if n})

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass
