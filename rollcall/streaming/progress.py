"""What a running ingestion has read, accepted, refused and lost, batch by batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

#: Name under which the ingesting stream reports its counts.
WATCHED = "ingested"

PROGRESS_SCHEMA = (
    "query_id string, batch bigint, at string, read bigint, accepted bigint, refused bigint, lost bigint"
)


def lost_offsets(start: str | None, end: str | None, rows: int) -> int:
    """Offsets between ``start`` and ``end`` of a batch that gave no row: gone before they were read.

    Offsets are JSON as a topic source reports them, ``{topic: {partition: offset}}``. A partition
    that is not in ``start`` was read from wherever it begins, and a source without offsets has none.
    Markers of transactions, which take offsets and are no messages, count as lost.
    """
    # Sources without offsets, and the first batch, report other texts, "None" among them.
    before, after = (json.loads(x) if x and x.startswith("{") else {} for x in (start, end))
    passed = 0
    for topic, offsets in after.items():
        earlier = before.get(topic)
        if not isinstance(offsets, dict) or not isinstance(earlier, dict):
            return 0
        passed += sum(to - earlier[part] for part, to in offsets.items() if part in earlier)
        if offsets.keys() - earlier.keys():
            return 0
    return max(0, passed - rows)


class IngestProgress(StreamingQueryListener):
    """Keeps one small row per batch of every ingesting stream of the session.

    ``spark.streams.addListener(progress)`` before the stream starts. Batches without rows leave
    none. ``wait(query)`` returns once all of a stopped query's batches have been reported.
    """

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(WATCHED)
        if counts is None or not counts["read"]:
            return
        lost = sum(lost_offsets(s.startOffset, s.endOffset, s.numInputRows) for s in progress.sources)
        row = (str(progress.id), progress.batchId, progress.timestamp, *(counts[c] for c in ("read", "accepted", "refused")), lost)
        with self._news:
            self.rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait(self, query, seconds: float = 60) -> None:
        """Until the end of ``query`` has been reported, which comes after all its batches."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the end of the stream was not reported")

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rows so far; ``at`` is the start of the batch in UTC."""
        with self._news:
            return spark.createDataFrame(list(self.rows), PROGRESS_SCHEMA)
