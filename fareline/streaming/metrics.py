"""What running flows report about their micro-batches, kept in a table.

A query's progress holds its constraint counts, its dedup's late rows and its input, and is
gone with the query. The recorder listens to all queries of a session and appends their
figures to ``<root>/flow_metrics``, many at a time.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fareline.operators.versions import first_per_key
from fareline.sources.storage import or_none

METRICS_DDL = (
    "query string, query_id string, batch bigint, reported_at timestamp, measured string, metric string, value bigint"
)
#: The group of figures that come from a query's state, and the name of the rows behind the watermark.
STATE, LATE_ROWS = "state", "rows_behind_watermark"


def metrics_path(root: str) -> str:
    return f"{root.rstrip('/')}/flow_metrics"


class FlowMetrics(StreamingQueryListener):
    """Records the flows below ``root`` that start while it is entered.

        with FlowMetrics(spark, root):
            flows.start_live_staging(spark, root).awaitTermination()

    Figures are written when ``hold`` of them have come, when a query ends, and on leaving,
    which waits up to ``patience`` seconds for the last reports of the queries that have
    ended. Queries that still run are recorded until then; enter again for the rest.
    """

    def __init__(self, spark: SparkSession, root: str, hold: int = 10_000, patience: float = 60.0) -> None:
        self._session, self._root = spark, root.rstrip("/")
        self._hold, self._patience = hold, patience
        self._held: list[tuple] = []
        self._names: dict[str, str] = {}
        self._changed = threading.Condition()

    def __enter__(self) -> FlowMetrics:
        self._session.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        def all_reported() -> bool:
            running = {str(query.runId) for query in self._session.streams.active}
            return set(self._names) <= running

        with self._changed:
            self._changed.wait_for(all_reported, self._patience)
        self._session.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        if (event.name or "").startswith(f"{self._root}/"):
            with self._changed:
                self._names[str(event.runId)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.runId) not in self._names:
            return
        name = progress.name.removeprefix(f"{self._root}/")
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        figures = [(group, metric, value) for group, row in progress.observedMetrics.items() for metric, value in row.asDict().items()]
        if progress.stateOperators:
            figures.append((STATE, LATE_ROWS, sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)))
        rows = [(name, str(progress.id), progress.batchId, at, *figure) for figure in figures]
        with self._changed:
            self._held += rows
            full = len(self._held) >= self._hold
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._names:
            self.flush()
            with self._changed:
                self._names.pop(str(event.runId))
                self._changed.notify_all()

    def flush(self) -> None:
        """Append what is held."""
        with self._changed:
            rows, self._held = self._held, []
        if rows:
            frame = self._session.createDataFrame(rows, METRICS_DDL)
            frame.coalesce(1).write.mode("append").parquet(metrics_path(self._root))


def flow_metrics(spark: SparkSession, root: str) -> DataFrame:
    """All recorded figures; of a batch that was reported more than once the last report."""
    stored = or_none(lambda: spark.read.schema(METRICS_DDL).parquet(metrics_path(root)))
    if stored is None:
        return spark.createDataFrame([], METRICS_DDL)
    keys = ["query", "query_id", "batch", "measured", "metric"]
    return first_per_key(stored, keys, [F.desc("reported_at"), F.desc("value")])


def flow_totals(spark: SparkSession, root: str) -> DataFrame:
    """(query, measured, metric, total) over all batches of each flow."""
    return flow_metrics(spark, root).groupBy("query", "measured", "metric").agg(F.sum("value").alias("total"))
