"""Structured Streaming: event-time windows with a watermark, and a stream of windows with state."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import Config
from ..functions import off_hours, saturating_sum
from ..operators import alerts as al
from ..schema import PAIR
from ..sources.metrics import normalize

LOG = logging.getLogger("tidewatch.stream")


class ProgressLog(StreamingQueryListener):
    """Logs how far queries are, each time that ``every`` more rows have been read.
    For ``spark.streams.addListener``."""

    def __init__(self, every: int = 1_000_000) -> None:
        self.every, self.rows, self.said = every, 0, 0

    def onQueryStarted(self, event) -> None:
        LOG.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        self.add(event.progress.numInputRows, f"query {event.progress.id}, batch {event.progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        LOG.info("query %s ended after %d rows%s", event.id, self.rows, f": {event.exception}" if event.exception else "")

    def add(self, rows: int, where: str) -> None:
        self.rows += rows
        if self.rows // self.every > self.said:
            self.said = self.rows // self.every
            LOG.info("%d rows read: %s", self.rows, where)


def start_off_hours_stream(stream: DataFrame, cfg: Config, write: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Type 3 over a stream of metrics: pair totals of a window are kept as
    aggregation state and leave it once the watermark, the stable delay behind
    the latest time, has passed the window; rows that come later are dropped.
    Each batch of finished windows is ranked and given to ``write``."""
    d = normalize(stream, cfg).withColumn("event_time", F.col("collect_time").cast("timestamp"))
    d = d.filter(off_hours(F.col("collect_time"), cfg.offhours_start, cfg.offhours_end) & (F.col("conn_count") > 0))
    totals = (d.withWatermark("event_time", f"{cfg.stable_delay_minutes} minutes")
              .groupBy(F.window("event_time", f"{cfg.window_minutes} minutes").alias("w"), *PAIR)
              .agg(saturating_sum(F.col("conn_count")).alias("conns"), F.max("collect_time").alias("collect_time")))

    def rank(batch: DataFrame, version: int) -> None:
        from pyspark.sql import Window as W

        b = batch.select(F.col("w.start").cast("timestamp_ntz").alias("win"), *PAIR, "conns", "collect_time")
        order = W.partitionBy("win").orderBy(F.col("conns").desc(), "collect_time", *PAIR)
        top = b.withColumn("top_rank", F.row_number().over(order)).filter(F.col("top_rank") <= cfg.topn)
        write(al.off_hours_alerts(top, cfg), version)

    return totals.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(rank).trigger(**(trigger or {"availableNow": True})).start()


def start_window_stream(stream: DataFrame, runner_step: Callable[[], str], checkpoint: str, **trigger) -> StreamingQuery:
    """Both rules: arrivals of ``stream`` set off a WindowRunner's steps, which
    scans each window in parallel and commits it with its state."""
    def go(batch: DataFrame, version: int) -> None:
        while runner_step() == "processed":
            pass

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(go).trigger(**(trigger or {"availableNow": True})).start()


