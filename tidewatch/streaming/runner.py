"""Windows strictly in order, each once its data is old enough; state and alerts committed together."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import alerts as al
from ..plans.incremental import run_window
from ..plans.state import StateStore
from ..schema import CONTEXT
from ..functions import parse_time
from ..sources.metrics import bad_rows, check_aligned, normalize, partition_predicate, progress, safe_end, time_predicate
from ..sources.sinks import Sink

LOG = logging.getLogger("tidewatch.runner")
Reader = Callable[[SparkSession], DataFrame]


@dataclass
class Counters:
    processed_windows: int = 0
    queried_rows: int = 0
    emitted_alerts: int = 0
    bad_rows: int = 0
    query_failures: int = 0
    watermark_queries: int = 0
    empty_window_retries: int = 0


class WindowRunner:
    """Polls a table of metrics.

    read: gives the raw metrics; the window's predicate is added to it and
    reaches the scan. A window is processed when its end is not after the
    latest time less the stable delay, floored. State, cursor and log ids are
    versions of a StateStore; alerts go to sinks under the same version
    before it, so a run that breaks off in between repeats that version.

    today: the date that lookback and log ids go by, by default that of the
    business time zone. latest: one row with the latest time, by default
    ``progress`` over what ``read`` gives. What a store or Spark refuses counts
    against the limit of failures in a row, and the watermark is asked anew.
    """

    def __init__(self, spark: SparkSession, read: Reader, store: StateStore, sinks: Sequence[Sink], cfg: Config, *,
                 today: Callable[[], date] | None = None, latest: Callable[[SparkSession, date], DataFrame] | None = None, clock: Callable[[], float] = time.monotonic,
                 sleep: Callable[[float], None] = time.sleep, day_col: str | None = None, hour_col: str | None = None) -> None:
        self.spark, self.read, self.store, self.sinks, self.cfg = spark, read, store, sinks, cfg
        zone = ZoneInfo(cfg.timezone)
        self.today = today or (lambda: datetime.now(zone).date())
        self.latest = latest or (lambda s, day: progress(read(s), day, cfg.watermark_lookback_days, day_col=day_col))
        self.clock, self.sleep, self.day_col, self.hour_col = clock, sleep, day_col, hour_col
        self.counters, self.failures = Counters(), 0
        self._bad: tuple[object, int] = (None, 0)  # partitions of the last window, and the bad rows counted in them
        self._safe: datetime | None = None
        self._refresh_at = float("-inf")
        self.version = store.latest()
        self.state = store.read(self.version)
        self.stopped = False
        self.sizes: dict[str, int] = {}

    def stop(self) -> None:
        self.stopped = True

    def safe_end(self) -> datetime | None:
        """End of the stable data, asked anew when it is unknown or its time is up."""
        if self._safe is None or self.clock() >= self._refresh_at:
            self.counters.watermark_queries += 1
            latest = self.latest(self.spark, self.today()).first()["latest"]
            self._safe = safe_end(latest, self.cfg)
            self._refresh_at = self.clock() + max(5, self.cfg.watermark_poll_seconds)
        return self._safe

    def cursor(self) -> datetime | None:
        """Start of the next window: the restored one, else by the start mode."""
        if self.state.cursor is not None:
            return self.state.cursor
        if self.cfg.start_mode == "fixed":
            return check_aligned(datetime.fromisoformat(self.cfg.start_time), self.cfg.window_minutes)
        safe = self.safe_end()
        return None if safe is None else safe - timedelta(minutes=self.cfg.window_minutes)

    def step(self) -> str:
        """One poll: ``processed``, ``waiting`` (not old enough), ``empty`` (held) or ``failed``."""
        try:
            start = self.cursor()
            safe = self.safe_end()
            if start is None or safe is None or start + timedelta(minutes=self.cfg.window_minutes) > safe:
                return "waiting"
            return self.process(start)
        except (PySparkException, Py4JJavaError):  # the latter is what a JDBC driver's errors come as
            self.counters.query_failures += 1
            self.failures += 1
            self._refresh_at = float("-inf")
            LOG.exception("window failed, %d of %d", self.failures, self.cfg.max_failures)
            if self.failures >= self.cfg.max_failures:
                raise
            return "failed"

    def process(self, start: datetime) -> str:
        end = start + timedelta(minutes=self.cfg.window_minutes)
        raw = self.read(self.spark)
        text = dict(raw.dtypes)["collect_time"] == "string"
        if text:  # text times are no predicate: partition columns prune, and of the rest only this window's rows and unreadable ones are kept
            parts = partition_predicate(start, end, self.day_col, self.hour_col)
            raw = raw if parts is None else raw.filter(parts)
            raw = raw.withColumn("_t", parse_time(F.col("collect_time")))
            raw = raw.filter(F.col("_t").isNull() | time_predicate(start, end, ts_col="_t")).drop("_t")
        else:
            raw = raw.filter(time_predicate(start, end, self.day_col, self.hour_col))
        raw = raw.persist()
        try:
            good = normalize(raw, self.cfg).filter(time_predicate(start, end))
            rows = good.count()
            if text:
                self._count_bad(start, bad_rows(raw).count())
            self.counters.queried_rows += rows
            if not rows and not self.cfg.empty_advance:
                self.counters.empty_window_retries += 1
                self._safe, self.failures = None, 0
                return "empty"
            alerts, state = run_window(good, start, self.state, self.cfg)
            ids = al.LogIds.restore(self.cfg.device_id, self.state.log_ids)
            alerts = alerts.persist()
            n = alerts.count()
            day = self.today()
            first = ids.take(day, n)
            lines = al.to_json(al.number(alerts, self.cfg, day, first), self.cfg)
            version = 0 if self.version is None else self.version + 1
            for sink in self.sinks:
                sink.write(lines, version)
            self.store.write(version, replace(state, log_ids=ids.snapshot()))
            by = {r["anomaly_type"]: r["count"] for r in alerts.groupBy("anomaly_type").count().collect()}
            alerts.unpersist()
        finally:
            raw.unpersist()
        self.version, self.state, self.failures = version, self.store.read(version), 0
        self.counters.processed_windows += 1
        self.counters.emitted_alerts += n
        self.sizes = {"pairs": self.state.pairs.count(), "context_days": self.state.contexts.select(*CONTEXT, "day").distinct().count()}
        LOG.info("window [%s, %s): %d rows, alerts %s, state %s", start, end, rows, by, self.sizes)
        return "processed"

    def _count_bad(self, start: datetime, n: int) -> None:
        """Rows without a time belong to no window, so all windows of the same partitions meet them: each counts once."""
        scope = (start.date() if self.day_col else None, start.replace(minute=0) if self.hour_col else None)
        before = self._bad[1] if self._bad[0] == scope else 0
        self.counters.bad_rows += max(0, n - before)
        self._bad = (scope, n)

    def run(self, until_waiting: bool = False) -> Counters:
        """Poll until stopped, or until no further window is ready."""
        waits = {"waiting": self.cfg.poll_seconds, "empty": self.cfg.empty_retry_seconds, "failed": self.cfg.retry_seconds}
        while not self.stopped:
            did = self.step()
            if until_waiting and did in ("waiting", "empty"):
                break
            if did != "processed":
                self.sleep(max(1, waits[did]))
        return self.counters


def run_with_restarts(make: Callable[[], WindowRunner], attempts: int = 20, delay_seconds: float = 10,
                      sleep: Callable[[float], None] = time.sleep, **options) -> Counters:
    """Run, and start anew from the last complete version after a failure, up to ``attempts`` times."""
    for left in range(attempts, -1, -1):
        try:
            return make().run(**options)
        except Exception:
            if not left:
                raise
            LOG.exception("run failed, %d restarts left", left)
            sleep(delay_seconds)
    raise AssertionError
