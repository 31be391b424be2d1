"""Where alert lines go: log, files, Kafka or nowhere."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, ConfigError

LOGGER, LOG = logging.getLogger("ANOMALY_ALERT"), logging.getLogger("tidewatch.sinks")


class Sink(Protocol):
    def write(self, lines: DataFrame, version: int) -> None:
        """Deliver the column ``value`` of a batch; the same version again replaces or repeats it."""


@dataclass
class LogSink:
    """Driver log at WARN, one alert a line, streamed by partition rather than gathered."""

    logger: logging.Logger = LOGGER

    def write(self, lines: DataFrame, version: int) -> None:
        for r in lines.select("value").toLocalIterator():
            self.logger.warning("%s", r["value"])


@dataclass
class FileSink:
    """JSON lines in a folder per version; a version written again is replaced: exactly once."""

    path: str

    def write(self, lines: DataFrame, version: int) -> None:
        lines.select("value").write.mode("overwrite").text(f"{self.path}/v={version}")


@dataclass
class NoopSink:
    def write(self, lines: DataFrame, version: int) -> None:
        lines.write.format("noop").mode("overwrite").save()


@dataclass
class KafkaSink:
    """At least once: Spark's Kafka sink has no transactions. The log id is the
    record's key, and a version that is written again has the same ids, so a
    compacted topic, or a consumer that drops repeated keys, has each alert
    once. Needs the connector."""

    servers: str
    topic: str
    options: dict[str, str] = field(default_factory=dict)

    def records(self, lines: DataFrame) -> DataFrame:
        return lines.selectExpr("cast(log_id as string) as key", "cast(value as string) as value")

    def write(self, lines: DataFrame, version: int) -> None:
        self.records(lines).write.format("kafka").options(**kafka_options(self.servers, self.options)).option("topic", self.topic).save()


def kafka_options(servers: str, more: dict[str, str] | None = None, kerberos: bool = False) -> dict[str, str]:
    """Options with the ``kafka.`` prefix; with ``kerberos`` the usual SASL ones unless given."""
    base = {"security.protocol": "SASL_PLAINTEXT", "sasl.mechanism": "GSSAPI", "sasl.kerberos.service.name": "kafka"} if kerberos else {}
    return {"kafka.bootstrap.servers": servers} | {f"kafka.{k}": v for k, v in (base | (more or {})).items()}


def kafka_available(spark: SparkSession) -> bool:
    """Whether this Spark can write to Kafka: a check before a run, as is ``probe``."""
    loader = spark._jvm.Thread.currentThread().getContextClassLoader()
    try:
        loader.loadClass("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # the JVM's ClassNotFoundException, wrapped
        return False


def probe(servers: str, timeout: float = 10.0, fail_fast: bool = False) -> list[str]:
    """Brokers that accept a connection; none is a warning, or an error with ``fail_fast``."""
    import socket

    found = []
    for s in servers.split(","):
        host, _, port = s.strip().rpartition(":")
        try:
            socket.create_connection((host, int(port)), timeout).close()
            found.append(s.strip())
        except (OSError, ValueError) as e:
            LOGGER.warning("broker %s: %s", s, e)
    if not found and fail_fast:
        raise ConnectionError(f"no broker of {servers} can be reached")
    return found


@dataclass
class Delivery:
    """Records and bytes that a sink took, in summaries of time spans aligned to
    ``seconds``: spans without records are passed over, the first failure of
    each is logged at once, as is the first batch that is ever acknowledged."""

    sink: Sink
    seconds: int = 300
    clock: Callable[[], float] = time.time
    summaries: list[dict[str, object]] = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.seconds < 1:
            raise ValueError("seconds must be positive")
        self.total = {"attempted": 0, "attempted_bytes": 0, "delivered": 0, "delivered_bytes": 0, "failed": 0}
        self.last, self.first_failure, self.acknowledged = dict(self.total), "", False
        self.since = self._start()

    def _start(self) -> float:
        return self.clock() // self.seconds * self.seconds

    def write(self, lines: DataFrame, version: int) -> None:
        self._turn()
        r = lines.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("b")).first()
        self.total["attempted"] += r["n"]
        self.total["attempted_bytes"] += r["b"]
        try:
            self.sink.write(lines, version)
        except Exception as e:
            self._turn()
            self.total["failed"] += r["n"]
            if not self.first_failure:
                self.first_failure = f"{type(e).__name__}: {e}"
                LOG.error("delivery failed: %s", self.first_failure)
            raise
        self._turn()
        self.total["delivered"] += r["n"]
        self.total["delivered_bytes"] += r["b"]
        if not self.acknowledged and r["n"]:
            self.acknowledged = True
            LOG.info("first batch acknowledged: %d records, version %d", r["n"], version)

    def _turn(self) -> None:
        if (now := self._start()) > self.since:
            if self.total != self.last:
                self.summaries.append(self.summary(now))
                LOG.info("delivery %s", self.summaries[-1])
            self.last, self.first_failure, self.since = dict(self.total), "", now

    def summary(self, until: float | None = None) -> dict[str, object]:
        """What the span that is open has had, and all records since the start."""
        part = {k: v - self.last[k] for k, v in self.total.items()}
        return part | {"since": self.since, "until": self.clock() if until is None else until, "first_failure": self.first_failure,
                       "in_flight": self.total["attempted"] - self.total["delivered"] - self.total["failed"], "total": dict(self.total)}

    def close(self) -> dict[str, object]:
        """The last summary, of a span that need not be over."""
        self.summaries.append(self.summary())
        LOG.info("delivery ends %s", self.summaries[-1])
        return self.summaries[-1]


def sinks_of(cfg: Config, kafka: KafkaSink | None = None) -> list[Sink]:
    out: list[Sink] = []
    if cfg.log_enabled:
        out.append(LogSink())
    if cfg.kafka_enabled:
        if kafka is None:
            raise ConfigError("Kafka output needs servers and a topic")
        if cfg.delivery_guarantee == "exactly_once":
            raise ConfigError("Spark's Kafka sink delivers at least once; exactly_once can't be had")
        out.append(kafka)
    return out or [NoopSink()]
