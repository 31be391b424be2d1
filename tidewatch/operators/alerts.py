"""Alerts: details, numbering and JSON."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import log_id

_DETAIL_2 = "struct<current_bytes:bigint,current_pkts:bigint,baseline_bytes:bigint,baseline_pkts:bigint,bytes_threshold:double,pkts_threshold:double,extreme_bytes_threshold:double,anomaly_reason:string>"
_DETAIL_3 = "struct<topRank:int,TopN:int,conns:bigint>"
_HEAD = ("win", "collect_time", "src_ip", "dst_ip", "protocol")


def large_alerts(best: DataFrame) -> DataFrame:
    detail = F.struct(F.col("total_bytes").alias("current_bytes"), F.col("total_pkts").alias("current_pkts"), "baseline_bytes", "baseline_pkts",
                      "bytes_threshold", "pkts_threshold", "extreme_bytes_threshold", "anomaly_reason")
    return best.select(*_HEAD, F.lit(2).alias("anomaly_type"), detail.cast(_DETAIL_2).alias("detail2"), F.lit(None).cast(_DETAIL_3).alias("detail3"),
                       F.col("total_bytes").alias("weight"))


def off_hours_alerts(top: DataFrame, cfg: Config) -> DataFrame:
    detail = F.struct(F.col("top_rank").alias("topRank"), F.lit(cfg.topn).alias("TopN"), "conns")
    return top.select(*_HEAD, F.lit(3).alias("anomaly_type"), F.lit(None).cast(_DETAIL_2).alias("detail2"), detail.cast(_DETAIL_3).alias("detail3"),
                      F.col("conns").alias("weight"))


def number(alerts: DataFrame, cfg: Config, day: date, first: int = 0) -> DataFrame:
    """Alerts with a log id: in order of window, type and weight, from ``first``.

    Rows are numbered within a window; windows' counts are summed up to
    offsets, so no task ranks all alerts. Alerts that have a ``log_id``
    already are refused: an id is given once.
    """
    if "log_id" in alerts.columns:
        raise ValueError("alerts are numbered already")
    counts = alerts.groupBy("win").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("win", (F.sum("n").over(W.orderBy("win")) - F.col("n")).alias("before"))
    place = F.row_number().over(W.partitionBy("win").orderBy("anomaly_type", F.col("weight").desc(), "collect_time", "src_ip", "dst_ip", "protocol"))
    d = alerts.withColumn("place", place).join(before, "win")
    seq = F.col("before") + F.col("place") - 1 + F.lit(first)
    return d.select(log_id(F.lit(day), cfg.device_id, seq).alias("log_id"), seq.alias("sequence"), *_HEAD, "anomaly_type", "detail2", "detail3")


def to_json(numbered: DataFrame, cfg: Config) -> DataFrame:
    """One JSON text per alert, fields in fixed order, the detail by type."""
    def line(detail: str):
        return F.to_json(F.struct(
            F.col("log_id").alias("logId"), F.date_format("collect_time", "yyyy-MM-dd HH:mm:ss").alias("collectTime"), F.col("src_ip").alias("srcIp"),
            F.col("dst_ip").alias("dstIp"), "protocol", F.col("anomaly_type").alias("anomalyType"), F.col(detail).alias("anomalyDetail"),
            F.lit(cfg.remark1).alias("remark1"), F.lit(cfg.remark2).alias("remark2"), F.lit(cfg.vendor_code).alias("vendorCode")))
    return numbered.select("log_id", "win", "anomaly_type", F.when(F.col("anomaly_type") == 2, line("detail2")).otherwise(line("detail3")).alias("value"))


class LogIds:
    """Next sequence number of a day; a new day begins at 0, an earlier one is refused."""

    def __init__(self, device_id: str, day: date | None = None, sequence: int = 0) -> None:
        if len(device_id) != 6 or not (device_id.isascii() and device_id.isdigit()):
            raise ValueError("a device id has six digits")
        if not 0 <= sequence <= 10**18:
            raise ValueError("sequence out of range")
        self.device_id, self.day, self.sequence = device_id, day, sequence

    def take(self, day: date, n: int) -> int:
        """First of ``n`` numbers for the day."""
        if self.day is not None and day < self.day:
            raise RuntimeError(f"the clock went back from {self.day} to {day}")
        if day != self.day:
            self.day, self.sequence = day, 0
        if self.sequence + n > 10**18:
            raise OverflowError("log ids of the day are used up")
        first, self.sequence = self.sequence, self.sequence + n
        return first

    def next(self, day: date) -> str:
        return f"{day:%Y%m%d}{self.device_id}{self.take(day, 1):018d}"

    def snapshot(self) -> str:
        return "" if self.day is None else f"{self.day:%Y%m%d}|{self.sequence}"

    @classmethod
    def restore(cls, device_id: str, snapshot: str) -> LogIds:
        if not snapshot:
            return cls(device_id)
        day, _, sequence = snapshot.partition("|")
        return cls(device_id, date(int(day[:4]), int(day[4:6]), int(day[6:8])), int(sequence))


def counts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("win", "anomaly_type").agg(F.count(F.lit(1)).alias("alerts"))
