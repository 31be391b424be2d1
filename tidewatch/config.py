"""Settings: defaults, loading and validation."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

#: Setting names, each with its field of Config and its kind.
KEYS = (
    ("window.size.minutes", "window_minutes", int), ("business.timezone", "timezone", str),
    ("source.start.mode", "start_mode", str), ("source.start.time", "start_time", str),
    ("source.poll.interval.seconds", "poll_seconds", int), ("source.watermark.poll.interval.seconds", "watermark_poll_seconds", int),
    ("source.watermark.lookback.days", "watermark_lookback_days", int), ("source.doris.stable.delay.minutes", "stable_delay_minutes", int),
    ("source.empty.window.advance", "empty_advance", bool), ("source.empty.window.retry.seconds", "empty_retry_seconds", int),
    ("source.retry.interval.seconds", "retry_seconds", int), ("source.retry.max.failures", "max_failures", int),
    ("rule.large.enabled", "large_enabled", bool), ("rule.offhours.enabled", "offhours_enabled", bool),
    ("rule.large.bytes.quantile", "bytes_quantile", float), ("rule.large.pkts.quantile", "pkts_quantile", float),
    ("rule.large.bytes.baseline.multiplier", "bytes_multiplier", float), ("rule.large.pkts.baseline.multiplier", "pkts_multiplier", float),
    ("rule.large.extreme.multiplier", "extreme_multiplier", float), ("rule.large.candidate.capacity", "candidate_capacity", int),
    ("rule.large.tdigest.compression", "compression", int), ("rule.offhours.topn", "topn", int), ("rule.offhours.sketch.capacity", "sketch_capacity", int),
    ("rule.offhours.weekday.start.hour", "offhours_start", int), ("rule.offhours.weekday.end.hour", "offhours_end", int),
    ("history.context.enabled", "context_enabled", bool), ("history.context.retention.days", "retention_days", int),
    ("history.context.min.days", "min_days", int), ("history.context.slot.minutes", "slot_minutes", int),
    ("history.context.tdigest.compression", "context_compression", int), ("history.pair.enabled", "pair_enabled", bool),
    ("history.pair.ttl.days", "ttl_days", int), ("history.pair.max.entries", "max_pairs", int), ("history.pair.ema.alpha", "alpha", float),
    ("history.pair.min.samples", "min_samples", int),
    ("history.pair.bootstrap.anomaly.capped.learning.enabled", "capped_learning", bool),
    ("alert.device.id", "device_id", str), ("alert.vendorCode", "vendor_code", str), ("alert.remark1", "remark1", str), ("alert.remark2", "remark2", str),
    ("alert.output.log.enabled", "log_enabled", bool), ("alert.output.kafka.enabled", "kafka_enabled", bool),
    ("kafka.delivery.guarantee", "delivery_guarantee", str), ("checkpoint.enabled", "checkpoint_enabled", bool),
)


class ConfigError(ValueError):
    """A setting is missing or out of its range."""


@dataclass(frozen=True)
class Config:
    window_minutes: int = 5
    timezone: str = "Asia/Shanghai"
    start_mode: str = "latest_data"
    start_time: str = ""
    poll_seconds: int = 15
    watermark_poll_seconds: int = 60
    watermark_lookback_days: int = 3
    stable_delay_minutes: int = 60
    empty_advance: bool = False
    empty_retry_seconds: int = 300
    retry_seconds: int = 30
    max_failures: int = 10
    large_enabled: bool = True
    offhours_enabled: bool = True
    bytes_quantile: float = 0.999
    pkts_quantile: float = 0.999
    bytes_multiplier: float = 4.0
    pkts_multiplier: float = 4.0
    extreme_multiplier: float = 2.0
    candidate_capacity: int = 20_000
    compression: int = 200
    topn: int = 100
    sketch_capacity: int = 2_048
    offhours_start: int = 20
    offhours_end: int = 8
    context_enabled: bool = True
    retention_days: int = 7
    min_days: int = 2
    slot_minutes: int = 5
    context_compression: int = 100
    pair_enabled: bool = True
    ttl_days: int = 7
    max_pairs: int = 200_000
    alpha: float = 0.10
    min_samples: int = 3
    capped_learning: bool = True
    device_id: str = "000000"
    vendor_code: str = "V001"
    remark1: str = ""
    remark2: str = ""
    log_enabled: bool = False
    kafka_enabled: bool = False
    delivery_guarantee: str = "at_least_once"
    checkpoint_enabled: bool = True
    #: Significant digits that values are rounded down to in quantiles and histograms, which bounds a
    #: context's day to 9 * 10**(digits - 1) * 19 values however many rows it has, at an error of
    #: 10**(1 - digits) of the value at most; None: exact.
    histogram_digits: int | None = 3

    def __post_init__(self) -> None:
        def need(ok: bool, what: str) -> None:
            if not ok:
                raise ConfigError(what)

        need(self.window_minutes > 0 and 60 % self.window_minutes == 0, "window.size.minutes must be a positive divisor of 60")
        need(self.histogram_digits is None or 1 <= self.histogram_digits <= 19, "histogram_digits must be from 1 to 19, or None")
        need(self.slot_minutes > 0 and 60 % self.slot_minutes == 0, "history.context.slot.minutes must be a positive divisor of 60")
        need(self.start_mode in ("latest_data", "latest_closed", "fixed"), "source.start.mode must be latest_data, latest_closed or fixed")
        need(self.start_mode != "fixed" or bool(self.start_time), "source.start.time is required when source.start.mode is fixed")
        need(self.large_enabled or self.offhours_enabled, "at least one rule must be enabled")
        for q, name in ((self.bytes_quantile, "bytes"), (self.pkts_quantile, "pkts")):
            need(0 < q < 1, f"rule.large.{name}.quantile must be in (0,1)")
        need(self.candidate_capacity > 0, "rule.large.candidate.capacity must be positive")
        need(self.sketch_capacity > self.topn > 0, "rule.offhours.sketch.capacity must exceed rule.offhours.topn, which must be positive")
        need(1 <= self.min_days <= self.retention_days, "history.context.min.days must be from 1 to the retention")
        need(self.ttl_days > 0, "history.pair.ttl.days must be positive")
        need(self.max_pairs >= 1_000, "history.pair.max.entries must be 1000 or more")
        need(0 < self.alpha <= 1, "history.pair.ema.alpha must be in (0,1]")
        need(self.stable_delay_minutes >= 0, "source.doris.stable.delay.minutes must not be negative")
        need(re.fullmatch(r"[0-9]{6}", self.device_id) is not None, "alert.device.id must be six digits")
        need(self.delivery_guarantee in ("at_least_once", "exactly_once"), "kafka.delivery.guarantee must be at_least_once or exactly_once")
        need(not self.kafka_enabled or self.checkpoint_enabled, "Kafka output needs checkpointing")


def _convert(name: str, raw: str, kind: type) -> object:
    if kind is bool:
        return raw.lower() == "true"
    try:
        return kind(raw)
    except ValueError as e:
        raise ConfigError(f"{name}: not a number: {raw}") from e


def parse_properties(text: str) -> dict[str, str]:
    """key=value or key:value lines; # and ! begin comments; values are trimmed."""
    out = {}
    for line in re.sub(r"\\\r?\n\s*", "", text).splitlines():
        line = line.strip()
        if line and line[0] not in "#!" and (m := re.match(r"([^=:\s]+)\s*[=:]?\s*(.*)", line)):
            out[m[1]] = m[2].strip()
    return out


def from_properties(props: Mapping[str, str], overrides: Mapping[str, str] | None = None) -> Config:
    """Settings of a file; overrides replace keys that the file has."""
    props = dict(props) | {k: v for k, v in (overrides or {}).items() if k in props}
    names = {f.name for f in fields(Config)}
    return Config(**{field: _convert(key, props[key], kind) for key, field, kind in KEYS if field in names and props.get(key, "") != ""})


def load(args: Sequence[str] = (), overrides: Mapping[str, str] | None = None, env: Mapping[str, str] | None = None) -> Config:
    """From ``--config X`` or ``--config=X``, else the file named by TIDEWATCH_CONFIG,
    else ./application.properties, else the defaults."""
    path, rest = None, list(args)
    for i, a in enumerate(rest):
        if a == "--config":
            if i + 1 >= len(rest):
                raise ConfigError("--config needs a path")
            path = rest[i + 1]
        elif a.startswith("--config="):
            path = a.partition("=")[2]
    path = path or (env if env is not None else os.environ).get("TIDEWATCH_CONFIG")
    if path is None and os.path.exists("application.properties"):
        path = "application.properties"
    if path is None:
        return Config()
    with open(path, encoding="utf-8") as f:
        return from_properties(parse_properties(f.read()), overrides)
