"""Scalar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 9223372036854775807
#: Text forms of collect_time, tried in this order; the last ones are the ISO form.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.S", "yyyy-MM-dd HH:mm:ss.SSS",
                "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_time(c: Column) -> Column:
    """Timestamp of any of the text forms, to the second; null if none fits."""
    t = F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(p)) for p in TIME_FORMATS])
    return F.date_trunc("second", t).cast("timestamp_ntz")


def saturating_add(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_add(a, b), F.lit(LONG_MAX).cast("bigint"))


def saturating_sum(c: Column) -> Column:
    """Aggregate: exact in decimals, then held to the largest long."""
    return F.least(F.sum(c.cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("bigint")


def floor_time(ts: Column, minutes: int) -> Column:
    """Start of the aligned window of ``minutes`` (a divisor of 60) that holds ``ts``."""
    return F.window(ts, f"{minutes} minutes")["start"]


def window_end(start: Column, minutes: int) -> Column:
    return (start + F.expr(f"interval {minutes} minutes")).cast("timestamp_ntz")


def off_hours(ts: Column, start: int, end: int) -> Column:
    """Saturday and Sunday always; else from hour ``start`` to ``end``, over midnight if start > end."""
    h = F.hour(ts)
    weekday = (h >= start) | (h < end) if start > end else (h >= start) & (h < end)
    return (F.weekday(ts) >= 5) | weekday


def day_type(ts: Column) -> Column:
    return F.when(F.weekday(ts) >= 5, "WEEKEND").otherwise("WORKDAY")


def time_slot(ts: Column, minutes: int) -> Column:
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes).cast("int")


def protocol_norm(c: Column) -> Column:
    """Trimmed; UNKNOWN for null and blank."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("UNKNOWN"))


def context_columns(ts: Column, protocol: Column, slot_minutes: int) -> list[Column]:
    return [protocol_norm(protocol).alias("context_protocol"), day_type(ts).alias("day_type"), time_slot(ts, slot_minutes).alias("slot")]


def quantile_round(x: Column) -> Column:
    """0 for null, NaN, infinities below and what is not positive; the largest long at most; else half up."""
    return (F.when(x.isNull() | F.isnan(x) | (x <= 0), F.lit(0).cast("bigint")).when(x >= float(LONG_MAX), F.lit(LONG_MAX).cast("bigint"))
            .otherwise(F.floor(x + 0.5).cast("bigint")))


def positive_round(x: Column, fallback: Column) -> Column:
    bad = x.isNull() | F.isnan(x) | (x <= 0) | (x == float("inf"))
    return F.when(bad, fallback).when(x >= float(LONG_MAX), F.lit(LONG_MAX).cast("bigint")).otherwise(F.floor(x + 0.5).cast("bigint"))


def learning_cap(context_high: Column, baseline: Column, current: Column) -> Column:
    return F.when(context_high > 0, context_high).when(baseline > 0, baseline).otherwise(F.greatest(current, F.lit(0).cast("bigint")))


def pair_key(src: Column, dst: Column, protocol: Column) -> Column:
    """The pair as one text; state and joins use the three columns instead."""
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (src, dst, protocol)])


def pair_hash(src: Column, dst: Column, protocol: Column) -> Column:
    """A compact 64-bit key where one is wanted; exact state is kept by the three columns."""
    return F.xxhash64(src, dst, protocol)


def log_id(day: Column, device_id: str, sequence: Column) -> Column:
    """32 digits: date, six of the device, eighteen of the sequence."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit(device_id), F.lpad(sequence.cast("string"), 18, "0"))


def total_order() -> list[Column]:
    """Larger rows first; ties by time, pair and row id, so that every rank is determined."""
    return [F.col("total_bytes").desc(), F.col("collect_time"), F.col("src_ip"), F.col("dst_ip"), F.col("protocol"), F.col("row_id")]
