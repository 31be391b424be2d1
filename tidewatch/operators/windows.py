"""Windows: assignment, summary, empty and late ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import context_columns, floor_time, off_hours


def assign(metrics: DataFrame, cfg: Config) -> DataFrame:
    """Rows with window start, day, context and off-hours flag."""
    ts = F.col("collect_time")
    return metrics.select(
        "*", floor_time(ts, cfg.window_minutes).alias("win"), F.to_date(ts).alias("day"),
        *context_columns(ts, F.col("protocol"), cfg.slot_minutes), off_hours(ts, cfg.offhours_start, cfg.offhours_end).alias("is_off_hours"))


def summary(rows: DataFrame) -> DataFrame:
    """Per window: rows, off-hours rows and contexts. One pass: the contexts of
    a window are counted after the map-side combined count by context."""
    by = rows.groupBy("win", "context_protocol", "day_type", "slot").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_off_hours").alias("off"))
    return by.groupBy("win").agg(F.sum("n").alias("rows"), F.sum("off").alias("offhours_rows"), F.count(F.lit(1)).alias("contexts"))


def empty_windows(rows: DataFrame, minutes: int) -> DataFrame:
    """Windows without rows between the first and the last one that has some."""
    seen = rows.select("win").distinct()
    span = seen.agg(F.min("win").alias("lo"), F.max("win").alias("hi"))
    every = span.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval {minutes} minutes"))).alias("win"))
    return every.join(seen, "win", "left_anti")


def late_rows(rows: DataFrame, safe_end: Column, processed_before: Column) -> DataFrame:
    """Rows whose window ended at or before what had been processed."""
    return rows.filter((F.col("win") < safe_end) & (F.col("win") < processed_before))
