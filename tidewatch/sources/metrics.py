"""Reading flow metrics: scans, predicates, coercion and progress."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import floor_time, parse_time, saturating_add
from ..schema import COUNTERS

_NAME = re.compile(r"[A-Za-z0-9_]+(\.[A-Za-z0-9_]+){0,2}")


def table_name(name: str) -> str:
    """The name, if it is a plain or dotted identifier."""
    if not _NAME.fullmatch(name or ""):
        raise ValueError(f"not a table name: {name!r}")
    return name


def floor_datetime(t: datetime, minutes: int) -> datetime:
    return t.replace(minute=t.minute - t.minute % minutes, second=0, microsecond=0)


def check_aligned(t: datetime, minutes: int) -> datetime:
    if t.second or t.microsecond or t.minute % minutes:
        raise ValueError(f"not aligned to {minutes} minutes: {t}")
    return t


def day_bounds(start: datetime, end: datetime) -> tuple[date, date]:
    """First and last day of [start, end), both included."""
    return start.date(), (end - timedelta(microseconds=1)).date()


def hour_bounds(start: datetime, end: datetime) -> tuple[datetime, datetime]:
    """Half-open range of whole hours around [start, end)."""
    low, high = floor_datetime(start, 60), floor_datetime(end, 60)
    return low, high if high == end else high + timedelta(hours=1)


def time_predicate(start: datetime, end: datetime, day_col: str | None = None, hour_col: str | None = None,
                   ts_col: str = "collect_time") -> Column:
    """[start, end) on the time column and, for partition pruning, the same
    range on day and hour columns where the table has them."""
    ts = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    out = (F.col(ts_col) >= ts(start)) & (F.col(ts_col) < ts(end))
    parts = partition_predicate(start, end, day_col, hour_col)
    return out if parts is None else parts & out


def partition_predicate(start: datetime, end: datetime, day_col: str | None = None, hour_col: str | None = None) -> Column | None:
    """The part of ``time_predicate`` that is on day and hour columns; None without any."""
    ts = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    out = []
    if day_col:
        low, high = day_bounds(start, end)
        out.append((F.col(day_col) >= F.lit(low)) & (F.col(day_col) <= F.lit(high)))
    if hour_col:
        low, high = hour_bounds(start, end)
        out.append((F.col(hour_col) >= ts(low)) & (F.col(hour_col) < ts(high)))
    return reduce(lambda a, b: a & b, out) if out else None


def read_metrics(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, start: datetime, end: datetime, *, day_col: str = "dayTime",
              hour_col: str = "dayHourTime", ts_col: str = "collectTime", columns: dict[str, str] | None = None,
              fetch_size: int = 5_000, timeout_seconds: int = 1_800, partitions: int = 0, **options: str) -> DataFrame:
    """A window of a store's table over JDBC. Predicates on day, hour and time
    go to the store; with ``partitions`` the window is read in as many time
    slices by as many connections, each with its own predicate."""
    t = lambda x: x.strftime("%Y-%m-%d %H:%M:%S")
    (d0, d1), (h0, h1) = day_bounds(start, end), hour_bounds(start, end)
    base = f"{day_col} >= '{d0}' AND {day_col} <= '{d1}' AND {hour_col} >= '{t(h0)}' AND {hour_col} < '{t(h1)}'"
    n = max(1, partitions)
    cuts = [start + (end - start) * i / n for i in range(n + 1)]
    where = [f"{base} AND {ts_col} >= '{t(a)}' AND {ts_col} < '{t(b)}'" for a, b in zip(cuts, cuts[1:])]
    props = {"fetchsize": str(fetch_size), "queryTimeout": str(timeout_seconds)} | options
    df = spark.read.jdbc(url, table_name(table), predicates=where, properties=props)
    return df.select(*[F.col(c).alias(a) for a, c in columns.items()]) if columns else df


def normalize(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Rows that have a time, coerced: time to the second, null strings empty,
    null and negative counters 0, saturating totals. ``bad_rows`` picks the rest."""
    ts = _time(df)
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("src_ip", "dst_ip", "protocol")]
    counts = [F.greatest(F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint")).alias(c) for c in COUNTERS]
    row = F.col("row_id").cast("bigint") if "row_id" in df.columns else F.xxhash64(ts, "src_ip", "dst_ip", "protocol", *COUNTERS)
    d = df.select(ts.alias("collect_time"), *text, *counts, row.alias("row_id")).filter("collect_time is not null")
    return d.withColumns({"total_bytes": saturating_add(F.col("c2s_bytes"), F.col("s2c_bytes")),
                          "total_pkts": saturating_add(F.col("c2s_pkts"), F.col("s2c_pkts"))})


def _time(df: DataFrame) -> Column:
    kind = dict(df.dtypes)["collect_time"]
    if kind == "string":
        return parse_time(F.col("collect_time"))
    return F.date_trunc("second", F.col("collect_time")).cast("timestamp_ntz")


def bad_rows(df: DataFrame) -> DataFrame:
    """Rows without a time that can be read."""
    return df.filter(_time(df).isNull())


def progress(df: DataFrame, today: date, lookback_days: int, ts_col: str = "collect_time", day_col: str | None = None) -> DataFrame:
    """One row: the latest time of the last ``lookback_days`` days. The range is a
    plain predicate on the day column or, without one, on the time column, so it
    reaches the scan; only text times must be parsed first."""
    first = today - timedelta(days=max(1, lookback_days) - 1)
    ts = F.col(ts_col)
    if dict(df.dtypes)[ts_col] == "string":
        ts = parse_time(ts)
    if day_col:
        span = (F.col(day_col) >= F.lit(first)) & (F.col(day_col) <= F.lit(today))
    else:
        at = lambda d: F.lit(d.isoformat()).cast("timestamp_ntz")
        span = (ts >= at(first)) & (ts < at(today + timedelta(days=1)))
    return df.filter(span).agg(F.max(ts).alias("latest"))


def jdbc_progress(spark: SparkSession, url: str, table: str, today: date, lookback_days: int, *, day_col: str = "dayTime",
                  ts_col: str = "collectTime", timeout_seconds: int = 120, **options: str) -> DataFrame:
    """``progress`` asked of the store itself: it is sent the range of days and the maximum, under a timeout of its own."""
    for c in (day_col, ts_col):
        table_name(c)
    first = today - timedelta(days=max(1, lookback_days) - 1)
    sql = f"SELECT MAX({ts_col}) AS latest FROM {table_name(table)} WHERE {day_col} >= '{first}' AND {day_col} <= '{today}'"
    return spark.read.format("jdbc").options(url=url, query=sql, queryTimeout=str(timeout_seconds), **options).load().toDF("latest")


def watermark(latest: Column, cfg: Config) -> Column:
    """End of the last window that is old enough to be stable."""
    held = latest - F.expr(f"interval {cfg.stable_delay_minutes} minutes")
    return floor_time(held.cast("timestamp_ntz"), cfg.window_minutes)


def safe_end(latest: datetime | None, cfg: Config) -> datetime | None:
    return None if latest is None else floor_datetime(latest - timedelta(minutes=max(0, cfg.stable_delay_minutes)), cfg.window_minutes)
