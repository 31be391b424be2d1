"""Flow metrics made of general event and order tables, by integer arithmetic that SQL engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_events(spark: SparkSession, sf_dir: str, spread: int = 16) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = e.select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                 F.round(F.col("value") * 1000).cast("bigint").alias("b"))
    return e.select(
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("collect_time"),
        F.expr("concat('10.0.', user_id div 256, '.', user_id % 256)").alias("src_ip"),
        F.expr(f"concat('172.16.0.', k % {spread})").alias("dst_ip"), F.upper("event_type").alias("protocol"),
        F.expr("1 + k % 7").alias("conn_count"), F.expr("(1 + b div 1400) div 2").alias("c2s_pkts"),
        F.expr("(1 + b div 1400) - (1 + b div 1400) div 2").alias("s2c_pkts"), F.expr("b div 3").alias("c2s_bytes"),
        F.expr("b - b div 3").alias("s2c_bytes"), F.col("event_id").alias("row_id"))


def from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For benchmarks: supplier to part, return flag as protocol, bytes from price."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    minutes = F.expr("make_dt_interval(0, 0, cast((l_orderkey * 7 + l_linenumber * 131) % 1440 as int), 0)")
    b = F.round(F.col("l_extendedprice")).cast("bigint")
    return li.select(
        (F.col("l_shipdate") + minutes).cast("timestamp_ntz").alias("collect_time"),
        F.concat(F.lit("s"), "l_suppkey").alias("src_ip"), F.concat(F.lit("p"), F.expr("l_partkey % 100")).alias("dst_ip"),
        F.col("l_returnflag").alias("protocol"), F.col("l_quantity").cast("bigint").alias("conn_count"),
        F.lit(1).cast("bigint").alias("c2s_pkts"), F.col("l_quantity").cast("bigint").alias("s2c_pkts"),
        F.lit(0).cast("bigint").alias("c2s_bytes"), b.alias("s2c_bytes"), F.expr("l_orderkey * 8 + l_linenumber").alias("row_id"))


#: The same view of events in SQL; {spread} as above.
EVENTS_SQL = """m0 AS (
  SELECT date_trunc('second', ts)::TIMESTAMP AS collect_time,
         '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src_ip, '172.16.0.' || (k % {spread}) AS dst_ip,
         upper(event_type) AS protocol, 1 + k % 7 AS conn_count, (1 + b // 1400) // 2 AS c2s_pkts,
         (1 + b // 1400) - (1 + b // 1400) // 2 AS s2c_pkts, b // 3 AS c2s_bytes, b - b // 3 AS s2c_bytes, event_id AS row_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(round(value * 1000) AS BIGINT) AS b FROM events)),
m AS (SELECT *, c2s_bytes + s2c_bytes AS total_bytes, c2s_pkts + s2c_pkts AS total_pkts,
             time_bucket(INTERVAL {minutes} MINUTE, collect_time) AS win, CAST(collect_time AS DATE) AS day,
             coalesce(nullif(trim(protocol), ''), 'UNKNOWN') AS context_protocol,
             CASE WHEN isodow(collect_time) >= 6 THEN 'WEEKEND' ELSE 'WORKDAY' END AS day_type,
             CAST((hour(collect_time) * 60 + minute(collect_time)) // {minutes} AS INTEGER) AS slot FROM m0)"""
