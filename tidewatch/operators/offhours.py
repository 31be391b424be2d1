"""Type 3, off hours: the connections of most activity outside of working hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import saturating_sum
from ..schema import PAIR


def pair_totals(rows: DataFrame) -> DataFrame:
    """Connections and last time of each pair in a window, off-hours rows with any connection only."""
    return (rows.filter(F.col("is_off_hours") & (F.col("conn_count") > 0)).groupBy("win", *PAIR)
            .agg(saturating_sum(F.col("conn_count")).alias("conns"), F.max("collect_time").alias("collect_time")))


def top_pairs(rows: DataFrame, cfg: Config) -> DataFrame:
    """The ``topn`` pairs of each window, ranked from 1; exact, so equal to a
    bounded sketch wherever that one is not full. Ties by time, then pair."""
    order = W.partitionBy("win").orderBy(F.col("conns").desc(), "collect_time", *PAIR)
    return pair_totals(rows).withColumn("top_rank", F.row_number().over(order)).filter(F.col("top_rank") <= cfg.topn)
