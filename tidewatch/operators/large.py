"""Type 2, large traffic: candidates, thresholds, verdict and what is learned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import learning_cap, positive_round, total_order
from ..schema import PAIR


def candidates(rows: DataFrame, cfg: Config) -> DataFrame:
    """The ``candidate_capacity`` rows of most bytes in each window, over all
    contexts. The limit on row_number is applied before the shuffle too, so a
    window sends no more than its capacity from each task."""
    rank = F.row_number().over(W.partitionBy("win").orderBy(*total_order()))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= cfg.candidate_capacity).drop("rank")


def judge(d: DataFrame, cfg: Config, mature: Column, ema_bytes: Column, ema_pkts: Column) -> DataFrame:
    """Baselines, thresholds and the verdict for candidates with statistics of their context."""
    base_b = F.when(mature, positive_round(ema_bytes, F.col("p50_bytes"))).otherwise(F.col("p50_bytes"))
    base_p = F.when(mature, positive_round(ema_pkts, F.col("p50_pkts"))).otherwise(F.col("p50_pkts"))
    d = d.withColumns({"mature": mature, "baseline_bytes": base_b, "baseline_pkts": base_p})
    d = d.withColumns({
        "bytes_threshold": F.greatest(F.col("high_bytes").cast("double"), F.col("baseline_bytes") * F.lit(cfg.bytes_multiplier)),
        "pkts_threshold": F.greatest(F.col("high_pkts").cast("double"), F.col("baseline_pkts") * F.lit(cfg.pkts_multiplier)),
        "extreme_bytes_threshold": F.col("high_bytes").cast("double") * F.lit(cfg.extreme_multiplier)})
    pkts = F.col("total_pkts") > F.col("pkts_threshold")
    extreme = F.col("total_bytes") > F.col("extreme_bytes_threshold")
    hit = (F.col("high_bytes") > 0) & (F.col("total_bytes") > F.col("bytes_threshold")) & (pkts | extreme)
    return d.withColumns({"is_anomaly": F.coalesce(hit, F.lit(False)),
                          "anomaly_reason": F.when(pkts, "BYTES_AND_PKTS").otherwise("EXTREME_BYTES")})


def best_alerts(judged: DataFrame) -> DataFrame:
    """One alert per pair and window: the anomalous candidate of most bytes."""
    rank = F.row_number().over(W.partitionBy("win", *PAIR).orderBy(*total_order()))
    return judged.filter("is_anomaly").withColumn("rank", rank).filter("rank = 1").drop("rank")


def cold_start(rows: DataFrame, cfg: Config, history: DataFrame | None = None) -> DataFrame:
    """Alerts from contexts alone, without pairs' own averages."""
    from .context import effective, window_stats

    d = effective(candidates(rows, cfg), window_stats(rows, cfg), history)
    nothing = F.lit(None).cast("double")
    return best_alerts(judge(d, cfg, F.lit(False), nothing, nothing))


def learning_plan(judged: DataFrame, cfg: Config) -> DataFrame:
    """What each candidate teaches its pair: plan NORMAL, CAPPED_BOOTSTRAP or
    SKIP, learn_bytes and learn_pkts (null for SKIP). All candidates of a pair
    in a window share a plan; the cap is that of the last anomalous one."""
    pair = W.partitionBy("win", *PAIR)
    cap = F.when(F.col("is_anomaly") & ~F.col("mature") & F.lit(cfg.capped_learning), F.struct(
        F.col("collect_time"), F.col("row_id"),
        learning_cap(F.col("high_bytes"), F.col("baseline_bytes"), F.col("total_bytes")).alias("b"),
        learning_cap(F.col("high_pkts"), F.col("baseline_pkts"), F.col("total_pkts")).alias("p")))
    d = judged.withColumns({"pair_anomalous": F.max("is_anomaly").over(pair), "cap": F.max(cap).over(pair)})
    plan = F.when(~F.col("pair_anomalous"), "NORMAL").when(F.col("cap").isNotNull(), "CAPPED_BOOTSTRAP").otherwise("SKIP")
    d = d.withColumn("plan", plan)
    held = lambda c, k: (F.when(F.col("plan") == "NORMAL", F.col(c))
                         .when(F.col("plan") == "CAPPED_BOOTSTRAP", F.least(F.col(c), F.col(f"cap.{k}"))))
    return d.withColumns({"learn_bytes": held("total_bytes", "b"), "learn_pkts": held("total_pkts", "p")})
