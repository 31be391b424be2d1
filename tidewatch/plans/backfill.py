"""A whole range of dates in a fixed number of jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..operators import alerts as al
from ..operators import context as ctx
from ..operators import large, offhours, pairs, windows
from ..schema import PAIR


@dataclass
class Result:
    alerts: DataFrame  # without ids
    pair_state: DataFrame
    histograms: DataFrame
    summary: DataFrame
    mode: str  # "parallel", or "sequential" where the pair limit couples pairs


def large_parts(rows: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(fold over all pairs with alerts and states, day histograms)."""
    hist = ctx.day_histograms(rows, cfg)
    past = ctx.history_capped(hist, cfg) if cfg.context_enabled else None
    judgeable = ctx.effective(large.candidates(rows, cfg), ctx.window_stats(rows, cfg), past)
    return pairs.chain(judgeable, cfg), hist


def alerts_of(fold: DataFrame) -> DataFrame:
    return fold.filter("kind = 'alert'").drop("kind", "ema_bytes", "ema_pkts", "samples", "last_seen", "update_time", "update_order")


def states_of(fold: DataFrame) -> DataFrame:
    return fold.filter("kind = 'state'").select(*PAIR, "ema_bytes", "ema_pkts", "samples", "last_seen", "update_time", "update_order")


def all_alerts(rows: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(alerts of the enabled rules, pair states, day histograms), however many pairs there are."""
    parts, states, hist = [], None, None
    if cfg.large_enabled:
        fold, hist = large_parts(rows, cfg)
        parts.append(al.large_alerts(alerts_of(fold)))
        states = states_of(fold)
    if cfg.offhours_enabled:
        parts.append(al.off_hours_alerts(offhours.top_pairs(rows, cfg), cfg))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), states, hist


def run_backfill(metrics: DataFrame, cfg: Config) -> Result:
    """Alerts of both rules over normalised metrics, windows without rows passed over.

    Candidates, statistics of windows and histograms of days are each one
    aggregation over all windows; past statistics recur per context over
    histograms; pairs fold in parallel. The only thing that couples pairs is
    the limit on their number: if more pairs than ``max_pairs`` appear at
    all, the exact result needs the run window by window, which is taken.
    """
    rows = windows.assign(metrics, cfg)
    if cfg.large_enabled and cfg.pair_enabled:
        def pairs_of(d: DataFrame) -> int:
            return d.select(*PAIR).distinct().limit(cfg.max_pairs + 1).count()

        # pairs of all rows bound those of candidates and need no ranking
        if pairs_of(rows) > cfg.max_pairs and pairs_of(large.candidates(rows, cfg)) > cfg.max_pairs:
            from .incremental import run_range

            return run_range(metrics, cfg)
    return Result(*all_alerts(rows, cfg), windows.summary(rows), "parallel")


def reason_counts(fold: DataFrame) -> DataFrame:
    return alerts_of(fold).groupBy("anomaly_reason", "baseline_from").agg(F.count(F.lit(1)).alias("alerts"))
