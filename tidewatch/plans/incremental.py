"""One window at a time: state in, alerts and new state out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import alerts as al
from ..operators import context as ctx
from ..operators import large, offhours, pairs, windows
from ..runtime import Scratch
from ..schema import CONTEXT, CONTEXT_STATE, PAIR, PAIR_STATE, STATS
from .backfill import Result


@dataclass
class State:
    """What a run knows before a window: pairs, context histograms, cursor and next log id."""

    pairs: DataFrame
    contexts: DataFrame
    cursor: datetime | None = None
    log_ids: str = ""

    @classmethod
    def empty(cls, spark: SparkSession) -> State:
        return cls(spark.createDataFrame([], PAIR_STATE), spark.createDataFrame([], CONTEXT_STATE))


def _stamp(t: datetime):
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def past_stats(contexts: DataFrame, day: date, cfg: Config) -> DataFrame:
    """Statistics of every known context for a day, from its capped histograms of earlier days."""
    kept = contexts.filter((F.col("day") < F.lit(day)) & (F.col("day") >= F.lit(day - timedelta(days=cfg.retention_days))))
    days = kept.groupBy(*CONTEXT).agg(F.count_distinct("day").alias("days"))
    stats = ctx.histogram_stats(kept.drop("day"), [*CONTEXT], cfg)
    return days.join(stats, [*CONTEXT]).withColumns({"usable": F.col("days") >= cfg.min_days, "day": F.lit(day)})


def run_window(metrics: DataFrame, start: datetime, state: State, cfg: Config) -> tuple[DataFrame, State]:
    """(alerts without ids, state after the window).

    Every candidate is tested against the state before the window; contexts
    learn from all rows, pairs from candidates; then states expire, in the
    order: contexts, pairs, context updates, pair updates, limit on pairs.
    """
    end, day = start + timedelta(minutes=cfg.window_minutes), start.date()
    rows = windows.assign(metrics, cfg).filter(F.col("win") == _stamp(start))
    parts, new = [], state
    if cfg.large_enabled:
        past = past_stats(state.contexts, day, cfg)
        d = ctx.effective(large.candidates(rows, cfg), ctx.window_stats(rows, cfg), past if cfg.context_enabled else None)
        ttl = F.expr(f"interval {cfg.ttl_days} days")
        known = state.pairs.select(*PAIR, "ema_bytes", "ema_pkts", "samples", "last_seen", "update_time", "update_order")
        d = d.join(known, [*PAIR], "left")
        live = F.col("last_seen").isNotNull() & ~(F.col("last_seen") < (F.col("collect_time") - ttl))
        mature = F.lit(cfg.pair_enabled) & live & (F.col("samples") >= cfg.min_samples)
        judged = large.judge(d, cfg, F.coalesce(mature, F.lit(False)), F.col("ema_bytes"), F.col("ema_pkts"))
        parts.append(al.large_alerts(large.best_alerts(judged)))
        new = replace(new, contexts=_learn_contexts(rows, state.contexts, past, day, end, cfg) if cfg.context_enabled else state.contexts,
                      pairs=_learn_pairs(large.learning_plan(judged, cfg), known, start, end, cfg) if cfg.pair_enabled else state.pairs)
    if cfg.offhours_enabled:
        parts.append(al.off_hours_alerts(offhours.top_pairs(rows, cfg), cfg))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out, replace(new, cursor=end)


def _learn_contexts(rows: DataFrame, contexts: DataFrame, past: DataFrame, day: date, end: datetime, cfg: Config) -> DataFrame:
    hist = ctx.day_histograms(rows, cfg)
    caps = past.select(*CONTEXT, "days", *[F.col(s) for s in STATS if s.startswith("high")])
    high = F.when(F.col("measure") == "bytes", F.col("high_bytes")).otherwise(F.col("high_pkts"))
    held = hist.join(caps, [*CONTEXT], "left").withColumn(
        "value", F.when((F.col("days") > 0) & (high > 0), F.least("value", high)).otherwise(F.col("value")))
    kept = contexts.filter(F.col("day") >= F.lit(end.date() - timedelta(days=cfg.retention_days)))
    cols = [*CONTEXT, "day", "measure", "value", "n"]
    return kept.select(*cols).unionByName(held.select(*cols)).groupBy(*cols[:-1]).agg(F.sum("n").alias("n"))


def _learn_pairs(plan: DataFrame, known: DataFrame, start: datetime, end: datetime, cfg: Config) -> DataFrame:
    kept = pairs.expire(known, end.isoformat(sep=" "), cfg.ttl_days)
    a = cfg.alpha
    taught = plan.filter("plan != 'SKIP'").groupBy(*PAIR).agg(F.sort_array(F.collect_list(F.struct(  # candidates of one window: bounded by the capacity
        "collect_time", (-F.col("total_bytes")).alias("o"), "row_id", F.col("learn_bytes").cast("double").alias("b"), F.col("learn_pkts").cast("double").alias("p")))).alias("xs"))
    d = kept.join(taught, [*PAIR], "full_outer")
    fold = lambda old, k: F.when(F.col("xs").isNull(), F.col(old)).otherwise(F.aggregate(
        F.when(F.col(old).isNull(), F.slice("xs", F.lit(2), F.size("xs"))).otherwise(F.col("xs")),
        F.coalesce(F.col(old), F.col("xs")[0][k]), lambda e, s: e * (1 - a) + s[k] * a))
    last = F.element_at("xs", -1)
    out = d.select(*PAIR, fold("ema_bytes", "b").alias("ema_bytes"), fold("ema_pkts", "p").alias("ema_pkts"),
                   (F.coalesce("samples", F.lit(0)) + F.coalesce(F.when(F.col("xs").isNotNull(), F.size("xs")), F.lit(0))).cast("bigint").alias("samples"),
                   F.greatest("last_seen", last["collect_time"]).alias("last_seen"),
                   F.when(F.col("xs").isNotNull(), _stamp(start)).otherwise(F.col("update_time")).alias("update_time"),
                   F.coalesce(last["row_id"], F.col("update_order")).alias("update_order"))
    return pairs.evict(out, cfg.max_pairs)


def run_range(metrics: DataFrame, cfg: Config, on_window: Callable[[datetime, DataFrame], None] | None = None,
              state: State | None = None, windows_: list[datetime] | None = None) -> Result:
    """All windows of ``metrics`` in order, state kept between them in scratch tables."""
    spark = metrics.sparkSession
    scratch = Scratch(spark)
    rows = windows.assign(metrics, cfg)
    state = state or State.empty(spark)
    if windows_ is None:
        windows_ = [r["win"] for r in rows.select("win").distinct().orderBy("win").collect()]
    paths, given, schema = [], state, None
    for start in windows_:
        found, new = run_window(metrics, start, state, cfg)
        found, old = scratch.cut(found), state
        state = replace(state, pairs=scratch.cut(new.pairs), contexts=scratch.cut(new.contexts), cursor=new.cursor)
        if old is not given:
            scratch.drop(old.pairs, old.contexts)
        if on_window:
            on_window(start, found)
        paths, schema = [*paths, found._scratch_path], found.schema
    # one scan of all windows' tables, however many there are
    out = spark.read.schema(schema).parquet(*paths) if paths else run_window(metrics, datetime(1970, 1, 1), state, cfg)[0]
    return Result(out, state.pairs, state.contexts, windows.summary(rows), "sequential")
