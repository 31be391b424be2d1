"""Contexts: distributions of current windows and of past days."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import quantile_round
from ..runtime import ship
from ..schema import CONTEXT, STATS


def disc(q: float, column: str) -> Column:
    return quantile_round(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})").cast("double"))


def window_stats(rows: DataFrame, cfg: Config) -> DataFrame:
    """P50, P90 and the high quantile of bytes and packets per window and context.

    Merged map-side; values are rounded to ``histogram_digits`` first, which
    bounds what a context holds, unless that is None.
    """
    rows = rows.select("win", *CONTEXT, *[rounded(F.col(c), cfg).alias(c) for c in ("total_bytes", "total_pkts")])
    aggs = [disc(q, c).alias(f"{name}_{m}") for m, c, high in (("bytes", "total_bytes", cfg.bytes_quantile), ("pkts", "total_pkts", cfg.pkts_quantile))
            for name, q in (("p50", 0.5), ("p90", 0.9), ("high", high))]
    return rows.groupBy("win", *CONTEXT).agg(F.count(F.lit(1)).alias("n"), *aggs)


def rounded(c: Column, cfg: Config) -> Column:
    """The value, or its first ``histogram_digits`` digits and zeros."""
    if cfg.histogram_digits is None:
        return c
    unit = F.pow(F.lit(10.0), F.greatest(F.length(c.cast("string")) - cfg.histogram_digits, F.lit(0))).cast("bigint")
    return F.when(c > 0, c - c % unit).otherwise(c)


def day_histograms(rows: DataFrame, cfg: Config) -> DataFrame:
    """Counts of values per context and day, both measures in one pass: (context, day, measure, value, n).
    Histograms merge by adding, so windows of a day, and days, fold without the rows."""
    both = F.explode(F.array(F.struct(F.lit("bytes").alias("measure"), rounded(F.col("total_bytes"), cfg).alias("value")),
                             F.struct(F.lit("pkts").alias("measure"), rounded(F.col("total_pkts"), cfg).alias("value"))))
    return (rows.select(*CONTEXT, "day", both.alias("x")).select(*CONTEXT, "day", "x.measure", "x.value")
            .groupBy(*CONTEXT, "day", "measure", "value").agg(F.count(F.lit(1)).alias("n")))


def histogram_stats(hist: DataFrame, keys: list[str], cfg: Config) -> DataFrame:
    """Quantiles of histograms by a running sum over values; a row per key."""
    order = W.partitionBy(*keys, "measure").orderBy("value")
    h = hist.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    h = h.select("*", F.sum("n").over(order).alias("upto"), F.sum("n").over(W.partitionBy(*keys, "measure")).alias("all"))
    at = lambda q: F.ceil(F.lit(q) * F.col("all"))
    pick = lambda m, q: F.coalesce(F.min(F.when((F.col("measure") == m) & (F.col("upto") >= at(q)), F.col("value"))), F.lit(0).cast("bigint"))
    aggs = [F.greatest(pick(m, q), F.lit(0).cast("bigint")).alias(f"{name}_{m}") for m, high in (("bytes", cfg.bytes_quantile), ("pkts", cfg.pkts_quantile))
            for name, q in (("p50", 0.5), ("p90", 0.9), ("high", high))]
    return h.groupBy(*keys).agg(*aggs)


def history_uncapped(hist: DataFrame, cfg: Config) -> DataFrame:
    """Statistics of the days before each day, within the retention, without capping.

    Instead of a range join each day's histogram is dealt to the days it
    counts for, so all is one aggregation by (context, day); only days on
    which the context was seen are kept.
    """
    def later(d: DataFrame) -> DataFrame:
        k = F.explode(F.sequence(F.lit(1), F.lit(cfg.retention_days))).alias("k")
        return d.select("*", k).withColumn("day", F.date_add("day", F.col("k"))).drop("k")

    keys = [*CONTEXT, "day"]
    seen = hist.select(*keys).distinct()
    days = later(seen).groupBy(*keys).agg(F.count(F.lit(1)).alias("days")).join(seen, keys, "left_semi")
    # one shuffle by (context, day) serves the join, the running sums and the result
    dealt = later(hist).repartition(*keys).join(days, keys)
    return histogram_stats(dealt, [*keys, "days"], cfg).withColumn("usable", F.col("days") >= cfg.min_days)


def quantile(counts: dict[int, int], q: float) -> int:
    """percentile_disc of a histogram; 0 if it is empty."""
    total = sum(counts.values())
    need, upto = math.ceil(q * total), 0
    for v in sorted(counts):
        upto += counts[v]
        if upto >= need:
            return max(0, v)
    return 0


class DayRecursion:
    """A context's buckets of the retained days, each capped by the threshold of its own day."""

    def __init__(self, cfg: Config) -> None:
        self.cfg, self.buckets = cfg, {}

    def stats(self, day: int) -> tuple[int, dict[str, int]]:
        """(contributing days, statistics) for a day, from the days before it that are retained."""
        self.buckets = {d: b for d, b in self.buckets.items() if d >= day - self.cfg.retention_days}
        past = [b for d, b in self.buckets.items() if d < day]
        out = {}
        for m, high in (("bytes", self.cfg.bytes_quantile), ("pkts", self.cfg.pkts_quantile)):
            merged: dict[int, int] = {}
            for b in past:
                for v, n in b[m].items():
                    merged[v] = merged.get(v, 0) + n
            out |= {f"p50_{m}": quantile(merged, 0.5), f"p90_{m}": quantile(merged, 0.9), f"high_{m}": quantile(merged, high)}
        return len(past), out

    def learn(self, day: int, measure: str, values: dict[int, int], days: int, threshold: int) -> None:
        """Add a day's values; from the first past day on they are held to the threshold, which commutes with quantiles."""
        bucket = self.buckets.setdefault(day, {"bytes": {}, "pkts": {}})[measure]
        for v, n in values.items():
            v = min(v, threshold) if days and threshold > 0 else v
            bucket[v] = bucket.get(v, 0) + n


def history_capped(hist: DataFrame, cfg: Config) -> DataFrame:
    """Statistics for each day on which a context was seen, from earlier days'
    capped histograms. The day by day recursion runs per context over
    histograms, never over rows; contexts run in parallel. Rows reach a task
    sorted by context and day and are folded as they come, so a task holds
    one context's retained days: with ``histogram_digits`` of 3 some 11 000
    values a day and measure at most, whatever the number of rows. Where it is
    None, nearly every row's value is its own and the days are as large as
    they come, which is for small tables."""
    ship(hist.sparkSession)
    keys = [*CONTEXT]
    schema = f"context_protocol string, day_type string, slot int, day date, days int, {', '.join(f'{s} bigint' for s in STATS)}"
    epoch = pd.Timestamp("1970-01-01").date()

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context, day, values, rec, out = None, None, {}, None, []

        def close() -> None:
            if day is None:
                return
            d = (day - epoch).days
            days, s = rec.stats(d)
            out.append((*context, day, days, *[s[x] for x in STATS]))
            for m in ("bytes", "pkts"):
                rec.learn(d, m, values.get(m, {}), days, s[f"high_{m}"])

        for p in batches:
            for p_, t, s, d, m, v, n in zip(p["context_protocol"], p["day_type"], p["slot"], p["day"], p["measure"], p["value"], p["n"]):
                if (p_, t, s) != context or d != day:
                    close()
                    values = {}
                    if (p_, t, s) != context:
                        context, rec = (p_, t, s), DayRecursion(cfg)
                    day = d
                values.setdefault(m, {})[v] = n
            yield pd.DataFrame(out, columns=[*keys, "day", "days", *STATS])
            out = []
        close()
        yield pd.DataFrame(out, columns=[*keys, "day", "days", *STATS])

    ordered = hist.repartition(*keys).sortWithinPartitions(*keys, "day", "measure", "value")
    return ordered.mapInPandas(fold, schema).withColumn("usable", F.col("days") >= cfg.min_days)


def effective(candidates: DataFrame, current: DataFrame, history: DataFrame | None) -> DataFrame:
    """Candidates with the statistics of their context: of the past if usable, else of the window."""
    cur = current.select("win", *CONTEXT, *[F.col(s).alias(f"cur_{s}") for s in STATS])
    d = candidates.join(cur, ["win", *CONTEXT], "left")
    if history is None:
        return d.select(*candidates.columns, F.lit("CURRENT").alias("stats_from"), *[F.col(f"cur_{s}").alias(s) for s in STATS])
    past = history.select(*CONTEXT, "day", "usable", *[F.col(s).alias(f"past_{s}") for s in STATS])
    d = d.join(past, [*CONTEXT, "day"], "left").withColumn("usable", F.coalesce("usable", F.lit(False)))
    return d.select(*[F.col(c) for c in candidates.columns], F.when(F.col("usable"), "HISTORY").otherwise("CURRENT").alias("stats_from"),
                    *[F.when(F.col("usable"), F.col(f"past_{s}")).otherwise(F.col(f"cur_{s}")).alias(s) for s in STATS])
