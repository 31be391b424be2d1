"""Sketches: weighted Space-Saving, Count-Min, KLL quantiles and built-in top-k."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Config
from ..functions import LONG_MAX, saturating_sum
from ..runtime import ship
from ..schema import PAIR


class SpaceSaving:
    """Weighted Space-Saving: ``capacity`` counters; a new key in a full sketch
    takes over the least counter and what that had counted, as its error."""

    def __init__(self, capacity: int) -> None:
        if capacity <= 0:
            raise ValueError("capacity must be positive")
        self.capacity, self.at, self.heap, self.tick = capacity, {}, [], 0

    def add(self, key, weight: int, when=None) -> None:
        if key is None or weight <= 0:
            return
        held = self.at.get(key)
        if held:
            held[0] = min(LONG_MAX, held[0] + weight)
            held[2] = when if held[2] is None else max(held[2], when) if when is not None else held[2]
        elif len(self.at) < self.capacity:
            held = self.at[key] = [weight, 0, when]
        else:
            least = self._least()
            old = self.at.pop(least)
            held = self.at[key] = [min(LONG_MAX, old[0] + weight), old[0], when]
        self.tick += 1
        heapq.heappush(self.heap, (held[0], self.tick, key))
        if len(self.heap) > 8 * self.capacity + 64:
            self.heap = [(v[0], i, k) for i, (k, v) in enumerate(self.at.items())]
            heapq.heapify(self.heap)
            self.tick = len(self.heap)

    def _least(self):
        while True:  # entries of counters that have grown or gone are stale
            n, _, key = heapq.heappop(self.heap)
            if key in self.at and self.at[key][0] == n:
                return key

    def lower_bound(self, key) -> int:
        """What the key has been given for certain."""
        held = self.at.get(key)
        return max(0, held[0] - held[1]) if held else 0

    def merge(self, other: SpaceSaving) -> None:
        """Add the other sketch's estimates as weights."""
        for key, (n, _, when) in sorted(other.at.items(), key=lambda kv: (-kv[1][0], str(kv[0]))):
            self.add(key, n, when)

    def top(self, n: int) -> list[tuple[object, int, int, object]]:
        """(key, estimate, error, last time), the largest estimates first, ties by key."""
        best = sorted(self.at.items(), key=lambda kv: (-kv[1][0], str(kv[0])))[:n]
        return [(k, v[0], v[1], v[2]) for k, v in best]


def heavy_hitters(rows: DataFrame, cfg: Config, parts: int = 8) -> DataFrame:
    """Top pairs of each window by Space-Saving in bounded memory.

    Rows are added up by window and pair first, map-side combined. The pairs
    of a window are dealt by hash to ``parts`` sketches of ``sketch_capacity``
    counters, each fed in the order of another hash, so the result does not
    depend on how the input is partitioned, and a task holds one sketch at a
    time. A pair is in one sketch only: its estimate never falls short of
    the truth, estimate - error never exceeds it, and of a sketch given w in
    all, every pair above w / capacity is kept. Exact while no sketch is full.
    """
    ship(rows.sparkSession)
    cap = cfg.sketch_capacity

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sketch, out = None, None, []

        def close() -> None:
            if sketch:
                out.extend((at[0], *k, n, e, t) for k, n, e, t in sketch.top(cap))

        for p in batches:
            for w, part, *pair, n, t in zip(p["win"], p["part"], *(p[c] for c in PAIR), p["conns"], p["collect_time"]):
                if (w, part) != at:
                    close()
                    at, sketch = (w, part), SpaceSaving(cap)
                sketch.add(tuple(pair), int(n), t)
            yield pd.DataFrame(out, columns=["win", *PAIR, "estimate", "error", "collect_time"])
            out = []
        close()
        yield pd.DataFrame(out, columns=["win", *PAIR, "estimate", "error", "collect_time"])

    kinds = "win timestamp_ntz, src_ip string, dst_ip string, protocol string, estimate bigint, error bigint, collect_time timestamp_ntz"
    totals = rows.filter(F.col("is_off_hours") & (F.col("conn_count") > 0)).groupBy("win", *PAIR).agg(
        saturating_sum(F.col("conn_count")).alias("conns"), F.max("collect_time").alias("collect_time"))
    dealt = totals.withColumns({"part": F.pmod(F.xxhash64(F.lit(1), *PAIR), F.lit(parts)).cast("int"), "turn": F.xxhash64(F.lit(2), *PAIR)})
    kept = dealt.repartition("win", "part").sortWithinPartitions("win", "part", "turn", *PAIR).mapInPandas(local, kinds)
    order = W.partitionBy("win").orderBy(F.col("estimate").desc(), *PAIR)
    return kept.withColumn("top_rank", F.row_number().over(order)).filter(F.col("top_rank") <= cfg.topn)


def count_min(rows: DataFrame, key: str, eps: float = 0.001, confidence: float = 0.99, seed: int = 1) -> bytes:
    """Serialised Count-Min sketch of a string column's row counts, merged map-side."""
    return rows.agg(F.count_min_sketch(key, F.lit(eps), F.lit(confidence), F.lit(seed)).alias("s")).first()["s"]


class CountMin:
    """Count-Min sketch with weights, estimates and merging; estimates never fall short."""

    def __init__(self, depth: int = 5, width: int = 4096) -> None:
        import numpy as np

        if depth <= 0 or width <= 0:
            raise ValueError("depth and width must be positive")
        self.depth, self.width, self.table = depth, width, np.zeros((depth, width), np.int64)

    def _columns(self, key: str) -> list[int]:
        import hashlib

        d = hashlib.blake2b(str(key).encode(), digest_size=16).digest()
        a, b = int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little") | 1
        return [(a + i * b) % 2**64 % self.width for i in range(self.depth)]

    def add(self, key: str, weight: int = 1) -> None:
        if weight > 0:
            for i, c in enumerate(self._columns(key)):
                self.table[i, c] = min(LONG_MAX, int(self.table[i, c]) + weight)

    def estimate(self, key: str) -> int:
        return int(min(self.table[i, c] for i, c in enumerate(self._columns(key))))

    def merge(self, other: CountMin) -> None:
        if (self.depth, self.width) != (other.depth, other.width):
            raise ValueError("sketches differ in shape")
        import numpy as np

        total = self.table + other.table  # wraps below zero where it overflows
        self.table = np.where(total < 0, LONG_MAX, total)


def _cells(pair: str, depth: int, width: int) -> Column:
    """A pair's column in each row of the table: the first 32 bits of MD5(row:pair), which any engine can repeat."""
    one = lambda i: F.conv(F.substring(F.md5(F.concat(F.lit(f"{i}:"), F.col(pair))), 1, 8), 16, 10).cast("bigint") % width
    return F.posexplode(F.array(*map(one, range(depth)))).alias("row", "col")


def count_min_table(rows: DataFrame, depth: int = 5, width: int = 4096) -> DataFrame:
    """Connections added up into ``depth`` * ``width`` counters at most, map-side
    combined, so nothing grows with the number of pairs; tables merge by adding."""
    d = rows.select(F.concat_ws("|", *PAIR).alias("pair"), F.col("conn_count").alias("w"))
    return d.select("w", _cells("pair", depth, width)).groupBy("row", "col").agg(F.sum("w").alias("count"))


def count_min_estimates(pairs: DataFrame, table: DataFrame, depth: int = 5, width: int = 4096) -> DataFrame:
    """Estimated connections of the given distinct pairs: the least of their counters, never less than the truth."""
    cells = pairs.select("pair", _cells("pair", depth, width))
    return cells.join(F.broadcast(table), ["row", "col"]).groupBy("pair").agg(F.min("count").alias("estimate"))


def kll_window_stats(rows: DataFrame, cfg: Config, k: int = 200) -> DataFrame:
    """P50, P90 and the high quantile of bytes per window and context from mergeable KLL sketches."""
    from ..schema import CONTEXT

    s = rows.groupBy("win", *CONTEXT).agg(F.expr(f"kll_sketch_agg_bigint(total_bytes, {k})").alias("s"), F.count(F.lit(1)).alias("n"))
    q = lambda x: F.expr(f"kll_sketch_get_quantile_bigint(s, {x}D)")
    return s.select("win", *CONTEXT, "n", q(0.5).alias("p50_bytes"), q(0.9).alias("p90_bytes"), q(cfg.bytes_quantile).alias("high_bytes"))


def approx_top_pairs(rows: DataFrame, cfg: Config, tracked: int = 10_000) -> DataFrame:
    """Most frequent pairs of each window by Spark's own top-k sketch (row counts)."""
    d = rows.filter("is_off_hours").select("win", F.concat_ws("|", *PAIR).alias("pair"))
    top = d.groupBy("win").agg(F.expr(f"approx_top_k(pair, {cfg.topn}, {tracked})").alias("t"))
    return top.select("win", F.posexplode("t").alias("pos", "x")).select("win", (F.col("pos") + 1).alias("top_rank"), "x.item", "x.count")
