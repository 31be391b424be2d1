"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, pick, positional, read, ship

#: Words of the shortest tile, and share of an item's words under tiles from which a document counts as contaminated.
LEAST, COVERAGE = 5, 0.5
#: Benchmark words that one pass over the documents broadcasts at most; a larger benchmark takes more passes.
PASS_WORDS = 2_000_000

_WORDS = re.compile(r"\w+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _mixed(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


class Rolled:
    """Karp-Rabin hashes (mod 2**64) of all windows of any length of a sequence: sums of
    words times powers of an odd base, from which a window's is a difference."""

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        with np.errstate(over="ignore"):
            up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _MUL))]).astype(np.uint64)
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _INVERSE))]).astype(np.uint64)
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(ids) * up[:n], dtype=np.uint64)])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    return Rolled(ids).windows(size)


def _open(free: np.ndarray, size: int) -> np.ndarray:
    """Places at which a window of ``size`` is free."""
    n = len(free) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    run = np.concatenate([[0], np.cumsum(free)])
    return np.flatnonzero(run[size:] - run[:n] == size)


def tile(doc: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two id sequences: (start, item start, words).

    The longest match of unmarked words is marked first, at the first place of
    the document and then of the item on a tie, until none of ``least`` words
    is left. Running Karp-Rabin: a length has a match if free windows of both
    sides share a hash, so the longest is found by halving; all matches of
    that length are marked in one run over both sides' places, and the next
    length is shorter. There are at most as many lengths as distinct ones add
    up to the item, the square root of twice its words, and each costs
    n log n, whatever repeats. No word of either side is in two tiles.
    """
    free_d, free_p = np.ones(len(doc), bool), np.ones(len(item), bool)
    roll_d, roll_p = Rolled(doc), Rolled(item)
    tiles: list[tuple[int, int, int]] = []

    def matches(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Free places of both sides whose windows come on the other one, and their hashes."""
        i, j = _open(free_d, size), _open(free_p, size)
        hi, hj = roll_d.windows(size)[i], roll_p.windows(size)[j]
        both = np.intersect1d(hi, hj)
        if not len(both):
            return i[:0], j[:0], hi[:0], hj[:0]
        at_i, at_j = np.isin(hi, both), np.isin(hj, both)
        return i[at_i], j[at_j], hi[at_i], hj[at_j]

    low, high = least, min(len(doc), len(item))
    while low <= high:
        lo, hi, best = low, high, None
        while lo <= hi:
            size = (lo + hi + 1) // 2
            found = matches(size)
            if len(found[0]):
                best, lo = (size, found), size + 1
            else:
                hi = size - 1
        if best is None:
            break
        size, (at_d, at_p, hash_d, hash_p) = best
        by: dict[int, deque[int]] = {}
        for j, h in zip(at_p.tolist(), hash_p.tolist()):
            by.setdefault(h, deque()).append(j)
        done, k = 0, 0
        while k < len(at_d) and by:
            i, h = int(at_d[k]), int(hash_d[k])
            places = by.get(h)
            while places and not free_p[places[0]:places[0] + size].all():
                places.popleft()  # a word marked once stays marked
            if not places:
                by.pop(h, None)
                k += 1
                continue
            j = places.popleft()
            if not np.array_equal(doc[i:i + size], item[j:j + size]):  # hashes collide
                k += 1
                continue
            free_d[i:i + size] = free_p[j:j + size] = False
            tiles.append((i, j, size))
            done = i + size
            k = int(np.searchsorted(at_d, done))
        high = size - 1
    return sorted(tiles)


class Bench:
    """A part of the benchmark: its vocabulary, items as ids, and its seeds."""

    def __init__(self, items: list[tuple[object, list[str]]], least: int) -> None:
        self.least, self.vocabulary = least, {w: i + 1 for i, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
        self.items = [(k, np.array([self.vocabulary[w] for w in ws], np.int64)) for k, ws in items]
        hashes = [window_hashes(x, least) for _, x in self.items]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        order = np.lexsort((owner, flat))
        flat, owner = flat[order], owner[order]
        if len(flat):  # a seed that an item repeats counts once
            once = np.concatenate([[True], (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])])
            flat, owner = flat[once], owner[once]
        self.seeds, self.owner = flat, owner
        self.short: dict[int, dict[tuple[int, ...], list[object]]] = {}  # items without a seed: length, words, names
        for name, x in self.items:
            if len(x) < least:
                self.short.setdefault(len(x), {}).setdefault(tuple(x.tolist()), []).append(name)

    def matches(self, text: str | None, coverage: float) -> list[tuple[object, float, int, list[tuple[int, int, int]]]]:
        """(item, coverage, words covered, tiles) of the items whose coverage reaches the threshold."""
        ids = np.fromiter(map(self.vocabulary.get, ws := words(text), [0] * len(ws)), np.int64, len(ws))
        return self._whole(ids) + self._tiled(ids, coverage)

    def _whole(self, ids: np.ndarray) -> list[tuple[object, float, int, list[tuple[int, int, int]]]]:
        """Items shorter than a seed, where all their words come in a run: one tile, the first."""
        out = []
        for n, items in self.short.items():
            firsts = np.array(sorted({x[0] for x in items}), np.int64)
            met: dict[tuple[int, ...], int] = {}
            for p in np.flatnonzero(np.isin(ids[:max(0, len(ids) - n + 1)], firsts)).tolist():
                if (run := tuple(ids[p:p + n].tolist())) in items:
                    met.setdefault(run, p)
            out += [(name, 1.0, n, [(p, 0, n)]) for run, p in met.items() for name in items[run]]
        return out

    def _tiled(self, ids: np.ndarray, coverage: float) -> list[tuple[object, float, int, list[tuple[int, int, int]]]]:
        if len(ids) < self.least or not len(self.seeds):
            return []
        known = np.convolve(ids > 0, np.ones(self.least, int), "valid") == self.least
        at = np.flatnonzero(known)
        if not len(at):
            return []
        h = window_hashes(ids, self.least)[at]
        lo, hi = np.searchsorted(self.seeds, h, "left"), np.searchsorted(self.seeds, h, "right")
        hit = hi > lo
        if not hit.any():
            return []
        at, lo, hi = at[hit], lo[hit], hi[hit]
        n = hi - lo
        place = np.repeat(at, n)
        owner = self.owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.argsort(owner, kind="stable")
        place, owner = place[order], owner[order]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        out = []
        for o, starts in zip(owner[np.concatenate([[0], cuts])].tolist(), np.split(place, cuts)):
            name, item = self.items[o]
            # seeds bound what tiles can cover: most documents that share a phrase end here
            seeded = np.zeros(len(ids), bool)
            for k in range(self.least):
                seeded[starts + k] = True
            if seeded.sum() < coverage * len(item):
                continue
            where = np.flatnonzero(seeded)
            gap = np.flatnonzero(np.diff(where) > 1) + 1  # stretches apart, with a stop between them
            doc, place = np.insert(ids[where], gap, -1), np.insert(where, gap, -1)
            tiles = [(int(place[i]), j, n) for i, j, n in tile(doc, item, self.least)]
            covered = sum(n for _, _, n in tiles)
            if covered >= coverage * len(item):
                out.append((name, covered / len(item), covered, tiles))
        return out


def benchmark_parts(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", least: int = LEAST,
                    pass_words: int = PASS_WORDS) -> Iterator[Bench]:
    """Parts of the benchmark, one after another, each of ``pass_words`` words or one item at most.

    Items without words are left out.
    """
    ship(benchmark.sparkSession)
    held, size = [], 0
    for r in pick(benchmark, id=id_col, text=text_col).orderBy("id", "text").toLocalIterator():
        ws = words(r["text"])
        if not ws:
            continue
        if held and size + len(ws) > pass_words:
            yield Bench(held, least)
            held, size = [], 0
        held.append((r["id"], ws))
        size += len(ws)
    if held:
        yield Bench(held, least)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST,
                       coverage: float = COVERAGE, pass_words: int = PASS_WORDS) -> DataFrame:
    """A row per document row and item whose words the document's tiles cover to
    ``coverage`` or more: id, item, coverage, covered, tiles (start, item_start, words).

    Words are runs of letters, digits and underscores, in lower case. Shared
    runs of ``least`` words are the seeds that join documents to items; each
    pair is tiled over the stretches that have seeds, which is all that
    tiles can reach. Tiles need not keep the item's order, so reordered
    passages count. The whole text is read. The benchmark, not the corpus, is
    broadcast, in parts of ``pass_words`` words, a pass over the documents
    each; nothing is shuffled.

    Items of fewer than ``least`` words have no seed; they are found where all
    their words come in a run, so an item of one word is found in every
    document that holds it. Null and empty texts have no row, nor have items
    without words. Repeated rows give their pairs again; extra columns are
    ignored; empty tables give an empty result.
    """
    d = pick(docs, id=id_col, text=text_col)
    kind, item_kind = dict(d.dtypes)["id"], dict(benchmark.select(item_col).dtypes)[item_col]
    schema = f"id {kind}, item {item_kind}, coverage double, covered long, tiles array<struct<start:long,item_start:long,words:long>>"

    def search(part):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in batches:
                rows = [(i, k, c, n, [{"start": a, "item_start": b, "words": w} for a, b, w in t])
                        for i, text in zip(p["id"], p["text"]) for k, c, n, t in part.value.matches(text, coverage)]
                yield pd.DataFrame(rows, columns=["id", "item", "coverage", "covered", "tiles"])
        return run

    out = _by_parts(benchmark_parts(benchmark, item_col, item_text_col, least, pass_words), docs.sparkSession,
                    lambda part: d.mapInPandas(search(part), schema))
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def _by_parts(parts: Iterator[Bench], spark: SparkSession, run: Callable) -> DataFrame | None:
    """What ``run`` gives for every part, together. Where there are several parts, each has
    a pass of its own whose rows are written before the next is sent out, so that workers
    hold one part at a time and the driver two."""
    scratch, out = None, None
    part = next(parts, None)
    while part is not None:
        after = next(parts, None)
        shared = spark.sparkContext.broadcast(part)
        if after is None and scratch is None:
            return run(shared)
        scratch = scratch or Scratch(spark)
        found = scratch.cut(run(shared))
        shared.destroy()
        out = found if out is None else out.unionByName(found)
        part = after
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", coverage: float = COVERAGE,
               pass_words: int = PASS_WORDS) -> DataFrame:
    """The documents that no item contaminates; columns stay as they are.

    Texts are judged as in ``contaminated_pairs``. With a benchmark of several
    parts, the hashes of contaminated texts are written part by part and the
    documents that have them go in one join. Null and empty texts hold no item
    and stay, rows that repeat stay or go alike, and an empty table or an empty
    benchmark leaves the documents as they are.
    """
    flat, at, back = positional(docs)
    text = at[text_col]
    parts = list(islice(benchmark_parts(benchmark, pass_words=pass_words), 2))
    if not parts:
        return docs

    def hit(part):
        @F.pandas_udf("boolean")
        def judge(t: pd.Series) -> pd.Series:
            return pd.Series([bool(part.value.matches(x, coverage)) for x in t], dtype=bool)
        return judge(F.col(text))

    if len(parts) == 1:
        return flat.filter(~hit(docs.sparkSession.sparkContext.broadcast(parts[0]))).select(*back)
    del parts
    own = F.md5(F.coalesce(F.col(text), F.lit("")))
    gone = _by_parts(benchmark_parts(benchmark, pass_words=pass_words), docs.sparkSession,
                     lambda part: flat.filter(hit(part)).select(own.alias("_gone")).distinct()).distinct()
    return flat.withColumn("_own", own).join(gone, F.col("_own") == F.col("_gone"), "left_anti").select(*back)


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the items found in them."""
    out = contaminated_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"), "covered", F.size("tiles").alias("n_tiles"))
