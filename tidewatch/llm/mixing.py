"""Mixing sources to target weights by permuted fixed-length blocks."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, pick, positional, read, ship

WEIGHTS, BUDGET, MOST = (5, 2, 1), 1.5, 2.0
BLOCK_WORDS, OUT_SHARDS, SEED = 256, 64, 7
#: Ranges of a source's packing order whose words one task sums up.
PACK_BINS = 1024


def targets(sizes: dict, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> dict:
    """Words to take of each source.

    Sources in order of code points, null last, weigh ``weights``, repeating.
    Together they take ``budget`` times all words; none takes more than
    ``most`` times its own, and what is cut off is shared again by weight
    among the others until no source is above.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, free, left = {}, list(order), budget * sum(sizes.values())
    while free:
        total = sum(weigh[s] for s in free)
        share = {s: left * weigh[s] / total for s in free}
        full = [s for s in free if share[s] > most * sizes[s]]
        if not full:
            return got | share
        for s in full:
            got[s] = most * sizes[s]
            left -= got[s]
        free = [s for s in free if s not in got]
    return got


def draw_counts(slots: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each output shard: a (shards, sources) matrix.

    Every shard is as long as the next to within one slot. A shard takes of
    each source the whole part of its share of what is left of all quotas,
    and draws the rest from a multinomial over the fractional parts, so each
    source's total is its quota exactly and no source outgrows it.
    """
    rng, left = np.random.default_rng(seed), slots.astype(np.int64).copy()
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        rest = int(left.sum())
        room = rest // (shards - k) + (1 if rest % (shards - k) else 0)
        if not rest:
            break
        share = left * (room / rest)
        whole = np.minimum(np.floor(share).astype(np.int64), left)
        part, open_ = share - whole, room - int(whole.sum())
        while open_ > 0:
            p = np.where(left > whole, np.maximum(part, 1e-12), 0.0)
            extra = np.minimum(rng.multinomial(open_, p / p.sum()), left - whole)
            whole, part = whole + extra, np.zeros_like(part)
            open_ = room - int(whole.sum())
        out[k], left = whole, left - whole
    return out


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(n) under ``key``, by a four-round
    Feistel network with cycle walking; vectorised over all three arguments."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64).copy(), np.arange(len(index))
    size, key = n.astype(np.uint64), key.astype(np.uint64)
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k = half[todo], mask[todo], key[todo]
            a, b = out[todo] >> h, out[todo] & m
            for r in range(4):
                x = b * np.uint64(0x9E3779B97F4A7C15) + k + np.uint64(r) * np.uint64(0xD1B54A32D192ED03)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                x ^= x >> np.uint64(32)
                a, b = b, a ^ (x & m)
            out[todo] = (a << h) | b
            todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def pack(docs: DataFrame, seed: int, block_words: int) -> DataFrame:
    """Words of each source, in seeded order of documents, cut into blocks.

    docs: id, source, size. Returns a row for each part of a document in a
    block: source, block, at (place in the block), id, row, size, start, words.
    Offsets are summed in ``PACK_BINS`` ranges of each source's order.
    """
    d = docs.filter("size > 0").withColumn("h", F.xxhash64(F.lit(seed), "id", "size", "row"))
    d = d.withColumn("bin", F.pmod("h", F.lit(PACK_BINS)))
    bins = d.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    before = bins.select(F.col("source").alias("s"), F.col("bin").alias("b"), (
        F.sum("n").over(W.partitionBy("source").orderBy("bin")) - F.col("n")).alias("before"))
    run = W.partitionBy("source", "bin").orderBy("h", "id", "size", "row").rowsBetween(W.unboundedPreceding, 0)
    d = (d.withColumn("upto", F.sum("size").over(run))
         .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
         .select("id", "row", "source", "size", (F.col("before") + F.col("upto") - F.col("size")).alias("off")))
    span = F.sequence(F.expr(f"off div {block_words}"), F.expr(f"(off + size - 1) div {block_words}"))
    d = d.select("*", F.explode(span).alias("block"))
    low = F.greatest(F.col("off"), F.col("block") * block_words)
    high = F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * block_words)
    return d.select("source", "block", (low - F.col("block") * block_words).alias("at"), "id", "row", "size",
                    (low - F.col("off")).alias("start"), (high - low).alias("words"))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=WEIGHTS, budget: float = BUDGET, most: float = MOST, block_words: int = BLOCK_WORDS,
        shards: int = OUT_SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sizes, mixed): every document with its source's target, and the mixed blocks.

    ``sizes`` has id, row (tells rows with the same id, source and size
    apart), source, size, source_size, target. ``mixed`` has a row for each
    part of a document in a block of the mix: shard, slot, source, block,
    epoch, take (words the slot takes of the block), id, row, size, start,
    words (the words of the document that are taken: ``words`` from word
    ``start`` on).

    Each source's words are packed into blocks of ``block_words``. A source
    gets as many slots as its target needs; ``draw_counts`` deals them to
    output shards; slot j of a source is block ``permute(j mod n)`` in epoch
    ``j div n``, with another permutation in each epoch. Full blocks are
    permuted; a shorter last block ends each epoch. The last slot takes only
    the words that are left, so a source gives its rounded target exactly, and
    since targets stop at ``most`` times the source's words, no word is taken
    more than ceil(most) times, nor a document more than ``most`` times its
    size for whole ``most``. Slots and blocks are joined on (source, block),
    where each epoch has one slot for a block: no key is hot.

    One row per source goes to the driver, and a count per source and shard
    comes from it. Null sources are a source of their own. Null and
    blank texts have size 0 and take nothing. Repeated rows count each on its
    own. An empty table gives empty results. Extra columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    d = pick(docs, id=id_col, source=source_col, text=text_col)
    d = d.select("id", "source", size_of(F.col("text")).alias("size"))
    d = cut(d)
    # rows that repeat an id are told apart by a number among those of one source and size, which are interchangeable
    repeated = d.groupBy("id").count().filter("count > 1").limit(1).count()
    d = d.withColumn("row", F.row_number().over(W.partitionBy("id", "source", "size").orderBy(F.lit(1))) if repeated else F.lit(1))
    by_source = {r["source"]: int(r["n"]) for r in d.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    want = targets(by_source, weights, budget, most)
    names = sorted((s for s in by_source if s is not None)) + [None] * (None in by_source)

    plan = []
    for i, s in enumerate(names):
        words, take = by_source[s], min(int(round(want[s])), int(most * by_source[s]))
        full, tail = divmod(words, block_words)
        epochs, rest = divmod(take, words) if words else (0, 0)
        plan.append((i, s, words, full, tail, epochs * (full + (tail > 0)) + math.ceil(rest / block_words), take))
    table = [(i, s, w, float(want[s]), f, t, c, k) for i, s, w, f, t, c, k in plan]
    schema = "sid int, source string, source_size long, target double, full long, tail int, slots long, take long"
    facts = spark.createDataFrame(table, schema)
    deal = draw_counts(np.array([p[5] for p in plan] or [0]), shards, seed) if plan else np.zeros((0, 0), int)
    first = np.cumsum(deal, axis=0) - deal
    inside = np.cumsum(deal, axis=1) - deal
    cells = [(k, i, int(first[k, i]), int(inside[k, i]), int(deal[k, i]))
             for k in range(deal.shape[0]) for i in range(deal.shape[1]) if deal[k, i]]
    cells_df = spark.createDataFrame(cells, "shard int, sid int, first long, inside long, n long")

    slots = (cells_df.repartition(spark.sparkContext.defaultParallelism, "shard", "sid").join(facts, "sid")
             .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("q")))
    slots = slots.select("shard", (F.col("inside") + F.col("q")).alias("slot"), "sid", "source", "source_size",
                         "full", "tail", "take", (F.col("first") + F.col("q")).alias("j"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            full, tail = p["full"].to_numpy(), p["tail"].to_numpy()
            per = full + (tail > 0)
            j = p["j"].to_numpy()
            epoch, q = j // per, j % per
            inner = q < full
            key = (p["sid"].to_numpy().astype(np.uint64) * np.uint64(1_000_003) + epoch.astype(np.uint64)
                   + np.uint64(seed * 0x5851F42D4C957F2D % 2**64))
            block = q.copy()
            block[inner] = permute(q[inner], full[inner], key[inner])
            done = epoch * p["source_size"].to_numpy() + q * block_words
            length = np.where(inner, block_words, tail)
            yield pd.DataFrame({"shard": p["shard"], "slot": p["slot"], "source": p["source"], "block": block,
                                "epoch": epoch, "take": np.minimum(length, p["take"].to_numpy() - done)})

    slots = slots.mapInPandas(place, "shard int, slot long, source string, block long, epoch long, take long")
    b = pack(d, seed, block_words).withColumnRenamed("source", "s").withColumnRenamed("block", "b")
    part = F.least(F.col("words"), F.col("take") - F.col("at"))
    mixed = (b.join(slots, F.col("s").eqNullSafe(F.col("source")) & (F.col("b") == F.col("block")))
             .select("shard", "slot", "source", "block", "epoch", "take", "id", "row", "size", "start", part.alias("words"))
             .filter("words > 0"))
    sizes = d.withColumnRenamed("source", "s").join(
        facts.select("source", "source_size", "target"), F.col("s").eqNullSafe(F.col("source")), "left").drop("s")
    return sizes.select("id", "row", "source", "size", "source_size", "target"), mixed


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                  n_chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix as documents: a row for each time (epoch) that any words of a
    document are taken, with the columns of ``docs``. A document that is taken
    whole keeps its text; of one that a block's end cuts, the taken stretches
    stay, joined by line feeds, and ``n_chars_col`` is counted anew. Texts
    without words are not in the mix."""
    _, mixed = mix(docs, id_col, source_col, text_col, **options)
    parts = mixed.groupBy(F.col("id").alias("_id"), F.col("source").alias("_s"), F.col("size").alias("_n"), F.col("row").alias("_row"), "epoch").agg(
        F.sort_array(F.collect_list(F.struct("start", "words"))).alias("_parts"))  # as many as the text has blocks
    flat, at, back = positional(docs)
    key = F.col(at[id_col]).eqNullSafe(F.col("_id"))
    if flat.groupBy(at[id_col]).count().filter("count > 1").limit(1).count():
        size = size_of(F.col(at[text_col]))
        flat = flat.withColumn("_size", size)
        flat = flat.withColumn("_r", F.row_number().over(W.partitionBy(at[id_col], at[source_col], "_size").orderBy(F.lit(1))))
        key = key & F.col(at[source_col]).eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_n")) & (F.col("_r") == F.col("_row"))

    @F.pandas_udf("string")
    def stretch(text: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, [(p["start"], p["words"]) for p in ps]) for t, ps in zip(text, parts)])

    out = flat.join(parts, key).withColumn(at[text_col], stretch(F.col(at[text_col]), F.col("_parts")))
    if n_chars_col in at:
        out = out.withColumn(at[n_chars_col], F.length(at[text_col]).cast(dict(flat.dtypes)[at[n_chars_col]]))
    return out.select(*back)


def cut_words(text: str, parts: list[tuple[int, int]]) -> str:
    """The stretches of ``text`` from word ``start`` on, ``words`` long, joined by line feeds."""
    runs: list[list[int]] = []
    for start, n in sorted(parts):
        if runs and runs[-1][1] == start:
            runs[-1][1] = start + n
        else:
            runs.append([start, start + n])
    spans = [m.span() for m in re.finditer(WORD, text)]
    if runs == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in runs)


def op5_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, mixed = mix(read(spark, sf_dir, "documents"))
    taken = mixed.groupBy(F.col("id").alias("i"), F.col("source").alias("s"), F.col("size").alias("z"), F.col("row").alias("r")).agg(F.sum("words").alias("taken"))
    out = sizes.join(taken, F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("row") == F.col("r")), "left")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))
