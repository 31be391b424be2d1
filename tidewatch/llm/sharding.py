"""Sharding by proportional stratified interleaving, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, pick, positional, read

SHARDS, SEED = 8, 20240607
#: Ranges that a source's shuffle keys are cut into for ranking, and those of one text's
#: rows; ranges of the fractional rank: a table of that size is broadcast, whatever the
#: input's size. All only bound how many rows one task ranks.
SOURCE_BINS, TEXT_BINS, RANK_BINS = 1024, 1024, 4096
_BITS = 60


def shuffle_key(column, seed: int):
    """60 bits of MD5(seed:column): a seeded order that any SQL engine can repeat."""
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit("null")))), 1, _BITS // 4)
    return F.conv(hexed, 16, 10).cast("bigint")


def interleave_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                      source_col: str = "source", text_col: str = "text", source_bins: int = SOURCE_BINS,
                      text_bins: int = TEXT_BINS, rank_bins: int = RANK_BINS) -> DataFrame:
    """One row per input row: id, source, size, text_crc32, shard, slot.

    Rows are shuffled within each source by a seeded key of the text, then of
    the id, and ranked; the rank minus one half over the source's count is the
    fractional rank. All rows are put in its order (ties by source, nulls
    first, then id) and the order is cut into ``shards`` runs whose lengths
    differ by one at most, so every shard holds each source in its share of
    the whole to within a row or two. ``slot`` is the place in the shard,
    gapless from 0; ``size`` is the UTF-8 bytes of the text plus 1.

    Groups are equal texts: the key makes a group neighbours within a source,
    so of a source at most one group a cut is split, and puts the copies of
    other sources at nearly the same fractional rank, the nearer the larger
    the sources are. A group is not held together where that would break the
    equal counts or the mixture, which come first.

    A rank is counted in bins: each source's key range is cut into
    ``source_bins``, and the rows of one text into ``text_bins`` by the key of
    their ids. Counts of those cells are summed up to offsets, and
    ``row_number`` runs within one cell only, so neither a source nor a text
    with a third of all rows is ranked in one task. The global position is
    found in the same way over ``rank_bins`` ranges of the fractional rank.
    Only narrow rows are shuffled, never the text.

    Null sources are a stratum of their own; null text counts as none (size
    1, CRC 0) and null ids as one id. Rows with equal source, id and text are
    interchangeable; only they share a cell whatever their number. An
    empty table gives an empty result. Extra columns are ignored.
    """
    d = pick(docs, id=id_col, source=source_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    d = d.select("id", "source", (F.octet_length("text") + 1).cast("bigint").alias("size"), F.crc32("text").alias("crc"),
                 shuffle_key("text", seed).alias("h"), shuffle_key("id", seed).alias("g"))
    d = cut(d.withColumn("sub", F.expr(f"cast(g div {2**_BITS // text_bins} as int)")))

    cells = d.groupBy("source", "h", "sub").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.expr(f"cast(h div {2**_BITS // source_bins} as int)"))
    counts = cells.groupBy("source", "bin").agg(F.sum("n").alias("m"))
    ahead = counts.select(F.col("source").alias("s"), F.col("bin").alias("b"),
                          (F.sum("m").over(W.partitionBy("source").orderBy("bin")) - F.col("m")).alias("before"),
                          F.sum("m").over(W.partitionBy("source")).alias("total"))
    run = W.partitionBy("source", "bin").orderBy("h", "sub").rowsBetween(W.unboundedPreceding, 0)
    before = (cells.withColumn("upto", F.sum("n").over(run))
              .join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
              .select(F.col("source").alias("s"), F.col("h").alias("ch"), F.col("sub").alias("csub"), "total",
                      (F.col("before") + F.col("upto") - F.col("n")).alias("before")))
    order = [F.col("g"), F.col("id"), F.col("size"), F.col("crc")]
    ranked = (d.withColumn("rn", F.row_number().over(W.partitionBy("source", "h", "sub").orderBy(*order)))
              .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("ch")) & (F.col("sub") == F.col("csub")))
              .select("id", "source", "size", "crc", "h", "g", ((F.col("before") + F.col("rn") - 0.5) / F.col("total")).alias("frac"))
              .withColumn("slice", F.floor(F.col("frac") * rank_bins).cast("int")))
    ranked = cut(ranked)

    slices = ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))  # at most rank_bins rows
    ahead = slices.select(F.col("slice").alias("b"),
                          (F.sum("n").over(W.orderBy("slice")) - F.col("n")).alias("ahead"),
                          F.sum("n").over(W.partitionBy()).alias("all"))
    place = F.row_number().over(W.partitionBy("slice").orderBy(
        "frac", F.col("source").asc_nulls_first(), "id", "size", "crc"))
    out = (ranked.withColumn("rn", place).join(F.broadcast(ahead), F.col("slice") == F.col("b"))
           .withColumn("pos", F.col("ahead") + F.col("rn") - 1)
           .withColumn("shard", F.expr(f"cast((pos * {shards}) div `all` as int)")))
    first = F.expr(f"(shard * `all` + {shards - 1}) div {shards}")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size",
                      F.col("crc").alias("text_crc32"), "shard", (F.col("pos") - first).cast("bigint").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
                    source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with the columns shard and slot of ``interleave_shards``.

    Texts meet their places on (id, size, CRC); rows that agree in all three
    take the places of their group one each, so each place is taken once.
    They are numbered in no order, as any of them may take any of those.
    """
    flat, at, back = positional(docs)
    ident, text = at[id_col], F.coalesce(at[text_col], F.lit(""))
    flat = flat.withColumns({"_size": (F.octet_length(text) + 1).cast("bigint"), "_crc": F.crc32(text)})
    flat = flat.withColumn("_n", F.row_number().over(W.partitionBy(ident, "_size", "_crc").orderBy(F.lit(1))))
    a = interleave_shards(docs, shards, seed, id_col, source_col, text_col).select(
        F.col(id_col).alias("_id"), F.col("size").alias("_s"), F.col("text_crc32").alias("_c"), "shard", "slot")
    a = a.withColumn("_m", F.row_number().over(W.partitionBy("_id", "_s", "_c").orderBy("shard", "slot")))
    # the numbers are compared as a condition, not as a key: the windows' partitioning serves the join
    on = F.col(ident).eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_s")) & (F.col("_crc") == F.col("_c"))
    out = flat.join(a, on & (F.col("_n") - F.col("_m") == 0))
    return out.select(*back, "shard", "slot")


def op10_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = interleave_shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
