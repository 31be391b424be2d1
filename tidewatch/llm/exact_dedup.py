"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_by_key, pick, read

PREFIX_CHARS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, hash_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, content_hash.

    Rows are grouped by byte length and within it by the hash of the first
    ``prefix_chars``, both counted in one map-side combined aggregate; what
    occurs once is settled. Only rows of groups with two members or more have
    their whole text hashed (SHA-256). Groups that hold a large share of all
    rows meet their facts by a broadcast of bounded size (``join_by_key``), so
    no group is hot in a shuffle. With ``hash_all`` every row gets its hash in
    the scan, so that no text is shuffled, at the price of hashing settled
    rows too; without it, texts of rows that are not hot are shuffled once.

    Of equal texts the row with the largest id stays. Null text counts as
    empty. Rows that repeat an id and a text are all ``kept`` if that id is
    the largest; a null id stays only in a group without another id.
    An empty table gives an empty result. Extra columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    # the hashes are taken below the joins: what they shuffle is narrow
    rows = pick(docs, id=id_col, text=text_col).select(
        "id", F.xxhash64(F.octet_length(text), F.xxhash64(F.substring(text, 1, prefix_chars))).alias("short"),
        F.sha2(text, 256).alias("hash") if hash_all else text.alias("text"))
    if hash_all:
        rows = scratch.cut(rows)
    open_ = scratch.cut(rows.groupBy("short").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    left = join_by_key(rows, open_, "short", "n")
    if not hash_all:
        left = scratch.cut(left.select("id", F.sha2("text", 256).alias("hash")))
    groups = scratch.cut(left.groupBy("hash").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size")).filter("size > 1"))

    out = join_by_key(rows.select("id", "hash") if hash_all else left, groups, "hash", "size", "left")
    if not hash_all:
        settled = join_by_key(rows.select("id", "short"), open_, "short", "n", "left").filter("n is null")
        out = out.unionByName(settled.select("id"), allowMissingColumns=True)
    keep = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id_col), keep.alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), F.col("hash").alias("content_hash"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(read(spark, sf_dir, "documents"), hash_all=True)
    return out.withColumnRenamed("content_hash", "text_sha256")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
