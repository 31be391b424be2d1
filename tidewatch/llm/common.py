"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import Scratch, checkpoint_dir, cut, ship  # noqa: F401

#: One word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Select exactly the columns ``names`` maps to, under the aliases given.

    Columns are found by exact name and position, so extra columns whose names
    clash with those (also in another case) or with internal names do no harm.
    """
    cols = df.columns
    flat = df.toDF(*[f"_in{i}" for i in range(len(cols))])
    return flat.select(*[F.col(f"_in{cols.index(c)}").alias(a) for a, c in names.items()])


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """(df with unambiguous names, those names by the exact old ones, columns that restore the old ones)."""
    flat = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    at: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, f"_p{i}")
    return flat, at, [F.col(f"_p{i}").alias(c) for i, c in enumerate(df.columns)]


#: Keys with more than this share of all rows are hot: there are fewer than its inverse of them, so a table of one row for each can be broadcast.
HOT_SHARE = 0.001


def join_by_key(rows: DataFrame, facts: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner or left) with ``facts``, a written table of one row for each key.

    ``count`` is the column of ``facts`` that has the number of rows of its key.
    Hot keys, those with more than ``HOT_SHARE`` of the rows, are fewer than
    its inverse whatever the input, so their facts are broadcast; the other
    rows meet theirs in a shuffle, in which no key is hot. Where ``how`` is
    left, rows with a null key are spread by nothing: give them keys of their own.
    """
    total, most = facts.agg(F.sum(count), F.max(count)).first()
    bound = max(1_000, int((total or 0) * HOT_SHARE))
    if (most or 0) <= bound:
        return rows.join(facts, key, how)
    hot, cold = facts.filter(F.col(count) > bound), facts.filter(F.col(count) <= bound)
    first = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return first.unionByName(rest)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(texts: list[str], limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``limit`` characters (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
