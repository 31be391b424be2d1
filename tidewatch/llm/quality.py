"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, pick, read, ship, slices

#: Shrinkage of a class covariance towards the pooled one, and of that towards its diagonal.
POOL, DIAGONAL, FLOOR = 0.3, 0.2, 1e-3
THRESHOLD = 0.7
NAMES = ("log_chars", "log_words", "word_length", "upper", "digit", "punctuation", "symbol", "space", "other",
         "capital_words", "symbol_words", "distinct_words", "repeated_lines", "line_words", "short_words", "compression")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: lower letter 0, upper 1, digit 2, punctuation 3, symbol 4, space 5, other 6."""
    out = np.full(0x110000, 6, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = 1 if ch.isupper() else 0
        elif ch.isdigit():
            out[c] = 2
        elif ch.isspace():
            out[c] = 5
    for ch in ".,;:!?'\"()-’“”¿¡":
        out[ord(ch)] = 3
    for ch in "#$%&*+/<=>@[\\]^_`{|}~":
        out[ord(ch)] = 4
    return out


def _logit(x: float, n: float) -> float:
    """Log odds of x in n, smoothed: close to normal where shares are not."""
    return float(np.log((x + 0.5) / (max(n - x, 0) + 0.5)))


def statistics(texts: list[str]) -> np.ndarray:
    """The transformed statistics ``NAMES`` of each whole text (logs and log odds)."""
    out = np.zeros((len(texts), len(NAMES)))
    for lo, hi in slices(texts):
        part = texts[lo:hi]
        codes = _classes()[np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)]
        lens = np.array([len(t) for t in part], np.int64)
        ends = np.cumsum(lens)
        kinds = np.zeros((len(part), 7), np.int64)
        for i, (a, b) in enumerate(zip(ends - lens, ends)):
            kinds[i] = np.bincount(codes[a:b], minlength=7)
        for i, t in enumerate(part):
            n, k, words = len(t), kinds[i], t.split()
            w, lines = len(words), [x for x in t.split("\n") if x.strip()]
            solid = n - int(k[5])
            raw = t.encode("utf-8", "replace")
            out[lo + i] = (
                np.log1p(n), np.log1p(w), np.log1p(solid / max(w, 1)),
                _logit(k[1], k[0] + k[1]), _logit(k[2], solid), _logit(k[3], solid), _logit(k[4], solid),
                _logit(k[5], n), _logit(k[6], solid),
                _logit(sum(1 for x in words if len(x) > 1 and x.isupper()), w),
                _logit(sum(1 for x in words if not x[-1].isalnum() and x[-1] not in ".,;:!?'\")"), w),
                _logit(len(set(words)), w), _logit(len(lines) - len(set(lines)), len(lines)),
                np.log1p(w / max(len(lines), 1)), _logit(sum(1 for x in words if len(x) <= 3), w),
                np.log((len(zlib.compress(raw, 1)) + 20) / (len(raw) + 20)),
            )
    return out


@dataclass
class QdaModel:
    """Class means, Cholesky factors of the shrunk covariances and log priors."""

    mean: np.ndarray | None = None  # 2 x d
    factor: np.ndarray | None = None  # 2 x d x d: inverses of the Cholesky factors
    log_det: np.ndarray | None = None
    log_prior: np.ndarray | None = None
    constant: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: a logistic of the difference of log densities."""
        if self.mean is None:
            return np.full(len(x), self.constant)
        out = np.zeros((2, len(x)))
        for c in (0, 1):
            z = (x - self.mean[c]) @ self.factor[c].T
            out[c] = self.log_prior[c] - 0.5 * ((z * z).sum(1) + self.log_det[c])
        return 1 / (1 + np.exp(np.clip(out[0] - out[1], -700, 700)))


def fit_qda(n: np.ndarray, total: np.ndarray, outer: np.ndarray, pool: float = POOL, diagonal: float = DIAGONAL) -> QdaModel:
    """From counts, sums and sums of outer products of both classes.

    Without rows the score is 0.5; with one class only, its smoothed share.
    """
    if n.sum() == 0 or (n < 2).any():
        return QdaModel(constant=float((n[1] + 0.5) / (n.sum() + 1)) if n.sum() else 0.5)
    mean = total / n[:, None]
    cov = outer / n[:, None, None] - np.einsum("ci,cj->cij", mean, mean)
    pooled = np.einsum("c,cij->ij", n / n.sum(), cov)
    scale = np.diag(np.diag(pooled)) + FLOOR * np.eye(len(pooled))
    pooled = (1 - diagonal) * pooled + diagonal * scale
    factor, log_det = [], []
    for c in (0, 1):
        # few rows of a class lean more on the pooled covariance
        lam = max(pool, len(pooled) / (len(pooled) + n[c]))
        low = np.linalg.cholesky((1 - lam) * cov[c] + lam * pooled + FLOOR * np.eye(len(pooled)))
        factor.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    return QdaModel(mean, np.array(factor), np.array(log_det), np.log(n / n.sum()))


def document_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with an array column ``stats``; null texts count as empty."""
    ship(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def stats(text: pd.Series) -> pd.Series:
        return pd.Series(list(statistics([t or "" for t in text])))

    return docs.withColumn("stats", stats(F.col(text_col)))


def train_quality(rows: DataFrame, stats_col: str = "stats", label_col: str = "label", pool: float = POOL,
                  diagonal: float = DIAGONAL) -> QdaModel:
    """Fit on all rows with a label 0 or 1: every task sums up its rows, so that
    two classes' sums per task are what is shuffled and 2 x d x d numbers
    come to the driver."""
    ship(rows.sparkSession)
    d = len(NAMES)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((2, 1 + d + d * d))
        for p in batches:
            if not len(p):
                continue
            x, y = np.stack(p["stats"].to_numpy()), p["label"].to_numpy()
            for c in (0, 1):
                v = x[y == c]
                acc[c] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
        yield pd.DataFrame({"c": np.repeat([0, 1], acc.shape[1]), "k": np.tile(np.arange(acc.shape[1]), 2), "v": acc.ravel()})

    got = (pick(rows, stats=stats_col, label=label_col).filter("label in (0, 1)").withColumn("label", F.col("label").cast("int"))
           .mapInPandas(sums, "c int, k int, v double").groupBy("c", "k").agg(F.sum("v").alias("v")).toPandas())
    acc = np.zeros((2, 1 + d + d * d))
    acc[got["c"], got["k"]] = got["v"]
    return fit_qda(acc[:, 0], acc[:, 1:1 + d], acc[:, 1 + d:].reshape(2, d, d), pool, diagonal)


def score_quality(rows: DataFrame, model: QdaModel, stats_col: str = "stats") -> DataFrame:
    """``rows`` with the probability ``score`` of good quality."""
    spark = rows.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.stack(stats.to_numpy()) if len(stats) else np.zeros((0, len(NAMES)))))

    return rows.withColumn("score", score(F.col(stats_col)))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", held_out: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted (1 from ``threshold`` on).

    Statistics of the whole texts are taken in one pass and kept in the
    shared checkpoint folder; labels (matched by id, null labels and labels
    of held-out ids left out) meet those narrow rows, never the texts.
    ``held_out`` is a condition on ``F.col("id")``. Null texts count as
    empty and are scored too. A document with several labels counts once for
    each; repeated documents count each. Without labels all score 0.5. An
    empty table gives an empty result; extra columns are ignored.
    """
    d = pick(docs, id=id_col, text=text_col)
    out = F.coalesce(held_out if held_out is not None else F.lit(False), F.lit(False))
    rows = cut(document_statistics(d).select("id", out.alias("held_out"), "stats"))
    known = pick(labels, k=id_col, label=label_col).dropna()
    model = train_quality(rows.filter("not held_out").join(known, F.col("id") == F.col("k")))
    scored = score_quality(rows, model)
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op6_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose crc32 of the id leaves 2 on division by 4 are held out of learning."""
    return classify_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                            held_out=F.crc32(F.col("id").cast("string")) % 4 == 2)
