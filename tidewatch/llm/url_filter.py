"""URL filter: host and path rules, then gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_labels
from .common import pick, read, ship

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MAX_TRAIN, MAX_RULES, SEED = 20_000, 1_000, 11
SMOOTHING = 5.0


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    A rule (host, path, verdict) fits its host and all its subdomains if the
    path starts with the rule's path.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        said = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, said) if out is None else out.when(fits, said)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _suffixes(host: str) -> tuple[str, str, str]:
    parts = host.split(".")
    return tuple(".".join(parts[-k:]) for k in (1, 2, 3))


def _split(url: str) -> tuple[str, str, str]:
    rest = url.partition("://")[2]
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    tail = rest[cut:].partition("#")[0]
    path, _, query = tail.partition("?")
    return rest[:cut].lower(), path, query


def _entropy(rows: list[bytes]) -> np.ndarray:
    n = len(rows)
    lens = np.array([len(r) for r in rows], np.int64)
    flat = np.frombuffer(b"".join(rows), np.uint8).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(n), lens) * 256 + flat, minlength=n * 256).reshape(n, 256)
    p = counts / np.maximum(lens, 1)[:, None]
    return -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)


@dataclass
class UrlModel:
    """Boosted complete trees and the suffix statistics they read."""

    suffix: dict[str, tuple[float, float]] = field(default_factory=dict)
    base: float = 0.0
    prior: float = 0.0
    feature: np.ndarray | None = None  # trees x inner nodes
    threshold: np.ndarray | None = None
    leaf: np.ndarray | None = None  # trees x leaves
    depth: int = 3

    def features(self, urls: list[str], leave_out: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Length, host length, depth, digit ratio, entropy of URL and host,
        parameter count and length, hyphens, labels, then for the last one,
        two and three labels of the host the smoothed share of unwanted URLs
        and the log count. ``leave_out``: unwanted and all URLs to take out of each URL's counts."""
        parts = [_split(u) for u in urls]
        raw = [u.encode("utf-8", "replace") for u in urls]
        hosts = [h.encode("utf-8", "replace") for h, _, _ in parts]
        cols = [
            [len(u) for u in urls], [len(h) for h, _, _ in parts],
            [sum(1 for x in p.split("/") if x) for _, p, _ in parts],
            [sum(map(str.isdigit, u)) / max(1, len(u)) for u in urls],
            _entropy(raw), _entropy(hosts),
            [sum(1 for x in q.split("&") if x) for _, _, q in parts], [len(q) for _, _, q in parts],
            [h.count("-") for h, _, _ in parts], [h.count(".") for h, _, _ in parts],
        ]
        for k in range(3):
            bad, n = np.array([self.suffix.get(_suffixes(h)[k], (0.0, 0.0)) for h, _, _ in parts] or np.zeros((0, 2))).reshape(-1, 2).T
            if leave_out is not None:
                bad, n = bad - leave_out[0], n - leave_out[1]
            cols += [(bad + SMOOTHING * self.prior) / (n + SMOOTHING), np.log1p(n)]
        return np.array(cols, float).T.reshape(len(urls), -1)

    def score(self, urls: list[str]) -> np.ndarray:
        out = np.full(len(urls), self.base)
        if self.feature is not None and len(urls):
            x, rows = self.features(urls), np.arange(len(urls))
            for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
                node = np.zeros(len(urls), np.int64)
                for _ in range(self.depth):
                    node = 2 * node + 1 + (x[rows, f[node]] > t[node])
                out += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit_trees(urls: list[str], labels: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3,
              bins: int = 32, ridge: float = 1.0) -> UrlModel:
    """Newton boosting of the log loss over histograms of quantile bins.

    A URL's own label is left out of the suffix shares it is trained on, and
    every second URL is trained without all labels of its host, so the trees
    learn to judge hosts that no label is known of as well as known ones.
    Without URLs, or with one label only, the score is the smoothed share.
    """
    y, m = labels.astype(float), UrlModel(depth=depth)
    for u, v in zip(urls, y):
        for s in set(_suffixes(_split(u)[0])):
            bad, n = m.suffix.get(s, (0.0, 0.0))
            m.suffix[s] = (bad + v, n + 1)
    m.prior = float((y.sum() + 0.5) / (len(y) + 1)) if len(y) else 0.25
    m.base = float(np.log(m.prior / (1 - m.prior)))
    if len(set(y)) < 2:
        return m
    hosts = [_split(u)[0] for u in urls]
    of_host: dict[str, list[float]] = {}
    for h, v in zip(hosts, y):
        held = of_host.setdefault(h, [0.0, 0.0])
        held[0], held[1] = held[0] + v, held[1] + 1
    whole = np.array([of_host[h] for h in hosts])
    odd = (np.arange(len(y)) % 2 == 1)[:, None]
    out = np.where(odd, whole, np.stack([y, np.ones(len(y))], axis=1))
    x = m.features(urls, (out[:, 0], out[:, 1]))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    now, inner = np.full(len(y), m.base), 2**depth - 1
    feats, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-now))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        node, f_of, t_of = np.zeros(len(y), np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local, best = node - first, np.full(width, 1e-9)
            side = np.zeros(len(y), bool)
            for f, e in enumerate(edges):
                k = len(e) + 1
                if k < 2:
                    continue
                at = local * k + binned[:, f]
                gs = np.bincount(at, g, width * k).reshape(width, k).cumsum(1)
                hs = np.bincount(at, h, width * k).reshape(width, k).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                c = gain[:, :-1].argmax(1)
                top = gain[np.arange(width), c]
                for w in np.flatnonzero(top > best):
                    best[w], f_of[first + w], t_of[first + w] = top[w], f, e[c[w]]
            side = x[np.arange(len(y)), f_of[node]] > t_of[node]
            node = 2 * node + 1 + side
        at = node - inner
        leaf = rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + ridge)
        now += leaf[at]
        feats, cuts, leaves = [*feats, f_of], [*cuts, t_of], [*leaves, leaf]
    m.feature, m.threshold, m.leaf = np.array(feats), np.array(cuts), np.array(leaves)
    return m


def train_url_model(labelled: DataFrame, url_col: str = "url", label_col: str = "label", key_col: str = "page_id",
                    max_train: int = MAX_TRAIN, seed: int = SEED) -> UrlModel:
    """Fit on labelled URLs (label 1: unwanted): on all up to ``max_train``, else
    on those whose keys have the lowest seeded hashes, ``max_train`` in
    expectation: keys, not URLs, as one URL may be a third of all rows.
    Rows without URL, label or key don't count."""
    d = pick(labelled, url=url_col, label=label_col, key=key_col).dropna()
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key").cast("string")), F.lit(1 << 30))
    rows = d.filter(draw < int((1 << 30) * min(1.0, max_train / max(1, d.count())))).collect()
    rows.sort(key=lambda r: (r["url"], r["label"]))
    return fit_trees([r["url"] for r in rows], np.array([r["label"] for r in rows], float))


def filter_urls(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES,
                id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score.

    The longest rule that fits decides; else the trees block the URL if its
    score, the probability that it is unwanted, is ``threshold`` or more.
    Null URLs and URLs without ``://`` have empty host and path, fit no rule
    and are scored as they are (null as empty). No shuffle; the model, whose
    suffix table is bounded by the training sample, is the only broadcast.
    Repeated rows are judged alike, an empty table gives an empty result, and
    extra columns are ignored.
    """
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(url: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([u or "" for u in url]))

    d = pick(pages, id=id_col, url=url_col)
    d = d.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                 score(F.coalesce("url", F.lit(""))).alias("score"))
    d = d.withColumn("by", match_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return d.select(F.col("id").alias(id_col), "host", "path", F.col("by.rule").alias("rule"),
                    F.coalesce("by.verdict", own).alias("verdict"), "score")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no labels of URLs: the trees learn from those of ``url_labels``, a
    stand-in for a list of labelled hosts, in which a quarter of the hosts have none."""
    pages = read(spark, sf_dir, "pages")
    return filter_urls(pages, train_url_model(url_labels.labelled(pages)))
