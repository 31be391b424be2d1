"""Personal data: fixed patterns, and a skip-chain conditional random field over the tokens around them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, read, ship, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents that are learned from, in expectation, and tokens of them at most.
TRAIN_DOCS, TRAIN_TOKENS, SEED = 20_000, 50_000, 3
#: Rounds of message passing at most, and change of a document's messages from which on it goes on.
ROUNDS, TOLERANCE = 200, 1e-7
SURE, PRIOR = 0.95, 0.5

# The patterns of the contract, made linear: a match of a kind can only begin where the run before it ends.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s@0-9]*+[@0-9]\S*+")
_EDGE = ".,;:!?()[]{}<>\"'"
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns: per kind leftmost and non-overlapping,
    those that fail the test of their kind dropped; by start, then kind."""
    out = [("email", *s) for s in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or @, without outer punctuation."""
    out = []
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _EDGE and text[a] != "(":
            a += 1
        while b > a and text[b - 1] in _EDGE and text[b - 1] != ")":
            b -= 1
        if a < b:
            out.append((a, b))
    return out


SHAPES = 22
FEATURES = SHAPES + len(KINDS)  # and the kind of a base span over the token


def features(token: str) -> int:
    """Lexical shape of a token as bits."""
    d = _digits(token)
    n, parts = len(d), token.split(".")
    alpha = sum(map(str.isalpha, token))
    has_at = "@" in token
    four = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    plain = alpha == 0 and not has_at
    on = (
        True, has_at, has_at and bool(_DOMAIN.fullmatch(token.rpartition("@")[2])), has_at and token[0] != "@",
        four, four and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        plain and n <= 2, plain and n == 3, plain and n == 4, plain and 5 <= n <= 9, plain and 10 <= n <= 13, plain and 14 <= n <= 19, plain and n > 19,
        plain and 14 <= n <= 19 and luhn(d), token[0] == "+", token[0] == "(" and token[-1] == ")", plain and "-" in token,
        plain and "." in token and not four, 0 < alpha <= n, alpha > n > 0, len(token) > 24, n == len(token),
    )
    return sum(1 << i for i, x in enumerate(on) if x)


def key(token: str) -> str:
    """Tokens with the same key are repeated or similar: equal digits, or equal but for case."""
    d = _digits(token)
    return d if len(d) >= 4 and "@" not in token and sum(map(str.isalpha, token)) == 0 else token.lower()


def unpack(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(FEATURES)) & 1).astype(float)


def graph(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[tuple[int, int]], list[int], list[int], list[tuple[int, int]], list[tuple[int, int]]]:
    """Tokens, their feature bits (of shape and of the base span over them), base
    labels, chain edges (neighbours with white space alone between them) and skip
    edges (a token and the next one with its key; so an entity's mentions are one
    chain, whatever their number). Of several spans over a token the first counts."""
    toks = tokens(text)
    label, bits, at, open_ = [], [], 0, []
    for a, b in toks:
        while at < len(spans) and spans[at][1] < b:
            open_.append(spans[at])
            at += 1
        open_ = [s for s in open_ if s[2] > a]  # spans of one kind don't overlap, so four are open at most
        label.append(LABELS.index(open_[0][0]) if open_ else 0)
        bits.append(features(text[a:b]) | (1 << (SHAPES + label[-1] - 1) if label[-1] else 0))
    chain = [(i, i + 1) for i in range(len(toks) - 1) if toks[i + 1][0] - toks[i][1] <= 3 and text[toks[i][1]:toks[i + 1][0]].strip(_EDGE + " \t\r\n") == ""]
    last: dict[str, int] = {}
    skip = []
    for i, (a, b) in enumerate(toks):
        k = key(text[a:b])
        if len(k) >= 4:
            if k in last:
                skip.append((last[k], i))
            last[k] = i
    return toks, bits, label, chain, skip


@dataclass
class Crf:
    """Log potentials: of a label given a token's features, of neighbours' labels, of labels of like tokens."""

    unary: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray

    def marginals(self, bits: np.ndarray, chain: np.ndarray, skip: np.ndarray, doc: np.ndarray | None = None,
                  rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
        """Loopy belief propagation (sum-product, flooding, damped) over the graphs of
        many documents at once. ``doc``: the document of each token, from 0; a document's
        messages rest when none changes by ``tolerance``, whatever the others do."""
        k = len(LABELS)
        own = unpack(bits) @ self.unary
        own -= own.max(1, keepdims=True)
        edges = np.concatenate([chain.reshape(-1, 2), skip.reshape(-1, 2)]).astype(np.int64)
        belief = own.copy()
        if len(edges):
            table = np.concatenate([np.zeros(len(chain), np.int64), np.ones(len(skip), np.int64)])
            pots = np.stack([self.chain, self.skip, self.chain.T, self.skip.T])
            src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
            kind = np.concatenate([table, table + 2])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            doc = np.zeros(len(own), np.int64) if doc is None else doc
            of = doc[src]
            msg = np.zeros((len(src), k))
            live = np.arange(len(src))
            for _ in range(rounds):
                out = (belief[src[live]] - msg[back[live]])[:, :, None] + pots[kind[live]]
                top = out.max(1, keepdims=True)
                new = np.log(np.exp(out - top).sum(1)) + top[:, 0]
                new = 0.5 * msg[live] + 0.5 * (new - new.max(1, keepdims=True))
                moved = np.zeros(doc.max() + 1, bool)
                moved[of[live[np.abs(new - msg[live]).max(1) >= tolerance]]] = True
                msg[live] = new
                into = np.unique(dst[live])
                at = np.searchsorted(into, dst[live])
                belief[into] = own[into] + np.stack([np.bincount(at, new[:, j], len(into)) for j in range(k)], 1)
                live = live[moved[of[live]]]
                if not len(live):
                    break
        belief -= belief.max(1, keepdims=True)
        p = np.exp(belief)
        return p / p.sum(1, keepdims=True)


def _pairs(a: np.ndarray, b: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log ratio of how often labels meet on an edge to how often by chance, smoothed."""
    k = len(LABELS)
    n = np.bincount(a * k + b, minlength=k * k).reshape(k, k).astype(float)
    n = n + n.T + PRIOR * np.outer(share, share) * 10 + PRIOR * np.eye(k)
    p = n / n.sum()
    return np.clip(np.log(p / np.outer(p.sum(1), p.sum(0))), -4, 4)


def fit_crf(bits: np.ndarray, label: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 400, ridge: float = 1.0) -> Crf:
    """Piecewise training from tokens with base labels and their edges (pairs of places).

    A mention that the patterns find in one place they may miss in another, so
    an entity's mentions teach twice: as found, and as missed, with the bit of
    the base span taken off and the label kept. Tokens without a base span
    that are like one with it are neither, and teach nothing; other tokens
    teach that they are none. Unary potentials come of softmax regression,
    edge potentials of label pairs on the edges between tokens that teach.
    """
    k = len(LABELS)
    w = np.zeros((FEATURES, k))
    chain, skip = chain.reshape(-1, 2).astype(np.int64), skip.reshape(-1, 2).astype(np.int64)
    unknown, repeated = np.zeros(len(bits), bool), np.zeros(len(bits), bool)
    for _ in range(2):  # a chain of equal tokens: what is next to an unknown one is too
        for a, b in ((skip[:, 0], skip[:, 1]), (skip[:, 1], skip[:, 0])):
            unknown[a[(label[a] == 0) & ((label[b] > 0) | unknown[b])]] = True
            repeated[a[label[a] > 0]] = True
    teach = ~unknown
    missed = bits[repeated] & ((1 << SHAPES) - 1)
    x_bits, y_of = np.concatenate([bits[teach], missed]), np.concatenate([label[teach], label[repeated]])
    share = (np.bincount(y_of, minlength=k) + 0.5) / (len(y_of) + 0.5 * k)
    if len(x_bits):
        kinds, inverse = np.unique(x_bits, return_inverse=True)  # few shapes: the whole sample is fitted at their cost
        y = np.bincount(inverse * k + y_of, minlength=len(kinds) * k).reshape(-1, k).astype(float)
        n, x = y.sum(1, keepdims=True), unpack(kinds)
        speed = np.zeros_like(w)
        for _ in range(steps):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            grad = (x.T @ (y - n * p) - ridge * w) / max(1.0, n.sum())
            speed = 0.9 * speed + grad
            w += 1.0 * speed
    known = lambda e: e[teach[e[:, 0]] & teach[e[:, 1]]]
    pair = lambda e: _pairs(label[e[:, 0]], label[e[:, 1]], share) if len(e) else np.zeros((k, k))
    return Crf(w, pair(known(chain)), pair(known(skip)))


def train_crf(docs: DataFrame, text_col: str = "text", key_col: str = "doc_id", train_docs: int = TRAIN_DOCS,
              max_tokens: int = TRAIN_TOKENS, seed: int = SEED) -> Crf:
    """Learn from the base spans of a bounded sample: the documents with the
    lowest seeded hashes, ``train_docs`` in expectation, of whose tokens the
    first ``max_tokens`` in seeded order come to the driver, each with its
    features, label and the places in its text of the tokens it has edges to."""
    ship(docs.sparkSession)
    d = pick(docs, key=key_col, text=text_col)
    n = d.count()
    draw = F.xxhash64(F.lit(seed), F.col("key").cast("string"))
    d = d.select("text", draw.alias("h"), F.xxhash64("text").alias("g")).filter("text rlike '[@0-9]'")
    d = d.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1.0, train_docs / max(n, 1))))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = []
            for h, g, text in zip(p["h"], p["g"], p["text"]):
                _, bits, own, chain, skip = graph(text, base_spans(text))
                to, like = dict(chain), dict(skip)
                rows += [(h, g, i, bits[i], own[i], to.get(i, -1), like.get(i, -1)) for i in range(len(bits))]
            yield pd.DataFrame(rows, columns=["h", "g", "i", "bits", "label", "chain", "skip"]).astype("int64")

    t = d.mapInPandas(label, "h long, g long, i long, bits long, label long, chain long, skip long").orderBy("h", "g", "i").limit(max_tokens).toPandas()
    t = t.drop_duplicates(["h", "g", "i"]).reset_index(drop=True)  # rows that repeat teach once
    place = {x: r for r, x in enumerate(zip(t["h"], t["g"], t["i"]))}

    def edges(c: str) -> np.ndarray:
        found = [(r, place.get((h, g, j))) for r, (h, g, j) in enumerate(zip(t["h"], t["g"], t[c])) if j >= 0]
        return np.array([e for e in found if e[1] is not None], np.int64).reshape(-1, 2)

    return fit_crf(t["bits"].to_numpy(), t["label"].to_numpy(), edges("chain"), edges("skip"))


def find_all(texts: list[str], model: Crf) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """(base spans, all spans) of each text."""
    out, graphs, held = [], [], []
    shift = 0
    for t in texts:
        spans = base_spans(t)
        out.append((spans, spans))
        g = graph(t, spans)
        if g[0]:
            held.append((len(out) - 1, shift, g))
            graphs.append(g)
            shift += len(g[0])
    if not held:
        return out
    edge = lambda k: np.array([(a + s, b + s) for _, s, g in held for a, b in g[k]], np.int64).reshape(-1, 2)
    doc = np.repeat(np.arange(len(graphs)), [len(g[0]) for g in graphs])
    p = model.marginals(np.array([b for g in graphs for b in g[1]], np.int64), edge(3), edge(4), doc)
    for at, s, (toks, _, own, chain, _) in held:
        best = p[s:s + len(toks)]
        kind = np.where(best.max(1) >= SURE, best.argmax(1), 0)
        new, joined = [], set(chain)
        i = 0
        while i < len(toks):
            j = i
            if kind[i] and not own[i]:
                while j + 1 < len(toks) and (j, j + 1) in joined and kind[j + 1] == kind[i] and not own[j + 1] and kind[i] == LABELS.index("phone"):
                    j += 1
                new.append((LABELS[kind[i]], toks[i][0], toks[j][1]))
            i = j + 1
        if new:
            base = out[at][0]
            out[at] = (base, sorted(base + new, key=lambda x: (x[1], KINDS.index(x[0]))))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, base and spans, both arrays of (kind, start, end).

    ``base`` holds the matches of the fixed patterns. The field labels every
    token with a digit or @ given its shape, the base span over it, its
    neighbours and the other tokens like it (equal, or equal but for case, or
    of equal digits) anywhere in the document; tokens outside of base spans
    that it is sure of (``SURE``) are added in ``spans``, neighbouring parts
    of a phone number as one. Offsets count code points, ends exclusive.

    The whole text is read, in time linear in its length; null and empty
    texts have no spans. No shuffle; documents pass in Arrow batches, and
    the graphs of about a million characters are solved at once, each until
    its own messages rest. Repeated rows are answered each, ties between
    labels go to the first, an empty table gives an empty result, and extra
    columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            texts = [t or "" for t in p["text"]]
            got = [x for lo, hi in slices(texts) for x in find_all(texts[lo:hi], shared.value)]
            as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
            yield pd.DataFrame({"id": p["id"], "base": [as_rows(b) for b, _ in got], "spans": [as_rows(s) for _, s in got]})

    d = pick(docs, id=id_col, text=text_col)
    span = "array<struct<kind:string,start:long,end:long>>"
    return d.mapInPandas(find, f"id {dict(d.dtypes)['id']}, base {span}, spans {span}").withColumnRenamed("id", id_col)


def op7_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email and the others count base spans."""
    docs = read(spark, sf_dir, "documents")
    d = find_pii(docs, train_crf(docs))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return d.select("doc_id", *map(count, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
