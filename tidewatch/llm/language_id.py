"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, positional, read, ship, slices

BUCKET_BITS, ALPHA = 16, 0.5
#: Documents of each language that are learned from, in expectation; languages at most.
PER_LANG, MAX_LANGS, SEED = 5_000, 256, 5


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Lower-cased letter of every code point; a space for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (ch := chr(c)).isalpha():
            out[c] = ord(ch.lower()[0])
    return out


def grams(texts: list[str], bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hash buckets of the 1-, 2- and 3-grams at every place of the joined
    texts, where each text begins, and whether it has a letter.

    Texts are set apart by spaces, and grams that say nothing (a space, two
    spaces, a middle space) get bucket ``2**bits``, so no gram spans two texts.
    """
    joined = "".join(f" {t}  " for t in texts)
    c = _fold()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lens = np.array([len(t) + 3 for t in texts], np.int64)
    starts = np.cumsum(lens) - lens
    letter = c != 32
    has = np.maximum.reduceat(letter, starts) if len(texts) else np.zeros(0, bool)
    pad = np.array([32, 32], np.uint32)
    c1, c2 = np.concatenate([c[1:], pad[:1]]), np.concatenate([c[2:], pad])
    none, shift = np.uint32(2**bits), np.uint32(32 - bits)
    a, b, d, z = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F)
    h1 = c * a
    h2 = (h1 ^ (c1 * b)) * z
    h3 = (h2 ^ (c2 * d)) * a
    mid = c1 != 32
    return [np.where(letter, (h1 * z) >> shift, none), np.where(letter | mid, h2 >> shift, none),
            np.where(mid, h3 >> shift, none)], starts, has


@dataclass
class LanguageModel:
    langs: list[str]
    logp: np.ndarray  # (buckets + 1) x languages; the last row is zero
    prior: np.ndarray
    bits: int = BUCKET_BITS

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability; ``und`` and 0 without a letter."""
        texts = [t or "" for t in texts]
        lang, score = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return lang, score
        for lo, hi in slices(texts):
            total = np.tile(self.prior, (hi - lo, 1))
            has = np.zeros(hi - lo, bool)
            for part in _pieces(texts[lo:hi]):
                buckets, starts, h = grams(part, self.bits)
                has |= h
                for k in buckets:
                    total += np.add.reduceat(self.logp[k], starts, axis=0)
            best = total.argmax(1)
            p = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i in np.flatnonzero(has):
                lang[lo + i], score[lo + i] = self.langs[best[i]], p[i]
        return lang, score


def _pieces(texts: list[str], limit: int = 1_000_000) -> Iterator[list[str]]:
    """The texts in pieces of ``limit`` characters at most, cut at spaces if there are any,
    one list after another; a text that has ended goes on as empty."""
    if all(len(t) <= limit for t in texts):
        yield texts
        return
    at = [0] * len(texts)
    while any(a < len(t) for a, t in zip(at, texts)):
        part = []
        for i, t in enumerate(texts):
            end = min(len(t), at[i] + limit)
            if end < len(t) and (space := t.rfind(" ", at[i], end)) > at[i]:
                end = space
            part.append(t[at[i]:end])
            at[i] = end
        yield part


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
                         per_lang: int = PER_LANG, alpha: float = ALPHA, bits: int = BUCKET_BITS, seed: int = SEED) -> LanguageModel:
    """Learn from labelled texts: all of a language with up to ``per_lang`` texts,
    else those with the lowest seeded hashes, ``per_lang`` in expectation.

    One row per language and one count per (language, bucket) come to the
    driver: ``2**bits`` times the languages at most. Rows with null text or
    language don't count. More than ``MAX_LANGS`` languages are an error.
    """
    ship(labelled.sparkSession)
    d = pick(labelled, text=text_col, lang=lang_col, key=key_col).dropna(subset=["text", "lang"])
    sizes = {r["lang"]: r["count"] for r in d.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.zeros((2**bits + 1, 0)), np.zeros(0), bits)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, per_lang / sizes[lang]))])
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    place = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(langs), 2**bits), np.int64)
        for p in batches:
            for lang, group in p.groupby("lang"):
                texts = list(group["text"])
                for lo, hi in slices(texts):
                    for part in _pieces(texts[lo:hi]):
                        for k in grams(part, bits)[0]:
                            counts[place[lang]] += np.bincount(k, minlength=2**bits + 1)[:-1]
        at, bucket = np.nonzero(counts)
        yield pd.DataFrame({"lang": at.astype(np.int32), "bucket": bucket.astype(np.int32), "n": counts[at, bucket]})

    rows = (d.filter(draw < share[F.col("lang")]).select("text", "lang")
            .mapInPandas(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    n = np.full((2**bits + 1, len(langs)), alpha)
    n[rows["bucket"], rows["lang"]] += rows["n"]
    logp = np.log(n / n[:-1].sum(0))
    logp[-1] = 0.0
    known = np.array([sizes[x] for x in langs], float)
    return LanguageModel(langs, logp, np.log(known / known.sum()), bits)


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column lang_id(lang_pred, score), of the whole text, as the last one.

    Null texts and texts without a letter get ``und`` and 0, as does every
    text if the model knows no language; of languages that are equally likely
    the first in order is taken. No shuffle: one pass of Arrow batches,
    worked on in slices of about a million characters, with the
    log-probability matrix broadcast (its size is fixed by buckets and
    ``MAX_LANGS``). Rows that repeat are judged alike, and an empty table
    gives an empty result. The text is found by position: columns whose names
    clash, even one called lang_id, stay as they are.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(text: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict(list(text))
        return pd.DataFrame({"lang_pred": lang, "score": score})

    flat, at, back = positional(docs)
    return flat.withColumn("_judged", judge(F.col(at[text_col]))).select(*back, F.col("_judged").alias("lang_id"))


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 0 on division by 5; null keys are not."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def language_model(docs: DataFrame) -> LanguageModel:
    """The model learned from the documents' own lang column, without the held-out ones."""
    d = pick(docs, doc_id="doc_id", text="text", lang="lang")
    return train_language_model(d.filter(~held_out(F.col("doc_id"))))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    d = predict_language(pick(docs, doc_id="doc_id", text="text"), language_model(docs))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_id.lang_pred", "lang_id.score")


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents that have a language; ``und`` ones go. Columns stay as they are, repeated rows too."""
    flat, at, back = positional(docs)
    return predict_language(flat, model, at[text_col]).filter(F.col("lang_id.lang_pred") != "und").select(*back)
