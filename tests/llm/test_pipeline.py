"""The pipeline's stages against plain loops, each on its own input."""

import collections
import hashlib
import zlib

import numpy as np

import corpus_pipeline as cp
from tidewatch.llm import decontamination as dc
from tidewatch.llm import mixing as mx
from tidewatch.llm import near_dedup as nd
from tidewatch.llm import sharding

from .test_corpus import count
from .test_dedup import classes
from .test_text_models import greedy

SMALL = "/root/testdata/sf0.001"


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def contaminated(text, items):
    w = dc.words(text)
    grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    for it in items:
        if len(it) < 5:
            if it and any(w[i:i + len(it)] == it for i in range(len(w) - len(it) + 1)):
                return True
        elif any(tuple(it[j:j + 5]) in grams for j in range(len(it) - 4)) and greedy(w, it, 5) >= 0.5 * len(it):
            return True
    return False


def in_order(part, whole):
    """Whether the words of ``part`` come in ``whole`` in order."""
    it = iter(whole)
    return all(w in it for w in part)


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = [docs.collect()]
    frames = [docs]
    for _, stage in cp.STAGES:
        frames.append(stage(spark, frames[-1], SMALL).checkpoint())
        held.append(frames[-1].collect())
    given, known, single, clean, mixed, sharded = held

    assert ids(known) == ids(r for r in given if any(c.isalpha() for c in r["text"] or ""))

    of = classes([r["text"] for r in known], [r["doc_id"] for r in known])
    assert ids(single) == sorted(r["doc_id"] for r, c in zip(known, of) if c == r["doc_id"] or not nd.words_of(r["text"]))
    assert len(single) < len(known) and {r["doc_id"]: r["text"] for r in single}.items() <= {r["doc_id"]: r["text"] for r in given}.items()

    items = [dc.words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert ids(clean) == ids(r for r in single if not contaminated(r["text"], items)) and len(clean) < len(single)

    by = {r["doc_id"]: r for r in clean}
    size = collections.Counter()
    for r in clean:
        size[r["source"]] += count(r["text"])
    want, took, used = mx.targets(dict(size)), collections.Counter(), collections.Counter()
    for r in mixed:
        source = by[r["doc_id"]]
        assert (r["lang"], r["source"]) == (source["lang"], source["source"]) and r["n_chars"] == len(r["text"])
        assert in_order(r["text"].split(), source["text"].split())
        took[r["source"]] += count(r["text"])
        used[r["doc_id"]] += count(r["text"])
    assert all(abs(took[s] - want[s]) <= 1 for s in size) and all(n <= 2 * count(by[i]["text"]) for i, n in used.items())

    def key(x):
        return int(hashlib.md5(f"{sharding.SEED}:{x}".encode()).hexdigest()[:15], 16)

    order = []
    for s in {r["source"] for r in mixed}:
        own = sorted((key(r["text"]), key(r["doc_id"]), r["doc_id"], len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode()), r["text"]) for r in mixed if r["source"] == s)
        order += [((k + 0.5) / len(own), s, *x[2:]) for k, x in enumerate(own)]
    n = len(order)
    want = collections.Counter((x[2], x[5], k * 8 // n, k - -(-(k * 8 // n) * n // 8)) for k, x in enumerate(sorted(order)))
    assert collections.Counter((r["doc_id"], r["text"], r["shard"], r["slot"]) for r in sharded) == want
    assert max(np.bincount([r["shard"] for r in sharded])) - min(np.bincount([r["shard"] for r in sharded])) <= 1


def test_repeated_ids_lose_no_text(spark):
    """Rows that share an id go by their texts: a unique text is not lost with another row of its id."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(3).collect()
    a, b = docs[0]["text"], docs[1]["text"]
    d = spark.createDataFrame([(1, a, "en", "s", len(a)), (2, a, "en", "s", len(a)), (2, b, "en", "s", len(b)), (None, None, "en", "s", None)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    got = cp.remove_near_duplicates(spark, d, SMALL).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted([("1", a), ("2", b), ("None", "None")])
