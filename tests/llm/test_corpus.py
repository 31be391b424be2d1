import collections
import random
import re
import zlib

import numpy as np

import corpus_pipeline as cp
from tidewatch.llm import mixing as mx
from tidewatch.llm import queries, sharding

from .util import DOCS, clash, odd_documents

DATA = "/root/testdata/sf0.01"


def test_targets():
    t = mx.targets({"a": 100, "b": 100, None: 10})
    assert t["b"] == 315 - 200 - 20 and t["a"] == 200 and t[None] == 20  # 5:2:1 of 315, held to twice the size
    r = random.Random(1)
    for _ in range(100):
        s = {f"s{i}": r.randint(0, 1_000) for i in range(r.randint(1, 12))}
        t = mx.targets(s)
        assert all(t[k] <= 2 * s[k] + 1e-6 for k in s) and abs(sum(t.values()) - 1.5 * sum(s.values())) < 1e-6
    assert mx.targets({}) == {}


def test_draws_and_permutations():
    r = np.random.default_rng(2)
    for _ in range(30):
        slots = r.integers(0, 60, r.integers(1, 9))
        c = mx.draw_counts(slots, 7, 3)
        assert (c.sum(0) == slots).all() and (c >= 0).all() and c.sum(1).max() - c.sum(1).min() <= 1
    for n in (1, 2, 3, 10, 257):
        p = mx.permute(np.arange(n), np.full(n, n), np.full(n, 99, np.uint64))
        assert sorted(p.tolist()) == list(range(n))
    assert (mx.permute(np.arange(100), np.full(100, 100), np.full(100, 1, np.uint64)) != np.arange(100)).any()


def count(t):
    return len(re.findall(mx.WORD, t or ""))


def test_mix_odd_documents(spark):
    d = odd_documents(spark)
    sizes, mixed = mx.mix(clash(d), block_words=64, shards=5)
    got = sizes.collect()
    rows = d.collect()
    assert sorted((str(r["id"]), r["size"]) for r in got) == sorted((str(r["doc_id"]), count(r["text"])) for r in rows)
    by = collections.Counter()
    for r in rows:
        by[r["source"]] += count(r["text"])
    want = mx.targets(dict(by))
    taken = collections.Counter()
    spans = collections.defaultdict(list)
    for r in mixed.collect():
        taken[r["source"]] += r["words"]
        spans[(r["id"], r["source"], r["size"], r["row"]), r["epoch"]].append((r["start"], r["words"]))
    assert all(abs(taken[s] - want[s]) <= 1 for s in by)
    size = {(r["id"], r["source"], r["size"], r["row"]): r["size"] for r in got}
    assert len(size) == len(got)
    used = collections.Counter()
    for (k, _), parts in spans.items():
        parts.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[-1][0] + parts[-1][1] <= size[k]
        used[k] += sum(n for _, n in parts)
    assert all(n <= 2 * size[k] for k, n in used.items())
    out = mx.mix_documents(clash(d), block_words=64, shards=5)
    assert out.columns == clash(d).columns and out.count() == len(spans)
    words = collections.Counter()
    text = collections.defaultdict(list)
    for r in rows:
        text[r["doc_id"]].append((r["text"] or "").split())
    for i, t, _, source, n_chars, *_ in out.collect():
        words[source] += count(t)
        assert n_chars == len(t) and any(set(t.split()) <= set(x) for x in text[i])
    assert words == taken
    assert mx.mix(spark.createDataFrame([], DOCS))[1].count() == 0 and mx.mix_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_mix_query(spark):
    a, b = (sorted(tuple(r) for r in queries.QUERIES["op5_block_mix"](spark, DATA).collect()) for _ in range(2))
    assert a == b
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    total, want, took = collections.Counter(), {}, collections.Counter()
    for i, size, source_size, target, taken in a:
        assert size == count(docs[i]["text"]) and 0 <= taken <= 2 * size
        s = docs[i]["source"]
        total[s] += size
        want[s] = target
        took[s] += taken
    assert want == mx.targets(dict(total)) and all(abs(took[s] - want[s]) <= 1 for s in want)


def check_shards(rows, shards):
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    n = len(rows)
    assert set(by) <= set(range(shards)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - (min(map(len, by.values())) if n >= shards else 0) <= 1
    source = collections.Counter(r["source"] for r in rows)
    for s, m in source.items():
        per = collections.Counter(r["shard"] for r in rows if r["source"] == s)
        assert max(per.values()) - min(per.get(k, 0) for k in range(shards)) <= 2 + m // n


def test_shards_against_brute_force(spark):
    d = odd_documents(spark)
    rows = d.collect()
    got = sharding.interleave_shards(clash(d), shards=3).collect()
    check_shards(got, 3)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(r["doc_id"]), len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    import hashlib

    def key(i):
        return int(hashlib.md5(f"{sharding.SEED}:{'null' if i is None else i}".encode()).hexdigest()[:15], 16)

    frac = []
    for s in {r["source"] for r in rows}:
        own = sorted((key(r["text"] or ""), key(r["doc_id"]), r["doc_id"] or -1, len((r["text"] or "").encode())) for r in rows if r["source"] == s)
        frac += [((i + 0.5) / len(own), (s is not None, s or ""), x[2]) for i, x in enumerate(own)]
    order = [x[2] for x in sorted(frac)]
    n = len(order)
    want = sorted((i * 3 // n, i - -(-(i * 3 // n) * n // 3), x) for i, x in enumerate(order))
    assert sorted((r["shard"], r["slot"], r["doc_id"] or -1) for r in got) == want
    whole = sharding.shard_documents(clash(d), shards=3)
    assert whole.columns == [*clash(d).columns, "shard", "slot"]
    assert sorted((r["shard"], r["slot"]) for r in whole.collect()) == sorted((r["shard"], r["slot"]) for r in got)
    assert sharding.interleave_shards(spark.createDataFrame([], DOCS)).count() == 0


def test_shard_query(spark):
    docs = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.QUERIES["op10_stratified_shards"](spark, DATA).collect()
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None} and len(got) == len(docs)
    check_shards([{"shard": r["shard"], "slot": r["slot"], "source": docs[r["doc_id"]]} for r in got], 8)


def test_equal_texts_are_neighbours(spark):
    """Of a source, at most one group of equal texts is split at each cut; groups of all sources drift apart only by the sources' sizes."""
    r = random.Random(6)
    rows = [(i, f"text {r.choice([r.randrange(150), r.randrange(9_000), 7])}", "en", f"s{r.choice([0, 0, 0, 1])}") for i in range(4_000)]
    d = spark.createDataFrame([(i, t, lg, s, len(t)) for i, t, lg, s in rows], DOCS)
    got = {x["doc_id"]: x["shard"] for x in sharding.interleave_shards(d).collect()}
    check_shards([{**x.asDict(), "doc_id": None} for x in sharding.interleave_shards(d, source_bins=4, text_bins=4).collect()], 8)
    per, everywhere = collections.defaultdict(set), collections.defaultdict(set)
    for i, t, _, s in rows:
        per[s, t].add(got[i])
        everywhere[t].add(got[i])
    for s in ("s0", "s1"):
        split = [v for (x, _), v in per.items() if x == s and len(v) > 1]
        assert sum(len(v) - 1 for v in split) <= 7 and all(max(v) - min(v) == len(v) - 1 for v in split)
    several = [t for t in everywhere if sum(x[1] == t for x in rows) > 1]
    assert sum(len(everywhere[t]) > 1 for t in several) <= 0.25 * len(several)


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cols, before = docs.columns, docs.count()
    kept = []
    for i, (_, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, "/root/testdata/sf0.001").checkpoint()
        kept.append(docs.count())
        assert docs.columns == (cols if i < 4 else [*cols, "shard", "slot"])
    assert kept[0] == before and kept[1] < kept[0] and kept[2] < kept[1] and kept[3] >= kept[2] * 0.8 and kept[4] == kept[3]
    assert cp.run(spark, "/root/testdata/sf0.001").count() == kept[4]


def test_pipeline_odd_and_empty(spark):
    d = odd_documents(spark)
    for docs in (d, clash(d), d.limit(0)):
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, "/root/testdata/sf0.001").checkpoint()
        assert docs.count() >= 0
