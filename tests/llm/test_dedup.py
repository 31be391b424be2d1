import collections
import hashlib
import random

import numpy as np
import pytest

from tidewatch.llm import near_dedup as nd
from tidewatch.llm import queries
from tidewatch.llm.common import join_by_key
from tidewatch.llm.exact_dedup import exact_dedup

from .util import DOCS, clash, odd_documents, sentence


@pytest.mark.parametrize("hash_all", [True, False])
def test_exact_against_brute_force(spark, hash_all):
    d = odd_documents(spark, [(200, "x", "en", "a"), (201, "y" * 64 + "1", "en", "a"), (202, "y" * 64 + "2", "en", "a"), (203, "y" * 64 + "1", "en", "a")])
    rows = d.collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for r in rows:
        g = groups[r["text"] or ""]
        keep = max((i for i in g if i is not None), default=None) if len(g) > 1 else r["doc_id"]
        want.append((r["doc_id"], keep, len(g), r["doc_id"] == keep))
    got = exact_dedup(clash(d), hash_all=hash_all).collect()
    key = lambda x: str(x)
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got], key=key) == sorted(want, key=key)
    by = {r["doc_id"]: r["text"] for r in rows}
    for r in got:
        if hash_all or r["group_size"] > 1:
            assert r["content_hash"] == hashlib.sha256((by[r["doc_id"]] or "").encode()).hexdigest()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_by_key_with_hot_keys(spark, how):
    rows = spark.range(9_000).selectExpr("id", "case when id < 4000 then 1 when id < 5500 then 2 else id end as k")
    facts = rows.groupBy("k").count().filter("k != 6000").selectExpr("k", "count as n", "k * 10 as v")
    got = {r["id"]: r["v"] for r in join_by_key(rows, facts, "k", "n", how).collect()}
    want = {i: 10 * (1 if i < 4_000 else 2 if i < 5_500 else i) for i in range(9_000)} | {6_000: None}
    assert got == ({k: v for k, v in want.items() if v is not None} if how == "inner" else want)
    assert join_by_key(rows, facts.limit(0), "k", "n", how).count() == (0 if how == "inner" else 9_000)


def test_exact_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_alignment_against_plain_dynamic_programming():
    r, known = random.Random(2), nd.Words()
    for _ in range(60):
        a = [r.choice("abcdefghijklmnop") for _ in range(r.randint(6, 60))]
        b = list(a)
        for _ in range(r.randint(0, 3)):
            b[r.randrange(len(b))] = "z"
        b = b[3:] if r.random() < 0.3 else b
        x, y = nd.shingles(a, known), nd.shingles(b, known)
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        assert len(nd._banded_rows(x, y, 200)) == best[-1][-1]
        jaccard = len(set(x) & set(y)) / len(set(x) | set(y))
        assert nd.aligned(x, y, 1e-4) <= jaccard + 1e-9
    same = nd.shingles(["spam"] * 400, known)
    assert nd.aligned(same, nd.shingles(["spam"] * 300, known)) == 1.0
    assert nd.aligned(same, nd.shingles(["ham"] * 300, known)) == 0.0 and nd.aligned(same, same[:0]) == 0.0


def longest(a, b, band):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            hit = best[i][j] + 1 if a[i] == b[j] and abs(i - j) <= band else 0
            best[i + 1][j + 1] = max(hit, best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_words_in_order_against_plain_dynamic_programming():
    r = random.Random(8)
    for _ in range(300):
        a = [r.randrange(r.choice([2, 9, 40])) for _ in range(r.randint(0, 50))]
        b = [r.randrange(r.choice([2, 9, 40])) for _ in range(r.randint(0, 50))]
        band = r.choice([0, 1, 5, 60])
        assert nd.common_words(a, b, band) == longest(a, b, band)
    a = [r.randrange(5_000) for _ in range(1_200)]
    b = [x for x in a if r.random() < 0.9]
    assert nd.common_words(a, b, 130) == longest(a, b, 130) and nd.common_words(a, b, 2) == longest(a, b, 2)
    for _ in range(200):
        a = [r.randrange(30) for _ in range(r.randint(1, 60))]
        b = [x if r.random() < 0.9 else 99 for x in a][:len(a) - r.randint(0, 5)] + [7] * r.randint(0, 3)
        x, y = (nd.Compared(np.array(v, np.uint64)) for v in (a, b))
        want = longest(a, b, 99) / max(len(a), len(b), 1)
        assert (nd.share_in_order(x, y) >= 0.8) == (want >= 0.8 - 1e-12) and nd.share_in_order(x, y) <= want + 1e-12
        if not (x.repeats or y.repeats):
            assert nd.aligned(x.s, y.s) < 0.8 or want >= 0.8


def test_long_texts_are_aligned_in_bounded_time():
    import time

    g = np.random.default_rng(3)
    a = g.integers(0, 30_000, 170_000).astype(np.uint64)
    b = a.copy()
    b[g.random(len(b)) < 0.1] = 5
    t = time.time()
    assert nd.alike(nd.Compared(a), nd.Compared(b)) and time.time() - t < 60


def test_alignment_keeps_order():
    known, r = nd.Words(), random.Random(4)
    a, b = sentence(r, 60).split(), sentence(r, 60).split()
    assert nd.aligned(nd.shingles(a + b, known), nd.shingles(a + b[:-2] + ["q", "r"], known), 0.8) >= 0.8
    assert nd.aligned(nd.shingles(a + b, known), nd.shingles(b + a, known), 0.8) < 0.8


def test_sketch_of_long_text_is_made_in_parts():
    s = np.random.default_rng(1).integers(0, 2**63, 300_000).astype(np.uint64)
    v, n = nd.sketch(s)
    assert len(v) == nd.SKETCHES and n == len(np.unique(s)) and nd.sketch(s)[0] == v


def classes(texts, ids):
    known = nd.Words()
    sh = [nd.Compared(nd.hashes(nd.words_of(t), known)) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and nd.alike(sh[j], sh[i], 0.8):
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(texts))]


def near_corpus():
    r = random.Random(11)
    rows, i = [], 1_000
    passage = sentence(r, 25)
    for g in range(12):
        base = sentence(r, r.randint(60, 120)).split()
        for _ in range(r.choice([1, 2, 5, 30 if g == 0 else 3])):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = "changed" + str(r.randrange(99))
            rows.append((i, " ".join(w), "en", "a"))
            i += 1
    for _ in range(40):  # alike in a common passage, else apart: buckets that stay open
        rows.append((i, passage + " " + sentence(r, 8), "en", "b"))
        i += 1
    return rows


@pytest.mark.parametrize("small", [nd.SMALL, 2])
def test_near_against_brute_force(spark, small):
    d = odd_documents(spark, near_corpus())
    rows = d.collect()
    got = nd.near_duplicates(clash(d), small=small, retained=2 if small == 2 else nd.RETAINED, rounds=2).collect()
    want = classes([r["text"] for r in rows], [r["doc_id"] for r in rows])
    key = lambda x: str(x)
    assert sorted([(r["doc_id"], r["class_id"]) for r in got], key=key) == sorted(zip([r["doc_id"] for r in rows], want), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_near_texts_that_repeat_lines(spark):
    r, rows = random.Random(23), []
    for g in range(12):
        w = sentence(r, 104, [f"w{g}x{k}" for k in range(9_999)]).split()
        line, head = w[-30:], w[:8]
        for k, more in enumerate([w, w + 20 * line, w + (5 + g) * line, head * 9 + w]):
            rows.append((10 * g + k, " ".join(more), "en", "a"))
    rows += [(500, "spam " * 5, "en", "a"), (501, "spam " * 300, "en", "a"), (502, "spam " * 400, "en", "a"), (503, "eggs " * 300, "en", "a")]
    d = spark.createDataFrame([(i, t, lg, s, len(t)) for i, t, lg, s in rows], DOCS)
    got = {x["doc_id"]: x["class_id"] for x in nd.near_duplicates(d).collect()}
    ids = [x[0] for x in rows]
    want = classes([x[1] for x in rows], ids)
    assert sum(i != c for i, c in zip(ids, want)) >= 38
    assert [got[i] for i in ids] == want


def test_near_query_against_all_pairs(spark):
    """Every pair of documents that is linked, and how many of each five-word Jaccard similarity are."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op3_order_minhash"](spark, "/root/testdata/sf0.01").collect()}
    known = nd.Words()
    x = {i: nd.Compared(nd.hashes(nd.words_of(t), known)) for i, t in docs.items()}
    sets = {i: set(c.s.tolist()) for i, c in x.items()}
    holds, common = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for v in s:
            holds[v].append(i)
    for v in holds.values():
        common.update((a, b) for a in v for b in v if a < b)
    linked, apart, near = 0, 0, collections.Counter()
    for (a, b), c in common.items():
        if nd.words_of(docs[a]) == nd.words_of(docs[b]):
            assert got[a] == got[b]
            continue
        jaccard, alike = c / (len(sets[a]) + len(sets[b]) - c), nd.alike(x[a], x[b])
        linked += alike
        apart += alike and got[a] != got[b]
        if jaccard >= 0.4:
            near[int(jaccard * 10)] += 1
            near["caught", int(jaccard * 10)] += got[a] == got[b]
    assert linked > 85 and apart == 0
    deciles = [k for k in near if isinstance(k, int)]
    assert sum(near["caught", k] for k in deciles) >= 0.95 * sum(near[k] for k in deciles)
    # clean documents are left alone: whoever shares a class is linked to one of it
    by = collections.defaultdict(list)
    for i, c in got.items():
        by[c].append(i)
    for members in by.values():
        for a in members:
            assert len(members) == 1 or any(b != a and (nd.words_of(docs[a]) == nd.words_of(docs[b]) or nd.alike(x[a], x[b])) for b in members)


def test_keep_one_goes_by_id_and_text(spark):
    r = random.Random(5)
    a, b = sentence(r, 50), sentence(r, 60)
    near = " ".join(["changed", *a.split()[1:]])
    rows = [(1, a), (2, a), (2, b), (3, near), (4, None), (4, None), (5, "  "), (7, b), (1, a), (None, a), (None, "alone " + sentence(r, 9)), (8, "x"), (9, "x")]
    d = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOCS)
    kept = nd.keep_one(clash(d))
    assert kept.columns == clash(d).columns
    got = [(x[0], x[1]) for x in kept.collect()]
    key = lambda v: (str(v[0]), str(v[1]))
    assert sorted(got, key=key) == sorted([(1, a), (2, b), (4, None), (4, None), (5, "  "), (None, rows[10][1]), (8, "x")], key=key)


def test_near_with_plain_ids(spark):
    d = spark.createDataFrame([(i, t, lg, s, len(t)) for i, t, lg, s in near_corpus()], DOCS)
    rows = d.collect()
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicates(d).collect()}
    assert [got[r["doc_id"]] for r in rows] == classes([r["text"] for r in rows], [r["doc_id"] for r in rows])
    kept = nd.keep_one(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_near_empty_table(spark):
    assert nd.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_links_by_words_in_large_open_parts_are_found(spark):
    """Pairs that agree in a common passage and in all but every fifth of their own words: they share
    no other shingle, and few are linked to a leader. With this seed every pair shares a bucket."""
    r, rows = random.Random(5), []
    passage = sentence(r, 64)
    for g in range(40):
        own = sentence(r, 30, [f"w{g}x{k}" for k in range(9_999)]).split()
        rows += [(10 * g, f"{passage} {' '.join(own)}"), (10 * g + 1, f"{passage} {' '.join('changed' if k % 5 == 2 else w for k, w in enumerate(own))}")]
    d = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    ids = [i for i, _ in rows]
    want = classes([t for _, t in rows], ids)
    assert len(set(want)) == 40
    got = {x["doc_id"]: x["class_id"] for x in nd.near_duplicates(d).collect()}
    assert [got[i] for i in ids] == want


@pytest.mark.parametrize("block", [nd.BLOCK, 30])
def test_open_parts_of_a_block_are_read_once(spark, monkeypatch, block):
    """A common passage, own words and pairs: what reads texts is the first round, the pairs of small parts, rounds
    of leaders only for parts of several blocks, and one read of each part in which there is something to compare."""
    monkeypatch.setattr(nd, "BLOCK", block)
    r, rows = random.Random(5), []
    passage = sentence(r, 64)
    for g in range(40):
        own = sentence(r, 30, [f"w{g}x{k}" for k in range(9_999)]).split()
        rows += [(10 * g, f"{passage} {' '.join(own)}"), (10 * g + 1, f"{passage} {' '.join('changed' if k % 5 == 2 else w for k, w in enumerate(own))}")]
    asked, parts, cut, linked = [], [], nd.Scratch.cut, nd._linked_in_blocks

    def noted(self, df):
        out = cut(self, df)
        if df.columns == ["lead", "node"]:
            asked.append(out.count())
        return out

    def held(part, *more):
        by = collections.defaultdict(list)
        for x in part.collect():
            by[x["key"]].append(x)
        parts.extend(by.values())
        return linked(part, *more)

    monkeypatch.setattr(nd.Scratch, "cut", noted)
    monkeypatch.setattr(nd, "_linked_in_blocks", held)
    d = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    got = {x["doc_id"]: x["class_id"] for x in nd.near_duplicates(d).collect()}
    assert [got[i] for i, _ in rows] == classes([t for _, t in rows], [i for i, _ in rows])
    assert len(asked) == (2 if block > 1_000 else 4)
    # no text repeats a shingle: none is compared by shingles; texts of a lower range alone meet there
    assert parts and all({x["by"] for x in p} == {"w"} and not all(x["second"] for x in p) for p in parts)


@pytest.mark.parametrize("block", [nd.BLOCK, 7])
def test_blocks_rule_out_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    d = spark.createDataFrame([(i, t, lg, s, len(t)) for i, t, lg, s in near_corpus()], DOCS)
    rows = d.select("doc_id", "text").collect()
    same = d.selectExpr("1L as key", f"{len(rows)}L as size", "doc_id as node", "doc_id as label", "'w' as by", "false as second")
    edges = [(x["a"], x["b"]) for x in nd._linked_in_blocks(same, d.selectExpr("doc_id as node", "text"), 0.8).collect()]
    up = nd.Joined()
    for a, b in edges:
        a, b = up.find(a), up.find(b)
        up[max(a, b)] = min(a, b)
    assert [up.find(x["doc_id"]) for x in rows] == classes([x["text"] for x in rows], [x["doc_id"] for x in rows])


def test_bounds_of_blocks_rule_out_no_link():
    r, known, texts = random.Random(9), nd.Words(), []
    for g in range(25):
        w = sentence(r, r.randint(5, 60)).split()
        texts += [w, w + w[-9:] * r.randint(1, 9), [x if r.random() < 0.85 else "z" for x in w], w[:3] * r.randint(1, 40)]
    b = nd.Block([(i, i, " ".join(w), False) for i, w in enumerate(texts)], known)
    links, alone = 0, 0
    for i in range(len(texts)):
        j = np.arange(i + 1, len(texts))
        by = {k: set(nd._may_be_alike(b, i, b, j, 0.8, k).tolist()) for k in "wn"}
        want = {k for k in j.tolist() if nd.alike(b.compared(i), b.compared(k))}
        assert want <= by["w"] | by["n"]
        links, alone = links + len(want), alone + len(want - by["w"])
    assert links > 30 and alone > 3
