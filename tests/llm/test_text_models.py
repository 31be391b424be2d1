import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontamination as dc
from tidewatch.llm import language_id as li
from tidewatch.llm import pii
from tidewatch.llm import quality as ql
from tidewatch.llm import queries

from .util import DOCS, clash, odd_documents, sentence

DATA = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def crc(i):
    return zlib.crc32(str(i).encode())


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op8_language_id"](spark, DATA).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(got) == len(lang) and all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) for r in got)
    out = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in out]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_texts(spark):
    d = odd_documents(spark)
    model = li.train_language_model(d)
    got = li.predict_language(d.select("doc_id", "text"), model).collect()
    for r in got:
        has = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_id"]["lang_pred"] == "und") == (not has)
    assert li.language_model(spark.createDataFrame([], DOCS)).predict(["abc"])[0] == ["und"]
    kept = li.keep_identified(clash(d), model)
    assert kept.count() == sum(any(c.isalpha() for c in r["text"] or "") for r in got) and "TEXT" in kept.columns


def plain_grams(text, bits=16):
    """Buckets of the 1-, 2- and 3-grams of a text, letter by letter."""
    fold = [ord(c.lower()[0]) if c.isalpha() else 32 for c in f" {text}  "] + [32, 32]
    m, top = 2**32 - 1, 32 - bits
    for i in range(len(fold) - 2):
        a, b, c = fold[i:i + 3]
        h1 = a * 0x9E3779B1 & m
        h2 = (h1 ^ (b * 0x85EBCA77 & m)) * 0x27D4EB2F & m
        h3 = (h2 ^ (c * 0xC2B2AE3D & m)) * 0x9E3779B1 & m
        if a != 32:
            yield (h1 * 0x27D4EB2F & m) >> top
        if a != 32 or b != 32:
            yield h2 >> top
        if b != 32:
            yield h3 >> top


def test_language_query_against_plain_loops(spark):
    """Every prediction and score by loops over characters; all documents are within the bound of the sample here."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    n, seen = collections.defaultdict(collections.Counter), collections.Counter()
    for r in docs:
        if crc(r["doc_id"]) % 5 and r["text"] is not None and r["lang"] is not None:
            seen[r["lang"]] += 1
            n[r["lang"]].update(plain_grams(r["text"]))
    total = {x: sum(n[x].values()) + li.ALPHA * 2**16 for x in seen}
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_language_id"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        g, text = got[r["doc_id"]], r["text"] or ""
        assert g["held_out"] == (crc(r["doc_id"]) % 5 == 0)
        if not any(c.isalpha() for c in text):
            assert (g["lang_pred"], g["score"]) == ("und", 0.0)
            continue
        ks = collections.Counter(plain_grams(text))
        like = {x: math.log(seen[x] / sum(seen.values())) + sum(c * math.log((n[x][k] + li.ALPHA) / total[x]) for k, c in ks.items()) for x in seen}
        best = max(sorted(like), key=like.get)
        assert g["lang_pred"] == best and abs(g["score"] - 1 / sum(math.exp(v - like[best]) for v in like.values())) < 1e-6


def test_language_columns_that_clash(spark):
    d = clash(odd_documents(spark)).withColumn("lang_id", F.lit("mine"))
    model = li.train_language_model(d)
    got = li.predict_language(d, model)
    assert got.columns == [*d.columns, "lang_id"] and {r[-2] for r in got.collect()} == {"mine"}
    assert li.predict_language(d.limit(0), model).count() == 0 and li.keep_identified(d, model).columns == d.columns
    same = li.predict_language(d.unionAll(d), model).collect()
    assert len({(r[1], r[-1]) for r in same}) == len({(r[1], r[-1]) for r in got.collect()})


def test_grams_do_not_span_texts_and_pieces_agree():
    a, b = "abc déf", "Ghi, x"
    alone = [sorted(x) for x in li.grams([a])[0]], [sorted(x) for x in li.grams([b])[0]]
    both, starts, has = li.grams([a, b])
    for k in range(3):
        assert sorted(both[k][:starts[1]]) == alone[0][k] and sorted(both[k][starts[1]:]) == alone[1][k]
    assert has.tolist() == [True, True]
    t = sentence(random.Random(1), 2_000)
    m = li.LanguageModel(["a", "b"], np.random.default_rng(0).normal(size=(2**16 + 1, 2)) * 1e-4, np.zeros(2))
    m.logp[-1] = 0
    want = m.predict([t, "x"])[1]
    old = li._pieces
    try:
        li._pieces = lambda texts: old(texts, 500)
        assert np.allclose(m.predict([t, "x"])[1], want)
    finally:
        li._pieces = old


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_quality_qda"](spark, d).collect()}
    labels = [r for r in spark.read.parquet(f"{d}/labels.parquet").collect() if crc(r["doc_id"]) % 4 == 2]
    assert all(r["held_out"] == (crc(i) % 4 == 2) and (r["predicted"] == 1) == (r["score"] >= 0.7) for i, r in got.items())
    assert np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) > 0.97


def plain_statistics(text):
    """The 16 statistics of a text, character by character and word by word."""
    def kind(ch):
        return ("punctuation" if ch in ".,;:!?'\"()-’“”¿¡" else "symbol" if ch in "#$%&*+/<=>@[\\]^_`{|}~" else ("upper" if ch.isupper() else "lower")
                if ch.isalpha() else "digit" if ch.isdigit() else "space" if ch.isspace() else "other")
    k = collections.Counter(map(kind, text))
    n, words, lines = len(text), text.split(), [x for x in text.split("\n") if x.strip()]
    w, solid, raw = len(words), n - k["space"], text.encode()
    odds = lambda x, m: math.log((x + 0.5) / (max(m - x, 0) + 0.5))
    return [math.log1p(n), math.log1p(w), math.log1p(solid / max(w, 1)), odds(k["upper"], k["upper"] + k["lower"]), odds(k["digit"], solid),
            odds(k["punctuation"], solid), odds(k["symbol"], solid), odds(k["space"], n), odds(k["other"], solid),
            odds(sum(len(x) > 1 and x.isupper() for x in words), w), odds(sum(not x[-1].isalnum() and x[-1] not in ".,;:!?'\")" for x in words), w),
            odds(len(set(words)), w), odds(len(lines) - len(set(lines)), len(lines)), math.log1p(w / max(len(lines), 1)),
            odds(sum(len(x) <= 3 for x in words), w), math.log((len(zlib.compress(raw, 1)) + 20) / (len(raw) + 20))]


def test_quality_query_against_plain_densities(spark):
    """Every score from plain statistics and the densities written out with inverse and determinant."""
    docs = {r["doc_id"]: np.array(plain_statistics(r["text"] or "")) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = [(r["quality"], docs[r["doc_id"]]) for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()
            if crc(r["doc_id"]) % 4 != 2 and r["quality"] in (0, 1) and r["doc_id"] in docs]
    x = [np.array([v for y, v in rows if y == c]) for c in (0, 1)]
    d, n = len(ql.NAMES), np.array([len(v) for v in x])
    cov = [np.cov(v.T, bias=True) for v in x]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    pooled = (1 - ql.DIAGONAL) * pooled + ql.DIAGONAL * (np.diag(np.diag(pooled)) + ql.FLOOR * np.eye(d))
    shrunk = []
    for c in (0, 1):
        lam = max(ql.POOL, d / (d + n[c]))
        shrunk.append((1 - lam) * cov[c] + lam * pooled + ql.FLOOR * np.eye(d))
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_quality_qda"](spark, DATA).collect()}
    assert len(got) == len(docs)
    for i, v in docs.items():
        dens = [math.log(n[c] / n.sum()) - 0.5 * ((v - x[c].mean(0)) @ np.linalg.inv(shrunk[c]) @ (v - x[c].mean(0)) + np.linalg.slogdet(shrunk[c])[1]) for c in (0, 1)]
        want = 1 / (1 + math.exp(min(700, dens[0] - dens[1])))
        assert abs(got[i]["score"] - want) < 1e-6 and got[i]["predicted"] == int(got[i]["score"] >= 0.7) and got[i]["held_out"] == (crc(i) % 4 == 2)


def test_very_long_texts(spark):
    """A text of more than a million characters goes through every operator whole: what matters stands at its end."""
    r = random.Random(12)
    item = sentence(r, 40)
    body = sentence(r, 250_000, [sentence(r, 1) for _ in range(20_000)])
    assert len(body) > 1_000_000
    d = spark.createDataFrame([(1, f"{body} {item} write to end@of.text", "en", "a", 0), (2, "жук лес " * 30, "de", "a", 0), (3, body, "en", "a", 0)], DOCS)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [tuple(x)[:2] for x in dc.contaminated_pairs(d, bench).collect()] == [(1, 1)]
    assert sorted(x["doc_id"] for x in dc.keep_clean(d, bench).collect()) == [2, 3]
    text = {x["doc_id"]: x["text"] for x in d.collect()}
    spans = {x["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in x["base"]] for x in pii.find_pii(d, pii.train_crf(d)).collect()}
    assert spans == {1: [("email", text[1].index("end@"), len(text[1]))], 2: [], 3: []}
    stats = ql.document_statistics(d.select("doc_id", "text")).collect()
    assert all(np.allclose(x["stats"], plain_statistics(x["text"])) for x in stats)
    model = li.train_language_model(d)
    got = {x["doc_id"]: x["lang_id"]["lang_pred"] for x in li.predict_language(d.select("doc_id", "text"), model).collect()}
    assert got == {1: "en", 2: "de", 3: "en"}


def test_quality_odd_texts(spark):
    d = clash(odd_documents(spark))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = ql.classify_quality(d, none).collect()
    assert len(got) == d.count() and {r["score"] for r in got} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 112)] + [(100, None), (None, 1)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in ql.classify_quality(d, clash(labels)).collect())
    assert ql.classify_quality(spark.createDataFrame([], DOCS), labels).count() == 0


def test_discriminant_against_the_densities():
    r = np.random.default_rng(3)
    x = [r.normal(size=(400, 3)), r.normal(size=(300, 3)) * [1, 2, 0.5] + [2, 0, 1]]
    n = np.array([400.0, 300.0])
    m = ql.fit_qda(n, np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), pool=0.0, diagonal=0.0)
    lam = 3 / (3 + n)
    cov = [np.cov(v.T, bias=True) for v in x]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    p = r.normal(size=(50, 3))
    dens = []
    for c in (0, 1):
        s = (1 - lam[c]) * cov[c] + lam[c] * pooled + ql.FLOOR * np.eye(3)
        z = p - x[c].mean(0)
        dens.append(np.log(n[c] / n.sum()) - 0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(s), z) + np.linalg.slogdet(s)[1]))
    assert np.allclose(m.score(p), 1 / (1 + np.exp(dens[0] - dens[1])))


def plain_spans(text):
    out = []
    for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                 ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": k != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}[k]
            if ok:
                out.append((k, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_against_the_plain_patterns():
    r = random.Random(1)
    for _ in range(8_000):
        t = "".join(r.choice("aA1.@+ -()9é0_%\n25") for _ in range(r.randint(0, 60)))
        assert plain_spans(t) == pii.base_spans(t)
    t = time.time()  # the plain patterns would take hours here
    pii.base_spans("a" * 300_000 + "@" * 1_000 + "1." * 50_000 + "1" * 50_000 + "+ " * 1_000)
    assert time.time() - t < 10


def test_loopy_propagation_is_exact_on_a_chain():
    r = np.random.default_rng(5)
    k, n = len(pii.LABELS), 4
    m = pii.Crf(r.normal(size=(pii.FEATURES, k)), r.normal(size=(k, k)), r.normal(size=(k, k)))
    bits = r.integers(0, 2**pii.FEATURES, n)
    chain = np.array([(0, 1), (1, 2)])
    skip = np.array([(2, 3)])
    got = m.marginals(bits, chain, skip, rounds=60)
    u = pii.unpack(bits) @ m.unary
    joint = np.zeros([k] * n)
    for x in np.ndindex(*joint.shape):
        joint[x] = sum(u[i, x[i]] for i in range(n)) + m.chain[x[0], x[1]] + m.chain[x[1], x[2]] + m.skip[x[2], x[3]]
    p = np.exp(joint - joint.max())
    p /= p.sum()
    assert np.allclose(got, [p.sum(tuple(j for j in range(n) if j != i)) for i in range(n)], atol=1e-6)


def plain_marginals(m, bits, chain, skip):
    """The same message passing with plain loops, of one document."""
    k = len(pii.LABELS)
    own = [[sum(m.unary[f][y] for f in range(pii.FEATURES) if b >> f & 1) for y in range(k)] for b in bits]
    table = {}
    for edges, pot in ((chain, m.chain), (skip, m.skip)):
        for e, (a, b) in enumerate(edges):
            table[id(pot), e, a, b] = (a, b, pot)
            table[id(pot), e, b, a] = (b, a, pot.T)
    back = {x: (x[0], x[1], x[3], x[2]) for x in table}
    msg = {x: [0.0] * k for x in table}
    for _ in range(pii.ROUNDS):
        into = [list(o) for o in own]
        for x, (_, b, _) in table.items():
            into[b] = [u + v for u, v in zip(into[b], msg[x])]
        new, moved = {}, 0.0
        for x, (a, _, pot) in table.items():
            raw = [np.logaddexp.reduce([into[a][y] - msg[back[x]][y] + pot[y][z] for y in range(k)]) for z in range(k)]
            new[x] = [0.5 * o + 0.5 * (v - max(raw)) for o, v in zip(msg[x], raw)]
            moved = max([moved, *(abs(u - v) for u, v in zip(new[x], msg[x]))])
        msg = new
        if moved < pii.TOLERANCE:
            break
    into = [list(o) for o in own]
    for x, (_, b, _) in table.items():
        into[b] = [u + v for u, v in zip(into[b], msg[x])]
    p = np.exp(np.array(into) - np.max(into, axis=1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def test_propagation_on_loops_against_brute_force():
    r = np.random.default_rng(7)
    k, n = len(pii.LABELS), 4
    chain, skip = np.array([(0, 1), (1, 2), (2, 3)]), np.array([(0, 2), (1, 3)])
    for scale, near in ((0.3, 0.02), (1.0, 0.2)):
        m = pii.Crf(r.normal(size=(pii.FEATURES, k)), scale * r.normal(size=(k, k)), scale * r.normal(size=(k, k)))
        bits = r.integers(0, 2**pii.FEATURES, n)
        u = pii.unpack(bits) @ m.unary
        joint = np.zeros([k] * n)
        for x in np.ndindex(*joint.shape):
            joint[x] = sum(u[i, x[i]] for i in range(n)) + sum(m.chain[x[a], x[b]] for a, b in chain) + sum(m.skip[x[a], x[b]] for a, b in skip)
        p = np.exp(joint - joint.max())
        p /= p.sum()
        exact = np.array([p.sum(tuple(j for j in range(n) if j != i)) for i in range(n)])
        got = m.marginals(bits, chain, skip)
        assert np.allclose(got, exact, atol=near) and np.allclose(got, plain_marginals(m, bits.tolist(), chain.tolist(), skip.tolist()), atol=1e-6)
        both = m.marginals(np.concatenate([bits, bits[:2]]), np.concatenate([chain, [(4, 5)]]), skip, np.array([0, 0, 0, 0, 1, 1]))
        assert np.allclose(both[:4], got, atol=1e-12)  # other documents don't matter


def test_missed_mentions_are_found_by_their_like():
    r = random.Random(5)
    card = lambda: next(d for _ in range(99) if pii.luhn(d := "4" + "".join(r.choice("0123456789") for _ in range(15))))
    texts = []
    for i in range(300):
        c, ip = card(), ".".join(str(r.randrange(256)) for _ in range(4))
        texts.append(f"{sentence(r, 5)} {c} then {ip} and {r.randrange(10**6)} again {c}, {ip} or +1 (555) 555-{r.randrange(10**4):04d} a{i}@b.org {sentence(r, 3)} a{i}@b.org")
    rows = [(t, *pii.graph(t, pii.base_spans(t))) for t in texts]
    shift = np.cumsum([0, *(len(x[1]) for x in rows)])
    edge = lambda k: np.array([(a + s, b + s) for x, s in zip(rows, shift) for a, b in x[k]], np.int64).reshape(-1, 2)
    m = pii.fit_crf(np.array([b for x in rows for b in x[2]]), np.array([b for x in rows for b in x[3]]), edge(4), edge(5))
    assert (np.diag(m.skip)[1:4] > 1).all()  # like tokens share their labels
    c = card()
    for text, more in ((f"pay {c} twice {c} {c} end", 2), (f"number 123456 and {c}", 0), ("write to A1@B.org", 0)):
        base, spans = pii.find_all([text], m)[0]
        assert base == pii.base_spans(text) and len(spans) - len(base) == more and set(base) <= set(spans)
    # many spans near one token, and tokens with many like them: nothing is looked up in a fixed reach
    long = " ".join([c] + ["word"] * 3) + " " + " x ".join([c] * 200) + f" x {c} {c}"
    assert sum(s[0] == "card" for s in pii.find_all([long], m)[0][1]) == 203


def plain_find(text, model):
    spans = pii.base_spans(text)
    toks, bits, own, chain, skip = pii.graph(text, spans)
    if not toks:
        return spans
    p = plain_marginals(model, bits, chain, skip)
    kind = [int(x.argmax()) if x.max() >= pii.SURE and not o else 0 for x, o in zip(p, own)]
    new, i = [], 0
    while i < len(toks):
        j = i
        while kind[i] == pii.LABELS.index("phone") and j + 1 < len(toks) and (j, j + 1) in chain and kind[j + 1] == kind[i]:
            j += 1
        if kind[i]:
            new.append((pii.LABELS[kind[i]], toks[i][0], toks[j][1]))
        i = j + 1
    return sorted(spans + new, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_pii_spans_of_the_query_against_plain_loops(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = pii.train_crf(docs)
    got = {r["doc_id"]: r["spans"] for r in queries.QUERIES["op7_pii_crf"](spark, DATA).select("doc_id", "spans").collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == pii.joined(plain_find(r["text"] or "", model))


def test_pii_query_and_repeats(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_pii_crf"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        base = plain_spans(r["text"] or "")
        g = got[r["doc_id"]]
        assert g["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [g[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(filter(None, pii.joined(base).split(","))) <= set(filter(None, g["spans"].split(",")))
    model = pii.train_crf(spark.read.parquet(f"{DATA}/documents.parquet"))
    card = "4952935900253052"
    base, spans = pii.find_all([f"card {card} and twice {card} {card} at last"], model)[0]
    assert [s[0] for s in base] == ["card"] and len(spans) == 3  # two numbers side by side are no base match, yet alike


def test_pii_odd_texts(spark):
    d = clash(odd_documents(spark, [(300, "mail a.b@c.de, twice a.b@c.de. call +1 (017) 555-7713!", "en", "a")]))
    model = pii.train_crf(d)
    got = {r["doc_id"]: r for r in pii.find_pii(d, model).collect()}
    assert len(got[300]["base"]) == 3 and got[2]["spans"] == [] and got[1]["spans"] == []
    assert pii.find_pii(spark.createDataFrame([], DOCS), pii.train_crf(spark.createDataFrame([], DOCS))).count() == 0


def greedy(doc, item, least):
    """Greedy string tiling as defined: the longest unmarked match first."""
    fd, fp, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and fd[i + n] and fp[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return sum(out)
        n, i, j = best
        for k in range(n):
            fd[i + k] = fp[j + k] = False
        out.append(n)


def test_tiling_against_the_definition():
    r = random.Random(9)
    for _ in range(150):
        item = [r.randrange(1, 12) for _ in range(r.randint(3, 40))]
        doc = [r.randrange(1, 12) for _ in range(r.randint(0, 20))] + item[10:25] + [0] + item[:9] + [r.randrange(1, 12) for _ in range(5)]
        tiles = dc.tile(np.array(doc), np.array(item), 3)
        assert all(doc[i:i + n] == item[j:j + n] for i, j, n in tiles)
        assert len({x for i, _, n in tiles for x in range(i, i + n)}) == sum(n for _, _, n in tiles) == len({x for _, j, n in tiles for x in range(j, j + n)})
        assert sum(n for _, _, n in tiles) == greedy(doc, item, 3)
    long = list(range(1, 300))
    assert dc.tile(np.array(long), np.array(long[50:200]), 5) == [(50, 0, 150)]


def test_tiling_of_repetitive_texts_is_fast():
    t = time.time()
    assert dc.tile(np.ones(20_000, int), np.ones(2_000, int)) == [(0, 0, 2_000)]
    assert time.time() - t < 1
    r = random.Random(4)
    for _ in range(20):
        doc, item = ([r.choice([1, 1, 1, 2]) for _ in range(n)] for n in (150, 60))
        assert sum(n for _, _, n in dc.tile(np.array(doc), np.array(item), 3)) == greedy(doc, item, 3)
    runs = np.concatenate([[2 + k] + [1] * (5 + k) for k in range(60)])  # as many lengths as can be
    t = time.time()
    b = dc.Bench([(k, ["spam"] * 2_000) for k in range(3)] + [(9, [f"w{x}" if x > 1 else "spam" for x in runs])], 5)
    got = b.matches("spam " * 20_000, 0.5)
    assert sorted((k, n) for k, _, n, _ in got)[:3] == [(k, 2_000) for k in range(3)] and time.time() - t < 20


def test_contamination(spark):
    r = random.Random(3)
    items = [(i, sentence(r, 30)) for i in range(6)] + [(6, "too short"), (7, None), (None, sentence(r, 20)), (1, sentence(r, 30))]
    w = items[0][1].split()
    docs = [(1, "before " + items[0][1].upper() + ", after", "en", "a"), (2, " ".join(w[15:] + ["between"] + w[:15]), "en", "a"), (3, " ".join(w[:10]), "en", "a"),
            (4, sentence(r, 200), "en", "a"), (5, items[2][1] + " " + items[3][1], "en", "a"), (5, items[2][1], "en", "a")]
    d = odd_documents(spark, [(500 + i, *x) for i, *x in docs])
    bench = spark.createDataFrame(items, "item_id long, text string")
    for words in (dc.PASS_WORDS, 40):
        got = sorted((r["doc_id"], r["item_id"]) for r in dc.contaminated_pairs(clash(d), bench, pass_words=words).collect())
        assert got == [(501, 0), (502, 0), (505, 2), (505, 2), (505, 3)]
    for words in (dc.PASS_WORDS, 40):
        clean = dc.keep_clean(clash(d), bench, pass_words=words)
        assert clean.count() == d.count() - 4 and clean.columns == clash(d).columns
    assert dc.keep_clean(d.limit(0), bench).count() == 0 and dc.keep_clean(d, bench.limit(0)).count() == d.count()
    assert dc.contaminated_pairs(d, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert dc.contaminated_pairs(spark.createDataFrame([], DOCS), bench).count() == 0


def test_contamination_query_against_brute_force(spark):
    item = {r["item_id"]: dc.words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        w = dc.words(r["text"])
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for k, it in item.items():
            if any(tuple(it[j:j + 5]) in grams for j in range(len(it) - 4)) and greedy(w, it, 5) >= 0.5 * len(it):
                want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op2_string_tiling"](spark, SMALL).collect()}
    assert got == want


@pytest.mark.parametrize("text", ["", "a", "a b c d e", None])
def test_short_texts_match_nothing(text):
    b = dc.Bench([(1, "one two three four five six".split())], 5)
    assert b.matches(text, 0.5) == []


def test_items_shorter_than_a_tile(spark):
    texts = ["Who wrote Faust?", "they ask: who WROTE faust, and then more of it, and who wrote faust again", "who wrote", "who did write faust", None, "", "faust"]
    d = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(1, "who wrote faust"), (2, "Who wrote Faust"), (3, "..."), (4, "one two three four five six")], "item_id long, text string")
    for words in (dc.PASS_WORDS, 3):
        got = dc.contaminated_pairs(clash(d), bench, pass_words=words).collect()
        assert sorted((r["doc_id"], r["item_id"], r["coverage"], r["covered"], len(r["tiles"]), r["tiles"][0]["start"]) for r in got) == [
            (0, 1, 1.0, 3, 1, 0), (0, 2, 1.0, 3, 1, 0), (1, 1, 1.0, 3, 1, 2), (1, 2, 1.0, 3, 1, 2)]
    assert sorted(r["doc_id"] for r in dc.keep_clean(d, bench).collect()) == [2, 3, 4, 5, 6]
