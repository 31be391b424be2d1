"""Near-duplicate detection by Order MinHash and banded alignment."""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import Scratch, join_by_key, pick, positional, read, ship

SHINGLE, SIMILARITY = 5, 0.8
#: Sketches of a text, and labelled shingles that each retains in text order.
SKETCHES, RETAINED, SEED = 20, 2, 13
#: Texts in a bucket up to which all its pairs are compared; rounds of leaders for larger ones.
SMALL, ROUNDS = 16, 3
#: Texts of an open part that a task compares with those of another block; bins for the bounds of what two texts share, the quick one first.
BLOCK, BINS = 2_000, (64, 512)
#: Texts that are compared with one copy of a leader's text; rows of a bucket that one task of a join takes.
FAN, PART_ROWS = 64, 1_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Stable hashes of words (CRC-32), kept while there are not too many. Words
    that collide matter only next to four equal ones in the same place."""

    def __missing__(self, w: str) -> int:
        if len(self) > 50_000:
            self.clear()
        h = self[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        return h


def _parts(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Short slices: only so many texts are Python strings at a time."""
    for b in batches:
        for i in range(0, b.num_rows, size):
            yield b.slice(i, size)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _digest(ws: list[str]) -> bytes | None:
    return hashlib.md5(" ".join(ws).encode("utf-8", "surrogatepass")).digest() if ws else None


def hashes(ws: list[str], known: Words) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))


def shingles(ws: list[str], known: Words, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words in text order; of a shorter text, of all its words."""
    return shingled(hashes(ws, known), size)


def shingled(x: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    if not len(x):
        return np.zeros(0, np.uint64)
    size = min(size, len(x))
    n = len(x) - size + 1
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ x[k:k + n]) * _A
            out ^= out >> np.uint64(29)
        return _mix(out)


def labelled(s: np.ndarray) -> np.ndarray:
    """Hashes of the elements, each labelled with its occurrence number; no two are the same."""
    order = np.argsort(s, kind="stable")
    run = s[order]
    new = np.concatenate([[True], run[1:] != run[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    occurrence = np.empty(len(s), np.uint64)
    occurrence[order] = (np.arange(len(s)) - first).astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(s + occurrence * _A)


def sketch(s: np.ndarray, count: int = SKETCHES, retained: int = RETAINED, seed: int = SEED) -> tuple[list[int], int]:
    """(sketches, distinct shingles). Every shingle is labelled with its
    occurrence number; a sketch hashes, in text order, the ``retained``
    labelled shingles that are least under its own random order."""
    x = labelled(s)
    kept = x[_least(x, count, retained, seed)]
    return _folded(kept), len(np.unique(s))


def bucket_keys(s: np.ndarray, count: int = SKETCHES, retained: int = RETAINED, seed: int = SEED) -> tuple[np.ndarray, int]:
    """(keys of buckets, distinct shingles): the values of ``sketch`` and, for a text
    that repeats a shingle, also those of its shingles' first occurrences alone, by
    which it agrees with a text that has the same ones without the repeats."""
    u, first = np.unique(s, return_index=True)
    keys = sketch(s, count, retained, seed)[0]
    if len(u) < len(s):
        keys = keys + sketch(s[np.sort(first)], count, retained, seed)[0]
    return np.unique(np.array(keys, np.int64)), len(u)


def _least(labelled: np.ndarray, count: int, retained: int, seed: int) -> np.ndarray:
    """Places, in text order, of the least values under each random order."""
    with np.errstate(over="ignore"):
        seeds = np.array([(seed * 1_000_003 + c) * 0xD1B54A32D192ED03 % 2**64 for c in range(count)], np.uint64)
        k = min(retained, len(labelled))
        least = np.empty((count, k), np.int64)
        step = max(1, 2_000_000 // len(labelled))  # a long text's orders are made a few at a time
        for c in range(0, count, step):
            h = (labelled[None, :] ^ seeds[c:c + step, None]) * _B
            at = np.arange(len(h))
            for j in range(k):
                least[c:c + step, j] = h.argmin(axis=1)
                h[at, least[c:c + step, j]] = np.uint64(2**64 - 1)
    return np.sort(least, axis=1)


def _folded(kept: np.ndarray) -> list[int]:
    with np.errstate(over="ignore"):
        v = np.arange(1, len(kept) + 1, dtype=np.uint64)
        for j in range(kept.shape[1]):
            v = _mix((v ^ kept[:, j]) * _A)
    return v.astype(np.int64).tolist()


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Order-keeping similarity of two shingle sequences: distinct shingles that
    a longest common subsequence within a band pairs up, over all distinct ones.

    Equal to the Jaccard similarity where the common shingles come in the
    same order. 0 without alignment if the sets alone rule the threshold out.
    The band is as wide as a similarity of ``threshold`` allows.
    """
    if not len(a) or not len(b):
        return 0.0
    ua, ub = np.unique(a), np.unique(b)
    common = np.intersect1d(ua, ub, assume_unique=True)
    if len(common) < threshold * (len(ua) + len(ub) - len(common)):
        return 0.0
    band = abs(len(a) - len(b)) + int((1 - threshold) * max(len(a), len(b))) + 8
    pa, pb = np.flatnonzero(np.isin(a, common)), np.flatnonzero(np.isin(b, common))
    xa, xb = np.searchsorted(common, a[pa]), np.searchsorted(common, b[pb])
    places: list[list[int]] = [[] for _ in common]
    for x, j in zip(xb.tolist(), pb.tolist()):
        places[x].append(j)
    matches = int(np.bincount(xa, minlength=len(common)) @ np.bincount(xb, minlength=len(common)))
    if matches > 40 * (len(a) + len(b)):
        used = _banded_rows(a, b, band)
        got = len(np.unique(a[used]))
    else:
        # Hunt-Szymanski: the matches of each place, last first, in a longest increasing run
        tails: list[int] = []
        nodes: list[tuple[int, object]] = []
        for i, x in zip(pa.tolist(), xa.tolist()):
            for j in reversed(places[x]):
                if abs(i - j) <= band:
                    k = bisect_left(tails, j)
                    node = (x, nodes[k - 1] if k else None)
                    if k == len(tails):
                        tails.append(j)
                        nodes.append(node)
                    else:
                        tails[k], nodes[k] = j, node
        seen, node = set(), nodes[-1] if nodes else None
        while node:
            seen.add(node[0])
            node = node[1]
        got = len(seen)
    return got / (len(ua) + len(ub) - got)


def _banded_rows(a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray:
    """Places of ``a`` in a longest common subsequence within the band, row by
    row in numpy; for texts of many repeats. Keeps a bit per cell."""
    m = len(b)
    width = min(2 * band + 1, m + 2 * band + 1)
    prev = np.zeros(m + 1, np.int32)
    grew, steps = [], []
    for i in range(len(a)):
        lo, hi = max(0, i - band), min(m, i + band + 1)
        if lo >= hi:
            grew.append(np.zeros(0, np.uint8))
            steps.append((lo, 0))
            continue
        diag = prev[lo:hi] + (b[lo:hi] == a[i])
        best = np.maximum(diag, prev[lo + 1:hi + 1])
        row = np.maximum.accumulate(np.maximum(best, prev[lo] if lo else 0))
        grew.append(np.packbits(row > prev[lo + 1:hi + 1]))
        steps.append((lo, hi - lo))
        prev = prev.copy()
        prev[lo + 1:hi + 1] = row
        prev[hi + 1:] = np.maximum(prev[hi + 1:], row[-1])
    used, j = [], m
    for i in range(len(a) - 1, -1, -1):
        lo, n = steps[i]
        if not n or j <= lo:
            continue
        bits = np.unpackbits(grew[i], count=n)
        at = min(j, lo + n) - 1
        if bits[at - lo]:
            hit = np.flatnonzero(b[lo:at + 1] == a[i])
            if len(hit):
                used.append(i)
                j = lo + int(hit[-1])
    return np.array(used[::-1], np.int64)


def common_words(a: list[int], b: list[int], band: int) -> int:
    """Length of a longest common subsequence of two word sequences within a band:
    pairs of equal words whose places differ by ``band`` at most. Bit-parallel, a
    bit per place of ``a``; only the bits of the band are held, in blocks of rows."""
    got, low, width, v = 0, 0, 0, 0  # v: places low .. low + width of a, a zero where the length grows
    for at in range(0, len(b), band + 256):
        upto = at + band + 256
        lo, hi = min(len(a), max(0, at - band)), min(len(a), upto + band)
        gone = v & ((1 << (lo - low)) - 1)  # out of reach from here on
        got += min(width, lo - low) - gone.bit_count()
        v >>= lo - low
        width = max(0, width - (lo - low))
        v |= ((1 << (hi - lo - width)) - 1) << width
        low, width = lo, hi - lo
        places: dict[int, int] = {}
        for k, w in enumerate(a[lo:hi]):
            places[w] = places.get(w, 0) | (1 << k)
        full = (1 << width) - 1
        for i, w in enumerate(b[at:upto], at):
            if m := places.get(w):
                if i - band > lo:  # places before the band
                    m = m >> (i - band - lo) << (i - band - lo)
                m &= (1 << max(0, i + band + 1 - lo)) - 1
                u = v & m
                v = ((v + u) | (v - u)) & full
    return got + width - v.bit_count()


class Compared:
    """A text to be compared: word hashes and what is derived of them."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.words, self.counts = np.unique(x, return_counts=True)

    @cached_property
    def s(self) -> np.ndarray:
        return shingled(self.x)

    @cached_property
    def repeats(self) -> bool:
        return len(np.unique(self.s)) < len(self.s)


def share_in_order(a: Compared, b: Compared, threshold: float = SIMILARITY) -> float:
    """Words that a banded alignment pairs up, over the words of the longer text;
    0 without alignment if lengths or word counts alone rule the threshold out."""
    n = max(len(a.x), len(b.x))
    least = math.ceil(threshold * n - 1e-9)
    if not n or min(len(a.x), len(b.x)) < least:
        return 0.0
    _, ia, ib = np.intersect1d(a.words, b.words, assume_unique=True, return_indices=True)
    if np.minimum(a.counts[ia], b.counts[ib]).sum() < least:
        return 0.0
    m = min(len(a.x), len(b.x))
    differ = np.flatnonzero(a.x[:m] != b.x[:m])
    head = int(differ[0]) if len(differ) else m  # equal ends are in some longest alignment
    m -= head
    differ = np.flatnonzero(a.x[len(a.x) - m:][::-1] != b.x[len(b.x) - m:][::-1])
    tail = int(differ[0]) if len(differ) else m
    x, y = a.x[head:len(a.x) - tail].tolist(), b.x[head:len(b.x) - tail].tolist()
    return (head + tail + common_words(x, y, n - least)) / n


def alike(a: Compared, b: Compared, threshold: float = SIMILARITY) -> bool:
    """Whether two texts are linked: by words in order or, where one repeats shingles, by distinct shingles in order."""
    return share_in_order(a, b, threshold) >= threshold or (
        (a.repeats or b.repeats) and aligned(a.s, b.s, threshold) >= threshold)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the least node of each node's component. edges: a, b.

    Labels spread along edges and then to the labels' own labels, so the
    rounds grow with the logarithm of the longest path; lineage is cut in
    each round, and only a count comes to the driver.
    """
    both = scratch.cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    label = scratch.cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                        .select("node", F.least("node", "m").alias("label"), F.lit(True).alias("moved")))
    while True:
        near = (both.join(label.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("l")))
        step = label.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "l").alias("label"))
        up = label.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = scratch.cut(step.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label"),
                                                                (F.coalesce("above", "label") != F.col("was")).alias("moved")))
        scratch.drop(label)
        label = new
        if not label.filter("moved").limit(1).count():
            scratch.drop(both)
            return label.drop("moved")


class _Links:
    """Components of the links found so far: (node, label) for nodes that have any."""

    def __init__(self, scratch: Scratch) -> None:
        self.scratch, self.label = scratch, None

    def named(self, d: DataFrame) -> DataFrame:
        """``d`` with the label of its column node; a node without links is its own."""
        if self.label is None:
            return d.withColumn("label", F.col("node"))
        return d.join(self.label, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def add(self, edges: DataFrame) -> None:
        """Links between labels join components: what is solved is the graph of the old labels."""
        if self.label is None:
            self.label = self.scratch.cut(components(edges, self.scratch))
            return
        one = self.named(edges.withColumnRenamed("a", "node")).select(F.col("label").alias("la"), F.col("b").alias("node"))
        both = self.named(one).select(F.col("la").alias("a"), F.col("label").alias("b")).filter("a != b")
        joined = components(both, self.scratch)
        new = self.label.unionByName(joined.select("node", F.col("node").alias("label")).join(self.label.select("node"), "node", "left_anti"))
        up = joined.select(F.col("node").alias("label"), F.col("label").alias("above"))
        old, self.label = self.label, self.scratch.cut(new.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")))
        self.scratch.drop(old)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    sketches: int = SKETCHES, retained: int = RETAINED, small: int = SMALL, rounds: int = ROUNDS,
                    seed: int = SEED) -> DataFrame:
    """One row per input row: id, class_id (least id of its class), class_size, kept.

    Words are runs of non-space in lower case, shingles five of them. Two
    texts are linked if a banded alignment pairs up ``similarity`` of the
    longer one's words (``share_in_order``), or, where one of them repeats
    shingles, that share of their distinct shingles (``aligned``); without
    repeats the former holds wherever the latter does. Classes are connected
    components of the links, and ``kept`` marks the row with the least id.

    1. One pass over the texts keeps a digest, the counts of words and of
       distinct shingles, and ``sketches`` Order MinHash values per row; of
       texts that repeat a shingle also those of the first occurrences alone.
       Equal texts become one node by a map-side combined aggregate, however
       many there are.
    2. Nodes with an equal value share a bucket. Round 1 compares each
       node with its bucket's leader (the least in one random order for all
       buckets, so copies of one text meet the same leader). Larger buckets
       that still hold several components are then split by size: linked
       texts are less than a ratio of 1 / ``similarity`` apart in words or in
       distinct shingles, so with ranges of that ratio, each overlapping the
       next, they share a part. Only parts with something left to compare are
       formed: of several components, not of texts alone that meet in the
       range below, and by shingles only where a text repeats some. Up to
       ``small`` nodes all remaining pairs are compared; where all but
       ``small`` nodes are of one component, the others are compared with
       all. Only parts larger than a block have further rounds, in which each
       node outside the component of a leader drawn anew is compared with it.
    3. All pairs of the parts that are still open are compared,
       whatever its size: it is cut into blocks of ``BLOCK`` nodes that meet
       two by two in tasks, where counts of words and shingles in bins rule
       most pairs out, pairs of one component are passed over and the others
       are aligned. So of texts that share a bucket no link between
       components is lost. Work grows with the square of a part, rows with
       its size times its number of blocks.

    Two texts that share x of their labelled shingles agree in a sketch with a
    chance of x ** ``retained``, so they share no bucket with one of
    (1 - x ** 2) ** 20: 1 in 10^9 at 0.8, 3 in 1 000 at 0.5, 3 in 100 at 0.4,
    15 in 100 at 0.3; what is linked with changes spread evenly over all the
    text may share less than that.

    Every comparison is filtered by counts first (their ratios bound the
    similarity) and then aligned in Python, where the leader's text and
    up to ``FAN`` others are read one after another. A leader is found by a
    combined minimum, not by sorting a bucket, and rows of a bucket are dealt
    to parts of some ``PART_ROWS`` for every join with it: no bucket is
    gathered in one task, and no large bucket's pairs are all listed. Texts
    of nodes that have a bucket are shuffled once, by node, and kept on disk
    for all rounds, whatever their number.

    Null and blank texts are classes of their own. Texts of five words or
    fewer have one shingle and meet only texts that have it too. Rows that
    repeat an id are in the class of their text; all of them are kept if the
    id is the least. An empty table gives an empty result. Extra columns are
    ignored.
    """
    rows, classes = _classes(docs, id_col, text_col, similarity, sketches, retained, small, rounds, seed)
    out = _with_classes(rows, classes)
    return out.select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
                      F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"),
                      F.col("id").eqNullSafe(F.coalesce("class_id", "id")).alias("kept"))


def _with_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    # rows without words get a key of their own, so that they spread evenly over the join
    key = F.coalesce("digest", F.concat(F.lit(b"\0"), F.col("row").cast("string").cast("binary")))
    return join_by_key(rows.select("id", "row", "mark", key.alias("digest")), classes, "digest", "copies", "left")


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             sketches: int = SKETCHES, retained: int = RETAINED, small: int = SMALL, rounds: int = ROUNDS,
             seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): id, row (unique), mark (of the text), digest of every row; and for
    every digest its copies, class_id, class_size and best, the row of its class that is kept."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    d = pick(docs, id=id_col, text=text_col)
    kind = dict(d.dtypes)["id"]
    if kind in ("bigint", "int") and not d.groupBy("id").count().filter("count > 1 or id is null").limit(1).count():
        d = d.withColumn("row", F.col("id").cast("bigint"))
    else:  # ids that repeat, are null or no numbers: rows are numbered, once for all
        d = scratch.cut(d.withColumn("row", F.monotonically_increasing_id()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for p in _parts(batches):
            keys, lens, sizes, values = [], [], [], []
            for t in p.column("text").to_pylist():
                ws = words_of(t)
                keys.append(_digest(ws))
                s = shingles(ws, known)
                v, n = bucket_keys(s, sketches, retained, seed) if len(s) else ([], 0)
                lens.append(len(ws))
                sizes.append(n)
                values.append(v)
            yield pa.RecordBatch.from_arrays(
                [p.column("id"), p.column("row"), p.column("mark"), pa.array(keys, pa.binary()), pa.array(lens, pa.int32()), pa.array(sizes, pa.int32()),
                 pa.array(values, pa.list_(pa.int64()))], names=["id", "row", "mark", "digest", "w", "n", "keys"])

    rows = scratch.cut(d.select("id", "row", "text", F.unhex(F.md5("text")).alias("mark")).mapInArrow(
        scan, f"id {kind}, row long, mark binary, digest binary, w int, n int, keys array<long>"))
    best = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row", "mark"))
    nodes = scratch.cut(rows.filter("digest is not null").groupBy("digest").agg(
        best.alias("best"), F.min("row").alias("node"), F.first("w").alias("w"), F.first("n").alias("n"), F.first("keys").alias("keys"),
        F.count(F.lit(1)).alias("copies")))

    members = nodes.select(F.explode("keys").alias("key"), "node", "w", "n")
    shared = scratch.cut(members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    members = scratch.cut(join_by_key(members, shared, "key", "size"))

    # the texts that are compared, by node; not a checkpoint, as lost parts are read again from the tables
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = (d.filter("text is not null").select(F.col("row").alias("node"), "text").repartition(parts, "node")
             .join(members.select("node").distinct(), "node", "left_semi").persist(StorageLevel.DISK_ONLY))

    def verify(pairs: DataFrame) -> DataFrame:
        """Links (a, b) among pairs of a leader and a node."""
        pairs = scratch.cut(pairs.select("lead", "node").distinct())
        fans = scratch.cut(pairs.groupBy("lead").agg(F.count(F.lit(1)).alias("asked")).withColumn("fans", F.ceil(F.col("asked") / FAN).cast("int")))
        asked = join_by_key(pairs, fans, "lead", "asked").select(
            "node", "lead", F.pmod(F.xxhash64("node"), "fans").cast("int").alias("fan"), F.lit(1).alias("member"))
        leads = fans.select(F.col("lead").alias("node"), "lead", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"), F.lit(0).alias("member"))
        asked = scratch.cut(asked.unionByName(leads))
        read = texts.join(asked, "node").select("lead", "fan", "member", "node", "text")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, at, head = Words(), None, None
            for p in _parts(batches):
                found = []
                for lead, fan, member, node, text in zip(*(p.column(c).to_pylist() for c in ("lead", "fan", "member", "node", "text"))):
                    x = Compared(hashes(words_of(text), known))
                    if not member:
                        at, head = (lead, fan), x
                    elif at == (lead, fan) and alike(head, x, similarity):
                        found.append((lead, node))
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        links = scratch.cut(read.repartition("lead", "fan").sortWithinPartitions("lead", "fan", "member", "node").mapInArrow(compare, "a long, b long"))
        scratch.drop(pairs, fans, asked)
        return links

    def repeats(w: str, n: str):
        """Whether a text has fewer distinct shingles than shingles."""
        return F.col(n) < F.greatest(F.col(w) - (SHINGLE - 1), F.lit(1))

    def fits(w: str, wl: str, n: str, nl: str):
        """Whether the counts of words or, where one repeats shingles, of distinct shingles leave room for the similarity."""
        one = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)
        return one(w, wl) | one(n, nl) & (repeats(w, n) | repeats(wl, nl))

    def dealt(m: DataFrame, facts: DataFrame, how: str) -> DataFrame:
        """Members joined with one row per bucket (key, size): rows of a bucket go to parts, each with a copy of its row."""
        n = F.ceil(F.col("size") / PART_ROWS).cast("int")
        f = facts.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("part")).drop("size")
        return m.withColumn("part", F.pmod(F.xxhash64("node"), n).cast("int")).join(f, ["key", "part"], how).drop("part")

    def by_leader(m: DataFrame, rank) -> DataFrame:
        """Each node of a bucket with the bucket's leader, if not of one component."""
        m = m.select("key", "size", "node", "w", "n", "label", rank.alias("h"))
        lead = m.groupBy("key").agg(F.max("size").alias("size"), F.min(F.struct(
            "h", F.col("node").alias("lead"), F.col("w").alias("wl"), F.col("n").alias("nl"), F.col("label").alias("ll"))).alias("x"))
        lead = lead.select("key", "size", "x.lead", "x.wl", "x.nl", "x.ll")
        return dealt(m, lead, "inner").filter((F.col("label") != F.col("ll")) & fits("w", "wl", "n", "nl")).select("lead", "node")

    links = _Links(scratch)

    def still_open(m: DataFrame, *more: str) -> DataFrame:
        """Members of buckets that hold several components, with their labels."""
        named = links.named(m)
        several = named.groupBy("key").agg(F.max("size").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
        return scratch.cut(dealt(named, several.select("key", "size"), "left_semi").select("key", "size", "node", "w", "n", "label", *more))

    links.add(verify(by_leader(links.named(members), F.xxhash64(F.lit(seed), "node"))))
    few = still_open(members.filter(F.col("size") <= small))
    # linked texts are of one size class or of neighbouring ones, by words or by distinct shingles
    part = still_open(members.filter(F.col("size") > small))
    step = math.log(1 / similarity) + 1e-6
    rows_of, facts = [], []
    for c in ("w", "n"):
        at, key = F.floor(F.log(c) / step), F.xxhash64("key", F.lit(c), "at").alias("key")
        held = part.groupBy("key", at.alias("at")).agg(
            F.max("size").alias("size"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.max(F.lit(True) if c == "w" else repeats("w", "n")).alias("asks"))
        below = held.select("key", (F.col("at") + 1).alias("at"), F.col("lo").alias("lo_below"), F.col("hi").alias("hi_below"), F.col("asks").alias("asks_below"))
        # nothing is to be compared among texts of one component, those that meet in the range below, or by shingles where no text repeats any
        facts.append(held.join(below, ["key", "at"], "left").filter(
            (F.least("lo", "lo_below") < F.greatest("hi", "hi_below")) & (F.col("asks") | F.coalesce("asks_below", F.lit(False)))).select(key, "size"))
        rows_of += [part.withColumn("at", at + k).select(key, "size", F.lit(c).alias("by"), F.lit(k == 1).alias("second"), "node", "w", "n", "label") for k in (0, 1)]
    sub = scratch.cut(dealt(reduce(DataFrame.unionByName, rows_of), reduce(DataFrame.unionByName, facts), "inner").drop("size"))
    several = sub.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("key").agg(
        F.sum("k").alias("size"), F.max("k").alias("most"), F.max_by("label", F.struct("k", "label")).alias("main"))
    several = scratch.cut(several.select("key", "size", "main", (F.col("size") - F.col("most")).alias("others")))
    sub = scratch.cut(join_by_key(sub, several, "key", "size").select("key", "size", "main", "others", "by", "second", "node", "w", "n", "label"))
    scratch.drop(part)

    def with_leads(m: DataFrame, leads: DataFrame) -> DataFrame:
        leads = leads.select("key", "size", F.col("node").alias("lead"), F.col("w").alias("wl"), F.col("n").alias("nl"), F.col("label").alias("ll"))
        return dealt(m, leads, "inner").filter((F.col("lead") != F.col("node")) & (F.col("label") != F.col("ll")) & fits("w", "wl", "n", "nl"))

    few = few.unionByName(sub.filter(F.col("size") <= small).select(*few.columns))
    pairs = with_leads(few, few).filter("lead < node").select("lead", "node")
    # one component and a few others: each of those is compared with all
    one = sub.filter((F.col("size") > small) & (F.col("others") <= small))
    pairs = pairs.unionByName(with_leads(one, one.filter("label != main")).select("lead", "node"))
    links.add(verify(pairs))
    # a part that one block holds is read once, for all its pairs; leaders would read it as often as there are rounds
    large = sub.filter((F.col("size") > small) & (F.col("others") > small)).drop("label", "main", "others")
    for r in range(1, rounds):
        part = still_open(large.filter(F.col("size") > BLOCK))
        if found := part.limit(1).count():
            links.add(verify(by_leader(part, F.xxhash64(F.lit(seed + r), "node", "key"))))
        scratch.drop(part)
        if not found:
            break
    part = still_open(large, "by", "second")
    if part.limit(1).count():
        links.add(scratch.cut(_linked_in_blocks(part, texts, similarity)))
    scratch.drop(members, shared, several, sub, part)
    texts.unpersist()

    named = scratch.cut(links.named(nodes.select("digest", "node", "best", "copies")))
    of = scratch.cut(named.groupBy("label").agg(F.min("best").alias("class_best"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("texts")))
    classes = scratch.cut(join_by_key(named, of, "label", "texts").select(
        "digest", "copies", F.col("class_best.id").alias("class_id"), "class_size", F.col("class_best").alias("best")))
    scratch.drop(named, of, nodes)
    return rows.select("id", "row", "mark", "digest"), classes


class Block:
    """Texts of an open part, with counts that bound what any two of them share."""

    def __init__(self, rows: list[tuple], known: Words) -> None:
        self.node, self.label = [r[0] for r in rows], [r[1] for r in rows]
        self.x = [hashes(words_of(r[2]), known).astype(np.uint32) for r in rows]
        self.second = np.array([r[3] for r in rows], bool)  # those of the range's lower half, which meet each other in the range below
        self.w = np.array([len(x) for x in self.x], np.int64)
        kind = np.uint16 if self.w.max(initial=0) < 2**16 else np.uint32
        self.n, self.repeats = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        self.words, self.shingles = ([np.zeros((len(rows), k), kind) for k in BINS] for _ in range(2))
        for i, x in enumerate(self.x):
            s = shingled(x.astype(np.uint64))
            u = np.unique(s)
            self.n[i], self.repeats[i] = len(u), len(u) < len(s)
            for k, words, own in zip(BINS, self.words, self.shingles):
                words[i] = np.bincount(x % np.uint32(k), minlength=k)
                own[i] = np.bincount((u % np.uint64(k)).astype(np.int64), minlength=k)
        self.held: dict[int, Compared] = {}

    def compared(self, i: int) -> Compared:
        if len(self.held) > 1_000:
            self.held.clear()
        if i not in self.held:
            self.held[i] = Compared(self.x[i].astype(np.uint64))
        return self.held[i]


def _may_be_alike(a: Block, i: int, b: Block, j: np.ndarray, similarity: float, by: str) -> np.ndarray:
    """Those of the texts ``j`` of b that the counts let be linked with text i of a: by
    words in a part of like counts of words ("w"), by shingles in one of shingles ("n")."""
    if by == "w":
        need = similarity * np.maximum(a.w[i], b.w[j]) - 1e-6
        ok = np.minimum(a.w[i], b.w[j]) >= need
    else:  # common ones number similarity / (1 + similarity) of both counts or more
        need = similarity / (1 + similarity) * (a.n[i] + b.n[j]) - 1e-6
        ok = (b.repeats[j] | a.repeats[i]) & (np.minimum(a.n[i], b.n[j]) >= need)
    for x, y in zip(*((c.words if by == "w" else c.shingles) for c in (a, b))):
        j, need = j[ok], need[ok]
        ok = np.minimum(y[j], x[i]).sum(axis=1, dtype=np.int64) >= need
    return j[ok]


class Joined(dict):
    """Components that the links found so far join: union-find over labels."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = x = self.get(up, up)
        return x


def _links_of(a: Block, b: Block, similarity: float, joined: Joined, by: str) -> Iterator[tuple[int, int]]:
    """Links across components between all texts of two blocks, or within one given twice, as
    far as they join components: every pair is ruled out by its counts, joined already or aligned."""
    for i in range(len(a.node)):
        j = np.arange(i + 1 if a is b else 0, len(b.node))
        for j in _may_be_alike(a, i, b, j[~b.second[j]] if a.second[i] else j, similarity, by).tolist():
            one, other = joined.find(a.label[i]), joined.find(b.label[j])
            if one != other and alike(a.compared(i), b.compared(j), similarity):
                joined[max(one, other)] = min(one, other)
                yield a.node[i], b.node[j]


def _linked_in_blocks(part: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join components among the nodes of each open part: all its pairs, whatever
    its size. A part is cut into blocks of some ``BLOCK`` nodes, of which every two, and each with
    itself, meet in a task; the pairs are formed there and never listed."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = part.select("key", "by", "second", "node", "label", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), blocks.alias("blocks"))
    own = own.select("key", "by", "second", "node", "label", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = own.select("key", "by", "second", "node", "label", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    cols = ("key", "lo", "hi", "by", "block", "node", "label", "text", "second")
    read = texts.join(units, "node").select(*cols)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, joined, at, kind, rows = Words(), Joined(), None, None, {}

        def close() -> pa.RecordBatch:
            held = {k: Block(v, known) for k, v in rows.items()}
            found = list(_links_of(held[at[1]], held[at[2]], similarity, joined, kind)) if at and at[1] in held and at[2] in held else []
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for p in _parts(batches):
            for key, lo, hi, by, block, *row in zip(*(p.column(c).to_pylist() for c in cols)):
                if (key, lo, hi) != at:
                    yield close()
                    at, kind, rows = (key, lo, hi), by, {}
                rows.setdefault(block, []).append(tuple(row))
        yield close()

    return read.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "block", "node").mapInArrow(compare, "a long, b long")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all but one row of each class; columns stay as they are.

    The row with the least id stays (null ids last, then any one). Rows go by
    id and text together, so of rows that repeat an id only those go whose
    text has a near-duplicate that stays. Null and blank texts stay.
    """
    flat, at, back = positional(docs)
    scratch = Scratch(docs.sparkSession)
    rows, classes = _classes(docs, id_col, text_col)
    held = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("mark") == F.col("best.mark"))
    more = scratch.cut(_with_classes(rows, classes).filter(F.col("best").isNotNull() & (F.col("row") != F.col("best.row")))
                       .select("id", "mark", held.alias("held")))
    mark = F.unhex(F.md5(at[text_col]))

    def of(x: DataFrame):
        return F.col(at[id_col]).eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_own"))

    gone = more.filter(~F.col("held")).select(F.col("id").alias("_id"), F.col("mark").alias("_mark"))
    flat = flat.withColumn("_own", mark)
    out = flat.join(gone, of(gone), "left_anti")
    twice = more.filter("held").select(F.col("id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    if twice.limit(1).count():  # rows that have id and text of the one that stays: any one of them does
        once = flat.join(twice, of(twice), "left_semi").dropDuplicates([at[id_col], "_own"])
        out = out.join(twice, of(twice), "left_anti").unionByName(once)
    return out.select(*back)
