"""Small tables that hold the odd cases."""

import random
import string

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def clash(df):
    """The table with more columns, whose names differ in case only or look internal."""
    from pyspark.sql import functions as F

    extra = [F.lit("?").alias(c) for c in ("TEXT", "Doc_ID", "id", "node", "label", "size", "row", "kept", "URL", "h", "n")]
    return df.select("*", *[e for e in extra])


def sentence(r, n, words=None):
    words = words or ["".join(r.choice(string.ascii_lowercase) for _ in range(r.randint(2, 8))) for _ in range(4 * n)]
    return " ".join(r.choice(words) for _ in range(n))


def odd_documents(spark, more=()):
    r = random.Random(7)
    long = sentence(r, 30_000)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "x", "en", None), (4, "x", "en", None), (5, "x", "de", "b"),
            (6, long, "en", "a"), (7, "no letters: 12 34!"[11:], "en", "b"), (None, "a row without an id of its own", "en", "b"), (8, "é ß 漢字 🙂", "fr", "")]
    rows += [(100 + i, sentence(r, 40), "en", "ab"[i % 2]) for i in range(12)] + list(more)
    return spark.createDataFrame([(i, t, lg, s, None if t is None else len(t)) for i, t, lg, s in rows], DOCS)
