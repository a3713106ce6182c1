"""Frames of odd rows, and brute-force versions of the operators."""

import hashlib
import re

from pyspark.sql import functions as F

BLANK = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def clashing(df):
    """df with columns whose names the operators use inside."""
    names = "id row k h n label digit sha keep_id kept bin shard piece block body told cls sig comp score source salt n_words lines words first last count key value".split()
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, one id with two texts, a very long text and a word of 3,000 characters."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    line = "the quick brown fox jumps over the lazy dog and runs away from all of the other animals in the wood tonight again"
    return [
        (None, "a b c"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, line), (4, line), (5, line), (6, line + " x"), (7, "one"),
        (7, "two"), (8, long), (9, long), (10, "é" * 60 + line), (11, "x" * 3000), (12, "\n".join([line, "other line here", line])), (13, "日本 語 😀 " * 20),
    ]


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def brute_substrings(rows, width):
    """Per row: (n_bytes, n_removed, n_spans, sha of what is left) of a document order by id."""
    first = {}
    key = lambda i: (i is not None, i or 0)
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - width + 1):
            if first[b[s : s + width]] < key(i):
                gone[s : s + width] = [True] * width
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def brute_windows(rows, width):
    """rows are in their order (id, text)."""
    seen, out = set(), []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            x = tuple(w[s : s + width])
            if x in seen:
                gone[s : s + width] = [True] * width
            seen.add(x)
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def shingle_set(text, n=5):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute_near(rows, percent=75):
    """id -> (size of its set, component)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return {i: (len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)}
