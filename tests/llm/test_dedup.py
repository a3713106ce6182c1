"""Exact, near-duplicate, line, window and byte deduplication."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from textmill.llm import exact_dedup, line_dedup, near_dedup, substring_dedup, suffix_dedup
from textmill.llm.common import Scratch
from textmill.llm.graph import components
from textmill.llm.run_index import RunIndex


def key(rows):
    return sorted(map(tuple, rows), key=str)


# ---- exact ------------------------------------------------------------------------------------------------------


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        out.append((i, best, len(ids), i == best, H.sha(t or "")))
    return out


@pytest.mark.parametrize("first_digit", [3, 64])
def test_exact(spark, first_digit):
    rng = random.Random(first_digit)
    rows = H.odd_rows() if first_digit == 64 else []
    rows += [(100 + k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))) for k in range(120)]
    rows += [(300, "z" * 90), (301, "z" * 90), (302, "z" * 89), (303, "z" * 90 + "\x00")]
    got = exact_dedup.exact_dedup(H.clashing(H.frame(spark, rows)), first_digit=first_digit).collect()
    assert key(got) == key(brute_exact(rows))


def test_exact_empty_and_smallest(spark):
    assert exact_dedup.exact_dedup(H.frame(spark, [])).collect() == []
    got = exact_dedup.exact_dedup(H.frame(spark, [(1, "a"), (2, "a")]), keep="smallest").where("kept").collect()
    assert [r.doc_id for r in got] == [1]
    with pytest.raises(ValueError):
        exact_dedup.exact_dedup(H.frame(spark, []), keep="any")


# ---- windows of words -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_windows(spark, seed):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for k in range(60)]
    got = substring_dedup.dedup_windows(H.frame(spark, rows), width=4).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert key(got.collect()) == key(H.brute_windows(rows, 4))


def test_windows_odd(spark):
    rows = sorted(H.odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    got = substring_dedup.dedup_windows(H.clashing(H.frame(spark, rows)), with_text=True)
    out = got.collect()
    assert key(r[:3] + (r.kept_sha256,) for r in out) == key(H.brute_windows(rows, 20))
    assert all(sum(s.end - s.begin for s in r.spans) == r.n_removed and H.sha(r.kept) == r.kept_sha256 for r in out)
    assert substring_dedup.dedup_windows(H.frame(spark, [])).collect() == []


# ---- strings of bytes -------------------------------------------------------------------------------------------


def naive_statistics(text, pattern, most):
    out = []
    for i in range(len(pattern)):
        n = 0
        while n < most and i + n < len(pattern) and pattern[i : i + n + 1] in text:
            n += 1
        out.append(n)
    return out


def test_run_index():
    rng = random.Random(1)
    for trial in range(150):
        letters = b"ab" if trial % 2 else b"abcd"
        parts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        text = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 1, 0) for p in parts])
        index = RunIndex(text, most=rng.choice([4, 16, 64]))
        pattern = bytes(rng.choice(b"abcde" if trial % 3 else b"ab") for _ in range(25))
        want = [max(x) for x in zip(*(naive_statistics(p, pattern, index.most) for p in parts), strict=True)]
        assert index.matching_statistics(np.frombuffer(pattern, np.uint8)).tolist() == want
    assert RunIndex(np.array([1, 2] * 50 + [0]), 8).n_runs <= 5


@pytest.mark.parametrize("seed", range(2))
def test_strings(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 7)
    monkeypatch.setattr(suffix_dedup, "STRETCH", 11)
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé") for _ in range(rng.randint(3, 30))) for _ in range(12)]
    rows = [(k, "".join(rng.choice(pool) + rng.choice(["", "x", "yz"]) for _ in range(rng.randint(0, 5)))) for k in range(40)]
    rows += [(k, rows[k % 40][1]) for k in range(40, 46)] + [(50, None), (None, pool[0] * 3), (None, pool[1] * 3), (51, pool[0] * 3), (3, pool[2] * 3)]
    rng.shuffle(rows)
    got = suffix_dedup.dedup_bytes(H.frame(spark, rows), width=10).collect()
    assert key(got) == key(H.brute_substrings(rows, 10))


def test_strings_odd(spark):
    rows = H.odd_rows()
    out = suffix_dedup.dedup_bytes(H.clashing(H.frame(spark, rows)), with_text=True).collect()
    assert key(r[:5] for r in out) == key(H.brute_substrings(rows, 50))
    for r in out:
        assert len(r.spans) == r.n_spans and sum(s.end - s.begin for s in r.spans) == r.n_removed
        assert (r.kept_text is None) == (r.n_removed == 0)
    assert suffix_dedup.dedup_bytes(H.frame(spark, [])).collect() == []


def test_whole_characters():
    body = np.frombuffer("aéb日c".encode(), np.uint8)
    lost = np.zeros(len(body), bool)
    lost[[2, 4]] = True
    assert suffix_dedup.whole_characters(body, lost) == "abc"


# ---- near duplicates --------------------------------------------------------------------------------------------


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(1000)}"
    return " ".join(w)


def near_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(6):
        base = " ".join(f"t{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 120])))
        rows += [edited(rng, base, rng.randrange(0, 9)) for _ in range(12)] + [base.upper(), base]
    rows += ["", "  ", "one two", "ONE  two", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block", [(0, 1000), (1, 3)])
def test_near(spark, seed, block):
    rows = near_rows(seed)
    got = near_dedup.near_duplicates(H.clashing(H.frame(spark, rows)), block=block).collect()
    want = H.brute_near(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_odd(spark):
    rows = H.odd_rows()
    got = near_dedup.near_duplicates(H.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[5][0].component_id == 4 and by[6][0].component_id == 4 and by[9][0].component_id == 8
    assert by[1][0].n_shingles == 0 and by[1][0].component_id == 1 and by[2][0].kept
    assert near_dedup.near_duplicates(H.frame(spark, [])).collect() == []


def test_chunk_keys_meet():
    """Two signatures with less than two errors a chunk on average share a key."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 16, (300, 40), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(40, 19, replace=False)] += 1
    x, y = near_dedup.chunk_keys(a), near_dedup.chunk_keys(b)
    assert all(set(p) & set(q) for p, q in zip(x.tolist(), y.tolist(), strict=True))
    assert not any(set(p) & set(q) for p, q in zip(x.tolist(), x[1:].tolist()))


def test_components(spark, tmp_path):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: parent[x] for a, b in edges for x in (a, b) if a != b}


# ---- lines ------------------------------------------------------------------------------------------------------


def test_patience():
    assert line_dedup.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert line_dedup.patience([9, 1, 2, 8, 3], [1, 2, 3]) == [(1, 0), (2, 1), (4, 2)]
    assert line_dedup.patience([], [1]) == [] and line_dedup.patience([1], [2]) == []
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(8) for _ in range(rng.randrange(12))] for _ in range(2))
        out = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in out)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(out, out[1:]))
    assert line_dedup.common_blocks([(0, 0), (1, 1), (3, 2), (4, 3), (5, 9)]) == [(0, 2), (3, 5), (5, 6)]


def test_lines(spark):
    a, b, c, d = (f"this is line number {x} of a text, long enough to count as one block of its own, and then some more of it" for x in "abcd")
    short = "short common"
    rows = [
        (1, f"{a}\n{b}\n{c}"), (2, f"own line of two\n{a}\n{b}\nanother own line of two"), (3, f"{c}\n{d}"), (4, f"{d}"),
        (5, f"{short}\nfive is alone with this"), (6, f"{short}\nsix is alone with that"), (7, f"{a}\n{b}\n{c}"),
    ]
    df = H.clashing(H.frame(spark, rows))
    out = line_dedup.line_dedup(df, counts=False)
    assert out.columns == df.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text == {1: rows[0][1], 2: "own line of two\nanother own line of two", 3: d, 4: "", 5: rows[4][1], 6: rows[5][1], 7: ""}
    counts = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.line_dedup(H.frame(spark, rows), counts=True).collect()}
    assert counts[2] == (4, 2) and counts[1] == (3, 0) and counts[7] == (3, 3)
    # Lines that many documents have still link a document that has no rarer ones.
    many = [(k, f"{a}\n{b}") for k in range(40)]
    assert line_dedup.line_dedup(H.frame(spark, many)).where("text = ''").count() == 39


def test_lines_hot_passage_beside_a_rare_line(spark):
    hot, own = "\n".join(f"line {x} of a passage that very many of the documents have" for x in range(4)), "a line that only two documents have"
    rows = [(0, own), *((k, f"text of document {k}\n{hot}") for k in range(1, 90)), (90, f"{own}\n{hot}\nend")]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows)).collect()}
    assert text[90] == f"{own}\nend" and text[89] == "text of document 89" and text[1] == rows[1][1]


def brute_lines(rows, min_chars=100):
    """What is left of each text when every block shared with any earlier document is deleted."""
    split = [t.split("\n") for _, t in rows]
    out = []
    for d, a in enumerate(split):
        gone = set()
        for b in split[:d]:
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if sum(map(len, a[i : i + n])) >= min_chars:
                        gone.update(range(i, i + n))
        out.append("\n".join(x for i, x in enumerate(a) if i not in gone))
    return {k: t for (k, _), t in zip(rows, out)}


def test_lines_block_of_later_documents(spark):
    x, y, z = (f"{c} is a line of about sixty characters, no more and no less" for c in "xyz")
    own = [f"own line {k} of some document" for k in range(9)]
    rows = [(1, f"{x}\n{own[0]}\n{y}\n{own[1]}\n{z}"), (2, f"{own[2]}\n{y}"), (3, z), (8, f"{own[3]}\n{x}\n{y}\n{z}"), (9, f"{x}\n{y}\n{z}\n{own[4]}")]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows)).collect()}
    assert text == brute_lines(rows) and text[9] == own[4]


def test_shortest_runs():
    rng = random.Random(5)
    for _ in range(300):
        sizes = np.array([rng.choice((0, 1, 30, 60, 120)) for _ in range(rng.randrange(1, 12))])
        n = len(sizes)
        runs = list(zip(*line_dedup.shortest_runs(sizes, np.full(n, n), np.zeros(n, dtype=int), 100)))
        for p in range(n):
            for q in range(p + 1, n + 1):
                if sizes[p:q].sum() >= 100:
                    assert {i for b, e in runs if p <= b and e <= q for i in range(b, e)} == set(range(p, q))


def test_run_hashes():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**63), 2**63 - 1, 40)
    y = np.concatenate((rng.integers(-(2**63), 2**63 - 1, 7), x))
    a, b = line_dedup.Runs(x), line_dedup.Runs(y)
    begin, end = np.triu_indices(41, 1)
    assert (a.hash(begin, end) == b.hash(begin + 7, end + 7)).all() and len(set(a.hash(begin, end))) == len(begin)
    assert (a.hash(np.arange(40), np.arange(1, 41)) == x).all()


def test_lines_passage_twice_in_a_document(spark):
    p = "\n".join(f"line {x} of a passage that stands twice in one of the documents" for x in range(4))
    rows = [(1, f"begin of one\n{p}\nend of one"), (2, f"begin of two\n{p}\nmiddle of two\n{p}\nend of two")]
    rows += [(3, f"begin of three\n{p}\n{p}\nmiddle of three\n{p}\nend of three")]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows)).collect()}
    assert text == {1: rows[0][1], 2: "begin of two\nmiddle of two\nend of two", 3: "begin of three\nmiddle of three\nend of three"}


def test_lines_brute_force(spark):
    """All pairs, on documents of few different lines, short ones among them."""
    rng = random.Random(11)
    pool = ["", "a", "eleven char", "x" * 30, "y" * 45, "z" * 60, "v" * 99, "w" * 110]
    rows = [(k, "\n".join(rng.choice(pool[: rng.choice((4, 8))]) for _ in range(rng.randrange(1, 25)))) for k in range(120)]
    text = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows)).collect()}
    assert text == brute_lines(rows)


def test_lines_short_ones_only(spark):
    text = "\n".join(f"{k * 7919:011d}" for k in range(500))
    rows = [(1, text), (2, text), (3, "own\n" + text[1200:2399] + "\nown too"), (4, "日本\n" * 60), (5, "日本\n" * 60)]
    left = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows)).collect()}
    assert left == {1: text, 2: "", 3: "own\nown too", 4: rows[3][1], 5: ""}


def test_lines_odd(spark):
    rows = H.odd_rows()
    out = line_dedup.line_dedup(H.clashing(H.frame(spark, rows))).collect()
    assert len(out) == len(rows)
    text = {}
    for r in out:
        text.setdefault(r.doc_id, []).append(r.text)
    assert text[1] == [None] and text[2] == [""] and text[9] == [""] and len(text[8][0]) > 1000
    assert text[4] == [rows[5][1]] * 2 and text[5] == [""]
    assert line_dedup.line_dedup(H.frame(spark, [])).collect() == []


def test_null_safe_counts(spark):
    df = H.frame(spark, H.odd_rows())
    assert df.where(F.col("text").isNull()).count() == 2


def template_rows(n, common=9, own=4):
    """Pages of one template that have words of their own, and some near copies of a page among them."""
    head = " ".join(f"t{i}" for i in range(common))
    rows = [(i, head + " " + " ".join(f"p{i}w{k}" for k in range(own))) for i in range(n)]
    long = lambda i: head + " " + " ".join(f"q{i}w{k}" for k in range(60))
    for i in range(0, n // 20):
        rows += [(10_000 + 2 * i, long(i)), (10_001 + 2 * i, long(i) + " end")]
    return rows


def test_near_pages_of_one_template(spark):
    rows = template_rows(260)
    want = H.brute_near(rows)
    assert sum(i != c for i, (_, c) in want.items()) == 13
    for block in (500, 20):
        got = near_dedup.near_duplicates(H.frame(spark, rows), block=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_unlike_pages_of_one_template_do_not_meet(spark):
    from textmill.llm.common import Scratch

    for n in (300, 1200):
        rows = H.frame(spark, template_rows(n)).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("body"))
        told = near_dedup.sketch(rows, 5, 10).select(F.col("id").alias("cls"), F.col("id").alias("comp"), "n", "h", "sig")
        classes = told.withColumn("id", F.col("cls"))
        links = classes.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
        scratch = Scratch(spark, "template")
        sets = near_dedup.class_sets(rows, classes, links, 5, scratch)
        crowd = sets.join(told.select("cls", "comp"), "cls").select("cls", "comp", "n", "elements")
        found = {r.cls for r in near_dedup.may_be_similar(crowd, 75, scratch).collect()}
        assert found == {10_000 + i for i in range(n // 10)}


def test_prefix_lengths():
    for percent in (50, 75, 90):
        for n in range(1, 60):
            short, long_ = near_dedup.prefix_lengths(np.int64(n), percent)
            for m in range(n, 100 * n // percent + 1):  # the least intersection of similar sets
                both = -(-percent * (n + m) // (100 + percent))
                assert n - both + 1 <= short and m - both + 1 <= near_dedup.prefix_lengths(np.int64(m), percent)[1]


def test_lines_of_a_hub_document(spark):
    """A list of lines that other documents have one each of isn't aligned with these."""
    from textmill.llm.common import Scratch

    own = [f"entry number {i:05d} of the list, found on a page of its own" for i in range(300)]
    rows = [(i, f"page {i}\n{x}\nends here {i}") for i, x in enumerate(own)] + [(1000, "\n".join(own)), (1001, "\n".join(own[::-1] + own[:2]))]
    rows += [(1002, own[5] + "\n" + own[6])]
    blanks = [(1003, own[7] + " " * 60), (1004, own[7] + " " * 60 + "\n" + own[250])]
    docs = H.frame(spark, rows).select(F.col("doc_id").alias("k"), F.xxhash64("text").alias("h"), F.col("text").alias("_text"))
    pairs = line_dedup.overlaps(docs, Scratch(spark, "hub"), 12, 100)
    assert pairs.count() <= 6
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(H.frame(spark, rows + blanks)).collect()}
    assert got == {**brute_lines(rows), 1003: "", 1004: own[250]}  # only blanks make these lines long enough


def test_windows_of_rows_without_ids(spark):
    """Rows without an id lie in several blocks, in the order of their texts."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(60)) for _ in range(40)]
    rows = sorted([(None, rng.choice(texts)) for _ in range(200)] + [(5, t) for t in texts], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    from textmill.llm import blocks
    from textmill.llm.common import Scratch

    made, total = blocks.ordered_blocks(H.frame(spark, rows), Scratch(spark, "ids"), "doc_id", "text", block_bytes=2000, split_ids=True)
    assert made.count() > total // 4000
    order = [i for r in made.orderBy("block").collect() for i in zip(*(lambda b: ([b.id_of(k) for k in range(len(b.ids))], list(b.texts())))(blocks.Block(r)))]
    assert order == [(i, t.encode()) for i, t in rows]
    got = substring_dedup.dedup_windows(H.frame(spark, rows), width=4).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert key(got.collect()) == key(H.brute_windows(rows, 4))


def test_further_bits_tell_equal_hashes_apart(spark):
    """Two windows whose 64-bit hashes agree aren't equal if the further bits differ, whatever lies between."""
    from textmill.llm import blocks
    from textmill.llm.common import Scratch

    scratch = Scratch(spark, "further")
    rows = [(i, str(i)) for i in range(4)]
    made, _ = blocks.ordered_blocks(H.frame(spark, rows), scratch, "doc_id", "text", block_bytes=1)

    def hashes(row):
        i = int(bytes(row.body))
        return np.array([7, 9], np.uint64), np.array([i % 2, 5], np.uint32)

    told = blocks.with_answers(made, blocks.seen_earlier(made, hashes, 6, scratch, more=True))
    got = {int(bytes(r.body)): blocks.read_answers([x.asDict() for x in r.told]).tolist() for r in told.collect()}
    assert got == {0: [False, False], 1: [False, True], 2: [True, True], 3: [True, True]}
