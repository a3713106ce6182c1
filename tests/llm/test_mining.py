"""Hard negatives, language identification and phrases against brute force and held-out rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from textmill.llm import hard_negatives, langid, phrases
from textmill.llm.common import Scratch

# ---- hard negatives ---------------------------------------------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<float>"


def brute_negatives(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    live = []
    for i, label, x in rows:
        if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            live.append((i, label, tuple(math.floor(256 * np.float32(v).item()) for v in x)))
    anchors = {}
    for i, label, q in sorted(live):
        if is_anchor(i):
            anchors.setdefault(i, (label, q))
    out = set()
    for a, (label, q) in anchors.items():
        score = lambda r: sum(x * y for x, y in zip(q, r[2]))  # noqa: B023, E731
        same = sorted({(-score(r), r[0]) for r in live if r[1] == label and r[0] != a})[:positives]
        other = sorted({(-score(r), r[0]) for r in live if r[1] != label})
        for s, p in same:
            inside = [(n, i) for n, i in other if low * -s <= 100 * -n <= high * -s][:negatives]
            out |= {(a, p, k, i, -s, -n) for k, (n, i) in enumerate(inside, 1)}
    return out


def mined(spark, rows, is_anchor, **options):
    df = H.clashing(spark.createDataFrame(rows, VECTORS).withColumnRenamed("label", "kind"))
    out = hard_negatives.hard_negatives(df, is_anchor, label_col="kind", **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(r) for r in out.collect()]


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 12)) / 4
    rows = []
    for i in range(400):
        label = int(rng.integers(4))
        rows.append((i, label, [float(v) for v in 0.6 * centre[label] + 0.5 * centre[0] + rng.normal(size=12) / 12]))
    hot = rows[5][2]
    rows += [(1000 + i, i % 2, hot) for i in range(60)]  # ties
    rows += [rows[7], rows[7], (8, 2, rows[9][2]), (40, 3, rows[40][2])]  # repeated rows, and ids with other vectors
    rows += [(None, 1, hot), (20, None, hot), (2001, 1, None), (2002, 1, [math.nan] * 12), (2003, 1, [math.inf] * 12), (2004, 2, [None, 1.0])]
    rows += [(2005, 1, []), (2006, 1, [1.0]), (2010, 2, [9.0, -40.0] * 6), (2020, 2, [-1e-9] * 12)]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 200
    got = mined(spark, rows, F.col("vec_id") % 10 == 0)
    assert len(got) == len(set(got)) and set(got) == want
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    assert set(mined(spark, rows, F.col("vec_id") % 10 == 0)) == want


def test_hard_negatives_of_few_rows(spark):
    yes = F.col("vec_id") % 2 == 0
    assert mined(spark, [], yes) == [] and mined(spark, [(1, 1, [0.5])], yes) == []
    assert mined(spark, [(2, 1, [1.0]), (3, 1, [0.5]), (4, 0, [0.5]), (5, 0, [0.3])], yes) == [(2, 3, 1, 4, 32768, 32768)]
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(2, 1, [1e30]), (3, 1, [1e30]), (4, 0, [1.0])], yes)


def test_intervals_hold_every_product():
    rng = np.random.default_rng(1)
    anchors, rows = rng.integers(-300, 300, (5, 9)), rng.integers(-500, 40, (50, 9))
    p, exact = hard_negatives.Products(anchors, rows), anchors @ rows.T
    partial, width = np.repeat(p.start[:, None], 50, axis=1), np.inf
    for k in range(p.bits - 1, -1, -1):
        partial = partial + (1 << k) * (p.anchors @ p.plane(k).T)
        under, over = (partial + p.open_after(k) * x[:, None] for x in (p.less, p.more))
        assert (under <= exact).all() and (exact <= over).all() and (over - under).max() < width
        width = (over - under).max()
    assert (partial == exact).all()


# ---- language ---------------------------------------------------------------------------------------------------


def test_codewords():
    for n in range(2, 30):
        code = langid.codewords(n).astype(int)
        assert len(code) == n and (np.abs(code.sum(0)) < n).all()
        columns = {tuple(c * c[0]) for c in code.T}
        assert len(columns) == code.shape[1]  # no split twice
        if n > 2:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_a_wrong_bit_is_outvoted():
    code = langid.codewords(4)
    model = langid.Model(list("abcd"), code, np.zeros((1, 7)), np.zeros(7))
    for k in range(4):
        for wrong in range(7):
            bits = 3.0 * code[k]
            bits[wrong] *= -1
            best, score, unsure = model.decode(bits[None])
            assert best[0] == k and score[0] > 0.9 and not unsure[0]
    assert model.decode(np.zeros((1, 7)))[2][0]


def test_spans_count_as_whole_texts(monkeypatch):
    text = "Ärger, İstanbul -- and 12 cats\n\n" * 40 + "x"
    whole = Counter(np.concatenate([s for parts, _ in langid._batches([text]) for s in langid.gram_slots(parts)]).tolist())
    whole.pop(1 << langid.BITS)
    for span in (1, 3, 17, 100):
        monkeypatch.setattr(langid, "SPAN", span)
        cut = Counter(np.concatenate([s for parts, _ in langid._batches([text]) for s in langid.gram_slots(parts)]).tolist())
        cut.pop(1 << langid.BITS, None)
        assert cut == whole


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(*langid.learning_rows(docs, per_lang=60))
    found = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 150 and right > 0.98


def test_languages_of_odd_rows(spark):
    texts = ["the cat and the dog were in the house", "der hund und die katze sind im haus", "le chat et le chien dans la maison"]
    model = langid.fit(texts * 3, ["en", "de", "fr"] * 3)
    rows = [*H.odd_rows(), (50, "12 34 !? 😀"), (51, "Und die Katze ist der Hund"), (52, "et la maison"), (53, None)]
    got = langid.identify(H.clashing(H.frame(spark, rows)), model).collect()
    assert sorted(map(str, [r["doc_id"] for r in got])) == sorted(str(i) for i, _ in rows)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 50, 53)} == {"und"}
    assert {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] in (51, 52)} == {51: "de", 52: "fr"}
    assert all(0 <= r["score"] <= 1 for r in got) and langid.identify(H.frame(spark, []), model).count() == 0
    empty = langid.fit([], [])
    assert empty.predict(["some text"]) == [("und", 0.0, True)] and langid.fit(["a"], ["en"]).predict(["b"])[0][0] == "en"


def test_learning_rows_are_bounded(spark):
    rows = [(i, f"text {i}", ["en", "de", None][i % 3]) for i in range(90)] + [(1, "x" * 50, "de")] * 40 + [(None, "n", "en"), (4, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, langs = langid.learning_rows(docs, per_lang=8, max_bytes=100)
    assert 0 < len(texts) <= 16 and sum(map(len, texts)) <= 100 and set(langs) <= {"en", "de"} and len(set(texts)) == len(texts)


# ---- phrases ----------------------------------------------------------------------------------------------------


def brute_phrases(rows, least, max_words, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, max_words + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= least}
    kept = []
    for (lang, w), a in cand.items():
        longer = [
            b for (other, v), b in cand.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
        ]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        kept.append((lang, a, f[lang, w[:k]], f[lang, w[k:]], score, " ".join(w)))
    out = set()
    for lang in {x[0] for x in kept}:
        own = sorted((x for x in kept if x[0] == lang), key=lambda x: (-x[4], -x[1], x[5].encode()))
        out |= {(lang, i, x[5], *x[1:4], n[lang], x[4]) for i, x in enumerate(own[:top], 1)}
    return out


def phrase_rows(seed=0):
    rng = np.random.default_rng(seed)
    vocab = ["the", "THE", "cat", "sat", "on", "été", "日本", "mat.", "a,b", "x\x00y", "ends\x0b", "-"]
    rows = []
    for i in range(150):
        weights = rng.dirichlet(np.full(len(vocab), 0.4))
        rows.append(([None, "en", "de"][i % 3], " \t".join(rng.choice(vocab, 40, p=weights))))
    passage = "we saw the cat that sat on the mat; then it left us alone."
    rows += [("en", passage)] * 40 + [("de", passage + passage)] * 9
    return rows + [("en", None), ("en", ""), ("", "the cat"), (None, " \t"), ("en", "w" * 5000), ("fr", "one two three " * 60)]


@pytest.mark.parametrize("options", [{}, {"most": 12, "block_bytes": 700}, {"max_words": 3, "most": 5}, {"max_words": 2, "top": 7}, {"max_words": 5}])
def test_phrases(spark, options):
    rows = phrase_rows()
    docs = H.clashing(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    got = phrases.collocations(docs, least=15, **options)
    want = brute_phrases(rows, 15, options.get("max_words", 4), options.get("top", 2000))
    out = [tuple(r) for r in got.collect()]
    assert len(want) > 10 and len(out) == len(set(out)) and set(out) == want
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_of_nothing(spark):
    for rows in ([], [("en", "too few words")], [(None, None)]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_phrases_of_blocks_without_longer_ones(spark):
    """Pairs that nothing follows, words without pairs, and blocks of both."""
    for rows in ([("en", "a b. a b.")] * 9, [("en", "a. b. c. d")] * 9, [("en", "a b. c")] * 9 + [("de", "x y z")] * 9 + [("fr", "q")] * 9):
        got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), least=9)
        assert {tuple(r) for r in got.collect()} == brute_phrases(rows, 9, 4, 2000)


def test_words_are_the_same_in_spans(monkeypatch):
    text = "The cat, sat on" + "z" * 90 + " a mat.\tIt is\n. so! " * 7
    def tokens():
        words = phrases.Words()
        flat = np.concatenate(list(phrases.numbered(text.encode(), words)))
        return [list(words)[i] for i in flat]
    whole = tokens()
    for span in (1, 2, 7, 50):
        monkeypatch.setattr(phrases, "SPAN", span)
        assert tokens() == whole


def test_scores_are_exact_beyond_64_bits(spark):
    big = 7_000_000_000_001
    rows = [([1], big * 3), ([2], big * 2 + 5), ([3], 40), ([1, 2], big), ([2, 3], 33)]
    got = {tuple(r["ids"]): r for r in phrases.scored(spark.createDataFrame(rows, "ids array<long>, f long")).collect()}
    assert got[1, 2]["score"] == 2_000_000 * big // (big * 5 + 5) and got[2, 3]["score"] == 2_000_000 * 33 // (big * 2 + 45)


def test_ids_are_dense(spark):
    rows = [("en", " ".join(f"w{i} w{i}" for i in range(500))), ("de", " ".join(f"w{i} w{i}" for i in range(300)))]
    scratch = Scratch(spark, "dense")
    blocks = scratch.write(phrases.token_blocks(spark.createDataFrame(rows, "lang string, text string"), "lang", "text", 1 << 20))
    words = phrases.frequent_words(blocks, 2, scratch)
    assert sorted(r["id"] for r in words.collect()) == list(range(1, 801))
