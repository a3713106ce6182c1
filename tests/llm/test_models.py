"""Tokenizing, classifying, rules, packing and chats."""

import itertools
import json
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import helpers as H
from textmill.llm import bpe, chat, crf, packing, quality_rules

DIR = "/root/testdata/sf0.01"
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


# ---- bpe --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return bpe.ByteBpe(PATH), Tokenizer.from_file(PATH)


ODD = st.lists(
    st.one_of(st.sampled_from(["  ", " ", "\n", "\t", " ", "\u0085", "\x1c", "é", "日", "😀", "'s", "'ll", "12", "½", "<|endoftext|>", "aaaa", "​", "\r\n", "\x00"]), st.text(max_size=6)),
    max_size=12,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_encoding(both, text):
    own, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text).tolist() == ids
    assert own.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_encoding_of_letters_unknown_to_the_library(both):
    own, library = both
    for c in ("\U0003d000", "\u0558", "\U000323b0", "\u1c89", "\U00010d40", "\U00011de5", "\U0003fc3f"):
        for text in (c + "'s", c + "1", "a" + c, c + "a", " " + c + "!"):
            assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoding_in_slices(both, monkeypatch):
    own, library = both
    monkeypatch.setattr(bpe, "SLICE_CHARS", 5)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["ab", " ", "  ", "\n", "'s", "12", "é", "!!", "日本", "。", "e\u0301", "<|endoftext|>", "<|endof"]) for _ in range(30))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert "".join(own.slices(text)) == text


def test_slices_of_long_texts_without_blanks(both):
    """A text of over 1 MB in sentences without any blank is cut at their marks, a run of letters is not."""
    own, library = both
    text = "".join(f"日本語の文{i}、続く。" for i in range(150_000))
    assert len(text) > 1_500_000 and max(map(len, own.slices(text))) < bpe.SLICE_CHARS + 20
    part = text[:200_000]
    assert own.encode(part).tolist() == library.encode(part, add_special_tokens=False).ids
    assert len(list(own.slices("z" * (bpe.SLICE_CHARS + 5)))) == 1


def test_memory_is_bounded(both):
    own, library = bpe.ByteBpe(PATH, memory_words=10), both[1]
    text = " ".join(f"word{i}" for i in range(200))
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, both):
    rows = H.odd_rows()
    got = bpe.round_trip(H.clashing(H.frame(spark, rows)), PATH).collect()
    want = []
    for i, t in rows:
        ids = both[1].encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), H.sha(",".join(map(str, ids))), H.sha(both[1].decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip(H.frame(spark, []), PATH).collect() == []
    texts = bpe.decode_ids(bpe.encode_documents(H.frame(spark, rows), PATH), PATH)
    assert sorted((r.doc_id, r.text) for r in texts.where("doc_id is not null").collect()) == sorted((i, t or "") for i, t in rows if i is not None)


# ---- line model -------------------------------------------------------------------------------------------------


def test_chain_against_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 5])
    begins = np.cumsum(counts) - counts
    lines = crf.Lines(begins, counts, np.ones(9), np.zeros((9, crf.N_FEATURES)))
    emission, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    good, edges, logz = crf.chain(lines, emission, moves)
    for d, (b, n) in enumerate(zip(begins, counts, strict=True)):
        weights = {}
        for states in itertools.product((0, 1), repeat=int(n)):
            s = sum(emission[b + t] for t in range(n) if states[t]) + sum(moves[x, y] for x, y in zip(states, states[1:]))
            weights[states] = np.exp(s)
        z = sum(weights.values())
        want = [sum(w for s, w in weights.items() if s[t]) / z for t in range(n)]
        assert np.allclose(good[b : b + n], want) and np.isclose(logz[d], np.log(z))
        pairs = np.zeros((2, 2))
        for s, w in weights.items():
            for x, y in zip(s, s[1:]):
                pairs[x, y] += w / z
        assert np.allclose(edges[d], pairs)


def test_features_do_not_depend_on_neighbours_in_the_batch(monkeypatch):
    texts = ["a b c\nA B C!! A\n\nx | y | z", "", "one line", "w " * 50 + "\n" + "### $$$\n" * 5]
    together = crf.read_lines(texts)
    for k, t in enumerate(texts):
        alone = crf.read_lines([t])
        b, n = together.begins[k], together.count[k]
        assert n == t.count("\n") + 1 and np.allclose(together.features[b : b + n], alone.features)


def test_scores_do_not_depend_on_the_batch(spark):
    """Windows of three words end with their text; a text scores alone as it does beside others."""
    model = crf.fit(["good text here\nand more of it"] * 20 + ["### $$$ ###\n%%% &&& ***"] * 20, np.array([1] * 20 + [0] * 20))
    texts = ["x y z a x y", "z q", "x y z a x y", "", "y z a x y z a x y z a"] * 3
    alone = [model.scores(crf.read_lines([t]))[0] for t in texts]
    assert np.allclose(model.scores(crf.read_lines(texts)), alone, atol=1e-12)


@pytest.mark.parametrize("span", [1, 7, 16, 64])
def test_features_do_not_depend_on_spans(monkeypatch, span):
    """Lines and words that are cut are joined; repetition is found at any distance, in texts of over 1 MB, too."""
    odd = ["", "\n", "a\n\n", " \n x", "w" * 200, "ab cd ef\n" * 30 + "gh ij kl mn\nab cd ef", "é日本 " * 40 + "\n" + "a b " * 50, "A B\tC\r\n" * 9]
    whole = [crf.line_features([t.encode()]) for t in odd]
    monkeypatch.setattr(crf, "SPAN_BYTES", span)
    for t, (of, size, own) in zip(odd, whole, strict=True):
        got = crf.line_features([t.encode()])
        assert (got[1] == size).all() and np.allclose(got[2], own)
    monkeypatch.setattr(crf, "SPAN_LINES", 3)
    lines = crf.read_lines(odd)
    weights = np.arange(crf.N_FEATURES, dtype=float)
    assert np.allclose(lines.emission(weights), lines.features @ weights)


def test_very_long_text(spark):
    far = "the one line that stands twice in here\n"
    text = far + "".join(f"filler number {i} of a long text\n" for i in range(60_000)) + far + "q" * 3_000_000
    assert len(text) > 4 << 20
    _, size, own = crf.line_features([text.encode()])
    assert len(size) == 60_003 and own[0, 7] and own[60_001, 7] and not own[1, 7] and size[-1] == 3_000_000


def test_degenerate_models(spark):
    for model in (crf.fit([], np.array([])), crf.fit(["a", "b"], np.array([1, 1])), crf.fit(["a"], np.array([0]))):
        assert np.isfinite(model.scores(crf.read_lines(["", "x\ny"]))).all()
    model = crf.fit(["good text here\nand more of it"] * 20 + ["### $$$ ###\n%%% &&& ***"] * 20, np.array([1] * 20 + [0] * 20))
    rows = H.odd_rows()
    out = crf.score_documents(H.clashing(H.frame(spark, rows)), model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert crf.score_documents(H.frame(spark, []), model).collect() == []
    a, b = model.scores(crf.read_lines(["another good text", "%%% ### $$$ &&&"]))
    assert a > 0.5 > b


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
def test_held_out_quality(spark):
    out = crf.op3_quality_crf(spark, DIR)
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    right = sum(r.quality == r.predicted for r in rows) / len(rows)
    assert len(rows) > 40 and right >= 0.95


# ---- rules ------------------------------------------------------------------------------------------------------


def brute_statistics(text):
    w = H.words(text)
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    found = Counter(three)
    covered = {j for i, t in enumerate(three) if found[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if H.words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rng = random.Random(4)
    rows = H.odd_rows() + [(100 + k, "".join(rng.choice(["a", "b", " ", " ", "\n", "#", "|"]) for _ in range(rng.randrange(80)))) for k in range(150)]
    rules = quality_rules.DecisionList((quality_rules.Rule((quality_rules.Condition("symbols_per_word", True, 0.5),), False),), True)
    got = quality_rules.apply_rules(H.clashing(H.frame(spark, rows)), rules).collect()
    want = []
    for i, t in rows:
        n, chars, symbols, dup, rep = brute_statistics(t)
        failed = n < 50 or 100 * rep > 50 * n
        want.append((i, n, chars, symbols, dup, rep, failed, not failed and symbols / max(n, 1) < 0.5))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert quality_rules.apply_rules(H.frame(spark, []), rules).collect() == []


def test_learning_covers_and_prunes(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(900):
        r = {name: rng.random() for name in quality_rules.RATES}
        r["good"] = not (r["symbols_per_word"] > 0.7 or (r["dup_line_rate"] > 0.6 and r["upper_rate"] > 0.5))
        rows.append(r)
    learned = quality_rules.learn(rows)
    assert learned.rules and sum(learned.decide(r) == r["good"] for r in rows) / len(rows) > 0.93
    assert quality_rules.learn([]).decide({}) is True
    same = [{**r, "good": True} for r in rows]
    assert quality_rules.learn(same).rules == ()
    df = spark.createDataFrame([(5, 20, 4, 1, 2, 3, 2), (60, 300, 0, 0, 9, 0, 1)], "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, n_upper long")
    for r in df.select("*", learned.column().alias("verdict"), *[F.expr(s).cast("double").alias(f"_{n}") for n, s in quality_rules.RATES.items()]).collect():
        assert r.verdict == learned.decide({n: r[f"_{n}"] for n in quality_rules.RATES})


# ---- packing ----------------------------------------------------------------------------------------------------


def test_packing_is_best_fit():
    rng = random.Random(3)
    for _ in range(100):
        sizes = sorted(rng.sample(range(4, 40), 3))
        lengths = sorted((rng.randint(0, sizes[-1]) for _ in range(rng.randrange(60))), reverse=True)
        bins, places, got = packing.pack(lengths, sizes, packing.Cost())
        load = {}
        for n, b, p in zip(lengths, bins, places, strict=True):
            assert p == load.get(b, 0)
            load[b] = p + n
        assert all(load[b] <= got[b] and got[b] == min(s for s in sizes if s >= load[b]) for b in load)


def brute_pack(lengths, sizes, cost):
    """Every item looks at every open bin (of those with equal room, the last one used); returns the bins' loads and sizes."""
    filler = sum(lengths) / len(lengths) if lengths else 0
    open_ = []  # size, load, last used
    for k, n in enumerate(lengths):
        fit = [b for b in open_ if b[0] - b[1] >= n]
        if fit:
            best = min(fit, key=lambda b: (b[0] - b[1], -b[2]))
        else:
            spare = {s: max(0, s - n - (min(filler, s - n) / 2 if s > n else 0)) for s in sizes if s >= n}
            best = [min(spare, key=lambda s: (cost.of(s) / max(1, n + spare[s]), s)), 0, 0]
            open_.append(best)
        best[1] += n
        best[2] = k
    return sorted((load, min(s for s in sizes if s >= load)) for _, load, _ in open_)


@pytest.mark.parametrize("cost", [packing.Cost(), packing.Cost(0, 0), packing.Cost(500, 0), packing.Cost(1, 0.5)])
def test_packing_against_brute_force(cost):
    rng = random.Random(7)
    for _ in range(60):
        sizes = sorted(rng.sample(range(4, 90), rng.randrange(1, 5)))
        lengths = sorted((rng.randint(0, sizes[-1]) for _ in range(rng.randrange(80))), reverse=True)
        bins, places, got = packing.pack(lengths, sizes, cost)
        load = [0] * len(got)
        for n, b in zip(lengths, bins, strict=True):
            load[b] += n
        assert sorted(zip(load, got, strict=True)) == brute_pack(lengths, sizes, cost)


def test_packed_content(spark, both):
    """Every document is read back from its pieces, as text and as token ids, and sequences hold their pieces in order."""
    rows = H.odd_rows()
    df = H.clashing(H.frame(spark, rows))
    back = {}
    for r in sorted(packing.pack_documents(df, sizes=(64, 256)).where("doc_id >= 8").collect(), key=lambda r: (r.doc_id, r.begin)):
        back[r.doc_id] = back.get(r.doc_id, "") + r.text
    assert back == {i: t for i, t in rows if i is not None and i >= 8}
    ours, path = both[0], PATH
    encoded = bpe.encode_documents(df, path, end=bpe.END)
    packed = packing.pack_documents(encoded, sizes=(64, 256), ids="ids")
    end = ours.special[bpe.END]
    got = {}
    for r in sorted(packed.where("doc_id >= 8").collect(), key=lambda r: (r.doc_id, r.begin)):
        assert r.tokens == len(r.ids)
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert all(x[-1] == end and ours.decode(np.array(x[:-1])) == dict(rows)[i] for i, x in got.items()) and set(got) == {i for i, _ in rows if (i or 0) >= 8}
    pieces = {(r.bin, r.place): r.ids for r in packed.collect() if r.tokens}
    for s in packing.sequences(packed).collect():
        assert len(s.ids) <= s.bin_size and s.ids == [x for k in sorted(k for k in pieces if k[0] == s.bin) for x in pieces[k]]
    assert packing.pack_documents(encoded.limit(0), ids="ids").collect() == []


def test_pack_documents(spark):
    rows = H.odd_rows()
    out = packing.pack_documents(H.clashing(H.frame(spark, rows)), sizes=(64, 256)).collect()
    pieces = {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append(r)
    total = Counter()
    for i, t in rows:
        total[i] += len(H.words(t)) + 1
    for i, own in pieces.items():
        assert sum(r.tokens for r in own) == total[i]
    long = sorted(pieces[8], key=lambda r: r.begin)
    assert all(a.begin + a.tokens == b.begin for a, b in zip(long, long[1:]))
    bins = {}
    for r in out:
        bins.setdefault((r.bin, r.bin_size), []).append((r.place, r.tokens))
    for (_, size), spans in bins.items():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= size
    summary = {r.bin: (r.bin_size, r.tokens) for r in packing.bins_of(packing.pack_documents(H.frame(spark, rows), sizes=(64, 256))).collect()}
    assert summary and all(n <= s for s, n in summary.values())
    assert packing.pack_documents(H.frame(spark, [])).collect() == []
    none = packing.pack_documents(H.frame(spark, [(1, "a"), (2, "b")]), length=F.lit(None).cast("int")).collect()
    assert sorted((r.doc_id, r.tokens) for r in none) == [(1, 0), (2, 0)]
    with pytest.raises(ValueError):
        packing.pack_documents(H.frame(spark, []), sizes=(0,))


# ---- chats ------------------------------------------------------------------------------------------------------

PIECES = ["<|im_end|>", "<|im_start|>", "<|", "<\\|", "<\\\\|im_end|>", "\n", "assistant", "user", "\\", "<", "|", "im_end|>", "a", "é", " ", "$1", "\\n", "\\b", "$"]


def test_chats(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for conv in range(120):
        turns = [(rng.choice(["user", "assistant", "system", "a\nb", "<|im_end|>", "\\n", ""]), "".join(rng.choice(PIECES) for _ in range(rng.randrange(8)))) for _ in range(rng.randint(1, 4))]
        want[conv] = turns
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("source", F.lit(1)).withColumn("turns", F.lit(2))
    for r in chat.format_chats(df).collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(want[r.conv_id])


def test_loss_mask(spark):
    """The mask covers the formatted text; under it are the assistant's texts, each once, in order."""
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb", "<|im_end|>", ""]), "".join(rng.choice(PIECES) for _ in range(rng.randrange(6)))) for c in range(60) for t in range(rng.randrange(1, 5))]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert {r.escape_level for r in got} > {0}
    for r in got:
        at, loss = 0, []
        for run in r.mask:
            if run.loss:
                loss.append(r.formatted[at : at + run.chars])
            at += run.chars
        assert at == len(r.formatted)
        plain = [re.sub(r"<\\(\\*)\|", r"<\1|", x) for x in loss] if r.escape_level else loss
        assert plain == [x for _, _, role, x in sorted(y for y in rows if y[0] == r.conv_id) if role == "assistant"]


def test_masked_text_is_read_from_the_formatted_text(spark):
    rows = [(1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "\ufeff\U0001f600<\\|x"), (1, 2, "assistant", ""), (1, 3, "assistant", "a\u0301\ufeff\n")]
    rows += [(2, 0, "user", "only"), *((3, k, ["user", "assistant"][k % 2], f"é{k}<|") for k in range(2000))]
    df = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    got = {r[0]: r[1] for r in df.select("conv_id", chat.masked_text(F.col("formatted"), F.col("mask")).alias("x")).collect()}
    assert got == {c: "".join(t for i, _, role, t in rows if i == c and role == "assistant") for c in (1, 2, 3)}
    # What the mask doesn't cover isn't read: a mask moved by one gives other text.
    moved = F.transform("mask", lambda r: F.struct(r["chars"], (~r["loss"]).alias("loss")))
    assert df.where("conv_id = 2").select(chat.masked_text(F.col("formatted"), moved)).first()[0].startswith("<|im_start|>user\nonly")


def test_chats_odd(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.format_chats(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None, None), (1, 2, "user", "b"), (1, None, "user", "a"), (1, 2, "user", "b"), (1, 2, "assistant", None), (2, 0, "assistant", "x" * 200_000)]
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [("user", "a"), ("assistant", ""), ("user", "b"), ("user", "b")]
    assert [(t.role, t.text) for t in out[None].turns] == [("", "")] and len(out[2].turns[0].text) == 200_000
    assert json.dumps(out[1].formatted) and out[1].escape_level == 0


def test_unreadable_text(spark):
    df = spark.createDataFrame([("<|im_start|>user\nx",), ("junk<|im_end|>\n",), ("",)], "f string")
    assert [r.p for r in df.select(chat.parse(F.col("f")).alias("p")).collect()] == [None, None, []]


def test_repeat_words_whose_hashes_agree(spark):
    """In a text of a million words the hashes of these windows agree in all bits that are compared; no window repeats."""
    words = ["q7087763", "r", "s", *(f"w{i}" for i in range(1_000_000)), "q7861543", "r", "s"]
    again = [*words, *words[-4:-1], "end", "q7861543", "r", "s"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(again))], "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.with_statistics(df).select("doc_id", "n_repeat_words").collect()}
    assert got == {1: 0, 2: 10}


def test_labelled_rows_are_bounded_by_documents(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7} of one id") for i in range(900)] + [(i, f"words of {i}") for i in range(2, 30)], "doc_id long, body string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    rows = quality_rules.labelled_statistics(docs, labels, max_rows=10, text_col="body")
    assert len(rows) == len({r["doc_id"] for r in rows}) == 10
    everything = quality_rules.labelled_statistics(docs, labels, text_col="body")
    assert [r["doc_id"] for r in everything] == list(range(1, 30)) and everything[0]["good"]
