"""Line quality by a linear-chain conditional random field.

Every line of a document is a node with two states, good and bad. A node's score
is linear in features of the line and of its neighbours; adjacent nodes share
transition scores. Forward-backward gives each line's probability of being good,
and a document's quality is a logistic function of the length-weighted sums of
these marginals.

Labels are known for documents only, so lines start with their document's label,
and lines of bad documents that a first model holds for good are relabelled before
the model that is used is fitted. Fitting reads a bounded sample (``max_docs``
labelled documents of ``max_bytes`` in all, by a hash of the id); scoring reads
everything, and a document's score depends on its own text only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, frugal_batches, table, text_or_empty

#: So many bytes are looked at at a time; lines and words that are cut are joined again.
SPAN_BYTES = 1 << 20
#: So many lines' features are held at a time when scoring.
SPAN_LINES = 1 << 16

_CLASSES = np.zeros(256, dtype=np.int64)  # 0: other
for _k, _chars in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b"!?", b" \t\r\x0b\x0c", b".,;:"), 1
):
    _CLASSES[list(_chars)] = _k
_CLASSES[0xC0:] = 8  # the first byte of a longer character
_CLASSES[0x80:0xC0] = 9  # its other bytes
N_CLASSES = 10
OWN = 13  # features of a line itself
N_FEATURES = 1 + OWN + 2 * 7 + 2

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(pow(int(_ODD), -1, 1 << 64)), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, (n - 1).bit_length())
    if size not in _tables:
        _tables.clear()
        _tables[size] = (_powers(size), _inverse_powers(size))
    return _tables[size]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether a key is found twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


@dataclass
class _Span:
    """What a span of bytes holds: its lines' and words' counts, sizes and raw hashes."""

    counts: np.ndarray  # lines x N_CLASSES
    size: np.ndarray  # bytes of each line
    whole: np.ndarray  # raw hash of each line
    word: np.ndarray  # raw hash of each word
    word_size: np.ndarray
    word_line: np.ndarray
    tail: bool  # whether the span ends within a word


def _span(raw: bytes) -> _Span:
    """The lines (parted by line feeds, so one more than there are of these) and words of some bytes."""
    buf = np.frombuffer(raw, dtype=np.uint8)
    feeds = np.flatnonzero(buf == 10)
    starts, ends = np.append(0, feeds + 1), np.append(feeds, len(buf))
    size = ends - starts
    n = len(ends)
    kinds = _CLASSES[buf]
    line_of = np.repeat(np.arange(n), size + 1)[: len(buf)]
    counts = np.bincount(line_of * N_CLASSES + kinds, minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float64)
    counts[:-1, 0] -= 1  # the line feeds
    blank = (kinds == 6) | (buf == 10)
    edge = np.flatnonzero(np.diff(np.concatenate(([1], blank.view(np.int8), [1]))))
    w_start, w_end = edge[::2], edge[1::2]
    power, inverse = _power_tables(len(buf) + 1)
    total = np.concatenate(([np.uint64(0)], np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], dtype=np.uint64)))
    return _Span(
        counts, size, (total[ends] - total[starts]) * inverse[starts], (total[w_end] - total[w_start]) * inverse[w_start],
        w_end - w_start, np.searchsorted(ends, w_start, side="right"), bool(len(buf)) and not blank[-1],
    )


def _joined(a: np.uint64, size: int, b: np.uint64) -> np.uint64:
    """The raw hash of two strings, the first of size bytes, one after the other."""
    return np.uint64((int(a) + int(b) * pow(int(_ODD), int(size), 1 << 64)) & (2**64 - 1))


def _spans_of(text: bytes) -> list[_Span]:
    """The spans of a text; a line or word that goes on in the next span is moved there whole (by its counts and hashes)."""
    out: list[_Span] = []
    for at in range(0, max(1, len(text)), SPAN_BYTES):
        s = _span(text[at : at + SPAN_BYTES])
        if out:
            p = out[-1]
            if p.tail and len(s.word_size) and not _is_blank(text[at]):
                s.word[0] = _joined(p.word[-1], p.word_size[-1], s.word[0])
                s.word_size[0] += p.word_size[-1]
                p.word, p.word_size, p.word_line = p.word[:-1], p.word_size[:-1], p.word_line[:-1]
            s.whole[0] = _joined(p.whole[-1], p.size[-1], s.whole[0])
            s.size[0] += p.size[-1]
            s.counts[0] += p.counts[-1]
            mine = p.word_line == len(p.size) - 1
            s.word = np.concatenate([p.word[mine], s.word])
            s.word_size = np.concatenate([p.word_size[mine], s.word_size])
            s.word_line = np.concatenate([np.zeros(int(mine.sum()), np.int64), s.word_line])
            p.word, p.word_size, p.word_line = p.word[~mine], p.word_size[~mine], p.word_line[~mine]
            p.counts, p.size, p.whole = p.counts[:-1], p.size[:-1], p.whole[:-1]
        out.append(s)
    return out


def _is_blank(byte: int) -> bool:
    return byte == 10 or _CLASSES[byte] == 6


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the lines of all texts: which text, bytes, and own features (lines x OWN).

    A text of up to SPAN_BYTES is looked at together with others, a longer one in
    spans. Repetition is looked for in the whole of a text and in no other one.
    """
    parts: list[_Span] = []
    line_text: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= SPAN_BYTES):
            held += len(texts[end]) + 1
            end += 1
        if end == at + 1:
            spans = _spans_of(texts[at])
            line_text.append(np.full(sum(len(s.size) for s in spans), at))
        else:
            spans = [_span(b"\n".join(texts[at:end]))]
            line_text.append(np.repeat(np.arange(at, end), [t.count(b"\n") + 1 for t in texts[at:end]]))
        parts += spans
        at = end
    counts, size, whole, word, w_size = (np.concatenate([getattr(p, c) for p in parts]) for c in ("counts", "size", "whole", "word", "word_size"))
    first = np.cumsum([0, *(len(p.size) for p in parts)])
    w_line = np.concatenate([p.word_line + k for p, k in zip(parts, first[:-1], strict=True)])
    text_of = np.concatenate(line_text)
    n = len(size)
    word = (word ^ (word >> np.uint64(29))) * _MIX
    words = np.bincount(w_line, minlength=n).astype(np.float64)
    again = np.zeros(n)
    common = np.zeros(n)
    if len(word) > 1:
        adjacent = (word[1:] == word[:-1]) & (w_line[1:] == w_line[:-1])
        again = np.bincount(w_line[1:][adjacent], minlength=n)
    if len(word) > 2:
        w_text = text_of[w_line]
        inside = w_text[:-2] == w_text[2:]  # windows end in the text that they begin in
        three = (word[:-2] * _ODD + word[1:-1]) * _ODD + word[2:]
        three = (three ^ (three >> np.uint64(31))) * _MIX + w_text[:-2].astype(np.uint64) * _ODD
        common = np.bincount(w_line[:-2][inside][_repeats(three[inside])], minlength=n)
    twice = _repeats(whole * _MIX + text_of.astype(np.uint64)) & (size > 0)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, 8], 1)
    some = np.maximum(words, 1)
    symbols, shouts = counts[:, 4] / some, counts[:, 5] / some
    upper = counts[:, 1] / letters
    own = np.column_stack(
        [
            upper,
            upper > 0.5,
            np.minimum(symbols, 3) / 3,
            symbols > 0.3,
            np.minimum(shouts, 2) / 2,
            again / some,
            common / some,
            twice,
            np.minimum(counts[:, 3] / some, 2) / 2,
            np.minimum(counts[:, 7] / some, 1),
            np.log1p(words) / 5,
            np.minimum(letters / some, 20) / 20,
            words == 0,
        ]
    ).astype(np.float64)
    return text_of, size, own


def with_neighbours(own: np.ndarray, begins: np.ndarray, goes_on: bool = False) -> np.ndarray:
    """Bias, own features, those of the lines before and after, and whether there are none.

    goes_on: lines follow that aren't given, so the last one's features are unknown.
    """
    n = len(own)
    out = np.zeros((n, N_FEATURES))
    out[:, 0] = 1
    out[:, 1 : 1 + OWN] = own
    near = own[:, [0, 2, 4, 5, 6, 7, 10]]
    first = np.zeros(n, dtype=bool)
    first[begins] = True
    last = np.append(first[1:], not goes_on)
    at = 1 + OWN
    out[1:, at : at + 7] = near[:-1]
    out[first, at : at + 7] = 0
    out[:-1, at + 7 : at + 14] = near[1:]
    out[last, at + 7 : at + 14] = 0
    out[:, -2], out[:, -1] = first, last
    return out


@dataclass
class Lines:
    """The lines of some documents, end to end, each with at least one line."""

    begins: np.ndarray
    count: np.ndarray
    size: np.ndarray
    own: np.ndarray

    @property
    def features(self) -> np.ndarray:
        return with_neighbours(self.own, self.begins)

    def emission(self, weights: np.ndarray) -> np.ndarray:
        """features @ weights, some lines at a time."""
        out = np.empty(len(self.own))
        for a in range(0, len(out), SPAN_LINES):
            b = min(a + SPAN_LINES, len(out))
            x, y = max(a - 1, 0), min(b + 1, len(out))
            begins = self.begins[(self.begins >= x) & (self.begins < y)] - x
            # The line past the end may begin a document; the one before the start is only a neighbour.
            out[a:b] = (with_neighbours(self.own[x:y], begins, y < len(out)) @ weights)[a - x : b - x]
        return out


def read_lines(texts: list[str]) -> Lines:
    """Lines of whole texts."""
    of, size, own = line_features([t.encode("utf-8", "replace") for t in texts])
    count = np.bincount(of, minlength=len(texts))
    return Lines(np.cumsum(count) - count, count, size.astype(np.float64), own)


@dataclass
class Model:
    weights: np.ndarray  # of a good line's features, against a bad line's 0
    moves: np.ndarray  # 2 x 2 transition scores
    document: np.ndarray  # logistic weights of document_inputs

    def marginals(self, lines: Lines) -> np.ndarray:
        return chain(lines, lines.emission(self.weights), self.moves)[0]

    def scores(self, lines: Lines) -> np.ndarray:
        z = document_inputs(lines, self.marginals(lines)) @ self.document
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def document_inputs(lines: Lines, good: np.ndarray) -> np.ndarray:
    """Bias, length-weighted mean marginal, log of the bad mass, and whether most is bad, of each document."""
    weight = lines.size + 1
    total = np.add.reduceat(weight, lines.begins)
    mean = np.add.reduceat(weight * good, lines.begins) / total
    return np.column_stack([np.ones(len(total)), 2 * mean - 1, np.log1p(total * (1 - mean)) / 5, 1 - mean > 0.5])


def chain(lines: Lines, emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of good, expected transition counts (2 x 2 for each document) and log Z.

    All documents advance by one line a step; those that have ended drop out.
    """
    n_docs = len(lines.count)
    order = np.argsort(-lines.count, kind="stable")
    count, begins = lines.count[order], lines.begins[order]
    steps = int(count[0])
    live = np.searchsorted(-count, -np.arange(1, steps + 1), side="right")  # documents with a line at step t
    m = np.exp(moves)
    score = np.exp(np.clip(emission, -30, 30))
    alpha, beta, scale = np.zeros((len(emission), 2)), np.zeros((len(emission), 2)), np.ones(len(emission))
    a = np.ones((n_docs, 2))
    for t in range(steps):
        k = live[t]
        at = begins[:k] + t
        a = a[:k] @ m if t else a[:k].copy()
        a[:, 1] *= score[at]
        s = a.sum(1)
        a /= s[:, None]
        alpha[at], scale[at] = a, s
    edges = np.zeros((n_docs, 2, 2))
    b = np.ones((n_docs, 2))
    for t in range(steps - 1, -1, -1):
        k = live[t]
        at = begins[:k] + t
        now = np.ones((k, 2))
        if t + 1 < steps:
            j = live[t + 1]
            nxt = at[:j] + 1
            ahead = b[:j].copy()
            ahead[:, 1] *= score[nxt]
            ahead /= scale[nxt][:, None]
            edges[order[:j]] += alpha[at[:j]][:, :, None] * m[None] * ahead[:, None, :]
            now[:j] = ahead @ m.T
        b[:k] = now
        beta[at] = now
    good = alpha[:, 1] * beta[:, 1]
    return good / (good + alpha[:, 0] * beta[:, 0]), edges, np.add.reduceat(np.log(scale), lines.begins)


def fit_chain(lines: Lines, state: np.ndarray, rounds: int, ridge: float, start: Model | None = None) -> Model:
    """Maximum likelihood of the states (0, 1) by Adam; a document counts once, whatever its length."""
    share = np.repeat(1 / lines.count, lines.count) / len(lines.count)
    x, y = lines.features, state.astype(np.float64)
    inner = np.ones(len(y), dtype=bool)
    inner[lines.begins] = False
    pair = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[pair - 1], state[pair]), share[pair])
    theta = np.zeros(x.shape[1] + 4) if start is None else np.concatenate([start.weights, start.moves.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    each = 1 / lines.count / len(lines.count)
    for k in range(1, rounds + 1):
        moves = theta[-4:].reshape(2, 2)
        good, edges, _ = chain(lines, x @ theta[:-4], moves)
        slope = np.concatenate([x.T @ (share * (y - good)), (seen - (edges * each[:, None, None]).sum(0)).ravel()]) - ridge * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta = theta + 0.15 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-9)
    return Model(theta[:-4], theta[-4:].reshape(2, 2), np.zeros(4))


def fit(texts: list[str], labels: np.ndarray, rounds: int = 120, ridge: float = 1e-4) -> Model:
    """A model from documents labelled 1 (good) or 0; without both labels it scores by the share seen."""
    labels = np.asarray(labels, dtype=np.int64)
    if not len(labels) or labels.min() == labels.max():
        bias = 0.0 if not len(labels) else (4.0 if labels[0] else -4.0)
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), np.array([bias, 0, 0, 0]))
    lines = read_lines(texts)
    label = np.repeat(labels, lines.count)
    model = fit_chain(lines, label, rounds, ridge)
    good = model.marginals(lines)
    model = fit_chain(lines, np.where(label == 1, 1, (good > 0.5).astype(np.int64)), rounds // 2, ridge, model)
    inputs = document_inputs(lines, model.marginals(lines))
    w = np.zeros(inputs.shape[1])
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(inputs @ w, -35, 35)))
        h = (inputs * (p * (1 - p))[:, None]).T @ inputs + np.eye(len(w)) * 0.1
        w += np.linalg.solve(h, inputs.T @ (labels - p) - 0.1 * w)
    model.document = w
    return model


def learning_rows(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = 3000,
    max_bytes: int = 64 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> tuple[list[str], np.ndarray]:
    """At most max_docs labelled documents outside the held-out fifth, picked by a hash of the id, of max_bytes in all.

    Of rows that repeat an id the one with the smallest text hash is read; a
    document that would exceed max_bytes is passed over for the next ones.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(max_docs)
    scratch = Scratch(docs.sparkSession, "labelled")
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id")
    rows = scratch.write(rows.select("id", "_label", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size")))
    one = rows.groupBy("id").agg(F.min(F.struct("h", "size")).alias("one")).select("id", "one.*")  # max_docs rows at most
    picked, held = [], 0
    for r in sorted(one.collect()):
        if held + r["size"] <= max_bytes:
            held += r["size"]
            picked.append((r["id"], r["h"]))
    wanted = docs.sparkSession.createDataFrame(picked, rows.select("id", "h").schema)
    found = sorted(rows.join(F.broadcast(wanted), ["id", "h"]).dropDuplicates(["id"]).select("id", "text", "_label").collect())
    scratch.drop(rows)
    return [r[1] for r in found], np.array([r[2] for r in found], dtype=np.int64)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Id, the columns to carry, and score (0 to 1) of every row.

    Empty and null texts are one empty line and get its score. Null ids, repeated
    rows and further columns need no care, as rows are scored one by one. A text's
    score is the same alone and beside any others. A text is held as a whole, with
    some 500 bytes for each of its lines. An empty table gives an empty result.
    """

    # A text that is carried is sent to the workers once.
    read, more = (text_col, []) if text_col in carry else ("_text", ["_text"])

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch[read].str.len().fillna(0).to_numpy(np.int64)
            cut = np.searchsorted(np.cumsum(sizes), np.arange(SPAN_BYTES, sizes.sum() + SPAN_BYTES, SPAN_BYTES))
            begins = sorted({0, *(int(c) for c in cut if c < len(batch))})
            for a, b in zip(begins, [*begins[1:], len(batch)], strict=True):
                if b > a:
                    part = batch.iloc[a:b]
                    lines = read_lines([x if isinstance(x, str) else "" for x in part[read]])
                    yield part.drop(columns=more).assign(score=model.scores(lines))

    keep = docs.select(id_col, *carry).schema
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "score double"])
    return docs.select(id_col, *carry, *[F.col(text_col).alias(c) for c in more]).mapInPandas(run, shape)


def op3_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(*learning_rows(docs, table(spark, sf_dir, "labels")))
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
