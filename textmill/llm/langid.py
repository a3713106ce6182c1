"""Language identification by error-correcting output codes.

Every language is given a codeword of bits. For each bit one binary classifier over
hashed character n-grams says on which side of the split a text lies; decoding adds
up, for every language, the logistic loss of all bits against its codeword and takes
the nearest one. So a few wrong bits are outvoted, and a text whose best two
languages are close, or whose bits fit no codeword, is flagged as ambiguous.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import frugal_batches, table, text_or_empty
from textmill.llm.hashing import mixed

UNDETERMINED = "und"
ORDERS = (1, 2, 3, 4)
BITS = 16
#: Code points that are read at a time.
SPAN = 1 << 19
#: Lengths in characters of the pieces that training texts are cut into, so that short texts are learned, too.
PIECES = (30, 120, 480, 1920)
#: Exhaustive codes double with each language; beyond so many languages, columns are drawn.
EXHAUSTIVE = 7


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of bits (+1, -1) for each of n languages; no two columns split the languages alike.

    Up to EXHAUSTIVE languages all splits are columns; beyond, the best of some drawn
    codes: the one whose two closest rows differ the most.
    """
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))
        rows = (splits[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.concatenate([np.zeros((1, len(splits)), np.int64), rows]).astype(np.int8) * 2 - 1
    width = 6 * (n - 1).bit_length()
    rng = np.random.default_rng(seed)
    best, closest = None, -1
    for _ in range(64):
        code = np.where(rng.random((n, 2 * width)) < 0.5, -1, 1).astype(np.int8)
        code *= code[0]  # a split and its complement are the same
        code = np.unique(code, axis=1)
        code = code[:, np.abs(code.astype(int).sum(0)) < n]
        code = code[:, rng.permutation(code.shape[1])[:width]]
        alike = code.astype(int) @ code.T
        np.fill_diagonal(alike, -width)
        if (apart := (code.shape[1] - alike.max()) // 2) > closest:
            best, closest = code, apart
    return best


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: itself for letters and their marks, else a blank; and whether it is a letter."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    letter = np.array([k == "L" for k in kinds])
    kept = np.where(letter | np.array([k == "M" for k in kinds]), np.arange(0x110000), 32)
    return kept.astype(np.uint32), letter


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: str) -> bool:
    letter = _characters()[1]
    return any(letter[_codes(text[at : at + SPAN])].any() for at in range(0, len(text), SPAN))


def spans(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """A text's lower-case letters, runs of other characters as one blank, a span at a time.

    With each span: how many of its first codes repeat the end of the one before.
    """
    keep = max(ORDERS) - 1
    tail = np.array([32], np.uint32)
    for at in range(0, len(text) + 1, SPAN):
        last = at + SPAN > len(text)
        codes = np.concatenate([tail, _characters()[0][_codes(text[at : at + SPAN].lower())], np.full(int(last), 32, np.uint32)])
        blank = codes == 32
        blank[1:] &= blank[:-1]
        blank[: len(tail)] = False
        codes = codes[~blank]
        yield codes, len(tail) if at else 1  # the first blank stands for the text's start
        tail = codes[-keep:]


def gram_slots(parts: list[tuple[np.ndarray, int]]) -> Iterator[np.ndarray]:
    """For each order, the slot of the n-gram that ends at each code of the parts; 2**BITS where none does."""
    sizes = np.array([len(c) for c, _ in parts])
    codes = np.concatenate([c for c, _ in parts]).astype(np.uint64)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fresh = place >= np.repeat([k for _, k in parts], sizes)
    total = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        factor = np.uint64(pow(0x9E3779B97F4A7C15, n, 1 << 64))
        total[n - 1 :] += codes[: len(codes) - n + 1] * factor
        if n in ORDERS:
            slot = (mixed(total + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64)
            slot[~(fresh & (place >= n - 1))] = 1 << BITS
            yield slot


def _batches(texts: Iterable[str]) -> Iterator[tuple[list[tuple[np.ndarray, int]], list[int]]]:
    """Parts of about SPAN codes in all, and the number of the text of each."""
    parts, of, held = [], [], 0
    for i, text in enumerate(texts):
        for part in spans(text):
            parts.append(part)
            of.append(i)
            held += len(part[0])
            if held >= SPAN:
                yield parts, of
                parts, of, held = [], [], 0
    if parts:
        yield parts, of


@dataclass
class Model:
    """Weights by n-gram slot and bit, a bias a bit, and the codeword of each language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def bits(self, texts: list[str]) -> np.ndarray:
        """How far each text lies on the +1 side of every bit: the mean weight of its n-grams."""
        width = self.code.shape[1]
        sums, counts = np.zeros((len(texts), width)), np.zeros(len(texts))
        for parts, of in _batches(texts):
            starts = np.cumsum([0, *(len(c) for c, _ in parts[:-1])])
            for slot in gram_slots(parts):
                np.add.at(sums, of, np.add.reduceat(self.weights[slot], starts, axis=0))
                np.add.at(counts, of, np.add.reduceat((slot < 1 << BITS).astype(np.int64), starts))
        return sums / np.maximum(counts, 1)[:, None] + self.bias

    def decode(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The language nearest by loss, its share of all languages' likelihoods, and whether it is ambiguous."""
        code = self.code.astype(np.float64)
        loss = np.logaddexp(0, -bits[:, None, :] * code[None]).sum(2)
        best = loss.argmin(1)
        likely = np.exp(loss.min(1)[:, None] - loss)
        score = 1 / likely.sum(1)
        wrong = ((bits > 0) != (code[best] > 0)).sum(1)
        apart = (code.shape[1] - (code @ code.T)[~np.eye(len(code), dtype=bool)].max(initial=-code.shape[1])) // 2
        return best, score, (score < 0.75) | (2 * wrong >= max(apart, 1))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) of each text; undetermined, 0 and ambiguous without a letter."""
        known = [i for i, x in enumerate(texts) if x and has_letter(x)] if self.languages else []
        out = [(UNDETERMINED, 0.0, True)] * len(texts)
        if known:
            for i, best, score, unsure in zip(known, *self.decode(self.bits([texts[i] for i in known])), strict=True):
                out[i] = (self.languages[best], float(score), bool(unsure))
        return out


def _pieces(text: str) -> Iterator[str]:
    """The whole text, and all of it in pieces of several lengths."""
    yield text
    at, k = 0, 0
    while at < len(text) and len(text) > PIECES[0]:
        yield text[at : at + PIECES[k % len(PIECES)]]
        at, k = at + PIECES[k % len(PIECES)], k + 1


def fit(texts: list[str], langs: list[str], rounds: int = 40, ridge: float = 1e-4) -> Model:
    """One logistic classifier a bit, all fitted together by Adam; a language counts the same, however many texts it has."""
    languages = sorted(set(langs))
    code = codewords(len(languages))
    width, n_slots = code.shape[1], 1 << BITS
    nothing = Model(languages, code, np.zeros((n_slots + 1, width), np.float32), np.zeros(width))
    if len(languages) < 2:
        return nothing
    number = {x: i for i, x in enumerate(languages)}
    rows, cols, values, label = [], [], [], []
    for text, lang in zip(texts, langs, strict=True):
        for piece in _pieces(text):
            slots = np.concatenate([s for parts, _ in _batches([piece]) for s in gram_slots(parts)])
            slot, n = np.unique(slots[slots < n_slots], return_counts=True)
            if len(slot):
                rows.append(np.full(len(slot), len(label), np.int32))
                cols.append(slot.astype(np.int32))
                values.append((n / n.sum()).astype(np.float32))
                label.append(number[lang])
    if not label:
        return nothing
    row, col, value = np.concatenate(rows), np.concatenate(cols), np.concatenate(values)
    del rows, cols, values
    label = np.array(label)
    # Slots are scaled by how common they are, so that rare and common ones move alike.
    scale = 1 / np.sqrt(np.bincount(col, value, n_slots) / len(label) + 1e-4)
    value *= scale[col].astype(np.float32)
    by_col = np.argsort(col, kind="stable").astype(np.int32)
    col_starts = np.flatnonzero(np.diff(col[by_col], prepend=np.int32(-1)))
    used = col[by_col][col_starts]
    row_starts = np.flatnonzero(np.diff(row, prepend=-1))
    place = np.searchsorted(used, col).astype(np.int32)
    row_c, value_c = row[by_col], value[by_col][:, None]
    target = code[label].astype(np.float32)
    share = (1 / np.bincount(label, minlength=len(languages))[label] / len(languages)).astype(np.float32)[:, None]
    w, b = np.zeros((len(used), width), np.float32), np.zeros(width, np.float32)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    for k in range(1, rounds + 1):
        z = np.add.reduceat(w[place] * value[:, None], row_starts, axis=0) + b
        pull = share * target / (1 + np.exp(np.clip(target * z, -30, 30)))
        slope_w = np.add.reduceat(pull[row_c] * value_c, col_starts, axis=0) - ridge * w
        for x, slope, i in ((w, slope_w, 0), (b, pull.sum(0), 2)):
            state[i] = 0.9 * state[i] + 0.1 * slope
            state[i + 1] = 0.99 * state[i + 1] + 0.01 * slope**2
            x += 0.3 * (state[i] / (1 - 0.9**k)) / (np.sqrt(state[i + 1] / (1 - 0.99**k)) + 1e-9)
    weights = np.zeros((n_slots + 1, width), np.float32)
    weights[used] = w * scale[used][:, None].astype(np.float32)
    return Model(languages, code, weights, b.astype(np.float64))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def learning_rows(
    docs: DataFrame, per_lang: int = 150, max_bytes: int = 3 << 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> tuple[list[str], list[str]]:
    """Texts and their languages: at most per_lang documents of each, of max_bytes in all, none of the held-out fifth.

    They are picked by a hash of the id, language by language in turn; a document
    that would exceed max_bytes is passed over for the next ones. Rows that repeat
    an id and text are read once. Only ids, hashes and sizes are ranked; texts are
    fetched for the picked ones.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out("id") & (F.col("text") != ""))
    named = rows.select("id", "lang", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "h"))
    chosen = named.withColumn("turn", turn).where(F.col("turn") <= per_lang).orderBy("turn", "lang").collect()
    picked, held = set(), 0
    for r in chosen:
        if (r["id"], r["h"]) not in picked and held + r["size"] <= max_bytes:
            held += r["size"]
            picked.add((r["id"], r["h"]))
    wanted = docs.sparkSession.createDataFrame(sorted(picked), named.select("id", "h").schema)
    # per_lang rows a language and max_bytes bound both what is broadcast and what is collected.
    found = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(wanted), ["id", "h"], "left_semi")
    found = sorted(found.dropDuplicates(["id", "h"]).select("id", "h", "lang", "text").collect())
    return [r["text"] for r in found], [r["lang"] for r in found]


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, lang_pred, score (0 to 1) and ambiguous of every row.

    A null or empty text, or one without a letter, is undetermined (und, 0, true), as
    are all texts if no language has been learned. Rows are judged one by one, so
    null ids, repeated rows and further columns need no care, and equal texts get
    the same. Texts are read whole, some thousand characters at a time. Of equally
    near languages the first by name is taken. An empty table gives an empty result.
    """

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = model.predict(batch["_text"].tolist())
            found = pd.DataFrame(told, columns=["lang_pred", "score", "ambiguous"])
            yield pd.concat([batch[[id_col]].reset_index(drop=True), found], axis=1)

    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"`{id_col}` {kind}, lang_pred string, score double, ambiguous boolean"
    return docs.select(id_col, text_or_empty(text_col).alias("_text")).mapInPandas(run, shape)


def op12_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(*learning_rows(docs)))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
