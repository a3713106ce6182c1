"""Suffix-array deduplication of bytes with run-length indexes.

A byte goes if a string of ``width`` bytes over it also starts in a document with
a smaller id. Exact copies of a whole text go as a whole (a text is told by its
SHA-256), so only one document of each text takes part in what follows.

1. Anchors. The least hash of the 26-byte grams of every 50-byte window names the
   window's anchor. Equal windows have equal anchors, so only windows whose anchor
   another document has, too, can repeat; the stretches of such windows are cut out.
   Neighbouring windows with one anchor are a run.
2. Routing. The bytes of a run are hashed, and each run learns the block of
   documents that has it first. What is left are runs that no earlier document has
   as a whole: where one anchor has several of these, their windows are hashed and
   routed one by one. Windows in a row with one first block are a piece; runs and
   windows that are first themselves and occur again are that block's sources.
3. Index. Every block's sources are indexed (a run-compressed Burrows-Wheeler
   transform with sampled run ends, see run_index.py), the pieces are streamed
   through it, and positions whose matching statistic reaches ``width`` are marked.

So hashes of parts only tell where to look; what is removed from a text has been
matched byte for byte. Equal pieces of a block are sent once, and the pieces for
one block's sources are salted by their size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.blocks import Block, bucket_bits, ordered_blocks, read_answers, read_sources, seen_earlier, with_answers
from textmill.llm.common import Scratch, frugal, frugal_batches, table, text_or_empty
from textmill.llm.hashing import mixed, powers
from textmill.llm.run_index import RunIndex
from textmill.llm.substring_dedup import intervals

#: Windows hashed at a time: few enough to stay in a processor's cache.
STRETCH = 1 << 16
#: Long pieces are streamed in parts of this length, side by side.
PART = 512
SALT_BYTES = 4 << 20

_SPREAD = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MIX = np.uint64(0x94D049BB133111EB)


def _sums(body: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes' values times the powers of the base."""
    total = np.empty(len(body) + 1, np.uint64)
    total[0] = 0
    values = _SPREAD[body]
    values *= powers(len(body) + 1)[0][: len(body)]
    np.cumsum(values, out=total[1:])
    return total


def _finished(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


def byte_windows(body: np.ndarray, width: int) -> np.ndarray:
    """The hash of body[i : i + width] for every i."""
    n = len(body) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = _sums(body)
    out = total[width:] - total[:n]
    out *= powers(len(body) + 1)[1][:n]
    return _finished(out)


def byte_strings(body: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of some strings of body."""
    total = _sums(body)
    out = (total[ends] - total[begins]) * powers(len(body) + 1)[1][begins]
    return _finished(out + (ends - begins).astype(np.uint64))


def window_anchors(body: np.ndarray, width: int) -> np.ndarray:
    """For every window of width bytes, the least hash of its grams of a little over half that."""
    gram = width // 2 + 1
    out = byte_windows(body, gram)
    span, wide = 1, width - gram + 1
    while span * 2 <= wide:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    more = wide - span
    return np.minimum(out[:-more], out[more:]) if more else out


def anchor_runs(block: Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one document with one anchor: anchor, document, first and end position."""
    body = np.frombuffer(block.body, np.uint8)
    n = len(body) - width + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return np.empty(0, np.uint64), none, none, none
    inside = np.maximum(block.sizes - width + 1, 0)
    kinds = np.tile(np.array([True, False]), len(inside))
    valid = np.repeat(kinds, np.column_stack([inside, block.sizes - inside]).ravel())[:n]
    fresh = np.zeros(len(body) + 1, dtype=bool)
    fresh[block.ends - block.sizes] = True
    values, places = [], []
    before = None
    for at in range(0, n, STRETCH):
        least = window_anchors(body[at : at + STRETCH + width - 1], width)
        change = fresh[at : at + len(least)].copy()
        change[1:] |= least[1:] != least[:-1]
        change[0] |= before is None or least[0] != before
        before = least[-1]
        change &= valid[at : at + len(least)]
        new = np.flatnonzero(change)
        values.append(mixed(least[new]))  # least hashes are small ones: without this they crowd the first buckets
        places.append(new + at)
    begins = np.concatenate(places)
    if not len(begins):
        return np.empty(0, np.uint64), none, none, none
    docs = np.searchsorted(block.ends, begins, side="right")
    # A run ends where the next one begins or its document has no more windows.
    ends = np.minimum(np.append(begins[1:], n), block.ends[docs] - width + 1)
    return np.concatenate(values), docs, begins, ends


def _in_other_documents(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Whether a value is also found with another owner."""
    order = np.argsort(values, kind="stable")
    v, o = values[order], owners[order]
    begins = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.empty(0, np.int64)
    out = np.zeros(len(values), dtype=bool)
    if len(v):
        differ = np.minimum.reduceat(o, begins) != np.maximum.reduceat(o, begins)
        out[order] = np.repeat(differ, np.diff(np.append(begins, len(v))))
    return out


def _owner(block: Block) -> np.ndarray:
    """A number for each document's id; equal ids, which stand together, share it."""
    new = np.append(True, (block.ids[1:] != block.ids[:-1]) | (block.known[1:] != block.known[:-1]))
    return np.cumsum(new)[: len(block.ids)]


CUT = "block long, doc binary, owner binary, begin binary, size binary, cut binary, values binary, run_begin binary, run_end binary"
CUT_NAMES = [x.split()[0] for x in CUT.split(", ")]


def cut_candidates(row, width: int) -> tuple:
    """The stretches of a block whose windows have shared anchors, and their runs; a row of CUT."""
    block = Block(row)
    values, docs, begins, ends = anchor_runs(block, width)
    owner = _owner(block)
    shared = _in_other_documents(values, owner[docs]) if len(values) else np.zeros(0, bool)
    if len(values):
        distinct, which = np.unique(values, return_inverse=True)
        shared |= read_answers(row.told)[which] | read_answers(row.told, "first")[which]
    values, docs, begins, ends = values[shared], docs[shared], begins[shared], ends[shared]
    if not len(docs):
        return (row.block, *[b""] * 8)
    new = np.append(True, (docs[1:] != docs[:-1]) | (begins[1:] != ends[:-1]))
    first = np.flatnonzero(new)
    begin, end = begins[first], ends[np.append(first[1:], len(docs)) - 1] + width - 1
    doc = docs[first]
    cut = b"".join([block.body[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
    size = end - begin
    local = begin - (block.ends - block.sizes)[doc]
    shift = (np.cumsum(size) - size - begin)[np.cumsum(new) - 1]
    return (
        row.block, doc.astype(np.int32).tobytes(), owner[doc].astype(np.int32).tobytes(), local.tobytes(), size.tobytes(),
        cut, values.tobytes(), (begins + shift).tobytes(), (ends + shift).tobytes(),
    )


def resolve(keys: np.ndarray, owner: np.ndarray, told, me: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's keys, in the order of its documents: the block of each one's first holder, if that is an
    earlier document (else -1), and whether this very one is the first and other documents have it, too."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, dtype=bool)
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    source = read_sources(told)[which]
    mine = owner[first[which]]
    source = np.where((source < 0) & (mine < owner), me, source)
    again = np.zeros(len(first), dtype=bool)
    again[which[owner != mine]] = True
    is_first = (source < 0) & (first[which] == np.arange(len(which))) & (read_answers(told, "first")[which] | again[which])
    return source, is_first


class Cut:
    """A row of the candidates table."""

    def __init__(self, row, width: int):
        self.block = row.block
        self.width = width
        self.doc = np.frombuffer(row.doc, np.int32)
        self.owner = np.frombuffer(row.owner, np.int32)
        self.begin = np.frombuffer(row.begin, np.int64)
        self.size = np.frombuffer(row.size, np.int64)
        self.body = bytes(row.cut)
        self.bytes = np.frombuffer(self.body, np.uint8)
        self.ends = np.cumsum(self.size)
        self.values = np.frombuffer(row.values, np.uint64)
        self.run_begin = np.frombuffer(row.run_begin, np.int64)
        self.run_end = np.frombuffer(row.run_end, np.int64)
        self.stretch = np.searchsorted(self.ends, self.run_begin, side="right")
        self.run_owner = self.owner[self.stretch]

    def run_keys(self) -> np.ndarray:
        """The hash of each run's bytes, together with its anchor."""
        return mixed(self.values + byte_strings(self.bytes, self.run_begin, self.run_end + self.width - 1))

    def open_runs(self, told) -> np.ndarray:
        """The runs that no earlier document has as a whole."""
        return np.flatnonzero(resolve(self.run_keys(), self.run_owner, told, self.block)[0] < 0)

    def mixed_runs(self, told, told_open) -> np.ndarray:
        """Of these, the runs whose anchor another document's open run has, too."""
        runs = self.open_runs(told)
        values = self.values[runs]
        shared = _in_other_documents(values, self.run_owner[runs])
        if len(values):
            _, which = np.unique(values, return_inverse=True)
            shared |= read_answers(told_open)[which] | read_answers(told_open, "first")[which]
        return runs[shared]

    def windows_of(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the windows of some runs, and their owners."""
        n = self.run_end[runs] - self.run_begin[runs]
        at = np.arange(int(n.sum())) + np.repeat(self.run_begin[runs] - (np.cumsum(n) - n), n)
        return at, np.repeat(self.run_owner[runs], n)

    def window_keys(self, at: np.ndarray) -> np.ndarray:
        return byte_strings(self.bytes, at, at + self.width)


def route(row, width: int) -> tuple[list[tuple], bytes, int]:
    """Pieces (source block, block, bytes, documents, begins) of a block; its sources, their lengths in front, and how many."""
    cut = Cut(row, width)
    run_source, run_first = resolve(cut.run_keys(), cut.run_owner, row.told, row.block)
    # By position of the cut bytes: the source block of the window there, and whether it is a source itself.
    source = np.full(len(cut.body), -1, np.int64)
    wanted = np.zeros(len(cut.body), dtype=bool)
    n = cut.run_end - cut.run_begin
    at, _ = cut.windows_of(np.arange(len(n)))
    source[at] = np.repeat(run_source, n)
    wanted[at] = np.repeat(run_first, n)
    at, owner = cut.windows_of(cut.mixed_runs(row.told, row.told_open))
    window_source, window_first = resolve(cut.window_keys(at), owner, row.told_windows, row.block)
    hit = window_source >= 0
    source[at[hit]] = window_source[hit]
    wanted[at] |= window_first
    edge = np.zeros(len(cut.body) + 1, dtype=bool)
    edge[cut.ends - cut.size] = edge[0] = True
    new = np.flatnonzero(edge[:-1] | np.append(True, wanted[1:] != wanted[:-1]))
    sources = [
        cut.body[a : b + width - 1] for a, b in zip(new, np.append(new[1:], len(wanted)), strict=True) if wanted[a]
    ]
    new = np.flatnonzero(edge[:-1] | np.append(True, source[1:] != source[:-1]))
    stretch = np.searchsorted(cut.ends, new, side="right")
    pieces: dict[tuple[int, bytes], tuple[list[int], list[int]]] = {}
    for a, b, k in zip(new.tolist(), [*new[1:].tolist(), len(source)], stretch, strict=True):
        if source[a] >= 0:
            docs, begins = pieces.setdefault((int(source[a]), cut.body[a : b + width - 1]), ([], []))
            docs.append(int(cut.doc[k]))
            begins.append(int(cut.begin[k] + a - (cut.ends[k] - cut.size[k])))
    rows = [
        (s, row.block, text, np.array(docs, np.int32).tobytes(), np.array(begins, np.int64).tobytes())
        for (s, text), (docs, begins) in pieces.items()
    ]
    lengths = np.array([len(s) for s in sources], np.int64)
    return rows, lengths.tobytes() + b"".join(sources), len(sources)


def index_of(sources: bytes, n: int, width: int) -> RunIndex:
    """The index of n source stretches, parted by separators."""
    lengths = np.frombuffer(sources[: 8 * n], np.int64)
    body = sources[8 * n :]
    ends = np.cumsum(lengths)
    parts = []
    for a, b in zip(ends - lengths, ends, strict=True):
        parts += [np.frombuffer(body[a:b], np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64)]
    most = 1 << (width - 1).bit_length()
    return RunIndex(np.concatenate(parts), most)


def matched(index: RunIndex, texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of positions of texts from which width bytes are in the index: the text, first and end position."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    body = np.frombuffer(b"".join(texts), np.uint8)
    # Parts of a text overlap, so that every window lies in one of them.
    n = np.maximum(1, -(-(sizes - width + 1) // PART))
    of = np.repeat(np.arange(len(texts)), n)
    begin = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * PART
    hit = index.long_matches(body, starts[of] + begin, np.minimum(PART + width - 1, sizes[of] - begin), width)
    # No window begins in a text's last bytes, so runs end within their texts.
    a, b = intervals(hit)
    of = np.searchsorted(starts, a, side="right") - 1
    return of, a - starts[of], b - starts[of]


def spread_spans(pieces: pd.DataFrame, of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple]:
    """(block, documents, begins, ends) of spans of pieces, at all the places a piece has in its block."""
    if not len(of):
        return []
    counts = np.array([len(x) // 4 for x in pieces["docs"]], np.int64)
    docs = np.frombuffer(b"".join(pieces["docs"]), np.int32)
    places = np.frombuffer(b"".join(pieces["begins"]), np.int64)
    blocks = pieces["block"].to_numpy()[of]
    order = np.argsort(blocks, kind="stable")
    of, begin, end, blocks = of[order], begin[order], end[order], blocks[order]
    n = counts[of]
    at = np.arange(int(n.sum())) + np.repeat((np.cumsum(counts) - counts)[of] - (np.cumsum(n) - n), n)
    doc, begin, end, blocks = docs[at], places[at] + np.repeat(begin, n), places[at] + np.repeat(end, n), np.repeat(blocks, n)
    cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
    return [
        (int(blocks[x]), doc[x:y].tobytes(), begin[x:y].tobytes(), end[x:y].tobytes())
        for x, y in zip(cuts, np.append(cuts[1:], len(blocks)), strict=True)
    ]


def whole_characters(body: np.ndarray, lost: np.ndarray) -> str:
    """The characters none of whose bytes is lost."""
    character = np.cumsum((body & 0xC0) != 0x80)
    hurt = np.zeros(int(character[-1]) + 1, dtype=bool)
    hurt[character[lost]] = True
    return body[~hurt[character]].tobytes().decode()


def dedup_bytes(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Id, n_bytes, n_removed, n_spans, kept_sha256 (with_text: and spans, kept_text, text_hash) of every row.

    Strings are judged on the input, as UTF-8, and never cross documents. spans are
    the maximal removed runs of bytes, from and to (exclusive); kept_sha256 is of all
    other bytes, joined; kept_text is these without characters that were cut into, or
    null where nothing is removed; text_hash is Spark's xxhash64 of the text. A null
    text is empty; a null id is smaller than any other; rows of one id are one
    document as far as order goes, so none of them is removed for another. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup")
    text = text_or_empty(text_col)
    named = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.sha2(text, 256).alias("sha"))
    order = F.struct(F.col("id").isNotNull().alias("known"), "id")
    heads = named.groupBy("sha").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = scratch.write(heads.select("sha", F.col("head.id").alias("head"), F.lit(True).alias("grouped")))
    # Of each text, the document with the smallest id; all other documents of that text are copies.
    is_copy = F.col("grouped").isNotNull() & ~F.col("id").eqNullSafe(F.col("head"))
    light = named.select("id", "sha", F.octet_length("text").cast("long").alias("n"), F.xxhash64("text").alias("h"))
    copies = scratch.write(light.join(heads, "sha").where(is_copy))
    scratch.drop(heads)
    blocks, total = ordered_blocks(named, scratch, "id", "text", without=copies)

    def anchors(row) -> np.ndarray:
        return anchor_runs(Block(row), width)[0]

    told = seen_earlier(blocks, anchors, bucket_bits(total // 13), scratch, sources=True)

    @frugal_batches
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame([cut_candidates(row, width)], columns=CUT_NAMES)

    whole = with_answers(blocks, told.drop("source"))
    cuts = scratch.write(whole.mapInPandas(cut, CUT).where("length(doc) > 0"), row_group_mb=32)
    scratch.drop(told)
    n_cut = cuts.agg(F.sum(F.length("cut"))).first()[0] or 0
    told = seen_earlier(cuts, lambda row: Cut(row, width).run_keys(), bucket_bits(n_cut // 13), scratch, sources=True)
    cuts = with_answers(cuts, told)

    def open_anchors(row) -> np.ndarray:
        own = Cut(row, width)
        return own.values[own.open_runs(row.told)]

    told = seen_earlier(cuts, open_anchors, bucket_bits(n_cut // 26), scratch, sources=True).drop("source")
    cuts = with_answers(cuts, told, "told_open")

    def open_windows(row) -> np.ndarray:
        own = Cut(row, width)
        return own.window_keys(own.windows_of(own.mixed_runs(row.told, row.told_open))[0])

    told = seen_earlier(cuts, open_windows, bucket_bits(n_cut // 4), scratch, sources=True)
    cuts = with_answers(cuts, told, "told_windows")

    @frugal_batches
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["source", "block", "text", "docs", "begins", "n_sources"]
        for batch in batches:
            for row in batch.itertuples(index=False):
                pieces, sources, n = route(row, width)
                out = [(*p, 0) for p in pieces]
                if n:
                    out.append((row.block, row.block, sources, b"", b"", n))
                yield pd.DataFrame(out, columns=names)

    shape = "source long, block long, text binary, docs binary, begins binary, n_sources int"
    dealt = scratch.write(cuts.mapInPandas(deal, shape))
    scratch.keep_only(blocks, copies, dealt)
    pieces = dealt.where("n_sources = 0")
    load = pieces.groupBy("source").agg(F.sum(F.length("text") + 64).alias("load"))
    salts = scratch.write(load.select("source", F.ceil(F.col("load") / SALT_BYTES).cast("int").alias("salts")))
    salted = pieces.join(salts, "source").withColumn("salt", F.pmod(F.xxhash64("block"), F.col("salts")).cast("int"))
    sources = scratch.reread(dealt).where("n_sources > 0").join(scratch.reread(salts), "source")
    sources = sources.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)"))).select("source", "salt", "text", "n_sources")

    @frugal
    def stream(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            index = index_of(bytes(right["text"].iat[0]), int(right["n_sources"].iat[0]), width)
            of, begin, end = matched(index, left["text"].tolist(), width)
            out = spread_spans(left, of, begin, end + width - 1)
        return pd.DataFrame(out, columns=["block", "doc", "begin", "end"])

    told = (
        salted.select("source", "salt", "block", "text", "docs", "begins")
        .groupBy("source", "salt")
        .cogroup(sources.groupBy("source", "salt"))
        .applyInPandas(stream, "block long, doc binary, begin binary, end binary")
    )
    told = scratch.write(told)
    scratch.keep_only(blocks, copies, told)
    each = told.groupBy("block").agg(F.collect_list(F.struct("doc", "begin", "end")).alias("told"))

    @frugal_batches
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row)
                change = np.zeros(len(block.body) + 1, np.int32)
                starts = block.ends - block.sizes
                for x in row.told if row.told is not None else ():
                    at = starts[np.frombuffer(x["doc"], np.int32)]
                    np.add.at(change, at + np.frombuffer(x["begin"], np.int64), 1)
                    np.add.at(change, at + np.frombuffer(x["end"], np.int64), -1)
                gone = np.cumsum(change)[:-1] > 0
                body = np.frombuffer(block.body, np.uint8)
                out = []
                for i, (a, b) in enumerate(zip(starts, block.ends, strict=True)):
                    lost = gone[a:b]
                    x, y = intervals(lost)
                    left = (body[a:b][~lost] if len(x) else body[a:b]).tobytes()
                    line = (block.id_of(i), int(b - a), int(lost.sum()), len(x), hashlib.sha256(left).hexdigest())
                    if with_text:
                        spans = [{"begin": int(p), "end": int(q)} for p, q in zip(x, y, strict=True)]
                        line = (*line, spans, whole_characters(body[a:b], lost) if len(x) else None, int(block.hashes[i]))
                    out.append(line)
                names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["spans", "kept_text", "text_hash"] * with_text]
                yield pd.DataFrame(out, columns=names).astype({"id": "Int64"})

    shape = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    more = ", spans array<struct<begin: long, end: long>>, kept_text string, text_hash long"
    out = blocks.join(each.hint("merge"), "block", "left").mapInPandas(remove, shape + more * with_text)
    copies = copies.withColumn("lost", F.col("n") >= width)
    copied = [
        F.col("id"),
        F.col("n").alias("n_bytes"),
        F.when(F.col("lost"), F.col("n")).otherwise(0).cast("long").alias("n_removed"),
        F.col("lost").cast("long").alias("n_spans"),
        F.when(F.col("lost"), F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    ]
    span = F.struct(F.lit(0).cast("long").alias("begin"), F.col("n").alias("end"))
    extra = [
        F.when(F.col("lost"), F.array(span)).otherwise(F.array().cast("array<struct<begin: long, end: long>>")).alias("spans"),
        F.when(F.col("lost"), F.lit("")).alias("kept_text"),
        F.col("h").alias("text_hash"),
    ]
    return out.unionByName(copies.select(*copied, *(extra if with_text else []))).withColumnRenamed("id", id_col)


def op5_suffix_dedup(spark, sf_dir):
    return dedup_bytes(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), keyed AS MATERIALIZED (
  SELECT doc_id, unnest(range(0, n - 49)) AS s,
         unnest(list_transform(range(0, n - 49), lambda i: md5_number(substr(x, 2 * i + 1, 100)))) AS k
  FROM docs WHERE n >= 50
), first AS (
  SELECT k, min(doc_id) AS first_id FROM keyed GROUP BY k HAVING min(doc_id) < max(doc_id)
), win AS (
  SELECT w.doc_id, s, w.doc_id > first_id AS again FROM keyed w JOIN first f ON f.k = w.k
), marks AS (
  SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM win WHERE again
), runs AS (
  SELECT doc_id, s, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM marks
), spans AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM runs GROUP BY doc_id, run
), parts AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), told AS (
  SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS kept
  FROM parts p JOIN docs d ON d.doc_id = p.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM docs d LEFT JOIN told t ON t.doc_id = d.doc_id
"""
