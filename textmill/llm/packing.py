"""Best-fit packing of documents into sequences of several permitted lengths.

A document is a run of tokens. What exceeds the largest permitted length is cut
into full sequences; the rest are items, taken by falling length. An item goes to
the open bin that it leaves the least room in. If it fits none, a bin is opened,
of the size that costs least for each token it is expected to hold: a bin of size
s costs ``fixed + s + quadratic * s * s``. After all items are placed, every bin
is downsized to the least permitted length that holds its contents, so sizes are
chosen jointly: large bins are opened to be filled, and shrink if they aren't.

Packing is per shard. Shards are dealt by a hash of the id and the content, and
hold ``shard_items`` documents or ``shard_bytes`` on average, whatever the corpus.
What a sequence holds comes with it: each piece carries its part of the text or of
the token ids, and a document's pieces, in order, give it back.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BLANKS, frugal, table, text_or_empty


@dataclass(frozen=True)
class Cost:
    """Cost of a sequence of n tokens, in tokens' worth of linear work."""

    fixed: float = 16.0
    quadratic: float = 1 / 16384

    def of(self, n: int) -> float:
        return self.fixed + n + self.quadratic * n * n


def pack(lengths: Sequence[int], sizes: Sequence[int], cost: Cost) -> tuple[list[int], list[int], list[int]]:
    """For items of falling length: each one's bin and place in it; and the bins' sizes.

    No item is longer than the largest size; items of length 0 take part like any.
    """
    sizes = sorted(sizes)
    largest = sizes[-1]
    # The open bins by the room left in them, and a bit for each room that is there.
    by_room: dict[int, list[int]] = {}
    rooms = 0
    used: list[int] = []
    bins, places = [], []
    mean = [0.0, 0]
    for n in lengths:
        mean[0] += n
        mean[1] += 1
    filler = mean[0] / mean[1] if mean[1] else 0.0

    def opened(n: int) -> int:
        # A bin is expected to end short of full by half an average item at most.
        def each(s: int) -> float:
            spare = s - n
            full = s if spare == 0 else n + max(0.0, spare - min(filler, spare) / 2)
            return cost.of(s) / max(1.0, full)

        return min((s for s in sizes if s >= n), key=lambda s: (each(s), s))

    for n in lengths:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, b = opened(n), len(used)
            used.append(0)
        bins.append(b)
        places.append(used[b])
        used[b] += n
        left = room - n  # a full bin still takes items of no tokens
        stack = by_room.setdefault(left, [])
        if not stack:
            rooms |= 1 << left
        stack.append(b)
    return bins, places, [next(s for s in sizes if s >= u) if u <= largest else largest for u in used]


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_count(text_col: str = "text"):
    """Words of a text, and one more token for its end."""
    words = F.array_remove(F.split(text_or_empty(text_col), BLANKS), "")
    return F.size(words) + 1


def text_parts(text: str, begins: list[int]) -> list[str]:
    """The parts of a text that begin at some of its words, the first one with all before its word; together the text.

    The end token is a word past the last; what begins there is empty.
    """
    if len(begins) == 1:
        return [text]
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    cuts = [0, *(starts[b] for b in begins[1:]), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def pack_documents(
    docs: DataFrame,
    sizes: Sequence[int] = (1024, 2048, 4096, 8192),
    cost: Cost = Cost(),
    ids: str | None = None,
    length=None,
    shard_items: int = 20_000,
    shard_bytes: int = 16 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of a document: its id, piece, begin and tokens in it, bin, bin_size, place and content.

    begin counts the document's tokens before the piece, place the bin's. A bin is
    named by its shard and number. Pieces of a document cover it without gap or
    overlap. Tokens are the words of text_col and an end token, so a null or empty
    text is one token long, and a piece's content is its part of the text (column
    text); or, with ids, the elements of that column of int arrays (column ids), a
    null or empty one giving one piece of no tokens. With length, a column of token
    counts (null or below zero: 0), numbers only are packed and text is null. Null ids and repeated rows are
    packed like any other, each row on its own; an empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    sizes = sorted({int(s) for s in sizes})
    if not sizes or sizes[0] < 1:
        raise ValueError("sizes are positive")
    largest = sizes[-1]
    bare = length is not None
    if bare:
        content, n = F.lit(None).cast("string"), F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long")
        weight = F.lit(0)
    elif ids is None:
        content, n = text_or_empty(text_col), word_count(text_col).cast("long")
        weight = F.octet_length(content)
    else:
        content = F.coalesce(F.col(ids), F.array().cast("array<int>"))
        n = F.size(content).cast("long")
        weight = n * 4
    total = docs.agg(F.count(F.lit(1)), F.sum(weight)).first()
    shards = max(1, -(-total[0] // shard_items), -(-(total[1] or 0) // shard_bytes))
    items = docs.select(F.col(id_col).alias("id"), n.alias("n"), content.alias("content"))
    # Rows of one id (or of none) are told apart by their content, and may share a shard.
    items = items.withColumn("h", F.xxhash64("content", "n"))
    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "h"), F.lit(shards)).cast("int"))

    @frugal
    def run(group):
        shard = group.column("shard")[0].as_py()
        # In the order of id (nulls first), length and hash, so a shard packs the same whatever order its rows come in.
        order = pc.sort_indices(group, [("id", "ascending"), ("n", "ascending"), ("h", "ascending")], null_placement="at_start")
        group = group.take(order).combine_chunks()
        items = []  # row, piece, begin, tokens
        full_bins: list[tuple] = []
        for row, n in enumerate(group.column("n").to_pylist()):
            full = n // largest
            full_bins += [(row, piece, piece * largest, largest) for piece in range(full)]
            if n % largest or not full:
                items.append((row, full, full * largest, n % largest))
        items.sort(key=lambda x: (-x[3], x[0]))
        of, place, got = pack([x[3] for x in items], sizes, cost)
        rows = [(*x, b, got[b], p) for x, b, p in zip(items, of, place, strict=True)]
        rows += [(*x, len(got) + k, largest, 0) for k, x in enumerate(full_bins)]
        rows.sort()
        row, piece, begin, tokens, number, bin_size, place = (np.array(c, np.int64) for c in zip(*rows))
        if bare:
            parts = pa.nulls(len(row), pa.string())
        elif ids is None:
            begins: dict[int, list[int]] = {}
            for r, b in zip(row.tolist(), begin.tolist()):
                begins.setdefault(r, []).append(b)
            whole = group.column("content")
            parts = pa.array([x for r, b in begins.items() for x in text_parts(whole[r].as_py(), b)], pa.string())
        else:
            lists = group.column("content").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            starts = lists.offsets.to_numpy()[row] + begin
            # One copy, without a table of all tokens' places.
            slices = [lists.values.slice(x, k) for x, k in zip(starts.tolist(), tokens.tolist())]
            offsets = pa.array(np.append(0, np.cumsum(tokens)), pa.int32())
            parts = pa.ListArray.from_arrays(offsets, pa.concat_arrays(slices))
        return pa.table(
            {
                "id": group.column("id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "begin": pa.array(begin, pa.int64()),
                "tokens": pa.array(tokens, pa.int32()),
                "shard": pa.array(np.full(len(row), shard), pa.int32()),
                "number": pa.array(number, pa.int32()),
                "bin_size": pa.array(bin_size, pa.int32()),
                "place": pa.array(place, pa.int32()),
                "content": parts,
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    held = "string" if ids is None else "array<int>"
    shape = f"id {kind}, piece int, begin long, tokens int, shard int, number int, bin_size int, place int, content {held}"
    packed = items.repartition(shards, "shard").groupBy("shard").applyInArrow(run, shape)
    return packed.select(
        F.col("id").alias(id_col), "piece", "begin", "tokens",
        F.concat_ws("-", "shard", "number").alias("bin"), "bin_size", "place", F.col("content").alias("text" if ids is None else "ids"),
    )


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per bin of pieces with ids: bin, bin_size, ids (all of its tokens in order) and documents (id, begin and tokens of each piece)."""
    piece = F.struct("place", "piece", "begin", "tokens", F.col(id_col).alias("id"), "ids")
    rows = packed.groupBy("bin").agg(F.max("bin_size").alias("bin_size"), F.array_sort(F.collect_list(piece)).alias("p"))
    documents = F.transform("p", lambda x: F.struct(x["id"].alias(id_col), x["begin"], x["tokens"]))
    return rows.select("bin", "bin_size", F.flatten(F.col("p.ids")).alias("ids"), documents.alias("documents"))


def bins_of(packed: DataFrame) -> DataFrame:
    """One row per bin: bin, bin_size, tokens in it, pieces."""
    return packed.groupBy("bin").agg(
        F.max("bin_size").alias("bin_size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("pieces")
    )


def op1_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
