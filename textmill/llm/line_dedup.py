"""Line deduplication by pairwise alignment.

Documents that overlap are found through shared runs of lines: each links a document
that has it to the first one (smallest id) that does, however many have it, so links
grow with the lines and not with the square of a line's documents. The runs are the
shortest of at least ``min_chars`` characters that begin at a line and that end at
one; together they cover every block that is long enough to be deleted, so its first
holder is always linked. A single shorter line links only where blanks at line ends
decide whether a block about it is long enough, as the other document may have none;
so an index or glossary isn't aligned with every document it has a line of. Linked documents are aligned by patience diff (lines unique to both sides
anchor the alignment, what lies between anchors is aligned again), and aligned
common blocks of at least ``min_chars`` characters are deleted from the later one,
as are runs of that size that the alignment leaves out: passages that repeat within
a document or stand in another order.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, table, text_or_empty

_NO_ID = -(2**63)
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse
_UNBASE = pow(_BASE, -1, 2**64)


def _unique(x: list[int], lo: int, hi: int) -> dict[int, int]:
    """Value to position, for values found once in x[lo:hi]."""
    out: dict[int, int] = {}
    for i in range(lo, hi):
        out[x[i]] = -1 if x[i] in out else i
    return {k: i for k, i in out.items() if i >= 0}


def _longest_rise(js: list[int]) -> list[int]:
    """Places of a longest rising subsequence."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(js)
    for i, j in enumerate(js):
        k = bisect_left(tops, j)
        if k:
            before[i] = at[k - 1]
        if k == len(tops):
            tops.append(j)
            at.append(i)
        else:
            tops[k], at[k] = j, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions (i, j) with a[i] == b[j], both rising."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        in_a, in_b = _unique(a, alo, ahi), _unique(b, blo, bhi)
        both = sorted((i, in_b[k]) for k, i in in_a.items() if k in in_b)
        if not both:
            continue
        i0, j0 = alo, blo
        for at in _longest_rise([j for _, j in both]):
            i, j = both[at]
            todo.append((i0, i, j0, j))
            i0, j0 = i, j  # the anchor itself is the next part's common head
        todo.append((i0, ahi, j0, bhi))
    return sorted(out)


def common_blocks(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of the first side that are aligned line after line."""
    blocks: list[list[int]] = []
    last = None
    for i, j in pairs:
        if last == (i - 1, j - 1):
            blocks[-1][1] = i + 1
        else:
            blocks.append([i, i + 1])
        last = (i, j)
    return [(a, b) for a, b in blocks]


class Runs:
    """Hashes of runs of line hashes; a run of one line has the line's own."""

    def __init__(self, lines: np.ndarray):
        x = lines.astype(np.int64).view(np.uint64)
        powers, back = (np.full(len(x) + 1, base, dtype=np.uint64) for base in (_BASE, _UNBASE))
        powers[0] = back[0] = 1
        powers, self.back = np.cumprod(powers), np.cumprod(back)
        self.total = np.concatenate(([np.uint64(0)], np.cumsum(x * powers[:-1], dtype=np.uint64)))

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return ((self.total[end] - self.total[begin]) * self.back[begin]).view(np.int64)


def shortest_runs(sizes: np.ndarray, doc_end: np.ndarray, doc_begin: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the shortest runs of min_chars or more that begin at a line, and of those that end at one.

    The documents lie end to end; doc_begin and doc_end are those of each line's
    document. Any run of min_chars or more is the union of the runs within it.
    """
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    at = np.arange(len(sizes))
    end = np.maximum(np.searchsorted(total, total[:-1] + min_chars, side="left"), at + 1)
    begin = np.minimum(np.searchsorted(total, total[1:] - min_chars, side="right") - 1, at)
    fore, aft = end <= doc_end, begin >= doc_begin
    return np.concatenate((at[fore], begin[aft])), np.concatenate((end[fore], at[aft] + 1))


def in_common(a: np.ndarray, sizes: np.ndarray, b: np.ndarray, min_chars: int) -> list[tuple[int, int]]:
    """Parts (begin, end) of a to delete: aligned blocks, and all runs of min_chars or more that stand anywhere in b.

    Patience finds no lines that repeat on a side without unique ones beside them,
    nor blocks in another order; the shortest runs of a, looked up in b, find these.
    """
    total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    gone = np.zeros(len(a), dtype=bool)
    for x, y in common_blocks(patience(a.tolist(), b.tolist())):
        if total[y] - total[x] >= min_chars:
            gone[x:y] = True
    begin, end = shortest_runs(sizes, np.full(len(a), len(a)), np.zeros(len(a), dtype=np.int64), min_chars)
    # Runs that are deleted already, or have a line that b lacks, need no look.
    kept, lacking = (np.concatenate(([0], np.cumsum(x))) for x in (~gone, ~np.isin(a, b)))
    open_ = (kept[end] > kept[begin]) & (lacking[end] == lacking[begin])
    begin, end = begin[open_], end[open_]
    if len(begin):
        runs, others = Runs(a), Runs(b)
        key, n = runs.hash(begin, end), end - begin
        for m in np.unique(n[n <= len(b)]):
            at = np.arange(len(b) - m + 1)
            of_m = n == m
            for x in begin[of_m][np.isin(key[of_m], others.hash(at, at + m))]:
                gone[x : x + m] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _lines() -> Column:
    return F.split("_text", "\n", -1)


def link_keys(docs: DataFrame, min_line_chars: int, min_chars: int) -> DataFrame:
    """Rows (k, h, line, links): the different hashes of each document's lines and shortest runs.

    A run's characters are counted with the blanks at line ends and without them:
    the first finds equal text, the second text that differs in these blanks. links
    says whether a later document is to be aligned for this key: for runs, and for
    lines in a run that only its blanks make long enough.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, bare, lines = (batch.column(c) for c in ("whole", "bare", "lines"))
            count = np.diff(lines.offsets.to_numpy())
            begins = np.cumsum(count) - count
            doc = np.repeat(np.arange(len(count)), count)
            line, sizes = lines.flatten().to_numpy(), bare.flatten().to_numpy()
            runs = Runs(line)
            total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            by_blanks = np.zeros(len(line) + 1, dtype=np.int64)
            docs, found = [], []
            for measure in (sizes, whole.flatten().to_numpy()):
                begin, end = shortest_runs(measure, (begins + count)[doc], begins[doc], min_chars)
                docs.append(doc[begin])
                found.append(runs.hash(begin, end))
                short = total[end] - total[begin] < min_chars
                np.add.at(by_blanks, begin[short], 1)
                np.add.at(by_blanks, end[short], -1)
            known = sizes >= min_line_chars
            links = np.repeat([False, True], [known.sum(), sum(map(len, docs))])
            links[: known.sum()] = np.cumsum(by_blanks)[:-1][known] > 0
            of, key = np.concatenate([doc[known], *docs]), np.concatenate([line[known], *found])
            order = np.lexsort((~links, key, of))
            of, key, links = of[order], key[order], links[order]
            new = np.ones(len(of), dtype=bool)
            new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1])
            of, key, links = of[new], key[new], links[new]
            k, h = (batch.column(c).to_numpy()[of] for c in ("k", "h"))
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (k, h, key)], pa.array(links)], names=["k", "h", "line", "links"])

    bare = F.transform(_lines(), lambda x: F.trim(x))
    shapes = docs.select(
        "k", "h", F.transform(_lines(), lambda x: F.length(x)).alias("whole"), F.transform(bare, lambda x: F.length(x)).alias("bare"),
        F.transform(bare, lambda x: F.xxhash64(x)).alias("lines"),
    )
    return shapes.mapInArrow(keys, "k long, h long, line long, links boolean")


def overlaps(docs: DataFrame, scratch: Scratch, min_line_chars: int, min_chars: int) -> DataFrame:
    """Pairs (d, dh, o, oh): a document and the first one that has one of its runs (or of its lines, see link_keys).

    docs has the key columns k, h and _text.
    """
    lines = scratch.write(link_keys(docs, min_line_chars, min_chars))
    shared = scratch.write(
        lines.groupBy("line")
        .agg(F.count(F.lit(1)).alias("df"), F.min(F.struct("k", "h")).alias("first"), F.max("links").alias("any"))
        .where("df > 1 and any")
        .select("line", "first")
    )
    # The first holder's own rows and the unshared lines go here.
    held = lines.where("links").join(shared.hint("merge"), "line").where("not (k = first.k and h = first.h)")
    held = held.select("k", "h", "first").distinct()
    held = scratch.write(held)
    scratch.drop(lines, shared)
    return held.select(F.col("k").alias("d"), F.col("h").alias("dh"), F.col("first.k").alias("o"), F.col("first.h").alias("oh"))


def line_dedup(
    docs: DataFrame,
    min_line_chars: int = 12,
    min_chars: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: bool = False,
) -> DataFrame:
    """docs with the text that is left (and, with counts, n_lines and n_removed, the lines deleted).

    Lines end at a line feed and are compared without blanks at their ends; short
    lines link documents as parts of runs, and take part in the alignment. Blocks are judged on the input, and a document loses the union of
    the blocks it shares with all the earlier ones it is linked to. Every row is
    returned, emptied ones with an empty text; a null text stays null. A null id is
    earlier than any other; rows that repeat id and text are one document, which
    isn't its own copy; of rows with one id and different texts those with the smaller
    text hash are earlier. An empty table gives an empty result. Other
    columns are returned as they are, whatever their names, but for the two counts.
    """
    # What is joined here grows with the input, so nothing is broadcast, however small it is.
    scratch = Scratch(docs.sparkSession, "line-dedup")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("k"),
        text_or_empty(text_col).alias("_text"),
    ).withColumn("h", F.xxhash64("_text"))
    bare = keyed.select("k", "h", "_text")
    pairs = overlaps(bare, scratch, min_line_chars, min_chars)
    lines = F.transform(_lines(), lambda x: F.trim(x))
    # Written, it is a join side of its own, and the pairs of a document that many others share lines with can be split.
    shapes = scratch.write(
        bare.select(
            "k", "h", F.transform(lines, lambda x: F.xxhash64(x)).alias("lines"), F.transform(_lines(), lambda x: F.length(x)).alias("sizes")
        ).dropDuplicates(["k", "h"])
    )
    later = shapes.select(F.col("k").alias("d"), F.col("h").alias("dh"), F.col("lines").alias("a"), "sizes")
    first = scratch.reread(shapes).select(F.col("k").alias("o"), F.col("h").alias("oh"), F.col("lines").alias("b"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, dh, a, sizes, b in zip(*(batch[c] for c in ("d", "dh", "a", "sizes", "b")), strict=True):
                out += [(d, dh, x, y) for x, y in in_common(a, sizes, b, min_chars)]
            yield pd.DataFrame(out, columns=["k", "h", "begin", "end"])

    linked = pairs.hint("merge").join(later, ["d", "dh"]).join(first.hint("merge"), ["o", "oh"]).select("d", "dh", "a", "sizes", "b")
    blocks = linked.mapInPandas(align, "k long, h long, begin int, end int")
    blocks = scratch.write(blocks.groupBy("k", "h").agg(F.collect_set(F.struct("begin", "end")).alias("blocks")))
    scratch.keep_only(blocks)
    told = keyed.join(blocks.hint("merge"), ["k", "h"], "left")
    left = F.filter(_lines(), lambda x, i: ~F.exists("blocks", lambda b: (i >= b["begin"]) & (i < b["end"])))
    told = told.withColumn("_left", F.when(F.col("blocks").isNotNull(), left))
    text = F.when(F.col("_left").isNotNull(), F.array_join("_left", "\n")).otherwise(F.col(f"row.`{text_col}`"))
    n_lines = F.size(_lines())
    more = [
        n_lines.alias("n_lines"),
        F.when(F.col("_left").isNotNull(), n_lines - F.size("_left")).otherwise(0).alias("n_removed"),
    ]
    return told.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns], *(more if counts else [])
    )


def op4_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, counts=True)
