"""Finding what occurs earlier in a corpus: ordered blocks, packed hashes, packed answers.

Documents are dealt by ranges of their id into blocks of a few MB, written once.
Every block sends the sorted distinct hashes of whatever it looks at (windows,
anchors) to buckets by the hash's leading bits: one row per block and bucket, a
packed array each. A bucket sees all holders of its hashes and answers every
block with one bit per hash: whether an earlier block holds it, too. So all of a
corpus's windows are counted at a few bytes each, equal windows of a block count
once before the shuffle, and no hash, however frequent, weighs more in a bucket
than its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, frugal, frugal_batches, text_or_empty

BLOCK_BYTES = 4 << 20
BUCKET_HASHES = 2 << 20
BLOCK = "block long, ids binary, known binary, hashes binary, sizes binary, body binary"


def ordered_blocks(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str,
    text_col: str,
    block_bytes: int = BLOCK_BYTES,
    without: DataFrame | None = None,
    split_ids: bool = False,
) -> tuple[DataFrame, int]:
    """The written blocks and the total of the documents' bytes.

    without (id, sha: SHA-256 in hex) names documents to leave out; these names are
    dealt along with the documents, so leaving some out takes no join of texts.

    A block holds whole documents in the order of (id, text), null ids first; block
    numbers rise with the ids. Rows of one id lie in one block, or, with split_ids, in
    as many as their size needs.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("body"))
    total = rows.agg(F.sum(F.length("body"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // (4 * block_bytes)) + 1)

    @frugal_batches
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        hashes: list[int] = []
        bodies: list[bytes] = []
        held = 0

        def row() -> pd.DataFrame:
            known = [i is not None for i in ids]
            return pd.DataFrame(
                {
                    "block": [number],
                    "ids": [np.array([i or 0 for i in ids], np.int64).tobytes()],
                    "known": [np.array(known, np.uint8).tobytes()],
                    "hashes": [np.array(hashes, np.int64).tobytes()],
                    "sizes": [np.array([len(b) for b in bodies], np.int64).tobytes()],
                    "body": [b"".join(bodies)],
                }
            )

        unwanted: set[tuple] = set()
        for batch in batches:
            for i, h, body, wanted in zip(batch["id"], batch["h"], batch["body"], batch["wanted"], strict=True):
                i = None if pd.isna(i) else int(i)
                if not wanted:
                    if unwanted and next(iter(unwanted))[0] != i:
                        unwanted.clear()  # names stand before the documents of their id
                    unwanted.add((i, bytes(body)))
                    continue
                if unwanted and (i, hashlib.sha256(body).digest()) in unwanted:
                    continue
                if held and held + len(body) > block_bytes and (split_ids or i != ids[-1]):
                    yield row()
                    ids, hashes, bodies, held, number = [], [], [], 0, number + 1
                ids.append(i)
                hashes.append(h)
                bodies.append(bytes(body))
                held += len(body)
        if ids:
            yield row()

    rows = rows.withColumn("wanted", F.lit(True))
    if without is not None:
        rows = rows.union(without.select(F.col("id").cast("long"), F.lit(0).cast("long"), F.unhex("sha"), F.lit(False)))
    by_id = F.col("id").asc_nulls_first()
    # Beginnings of texts are in the order of the texts; whole ones would be sampled for the ranges.
    ranges = [by_id, F.substring("body", 1, 16)] if split_ids else [by_id]
    ranged = rows.repartitionByRange(parts, *ranges).sortWithinPartitions(by_id, "wanted", "body")
    out = scratch.write(ranged.mapInPandas(pack, BLOCK), row_group_mb=32)
    return out, total


class Block:
    """A row of the blocks table."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.known = np.frombuffer(row.known, np.uint8).astype(bool)
        self.hashes = np.frombuffer(row.hashes, np.int64)  # Spark's xxhash64 of each text
        self.sizes = np.frombuffer(row.sizes, np.int64)
        self.body = bytes(row.body)
        self.ends = np.cumsum(self.sizes)

    def texts(self) -> Iterator[bytes]:
        at = 0
        for end in self.ends:
            yield self.body[at:end]
            at = end

    def id_of(self, i: int) -> int | None:
        return int(self.ids[i]) if self.known[i] else None


def pack_hashes(ordered: np.ndarray) -> bytes:
    """Sorted 64-bit values as their differences, one byte plane after another: the high ones are mostly zero."""
    steps = np.diff(ordered, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_hashes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def bucket_bits(n_hashes: int, least: int = 6) -> int:
    """Leading bits that make buckets of BUCKET_HASHES on average."""
    return max(least, (max(1, n_hashes) // BUCKET_HASHES).bit_length())


def split_by_bucket(ordered: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    if not len(ordered):
        return
    bucket = (ordered >> np.uint64(64 - bits)).astype(np.int64)
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(begins, np.append(begins[1:], len(ordered)), strict=True):
        yield int(bucket[a]), ordered[a:b]


def seen_earlier(
    blocks: DataFrame, hashes: Callable[[pd.Series], np.ndarray], bits: int, scratch: Scratch, sources: bool = False, more: bool = False
) -> DataFrame:
    """For every block: answers for its sorted distinct hashes, in bucket order.

    bits: whether an earlier block holds it; with sources also first: whether this
    block is the first of several, and source: the first block, for each bit set in
    bits. hashes(row) must give the same values whenever it is called. With more it
    gives two arrays, the second of 32 further bits of each hash, and hashes count
    as equal when all 96 bits are.
    """

    def distinct(row) -> tuple[np.ndarray, np.ndarray | None]:
        found = hashes(row)
        if not more:
            return np.unique(found), None
        ordered, first = np.unique(found[0], return_index=True)
        return ordered, found[1][first]

    @frugal_batches
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ordered, further = distinct(row)
                out, at = [], 0
                for b, part in split_by_bucket(ordered, bits):
                    out.append((b, row.block, pack_hashes(part), further[at : at + len(part)].tobytes() if more else b""))
                    at += len(part)
                yield pd.DataFrame(out, columns=["bucket", "block", "hashes", "further"])

    @frugal
    def answer(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        parts = [unpack_hashes(x) for x in group["hashes"]]
        everything = np.concatenate(parts)
        order = np.argsort(everything, kind="stable")  # equal hashes stay in the order of their blocks
        ordered = everything[order]
        later = np.zeros(len(everything), dtype=bool)
        again = ordered[1:] == ordered[:-1]
        if more:
            further = np.frombuffer(b"".join(group["further"]), np.uint32)
            if (further[order[1:]] != further[order[:-1]])[again].any():  # unlike ones lie between equal ones
                order = np.lexsort((further, everything))
                ordered = everything[order]
                again = ordered[1:] == ordered[:-1]
            again &= further[order[1:]] == further[order[:-1]]
        later[order[1:]] = again
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        out = {
            "block": group["block"].to_numpy(),
            "bucket": group["bucket"].to_numpy(),
            "n": [len(p) for p in parts],
            "bits": [np.packbits(x).tobytes() for x in np.split(later, cuts)],
        }
        if sources:
            first = np.zeros(len(everything), dtype=bool)
            first[order[:-1]] = again
            first &= ~later
            of = np.repeat(group["block"].to_numpy(), [len(p) for p in parts])[order]
            head = np.maximum.accumulate(np.where(np.append(True, ~again), np.arange(len(of)), 0))
            source = np.empty(len(of), np.int64)
            source[order] = of[head]
            out["first"] = [np.packbits(x).tobytes() for x in np.split(first, cuts)]
            out["source"] = [x[y].tobytes() for x, y in zip(np.split(source, cuts), np.split(later, cuts), strict=True)]
        return pd.DataFrame(out)

    sent = blocks.mapInPandas(send, "bucket int, block long, hashes binary, further binary")
    shape = "block long, bucket int, n int, bits binary" + ", first binary, source binary" * sources
    told = sent.groupBy("bucket").applyInPandas(answer, shape)
    out = scratch.write(told)
    return out


def with_answers(blocks: DataFrame, told: DataFrame, name: str = "told") -> DataFrame:
    """blocks with the answers to each, an array in the order of their buckets."""
    each = told.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("bucket", *[c for c in told.columns if c not in ("block", "bucket")]))).alias(name)
    )
    return blocks.join(each.hint("merge"), "block", "left")


def read_answers(told, name: str = "bits") -> np.ndarray:
    """The bits of one block, in the order of its sorted distinct hashes."""
    if told is None or not len(told):
        return np.empty(0, dtype=bool)
    return np.concatenate([np.unpackbits(np.frombuffer(x[name], np.uint8))[: x["n"]] for x in told]).astype(bool)


def read_sources(told) -> np.ndarray:
    """The first block of each hash that an earlier block holds; -1 for the others."""
    later = read_answers(told)
    out = np.full(len(later), -1, np.int64)
    if len(later):
        out[later] = np.concatenate([np.frombuffer(x["source"], np.int64) for x in told])
    return out
