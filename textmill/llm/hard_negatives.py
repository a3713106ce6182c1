"""Hard-negative mining by bit-sliced integer products.

Vectors are turned into integers, and a block of rows is read one bit-plane of its
components at a time, the most significant first. After each plane the inner product
of an anchor and a row lies in an interval: what has been read, and at least and at
most what the planes to come could add. Rows whose interval shows that they cannot be
among the results are dropped before the next, finer plane; once the last plane is
read, intervals are single integers and the results exact.

Rows are packed into blocks, written once; anchors, a stated part of the rows, are
packed into smaller blocks and meet every block of rows. A block returns its few best
rows for each anchor, and these are ranked in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, frugal_batches, table

BLOCK_BYTES = 4 << 20
ANCHORS = 1024
#: Anchors that are compared with a block at a time.
SLICE = 64
#: Pairs are followed one by one when fewer than this part of them is left.
SPARSE = 1 / 16
BLOCK = "block long, width int, ids binary, labels binary, parts binary, values binary"


def integers(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component x, as double; null if any component is null or not finite."""
    x = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v.cast("double") * scale)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of integers; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def packed(rows: DataFrame, most: int, extra: bool = False) -> DataFrame:
    """Blocks of at most `most` rows of (id, label, q): ids, labels and components as arrays of bytes.

    With extra the column scores (an array of longs) is packed, too, as parts: its
    values, padded by the least long, as many for each row as the longest has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
            values = _matrix(batch.column("q"))
            scores = [np.array(x, np.int64) for x in batch.column("scores").to_pylist()] if extra else []
            step = max(1, min(most, BLOCK_BYTES // (8 * max(values.shape[1], 1))))
            for at in range(0, len(ids), step):
                part = values[at : at + step]
                wide = np.full((len(part), max([1, *map(len, scores[at : at + step])])), np.iinfo(np.int64).min)
                for row, x in zip(wide, scores[at : at + step], strict=False):
                    row[: len(x)] = x
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([number], pa.int64()),
                        "width": pa.array([part.shape[1]], pa.int32()),
                        "ids": [ids[at : at + step].tobytes()],
                        "labels": [labels[at : at + step].tobytes()],
                        "parts": [wide.tobytes() if extra else b""],
                        "values": [np.ascontiguousarray(part).tobytes()],
                    }
                )
                number += 1

    return rows.mapInArrow(run, BLOCK)


def _unpacked(ids: bytes, labels: bytes, values: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, label = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
    return i, label, np.frombuffer(values, np.int64).reshape(len(i), width)


class Products:
    """Intervals of the inner products of some anchors with a block of rows, narrowed plane by plane."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        width = max(anchors.shape[1], rows.shape[1])
        anchors, rows = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, rows))
        self.bits = max(int(rows.max(initial=0)).bit_length(), int(~rows.min(initial=0)).bit_length()) + 1
        weight = int(np.abs(anchors).sum(1).max(initial=0))
        if weight << self.bits >= 1 << 53:
            raise OverflowError("components are too large for exact inner products")
        self.kind = np.float32 if weight < 1 << 24 else np.float64
        self.anchors = anchors.astype(self.kind)
        self.raised = (rows + (1 << (self.bits - 1))).astype(np.uint64)
        self.more = np.maximum(anchors, 0).sum(1).astype(np.float64)
        self.less = np.minimum(anchors, 0).sum(1).astype(np.float64)
        self.start = -float(1 << (self.bits - 1)) * anchors.sum(1)

    def plane(self, k: int) -> np.ndarray:
        return ((self.raised >> np.uint64(k)) & np.uint64(1)).astype(self.kind)

    def open_after(self, k: int) -> float:
        """What the planes below k can add to a component."""
        return float((1 << k) - 1)


def _nth_largest(group: np.ndarray, value: np.ndarray, nth: int, n_groups: int) -> np.ndarray:
    """The nth largest value of each group; minus infinity for smaller groups."""
    out = np.full(n_groups, -np.inf)
    order = np.lexsort((-value, group))
    ordered = group[order]
    begins = np.flatnonzero(np.diff(ordered, prepend=-1))
    sizes = np.diff(np.append(begins, len(ordered)))
    enough = sizes >= nth
    out[ordered[begins[enough]]] = value[order[begins[enough] + nth - 1]]
    return out


def survivors(products: Products, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, nth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every target: its number, and the anchors, rows and products that may be among its nth best.

    Target t takes the products from low[:, t] to high[:, t] of allowed (anchor, row)
    pairs; a pair is dropped when its interval leaves every target's range, or lies
    below nth intervals that are sure to be in it.
    """
    n = len(allowed)
    least, most = low.min(1, initial=np.inf), high.max(1, initial=-np.inf)
    partial = np.repeat(products.start[:, None], allowed.shape[1], axis=1)
    alive, k = allowed & (least <= most)[:, None], products.bits
    # Most pairs are alive: whole planes at a time.
    while k and alive.sum() > SPARSE * alive.size:
        k -= 1
        rows = np.flatnonzero(alive.any(0))
        partial[:, rows] += float(1 << k) * (products.anchors @ products.plane(k)[rows].T)
        rest = products.open_after(k)
        under, over = partial + rest * products.less[:, None], partial + rest * products.more[:, None]
        if low.shape[1] == 1 and alive.shape[1] >= nth:
            sure = np.where(alive & (under >= low) & (over <= high), under, -np.inf)
            alive &= over >= np.partition(sure, -nth, axis=1)[:, -nth, None]
        alive &= (over >= least[:, None]) & (under <= most[:, None])
    a, r = np.nonzero(alive)
    s = partial[a, r]
    wanted = np.ones((len(a), low.shape[1]), dtype=bool)
    while True:
        rest = products.open_after(k)
        under, over = s + rest * products.less[a], s + rest * products.more[a]
        for t in range(low.shape[1]):
            wanted[:, t] &= (over >= low[a, t]) & (under <= high[a, t])
            sure = wanted[:, t] & (under >= low[a, t]) & (over <= high[a, t])
            wanted[:, t] &= over >= _nth_largest(a[sure], under[sure], nth, n)[a]
        kept = wanted.any(1)
        a, r, s, wanted = a[kept], r[kept], s[kept], wanted[kept]
        if not k:
            break
        k -= 1
        plane = products.plane(k)
        for at in range(0, len(a), 1 << 16):  # pairs at a time
            x, y = a[at : at + (1 << 16)], r[at : at + (1 << 16)]
            s[at : at + (1 << 16)] += float(1 << k) * np.einsum("ij,ij->i", products.anchors[x], plane[y]).astype(np.float64)
    for t in range(low.shape[1]):
        at = wanted[:, t]
        yield t, a[at], np.stack([r[at], s[at].astype(np.int64)], axis=1)


def best_rows(row, positive_only: bool, nth: int, range_low: int, range_high: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor ids, targets, row ids, products) of one pair of blocks: nth for each anchor and target, distinct by id and product."""
    ids, labels, values = _unpacked(row.ids, row.labels, row.values, row.width)
    whose, kind, vectors = _unpacked(row.a_ids, row.a_labels, row.a_values, row.a_width)
    parts = np.frombuffer(row.a_parts, np.int64).reshape(len(whose), -1) if not positive_only else None
    # Rows that repeat an id could fill several of the nth places and count as one in the end.
    repeats = int(np.unique(ids, return_counts=True)[1].max(initial=1))
    for at in range(0, len(whose), SLICE):
        cut = slice(at, at + SLICE)
        same = kind[cut, None] == labels[None]
        if positive_only:
            allowed = same & (whose[cut, None] != ids[None])
            low, high = np.full((len(same), 1), -np.inf), np.full((len(same), 1), np.inf)
        else:
            allowed = ~same
            p = parts[cut]
            none = p == np.iinfo(np.int64).min
            low = np.where(none, np.inf, np.ceil(range_low * p / 100))
            high = np.where(none, -np.inf, np.floor(range_high * p / 100))
        for t, a, found in survivors(Products(vectors[cut], values), allowed, low, high, nth * repeats):
            r, s = ids[found[:, 0]], found[:, 1]
            order = np.lexsort((r, -s, a))
            a, r, s = a[order], r[order], s[order]
            new = np.append(True, (a[1:] != a[:-1]) | (s[1:] != s[:-1]) | (r[1:] != r[:-1]))[: len(a)]
            a, r, s = a[new], r[new], s[new]
            begins = np.flatnonzero(np.diff(a, prepend=-1))
            rank = np.arange(len(a)) - np.repeat(begins, np.diff(np.append(begins, len(a))))
            top = rank < nth
            yield whose[cut][a[top]], np.full(top.sum(), t), r[top], s[top]


def compared(blocks: DataFrame, anchors: DataFrame, slots: int, positive_only: bool, nth: int, low: int = 0, high: int = 0) -> DataFrame:
    """(anchor_id, target, id, product): the best of every block of rows for every anchor and target."""

    @frugal_batches
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                for a, t, i, s in best_rows(row, positive_only, nth, low, high):
                    yield pd.DataFrame({"anchor_id": a, "target": t, "id": i, "product": s})

    names = [c for c in anchors.columns if c != "block"]
    everywhere = anchors.select(
        *[F.col(c).alias(f"a_{c}") for c in names], F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    )
    spread = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    pairs = spread.join(everywhere.hint("merge"), "slot").drop("slot", "block", "parts")
    return pairs.mapInPandas(run, "anchor_id long, target int, id long, product long")


def first_by(rows: DataFrame, keys: list[str], n: int, score: str, tie: str, rank: str) -> DataFrame:
    """The first n rows of each key by score, largest first, ties by the smaller id; equal rows count once."""
    order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), tie))
    return rows.distinct().withColumn(rank, order).where(F.col(rank) <= n)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    range_low: int = 80,
    range_high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of anchors and their positives.

    An anchor's positives are its best rows of the same label; its hard negatives for
    one of them are the best rows of other labels whose score lies between range_low
    and range_high percent of the positive's. Scores are inner products of
    floor(scale * component); ties go by the smaller id, and a positive without such
    negatives has no rows. Rows with a null id, label or vector or with a component
    that is null or not finite take no part; missing components of shorter vectors
    are 0. Rows that repeat an id and score count once, and of rows that repeat an
    anchor's id the one with the least label and vector is the anchor. Tables
    without rows or anchors give no rows; other columns are ignored. Components are
    so bounded that products stay exact (below 2**53), or the job fails.
    """
    scratch = Scratch(vectors.sparkSession, "hard-negatives")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), integers(vector_col, scale).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL")
    blocks = scratch.write(packed(rows.select("id", "label", "q"), 1 << 16))
    slots = max(1, blocks.count())
    least = F.min(F.struct("label", "q")).alias("least")
    anchors = scratch.write(rows.where("anchor").groupBy("id").agg(least).select("id", "least.*"))
    parts = max(1, -(-anchors.count() // ANCHORS))
    found = compared(blocks, packed(anchors.repartition(parts), ANCHORS), slots, True, positives)
    best = first_by(found.drop("target"), ["anchor_id"], positives, "product", "id", "place")
    best = scratch.write(best.select("anchor_id", "place", F.col("id").alias("positive_id"), F.col("product").alias("positive_score")))
    told = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("told"))
    armed = anchors.join(told.withColumnRenamed("anchor_id", "id").hint("merge"), "id")
    armed = armed.select("id", "label", "q", F.col("told.positive_score").alias("scores"))
    found = compared(blocks, packed(armed.repartition(parts), ANCHORS, extra=True), slots, False, negatives, range_low, range_high)
    ranked = first_by(found, ["anchor_id", "target"], negatives, "product", "id", "rank")
    ranked = ranked.select("anchor_id", (F.col("target") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("product").alias("negative_score"))
    out = ranked.join(best.hint("merge"), ["anchor_id", "place"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH live AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id AS id, r.label,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * r.q[i])) AS BIGINT) AS score
  FROM live a JOIN live r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER best AS INT) AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> n.anchor_label
  AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER best <= 5
"""
