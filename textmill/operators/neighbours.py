"""Nearest neighbours by cosine through an inverted-file index.

Building: k-means centroids of a bounded sample cut the unit sphere into cells; every
row is stored under its nearest centroid's list, a partition of a Parquet table, and
each list's size and radius are kept beside the centroid. Searching: a query reads the
lists of its nearest centroids only, so that other lists are pruned from the scan; a
list's rows and queries meet in packed blocks, of which a task multiplies one pair at
a time. search_exact goes on to all lists that the triangle inequality can't rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.sources.store import written

ROWS_A_BLOCK = 8192
QUERIES_A_BLOCK = 512
#: A worker has so many distances or cosines at a time, and hands so many rows with a vector over at once.
CELLS = 1 << 20
ROWS_AT_ONCE = 1 << 13
#: At most so many lists; their centroids are held by every task.
MOST_LISTS = 1 << 14
_BLOCK = "list int, block int, ids binary, vectors binary"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) without null ids and vectors, components that are null or not finite, and vectors of length 0."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda v: v != 0))


def _units(column: pd.Series) -> np.ndarray:
    x = np.stack(column.to_numpy())
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (centroids**2).sum(1)[None] - 2 * x @ centroids.T, 0))


def _slices(rows: int, cells_a_row: int) -> Iterator[slice]:
    """Slices of rows, of CELLS cells together or one row."""
    step = max(1, CELLS // max(1, cells_a_row))
    return (slice(at, at + step) for at in range(0, rows, step))


@dataclass
class VectorIndex:
    """An index at a path: lists/ (list, id, vector) by list, and centroids/ (list, centroid, radius, n)."""

    spark: SparkSession
    path: str
    names: np.ndarray
    centroids: np.ndarray
    radius: np.ndarray
    sizes: np.ndarray

    @classmethod
    def build(
        cls, vectors: DataFrame, path: str, lists: int | None = None, sample_per_list: int = 64, seed: int = 42,
        id_col: str = "vec_id", vector_col: str = "embedding",
    ) -> VectorIndex:
        """Index every usable row; lists defaults to the square root of their number. Centroids are fitted on sample_per_list rows a list, by a hash of the id."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        rows = usable(vectors, id_col, vector_col)
        n = rows.count()
        lists = max(1, min(lists or round(n**0.5), n, MOST_LISTS))
        share = min(1.0, 2 * lists * sample_per_list / max(n, 1))
        drawn = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
        sample = rows.where(drawn).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(lists * sample_per_list)
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
        sample = written(sample.select(array_to_vector(F.transform("vector", lambda v: v / norm)).alias("features")))
        if n:
            model = KMeans(k=lists, seed=seed, maxIter=10).fit(sample)
            centroids = np.array(model.clusterCenters())
        else:
            centroids = np.zeros((1, 1))

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for cut in _slices(len(batch), len(centroids)):
                    part = batch.iloc[cut]
                    d = _distances(_units(part["vector"]), centroids)
                    yield part.assign(list=d.argmin(1), distance=d.min(1))

        dealt = rows.mapInPandas(assign, "id long, vector array<double>, list int, distance double")
        # Balanced by size: a list with a third of all rows is written by many tasks.
        dealt.hint("rebalance", "list").write.partitionBy("list").parquet(f"{path}/lists")
        stored = cls.spark_lists(vectors.sparkSession, path)
        found = {r["list"]: r for r in stored.groupBy("list").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}  # a row a list
        kept = [(k, centroids[k].tolist(), found[k]["radius"], found[k]["n"]) for k in range(len(centroids)) if k in found]
        vectors.sparkSession.createDataFrame(kept, "list int, centroid array<double>, radius double, n long").coalesce(1).write.parquet(f"{path}/centroids")
        return cls.open(vectors.sparkSession, path)

    @staticmethod
    def spark_lists(spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema("id long, vector array<double>, distance double, list int").parquet(f"{path}/lists")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        rows = sorted(spark.read.parquet(f"{path}/centroids").collect())
        centroids = np.array([r["centroid"] for r in rows]).reshape(len(rows), len(rows[0]["centroid"]) if rows else 0)
        return cls(spark, path, np.array([r["list"] for r in rows], np.int64), centroids, *(np.array([r[c] for r in rows]) for c in ("radius", "n")))

    def rows(self, lists: list[int] | None = None) -> DataFrame:
        """The stored rows, of some lists only where they are named: the others' files aren't read."""
        rows = self.spark_lists(self.spark, self.path)
        return rows if lists is None else rows.where(F.col("list").isin([int(x) for x in lists]))

    def _packed(self, rows: DataFrame, blocks: DataFrame | int) -> DataFrame:
        """Blocks (list, block, ids, vectors) of rows (list, id, vector), dealt by a hash of the id."""
        if isinstance(blocks, int):
            rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        else:
            rows = rows.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))  # a row a list

        def pack(group: pd.DataFrame) -> pd.DataFrame:
            head = group[["list", "block"]].iloc[:1].reset_index(drop=True)
            return head.assign(ids=[group["id"].to_numpy(np.int64).tobytes()], vectors=[_units(group["vector"]).tobytes()])

        return rows.select("list", "block", "id", "vector").groupBy("list", "block").applyInPandas(pack, _BLOCK)

    def _probed(self, probes: DataFrame, k: int, n_queries: int) -> DataFrame:
        """(query, id, cosine): of each probed list the k nearest of every query that probes it; probes has (list, id, vector)."""
        probes = written(probes)
        wanted = [r["list"] for r in probes.select("list").distinct().collect()]  # MOST_LISTS at most
        sizes = [(int(name), int(-(-n // ROWS_A_BLOCK))) for name, n in zip(self.names, self.sizes, strict=True)]
        blocks = self.spark.createDataFrame(sizes, "list int, blocks int")
        left = self._packed(self.rows(wanted if len(wanted) < len(self.names) else None), blocks)
        right = self._packed(probes, max(1, -(-n_queries // QUERIES_A_BLOCK)))
        right = right.select("list", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))

        def best(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            cosine = q @ x.T
            cosine[queries[:, None] == ids[None]] = -np.inf
            if len(ids) > k:
                cosine[cosine < np.partition(cosine, -k, axis=1)[:, -k, None]] = -np.inf
            at, which = np.nonzero(cosine > -np.inf)
            return pa.RecordBatch.from_arrays([pa.array(queries[at]), pa.array(ids[which]), pa.array(cosine[at, which])], names=["query", "id", "cosine"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:  # blocks are looked at where Arrow has them
                for row in zip(*batch.columns, strict=True):
                    ids, x, queries, q = (np.frombuffer(v.as_buffer(), t) for v, t in zip(row, (np.int64, float, np.int64, float), strict=True))
                    x, q = x.reshape(len(ids), -1), q.reshape(len(queries), -1)
                    for cut in _slices(len(queries), len(ids)):
                        yield best(ids, x, queries[cut], q[cut])

        pairs = left.select("list", "ids", "vectors").join(right.hint("merge"), "list")
        return pairs.select("ids", "vectors", "q_ids", "q_vectors").mapInArrow(run, "query long, id long, cosine double")

    def _nearest_lists(self, queries: DataFrame, choose) -> DataFrame:
        """(list, id, vector, and further columns): a row for each list that choose(distances, batch) marks for a query."""
        centroids, names = self.centroids, self.names

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for cut in _slices(len(batch), len(centroids)):
                    part = batch.iloc[cut]
                    at, which = np.nonzero(choose(_distances(_units(part["vector"]), centroids), part))
                    for k in range(0, len(at), ROWS_AT_ONCE):
                        here = slice(k, k + ROWS_AT_ONCE)
                        yield part[["id", "vector"]].iloc[at[here]].assign(list=names[which[here]])[["list", "id", "vector"]]

        return queries.mapInPandas(run, "list int, id long, vector array<double>")

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """(query, rank, id, cosine): for each query the k nearest rows of its nearest lists (default: a third of all), never itself.

        Ties go by the smaller id. Queries that aren't usable have no rows; ids are
        unique in the index and among the queries.
        """
        asked = written(usable(queries, id_col, vector_col))
        return _first(self._first_pass(asked, k, probes), k)

    def _probes(self, probes: int | None) -> int:
        return min(probes or -(-len(self.names) // 3), len(self.names))

    def _first_pass(self, asked: DataFrame, k: int, probes: int | None) -> DataFrame:
        if not len(self.names):
            return self.spark.createDataFrame([], "query long, id long, cosine double")
        n = self._probes(probes)

        def nearest(distances: np.ndarray, batch: pd.DataFrame) -> np.ndarray:
            return distances <= np.partition(distances, n - 1, axis=1)[:, n - 1, None]

        return self._probed(self._nearest_lists(asked, nearest), k, asked.count())

    def search_exact(self, queries: DataFrame, k: int = 10, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """As search, but the true k nearest rows: lists are read until no other can hold a nearer one."""
        asked = written(usable(queries, id_col, vector_col))
        found = written(self._first_pass(asked, k, probes))
        if not len(self.names):
            return _first(found, k)
        n = self._probes(probes)
        kth = _first(found, k).where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("cosine").alias("kth"))
        open_ = asked.join(kth.hint("merge"), "id", "left")
        radius = self.radius

        def within(distances: np.ndarray, batch: pd.DataFrame) -> np.ndarray:
            reach = np.sqrt(np.maximum(2 - 2 * batch["kth"].fillna(-1).to_numpy(), 0)) + 1e-6
            known = distances <= np.partition(distances, n - 1, axis=1)[:, n - 1, None]
            return ~known & (distances - radius[None] <= reach[:, None])

        more = self._probed(self._nearest_lists(open_, within), k, asked.count())
        return _first(found.unionByName(more), k)


    def probes_for(self, share: float = 0.95, k: int = 10, sample: int = 200, seed: int = 42) -> int:
        """How many lists hold a share of the true k nearest rows, as sample stored rows have it (picked by a hash of the id)."""
        drawn = self.rows().orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("id", "vector")
        asked = written(drawn)
        true = self.search_exact(asked, k, id_col="id", vector_col="vector").select(F.col("query"), F.col("id"))
        where = true.join(self.rows().select("id", "list").hint("merge"), "id").select(F.col("query").alias("id"), "list")
        pairs = where.join(asked.hint("merge"), "id")
        centroids, place = self.centroids, {int(x): i for i, x in enumerate(self.names)}

        def ranks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    d = _distances(_units(batch["vector"]), centroids)
                    own = d[np.arange(len(d)), batch["list"].map(place).to_numpy()]
                    yield pd.DataFrame({"rank": (d <= own[:, None]).sum(1)})

        found = sorted(r["rank"] for r in pairs.mapInPandas(ranks, "rank int").collect())  # k * sample numbers
        return found[min(len(found) - 1, int(share * len(found)))] if found else 1


def _first(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("cosine"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "id", "cosine")


def recall(found: DataFrame, true: DataFrame) -> DataFrame:
    """One row: the queries, and the share of the true neighbours (query, id) that were found."""
    hits = true.select("query", "id").join(found.select("query", "id", F.lit(1).alias("hit")), ["query", "id"], "left")
    return hits.agg(F.countDistinct("query").alias("queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
