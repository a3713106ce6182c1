"""The inverted-file index against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textmill.operators import neighbours
from textmill.operators.neighbours import VectorIndex, recall

SCHEMA = "vec_id long, embedding array<float>"


def clustered(n, dims=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    hot = rng.integers(0, 12, n) * (rng.random(n) > 0.4)  # one cell has four tenths of all rows
    return [(i, [float(np.float32(v)) for v in centres[c] + rng.normal(size=dims) / 2]) for i, c in enumerate(hot)]


def brute(rows, queries, k):
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        cosine = x @ x[q]
        order = sorted((-round(float(c), 12), i) for i, c in enumerate(cosine) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows = clustered(1500)
    odd = [(2000, None), (None, [1.0] * 16), (2001, [0.0] * 16), (2002, [math.nan] * 16), (2003, [None] * 16)]
    path = f"file://{tmp_path_factory.mktemp('index')}/i"
    table = spark.createDataFrame(rows + odd, SCHEMA).withColumn("id", F.lit(1)).withColumn("list", F.lit(2))
    return rows, table, VectorIndex.build(table, path, lists=30), path


def test_every_row_is_indexed(made):
    rows, _, index, _ = made
    assert sorted(r["id"] for r in index.rows().collect()) == [i for i, _ in rows] and index.sizes.sum() == len(rows)


def test_search_finds_most_and_exact_search_all(spark, made, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_A_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERIES_A_BLOCK", 7)
    rows, table, index, path = made
    queries = table.where("vec_id % 50 = 0")
    want = brute(rows, range(0, 1500, 50), 10)

    def told(found):
        out = {}
        for r in sorted(found.collect(), key=lambda r: (r.query, r.rank)):
            out.setdefault(r.query, []).append(r.id)
        return out

    exact = index.search_exact(queries)
    assert told(exact) == want
    assert told(VectorIndex.open(spark, path).search_exact(queries, probes=1)) == want
    assert recall(index.search(queries), exact).first()["recall"] >= 0.9
    enough = index.probes_for(0.95, sample=60)
    assert 1 <= enough <= 10 and recall(index.search(queries, probes=enough), exact).first()["recall"] >= 0.9
    few = recall(index.search(queries, probes=1), exact).first()
    assert few["queries"] == 30 and 0.2 < few["recall"] < 1


def test_unprobed_lists_are_not_read(made):
    _, table, index, _ = made
    one = index.rows([3, 5])
    assert len(one.inputFiles()) >= len({r["list"] for r in one.select("list").distinct().collect()}) == 2
    plan = one._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(list" in plan.toString() or "PartitionFilters: [list#" in plan.toString()
    one.collect()
    files = plan.collectLeaves().apply(0).metrics().apply("numFiles").value()
    assert 0 < files < len(index.rows().inputFiles())
    found = index.search(table.where("vec_id = 50"), probes=2, k=5)
    assert found.count() == 5


def test_index_of_few_rows(spark, tmp_path):
    empty = VectorIndex.build(spark.createDataFrame([], SCHEMA), f"{tmp_path}/empty")
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [2.0, 0.0])], SCHEMA)
    assert empty.search(some).count() == 0 and empty.search_exact(some).count() == 0
    index = VectorIndex.build(some, f"{tmp_path}/some")
    got = {(r.query, r.rank): r.id for r in index.search_exact(some, k=2).collect()}
    assert got == {(1, 1): 3, (1, 2): 2, (2, 1): 1, (2, 2): 3, (3, 1): 1, (3, 2): 2}


def test_workers_hand_a_bounded_number_of_rows_over(made, monkeypatch):
    _, _, index, _ = made
    monkeypatch.setattr(neighbours, "CELLS", 90)
    monkeypatch.setattr(neighbours, "ROWS_AT_ONCE", 16)
    handed = {}

    class Rows:
        def mapInPandas(self, run, shape):
            rng = np.random.default_rng(1)
            batch = pd.DataFrame({"id": range(50), "vector": list(rng.normal(size=(50, 16)))})
            handed["parts"] = list(run(iter([batch, batch.iloc[:0]])))
            handed["batch"] = batch

    seen = []

    def choose(distances, batch):
        seen.append(distances.shape)
        return distances >= 0

    index._nearest_lists(Rows(), choose)
    whole = pd.concat(handed["parts"])
    assert max(len(p) for p in handed["parts"]) <= 16 and max(n for n, _ in seen) <= 3
    assert len(whole) == 50 * len(index.names) and set(zip(whole["id"], whole["list"])) == {(i, j) for i in range(50) for j in index.names}
