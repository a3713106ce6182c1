"""The registered queries against their SQL, and the pipeline's stages against brute force."""

import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline as C
from tests.llm import helpers as H
from tests.test_queries import TABLES, canonical
from textmill.llm import bpe, registry

DIR = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")


@here
@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, name):
    got = registry.queries()[name](spark, DIR).toPandas()
    assert len(got)
    if name in registry.oracle_sql():
        con = duckdb.connect()
        for t in TABLES:
            con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
        want = con.sql(registry.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into every stage, and what comes out of the last."""
    if not os.path.isdir(DIR):
        pytest.skip("the driver's tables are not here")
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    seen = [docs]
    for k, (_, f) in enumerate(C.STAGES):
        f(spark, docs, DIR).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        seen.append(docs)
    return seen


def rows_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes


def test_quality_stage(spark, stages):
    before, after = rows_of(stages[0]), rows_of(stages[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    assert after.items() <= before.items()
    good, bad = [i for i in before if labels.get(i) == 1], [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.97 * len(good) and sum(i in after for i in bad) <= 0.1 * len(bad)


def test_line_stage(stages):
    before, after = rows_of(stages[1]), rows_of(stages[2])
    assert set(after) <= set(before)
    for i, t in after.items():
        rest = iter(before[i].split("\n"))
        assert all(x in rest for x in t.split("\n"))  # a subsequence of its lines
    gone = set(before) - set(after)
    assert all(any(before[i] == t or set(before[i].split("\n")) <= set(t.split("\n")) for j, t in before.items() if j < i) for i in gone)


def test_near_stage(stages):
    before, after = rows_of(stages[2]), rows_of(stages[3])
    want = H.brute_near(sorted(before.items()))
    assert after == {i: t for i, t in before.items() if want[i][1] == i}


def test_string_stage(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    for i, n_bytes, removed, _, kept in H.brute_substrings(sorted(before.items()), 50):
        if not removed:
            assert after[i] == before[i]
        elif i in after:
            assert len(after[i].encode()) <= n_bytes - removed
            assert len(after[i].encode()) >= n_bytes - removed - 3 * 2 * removed and (H.sha(after[i]) == kept or "�" not in after[i])


def test_packing_stage(stages):
    """Every document's tokens are read back, in order, from the sequences."""
    texts = rows_of(stages[4])
    ours = bpe.load(bpe.installed())
    ids = {}
    for r in sorted(stages[5].collect(), key=lambda r: (r.doc_id, r.begin)):
        assert r.place + r.tokens <= r.bin_size and r.begin == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += r.ids
    assert set(ids) == set(texts)
    assert all(x[-1] == ours.special[bpe.END] and ours.decode(np.array(x[:-1])) == texts[i] for i, x in ids.items())


@here
def test_run(spark):
    assert C.run(spark, DIR).count() > 0


def test_stages_with_odd_rows(spark, tmp_path):
    """Null ids and texts, repeated rows and an empty table go through every stage."""
    labels = spark.createDataFrame([(4, 1, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(i, t, "en", None, None) for i, t in H.odd_rows()], shape)
    for k, start in enumerate((odd, odd.limit(0))):
        docs = start
        for n, (_, f) in enumerate(C.STAGES):
            f(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{n}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{n}")
        assert (docs.count() > 0) == (k == 0)
