"""Limiters, repeated fetches, ranks by counted values, stores and other pieces."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_records import docx, warc
from textmill.functions import records as R
from textmill.functions import vectors as V
from textmill.operators import ingest, learning, mutations, sampling, stats
from textmill.plans import jobs
from textmill.schemas import DOCUMENTS
from textmill.sources import archive, store


@pytest.mark.parametrize("rps", [0.25, 0.5, 0.99, 2.0])
def test_slow_limiters_end(rps):
    """A rate below one a second waits 1 / rps for each request and never hangs."""
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s
        assert len(slept) < 1000

    bucket = archive.TokenBucket(rps, rps, rps, clock=lambda: now[0], sleep=sleep)
    for _ in range(20):
        bucket.acquire()
    assert now[0] == pytest.approx((20 - rps) / rps)


def test_scrape_fetches_once(spark, tmp_path):
    """Every record is fetched once, whatever its outcome, and failures share no key."""
    (tmp_path / "calls").mkdir()
    body = warc(docx(b"one"))
    calls = str(tmp_path / "calls")

    def fetch(file, start, length):
        import uuid

        with open(f"{calls}/{file}-{uuid.uuid4().hex}", "w"):
            pass
        if file.startswith("bad"):
            raise archive.FetchError(404)
        return body

    rows = [(f"https://x.org/{k}.docx", f"{'bad' if k % 2 else 'ok'}{k}", 0, 9) for k in range(10)]
    records = spark.createDataFrame(rows, "url string, filename string, range_start long, range_length long")
    new, objects = jobs.scrape(records, spark.createDataFrame([], DOCUMENTS), "C", fetch, F.current_timestamp(), rps=1e6)
    assert sorted(r.status for r in new.collect()) == ["duplicate"] * 4 + ["failed"] * 5 + ["uploaded"]
    assert objects.count() == 1 and len(list((tmp_path / "calls").iterdir())) == 10


def test_identified_without_content(spark):
    rows = [("u1", 0, None, "HTTP 404"), ("u2", 1, None, None), ("u3", 2, docx(b"z"), None), ("u4", 3, docx(b"z"), None)]
    fetched = spark.createDataFrame(rows, "url string, position long, content binary, error string")
    out = {r.source_url: (r.status, r.error_message) for r in ingest.identified(fetched, spark.createDataFrame([], DOCUMENTS), "C", F.current_timestamp()).collect()}
    assert out["u1"] == ("failed", "HTTP 404") and out["u2"] == ("failed", "no content") and out["u3"][0] == "uploaded" and out["u4"][0] == "duplicate"


def test_update_adds_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, x string")
    assert sorted(map(tuple, mutations.update(old, new).collect()), key=str) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("seed", range(2))
def test_ranks_by_counted_values(spark, seed):
    """One value holds a third of a group; nulls are a group and a value like others."""
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", None]), 7 if rng.random() < 0.4 else rng.choice([None, *range(12)])) for k in range(200)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    got = {r.id: r.tercile for r in sampling.terciles(df, "g", "v").collect()}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        third = len(own) // 3
        assert [got[r[0]] for r in own] == [0] * third + [1] * third + [2] * (len(own) - 2 * third)
    parts = sampling.split(df, "g", 0.15)
    for r in parts.groupBy("g").agg(F.sum(F.col("is_validation").cast("int")).alias("n"), F.count(F.lit(1)).alias("of")).collect():
        assert r.n == int(0.15 * r.of + 0.5)
    middle = {r.g: r.upper_median for r in stats.word_spread(df, "g", "v").collect()}
    for g in ("a", "b", None):
        own = sorted(r[2] for r in rows if r[1] == g and r[2] is not None)
        assert middle[g] == own[len(own) // 2]
    workers = [r.worker for r in sampling.id_chunks(df.select("id"), 7).orderBy("id").collect()]
    assert workers == [k // 29 for k in range(200)]
    assert sampling.terciles(df.limit(0), "g", "v").collect() == [] and sampling.id_chunks(df.limit(0), 3).collect() == []


def test_patterns_in_bytes(spark):
    rows = spark.createDataFrame([("éé\r\nx".encode(),), (bytes([0xFF, 0, 0xFE]),), (b"",)], "b binary")
    got = [tuple(r) for r in rows.select(R.find_pattern("b", b"\r\n"), R.find_pattern("b", bytes([0xFE]))).collect()]
    assert got == [(4, -1), (-1, 2), (-1, -1)]


def test_document_vectors(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0], 5), (2, [1.0, 0.0], 1), (2, [0.0, 1.0], 3), (3, None, 1)], "id int, vector array<double>, weight int")
    got = {r.id: r.vector for r in V.document_vectors(rows).collect()}
    assert got[1] == [3.0, 4.0] and got[2] == pytest.approx([1 / 10**0.5, 3 / 10**0.5]) and set(got) == {1, 2}


def test_patient_calls():
    said, slept = [], []

    def call(batch):
        said.append(batch)
        if len(said) < 3:
            raise learning.Busy
        return [x.upper() for x in batch]

    assert learning.patient(call, tries=3, sleep=slept.append)(["a"]) == ["A"] and len(said) == 3
    assert slept[0] == 0.05 and slept[2] == 0.1 and slept[4] == 0.2  # the delay doubles after each refusal
    with pytest.raises(learning.Busy):
        learning.patient(lambda b: (_ for _ in ()).throw(learning.Busy()), tries=2, sleep=slept.append)(["a"])


def test_hashed_dimensions():
    assert len({learning._place(f"w{k}", 3072)[0] for k in range(9000)}) > 2000


def test_objects_at_an_address(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"1"), ("b", b"2")], "id string, content binary")
    store.write_absent_objects(rows, f"file://{tmp_path}/o")
    store.write_absent_objects(rows.withColumn("content", F.lit(b"x")), f"{tmp_path}/o")
    assert (tmp_path / "o" / "a.docx").read_bytes() == b"1" and len(list((tmp_path / "o").iterdir())) == 2
    with pytest.raises(Exception):  # noqa: B017  no such file system: an error, not a local folder
        store.write_absent_objects(rows, "nothere://bucket/o")


def test_crash_within_a_swap(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not store.recover_table(spark, path)
    store.replace_table(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old-1")
    spark.range(5).write.parquet(f"{path}.new-1")
    assert store.recover_table(spark, path) and spark.read.parquet(path).count() == 5


def test_rates(spark):
    rows = spark.createDataFrame([("2025-01-01 00:00:00.1",), ("2025-01-01 00:00:00.9",), ("2025-01-01 00:00:02",)], "t string")
    got = stats.rates(rows.select(F.col("t").cast("timestamp").alias("t")), "t").orderBy("begin").collect()
    assert [(r.n, r.per_second) for r in got] == [(2, 2.0), (1, 1.0)]
