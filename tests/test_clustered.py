"""Partition-scoped merges: the same rows as whole-table mutations, and untouched files stay."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from textmill.operators import mutations
from textmill.sources.clustered import ClusteredTable, _write
from textmill.streaming.ingest import run_available
from textmill.streaming.seen import clustered_sink, once_within, rocksdb_state


def files(path):
    return {p.relative_to(path).as_posix(): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def told(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", i, f"v{i}") for i in range(2000)] + [(None, -1, "none")], "id string, n int, v string")
    return rows, ClusteredTable.create(rows, str(tmp_path / "t"), "id", 64), tmp_path / "t"


def test_merges_equal_whole_mutations(spark, table):
    rows, made, _ = table
    assert told(made.read()) == told(rows) and made.read().schema == rows.schema
    changes = spark.createDataFrame([("k5", 500, "new"), ("k77", None, None), ("fresh", 1, "x")], rows.schema)
    steps = [
        (changes, mutations.upsert), (changes.withColumn("v", F.lit("again")), mutations.update), (changes.withColumn("id", F.concat("id", F.lit("?"))), mutations.insert_ignore),
        (changes.select("id"), mutations.delete), (spark.createDataFrame([("absent", 1, "x")], rows.schema), mutations.update),
    ]
    whole = rows
    for new, how in steps:
        whole = spark.createDataFrame(how(whole, new).select(*rows.columns).collect(), rows.schema)
        made.merge(new, how)
        assert told(made.read()) == told(whole)
    assert told(made.of_keys(["k9", "k10", "absent"])) == [("k10", 10, "v10"), ("k9", 9, "v9")]


def test_only_touched_partitions_are_rewritten(spark, table):
    rows, made, path = table
    before = files(path)
    touched = made.merge(spark.createDataFrame([(f"k{i}", 0, "c") for i in range(0, 2000, 100)], rows.schema), mutations.upsert)  # a hundredth
    after = files(path)
    changed = {f.split("/")[0] for f in before.keys() ^ after.keys()} | {f.split("/")[0] for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed == {f"shard={k}" for k in touched} and len(touched) <= 20 < 64
    plan = made.read(touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard" in plan
    assert made.merge(rows.limit(0), mutations.upsert) == [] and files(path) == after
    with pytest.raises(Exception, match="don't touch"):
        made.merge(rows.where("id = 'k1'"), lambda old, new: old.withColumn("id", F.concat("id", F.lit("x"))))
    assert files(path) == after


def test_emptied_partitions_go(spark, table):
    rows, made, _ = table
    made.merge(rows.where("id is not null").select("id"), mutations.delete)
    assert told(made.read()) == [(None, -1, "none")]


@pytest.mark.parametrize("moves", range(7))
def test_a_crash_within_a_swap_is_recovered(spark, table, moves):
    rows, made, path = table
    gone = [r.id for r in made.read([3]).collect()]
    changes = rows.where(F.col("id").isin(gone + ["k1", "k2"])).withColumn("n", F.lit(-5))

    def how(old, new):  # one partition is emptied, others change
        return mutations.upsert(old, new).where(F.col("id").isNull() | ~F.col("id").isin(gone))

    want = told(how(made.read(), changes))

    class Crash(Exception):
        pass

    class Fs:
        """The file system, which fails after some moves."""

        left = moves

        def __getattr__(self, name):
            return getattr(made_fs, name)

        def rename(self, a, b):
            if not self.left:
                raise Crash
            self.left -= 1
            return made_fs.rename(a, b)

    made_fs, made._fs = made._fs, Fs()
    try:
        made.merge(changes, how)
    except Crash:
        pass
    again = ClusteredTable(spark, str(path))
    assert told(again.read()) == want and not list(path.glob("_stage-*"))


def test_what_was_only_written_is_discarded(spark, table):
    rows, made, path = table
    _write(rows.withColumn("shard", F.lit(1)), f"{path}/_stage-x")
    assert told(ClusteredTable(spark, str(path)).read()) == told(rows) and not list(path.glob("_stage-*"))
    with pytest.raises(FileNotFoundError):
        ClusteredTable(spark, f"{path}-none")


# ---- streams ----------------------------------------------------------------------------------------------------

BEGIN = datetime(2025, 1, 1)


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    part = folder / f".{number:03d}"
    part.write_text("\n".join(json.dumps({"url": u, "at": t.isoformat() if t else None}) for u, t in rows))
    part.rename(folder / f"{number:03d}.json")


def run(spark, tmp_path, sink):
    stream = spark.readStream.schema("url string, at timestamp").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    with rocksdb_state(spark):
        return run_available(once_within(stream, "url", "at", "3 hours"), sink, f"{tmp_path}/checkpoint")


def test_state_stays_flat_and_late_repeats_are_defined(spark, tmp_path):
    sizes = []
    for day in range(2):  # the second run goes on where the first has ended
        for hour in range(12 * day, 12 * day + 12):
            at = BEGIN + timedelta(hours=hour)
            rows = [(f"u{hour}-{i}", at) for i in range(50)] + [(f"u{hour - 1}-{i}", at) for i in range(50) if hour]  # repeats of the hour before
            put(tmp_path / "in", hour, rows)
        query = run(spark, tmp_path, clustered_sink(str(tmp_path / "out"), "url", 8))
        sizes += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]]
    assert len(sizes) == 24 and max(sizes) <= (2 * 3 + 3) * 50 and sizes[-1] <= max(sizes[8:12]) + 50  # one more batch after a restart
    out = ClusteredTable(spark, str(tmp_path / "out")).read()
    assert out.count() == out.select("url").distinct().count() == 24 * 50

    seen = []
    late = BEGIN + timedelta(hours=2)
    put(tmp_path / "in", 90, [("u5-1", BEGIN + timedelta(hours=24)), ("u23-1", BEGIN + timedelta(hours=24)), ("old", late), ("none", None), ("new", BEGIN + timedelta(hours=24))])
    run(spark, tmp_path, lambda batch, n: seen.extend(r.url for r in batch.collect()))
    # Forgotten after its time; still known; too late; without a time; new.
    assert sorted(seen) == ["new", "u5-1"]


def test_a_batch_that_is_tried_again_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([("a", BEGIN), ("b", BEGIN), ("a", BEGIN)], "url string, at timestamp")
    sink = clustered_sink(str(tmp_path / "out"), "url", 4)
    for _ in range(2):
        sink(batch, 0)
    assert sorted(r.url for r in ClusteredTable(spark, str(tmp_path / "out")).read().collect()) == ["a", "b"]
    assert "RocksDB" not in str(spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""))
