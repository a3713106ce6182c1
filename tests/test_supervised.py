"""Deadlines, crashes and stalled starts of child processes."""

import os
import time

import pytest
from pyspark.sql import functions as F

from textmill.functions.supervised import Child, with_deadline


def behave(x):
    if x == "hang":
        time.sleep(600)
    if x == "die":
        os._exit(5)
    if x == "fail":
        raise ValueError("bad value")
    print("not an answer")
    return (len(x), x * 2)


def test_a_hanging_value_gets_an_error_and_the_others_a_result(spark):
    values = ["a", "hang", "bb", "die", "fail", "", "x" * 300_000, "hang", "last"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, value string").coalesce(1)
    began = time.monotonic()
    got = {r.id: r for r in with_deadline(rows, behave, "value", "n int, twice string", deadline_s=1.5).collect()}
    assert time.monotonic() - began < 60 and len(got) == len(values)
    for i, x in enumerate(values):
        error = {"hang": "timed out after 1.5s", "die": "process ended with status 5", "fail": "ValueError: bad value"}.get(x)
        assert (got[i].n, got[i].twice, got[i].error) == ((None, None, error) if error else (len(x), x * 2, None))


def test_a_child_is_kept_until_it_has_to_be_killed():
    child = Child(behave)
    try:
        assert [child.call(x, 5)[1] for x in ("a", "b", "fail", "c")] == [None, None, "ValueError: bad value", None] and child.started == 1
        assert child.call("hang", 0.3) == (None, "timed out after 0.3s") and child.process is None
        assert child.call("a", 5) == ((1, "aa"), None) and child.started == 2
    finally:
        child.kill()


def test_a_start_that_stalls_is_tried_again(tmp_path):
    mark = tmp_path / "mark"

    class Stalls:
        def __reduce__(self):
            return (_stall_once, (str(mark),))

    child = Child(Stalls(), start_s=2)
    try:
        assert child.call("a", 5) == ((1, "aa"), None) and child.started == 2
    finally:
        child.kill()
    with pytest.raises(RuntimeError, match="no child has started"):
        Child(Stalls(), start_s=0.0001, starts=2).call("a", 5)


def _stall_once(mark):
    if not os.path.exists(mark):
        open(mark, "w").close()
        time.sleep(600)
    return behave


def test_memory_of_a_child_is_bounded():
    child = Child(lambda n: (len(bytearray(n)),), memory_mb=600)
    try:
        assert child.call(1000, 5) == ((1000,), None)
        assert child.call(1 << 30, 5) == (None, "MemoryError: ")
    finally:
        child.kill()


def test_no_rows_and_null_values(spark):
    rows = spark.createDataFrame([(1, None)], "id int, value string")
    got = with_deadline(rows, lambda x: (x is None,), "value", "none boolean").collect()
    assert [(r.id, r.none, r.error) for r in got] == [(1, True, None)]
    assert with_deadline(rows.where(F.lit(False)), behave, "value", "n int, twice string").collect() == []


def test_rows_go_on_while_some_hang(spark):
    values = ["hang" if i % 5 == 0 else f"v{i}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, value string").coalesce(1)
    began = time.monotonic()
    got = {r.id: r for r in with_deadline(rows, behave, "value", "n int, twice string", deadline_s=3).collect()}
    # One after the other, eight times three seconds would pass.
    assert time.monotonic() - began < 20
    assert all((got[i].twice, got[i].error) == ((None, "timed out after 3s") if x == "hang" else (x * 2, None)) for i, x in enumerate(values))


def test_new_children_are_forked_without_loading_the_function_again(tmp_path):
    log = tmp_path / "loads"

    class Loaded:
        def __reduce__(self):
            return (_logged, (str(log),))

    child = Child(Loaded())
    try:
        told = [child.call(x, 10)[1] for x in ("die", "a", "die", "b", "die")]
    finally:
        child.kill()
    died = "process ended with status 5"
    assert told == [died, None, died, None, died] and child.started == 3 and log.read_text() == "x"


def _logged(log):
    with open(log, "a") as f:
        f.write("x")
    return behave
