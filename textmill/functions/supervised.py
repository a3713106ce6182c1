"""Functions of single rows in supervised child processes: a deadline for each, a kill and a new child when it passes.

A parser that hangs on one document can't be interrupted from within; its process can
be killed. Every task keeps a template beside its Arrow worker: a process that has
loaded the function and forks children, so that a new one takes no import. A child gets
one value at a time. A value that takes longer than the deadline, or ends its child,
gets an error for a result, and all others get theirs from the next child. While a
value takes long, the task goes on with the next ones in another child.
"""

from __future__ import annotations

import os
import pickle
import select
import signal
import socket
import struct
import subprocess
import sys
import time
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

if TYPE_CHECKING:  # templates load this module, too, and need neither
    import pandas as pd
    from pyspark.sql import DataFrame

_HEAD = struct.Struct("<Q")
#: What a template is asked: to fork a child, or (with its process id) for the status of one that has ended.
_ASK = struct.Struct("<cQ")


class Late(Exception):
    """The other side hasn't answered in time."""


class Ended(Exception):
    """The other side has closed its end."""


def _left(until: float) -> float | None:
    """Seconds to wait; None is for ever."""
    return None if until == float("inf") else max(0.0, until - time.monotonic())


def _write(fd: int, data: bytes, until: float) -> None:
    view = memoryview(_HEAD.pack(len(data)) + data)
    while view:
        if not select.select([], [fd], [], _left(until))[1]:
            raise Late
        try:
            view = view[os.write(fd, view[: 1 << 16]) :]
        except BlockingIOError:
            continue
        except (BrokenPipeError, ConnectionResetError):
            raise Ended from None


def _read(fd: int, until: float) -> bytes:
    def exactly(n: int) -> bytes:
        out = bytearray()
        while len(out) < n:
            if not select.select([fd], [], [], _left(until))[0]:
                raise Late
            try:
                data = os.read(fd, min(1 << 16, n - len(out)))
            except ConnectionResetError:
                raise Ended from None
            if not data:
                raise Ended
            out += data
        return bytes(out)

    return exactly(*_HEAD.unpack(exactly(_HEAD.size)))


class Template:
    """A process that has loaded a function, and forks a child to run it whenever one is asked for."""

    def __init__(self, function: Callable, memory_mb: int | None = None):
        from pyspark import cloudpickle

        self.function = cloudpickle.dumps((function, memory_mb))
        self.process: subprocess.Popen | None = None
        self.control: socket.socket | None = None

    def fork(self, start_s: float) -> tuple[int, socket.socket]:
        """A child's process id and the socket that it listens to."""
        until = time.monotonic() + start_s
        if self.process is None:
            env = os.environ | {"PYTHONPATH": os.pathsep.join(x for x in sys.path if x)}
            self.control, theirs = socket.socketpair()
            with theirs:
                said = [sys.executable, "-m", __name__, str(theirs.fileno())]
                self.process = subprocess.Popen(said, stdin=subprocess.DEVNULL, pass_fds=[theirs.fileno()], env=env)
            self.control.setblocking(False)
            _write(self.control.fileno(), self.function, until)
            _read(self.control.fileno(), until)
        ours, theirs = socket.socketpair()
        try:
            with theirs:
                socket.send_fds(self.control, [_ASK.pack(b"f", 0)], [theirs.fileno()])
            ours.setblocking(False)
            return pickle.loads(_read(self.control.fileno(), until)), ours
        except (Late, Ended, OSError):
            ours.close()
            raise Ended from None

    def status(self, pid: int, wait_s: float = 10) -> int:
        """How a child that has ended, or was killed, did so; it is gone then. Of another template's child: a kill."""
        try:
            os.write(self.control.fileno(), _ASK.pack(b"w", pid))
            return pickle.loads(_read(self.control.fileno(), time.monotonic() + wait_s))
        except (Late, Ended, OSError, AttributeError):
            return -signal.SIGKILL

    def close(self) -> None:
        if self.process:
            self.process.kill()
            self.process.wait()
            self.control.close()
            self.process = self.control = None


class Child:
    """A process that runs one function, value after value; started when it is needed, and again after it was killed."""

    def __init__(self, function: Callable | None = None, start_s: float = 60, starts: int = 3, memory_mb: int | None = None, template: Template | None = None):
        self.template, self.shared = template or Template(function, memory_mb), template is not None
        self.start_s, self.starts = start_s, starts
        self.process: int | None = None
        self.started = 0
        self.until, self.told = 0.0, None

    def _start(self) -> None:
        """A child that has answered; where the template stalls while it starts, it is killed and tried again."""
        for _ in range(self.starts):
            self.started += 1
            try:
                self.process, self.socket = self.template.fork(self.start_s)
                return
            except (Late, Ended):
                self.template.close()
        raise RuntimeError(f"no child has started within {self.start_s:g} s, {self.starts} times")

    def _end(self) -> int | None:
        """The status of the process, which is gone."""
        if self.process is None:
            return None
        pid, self.process = self.process, None
        self.socket.close()
        try:
            os.kill(pid, signal.SIGKILL)
        except ProcessLookupError:
            pass
        return self.template.status(pid)

    def kill(self) -> None:
        self._end()
        if not self.shared:
            self.template.close()

    def begin(self, value, deadline_s: float) -> None:
        if self.process is None:
            self._start()
        self.deadline_s, self.until, self.told = deadline_s, time.monotonic() + deadline_s, None
        self._try(lambda fd: _write(fd, pickle.dumps(value), self.until))

    def answer(self) -> tuple[object, str | None]:
        """(result, None), or (None, error): the function's own, a deadline that has passed, or a child that has died."""
        return self.told or self._try(lambda fd: pickle.loads(_read(fd, self.until)))

    def _try(self, action: Callable[[int], tuple | None]) -> tuple | None:
        try:
            self.told = action(self.socket.fileno())
        except Late:
            self._end()
            self.told = (None, f"timed out after {self.deadline_s:g}s")
        except Ended:
            # It has ended by itself: its status is asked for before anything kills it.
            pid, self.process = self.process, None
            self.socket.close()
            self.told = (None, f"process ended with status {self.template.status(pid)}")
        return self.told

    def call(self, value, deadline_s: float) -> tuple[object, str | None]:
        self.begin(value, deadline_s)
        return self.answer()


def answers(children: list[Child], values: list, deadline_s: float, patience_s: float) -> list[tuple[object, str | None]]:
    """What children answer, in the values' order. Another child gets the next value only where all the others have been busy for patience_s."""
    told, at, busy = [None] * len(values), 0, {}
    while at < len(values) or busy:
        now = time.monotonic()
        idle = min((c for c in children if c not in busy), key=lambda c: c.process is None, default=None)
        left = max((patience_s - (now - since) for _, since in busy.values()), default=0)
        waiting = at < len(values) and idle is not None
        if waiting and left <= 0:
            idle.begin(values[at], deadline_s)
            busy[idle] = (at, time.monotonic())
            at += 1
            now = time.monotonic()
            left, waiting = patience_s, at < len(values) and len(busy) < len(children)
        until = min(0.0 if c.told else max(0.0, c.until - now) for c in busy)
        open_ = {c.socket: c for c in busy if not c.told}
        heard = select.select(list(open_), [], [], min(until, left) if waiting else until)[0]
        now = time.monotonic()
        for c in [c for c in busy if c.told or c.until <= now or c.socket in heard]:
            told[busy.pop(c)[0]] = c.answer()
    return told


def with_deadline(
    rows: DataFrame, function: Callable, column: str, shape: str, deadline_s: float = 30, start_s: float = 60, memory_mb: int | None = None,
    children: int = 4,
) -> DataFrame:
    """rows without a column, with function's results for its values (a tuple as in the DDL shape) and error.

    A null value goes to the function as None. An error leaves the results null. A task
    is never held up longer than deadline_s by a row, nor its other rows by that one.
    With memory_mb a child that grows beyond it gets a MemoryError. After a tenth of the
    deadline other rows go on in up to children processes a task.
    """
    import pandas as pd

    kept = [c for c in rows.columns if c != column]
    spark = rows.sparkSession
    names = spark.createDataFrame([], shape).columns
    out = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), shape, "error string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(function, memory_mb)
        pool = [Child(start_s=start_s, template=template) for _ in range(children)]
        try:
            for batch in batches:
                told = answers(pool, [bytes(x) if isinstance(x, (bytearray, memoryview)) else x for x in batch[column]], deadline_s, deadline_s / 10)
                found = {n: pd.Series([None if r is None else r[k] for r, _ in told], dtype=object) for k, n in enumerate(names)}
                yield pd.concat([batch[kept].reset_index(drop=True), pd.DataFrame(found | {"error": pd.Series([e for _, e in told], dtype=object)})], axis=1)
        finally:
            for child in pool:
                child.kill()
            template.close()

    return rows.mapInPandas(run, out)


def _serve(control: int) -> None:
    """The template: reads the function, then forks children and tells how they ended, until its input ends."""
    os.dup2(2, 1)
    function, memory_mb = pickle.loads(_read(control, float("inf")))
    _write(control, b"ready", float("inf"))
    asked = socket.socket(fileno=control)
    while True:
        data, found, _, _ = socket.recv_fds(asked, _ASK.size, 1)
        if len(data) < _ASK.size:
            return
        kind, pid = _ASK.unpack(data)
        if kind == b"w":
            _write(control, pickle.dumps(os.waitstatus_to_exitcode(os.waitpid(pid, 0)[1])), float("inf"))
        elif pid := os.fork():
            os.close(found[0])
            _write(control, pickle.dumps(pid), float("inf"))
        else:
            asked.close()
            try:
                _answer(found[0], function, memory_mb)
            finally:
                os._exit(0)


def _answer(fd: int, function: Callable, memory_mb: int | None) -> None:
    """A child: a value at a time, until its input ends."""
    if memory_mb:
        import resource

        resource.setrlimit(resource.RLIMIT_AS, (memory_mb << 20, memory_mb << 20))
    while True:
        value = pickle.loads(_read(fd, float("inf")))
        try:
            out = (function(value), None)
        except Exception as e:  # a bad value's error is its result
            out = (None, f"{type(e).__name__}: {e}")
        _write(fd, pickle.dumps(out), float("inf"))


if __name__ == "__main__":
    try:
        _serve(int(sys.argv[1]))
    except Ended:
        pass
