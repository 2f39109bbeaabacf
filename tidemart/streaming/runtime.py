"""Running stream jobs: when they trigger, how they are waited for, how they
stop and go on.

A job is started under :func:`settings`.  Without an interval it takes what
is there and stops (backfills, tests); with one it runs on and takes what
arrives.  Offsets and state are in the query's checkpoint, so a job that was
stopped, or lost its driver, goes on where it stood when it is started again
with the same name.
"""

from __future__ import annotations

import contextlib
import contextvars
import signal
import threading
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources import sinks


@dataclass(frozen=True)
class Settings:
    """``every``: the trigger interval (``"3 seconds"``), None: take what is
    there and stop.  ``sink``: how jobs that append rows write them, as
    ``parquet`` or as a ``topic`` of JSON lines for the next job.
    ``fold_every``: after how many micro-batches a table folds them (0: never)."""

    every: str | None = None
    sink: str = "parquet"
    fold_every: int = 20


_current: contextvars.ContextVar[Settings] = contextvars.ContextVar("stream_settings", default=Settings())


def current() -> Settings:
    return _current.get()


@contextlib.contextmanager
def settings(**changes) -> Iterator[Settings]:
    """Settings of the jobs started inside the block."""
    token = _current.set(replace(_current.get(), **changes))
    try:
        yield _current.get()
    finally:
        _current.reset(token)


def interval(text: str | None) -> str | None:
    """``3s``, ``500ms``, ``2m`` or Spark's own form to a trigger interval."""
    units = {"ms": "milliseconds", "s": "seconds", "m": "minutes", "h": "hours"}
    for short, long in units.items():
        if text and text.endswith(short) and text[:-len(short)].strip().isdigit():
            return f"{text[:-len(short)].strip()} {long}"
    return text


def triggered(writer: DataStreamWriter) -> DataStreamWriter:
    every = current().every
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


class StopSignal:
    """Set by SIGTERM / SIGINT while the block lasts; only a program's main
    thread can take signals, elsewhere it stays unset."""

    def __init__(self):
        self._event, self._before = threading.Event(), {}

    def __enter__(self) -> StopSignal:
        if threading.current_thread() is threading.main_thread():
            for s in (signal.SIGTERM, signal.SIGINT):
                self._before[s] = signal.signal(s, lambda *_: self._event.set())
        return self

    def __exit__(self, *_) -> None:
        for s, handler in self._before.items():
            signal.signal(s, handler)

    def is_set(self) -> bool:
        return self._event.is_set()


def stop(queries: Sequence[StreamingQuery], grace_seconds: float = 60) -> None:
    """Stop queries between two micro-batches if one ends in time; a batch
    that is cut off is done again at the restart, into the same place."""
    until = time.monotonic() + grace_seconds
    for q in queries:
        while q.isActive and q.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.1)
        q.stop()


def wait(spark: SparkSession, queries: Sequence[StreamingQuery], stop_file: str | None = None,
         seconds: float | None = None, poll_seconds: float = 0.5) -> str:
    """Wait for all queries of a job.  Returns ``finished`` when all have
    ended, ``stopped`` after a signal, after ``seconds`` or when ``stop_file``
    appears (in any store the session reads).  If one fails, the others are
    stopped too and its error is raised: half a job never goes on alone."""
    until = None if seconds is None else time.monotonic() + seconds
    with StopSignal() as signalled:
        while True:
            failed = next((q for q in queries if q.exception() is not None), None)
            if failed is not None:
                stop(queries)
                raise failed.exception()
            if not any(q.isActive for q in queries):
                return "finished"
            if signalled.is_set() or (until and time.monotonic() > until) or (stop_file and sinks.exists(spark, stop_file)):
                stop(queries)
                return "stopped"
            time.sleep(poll_seconds)
