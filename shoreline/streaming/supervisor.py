"""The apps of a deployment run as one thing.

``Supervisor`` starts every app with its own checkpoint and trigger, watches them, and
starts one that failed again from its checkpoint, so it goes on where it stopped and loses
or doubles nothing its sink does not (versions and topic batches replace themselves).
Restarts are limited per app; beyond the limit the supervisor stops the others and raises,
rather than serve tables that no longer move.  ``tick`` does one round of upkeep; ``run``
does rounds until told to stop.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shoreline.streaming.apps import state_store

_LOG = logging.getLogger("shoreline.supervisor")


@dataclass
class App:
    """One streaming app: ``build`` gives (its stream, its foreachBatch sink)."""

    build: Callable[[], tuple[DataFrame, Callable]]
    checkpoint: str
    every: str = "1 hour"
    partitions: int | None = None


class Supervisor:
    def __init__(self, spark: SparkSession, apps: Mapping[str, App], max_restarts: int = 3):
        self.spark, self.apps, self.max_restarts = spark, dict(apps), max_restarts
        self.queries = {}
        self.restarts = dict.fromkeys(self.apps, 0)

    def start(self) -> None:
        for name in self.apps:
            self._start(name)

    def _start(self, name: str) -> None:
        app = self.apps[name]
        updates, sink = app.build()
        with state_store(self.spark, app.partitions):
            self.queries[name] = (updates.writeStream.outputMode("update").foreachBatch(sink)
                                  .option("checkpointLocation", app.checkpoint).queryName(name)
                                  .trigger(processingTime=app.every).start())

    def tick(self) -> list[str]:
        """Start apps that failed again; returns their names."""
        failed = [n for n, q in self.queries.items() if not q.isActive]
        for name in failed:
            err = self.queries[name].exception()
            self.restarts[name] += 1
            if self.restarts[name] > self.max_restarts:
                self.stop()
                raise RuntimeError(f"streaming app {name} failed {self.restarts[name]} times: {err}")
            _LOG.warning("app %s stopped (%s); restart %d", name, err, self.restarts[name])
            self._start(name)
        if failed:
            self.spark.streams.resetTerminated()
        return failed

    def run(self, until: Callable[[], bool], poll_seconds: float = 5.0) -> None:
        """Watch the apps until ``until`` says so, then stop them."""
        try:
            while not until():
                try:
                    # returns early when an app ends, and raises when one fails: ``tick`` sees to both
                    self.spark.streams.awaitAnyTermination(poll_seconds)
                except Exception as err:  # noqa: BLE001
                    _LOG.warning("a streaming app ended: %s", err)
                    self.spark.streams.resetTerminated()
                self.tick()
        finally:
            self.stop()

    def settle(self, rounds: int = 1) -> None:
        """Wait until the apps have worked off what has landed, in their order, restarting
        those that fail (a deployment that is being drained, and tests)."""
        for _ in range(rounds):
            for name in self.apps:
                while True:
                    try:
                        self.queries[name].processAllAvailable()
                    except Exception as err:  # noqa: BLE001
                        _LOG.warning("app %s ended while draining: %s", name, err)
                        deadline = time.monotonic() + 30
                        while self.queries[name].isActive and time.monotonic() < deadline:
                            time.sleep(0.05)
                    if not self.tick():
                        break

    def stop(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()
