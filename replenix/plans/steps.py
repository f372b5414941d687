"""Steps of a run (B8): tried again, run side by side, and skipped where an earlier attempt has finished them.

A named run keeps one empty file per finished step.  A run that is started again under its name repeats only the
steps that have none, in the order of their needs; what finished steps wrote is read instead.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from replenix.sinks.snapshots import _put_if_absent
from replenix.sinks.writers import folder_exists


class Steps:
    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None, retries: int = 0):
        self.spark, self.retries = spark, retries
        self.folder = f"{base.rstrip('/')}/_runs/{run_id}" if run_id else None

    def done(self, name: str) -> bool:
        return self.folder is not None and folder_exists(self.spark, f"{self.folder}/{name}")

    def run(self, name: str, work: Callable, read: Callable = lambda: None):
        """What ``work`` returns, or ``read`` where the step is finished already."""
        if self.done(name):
            return read()
        for attempt in range(self.retries + 1):
            try:
                out = work()
                break
            except Exception:
                if attempt == self.retries:
                    raise
        if self.folder is not None:
            _put_if_absent(self.spark, f"{self.folder}/{name}")
        return out

    def side_by_side(self, **works: tuple[Callable, Callable]) -> dict:
        """Independent steps at the same time.  All are ended before the first failure is raised, so what succeeds
        beside a failing step is not repeated."""
        from pyspark import inheritable_thread_target

        with ThreadPoolExecutor(len(works)) as pool:
            started = {name: pool.submit(inheritable_thread_target(self.spark)(lambda n=name, w=work: self.run(n, *w)))
                       for name, work in works.items()}
        return {name: future.result() for name, future in started.items()}
