"""Outputs of several parts that are published together.

A run writes its parts below a folder of its own and marks each when it is whole. Only a manifest, one small file that is
renamed into place, makes a run the current one, so readers see all parts of one run or all of another. A run that died is
started again under its name: finished parts stay, the others are written anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


def _store(spark: SparkSession, path: str):
    """Spark's storage of a path, and a function that makes its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


def current(spark: SparkSession, output: str) -> str | None:
    """The folder of the run that was published last, or None before the first."""
    store, path = _store(spark, output)
    folder = path(f"{output}/{MANIFESTS}")
    if not store.exists(folder):
        return None
    names = sorted(s.getPath().getName() for s in store.listStatus(folder) if not s.getPath().getName().startswith("."))
    return f"{output}/runs/{names[-1].partition('-')[2]}" if names else None


@dataclass(frozen=True)
class Parts:
    """Where a job writes its parts: straight below ``output``, or with ``run`` as parts of a run to be published."""

    spark: SparkSession
    output: str
    run: str | None = None

    def path(self, name: str) -> str:
        return f"{self.output}/runs/{self.run}/{name}" if self.run else f"{self.output}/{name}"

    def write(self, name: str, write: Callable[[str], object]) -> None:
        """Write a part, unless this run has finished it before; ``write`` overwrites what a died run has left."""
        if not self.run:
            write(self.path(name))
            return
        store, path = _store(self.spark, self.output)
        mark = path(self.path(f"_finished/{name.replace('/', '.')}"))
        if not store.exists(mark):
            write(self.path(name))
            store.create(mark, True).close()

    def publish(self) -> None:
        """Make this run the current one; publishing a run again changes nothing."""
        if not self.run or current(self.spark, self.output) == f"{self.output}/runs/{self.run}":
            return
        store, path = _store(self.spark, self.output)
        folder = path(f"{self.output}/{MANIFESTS}")
        store.mkdirs(folder)
        earlier = [s.getPath().getName() for s in store.listStatus(folder) if not s.getPath().getName().startswith(".")]
        number = max((int(name.partition("-")[0]) for name in earlier), default=0) + 1
        hidden = path(f"{self.output}/{MANIFESTS}/.{self.run}")
        store.create(hidden, True).close()
        if not store.rename(hidden, path(f"{self.output}/{MANIFESTS}/{number:010d}-{self.run}")):
            raise OSError(f"could not publish run {self.run} below {self.output}")
