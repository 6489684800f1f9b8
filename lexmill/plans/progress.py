"""Progress of a run as rows, written while it goes on: phases, counts so far, and the error it ended in."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

PROGRESS_SCHEMA = (
    "run string, seq long, at_utc string, phase string, state string, files long, scanned long, selected long, last_error string"
)
# States of a phase.
STARTED, RUNNING, FINISHED, FAILED = "started", "running", "finished", "failed"
_COUNTS = ("files", "scanned", "selected")


class ProgressLog:
    """Rows under ``path``, one small file each, so that others may read them while the run goes on.

    A row is complete or not there, as its file is made under a name that readers pass over and renamed. Counts that a row does not
    name are those of the row before. No job is started for it.
    """

    def __init__(self, spark: SparkSession, path: str, run: str = ""):
        self._spark, self._path = spark, path
        self.run = run or uuid.uuid4().hex
        self._seq = 0
        self._known: dict[str, int | None] = dict.fromkeys(_COUNTS)

    def write(self, phase: str, state: str, last_error: str = "", **counts: int | None) -> None:
        self._known |= counts
        row = {"run": self.run, "seq": self._seq, "at_utc": datetime.now(UTC).isoformat(timespec="seconds")}
        row |= {"phase": phase, "state": state, "last_error": last_error, **self._known}
        path = self._spark._jvm.org.apache.hadoop.fs.Path
        name = f"{self.run}-{self._seq:08d}.json"
        hidden, shown = path(f"{self._path}/_{name}"), path(f"{self._path}/{name}")
        store = shown.getFileSystem(self._spark._jsc.hadoopConfiguration())
        stream = store.create(hidden, True)
        stream.write(bytearray(json.dumps(row).encode()))
        stream.close()
        store.rename(hidden, shown)
        self._seq += 1

    @contextmanager
    def phase(self, name: str) -> Iterator[dict]:
        """A phase of the run; the counts that are put into the dict are written when it ends. An error is written and raised."""
        self.write(name, STARTED)
        counts: dict[str, int] = {}
        try:
            yield counts
        except Exception as problem:
            self.write(name, FAILED, f"{type(problem).__name__}: {str(problem).splitlines()[0] if str(problem) else ''}", **counts)
            raise
        self.write(name, FINISHED, **counts)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """All rows under ``path``; empty before the first one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], PROGRESS_SCHEMA)
    return spark.read.schema(PROGRESS_SCHEMA).json(path)
