"""A small table in versions, of which one is current: a crash while a version is written leaves the one before in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Versions of a table under ``path``: the rows in ``versions/N``, and an empty file ``pointers/N`` once they are complete.

    The largest pointer names the current version. A pointer is made by one create call, which every store does at once or not at
    all, and never changed, so a reader sees the old version or the new one. A version without a pointer was given up; its
    number is not used again. One writer at a time works on a path.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def _hadoop(self, path: str):
        place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._spark._jsc.hadoopConfiguration())

    def _numbers(self, part: str) -> list[int]:
        place, store = self._hadoop(f"{self._path}/{part}")
        if not store.exists(place):
            return []
        names = [status.getPath().getName() for status in store.listStatus(place)]
        return sorted(int(name) for name in names if name.isdigit())

    @property
    def current(self) -> int | None:
        """The current version's number, or None before the first one."""
        return max(self._numbers("pointers"), default=None)

    def read(self) -> DataFrame | None:
        version = self.current
        return None if version is None else self._spark.read.parquet(f"{self._path}/versions/{version}")

    def write(self, table: DataFrame, keep: int = 2) -> int:
        """Write ``table`` as the next version and make it current; all but the last ``keep`` versions are deleted."""
        version = max([*self._numbers("versions"), *self._numbers("pointers")], default=-1) + 1
        table.write.parquet(f"{self._path}/versions/{version}")
        self._point(version)
        for part in ("pointers", "versions"):
            for old in self._numbers(part):
                if old <= version - keep:
                    place, store = self._hadoop(f"{self._path}/{part}/{old}")
                    store.delete(place, True)
        return version

    def _point(self, version: int) -> None:
        place, store = self._hadoop(f"{self._path}/pointers/{version}")
        store.create(place, False).close()
