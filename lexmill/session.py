"""Session helpers: a tuned local session, the checkpoint folder, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its estimated size stays under this many bytes.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(app_name: str = "lexmill", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, from the session's ``spark.checkpoint.dir`` if it is set.

    Only a local master may fall back to a temporary folder: on a cluster that folder would live on
    one machine and the checkpoint would be lost with it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="lexmill-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def spread_scan(scan: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with fewer splits than cores a partition for each core; a large scan stays as it is.

    Work on texts costs far more than moving the few row groups of a small input once.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return it without its history."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class StepTables:
    """The tables of an iteration in a folder beside the checkpoints, deleted as soon as no later step reads them.

    A step survives a lost executor as a checkpoint does, and the disk in use does not grow with the number of steps.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._root = f"{ensure_checkpoint_dir(spark)}/steps-{uuid.uuid4().hex}"
        self._count = 0
        self._tables: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next step's table and return it as read from there."""
        path = f"{self._root}/{self._count}"
        self._count += 1
        df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        self._tables.append((table, path))
        return table

    def together(self, *tables: DataFrame) -> DataFrame:
        """Tables of one schema as one scan, which packs their small files into few tasks; a union has tasks for each table."""
        paths = [path for table, path in self._tables if any(table is wanted for wanted in tables)]
        return self._spark.read.schema(tables[0].schema).parquet(*paths)

    def keep(self, *tables: DataFrame) -> None:
        """Delete every table but these."""
        left = []
        for table, path in self._tables:
            if any(table is kept for kept in tables):
                left.append((table, path))
            else:
                self._delete(path)
        self._tables = left

    def clear(self) -> None:
        self.keep()
        self._delete(self._root)

    def _delete(self, path: str) -> None:
        place = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(place, True)


def broadcast_if_small(df: DataFrame, bytes_per_row: int, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when ``rows * bytes_per_row`` is under the limit, else leave the join to Spark.

    The count runs on ``df``, so hand in something cheap to count (a checkpointed or cached table).
    """
    at_most = max(1, limit_bytes // bytes_per_row)
    small = df.limit(at_most + 1).count() <= at_most
    return F.broadcast(df) if small else df
