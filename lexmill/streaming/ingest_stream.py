"""Continuous ingest: a file stream over the Parquet root, one committed run for each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.config import IngestConfig
from lexmill.functions.text import relative_path
from lexmill.plans.ingest import file_log, ingest_files, next_run, run_history, waiting_files

_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when it made the checkpoint; a checkpoint made anew has another one."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take back the last offset commit of a stopped stream, as if it had died just before it: its last micro-batch comes again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    last = max(int(name) for name in names if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}"), False)


def start_ingest_stream(
    spark: SparkSession, config: IngestConfig, checkpoint: str, files_per_batch: int = 1000, continuous: bool = False
) -> StreamingQuery:
    """Ingest new Parquet files as they appear; ``continuous=False`` stops when all present files are done.

    The stream carries file names, not rows: each micro-batch probes its files, picks their columns and
    reads them as the batch job does. It takes the next run number of the output, so it goes on after batch runs and
    other streams, and leaves out files that the output already has. A micro-batch that was committed before its offset was,
    is known by the checkpoint's id and its number when it is replayed, and is not ingested again; one that was not is
    overwritten. ``files_per_batch`` is the stream's bound; those of a batch run are refused, because
    what they cut off would never come back.
    """
    if config.max_files or config.max_batches:
        raise ValueError("max_files and max_batches bound a batch run; bound a stream by files_per_batch")
    files = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", str(config.recursive).lower())
        .option("maxFilesPerTrigger", files_per_batch)
        .load(config.parquet_root)
    )
    # the content column is not selected, so file content is not read here
    listed = files.select(
        "path",
        relative_path(F.col("path"), config.parquet_root).alias("relative_path"),
        F.col("length").alias("input_bytes"),
        F.col("modificationTime").alias("modified"),
    )

    def ingest(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = (stream_id(session, checkpoint), batch_id)
        history = run_history(session, config.output_root)
        if history is not None:
            again = (F.col("stream_id") == stream[0]) & (F.col("stream_batch") == stream[1])
            if history.filter(again).limit(1).count():
                return
        run, first_run = next_run(session, config.output_root)
        waiting = waiting_files(batch, file_log(session, config.output_root))
        ingest_files(session, config, waiting, run, run if first_run is None else first_run, stream=stream)

    writer = listed.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    return (writer if continuous else writer.trigger(availableNow=True)).start()
