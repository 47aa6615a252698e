"""Resumable micro-batches: committed work is never done again.

A batch's results are written first, under its own number, and its entry in the
commit log last. A batch that stops in between is written again under the same
number when the query resumes, over what it left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def commit_log(spark: SparkSession, out: str) -> DataFrame:
    """(batch, rows) of the committed batches."""
    path = f"{out}/commits"
    exists = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not exists.getFileSystem(spark._jsc.hadoopConfiguration()).exists(exists):
        return spark.createDataFrame([], "batch long, rows long")
    return spark.read.schema("batch long, rows long").parquet(f"{path}/*")


def process(spark: SparkSession, source: str, schema: StructType, out: str, work: Callable[[DataFrame], DataFrame], files_per_batch: int = 1, stop_after: int | None = None, stop_marker: str | None = None) -> int:
    """Work through the Parquet files of ``source`` that no batch has taken yet;
    returns the number of batches run.

    The run ends between two batches after ``stop_after`` of them, or when a file
    ``stop_marker`` is there: a scheduler that is about to take the machine away
    writes it, a batch that has begun ends with its commit, and the next run goes
    on from there. Any other end is an error and is raised.
    """
    ran, stopped = 0, False
    marker = None if stop_marker is None else spark._jvm.org.apache.hadoop.fs.Path(stop_marker)

    class Stopped(Exception):
        pass

    def requested() -> bool:
        if stop_after is not None and ran >= stop_after:
            return True
        return marker is not None and marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)

    def one(batch: DataFrame, number: int) -> None:
        nonlocal ran, stopped
        if requested():
            stopped = True
            raise Stopped
        done = work(batch)
        done.write.mode("overwrite").parquet(f"{out}/data/batch={number}")
        written = spark.read.parquet(f"{out}/data/batch={number}").count()
        spark.range(1).select(F.lit(number).cast("long").alias("batch"), F.lit(written).cast("long").alias("rows")).write.mode("overwrite").parquet(f"{out}/commits/{number}")
        ran += 1

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not stopped:
            raise
    return ran


def results(spark: SparkSession, out: str) -> DataFrame:
    """Rows of the committed batches alone."""
    data = spark.read.parquet(f"{out}/data")
    return data.join(commit_log(spark, out).select("batch"), "batch", "left_semi")
