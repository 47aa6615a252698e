"""Spark session settings and table access shared by every plan."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spanloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared Parquet tables; the path is left to Spark's readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    Clusters ship the package (``--py-files``) or install it; a local session may
    have been started without its folder on ``PYTHONPATH``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where it is unset
    (local runs) is a temporary folder chosen and set."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp")))
    return context._jsc.sc().getCheckpointDir().get()


#: Folders of tables with their session and its settings of file systems, which
#: outlive the Spark context.
_folders: dict[str, tuple] = {}


def written(frame: DataFrame) -> DataFrame:
    """``frame`` as a Parquet table in the folder of ``spark.checkpoint.dir``,
    read again: a cut point whose rows are computed once and survive lost
    executors. The tables of an application lie in one folder, which is deleted
    when the driver's interpreter ends, or by ``clear_written`` before."""
    spark = frame.sparkSession
    folder = f"{checkpoint_dir(spark)}/spanloom-{spark.sparkContext.applicationId}"
    _folders[folder] = spark, spark._jsc.hadoopConfiguration()
    path = f"{folder}/{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _delete(spark: SparkSession, folder: str, settings=None) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(settings or spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``written`` that no frame still in use reads."""
    for frame in frames:
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            if "/spanloom-" in folder:
                _delete(frame.sparkSession, folder)


@atexit.register
def clear_written() -> None:
    """Delete all tables of ``written``; frames that read them are no longer of use."""
    while _folders:
        folder, (spark, settings) = _folders.popitem()
        try:
            _delete(spark, folder, settings)
        except Exception:  # the virtual machine is gone, and with it the way to the files
            return
