"""Status of shards, repair manifests and the checks of a resumed run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPLETE, PARTIAL, SUSPECT, MISSING = "complete", "partial", "suspicious_final", "missing"


def shard_status(shards: DataFrame, finals: DataFrame, partials: DataFrame, key: list[str]) -> DataFrame:
    """``status`` of each shard: a final output marked ``complete``, else a partial
    one, else a final that is not complete, else missing."""
    done = finals.groupBy(*key).agg(F.max(F.coalesce("complete", F.lit(False))).alias("__done"))
    begun = partials.select(*key).distinct().withColumn("__begun", F.lit(True))
    joined = shards.join(done, key, "left").join(begun, key, "left")
    status = F.when(F.col("__done"), COMPLETE).when(F.col("__begun"), PARTIAL).when(F.col("__done").isNotNull(), SUSPECT).otherwise(MISSING)
    return joined.withColumn("status", status).drop("__done", "__begun")


def repair_manifest(statused: DataFrame, everything: bool = False) -> DataFrame:
    """``original_index, split, shard_id, status`` of the shards to run again."""
    wanted = F.lit(True) if everything else F.col("status") != COMPLETE
    return statused.filter(wanted).select("original_index", "split", "shard_id", "status")


def status_counts(statused: DataFrame) -> DataFrame:
    return statused.agg(*[F.count_if(F.col("status") == s).alias(s) for s in (COMPLETE, PARTIAL, SUSPECT, MISSING)])


def batches(tracks: DataFrame, index: str, size: int) -> DataFrame:
    """``batch_index``: ``size`` tracks in a row."""
    if size < 1:
        raise ValueError("a batch has one track at least")
    return tracks.withColumn("batch_index", F.floor(F.col(index) / size).cast("int"))


def pending(work: DataFrame, log: DataFrame, key: list[str]) -> DataFrame:
    """Work that the commit log does not have."""
    return work.join(log.select(*key), key, "left_anti")


def completeness(work: DataFrame, log: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """For each ``by``: whether all batches are committed, and which are not."""
    rows = work.select(*key).distinct().join(log.select(*key).distinct().withColumn("__done", F.lit(True)), key, "left")
    left = F.sort_array(F.collect_list(F.when(F.col("__done").isNull(), F.col(key[-1]))))
    return rows.groupBy(*by).agg(F.bool_and(F.col("__done").isNotNull()).alias("complete"), left.alias("missing"))


def require(rows: DataFrame, condition: Column, message: str) -> DataFrame:
    """The rows; one that breaks the condition (or leaves it null) fails the job."""
    return rows.filter(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def require_rows(rows: DataFrame, message: str) -> DataFrame:
    if rows.isEmpty():
        raise ValueError(message)
    return rows


def require_equal_lengths(windows: DataFrame) -> DataFrame:
    """The windows, or an error where they differ in length."""
    lengths = windows.agg(F.count_distinct(F.col("end") - F.col("start")).alias("n")).first()["n"]
    if lengths > 1:
        raise ValueError("the windows differ in length")
    return windows


def matching_run(recorded: dict, wanted: dict) -> list[str]:
    """Names of the settings in which a resumed run differs from its record."""
    return sorted(k for k in {*recorded, *wanted} if recorded.get(k) != wanted.get(k))
