"""Shards to dense tensors in resumable track batches.

The tracks of a shard are worked through in batches. A batch's targets are
written under its number and its commit follows; a run that stops in between
leaves no commit, so the next run writes that batch again and no other. When all
batches are committed the shard is marked complete.

Nothing is lost in silence: every track must have a file and a total before the
first write, a window past the end of a track's chromosome fails its batch, and a
batch is committed only if the metrics observed while it was written say that each
window of each track is there.

``process_shard`` works on one shard. ``process_shards`` works on a whole manifest:
what the commit log does not have is found by an anti-join, and one job serves the
same batch of tracks for all shards, so signals are read once for all windows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.numeric import TARGET_TOTAL
from spanloom.functions.text import safe_filename, sequence_codes
from spanloom.operators import signal as S
from spanloom.operators.intervals import union_merge
from spanloom.operators.manifests import numbered
from spanloom.operators.status import batches, completeness, matching_run, pending, require_equal_lengths, shard_status
from spanloom.schemas import COMMIT
from spanloom.session import written
from spanloom.sources.text import present_files, window_sequences

log = logging.getLogger(__name__)
#: Windows of a shard have numbers under this.
MOST_WINDOWS = 1 << 24
#: A genome in chunks, or windows to windows with ``seq``.
Sequence = DataFrame | Callable[[DataFrame], DataFrame]


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def move(spark: SparkSession, source: str, target: str) -> None:
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    if not paths[0].getFileSystem(spark._jsc.hadoopConfiguration()).rename(*paths):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def quarantine(spark: SparkSession, path: str, stamp: str) -> str:
    """Set a broken output aside; returns its new place."""
    target = f"{path}.corrupt-{stamp}"
    move(spark, path, target)
    return target


def committed(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(COMMIT).parquet(f"{out}/commits/*") if exists(spark, f"{out}/commits") else spark.createDataFrame([], COMMIT)


def kept(spark: SparkSession, frame: DataFrame, path: str) -> DataFrame:
    """``frame`` worked out once for all batches and all runs of an output."""
    if not exists(spark, f"{path}/_SUCCESS"):
        frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shard_windows(shard: DataFrame) -> DataFrame:
    """(window_index, chrom, start, end) of one shard row, in its order."""
    return shard.select(F.posexplode("windows").alias("window_index", "w")).select("window_index", "w.*")


def required_files(spark: SparkSession, tracks: DataFrame, folder: str) -> DataFrame:
    """(track_id, path) of the signal file of every track: ``folder/<safe name of
    the id>.bw``. A file that is absent or empty fails, and so do two tracks with
    the same file name."""
    named = tracks.select("track_id", F.concat(safe_filename(F.col("track_id")), F.lit(".bw")).alias("name"))
    there = present_files(spark, folder).filter("length > 0").groupBy("name").agg(F.min("path").alias("path"))
    joined = written(named.join(there, "name", "left"))
    missing = [r["track_id"] for r in joined.filter("path is null").orderBy("track_id").limit(5).collect()]
    if missing:
        raise ValueError(f"no signal file in {folder} for {', '.join(map(repr, missing))}")
    twice = joined.groupBy("name").agg(F.count_distinct("track_id").alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"several tracks have the file name {twice['name']!r}")
    return joined.select("track_id", "path")


def require_totals(tracks: DataFrame, totals: DataFrame) -> None:
    """Fail where a track has no total, or one that is not finite and positive."""
    good = totals.filter(F.col("total").isNotNull() & ~F.isnan("total") & (F.col("total") > 0) & (F.col("total") < float("inf")))
    bad = [r["track_id"] for r in tracks.select("track_id").join(good.select("track_id"), "track_id", "left_anti").orderBy("track_id").limit(5).collect()]
    if bad:
        raise ValueError(f"no valid total for {', '.join(map(repr, bad))}")


def _write_observed(dense: DataFrame, path: str, expected: int, **options: str) -> dict:
    """Write dense rows and return what was observed on the way. Fails where rows
    are missing, so that nothing is committed."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("capped_values"), F.lit(0)).alias("capped_values"), F.min("low").alias("low"), F.max("high").alias("high")]
    dense.observe(seen, *metrics).write.mode("overwrite").options(compression="zstd", **options).partitionBy(*[c for c in ("split", "shard_id", "batch_index") if c in dense.columns]).parquet(path)
    if seen.get["rows"] != expected:
        raise RuntimeError(f"{seen.get['rows']} rows of {expected} were written")
    return seen.get


def _sequences(windows: DataFrame, sequence: Sequence) -> DataFrame:
    found = sequence(windows) if callable(sequence) else window_sequences(windows, sequence)
    return found.withColumn("sequence", sequence_codes(F.col("seq"))).drop("seq")


def process_shard(
    spark: SparkSession,
    shard: DataFrame,
    tracks: DataFrame,
    sequence: Sequence,
    signal: DataFrame,
    masks: tuple[DataFrame, DataFrame],
    out: str,
    *,
    totals: DataFrame | None = None,
    sizes: DataFrame | None = None,
    target: float = TARGET_TOTAL,
    batch_size: int = 16,
    stop_after: int | None = None,
) -> str:
    """Write one shard under ``out``; returns ``complete`` or ``partial``.

    ``tracks`` has ``track_index, track_id, sum_stat``. A complete output is left
    alone; a partial one whose recorded run differs in shard, batch size, windows
    or tracks fails. ``stop_after`` ends the run after that many batches. ``sizes``
    (``track_id, chrom, length``) lets windows past the end of a chromosome fail;
    sources that read by windows check this themselves.
    """
    final, partial = f"{out}/complete", f"{out}/partial"
    if exists(spark, final):
        return "complete"
    row = shard.select("shard_id", "split").first()
    windows = require_equal_lengths(shard_windows(shard))
    planned = batches(tracks, "track_index", batch_size)
    wanted = {"shard_id": row["shard_id"], "split": row["split"], "batch_size": str(batch_size), "target": repr(target)}
    wanted["windows"] = str(windows.agg(F.sum(F.xxhash64(*windows.columns).cast("decimal(38,0)"))).first()[0])
    wanted["tracks"] = str(tracks.agg(F.sum(F.xxhash64("track_index", "track_id", "sum_stat").cast("decimal(38,0)"))).first()[0])
    if exists(spark, f"{partial}/run"):
        differing = matching_run({r["name"]: r["value"] for r in spark.read.parquet(f"{partial}/run").collect()}, wanted)
        if differing:
            raise ValueError(f"the partial output differs in {', '.join(differing)}")
    totals = written(S.header_totals(signal) if totals is None else totals)
    require_totals(tracks, totals)
    if not exists(spark, f"{partial}/run"):
        spark.createDataFrame(list(wanted.items()), "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{partial}/run")
    mask = kept(spark, union_merge(*masks, ["chrom"]), f"{partial}/mask")
    if not exists(spark, f"{partial}/windows/_SUCCESS"):
        _sequences(windows, sequence).join(S.valid_masks(windows, mask), "window_index").write.mode("overwrite").parquet(f"{partial}/windows")
    factors = kept(spark, S.factors(totals, target), f"{partial}/factors")
    n_windows = windows.count()
    done = {r["batch_index"] for r in committed(spark, partial).collect()}
    counts = {r["batch_index"]: r["n"] for r in planned.groupBy("batch_index").agg(F.count(F.lit(1)).alias("n")).collect()}
    todo = sorted(counts.keys() - done)
    for number in todo if stop_after is None else todo[:stop_after]:
        own = planned.filter(F.col("batch_index") == number).join(factors, "track_id")
        if sizes is not None:
            S.check_bounds(windows, sizes.join(own.select("track_id"), "track_id", "left_semi")).count()
        runs = S.transformed(S.window_signal(windows, signal.join(own.select("track_id"), "track_id", "left_semi"), mask), own)
        dense = S.dense_targets(windows, own, runs, statistics=True)
        seen = _write_observed(dense, f"{partial}/targets/batch={number}", n_windows * counts[number])
        log.info("%s batch %d: extremes %s and %s, %d values capped", row["shard_id"], number, seen["low"], seen["high"], seen["capped_values"])
        stats = _track_statistics(spark.read.schema(dense.schema).parquet(f"{partial}/targets/batch={number}"), ["track_index"])
        own.join(stats, "track_index").write.mode("overwrite").parquet(f"{partial}/tracks/batch={number}")
        spark.range(1).select(F.lit(row["shard_id"]).alias("shard_id"), F.lit(number).cast("int").alias("batch_index")).write.mode("overwrite").parquet(f"{partial}/commits/{number}")
    work = planned.select(F.lit(row["shard_id"]).alias("shard_id"), "batch_index")
    state = completeness(work, committed(spark, partial), ["shard_id", "batch_index"], ["shard_id"]).first()
    if state is not None and not state["complete"]:
        return "partial"
    for name in ("mask", "factors"):
        delete(spark, f"{partial}/{name}")
    move(spark, partial, final)
    return "complete"


def _track_statistics(targets: DataFrame, by: list[str]) -> DataFrame:
    """Capped positions and extremes by track, from the small columns of written targets."""
    return targets.groupBy(*by).agg(F.sum("capped_values").alias("capped_values"), F.min("low").alias("low"), F.max("high").alias("high"))


def process_shards(
    spark: SparkSession,
    shards: DataFrame,
    tracks: DataFrame,
    sequence: Sequence,
    signal: Callable[[DataFrame, DataFrame], DataFrame],
    masks: tuple[DataFrame, DataFrame],
    out: str,
    *,
    totals: DataFrame,
    target: float = TARGET_TOTAL,
    batch_size: int = 16,
    stop_after: int | None = None,
) -> DataFrame:
    """Write all shards of a manifest under ``out``; ``shard_id, complete, missing``.

    ``signal(track ids, windows)`` gives the runs of some tracks on some windows.
    Every job takes one batch of tracks for the shards that have not committed it:
    targets go to partitions of split, shard and batch, which a job that runs again
    overwrites and no others, and the commits of all its shards follow. Windows may
    be shared by shards. ``stop_after`` ends the run after that many jobs.
    """
    require_totals(tracks, totals)
    placed = written(numbered(shards.select("shard_id", "split", "windows"), ["split", "shard_id"], "shard_no"))
    windows = placed.select("shard_no", F.posexplode("windows").alias("i", "w")).select((F.col("shard_no") * MOST_WINDOWS + F.col("i")).alias("window_index"), "w.*")
    windows = written(require_equal_lengths(windows))
    names = placed.select("shard_no", "split", "shard_id", F.size("windows").alias("n_windows"))
    planned = written(batches(tracks, "track_index", batch_size).join(S.factors(totals, target), "track_id"))
    mask = written(union_merge(*masks, ["chrom"]))
    shard_of = F.floor(F.col("window_index") / MOST_WINDOWS).alias("shard_no")
    position = F.pmod("window_index", F.lit(MOST_WINDOWS)).cast("int")
    if not exists(spark, f"{out}/windows/_SUCCESS"):
        coded = _sequences(windows, sequence).join(S.valid_masks(windows, mask), "window_index")
        rows = coded.withColumn("shard_no", shard_of).withColumn("window_index", position).join(names.drop("n_windows"), "shard_no").drop("shard_no")
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("split", "shard_id").parquet(f"{out}/windows")
    n_batches = planned.select("batch_index").distinct().count()
    spark.createDataFrame([(n_batches,)], "n_batches long").coalesce(1).write.mode("overwrite").parquet(f"{out}/plan")
    work = names.crossJoin(planned.select("batch_index").distinct())
    todo = written(pending(work, committed(spark, out), ["shard_id", "batch_index"]))
    numbers = sorted(r["batch_index"] for r in todo.select("batch_index").distinct().collect())
    for number in numbers if stop_after is None else numbers[:stop_after]:
        shards_left = todo.filter(F.col("batch_index") == number)
        own = planned.filter(F.col("batch_index") == number)
        wanted = windows.join(shards_left.select("shard_no"), shard_of == F.col("shard_no"), "left_semi")
        runs = S.transformed(S.window_signal(wanted, signal(own.select("track_id"), wanted), mask), own)
        dense = S.dense_targets(wanted, own, runs, statistics=True).withColumn("shard_no", shard_of).withColumn("window_index", position)
        dense = dense.join(names.drop("n_windows"), "shard_no").drop("shard_no").withColumn("batch_index", F.lit(number))
        expected = (shards_left.agg(F.sum("n_windows")).first()[0] or 0) * own.count()
        seen = _write_observed(dense, f"{out}/targets", expected, partitionOverwriteMode="dynamic")
        log.info("batch %d: extremes %s and %s, %d values capped", number, seen["low"], seen["high"], seen["capped_values"])
        commits = shards_left.select("shard_id", "batch_index").coalesce(1)
        commits.write.mode("overwrite").parquet(f"{out}/commits/{number}-{shards_left.agg(F.sum(F.xxhash64('shard_id').cast('decimal(38,0)'))).first()[0]}")
    return completeness(work.select("shard_id", "batch_index"), committed(spark, out), ["shard_id", "batch_index"], ["shard_id"])


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath().toString() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []]


def output_status(spark: SparkSession, shards: DataFrame, root: str) -> DataFrame:
    """``original_index, split, shard_id, status`` of a manifest (with ``line``) by
    the outputs under ``root``, of single shards and of whole splits. Folders are
    listed; commits are read, tensors are not."""
    parts = lambda paths: [tuple(p.rstrip("/").split("/")[-3:-1]) for p in paths]
    two, three = "split string, shard_id string", "split string, shard_id string, complete boolean"
    finals = spark.createDataFrame([(*p, False) for p in parts(_matching(spark, f"{root}/*/*/complete"))], three)
    partials = spark.createDataFrame(parts(_matching(spark, f"{root}/*/*/partial")), two)
    runs = [p for p in _matching(spark, f"{root}/*/*/complete/run")]
    if runs:  # a final output is whole if its own record names its shard
        recorded = spark.read.parquet(*runs).select("name", "value", F.split(F.col("_metadata.file_path"), "/").alias("at")).filter("name = 'shard_id'")
        named = recorded.select(F.element_at("at", -5).alias("split"), F.element_at("at", -4).alias("shard_id"), (F.col("value") == F.element_at("at", -4)).alias("complete"))
        finals = finals.unionByName(named)
    for plan in _matching(spark, f"{root}/all-*/plan"):
        base = plan.rpartition("/")[0]
        split = base.rpartition("/all-")[2]
        n = spark.read.parquet(plan).first()["n_batches"]
        counted = committed(spark, base).groupBy("shard_id").agg(F.count_distinct("batch_index").alias("n"))
        whole = counted.select(F.lit(split).alias("split"), "shard_id", (F.col("n") == n).alias("complete"))
        finals = finals.unionByName(whole.filter("complete"))
        partials = partials.unionByName(whole.filter("not complete").drop("complete"))
    listed = numbered(shards, ["line"], "original_index").select("original_index", "split", "shard_id")
    return shard_status(listed, finals, partials, ["split", "shard_id"])
