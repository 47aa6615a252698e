"""Writers: BED5, JSON lines, TSV reports and dense target tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import one_line
from spanloom.sources.ranged import store
from spanloom.sources.text import CHROMS

BED5_HEADER = "#chrom\tstart\tend\tbad_bp\tbad_fraction"
#: Bytes of a part that are copied at once.
COPY_BYTES = 8 << 20


def publish_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """``value`` lines in their order as one file.

    The lines are written as part files in parallel. One task then copies the parts
    behind one another in the store, a few megabytes at a time, under a hidden name,
    and moves the whole file to its place, so a reader sees the old file or the new
    one. A task that runs again starts a hidden file of its own.
    """
    spark = lines.sparkSession
    draft = f"{path}.parts-{uuid.uuid4().hex}"
    lines.select("value").write.text(draft)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, root = store(folder)
                _, target = store(path)
                files = system.get_file_info(pyarrow.fs.FileSelector(root))
                hidden = f"{root}/.whole-{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as out:
                    if header is not None:
                        out.write(header.encode() + b"\n")
                    for file in sorted((f for f in files if f.base_name.startswith("part-")), key=lambda f: f.base_name):
                        with system.open_input_stream(file.path) as part:
                            while held := part.read(COPY_BYTES):
                                out.write(held)
                system.create_dir(target.rpartition("/")[0], recursive=True)
                system.move(hidden, target)
        yield pa.RecordBatch.from_arrays([pa.array([True])], names=["done"])

    spark.createDataFrame([(draft,)], "folder string").coalesce(1).mapInArrow(run, "done boolean").collect()
    place = spark._jvm.org.apache.hadoop.fs.Path(draft)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def bed5_lines(regions: DataFrame) -> DataFrame:
    """``value`` lines in chromosome order, the fraction with six decimals."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, CHROMS)), F.col("chrom")), F.lit(0))
    line = F.format_string("%s\t%d\t%d\t%d\t%.6f", "chrom", "start", "end", "bad_bp", "bad_fraction")
    return regions.orderBy(F.when(rank == 0, len(CHROMS) + 1).otherwise(rank), "chrom", "start").select(line.alias("value"))


def write_bed5(regions: DataFrame, path: str) -> None:
    """Part files in order, the first with the header line."""
    header = regions.sparkSession.createDataFrame([(BED5_HEADER,)], "value string").coalesce(1)
    header.union(bed5_lines(regions)).write.text(path)


def publish_bed5(regions: DataFrame, path: str) -> None:
    """One file with the header line."""
    publish_lines(bed5_lines(regions), path, BED5_HEADER)


def write_json_lines(rows: DataFrame, path: str, nulls: bool = False, one_file: bool = False) -> None:
    fields = {"ignoreNullFields": str(not nulls).lower()}
    if one_file:
        publish_lines(rows.select(F.to_json(F.struct(*rows.columns), fields).alias("value")), path)
    else:
        rows.write.options(**fields).json(path)


def write_shards(shards: DataFrame, path: str, one_file: bool = False) -> None:
    """Shards in the order train, val, test."""
    rank = F.array_position(F.array(F.lit("train"), F.lit("val"), F.lit("test")), F.col("split"))
    write_json_lines(shards.orderBy(rank, "shard_id"), path, one_file=one_file)


def write_failures(failures: DataFrame, path: str) -> int:
    """``track_id, provider, error`` as TSV with one-line errors; number of rows.
    Without a failure an empty table replaces the one of the run before."""
    rows = failures.select("track_id", "provider", one_line(F.col("error")).alias("error"))
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="\\")
    return rows.count()


def write_targets(targets: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Dense targets by split and shard, neighbours together inside files."""
    ordered = targets.repartition("split", "shard_id").sortWithinPartitions("split", "shard_id", "track_index", "window_index")
    ordered.write.mode(mode).option("compression", "zstd").partitionBy("split", "shard_id").parquet(path)
