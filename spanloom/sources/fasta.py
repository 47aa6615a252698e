"""FASTA by index: windows are read by the bytes that hold them.

The index has a row for each record: its name, its length, where its first base
lies and how its lines are cut. It is read from the ``.fai`` file beside a genome,
or made by one pass over the bytes, in splits of a fixed size. A window's place in
the file follows from it, so a task reads the window's own bytes and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.session import written
from spanloom.sources.ranged import RangedFile

INDEX = "chrom string, length long, offset long, line_bases long, line_bytes long"
#: Bytes of a genome that one task scans for an index, and those it holds at once.
SPLIT_BYTES, BLOCK_BYTES = 64 << 20, 2 << 20
#: Bases of one output batch (or one window).
HELD_BASES = 1 << 20
#: Windows that start in the same stretch of a file go to one task, in order.
STRETCH_BYTES = 8 << 20


def read_fasta_index(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ``.fai`` file."""
    return spark.read.schema(INDEX).option("mode", "FAILFAST").csv(path, sep="\t")


def _segments(path: str, number: int, split: int) -> list[tuple]:
    """What a split knows of its records, by the lines that start in it: the part
    of the record before its first header (number 0), then one for each header."""
    file = RangedFile(path)
    begin, end = number * split, min((number + 1) * split, file.size)
    data = np.frombuffer(file(max(begin - 1, 0), end - max(begin - 1, 0)), np.uint8)
    breaks = np.flatnonzero(data == 10) + 1 + max(begin - 1, 0)
    starts = breaks[(breaks >= begin) & (breaks < end)]
    if begin == 0 and file.size:
        starts = np.concatenate(([0], starts))
    if not len(starts):
        return []
    raw = data.tobytes()[int(starts[0]) - max(begin - 1, 0) :]
    while not raw.endswith(b"\n") and int(starts[0]) + len(raw) < file.size:  # the last line goes on past the split
        line, found, _ = file(int(starts[0]) + len(raw), 1 << 16).partition(b"\n")
        raw += line + found
    ends = np.concatenate((starts[1:], [int(starts[0]) + len(raw)]))
    bytes_ = np.frombuffer(raw, np.uint8)
    first = bytes_[starts - starts[0]]
    blank = np.concatenate(([0], np.cumsum((bytes_ == 10) | (bytes_ == 13) | (bytes_ == 32) | (bytes_ == 9))))
    bases = (ends - starts) - (blank[ends - starts[0]] - blank[starts - starts[0]])
    heads = np.flatnonzero(first == ord(">"))
    rows = []
    for k, (head, after) in enumerate(zip([-1, *heads.tolist()], [*heads.tolist(), len(starts)])):
        own = np.arange(head + 1, after)
        own = own[bases[own] > 0] if k or len(own) else own
        name = None
        if k:
            title = raw[int(starts[head] - starts[0]) : int(ends[head] - starts[0])]
            name = (title[1:].split() or [b""])[0].decode("utf-8", "replace")
        if not k and not len(own):
            continue
        width = int(ends[own[0]] - starts[own[0]]) if len(own) else 0
        inner = bases[own[:-1]]
        rows.append((number, k, name, int(ends[head]) if k else None, int(bases[own[0]]) if len(own) else None, width, int(bases[own].sum()), int(inner.min()) if len(inner) else None, int(inner.max()) if len(inner) else None, int(bases[own[-1]]) if len(own) else None))
    return rows


def make_fasta_index(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    """The index of a FASTA file that has none. Lines of a record must be equally
    long, but for the last one; another record fails when the index is used.

    A task goes through its ``split`` by blocks. Records inside a block are done
    there; only the rows at the borders of blocks, two for each, are put together.
    """
    size = RangedFile(path).size
    block = min(split, BLOCK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 7]
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rows = _segments(path, number, block)
                whole = [0 < r[1] < rows[-1][1] for r in rows]
                yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)), pa.array(whole, pa.bool_())], names=["split", "k", "name", "offset", "line", "width", "bases", "low", "high", "last", "whole"])

    blocks, splits = max(-(-size // block), 1), max(-(-size // split), 1)
    segments = written(spark.range(0, blocks, 1, splits).mapInArrow(run, "split long, k long, name string, offset long, line long, width long, bases long, low long, high long, last long, whole boolean"))
    uneven = lambda line, final: (F.coalesce("low", line) != line) | (F.coalesce("high", line) != line) | F.when(final, F.coalesce("last", line) > line).otherwise(F.coalesce("last", line) != line)
    inside = segments.filter("whole").select(F.col("name").alias("chrom"), F.col("bases").alias("length"), "offset", F.col("line").alias("line_bases"), F.when(F.col("line").isNotNull(), F.col("width")).alias("line_bytes"), uneven(F.col("line"), F.lit(True)).alias("odd"))
    # Every block hands its last record on.
    along = W.orderBy("split", "k")
    numbered = segments.filter("not whole").withColumn("record", F.count("name").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    within = W.partitionBy("record").orderBy("split", "k").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    line = F.first("line", True).over(within)
    final = F.struct("split", "k") == F.max(F.struct("split", "k")).over(within)
    judged = numbered.withColumns({"line_bases": line, "line_bytes": F.first(F.when(F.col("line").isNotNull(), F.col("width")), True).over(within), "odd": uneven(line, final)})
    records = judged.filter("record > 0").groupBy("record").agg(F.max("name").alias("chrom"), F.sum("bases").alias("length"), F.max("offset").alias("offset"), F.first("line_bases").alias("line_bases"), F.first("line_bytes").alias("line_bytes"), F.bool_or("odd").alias("odd"))
    records = records.drop("record").unionByName(inside)
    checked = F.when(F.coalesce(F.col("odd"), F.lit(False)), F.raise_error(F.concat(F.lit("lines of different lengths in "), "chrom")).cast("bigint")).otherwise(F.col("length"))
    return records.select("chrom", checked.alias("length"), "offset", F.coalesce("line_bases", F.lit(1).cast("long")).alias("line_bases"), F.coalesce("line_bytes", F.lit(1).cast("long")).alias("line_bytes"))


def byte_span(start: Column, end: Column) -> tuple[Column, Column]:
    """First byte and the byte after the last one of the bases ``[start, end)``."""
    place = lambda x: F.col("offset") + F.floor(x / F.col("line_bases")) * F.col("line_bytes") + x % F.col("line_bases")
    return place(start), place(end - 1) + 1


def read_fasta_windows(spark: SparkSession, path: str, windows: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``windows(chrom, start, end, ...)`` with ``seq``, each read by its own bytes.

    ``index`` defaults to the ``.fai`` file beside ``path``. An empty window, one of
    a chromosome that the file does not have, or one past its end fails.
    """
    index = read_fasta_index(spark, f"{path}.fai") if index is None else index
    names = windows.columns
    joined = windows.join(index.withColumnRenamed("chrom", "__chrom"), F.col("chrom") == F.col("__chrom"), "left")
    inside = F.coalesce((F.col("start") >= 0) & (F.col("end") > F.col("start")) & (F.col("end") <= F.col("length")), F.lit(False))
    message = F.concat(F.lit("no sequence for "), "chrom", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    first, stop = byte_span(F.col("start"), F.col("end"))
    checked = joined.filter(F.when(inside, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    requests = checked.select(*names, first.alias("__first"), (stop - first).alias("__size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            file = file or RangedFile(path)
            places, sizes = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            first, held, total = 0, [], 0
            for row, (place, size) in enumerate(zip(places, sizes), 1):  # few at a time: a window can be long
                held.append(file(place, size).translate(None, b"\r\n").decode("ascii"))
                total += size
                if total >= HELD_BASES or row == batch.num_rows:
                    kept = [batch.column(k).slice(first, row - first) for k in range(batch.num_columns - 2)]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(held, pa.string())], names=[*names, "seq"])
                    first, held, total = row, [], 0

    schema = T.StructType([*windows.schema.fields, T.StructField("seq", T.StringType())])
    dealt = requests.repartition(F.floor(F.col("__first") / STRETCH_BYTES)).sortWithinPartitions("__first")
    return dealt.mapInArrow(run, schema)
