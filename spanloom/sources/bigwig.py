"""BigWig files as run-length rows, from the published file layout.

Only the parts of a file that are needed are read: tasks fetch the header and
walk the index by ranged reads, data blocks become rows, and these are dealt out
again by file and place, so one large file is the work of many tasks and blocks
next to each other are one read. Extents that a caller names, any number on each
chromosome, prune the index: a branch that meets none of them is not followed.
Stores that give no ranged access are read whole by Spark's own reader.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.intervals import merge_large, overlap_pairs
from spanloom.sources.ranged import RangedFile, WholeFile

#: Magic numbers and section types of the format.
MAGIC, TREE_MAGIC, INDEX_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
BED_GRAPH, VARIABLE, FIXED = 1, 2, 3
#: Fixed value: an end past every chromosome (positions have 32 bits).
WHOLE = 1 << 32
#: Bytes of a file whose blocks go to one task together; largest gap between blocks
#: that are read at once.
GROUP_BYTES, GAP_BYTES = 4 << 20, 1 << 14
#: Extents that prune an index walk; more of them meet the blocks in a join.
MOST_EXTENTS = 1 << 20


class BigWigFile:
    """Chromosomes, totals and data blocks of one file."""

    def __init__(self, read: RangedFile | WholeFile):
        self.read = read
        self.order = "<" if read(0, 4) == struct.pack("<I", MAGIC) else ">"
        if read.size < 64 or self._get("I", 0)[0] != MAGIC:
            raise ValueError("not a BigWig file")
        _, _, self.chrom_at, _, self.index_at, _, _, _, self.summary_at, self.buffer, _ = self._get("HHQQQHHQQIQ", 4)

    def _get(self, form: str, at: int) -> tuple:
        return struct.unpack(self.order + form, self.read(at, struct.calcsize(self.order + form)))

    def chroms(self) -> dict[int, tuple[str, int]]:
        magic, _, key, _, _, _ = self._get("IIIIQQ", self.chrom_at)
        if magic != TREE_MAGIC:
            raise ValueError("bad chromosome tree")
        found, stack = {}, [self.chrom_at + 32]
        while stack:
            at = stack.pop()
            leaf, _, count = self._get("BBH", at)
            for n in range(count):
                item = at + 4 + n * (key + 8)
                if leaf:
                    number, size = self._get("II", item + key)
                    found[number] = self.read(item, key).rstrip(b"\0").decode(), size
                else:
                    stack.append(self._get("Q", item + key)[0])
        return found

    def total(self) -> float | None:
        """The stored sum of all values; None where the file has no summary."""
        return self._get("Qdddd", self.summary_at)[3] if self.summary_at else None

    def entries(self, wanted: Extents | None = None) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(chromosome, start, last chromosome, end, place, size) of the data
        blocks in order; of those that meet an extent of ``wanted``, where given."""
        if self._get("I", self.index_at)[0] != INDEX_MAGIC:
            raise ValueError("bad data index")
        stack = [self.index_at + 48]
        while stack:
            at = stack.pop()
            leaf, _, count = self._get("BBH", at)
            form = "IIIIQQ" if leaf else "IIIIQ"
            children = struct.iter_unpack(self.order + form, self.read(at + 4, count * struct.calcsize(self.order + form)))
            kept = [c for c in children if wanted is None or wanted.meets(*c[:4])]
            if leaf:
                yield from kept
            else:
                stack += [c[4] for c in reversed(kept)]

    def decoded(self, data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """(chromosome number, starts, ends, values) of a block's bytes."""
        data = zlib.decompress(data) if self.buffer else data
        number, start, _, step, span, kind, _, count = struct.unpack_from(self.order + "IIIIIBBH", data)
        whole, real = self.order + "u4", self.order + "f4"
        if kind == BED_GRAPH:
            rows = np.frombuffer(data, np.dtype([("s", whole), ("e", whole), ("v", real)]), count, 24)
            starts, ends, values = rows["s"], rows["e"], rows["v"]
        elif kind == VARIABLE:
            rows = np.frombuffer(data, np.dtype([("s", whole), ("v", real)]), count, 24)
            starts, ends, values = rows["s"], rows["s"].astype(np.int64) + span, rows["v"]
        elif kind == FIXED:
            values = np.frombuffer(data, real, count, 24)
            starts = start + step * np.arange(count, dtype=np.int64)
            ends = starts + span
        else:
            raise ValueError(f"unknown section type {kind}")
        return number, starts.astype(np.int64), ends.astype(np.int64), values.astype(np.float32)

    def extents(self, regions: Regions | None) -> Extents | None:
        return None if regions is None else Extents({number: regions[name] for number, (name, _) in self.chroms().items() if name in regions})

    def check(self, regions: Regions, track: str) -> None:
        """Fail where an extent ends past its chromosome; one that the file does
        not have at all reads as zeros."""
        for name, length in self.chroms().values():
            starts, ends = regions.get(name, ((), ()))
            if len(ends) and (ends[-1] > length or starts[0] < 0):
                raise ValueError(f"track {track}: a window of {name} lies outside 0-{length}")


#: Sorted, disjoint extents of each chromosome: their starts and their ends.
Regions = Mapping[str, tuple[np.ndarray, np.ndarray]]


class Extents:
    """Extents by chromosome number, found by binary search."""

    def __init__(self, spans: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.spans = spans
        self.numbers = sorted(spans)

    def meets(self, first: int, start: int, last: int, end: int) -> bool:
        """Whether an extent meets what lies from ``start`` on ``first`` to ``end`` on ``last``."""
        for number in self.numbers[bisect_left(self.numbers, first) : bisect_right(self.numbers, last)]:
            starts, ends = self.spans[number]
            low, high = start if number == first else 0, end if number == last else WHOLE
            at = int(np.searchsorted(ends, low, "right"))
            if at < len(starts) and starts[at] < high:
                return True
        return False

    def kept(self, number: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which runs of a chromosome meet an extent."""
        if number not in self.spans:
            return np.zeros(len(starts), bool)
        lows, highs = self.spans[number]
        at = np.searchsorted(highs, starts, "right")
        return (at < len(lows)) & (lows[np.minimum(at, len(lows) - 1)] < ends)


def regions_of(windows: DataFrame) -> Regions | None:
    """The merged extents of ``windows(chrom, start, end)``, for all tasks; None
    where they are more than ``MOST_EXTENTS`` (16 bytes each)."""
    merged = merge_large(windows, ["chrom"]).limit(MOST_EXTENTS + 1).toPandas()
    if len(merged) > MOST_EXTENTS:
        return None
    ordered = merged.sort_values(["chrom", "start"])
    return {chrom: (rows["start"].to_numpy(np.int64), rows["end"].to_numpy(np.int64)) for chrom, rows in ordered.groupby("chrom")}


def _files(spark: SparkSession, path: str, ranged: bool) -> DataFrame:
    """(track_id, path, content) of the files; the bytes are read if not ``ranged``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{bw,BW,bigWig,bigwig}").load(path)
    name = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"(?i)\.(bw|bigwig)$", "")
    return files.select(name.alias("track_id"), "path", (F.lit(None).cast("binary") if ranged else F.col("content")).alias("content")).repartition("path")


def _opened(path: str, content: bytes | None) -> BigWigFile:
    return BigWigFile(RangedFile(path) if content is None else WholeFile(content))


def _over_files(files: DataFrame, schema: str, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for track, path, content in zip(*(c.to_pylist() for c in batch.columns)):
                yield from rows(track, path, _opened(path, content))

    return files.mapInArrow(run, schema)


RUNS = "track_id string, chrom string, start long, end long, value float"
BLOCKS = "track_id string, path string, chrom string, start long, end long, place long, size long"


def _run_batch(track: str, names: dict[int, tuple[str, int]], file: BigWigFile, data: bytes, wanted: Extents | None) -> pa.RecordBatch:
    number, starts, ends, values = file.decoded(data)
    if wanted is not None:
        keep = wanted.kept(number, starts, ends)
        starts, ends, values = starts[keep], ends[keep], values[keep]
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.array([track] * n, pa.string()), pa.array([names[number][0]] * n, pa.string()), pa.array(starts), pa.array(ends), pa.array(values)], names=["track_id", "chrom", "start", "end", "value"])


def bigwig_blocks(files: DataFrame, regions: Regions | None = None, checked: bool = False) -> DataFrame:
    """One row for each data block of ``files(track_id, path)``: its extent, place
    and size. A block on several chromosomes ends at the end of its first one's
    positions. With ``regions`` only blocks that meet them; with ``checked`` an
    extent past the end of a file's chromosome fails."""

    def rows(track: str, path: str, file: BigWigFile) -> Iterator[pa.RecordBatch]:
        names = file.chroms()
        if checked and regions is not None:
            file.check(regions, track)
        found = list(file.entries(file.extents(regions)))
        ends = [c[3] if c[0] == c[2] else WHOLE for c in found]
        columns = [pa.array([track] * len(found), pa.string()), pa.array([path] * len(found), pa.string()), pa.array([names[c[0]][0] for c in found], pa.string())]
        columns += [pa.array(values, pa.int64()) for values in ([c[1] for c in found], ends, [c[4] for c in found], [c[5] for c in found])]
        yield pa.RecordBatch.from_arrays(columns, names=["track_id", "path", "chrom", "start", "end", "place", "size"])

    return _over_files(files.select("track_id", "path", F.lit(None).cast("binary").alias("content")), BLOCKS, rows)


def read_blocks(blocks: DataFrame, regions: Regions | None = None) -> DataFrame:
    """The runs of data blocks (rows of ``bigwig_blocks``). Blocks of one part of a
    file go to one task, and those near each other are one read."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, names, wanted = None, None, {}, None

        def fetched(group: list[tuple[str, int, int]]) -> Iterator[pa.RecordBatch]:
            first = group[0][1]
            held = file.read(first, group[-1][1] + group[-1][2] - first)
            for track, place, size in group:
                yield _run_batch(track, names, file, held[place - first : place - first + size], wanted)

        group: list[tuple[str, int, int]] = []
        for batch in batches:
            for track, place_of, place, size in zip(*(c.to_pylist() for c in batch.columns)):
                if group and (place_of != path or place - group[-1][1] - group[-1][2] > GAP_BYTES or place + size - group[0][1] > GROUP_BYTES):
                    yield from fetched(group)
                    group = []
                if place_of != path:
                    path, file = place_of, _opened(place_of, None)
                    names, wanted = file.chroms(), file.extents(regions)
                group.append((track, place, size))
        if group:
            yield from fetched(group)

    dealt = blocks.select("track_id", "path", "place", "size").repartition("path", F.floor(F.col("place") / GROUP_BYTES))
    return dealt.sortWithinPartitions("path", "place").mapInArrow(decode, RUNS)


def read_bigwig(spark: SparkSession, path: str, regions: Regions | Mapping[str, tuple[int, int]] | None = None, *, ranged: bool = True) -> DataFrame:
    """(track_id, chrom, start, end, value) of all BigWig files of ``path``.

    ``regions`` gives the wanted extents of each chromosome, one pair or sorted
    arrays of starts and ends; index entries outside are not followed, and runs
    outside do not come back. Without ``ranged`` a file is one value of Spark's
    reader (2 GB at most), in any store it knows.
    """
    if regions is not None:
        regions = {chrom: (np.atleast_1d(np.asarray(a, np.int64)), np.atleast_1d(np.asarray(b, np.int64))) for chrom, (a, b) in regions.items()}
    if ranged:
        return read_blocks(bigwig_blocks(_files(spark, path, True), regions), regions)

    def whole(track: str, path: str, file: BigWigFile) -> Iterator[pa.RecordBatch]:
        names, wanted = file.chroms(), file.extents(regions)
        for entry in file.entries(wanted):
            yield _run_batch(track, names, file, file.read(*entry[4:]), wanted)

    return _over_files(_files(spark, path, False), RUNS, whole)


def read_bigwig_windows(files: DataFrame, windows: DataFrame) -> DataFrame:
    """The runs of ``files(track_id, path)`` that meet ``windows(chrom, start,
    end)``: an index join, so the bytes read are near those of the windows.

    The merged windows prune the walk of each file's index; where they are too
    many for that, all index entries are rows and are joined to the windows. A
    window past the end of a chromosome that a file has fails; a chromosome that
    it does not have gives no run.
    """
    regions = regions_of(windows)
    if regions is not None:
        return read_blocks(bigwig_blocks(files, regions, checked=True), regions)
    merged = merge_large(windows.select("chrom", "start", "end"), ["chrom"])
    sizes = _over_files(files.select("track_id", "path", F.lit(None).cast("binary").alias("content")), "track_id string, chrom string, length long", _size_rows)
    furthest = merged.groupBy("chrom").agg(F.max("end").alias("last"))
    outside = sizes.join(furthest, "chrom").filter("last > length").first()
    if outside is not None:
        raise ValueError(f"track {outside['track_id']}: a window of {outside['chrom']} lies outside 0-{outside['length']}")
    met = overlap_pairs(bigwig_blocks(files), merged, ["chrom"]).select("track_id", "path", "place", "size").distinct()
    runs = read_blocks(met)
    keys = ["track_id", "chrom", "start", "end", "value"]
    return overlap_pairs(runs, merged, ["chrom"]).select(keys).distinct()


def _total_rows(track: str, path: str, file: BigWigFile) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array([track]), pa.array([file.total()], pa.float64())], names=["track_id", "total"])


def read_bigwig_totals(spark: SparkSession, path: str, *, ranged: bool = True) -> DataFrame:
    """(track_id, total) from the files' own summaries; no data block is read."""
    return _over_files(_files(spark, path, ranged), "track_id string, total double", _total_rows)


def file_totals(files: DataFrame) -> DataFrame:
    """``read_bigwig_totals`` of ``files(track_id, path)``."""
    return _over_files(files.select("track_id", "path", F.lit(None).cast("binary").alias("content")), "track_id string, total double", _total_rows)


def _size_rows(track: str, path: str, file: BigWigFile) -> Iterator[pa.RecordBatch]:
    found = list(file.chroms().values())
    yield pa.RecordBatch.from_arrays([pa.array([track] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["track_id", "chrom", "length"])


def read_bigwig_sizes(spark: SparkSession, path: str, *, ranged: bool = True) -> DataFrame:
    """(track_id, chrom, length) of every file."""
    return _over_files(_files(spark, path, ranged), "track_id string, chrom string, length long", _size_rows)


def readable_bigwigs(spark: SparkSession, path: str, *, ranged: bool = True) -> DataFrame:
    """(track_id, valid): whether a file opens and names a chromosome."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for path, content in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                try:
                    good.append(bool(_opened(path, content).chroms()))
                except (ValueError, struct.error):
                    good.append(False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good)], names=["track_id", "valid"])

    return _files(spark, path, ranged).mapInArrow(run, "track_id string, valid boolean")
