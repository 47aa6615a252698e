"""Interval-set operators on ``(key..., start, end)`` rows, 0-based half-open.

``by`` names the columns that separate sets (a chromosome, a user). Rows whose
``end`` is not above ``start`` are empty and are dropped by the merging
operators. Nulls in ``start`` or ``end`` make a row invalid: it is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Width of the bins of the range join; a power of two near a window's length.
BIN = 1 << 18
#: Characters of the texts that are searched at once; code points there are.
HELD_CHARS, CODES = 1 << 20, 0x110000


def merge_intervals(rows: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """Sorted, disjoint, non-touching intervals of each set.

    A new island starts where ``start`` lies more than ``gap`` past the largest
    end so far, so touching intervals merge. With a gap this is the batch form of
    session windows. One shuffle by ``by`` serves the window and the aggregation.
    """
    valid = rows.filter(F.col("end") > F.col("start")).select(*by, "start", "end")
    before = W.partitionBy(*by).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    running = W.partitionBy(*by).orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)
    flagged = valid.withColumn("opens", F.coalesce(F.col("start") > F.max("end").over(before) + gap, F.lit(True)).cast("int"))
    islands = flagged.withColumn("island", F.sum("opens").over(running))
    return islands.groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def merge_large(rows: DataFrame, by: list[str], bin_size: int = BIN * 64) -> DataFrame:
    """``merge_intervals`` for sets too large for one task: merge inside bins
    first, which leaves few rows of each set for the merge across bins."""
    valid = rows.filter(F.col("end") > F.col("start"))
    binned = valid.withColumn("__bin", F.floor(F.col("start") / bin_size))
    return merge_intervals(merge_intervals(binned, [*by, "__bin"]).drop("__bin"), by)


def union_merge(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The merged union of two interval sets, also of large ones."""
    columns = [*by, "start", "end"]
    return merge_large(left.select(columns).unionByName(right.select(columns)), by)


def overlap_pairs(windows: DataFrame, intervals: DataFrame, by: list[str], bin_size: int = BIN) -> DataFrame:
    """Overlapping pairs of windows and intervals as an equi-join on bins.

    Both sides are spread over the bins they touch; a pair is kept in the bin of
    its later start alone, so none is repeated. Bins also split hot keys. The
    interval columns come back as ``i_start, i_end`` and any extra ones.
    """

    def spread(rows: DataFrame) -> DataFrame:
        bins = F.sequence(F.floor(F.col("start") / bin_size), F.floor((F.col("end") - 1) / bin_size))
        return rows.filter(F.col("end") > F.col("start")).withColumn("bin", F.explode(bins))

    right = spread(intervals).withColumnsRenamed({"start": "i_start", "end": "i_end"})
    met = spread(windows).join(right, [*by, "bin"])
    overlap = (F.col("i_start") < F.col("end")) & (F.col("i_end") > F.col("start"))
    own = F.col("bin") == F.floor(F.greatest("start", "i_start") / bin_size)
    return met.filter(overlap & own).drop("bin")


def _masks(merged: DataFrame, by: list[str], bin_size: int, reach: int) -> DataFrame:
    """``(by..., __bin, __mask)``: the intervals of each set that windows of at most
    ``reach`` positions can meet which start in the bin. They are disjoint, so there
    are fewer than positions of a bin and its reach."""
    bins = F.sequence(F.floor((F.col("start") - reach) / bin_size), F.floor((F.col("end") - 1) / bin_size))
    held = merged.filter(F.col("end") > F.col("start")).withColumn("__bin", F.explode(bins))
    return held.groupBy(*by, "__bin").agg(F.collect_list(F.struct("start", "end")).alias("__mask"))


def _covered() -> Column:
    """Positions of ``[start, end)`` that the intervals of ``__mask`` cover."""
    part = lambda m: F.greatest(F.least(m["end"], F.col("end")) - F.greatest(m["start"], F.col("start")), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    return F.when(F.col("__mask").isNull(), zero).otherwise(F.coalesce(F.aggregate("__mask", zero, lambda acc, m: acc + part(m)), zero))


def overlap_bp(windows: DataFrame, merged: DataFrame, by: list[str], name: str = "overlap_bp", bin_size: int = BIN, large: bool = False) -> DataFrame:
    """Every window with the number of positions that ``merged`` covers; 0 where
    nothing overlaps. Windows are told apart by ``by``, ``start`` and ``end``;
    repeated windows keep their rows.

    A window of up to ``bin_size`` meets the intervals near the bin it starts in as
    one row, so it is exchanged once, with its further columns, and neither sorted
    (if ``merged`` is said to be ``large``) nor aggregated. Longer ones are summed
    over their bins.
    """
    long = F.coalesce(F.col("end") - F.col("start") > bin_size, F.lit(False))
    masks = _masks(merged, by, bin_size, bin_size)
    near = windows.filter(~long).withColumn("__bin", F.floor(F.col("start") / bin_size)).join(masks.hint("shuffle_hash") if large else masks, [*by, "__bin"], "left")
    return near.withColumn(name, _covered()).select(*windows.columns, name).unionByName(_overlap_long(windows.filter(long), merged, by, name, bin_size))


def _overlap_long(windows: DataFrame, merged: DataFrame, by: list[str], name: str, bin_size: int) -> DataFrame:
    """``overlap_bp`` of windows over several bins.

    Equal windows are counted first. An outer join on bins keeps a window without
    any overlap, so one aggregation ends it; only windows with further columns
    are joined to the sums.
    """
    keys = [*by, "start", "end"]
    counted = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    bins = lambda end: F.explode_outer(F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.greatest("start", end - 1) / bin_size)))
    left = counted.withColumn("__bin", bins(F.col("end"))).alias("w")
    right = merged.filter(F.col("end") > F.col("start")).select(*by, "start", "end").withColumn("__bin", bins(F.col("end"))).alias("m")
    same = [F.col(f"w.{c}") == F.col(f"m.{c}") for c in (*by, "__bin")]
    overlap = (F.col("m.start") < F.col("w.end")) & (F.col("m.end") > F.col("w.start")) & (F.col("w.end") > F.col("w.start"))
    own = F.col("w.__bin") == F.floor(F.greatest("w.start", "m.start") / bin_size)
    met = left.join(right, [*same, overlap, own], "left").select("w.*", (F.least("w.end", "m.end") - F.greatest("w.start", "m.start")).alias("__bp"), F.col("m.start").isNotNull().alias("__met"))
    sums = met.groupBy(*keys, "__n").agg(F.sum(F.when(F.col("__met"), F.col("__bp")).otherwise(0)).cast("long").alias(name))
    if len(windows.columns) > len(keys):
        return windows.join(sums.drop("__n"), keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("long")))
    return sums.withColumn("__n", F.explode(F.array_repeat("__n", F.col("__n").cast("int")))).select(*windows.columns, name)


def tile_overlap_bp(runs: DataFrame, size: int, stride: int, merged: DataFrame, by: list[str], name: str = "overlap_bp", bin_size: int = BIN) -> DataFrame:
    """``overlap_bp(tile(runs, size, stride), merged, by, name)`` in which runs meet
    the intervals, cut to the windows that start in one bin, and the windows are
    made behind the join: no window is exchanged."""
    if size <= 0 or stride <= 0:
        raise ValueError("size and stride must be positive")
    width = max(bin_size, size)
    rest = [c for c in runs.columns if c not in ("start", "end")]
    whole = lambda x: F.floor(x).cast("long")
    fitting = runs.filter(F.col("end") - F.col("start") >= size).select(*rest, F.col("start").cast("long").alias("__from"), (F.col("end") - size).cast("long").alias("__last"))
    cut = fitting.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("__from") / width), F.floor(F.col("__last") / width))))
    skipped = F.greatest(-whole((F.col("__from") - F.col("__bin") * width) / stride), F.lit(0))
    cut = cut.select(*rest, "__bin", (F.col("__from") + skipped * stride).alias("__from"), F.least(F.col("__last"), (F.col("__bin") + 1) * width - 1).alias("__last"))
    met = cut.filter("__from <= __last").join(_masks(merged, by, width, size), [*by, "__bin"], "left")
    starts = F.explode(F.sequence("__from", "__last", F.lit(stride).cast("long")))
    tiles = met.select(*rest, "__mask", starts.alias("start")).withColumn("end", F.col("start") + size)
    return tiles.withColumn(name, _covered()).drop("__mask")


def filter_by_overlap(windows: DataFrame, limit: float, bad: str = "overlap_bp") -> DataFrame:
    """Windows whose covered part is strictly under ``limit`` of their length,
    with the fraction as ``bad_fraction``."""
    length = F.col("end") - F.col("start")
    return windows.filter(F.col(bad) < limit * length).withColumn("bad_fraction", F.col(bad) / length)


def subtract_intervals(rows: DataFrame, merged: DataFrame, by: list[str], bin_size: int = BIN) -> DataFrame:
    """The parts of each row outside ``merged`` (disjoint intervals), with the
    row's further columns. A row that overlaps nothing comes back whole."""
    extra = [c for c in rows.columns if c not in (*by, "start", "end")]
    keys = [*by, "start", "end", *extra]
    numbered = rows.filter(F.col("end") > F.col("start"))
    cuts = overlap_pairs(numbered, merged.select(*by, "start", "end"), by, bin_size)
    holes = cuts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i_start", "i_end"))).alias("holes"))
    clean = numbered.join(holes.select(keys), keys, "left_anti")
    edges = F.concat(F.array(F.col("start")), F.col("holes.i_end")), F.concat(F.col("holes.i_start"), F.array(F.col("end")))
    parts = F.filter(F.arrays_zip(edges[0].alias("a"), edges[1].alias("b")), lambda p: p["b"] > p["a"])
    cut = holes.withColumn("part", F.explode(parts)).select(*by, F.col("part.a").alias("start"), F.col("part.b").alias("end"), *extra)
    return cut.unionByName(clean.select(*by, "start", "end", *extra))


def tile(runs: DataFrame, size: int, stride: int) -> DataFrame:
    """Windows ``start, start + stride, ...`` of ``size`` that fit in each run.
    A stride under the size slides, an equal one tumbles."""
    if size <= 0 or stride <= 0:
        raise ValueError("size and stride must be positive")
    fitting = runs.filter(F.col("end") - F.col("start") >= size)
    starts = F.explode(F.sequence(F.col("start"), F.col("end") - size, F.lit(stride).cast("long")))
    rest = [c for c in runs.columns if c not in ("start", "end")]
    return fitting.select(*rest, starts.alias("start")).withColumn("end", F.col("start") + size)


def pattern_runs(text: Column, inside: str, outside: str) -> Column:
    """Array of (start, end) of the maximal runs of the class ``inside``.

    The text is cut into alternating pieces; running lengths give the offsets.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"({inside}+|{outside}+)"), F.lit(1))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece)
        span = F.array(F.struct(state["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(piece.rlike(f"^{inside}"), F.concat(state["runs"], span)).otherwise(state["runs"]).alias("runs"))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(pieces, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("runs")), step)["runs"]


def text_runs(rows: DataFrame, text: str, inside: str) -> DataFrame:
    """``pattern_runs`` as rows ``(..., start, end)`` without a shuffle: the runs
    of a text are found in one pass where the text is. Null texts have none."""
    rest = [c for c in rows.columns if c != text]
    pattern = re.compile(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, member = np.zeros(CODES, bool), np.zeros(CODES, bool)
        for batch in batches:
            for first, texts in _held(batch.column(0)):
                codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
                if not len(codes):
                    continue
                new = np.flatnonzero(np.bincount(codes[~known[codes]])) if not known[codes].all() else ()
                for code in new:  # the class decides on each character once
                    known[code], member[code] = True, pattern.match(chr(code)) is not None
                starts = np.cumsum([0, *map(len, texts)])
                hit = member[codes]
                opens, closes = hit.copy(), np.zeros(len(hit) + 1, bool)
                opens[1:] &= ~hit[:-1]
                closes[1:-1] = hit[:-1] & ~hit[1:]
                closes[-1] = hit[-1]
                # No run goes on across the border of two texts.
                border = np.unique(starts[(starts > 0) & (starts < len(hit))])
                opens[border] |= hit[border]
                closes[border] |= hit[border - 1]
                begin, end = np.flatnonzero(opens), np.flatnonzero(closes)
                owner = np.searchsorted(starts, begin, "right") - 1
                table = batch.select(range(1, batch.num_columns)).take(pa.array(first + owner))
                yield pa.RecordBatch.from_arrays([*table.columns, pa.array(begin - starts[owner]), pa.array(end - starts[owner])], names=[*rest, "start", "end"])

    schema = T.StructType([*(rows.schema[c] for c in rest), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return rows.select(text, *rest).mapInArrow(run, schema)


def _held(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of consecutive rows of at most ``HELD_CHARS`` (or one)."""
    first, held, size = 0, [], 0
    for row in range(len(column)):
        text = column[row].as_py() or ""
        if held and size + len(text) > HELD_CHARS:
            yield first, held
            first, held, size = row, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def mask_spans(rows: DataFrame, by: list[str], order: str, flag: Column) -> DataFrame:
    """Islands of consecutive rows where ``flag`` holds: first and last place
    (1-based, in ``order``) and length."""
    w = W.partitionBy(*by).orderBy(order)
    placed = rows.select(*by, order, flag.alias("flag")).withColumn("place", F.row_number().over(w).cast("long"))
    hit = placed.filter("flag").withColumn("island", F.col("place") - F.row_number().over(W.partitionBy(*by).orderBy("place")))
    return hit.groupBy(*by, "island").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("n")).drop("island")


def byte_ranges(rows: DataFrame, size: str, connections: int) -> DataFrame:
    """Ranges ``part, start, stop`` (stop inclusive) of files of ``size`` bytes:
    equal chunks rounded up, none past the end, the last one clipped."""
    n = F.least(F.lit(connections).cast("long"), F.col(size))
    chunk = F.ceil(F.col(size) / n)
    parts = rows.filter(F.col(size) > 0).withColumn("chunk", chunk.cast("long")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    start = F.col("part") * F.col("chunk")
    return parts.withColumn("start", start).filter(F.col("start") < F.col(size)).withColumn("stop", F.least(F.col("start") + F.col("chunk"), F.col(size)) - 1).drop("chunk")
