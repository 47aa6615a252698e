"""Signals as run-length rows ``(track_id, chrom, start, end, value)``.

Every transform is pointwise and maps 0 to 0, so it works on runs; masking is
interval subtraction, and counts are sums of run lengths. Dense arrays are made
only at the sink, one (window, track) row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.numeric import HALF_MAX, TARGET_TOTAL, cap, guard_finite, normalisation_factor, stride_for, transform_value, zero_missing
from spanloom.operators.intervals import BIN, overlap_pairs, subtract_intervals

PLACE = ["chrom"]
#: Values of one output batch (or one window).
DENSE_VALUES = 1 << 21


def header_totals(signal: DataFrame) -> DataFrame:
    """(track_id, total): all values, masked ones included."""
    return signal.groupBy("track_id").agg(F.sum(zero_missing(F.col("value").cast("double")) * (F.col("end") - F.col("start"))).alias("total"))


def valid_totals(signal: DataFrame, mask: DataFrame) -> DataFrame:
    """(track_id, total) over the positions outside ``mask`` (merged)."""
    return header_totals(subtract_intervals(signal, mask, PLACE))


def factors(totals: DataFrame, target: float = TARGET_TOTAL) -> DataFrame:
    return totals.withColumn("factor", normalisation_factor(F.col("total"), target))


def check_bounds(windows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Windows per track of ``sizes(track_id, chrom, length)``: an absent
    chromosome passes (it reads as zeros), a window past its end fails."""
    joined = windows.join(sizes, "chrom")
    outside = (F.col("start") < 0) | (F.col("end") > F.col("length"))
    return joined.filter(F.when(outside, F.raise_error(F.lit("a window lies outside its chromosome")).cast("boolean")).otherwise(F.lit(True)))


def window_signal(windows: DataFrame, signal: DataFrame, mask: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Unmasked runs of every track clipped to every window they meet:
    ``(window columns, track_id, r_start, r_end, value)``."""
    clean = subtract_intervals(signal, mask, PLACE)
    met = overlap_pairs(windows, clean, PLACE, bin_size)
    return met.withColumn("r_start", F.greatest("start", "i_start")).withColumn("r_end", F.least("end", "i_end")).drop("i_start", "i_end")


def transformed(runs: DataFrame, tracks: DataFrame, limit: float = HALF_MAX, strict: bool = True) -> DataFrame:
    """Scaled, powered and capped values of runs; ``tracks`` has ``track_id,
    factor, sum_stat``. ``uncapped`` is the value before the cap, and ``capped``
    marks the runs above the limit."""
    value = transform_value(F.col("value").cast("float"), F.col("factor"), F.col("sum_stat"), strict)
    joined = runs.join(tracks.select("track_id", "factor", "sum_stat"), "track_id").withColumn("uncapped", value)
    return joined.withColumn("capped", F.col("uncapped") > limit).withColumn("value", guard_finite(cap(F.col("uncapped"), limit)))


def _extremes(low: Column, high: Column, covered: Column, bp: Column) -> tuple[Column, Column]:
    """The extremes with the zeros between runs, where any position has none."""
    gap = F.coalesce(covered, F.lit(0)) < bp
    zero = F.lit(0.0).cast("float")
    return F.when(gap, F.least(low, zero)).otherwise(low), F.when(gap, F.greatest(high, zero)).otherwise(high)


def track_statistics(runs: DataFrame, window_bp: Column | int) -> DataFrame:
    """(track_id, capped_values, low, high): positions above the cap, and the
    extremes before the cap."""
    bp = F.lit(window_bp) if isinstance(window_bp, int) else window_bp
    lengths = F.col("r_end") - F.col("r_start")
    sums = runs.groupBy("track_id").agg(F.sum(F.when(F.col("capped"), lengths).otherwise(0)).alias("capped_values"), F.min("uncapped").alias("low"), F.max("uncapped").alias("high"), F.sum(lengths).alias("covered"))
    low, high = _extremes(F.col("low"), F.col("high"), F.col("covered"), bp)
    return sums.select("track_id", "capped_values", low.alias("low"), high.alias("high"))


def _dense_runs(windows: DataFrame, tracks: DataFrame, runs: DataFrame, statistics: bool) -> tuple[DataFrame, list[str]]:
    """A row for every window and track with its runs as arrays, and the names of
    the columns of ``statistics``."""
    pairs = windows.select("window_index", "start", "end").crossJoin(tracks.select("track_index", "track_id"))
    lengths = F.col("r_end") - F.col("r_start")
    made = [F.collect_list("r_start").alias("starts"), F.collect_list("r_end").alias("ends"), F.collect_list(F.col("value").cast("float")).alias("levels")]
    if statistics:
        made += [F.sum(F.when(F.col("capped"), lengths).otherwise(0)).alias("capped_values"), F.min("uncapped").alias("low"), F.max("uncapped").alias("high"), F.sum(lengths).alias("covered")]
    own = runs.groupBy("window_index", "track_id").agg(*made)
    joined = pairs.join(own, ["window_index", "track_id"], "left")
    further: list[str] = []
    if statistics:
        low, high = _extremes(F.col("low"), F.col("high"), F.col("covered"), F.col("end") - F.col("start"))
        joined = joined.withColumns({"capped_values": F.coalesce("capped_values", F.lit(0).cast("long")), "low": low.cast("float"), "high": high.cast("float")})
        further = ["capped_values", "low", "high"]
    return joined.select("window_index", "track_index", "start", "end", "starts", "ends", "levels", *further), further


def dense_statistics(windows: DataFrame, tracks: DataFrame, runs: DataFrame) -> DataFrame:
    """``(window_index, track_index, capped_values, low, high)`` as ``dense_targets``
    gives them, where the values themselves are not asked for: no row is filled."""
    joined, further = _dense_runs(windows, tracks, runs, True)
    return joined.select("window_index", "track_index", *further)


def _filled(begins: np.ndarray, cuts: np.ndarray, starts: pa.ListArray, ends: pa.ListArray, levels: pa.ListArray) -> np.ndarray:
    """The half-rounded values of rows, one after another from ``cuts``. Rounding is
    pointwise and keeps 0, so it is done once for each run."""
    values = np.zeros(int(cuts[-1]), np.float32)
    sizes = pa.compute.list_value_length(starts).fill_null(0).to_numpy(zero_copy_only=False)
    shift = np.repeat(cuts[:-1] - begins, sizes)
    first, stop = (np.asarray(c.flatten()) + shift for c in (starts, ends))
    with np.errstate(over="ignore"):
        half = np.asarray(levels.flatten()).astype(np.float16).astype(np.float32)
    for a, b, level in zip(first.tolist(), stop.tolist(), half.tolist()):
        values[a:b] = level
    return values


def dense_targets(windows: DataFrame, tracks: DataFrame, runs: DataFrame, statistics: bool = False, digest: tuple[str, Callable[[np.ndarray, np.ndarray], list[pa.Array]]] | None = None) -> DataFrame:
    """``(window_index, track_index, values array<float>)`` for every window and
    track, half-rounded; positions without a run are 0.

    The product of windows and tracks is the output's own size; runs join it on
    their keys, and one row is one window of one track. With ``statistics`` a row
    also carries ``capped_values, low, high`` of its positions before the cap, so
    they come out of the same pass over the signal. ``digest`` is the schema of
    columns that take the place of ``values`` and what makes them of the values of
    some rows, one after another, and the rows' borders: the values are filled and
    used in the same task and do not pass between it and Spark.
    """
    joined, further = _dense_runs(windows, tracks, runs, statistics)
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    made, work = digest or ("values array<float>", lambda values, cuts: [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))])
    schema = ", ".join([f"window_index {kinds['window_index']}", f"track_index {kinds['track_index']}", made, *[f"{c} {kinds[c]}" for c in further]])
    names = ["window_index", "track_index", *[c.split()[0] for c in made.split(", ")], *further]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, stops = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            first = 0
            while first < batch.num_rows:
                ends = np.cumsum(stops[first:] - begins[first:])
                last = first + max(1, int(np.searchsorted(ends, DENSE_VALUES, "right")))
                cuts = np.concatenate(([0], ends[: last - first]))
                values = _filled(begins[first:last], cuts, *(batch.column(k).slice(first, last - first) for k in (4, 5, 6)))
                kept = [batch.column(k).slice(first, last - first) for k in (0, 1, *range(7, batch.num_columns))]
                yield pa.RecordBatch.from_arrays([*kept[:2], *work(values, cuts), *kept[2:]], names=names)
                first = last

    return joined.mapInArrow(fill, schema)


def valid_masks(windows: DataFrame, mask: DataFrame) -> DataFrame:
    """``(window_index, valid array<boolean>)``: true outside the merged mask."""
    free = subtract_intervals(windows.select("chrom", "start", "end", "window_index", F.col("start").alias("w_start"), F.col("end").alias("w_end")), mask, PLACE)
    spans = free.groupBy("window_index").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("free"))
    joined = windows.select("window_index", "start", "end").join(spans, "window_index", "left")
    flags = lambda b, n: F.array_repeat(F.lit(b), n.cast("int"))
    before = F.transform("free", lambda r, i: r["start"] - F.when(i > 0, F.get(F.col("free"), i - 1)["end"]).otherwise(F.col("start")))
    body = F.flatten(F.zip_with(before, "free", lambda gap, r: F.concat(flags(False, gap), flags(True, r["end"] - r["start"]))))
    tail = flags(False, F.col("end") - F.element_at("free", -1)["end"])
    return joined.select("window_index", F.when(F.col("free").isNull(), flags(False, F.col("end") - F.col("start"))).otherwise(F.concat(body, tail)).alias("valid"))


def view_signal(values: DataFrame, total: float, statistic: str, target: float = TARGET_TOTAL) -> DataFrame:
    """``(x, raw, masked)`` positions as a viewer shows them: masked ones null,
    any other statistic linear, no cap."""
    processed = transform_value(F.col("raw"), F.lit(target / total), F.lit(statistic), strict=False)
    return values.withColumn("processed", F.when(~F.col("masked"), processed))


def downsample(points: DataFrame, by: list[str], place: str, x: str, y: str, most: int) -> DataFrame:
    """Means of ``x`` and ``y`` over runs of ``ceil(n / most)`` points in order;
    a remainder at the end is left out, null and NaN values of ``y`` are skipped.
    ``place`` numbers the points of a series from 0."""
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    stride = stride_for(F.col("n"), most)
    joined = points.join(sizes, by).withColumn("stride", stride).withColumn("point", F.floor(F.col(place) / F.col("stride")))
    whole = joined.filter((F.col("point") + 1) * F.col("stride") <= F.col("n"))
    return whole.groupBy(*by, "point").agg(F.avg(x).alias(x), F.avg(F.when(~F.isnan(y), F.col(y))).alias(y))


def every_kth(points: DataFrame, by: list[str], place: str, most: int) -> DataFrame:
    """Every k-th row, so that about ``most`` are left of each series."""
    sizes = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return points.join(sizes, by).filter(F.col(place) % stride_for(F.col("n"), most) == 0).drop("n")


def viewport(start: Column, length: Column, window: Column) -> tuple[Column, Column]:
    """Start and end of a view inside ``[0, length)``."""
    first = F.least(F.greatest(start, F.lit(0)), F.greatest(length - 1, F.lit(0)))
    return first, F.least(length, first + window)
