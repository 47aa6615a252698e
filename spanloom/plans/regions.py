"""End-to-end plans: masks and sequence to windows, windows to tensors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.text import sequence_codes
from spanloom.operators import signal as S
from spanloom.operators.intervals import filter_by_overlap, tile_overlap_bp, union_merge
from spanloom.sources.text import CHROMS, clean_runs, window_sequences

#: Default window, stride and largest masked share.
WINDOW, STRIDE, MOST_BAD = 262_144, 262_144, 0.5


def find_windows(sequence: DataFrame, unmappable: DataFrame, blacklist: DataFrame, *, size: int = WINDOW, stride: int = STRIDE, limit: float = MOST_BAD, chroms: tuple[str, ...] = CHROMS) -> DataFrame:
    """(chrom, start, end, bad_bp, bad_fraction) of the windows inside clean runs
    whose masked share is under ``limit``."""
    if not 0 <= limit <= 1:
        raise ValueError("the limit is a share")
    mask = union_merge(unmappable, blacklist, ["chrom"])
    runs = clean_runs(sequence.filter(F.col("chrom").isin(*chroms)))
    windows = tile_overlap_bp(runs, size, stride, mask, ["chrom"], "bad_bp")
    return filter_by_overlap(windows, limit, "bad_bp")


def shard_tensors(windows: DataFrame, sequence: DataFrame, signal: DataFrame, tracks: DataFrame, mask: DataFrame, totals: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of one or many shards: ``windows`` (codes and valid masks),
    ``tracks`` (factors, capped positions, extremes) and ``targets`` (dense,
    half-rounded). ``windows`` has ``window_index, chrom, start, end``; ``tracks``
    has ``track_index, track_id, sum_stat``. Totals default to all values."""
    factors = S.factors(S.header_totals(signal) if totals is None else totals)
    joined = tracks.join(factors, "track_id", "left")
    runs = S.transformed(S.window_signal(windows, signal, mask), joined)
    bp = windows.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    stats = joined.join(S.track_statistics(runs, bp), "track_id", "left")
    codes = window_sequences(windows, sequence).withColumn("sequence", sequence_codes(F.col("seq"))).drop("seq")
    return {
        "windows": codes.join(S.valid_masks(windows, mask), "window_index"),
        "tracks": stats.withColumn("capped_values", F.coalesce("capped_values", F.lit(0))),
        "targets": S.dense_targets(windows, tracks, runs),
    }
