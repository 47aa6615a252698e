"""Overlaps with a small merged set by binary search, where the windows are.

The merged set is sorted by set and start, with running sums of its lengths. How
much of it lies before a place is one search and one sum, and an overlap is the
difference of two of them. Windows stay in their partitions: there is no exchange,
no bin and no aggregation on their side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.intervals import overlap_bp
from spanloom.session import written

#: Intervals that are sent to every task, 24 bytes each and their keys; larger sets
#: are joined on bins.
MOST_INDEXED = 1 << 20


class IntervalIndex:
    """Sorted starts, ends and sums of each set of disjoint intervals."""

    def __init__(self, keys: list[tuple], starts: np.ndarray, ends: np.ndarray):
        self.starts, self.ends, self.sums = starts, ends, np.concatenate(([0], np.cumsum(ends - starts)))
        self.sets: dict[tuple, tuple[int, int]] = {}
        first = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[first]:
                self.sets[keys[first]] = first, k
                first = k

    def covered(self, key: tuple, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Positions of each ``[start, end)`` that the set covers."""
        if key not in self.sets:
            return np.zeros(len(starts), np.int64)
        own = slice(*self.sets[key])
        lows, highs, sums = self.starts[own], self.ends[own], self.sums[own] - self.sums[own.start]

        def before(places: np.ndarray) -> np.ndarray:
            at = np.searchsorted(lows, places, "right") - 1
            reached = np.minimum(places, highs[np.maximum(at, 0)]) - lows[np.maximum(at, 0)]
            return np.where(at >= 0, sums[np.maximum(at, 0)] + reached, 0)

        return np.where(ends > starts, before(ends) - before(starts), 0)


def overlap_bp_by_index(windows: DataFrame, merged: DataFrame, by: list[str], name: str = "overlap_bp", most: int = MOST_INDEXED) -> DataFrame:
    """``overlap_bp`` by an index of ``merged`` that all tasks hold, where it has
    at most ``most`` intervals; by the join on bins where it has more. They are
    written down and counted in parallel first, and a larger set is not fetched.
    Nulls in ``by`` meet nothing."""
    valid = merged.filter(F.col("end") > F.col("start")).select(*by, F.col("start").cast("long"), F.col("end").cast("long"))
    for key in by:
        valid = valid.filter(F.col(f"`{key}`").isNotNull())
    valid = written(valid)
    if valid.count() > most:
        return overlap_bp(windows, valid, by, name, large=True)
    held = valid.toArrow().sort_by([(c, "ascending") for c in (*by, "start")])
    keys = list(zip(*(held.column(c).to_pylist() for c in by))) if by else [()] * held.num_rows
    index = windows.sparkSession.sparkContext.broadcast(IntervalIndex(keys, held.column("start").to_numpy(), held.column("end").to_numpy()))
    places = [windows.columns.index(c) for c in (*by, "start", "end")]
    names = [*windows.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *sets, starts, ends = (batch.column(k) for k in places)
            starts, ends = starts.cast(pa.int64()).to_numpy(zero_copy_only=False), ends.cast(pa.int64()).to_numpy(zero_copy_only=False)
            found = np.zeros(batch.num_rows, np.int64)
            group = np.zeros(batch.num_rows, np.int64)
            for column in sets:
                codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                group = np.unique(group * (batch.num_rows + 1) + codes + 1, return_inverse=True)[1]
            order = np.argsort(group, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                if len(rows):
                    key = tuple(column[int(rows[0])].as_py() for column in sets)
                    found[rows] = index.value.covered(key, starts[rows], ends[rows])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=names)

    return windows.mapInArrow(run, T.StructType([*windows.schema.fields, T.StructField(name, T.LongType())]))
