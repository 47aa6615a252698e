"""Merging and numbering of sets that are too large for one task.

Rows are ranged by set and start over all tasks, so a set may lie in many of them.
Each task merges its own stretch as it streams by. A running maximum of ends over
the stretches, a table of two rows a task at most, then says which islands at the
head of a stretch belong to one that began before it, and how far that one reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.session import written


def _new_sets(columns: list[pa.Array], n: int) -> np.ndarray:
    """Whether a row's set differs from that of the row before; the first does."""
    new = np.zeros(n, bool)
    new[:1] = True
    for column in columns:
        codes = column.dictionary_encode().indices
        values = codes.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return new


def _islands(new: np.ndarray, starts: np.ndarray, ends: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """First row of each island of sorted rows, and the islands' ends."""
    order = np.argsort(ends, kind="stable")
    rank = np.empty(len(ends), np.int64)
    rank[order] = np.arange(len(ends))
    # Ranks rise from set to set, so the running maximum starts anew with each.
    reached = ends[order][np.maximum.accumulate(rank + (np.cumsum(new) - 1) * len(ends)) % len(ends)]
    opens = new.copy()
    opens[1:] |= starts[1:] > reached[:-1] + gap
    first = np.flatnonzero(opens)
    return first, np.maximum.reduceat(ends, first)


def _local(rows: DataFrame, by: list[str], gap: int) -> DataFrame:
    """The islands of each stretch with ``part``, ``head`` (of the first set there)
    and ``last`` (the last one there)."""
    kinds = [rows.schema[c] for c in by]
    n_by = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None
        in_head = True  # the open island belongs to the first set so far

        def made(table: pa.Table, head: np.ndarray, last: bool) -> pa.RecordBatch:
            n = table.num_rows
            marks = [pa.array(np.full(n, part, np.int32)), pa.array(head), pa.array(np.full(n, last))]
            return pa.RecordBatch.from_arrays([*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns], *marks], names=[*by, "start", "end", "part", "head", "last"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            columns = [table.column(k).combine_chunks() for k in range(n_by)]
            starts, ends = (table.column(n_by + k).to_numpy() for k in range(2))
            new = _new_sets(columns, table.num_rows)
            first, reached = _islands(new, starts, ends, gap)
            sets = np.cumsum(new)[first]
            head = (sets == 1) & in_head
            islands = pa.Table.from_arrays([*(c.take(pa.array(first)) for c in columns), pa.array(starts[first]), pa.array(reached)], names=[*by, "start", "end"])
            if len(first) > 1:
                yield made(islands.slice(0, len(first) - 1), head[:-1], False)
            held = islands.slice(len(first) - 1).combine_chunks().to_batches()[0].cast(batch.schema)
            in_head = bool(head[-1])
        if held is not None:
            yield made(pa.Table.from_batches([held]), np.array([in_head]), True)

    schema = T.StructType([*kinds, T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("head", T.BooleanType()), T.StructField("last", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def merge_scanned(rows: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """``merge_intervals`` in which no task has more than its share of the rows,
    however few the sets: one exchange by ranges, then tables of two rows a task."""
    valid = rows.filter(F.col("end") > F.col("start")).select(*by, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    ranged = valid.repartitionByRange(*by, "start", "end").sortWithinPartitions(*by, "start", "end")
    local = written(_local(ranged, by, gap))
    border = F.col("head") | F.col("last")
    edges = local.filter(border)
    along = W.partitionBy(*by).orderBy("part")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    same = lambda left, right: [left[c].eqNullSafe(right[c]) for c in (*by, "part")]

    # How far the stretches before reach in the set that goes on here.
    carry = edges.groupBy(*by, "part").agg(F.max("end").alias("high")).withColumn("reach", F.max("high").over(before)).drop("high").alias("c")
    given = edges.alias("e").join(carry, same(_columns("e", by), _columns("c", by)), "left").select("e.*", "c.reach")
    given = given.withColumn("absorbed", F.coalesce(F.col("head") & (F.col("start") <= F.col("reach") + gap), F.lit(False)))
    # What is absorbed lengthens the last island of its set that is not.
    parts = given.groupBy(*by, "part").agg(F.max(F.when(F.col("absorbed"), F.col("end"))).alias("more"), F.bool_or(~F.col("absorbed")).cast("int").alias("open"))
    parts = parts.withColumn("upto", F.coalesce(F.sum("open").over(before), F.lit(0))).withColumn("own", F.col("upto") + F.col("open"))
    longer = parts.filter("more is not null").groupBy(*by, F.col("upto").alias("own")).agg(F.max("more").alias("more"))
    ends = parts.filter("open = 1").select(*by, "part", "own").alias("p").join(longer.alias("l"), [F.col(f"p.{c}").eqNullSafe(F.col(f"l.{c}")) for c in (*by, "own")]).select(*[F.col(f"p.{c}").alias(c) for c in by], "p.part", "l.more").alias("x")
    kept = given.filter("not absorbed").alias("k").join(ends, [*same(_columns("k", by), _columns("x", by)), F.col("k.last")], "left")
    closed = kept.select(*[F.col(f"k.{c}").alias(c) for c in by], F.col("k.start").alias("start"), F.greatest("k.end", "x.more").alias("end"))
    return local.filter(~border).select(*by, "start", "end").unionByName(closed)


def _columns(alias: str, by: list[str]) -> dict[str, Column]:
    return {c: F.col(f"{alias}.{c}") for c in (*by, "part")}


def mask_spans_scanned(rows: DataFrame, by: list[str], order: list[str], flag: Column) -> DataFrame:
    """``mask_spans`` for sets of any size: rows are numbered in parallel, and
    neighbouring places where ``flag`` holds are touching intervals that merge."""
    from spanloom.operators.splits import placed

    one = F.xxhash64(*by) if by else F.lit(0)
    numbered = placed(rows.select(*by, *order, flag.alias("__flag"), one.alias("split")), [*map(F.col, by), *map(F.col, order)], "place")
    # Rows of one set follow each other; a set begins where its least place is.
    begins = numbered.groupBy("split", *by).agg(F.min("place").alias("__begin"))
    within = numbered.filter("__flag").alias("n").join(begins.alias("b"), [F.col("n.split") == F.col("b.split"), *[F.col(f"n.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]])
    hits = within.select(*[F.col(f"n.{c}").alias(c) for c in by], (F.col("place") - F.col("__begin")).alias("start"), (F.col("place") - F.col("__begin") + 1).alias("end"))
    return merge_scanned(hits, by).select(*by, (F.col("start") + 1).alias("first"), F.col("end").alias("last"), (F.col("end") - F.col("start")).alias("n"))


def prefix_sums(rows: DataFrame, by: list[str], order: str, values: list[str]) -> DataFrame:
    """``rows`` with ``<value>_sum``, the running sums of each set in ``order`` with
    the row's own value, and ``next``, the ``order`` of the row after it in its set.

    Rows are ranged over all tasks by set and order and written once. Each task
    sums its own stretch; sums and first places of the stretches, a row for each
    stretch and set, carry over what lies before and behind. ``order`` is distinct
    within a set.
    """
    held = written(rows.repartitionByRange(*by, order).sortWithinPartitions(*by, order).withColumn("__part", F.spark_partition_id()))
    stretches = held.groupBy("__part", *by).agg(*[F.sum(v).alias(f"__{v}") for v in values], F.min(order).alias("__first"))
    along = W.partitionBy(*by).orderBy("__part")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    carried = stretches.select("__part", *by, *[F.coalesce(F.sum(f"__{v}").over(before), F.lit(0)).alias(f"__{v}") for v in values], F.lead("__first").over(along).alias("__next"))
    met = held.alias("h").join(carried.alias("c"), [F.col(f"h.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("__part", *by)]).select("h.*", *[f"c.__{v}" for v in values], "c.__next")
    local = W.partitionBy("__part", *by).orderBy(order)
    sums = {f"{v}_sum": F.sum(v).over(local.rowsBetween(W.unboundedPreceding, W.currentRow)) + F.col(f"__{v}") for v in values}
    done = met.withColumns({**sums, "next": F.coalesce(F.lead(order).over(local), F.col("__next"))})
    return done.drop("__part", "__next", *[f"__{v}" for v in values])


def levels(spans: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Overlapping spans as disjoint runs ``(..., start, end, value)`` that carry the
    sum of the values of all spans over them; a run ends where a span begins or
    ends. Empty spans add nothing."""
    edge = lambda place, sign: F.struct(F.col(place).alias("start"), F.lit(sign).alias("depth"), (F.col(value) * sign).alias("level"))
    edges = spans.filter(F.col("end") > F.col("start")).select(*by, F.explode(F.array(edge("start", 1), edge("end", -1))).alias("e"))
    steps = edges.groupBy(*by, F.col("e.start").alias("start")).agg(F.sum("e.depth").alias("depth"), F.sum("e.level").alias("level"))
    summed = prefix_sums(steps, by, "start", ["depth", "level"])
    return summed.filter("depth_sum > 0").select(*by, "start", F.col("next").alias("end"), F.col("level_sum").alias(value))
