"""Leakage-free splits, shard allocation and even sharding.

Groups (chromosomes) are few, so their counts are aggregated in Spark and the
assignment is searched on the driver; the windows themselves never leave Spark.
"""

from __future__ import annotations

import itertools
import math
import random
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions.text import shard_name
from spanloom.session import written

#: Splits in order, their shares, the seeds' offsets.
SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}
OFFSETS = {"train": 0x13579BDF, "val": 0x2468ACE0, "test": 0x10203040}
SPLITS = tuple(SHARES)
#: Fixed value: the seed of published manifests.
SEED = 71798669716578
#: Places of a drawn permutation in one batch.
PLACES = 1 << 18
#: A step of the search must gain more than this.
LEAST_GAIN = 1e-15


def group_counts(windows: DataFrame, group: str) -> dict[str, int]:
    """Windows of each group; the groups are a bounded list of names."""
    return {r[group]: r["n"] for r in windows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()}


def imbalance(loads: Mapping[str, float], total: int) -> float:
    """Sum of squared relative errors against the shares."""
    return sum((loads[s] / (SHARES[s] * total) - 1) ** 2 for s in SPLITS)


def split_loads(assigned: Mapping[str, str], counts: Mapping[str, int]) -> dict[str, int]:
    loads = dict.fromkeys(SPLITS, 0)
    for group, split in assigned.items():
        loads[split] += counts[group]
    return loads


def greedy_assignment(counts: Mapping[str, int]) -> dict[str, str]:
    """Largest groups first, each to the split that is furthest below its share."""
    total, loads, assigned = sum(counts.values()), dict.fromkeys(SPLITS, 0), {}
    for group, n in sorted(counts.items(), key=lambda item: (-item[1], item[0])):
        need = {s: (1 - loads[s] / (SHARES[s] * total), -loads[s]) for s in SPLITS}
        assigned[group] = max(SPLITS, key=need.__getitem__)
        loads[assigned[group]] += n
    return assigned


def _neighbours(assigned: dict[str, str]):
    """Changes one step away: single moves that leave no split empty, then swaps."""
    members = {s: sum(v == s for v in assigned.values()) for s in SPLITS}
    names = sorted(assigned)
    for name, split in itertools.product(names, SPLITS):
        if split != assigned[name] and members[assigned[name]] > 1:
            yield {name: split}
    for a, b in itertools.combinations(names, 2):
        if assigned[a] != assigned[b]:
            yield {a: assigned[b], b: assigned[a]}


def balanced_assignment(counts: Mapping[str, int]) -> dict[str, str]:
    """The greedy assignment improved by the best change until none gains."""
    assigned, total = greedy_assignment(counts), sum(counts.values())
    while assigned:
        loads = split_loads(assigned, counts)
        best, change = imbalance(loads, total), None
        for step in _neighbours(assigned):
            trial = dict(loads)
            for group, split in step.items():
                trial[assigned[group]] -= counts[group]
                trial[split] += counts[group]
            if (value := imbalance(trial, total)) < best - LEAST_GAIN:
                best, change = value, step
        if change is None:
            break
        assigned |= change
    return assigned


def assign_splits(windows: DataFrame, group: str) -> DataFrame:
    """``windows`` with ``split``; whole groups go to one split."""
    assigned = balanced_assignment(group_counts(windows, group))
    rows = windows.sparkSession.createDataFrame(list(assigned.items()), f"{group} string, split string")
    return windows.join(rows, group)


def allocate_shards(sizes: Mapping[str, int], wanted: int) -> dict[str, int]:
    """Shards of each split: the floor of its share, one at least where it has
    items and never more than items. What is missing goes to the split with the
    largest remainder as long as it has room, what is over comes from the one
    with the smallest; equal remainders share by items per shard."""
    total = sum(sizes.values())
    if not total:
        return dict.fromkeys(sizes, 0)
    wanted = min(wanted, total)
    exact = {s: wanted * n / total for s, n in sizes.items()}
    given = {s: min(max(1, math.floor(exact[s])), n) if n else 0 for s, n in sizes.items()}
    rest = {s: exact[s] - math.floor(exact[s]) for s in sizes}
    for _ in range(abs(wanted - sum(given.values()))):
        grow = sum(given.values()) < wanted
        open_ = [s for s in sizes if (given[s] < sizes[s] if grow else given[s] > 1)]
        if not open_:
            break
        rank = {s: (rest[s], sizes[s] / max(given[s], 1)) for s in open_}
        given[(max if grow else min)(open_, key=rank.__getitem__)] += 1 if grow else -1
    return given


def placed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` numbered from 0 in each ``split`` in the order given.

    Rows are ranged over as many tasks as there are partitions, whatever the
    splits; each task numbers its own, and the counts of the tasks before it are
    added. The sorted rows are written, so that both passes see the same ones.
    """
    keys = [f"__{i}" for i in range(len(order))]
    keyed = rows.select("*", *[c.alias(k) for c, k in zip(order, keys)])
    spread = keyed.repartitionByRange("split", *keys).sortWithinPartitions("split", *keys).drop(*keys)
    place = F.monotonically_increasing_id()
    held = written(spread.select("*", F.shiftright(place, 33).alias("__part"), place.bitwiseAND((1 << 33) - 1).alias("__row")))
    counts = held.groupBy("split", "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("first"))
    # A row for each task and split.
    before = F.coalesce(F.sum("n").over(W.partitionBy("split").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("split", "__part", (before - F.col("first")).alias("__shift"))
    return held.join(starts, ["split", "__part"]).withColumn(name, F.col("__row") + F.col("__shift")).drop("__part", "__row", "__shift")


def shuffled(windows: DataFrame, seed: int, key: list[str], order: str = "place") -> DataFrame:
    """``windows`` with a reproducible random ``place`` (from 0) in each split:
    the order of a keyed hash, drawn and numbered in parallel."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    return placed(windows, [drawn, *map(F.col, key)], order)


def shuffled_exactly(windows: DataFrame, seed: int, key: list[str], offsets: Mapping[str, int] = OFFSETS) -> DataFrame:
    """Like ``shuffled`` in the very order of Python's generator, seeded with
    ``seed ^ offset`` per split and shuffling the rows in the order of ``key``.
    That generator draws one place after the other, so a split's permutation is
    made in one task (8 bytes a row there); the rows themselves stay spread."""
    sizes = windows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split, n in zip(*(c.to_pylist() for c in batch.columns)):
                order = array("q", range(n))
                random.Random(seed ^ offsets.get(split, 0)).shuffle(order)
                ranks = np.frombuffer(order, np.int64)
                for first in range(0, n, PLACES):
                    part = ranks[first : first + PLACES]
                    yield pa.RecordBatch.from_arrays([pa.array([split] * len(part)), pa.array(part), pa.array(np.arange(first, first + len(part)))], names=["split", "rank", "place"])

    places = sizes.repartition("split").mapInArrow(draw, "split string, rank long, place long")
    return placed(windows, [F.col(k) for k in key], "rank").join(places, ["split", "rank"]).drop("rank")


def even_shards(rows: DataFrame, shards: Mapping[str, int], order: str = "place") -> DataFrame:
    """``shard_index`` and ``shard_id`` for rows numbered from 0 in each split:
    sizes differ by one at most, larger shards first."""
    spark = rows.sparkSession
    sizes = rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    plan = spark.createDataFrame(list(shards.items()), "split string, n_shards long")
    joined = rows.join(sizes.join(plan, "split"), "split")
    base, more = F.floor(F.col("n") / F.col("n_shards")), F.col("n") % F.col("n_shards")
    head = more * (base + 1)
    index = F.when(F.col(order) < head, F.floor(F.col(order) / (base + 1))).otherwise(more + F.floor((F.col(order) - head) / F.greatest(base, F.lit(1))))
    return joined.withColumn("shard_index", index.cast("int")).withColumn("shard_id", shard_name(F.col("split"), F.col("shard_index"))).drop("n", "n_shards")


def shard_manifest(sharded: DataFrame, order: str = "place") -> DataFrame:
    """One row per shard with its windows nested in order."""
    one = F.struct(F.col(order).alias("place"), "chrom", "start", "end")
    nested = F.transform(F.sort_array(F.collect_list(one)), lambda w: F.struct(w["chrom"].alias("chrom"), w["start"].alias("start"), w["end"].alias("end")))
    return sharded.groupBy("shard_id", "split").agg(F.count(F.lit(1)).cast("int").alias("num_windows"), nested.alias("windows"))


def build_shards(windows: DataFrame, *, wanted: int = 1000, seed: int = SEED, exact: bool = True) -> DataFrame:
    """Windows to the nested shard manifest: split, shuffle, allocate, shard.

    ``exact`` shuffles as Python's generator does, from the order of ``line``
    (the place in the file) where there is one, else of the windows; without it
    a keyed hash gives the order."""
    split = assign_splits(windows, "chrom")
    key = ["chrom", "start", "end"]
    order = shuffled_exactly(split, seed, ["line"] if "line" in windows.columns else key) if exact else shuffled(split, seed, key)
    sizes = {s: 0 for s in SPLITS} | group_counts(split, "split")
    return shard_manifest(even_shards(order, allocate_shards(sizes, wanted)))
