import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.operators import splits as P


def test_greedy_then_search_never_gets_worse():
    counts = {"a": 50, "b": 30, "c": 20, "d": 20, "e": 10, "f": 5}
    total = sum(counts.values())
    first, best = P.greedy_assignment(counts), P.balanced_assignment(counts)
    assert first["a"] == "train"
    loads = [P.imbalance(P.split_loads(x, counts), total) for x in (first, best)]
    assert loads[1] <= loads[0] and set(best.values()) == set(P.SPLITS)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefghij"), st.integers(1, 90), min_size=3))
def test_search_ends_where_no_step_gains(counts):
    best = P.balanced_assignment(counts)
    total = sum(counts.values())
    here = P.imbalance(P.split_loads(best, counts), total)
    for step in P._neighbours(best):
        assert P.imbalance(P.split_loads({**best, **step}, counts), total) >= here - 1e-12


@pytest.mark.parametrize(
    ("sizes", "wanted", "given_"),
    [
        ({"train": 70, "val": 15, "test": 15}, 10, {"train": 8, "val": 1, "test": 1}),
        ({"train": 7, "val": 0, "test": 1}, 4, {"train": 3, "val": 0, "test": 1}),
        ({"train": 2, "val": 2, "test": 2}, 100, {"train": 2, "val": 2, "test": 2}),
        ({"train": 0, "val": 0, "test": 0}, 5, {"train": 0, "val": 0, "test": 0}),
    ],
)
def test_allocation(sizes, wanted, given_):
    got = P.allocate_shards(sizes, wanted)
    assert sum(got.values()) == min(wanted, sum(sizes.values()))
    assert sum(got.values()) == sum(given_.values())
    assert all(got[s] <= sizes[s] and (got[s] >= 1) == (sizes[s] > 0) for s in sizes)


def windows(spark, n=37):
    return spark.createDataFrame([(f"chr{1 + i % 5}", i * 10, i * 10 + 10) for i in range(n)], "chrom string, start long, end long")


def test_even_shards_cover_and_differ_by_one(spark):
    rows = windows(spark).withColumn("split", F.lit("train"))
    sharded = P.even_shards(P.shuffled(rows, 3, ["chrom", "start"]), {"train": 8}).collect()
    sizes = [sum(r["shard_index"] == i for r in sharded) for i in range(8)]
    assert sum(sizes) == 37 and sizes == [5, 5, 5, 5, 5, 4, 4, 4]


def test_fewer_rows_than_shards(spark):
    rows = windows(spark, 3).withColumn("split", F.lit("val"))
    sharded = P.even_shards(P.shuffled(rows, 3, ["chrom", "start"]), {"val": 3}).collect()
    assert sorted(r["shard_id"] for r in sharded) == ["val-00000", "val-00001", "val-00002"]


def test_exact_shuffle_is_pythons_own(spark):
    rows = windows(spark).withColumn("split", F.lit("test"))
    got = [(r["chrom"], r["start"]) for r in P.shuffled_exactly(rows, 9, ["chrom", "start"]).orderBy("place").collect()]
    want = sorted((r["chrom"], r["start"]) for r in rows.collect())
    random.Random(9 ^ P.OFFSETS["test"]).shuffle(want)
    assert got == want


@pytest.mark.parametrize("exact", [False, True])
def test_build_shards_keeps_groups_together(spark, exact):
    shards = P.build_shards(windows(spark), wanted=7, seed=1, exact=exact).collect()
    assert len(shards) == 7 and sum(s["num_windows"] for s in shards) == 37
    where = {}
    for s in shards:
        assert s["num_windows"] == len(s["windows"])
        for w in s["windows"]:
            assert where.setdefault(w["chrom"], s["split"]) == s["split"]


def plain_shards(regions, split_of, shards, seed):
    """The manifest by plain Python: file order, Python's shuffle, even cuts."""
    offsets, out = {"train": 0x13579BDF, "val": 0x2468ACE0, "test": 0x10203040}, {}
    for split, count in shards.items():
        own = [r for r in regions if split_of[r[0]] == split]
        random.Random(seed ^ offsets[split]).shuffle(own)
        base, more = divmod(len(own), count)
        for i in range(count):
            size = base + (i < more)
            out[f"{split}-{i:05d}"] = own[:size]
            own = own[size:]
    return out


def test_shards_follow_the_file(spark, tmp_path):
    from spanloom.sources.text import read_regions

    rng = random.Random(5)
    regions = [(f"chr{n}", k * 100, k * 100 + 100) for n in (1, 2, 10, 11, 3, 21) for k in range(rng.randint(5, 60))]
    rng.shuffle(regions)
    (tmp_path / "regions.bed").write_text("#chrom\tstart\tend\n" + "".join(f"{c}\t{a}\t{b}\n" for c, a, b in regions))
    rows = read_regions(spark, str(tmp_path / "regions.bed"), lines=True)
    got = {r["shard_id"]: [(w["chrom"], w["start"], w["end"]) for w in r["windows"]] for r in P.build_shards(rows, wanted=20).collect()}
    counts = {c: sum(r[0] == c for r in regions) for c, _, _ in regions}
    split_of = P.balanced_assignment(counts)
    sizes = P.split_loads(split_of, counts)
    assert got == plain_shards(regions, split_of, P.allocate_shards(sizes, 20), 71798669716578)


def test_rows_are_numbered_in_parallel(spark):
    rows = spark.range(0, 1000).select(F.when(F.col("id") % 7 == 0, "val").otherwise("train").alias("split"), (F.col("id") % 90).alias("k"), "id")
    got = P.placed(rows, [F.col("k"), -F.col("id")], "place").collect()
    for split in ("train", "val"):
        want = sorted((r["k"], -r["id"]) for r in got if r["split"] == split)
        own = {r["place"]: (r["k"], -r["id"]) for r in got if r["split"] == split}
        assert own == dict(enumerate(want))
    assert P.placed(rows.limit(0), [F.col("k")], "place").count() == 0
