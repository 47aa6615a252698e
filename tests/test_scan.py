import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators.intervals import mask_spans, merge_intervals
from spanloom.operators.scan import levels, mask_spans_scanned, merge_scanned, prefix_sums


def plain(rows, gap=0):
    out = []
    for key, start, end in sorted((r for r in rows if r[2] > r[1]), key=lambda r: (r[0] is not None, str(r[0]), r[1], r[2])):
        if out and out[-1][0] == key and start <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], end)
        else:
            out.append([key, start, end])
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_merge_over_any_stretches(spark, seed):
    """Few and many sets, nested, touching and long intervals, null sets."""
    rng = random.Random(seed)
    keys = [["a"], ["a", "b", None], [f"k{i}" for i in range(40)], ["a"]][seed]
    rows = [(rng.choice(keys), s, s + rng.choice((0, 1, 3, 10, 400 if seed == 3 else 20))) for s in (rng.randrange(0, 2500) for _ in range(700))]
    if seed == 3:
        rows += [("a", 5, 2400), ("a", 6, 7)]
    frame = spark.createDataFrame(rows, "k string, start long, end long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for gap in (0, 4):
            assert sorted(map(tuple, merge_scanned(frame, ["k"], gap).collect()), key=str) == plain(rows, gap)
    finally:
        for key in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, merge_intervals(frame, ["k"]).collect()), key=str) == plain(rows)


def test_two_key_columns_no_rows_and_no_key(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(3), rng.choice("xy"), s, s + 5) for s in (rng.randrange(200) for _ in range(90))]
    frame = spark.createDataFrame(rows, "a int, b string, start long, end long")
    want = sorted(map(tuple, merge_intervals(frame, ["a", "b"]).collect()))
    assert sorted(map(tuple, merge_scanned(frame, ["a", "b"]).collect())) == want
    assert merge_scanned(frame.limit(0), ["a", "b"]).collect() == []


def test_one_set_of_many_disjoint_rows_is_spread(spark):
    """No stretch has more than its share, and none of the rows is lost."""
    n = 400_000
    frame = spark.range(n).select(F.lit("a").alias("k"), (F.col("id") * 3).alias("start"), (F.col("id") * 3 + 2).alias("end"))
    ranged = frame.repartitionByRange(8, "k", "start", "end").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] < n / 4
    got = merge_scanned(frame, ["k"])
    assert got.count() == n and merge_scanned(frame, ["k"], 1).collect() == [("a", 0, 3 * n - 1)]


def test_spans_of_a_mask(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), i, rng.random() < 0.6) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, i long, hit boolean")
    want = sorted(map(tuple, mask_spans(frame, ["k"], "i", F.col("hit")).select("k", "first", "last", "n").collect()))
    assert sorted(map(tuple, mask_spans_scanned(frame.repartition(5), ["k"], ["i"], F.col("hit")).collect())) == want


def test_running_sums_over_stretches(spark):
    rng = random.Random(10)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(-5, 9)) for i in range(500)]
    frame = spark.createDataFrame(rows, "k string, i long, x long").repartition(4)
    want = []
    for key in ("a", "b", None):
        own = [r for r in rows if r[0] == key]
        want += [(key, i, x, sum(r[2] for r in own[: n + 1]), own[n + 1][1] if n + 1 < len(own) else None) for n, (_, i, x) in enumerate(own)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_sums(frame, ["k"], "i", ["x"]).select("k", "i", "x", "x_sum", "next").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_levels_position_by_position(spark):
    rng = random.Random(11)
    spans = [(rng.choice("ab"), s, s + rng.randrange(0, 12), rng.randrange(1, 5)) for s in (rng.randrange(120) for _ in range(60))]
    runs = levels(spark.createDataFrame(spans, "k string, start long, end long, value long"), ["k"]).collect()
    got = {(r["k"], p): r["value"] for r in runs for p in range(r["start"], r["end"])}
    want = {}
    for k, s, e, v in spans:
        for p in range(s, e):
            want[k, p] = want.get((k, p), 0) + v
    assert got == want and len(got) == sum(r["end"] - r["start"] for r in runs)
