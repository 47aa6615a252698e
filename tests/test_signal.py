import math

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanloom.operators import signal as S
from spanloom.plans.regions import find_windows, shard_tensors

SIGNAL = "track_id string, chrom string, start long, end long, value float"
SPAN = "chrom string, start long, end long"


@pytest.fixture(scope="module")
def tables(spark):
    signal = spark.createDataFrame([("t", "c", 0, 4, 2.0), ("t", "c", 6, 10, float("nan")), ("t", "c", 10, 12, 5.0), ("u", "c", 2, 8, 1e6), ("u", "d", 0, 2, -3.0)], SIGNAL)
    return signal, spark.createDataFrame([("c", 3, 7), ("c", 11, 20)], SPAN)


def test_totals_with_and_without_the_mask(tables):
    signal, mask = tables
    assert {r["track_id"]: r["total"] for r in S.header_totals(signal).collect()} == {"t": 18.0, "u": 5999994.0}
    assert {r["track_id"]: r["total"] for r in S.valid_totals(signal, mask).collect()} == {"t": 11.0, "u": 1999994.0}


def test_dense_tensor_by_hand(spark, tables):
    signal, mask = tables
    windows = spark.createDataFrame([(0, "c", 0, 8), (1, "c", 8, 16), (2, "x", 0, 4)], "window_index long, chrom string, start long, end long")
    tracks = spark.createDataFrame([(0, "t", "sum"), (1, "u", "sum_sqrt")], "track_index int, track_id string, sum_stat string")
    factors = spark.createDataFrame([("t", 2.0), ("u", 1.0)], "track_id string, factor double")
    runs = S.transformed(S.window_signal(windows, signal, mask, 4), tracks.join(factors, "track_id"))
    got = {(r["window_index"], r["track_index"]): list(r["values"]) for r in S.dense_targets(windows, tracks, runs).collect()}
    big = float(pytest.importorskip("numpy").float16(1e6**0.75))
    assert got[0, 0] == [4, 4, 4, 0, 0, 0, 0, 0] and got[1, 0] == [0, 0, 10, 0, 0, 0, 0, 0] and got[2, 1] == [0] * 4
    assert got[0, 1] == [0, 0, big, 0, 0, 0, 0, big]
    stats = {r["track_id"]: r for r in S.track_statistics(runs, 20).collect()}
    assert stats["u"]["capped_values"] == 0 and stats["t"]["low"] == 0 and stats["t"]["high"] == 10
    masks = {r["window_index"]: r["valid"] for r in S.valid_masks(windows, mask).collect()}
    assert masks[0] == [True] * 3 + [False] * 4 + [True] and masks[2] == [True] * 4


def test_cap_is_counted_before_it_applies(spark):
    runs = spark.createDataFrame([("t", 0, 5, 7e4), ("t", 5, 6, 1.0)], "track_id string, r_start long, r_end long, value double")
    tracks = spark.createDataFrame([("t", 1.0, "sum")], "track_id string, factor double, sum_stat string")
    done = S.transformed(runs, tracks)
    assert S.track_statistics(done, 6).first().asDict() == {"track_id": "t", "capped_values": 5, "low": 1.0, "high": 7e4}
    with pytest.raises(PySparkException):
        S.transformed(runs, tracks.withColumn("sum_stat", F.lit("odd"))).collect()


def test_bounds(spark):
    windows = spark.createDataFrame([("c", 0, 10), ("x", 0, 99)], SPAN)
    sizes = spark.createDataFrame([("t", "c", 10)], "track_id string, chrom string, length long")
    assert S.check_bounds(windows, sizes).count() == 1
    with pytest.raises(PySparkException):
        S.check_bounds(windows.withColumn("end", F.col("end") + 1), sizes).collect()


def test_downsampling(spark):
    points = spark.createDataFrame([("s", i, float(i), float("nan") if i == 1 else float(i)) for i in range(11)], "s string, place long, x double, y double")
    got = [(r["x"], r["y"]) for r in S.downsample(points, ["s"], "place", "x", "y", 5).orderBy("point").collect()]
    assert got == [(1.0, 1.0), (4.0, 4.0), (7.0, 7.0)]
    assert [r["y"] for r in S.downsample(points, ["s"], "place", "x", "y", 11).orderBy("point").collect()][2] == 2.0
    assert [r["place"] for r in S.every_kth(points, ["s"], "place", 4).orderBy("place").collect()] == [0, 3, 6, 9]


def test_view(spark):
    values = spark.createDataFrame([(0, 4.0, False), (1, 4.0, True), (2, None, False)], "x long, raw double, masked boolean")
    got = [r["processed"] for r in S.view_signal(values, 2.0, "odd", 8.0).orderBy("x").collect()]
    assert got == [16.0, None, 0.0]
    first, last = S.viewport(F.lit(-5), F.lit(100), F.lit(30))
    assert tuple(spark.range(1).select(first.alias("a"), last.alias("b")).first()) == (0, 30)
    first, last = S.viewport(F.lit(500), F.lit(100), F.lit(30))
    assert tuple(spark.range(1).select(first.alias("a"), last.alias("b")).first()) == (99, 100)


def test_regions_to_tensors(spark):
    sequence = spark.createDataFrame([("chr1", 0, "ACGTACGTNN"), ("chr1", 10, "acgtacgtac"), ("chr9", 0, "ACG"), ("odd", 0, "ACGTACGT")], "chrom string, offset long, seq string")
    none = spark.createDataFrame([], SPAN)
    mask = spark.createDataFrame([("chr1", 10, 12)], SPAN)
    found = find_windows(sequence, mask, none, size=4, stride=4)
    assert sorted((r["chrom"], r["start"], r["bad_bp"]) for r in found.collect()) == [("chr1", 0, 0), ("chr1", 4, 0), ("chr1", 14, 0)]
    windows = spark.createDataFrame([(0, "chr1", 8, 12)], "window_index long, chrom string, start long, end long")
    signal = spark.createDataFrame([("t", "chr1", 8, 11, 1.0)], SIGNAL)
    tracks = spark.createDataFrame([(0, "t", "mean")], "track_index int, track_id string, sum_stat string")
    out = shard_tensors(windows, sequence, signal, tracks, mask)
    row = out["windows"].first()
    assert row["sequence"] == [4, 4, 0, 1] and row["valid"] == [True, True, False, False]
    assert not math.isnan(out["tracks"].first()["factor"])
    assert [v > 0 for v in out["targets"].first()["values"]] == [True, True, False, False]


def test_digests_are_made_where_rows_are_filled(spark, tables):
    """Values that are only summed up do not leave the task, and equal those that do."""
    signal, mask = tables
    windows = spark.createDataFrame([(0, "c", 0, 8), (1, "c", 8, 13), (2, "x", 0, 4)], "window_index long, chrom string, start long, end long")
    tracks = spark.createDataFrame([(0, "t", "sum"), (1, "u", "sum_sqrt")], "track_index int, track_id string, sum_stat string")
    factors = spark.createDataFrame([("t", 2.0), ("u", 1.0)], "track_id string, factor double")
    runs = S.transformed(S.window_signal(windows, signal, mask, 4), tracks.join(factors, "track_id"))
    whole = S.dense_targets(windows, tracks, runs, statistics=True)
    sums = lambda values, cuts: [pa.array([float(values[a:b].sum()) for a, b in zip(cuts, cuts[1:])]), pa.array([int(b - a) for a, b in zip(cuts, cuts[1:])])]
    digests = S.dense_targets(windows, tracks, runs, digest=("mass double, n long", sums))
    assert {tuple(r) for r in digests.collect()} == {(r["window_index"], r["track_index"], sum(r["values"]), len(r["values"])) for r in whole.collect()}
    stats = ["window_index", "track_index", "capped_values", "low", "high"]
    only = S.dense_statistics(windows, tracks, runs)
    assert {tuple(r) for r in only.collect()} == {tuple(r) for r in whole.select(stats).collect()}
    assert "MapInArrow" not in only._jdf.queryExecution().executedPlan().toString()
