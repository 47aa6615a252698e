import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import index
from spanloom.operators.intervals import merge_intervals, overlap_bp
from spanloom.sources import bigwig, bigwig_source
from spanloom.sources.ranged import RangedFile
from tests.test_indexed import rows, write_tree_bigwig


def test_overlaps_by_index_and_by_join(spark, monkeypatch):
    rng = random.Random(4)
    spans = [(rng.choice("abc"), rng.randrange(2), s, s + rng.randrange(0, 30)) for s in (rng.randrange(900) for _ in range(120))]
    mask = merge_intervals(spark.createDataFrame(spans, "k string, n int, start long, end long"), ["k", "n"])
    wins = [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(3), s, s + rng.randrange(-5, 200), i) for i, s in enumerate(rng.randrange(-9, 1000) for _ in range(300))] + [("a", 1, 3, 50, 7)] * 2
    windows = spark.createDataFrame(wins, "k string, n int, start long, end long, x int").repartition(3)
    found = index.overlap_bp_by_index(windows, mask, ["k", "n"], "bad")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().partition("MapInArrow")[0]
    covered = {(k, n, p) for k, n, s, e in spans for p in range(s, e)}
    want = [(*w, sum((w[0], w[1], p) in covered for p in range(w[2], w[3]))) for w in wins]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert index.overlap_bp_by_index(windows, mask, ["k", "n"], "bad", most=3)._jdf.queryExecution().toString().count("Join") > 0
    plain = lambda frame: sorted(map(str, frame.filter("k is not null").select("k", "n", "start", "end", "bad").collect()))
    assert plain(index.overlap_bp_by_index(windows.select("k", "n", "start", "end"), mask, ["k", "n"], "bad")) == plain(overlap_bp(windows.select("k", "n", "start", "end"), mask, ["k", "n"], "bad", 64))
    assert index.overlap_bp_by_index(windows, mask.limit(0), ["k", "n"]).agg(F.sum("overlap_bp")).first()[0] == 0


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    runs = {c: [(a, a + 7, float(k)) for k, a in enumerate(range(5, 500_000, 50))] for c in ("chr1", "chr2")}
    for n in range(3):
        write_tree_bigwig(folder / f"t{n}.bw", {"chr1": 600_000, "chr2": 600_000}, runs)
    (folder / "other.txt").write_text("no track")
    return folder


def test_data_source_pushes_filters(spark, folder, monkeypatch):
    bigwig_source.register(spark)
    monkeypatch.setattr(bigwig_source, "PARTITION_BYTES", 50_000)
    frame = spark.read.format("bigwig").load(str(folder))
    whole = rows(bigwig.read_bigwig(spark, str(folder)))
    assert rows(frame) == whole and len(whole) == 60_000
    narrow = frame.filter((F.col("track_id") == "t1") & F.col("chrom").isin("chr2", "chr9") & (F.col("start") < 20_000) & (F.col("end") > 19_000) & (F.col("value") > 0))
    assert rows(narrow) == [r for r in whole if r[0] == "t1" and r[1] == "chr2" and r[2] < 20_000 and r[3] > 19_000]
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "BatchScan" in plan
    condition = frame.filter((F.col("start") >= 100) & (F.col("start") <= 300) & (F.col("end") == 162))
    assert {tuple(r)[1:4] for r in condition.collect()} == {("chr1", 155, 162), ("chr2", 155, 162)}
    assert frame.filter("chrom = 'chr1' and chrom = 'chr2'").count() == 0 and frame.filter("track_id = 'none'").count() == 0


def test_pushed_filters_read_fewer_bytes(folder):
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan, StringEndsWith

    reader = bigwig_source.BigWigReader(str(folder))
    kept = list(reader.pushFilters([EqualTo(("track_id",), "t2"), EqualTo(("chrom",), "chr1"), LessThan(("start",), 20_000), GreaterThan(("end",), 19_000), StringEndsWith(("chrom",), "1")]))
    assert [type(f).__name__ for f in kept] == ["StringEndsWith"]
    parts = reader.partitions()
    assert {p.track for p in parts} == {"t2"}
    file = bigwig.BigWigFile(RangedFile(parts[0].path))
    n = len(list(file.entries(bigwig.Extents({0: (np.array([reader.low]), np.array([reader.high]))}))))
    assert n <= 2 and sum(b.num_rows for p in parts for b in reader.read(p)) == 20
