import json
import random
import shutil

import pytest

from spanloom.__main__ import main
from spanloom.plans.process import committed, process_shard, process_shards, quarantine, required_files, shard_windows
from spanloom.operators.manifests import metadata_urls, reachable_candidates, with_canonical_order
from spanloom.functions.numeric import coordinates, missing_count
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tests.test_sources import write_bigwig


def test_command_line_from_genome_to_tensors(spark, tmp_path):
    rng = random.Random(2)
    with open(tmp_path / "g.fa", "w") as fa:
        for n in range(1, 7):
            fa.write(f">chr{n}\n" + "".join(rng.choice("ACGT") for _ in range(rng.randint(90, 160))) + "NNNN\n")
    (tmp_path / "u.bed").write_text("chr1\t0\t30\nodd\t0\t7\n")
    (tmp_path / "b.bed").write_text("chr2\t5\t9\n")
    args = lambda *parts: [str(p) for p in parts]
    main(args("regions", "--fasta", tmp_path / "g.fa", "--unmappable", tmp_path / "u.bed", "--blacklist", tmp_path / "b.bed", "--window-size", 20, "--stride", 20, "--output", tmp_path / "regions"), spark)
    lines = [x for p in sorted((tmp_path / "regions").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[0].startswith("#chrom") and not any(x.startswith("chr1\t0\t") for x in lines) and any(x.startswith("chr2\t0\t20\t4\t0.200000") for x in lines)
    main(args("shards", "--regions", tmp_path / "regions", "--output", tmp_path / "shards", "--target-shards", 6, "--seed", 5, "--exact-shuffle"), spark)
    shards = [json.loads(x) for p in sorted((tmp_path / "shards").glob("part-*")) for x in p.read_text().splitlines()]
    assert len(shards) == 6 and sum(s["num_windows"] for s in shards) == len(lines) - 1
    (tmp_path / "t.tsv").write_text("index\tidentifier\tfile\tclip\tclip_soft\tscale\tsum_stat\tstrand_pair\tdescription\n0\tA+\t/rna/encode/a\t1\t2\t3\tsum\t1\td\n1\tA-\t/rna/encode/b\t1\t2\t3\tsum_sqrt\t0\td\n2\tZ\t/chip/z\t1\t2\t3\tsum\t2\td\n")
    main(args("tracks", "--manifest", tmp_path / "t.tsv", "--output", tmp_path / "tracks"), spark)
    made = [json.loads(x) for p in sorted((tmp_path / "tracks").glob("part-*")) for x in p.read_text().splitlines()]
    assert [(t["id"], t["strand_pair"], t["preprocessing"]["scale"]) for t in made] == [("A+", "A-", 3.0), ("A-", "A+", 3.0)]
    (tmp_path / "raw").mkdir()
    for name in ("A+", "A-"):
        write_bigwig(tmp_path / "raw" / f"{name}.bw", {f"chr{n}": 200 for n in range(1, 7)}, [(n, 1, 0, 0, [(0, 50, 1.0), (60, 70, 9.0)]) for n in range(6)], 840.0, 70)
    common = ("--shards", tmp_path / "shards", "--tracks", tmp_path / "tracks", "--raw-dir", tmp_path / "raw", "--fasta", tmp_path / "g.fa", "--blacklist", tmp_path / "b.bed", "--unmappable", tmp_path / "u.bed", "--output-root", tmp_path / "out", "--target-total", 840, "--track-batch-size", 1)
    main(args("process", "--split", "train", "--shard-number", 1, *common), spark)
    out = tmp_path / "out" / "train" / "train-00000" / "complete"
    targets = spark.read.parquet(f"{out}/targets").collect()
    first = next(s for s in shards if s["shard_id"] == "train-00000")
    assert len(targets) == 2 * first["num_windows"] and committed(spark, str(out)).count() == 2
    windows = {r["window_index"]: r for r in spark.read.parquet(f"{out}/windows").collect()}
    assert [windows[i]["chrom"] for i in range(len(windows))] == [w["chrom"] for w in first["windows"]]
    for row in targets:
        w = windows[row["window_index"]]
        for at, (value, valid) in enumerate(zip(row["values"], w["valid"])):
            here = w["start"] + at
            raw = 1.0 if here < 50 else 9.0 if 60 <= here < 70 else 0.0
            want = (raw if row["track_index"] == 0 else raw**0.75) if valid else 0.0
            assert value == pytest.approx(want, rel=1e-3)


def test_resumed_shard(spark, tmp_path):
    shard = spark.createDataFrame([("train-00000", "train", 1, [("c", 0, 4)])], "shard_id string, split string, num_windows int, windows array<struct<chrom:string,start:bigint,end:bigint>>")
    assert shard_windows(shard).count() == 1
    tracks = spark.createDataFrame([(i, f"t{i}", "sum") for i in range(3)], "track_index int, track_id string, sum_stat string")
    sequence = spark.createDataFrame([("c", 0, "ACGTAC")], "chrom string, offset long, seq string")
    signal = spark.createDataFrame([(f"t{i}", "c", 0, 2, 1.0 + i) for i in range(3)], "track_id string, chrom string, start long, end long, value float")
    none = spark.createDataFrame([], "chrom string, start long, end long")
    out = str(tmp_path / "s")
    run = lambda **more: process_shard(spark, shard, tracks, sequence, signal, (none, none), out, **{"batch_size": 2, "target": 2.0} | more)
    assert run(stop_after=1) == "partial"
    with pytest.raises(ValueError, match="batch_size"):
        run(batch_size=1)
    assert run() == "complete" and run() == "complete"
    got = {r["track_index"]: list(r["values"]) for r in spark.read.parquet(f"{out}/complete/targets").collect()}
    assert got == {i: [1.0, 1.0, 0.0, 0.0] for i in range(3)}
    assert quarantine(spark, f"{out}/complete", "x").endswith(".corrupt-x")


def test_metadata_and_candidates(spark):
    answers = spark.createDataFrame([("a", '{"file_format": "bigWig", "href": "/files/a.bigWig", "x": 1}')], "id string, body string")
    assert metadata_urls(answers, "body", "https://site/x").first()["url"] == "https://site/files/a.bigWig"
    for bad in ('{"file_format": "bed", "href": "/f"}', '{"file_format": "bigWig"}', "no json"):
        with pytest.raises(PySparkException):
            metadata_urls(answers.withColumn("body", F.lit(bad)), "body", "https://site").collect()
    tracks = spark.createDataFrame([("a",), ("b",)], "id string")
    tried = F.array(F.concat("id", F.lit("2")), F.concat("id", F.lit("1")), F.concat("id", F.lit("2")))
    existing = spark.createDataFrame([("a1",), ("a2",)], "url string")
    assert {r["id"]: r["urls"] for r in reachable_candidates(tracks, tried, existing, "id").collect()} == {"a": ["a2", "a1"], "b": []}


def test_small_helpers(spark):
    assert spark.range(1).select(coordinates(F.lit(3).cast("long"), F.lit(6).cast("long")).alias("x")).first()["x"] == [3, 4, 5]
    assert spark.range(1).select(coordinates(F.lit(3).cast("long"), F.lit(3).cast("long")).alias("x")).first()["x"] == []
    frame = spark.createDataFrame([(1.0, "chr2"), (None, "chr10"), (float("nan"), "odd")], "x double, chrom string")
    assert frame.agg(missing_count(F.col("x"))).first()[0] == 2
    assert [r["chrom_rank"] for r in with_canonical_order(frame, ("chr2", "chr10")).collect()] == [1, 2, 3]


def made_shard_inputs(spark):
    shards = spark.createDataFrame([("train-00000", "train", 2, [("c", 0, 4), ("c", 4, 8)]), ("train-00001", "train", 1, [("c", 2, 6)])], "shard_id string, split string, num_windows int, windows array<struct<chrom:string,start:bigint,end:bigint>>")
    tracks = spark.createDataFrame([(i, f"t{i}", "sum") for i in range(3)], "track_index int, track_id string, sum_stat string")
    sequence = spark.createDataFrame([("c", 0, "ACGTACGTAC")], "chrom string, offset long, seq string")
    signal = spark.createDataFrame([(f"t{i}", "c", 0, 3, 1.0 + i) for i in range(3)] + [("t0", "c", 6, 8, 9e4)], "track_id string, chrom string, start long, end long, value float")
    mask = spark.createDataFrame([("c", 1, 2)], "chrom string, start long, end long")
    none = spark.createDataFrame([], "chrom string, start long, end long")
    return shards, tracks, sequence, signal, (mask, none)


def test_whole_manifest_killed_and_resumed_equals_a_clean_run(spark, tmp_path):
    shards, tracks, sequence, signal, masks = made_shard_inputs(spark)
    totals = spark.createDataFrame([(f"t{i}", 1.0) for i in range(3)], "track_id string, total double")
    on = lambda ids, windows: signal.join(ids, "track_id", "left_semi")
    run = lambda out, **more: process_shards(spark, shards, tracks, sequence, on, masks, str(tmp_path / out), totals=totals, target=1.0, batch_size=2, **more)
    read = lambda out, name: sorted(map(str, spark.read.parquet(str(tmp_path / out / name)).select(*sorted(spark.read.parquet(str(tmp_path / out / name)).columns)).collect()))
    assert {r["shard_id"]: (r["complete"], r["missing"]) for r in run("a", stop_after=1).collect()} == {"train-00000": (False, [1]), "train-00001": (False, [1])}
    # A commit that is lost is work that is done again, for its shard alone.
    assert all(r["complete"] for r in run("a").collect()) and all(r["complete"] for r in run("b").collect())
    assert read("a", "targets") == read("b", "targets") and read("a", "windows") == read("b", "windows") and len(read("a", "targets")) == 9
    spark.createDataFrame([("train-00001", i) for i in range(2)], "shard_id string, batch_index int").write.mode("overwrite").parquet(str(tmp_path / "b" / "commits" / "0"))
    for folder in (tmp_path / "b" / "commits").iterdir():
        if folder.name != "0":
            shutil.rmtree(folder)
    assert all(r["complete"] for r in run("b").collect()) and read("a", "targets") == read("b", "targets")
    got = {(r["shard_id"], r["window_index"], r["track_index"]): r for r in spark.read.parquet(str(tmp_path / "a" / "targets")).collect()}
    assert list(got["train-00000", 0, 1]["values"]) == [2.0, 0.0, 2.0, 0.0] and list(got["train-00001", 0, 2]["values"]) == [3.0, 0.0, 0.0, 0.0]
    capped = got["train-00000", 1, 0]
    assert list(capped["values"]) == [0.0, 0.0, 65504.0, 65504.0] and (capped["capped_values"], capped["low"], capped["high"]) == (2, 0.0, 9e4)


def test_breaches_fail_before_any_commit(spark, tmp_path):
    shards, tracks, sequence, signal, masks = made_shard_inputs(spark)
    shard = shards.filter("shard_id = 'train-00000'")
    totals = spark.createDataFrame([("t0", 1.0), ("t1", 1.0)], "track_id string, total double")
    run = lambda out, **more: process_shard(spark, shard, tracks, sequence, signal, masks, str(tmp_path / out), **more)
    with pytest.raises(ValueError, match="no valid total for 't2'"):
        run("a", totals=totals)
    with pytest.raises(ValueError, match="no valid total for 't2'"):
        run("a", totals=totals.union(spark.createDataFrame([("t2", 0.0)], "track_id string, total double")))
    assert not (tmp_path / "a").exists()
    sizes = spark.createDataFrame([(f"t{i}", "c", 8 if i < 2 else 7) for i in range(3)], "track_id string, chrom string, length long")
    with pytest.raises(PySparkException, match="outside"):
        run("b", batch_size=2, sizes=sizes)
    assert [r["batch_index"] for r in committed(spark, str(tmp_path / "b" / "partial")).collect()] == [0]
    (tmp_path / "raw").mkdir()
    for name in ("t0.bw", "t1.bw"):
        (tmp_path / "raw" / name).write_bytes(b"x" if name == "t0.bw" else b"")
    with pytest.raises(ValueError, match="'t1', 't2'"):
        required_files(spark, tracks, str(tmp_path / "raw"))
    odd = spark.createDataFrame([("a b",), ("a?b",)], "track_id string")
    (tmp_path / "raw" / "a_b.bw").write_bytes(b"x")
    with pytest.raises(ValueError, match="a_b.bw"):
        required_files(spark, odd, str(tmp_path / "raw"))
    assert required_files(spark, odd.limit(1), str(tmp_path / "raw")).first()["path"].endswith("/raw/a_b.bw")


def test_command_line_for_a_split_and_its_status(spark, tmp_path, capsys):
    args = lambda *parts: [str(p) for p in parts]
    (tmp_path / "g.fa").write_text(">c\nACGTACGT\nACGTAC\n")
    main(args("index", "--fasta", tmp_path / "g.fa"), spark)
    assert (tmp_path / "g.fa.fai").read_text() == "c\t14\t3\t8\t9\n"
    (tmp_path / "u.bed").write_text("c\t1\t2\n")
    shards = [{"shard_id": f"{split}-{i:05d}", "split": split, "num_windows": 1, "windows": [{"chrom": "c", "start": i, "end": i + 5}]} for split in ("train", "val") for i in range(2)]
    (tmp_path / "s.jsonl").write_text("".join(json.dumps(s) + "\n" for s in shards))
    (tmp_path / "t.jsonl").write_text("".join(json.dumps({"id": i, "preprocessing": {"sum_stat": "sum"}}) + "\n" for i in ("a b", "x")))
    (tmp_path / "raw").mkdir()
    for name in ("a_b", "x"):
        write_bigwig(tmp_path / "raw" / f"{name}.bw", {"c": 14}, [(0, 1, 0, 0, [(0, 3, 2.0)])], 2.0)
    common = ("--shards", tmp_path / "s.jsonl", "--tracks", tmp_path / "t.jsonl", "--raw-dir", tmp_path / "raw", "--fasta", tmp_path / "g.fa", "--blacklist", tmp_path / "u.bed", "--unmappable", tmp_path / "u.bed", "--output-root", tmp_path / "out", "--target-total", 2)
    main(args("process", "--split", "train", *common), spark)
    main(args("process", "--split", "val", "--shard-id", "val-00000", *common), spark)
    rows = spark.read.parquet(str(tmp_path / "out" / "all-train" / "targets")).collect()
    assert sorted((r["shard_id"], r["track_index"], list(r["values"])) for r in rows) == sorted((f"train-0000{i}", t, [0.0 if x == 1 or x >= 3 else 2.0 for x in range(i, i + 5)]) for i in range(2) for t in range(2))
    capsys.readouterr()
    main(args("status", "--shards", tmp_path / "s.jsonl", "--output-root", tmp_path / "out", "--repair", tmp_path / "again.jsonl"), spark)
    assert dict(line.split() for line in capsys.readouterr().out.splitlines() if " " in line) == {"complete": "3", "partial": "0", "suspicious_final": "0", "missing": "1"}
    assert json.loads((tmp_path / "again.jsonl").read_text()) == {"original_index": 3, "split": "val", "shard_id": "val-00001", "status": "missing"}
    with pytest.raises(PySparkException, match="outside|no sequence"):
        (tmp_path / "s2.jsonl").write_text(json.dumps({"shard_id": "test-00000", "split": "test", "num_windows": 1, "windows": [{"chrom": "c", "start": 10, "end": 15}]}) + "\n")
        main(args("process", "--split", "test", "--shards", tmp_path / "s2.jsonl", *common[2:]), spark)


def test_one_published_file(spark, tmp_path):
    from spanloom.sources import sinks

    regions = spark.createDataFrame([("chr10", 0, 4, 1, 0.25), ("chr2", 8, 12, 0, 0.0), ("chr2", 0, 4, 2, 0.5)], "chrom string, start long, end long, bad_bp long, bad_fraction double")
    for _ in range(2):  # a second run takes the place of the first
        sinks.publish_bed5(regions.repartition(3), str(tmp_path / "r.bed"))
    assert (tmp_path / "r.bed").read_text() == "#chrom\tstart\tend\tbad_bp\tbad_fraction\nchr2\t0\t4\t2\t0.500000\nchr2\t8\t12\t0\t0.000000\nchr10\t0\t4\t1\t0.250000\n"
    sinks.write_json_lines(spark.createDataFrame([(None, 1), ("x", 2)], "a string, b int"), str(tmp_path / "j.jsonl"), nulls=True, one_file=True)
    assert (tmp_path / "j.jsonl").read_text() == '{"a":null,"b":1}\n{"a":"x","b":2}\n'
    assert sorted(p.name for p in tmp_path.iterdir()) == ["j.jsonl", "r.bed"]
