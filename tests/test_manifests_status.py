import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanloom.operators import manifests as M
from spanloom.operators import status as Z


def test_build_tracks(spark):
    rows = [
        (0, "E1+", "/rna/encode/x", "d", "1", "2", "sum", "NaN", None),
        (1, "E1-", "/rna/encode/y", "d", "0", "x", "sum", "3", None),
        (2, "G.", "/cage/fantom/z", "d", "2", None, "mean", None, None),
        (3, "H", "/chip/z", "d", "0", None, "mean", None, None),
        (4, "C", "/atac/catlas/z", "d", "3", None, "mean", None, None),
    ]
    manifest = spark.createDataFrame(rows, "row_index long, identifier string, file string, description string, strand_pair string, scale string, sum_stat string, clip_soft string, clip string")
    manifest = manifest.withColumn("scale", F.when(F.col("scale") != "x", F.col("scale")))
    got = {r["id"]: r for r in M.build_tracks(manifest).collect()}
    assert set(got) == {"E1+", "E1-", "G.", "C"}
    assert got["E1+"]["strand_pair"] == "E1-" and got["E1-"]["strand_pair"] == "E1+"
    assert got["G."]["strand_pair"] is None and got["C"]["strand_pair"] == "H"
    assert got["E1+"]["source"]["file_accession"] == "E1" and got["E1+"]["preprocessing"]["clip_soft"] is None


def test_lookups(spark):
    index = spark.createDataFrame(
        [("a", 0, "X-1.bw", "a0"), ("a", 1, "X-1.bw", "a1"), ("a", 2, "q_r.bw", "a2"), ("a", 3, "Q.R.bw", "a3"), ("b", 0, "x1.BW", "b0"), ("b", 1, "q_r.bw", "b1")], "base string, ordinal int, filename string, url string"
    )
    tracks = spark.createDataFrame([("t1", "X-1"), ("t2", "qr"), ("t3", "none")], "id string, stem string")
    got = {r["id"]: r["urls"] for r in M.exact_or_canonical(tracks, index, "stem", ["a", "b"]).collect()}
    assert got == {"t1": ["a1", "b0"], "t2": ["b1"], "t3": []}
    with pytest.raises(PySparkException):
        M.require_urls(M.exact_or_canonical(tracks, index, "stem", ["a", "b"]), "id").collect()


def test_tags_from_two_sources_in_order(spark):
    names = [("h", 0, "a.CNhs1.ctss.fwd.bw", "u0"), ("h", 1, "b.CNhs1.ctss.fwd.bw", "u1"), ("h", 2, "cnhs2.ctss.rev.bw", "u2"), ("h", 3, "other.bw", "u3")]
    index = spark.createDataFrame(names, "base string, ordinal int, filename string, url string")
    loose, strict = M.tag_index(index, True), M.tag_index(index, False)
    assert sorted(map(tuple, loose.collect())) == [("CNhs1", "+", "u1"), ("cnhs2", "-", "u2")]
    tracks = spark.createDataFrame([("CNhs1", "+"), ("CNhs9", "+")], "library string, strand string")
    got = {r["library"]: r["urls"] for r in M.both_sources(tracks, loose, strict.withColumn("url", F.lit("s")), ["library", "strand"]).collect()}
    assert got == {"CNhs1": ["u1", "s"], "CNhs9": []}


def test_dispatch_and_first_success(spark):
    tracks = spark.createDataFrame([("a", "P"), ("b", "Q")], "id string, provider string")
    routes = {"P": lambda d: d.withColumn("u", F.lit(1)), "Q": lambda d: d.withColumn("u", F.lit(2))}
    assert sorted((r["id"], r["u"]) for r in M.dispatch(tracks, routes).collect()) == [("a", 1), ("b", 2)]
    with pytest.raises(PySparkException):
        M.dispatch(tracks, {"P": routes["P"]}).collect()
    tries = spark.createDataFrame([("a", 0, "x", False), ("a", 1, "y", True), ("a", 2, "z", True)], "id string, rank int, url string, ok boolean")
    assert M.first_success(tries, ["id"], "url", "rank", F.col("ok")).first()["url"] == "y"


def test_index_pages(spark):
    pages = spark.createDataFrame([("http://h/d/", '<a href="x.bw">1</a> <a class=k href=\'/y.BW\'>2</a> <a href="z.txt">')], "base string, html string")
    assert [(r["ordinal"], r["filename"], r["url"]) for r in M.link_index(pages, "base", "html").orderBy("ordinal").collect()] == [(0, "x.bw", "http://h/d/x.bw"), (1, "y.BW", "http://h/y.BW")]


def test_status_precedence_and_repair(spark):
    shards = spark.createDataFrame([(i, "train", f"s{i}") for i in range(4)], "original_index long, split string, shard_id string")
    finals = spark.createDataFrame([("s0", True), ("s2", None), ("s1", False)], "shard_id string, complete boolean")
    partials = spark.createDataFrame([("s0",), ("s1",)], "shard_id string")
    statused = Z.shard_status(shards, finals, partials, ["shard_id"])
    assert {r["shard_id"]: r["status"] for r in statused.collect()} == {"s0": "complete", "s1": "partial", "s2": "suspicious_final", "s3": "missing"}
    assert Z.status_counts(statused).first().asDict() == {"complete": 1, "partial": 1, "suspicious_final": 1, "missing": 1}
    assert Z.repair_manifest(statused).count() == 3 and Z.repair_manifest(statused, True).count() == 4


def test_batches_and_commit_log(spark):
    work = Z.batches(spark.range(40).select(F.lit("s").alias("shard_id"), F.col("id")), "id", 16)
    log = spark.createDataFrame([("s", 0), ("s", 2)], "shard_id string, batch_index int")
    assert Z.pending(work, log, ["shard_id", "batch_index"]).count() == 16
    row = Z.completeness(work, log, ["shard_id", "batch_index"], ["shard_id"]).first()
    assert row["complete"] is False and row["missing"] == [1]
    with pytest.raises(ValueError):
        Z.batches(work, "id", 0)


def test_requirements(spark):
    frame = spark.createDataFrame([(1,), (None,)], "x int")
    with pytest.raises(PySparkException):
        Z.require(frame, F.col("x") > 0, "bad").collect()
    with pytest.raises(ValueError):
        Z.require_rows(frame.limit(0), "none")
    with pytest.raises(ValueError):
        Z.require_equal_lengths(spark.createDataFrame([(0, 5), (0, 6)], "start long, end long"))
    assert Z.matching_run({"a": 1, "b": 2}, {"a": 1, "b": 3, "c": 4}) == ["b", "c"]


def test_hosts_that_do_not_answer_are_left_out(spark):
    pages = spark.createDataFrame([("a", None), ("b", "<a href='x.bw'>"), ("c", "")], "base string, html string")
    assert M.answering_hosts(pages, ["c", "a", "b", "d"]) == ["c", "b"]
    with pytest.raises(ValueError, match="a, d"):
        M.answering_hosts(pages, ["a", "d"])


def test_later_folders_replace_earlier_ones(spark):
    index = spark.createDataFrame([("one", 0, "x.bw", "one/x"), ("one", 7, "y.bw", "one/y"), ("two", 1, "x.bw", "two/x"), ("three", 9, "x.bw", "three/x")], "base string, ordinal long, filename string, url string")
    for bases, want in ((["one", "two"], "two/x"), (["two", "one"], "one/x")):
        got = dict((r["filename"], r["url"]) for r in M.last_wins(M.chained_index(index, bases), ["filename"], "url", "ordinal").collect())
        assert got == {"x.bw": want, "y.bw": "one/y"}
