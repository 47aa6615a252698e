import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanloom.functions import numeric as N
from spanloom.functions import text as T


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("made", "want"),
    [
        (lambda: T.encode_sequence(F.lit("ACGTacgtNü-")), "01230123444"),
        (lambda: T.safe_filename(F.lit("__a b//c.bw (x)_")), "a_b_c.bw_x"),
        (lambda: T.canonical_name(F.lit("My-File_1.BW")), "myfile1"),
        (lambda: T.accession(F.lit("ENC1+-+")), "ENC1"),
        (lambda: T.file_stem(F.lit("/a/b.c/d.e.bw")), "d.e"),
        (lambda: T.shard_name(F.lit("train"), F.lit(7)), "train-00007"),
        (lambda: T.one_line(F.lit("a\tb\nc")), "a b c"),
        (lambda: T.label(F.lit("a"), F.lit(None).cast("string"), F.lit("c")), "a | None | c"),
        (lambda: T.whole_number(F.lit("x")), None),
        (lambda: T.whole_number(F.lit(" 12 ")), 12),
        (lambda: T.file_size(F.lit("bytes 0-0/123"), F.lit("1")), 123),
        (lambda: T.file_size(F.lit(None).cast("string"), F.lit("9")), 9),
        (lambda: T.absolute_url(F.lit("http://h/a/b.html"), F.lit("x.bw")), "http://h/a/x.bw"),
        (lambda: T.absolute_url(F.lit("http://h/a/"), F.lit("/x.bw")), "http://h/x.bw"),
        (lambda: T.absolute_url(F.lit("http://h/a/"), F.lit("ftp://k/x")), "ftp://k/x"),
        (lambda: T.study_spellings(F.lit("RNA: left-arm skin")), ["LEFT-ARM SKIN", "LEFT-ARM_SKIN", "LEFT_ARM SKIN", "LEFT_ARM_SKIN"]),
        (lambda: T.study_spellings(F.lit("liver")), ["LIVER"]),
        (lambda: T.hrefs(F.lit("<a href='a.bw'>x</a><A HREF=\"b.BW\"><a href='c.txt'>")), ["a.bw", "b.BW"]),
        (lambda: T.library_and_strand(F.lit("x.cnhs1.ctss.fwd.bw"), False), None),
        (lambda: T.sequence_codes(F.lit("AN")), [0, 4]),
    ],
)
def test_text(spark, made, want):
    assert value(spark, made()) == want


def test_strand_and_library(spark):
    assert tuple(value(spark, T.split_strand(F.lit("X++")))) == ("X+", "+")
    assert tuple(value(spark, T.split_strand(F.lit("X")))) == ("X", ".")
    assert tuple(value(spark, T.library_and_strand(F.lit("x.cnhs1.CTSS.rev.bw"), True))) == ("cnhs1", "-")


def test_classes_and_sources(spark):
    assert tuple(value(spark, T.classify_path(F.lit("/d/RNA/encode/x")))) == ("RNA-seq", "ENCODE")
    assert tuple(value(spark, T.classify_path(F.lit("/chip/x")))) == ("exclude", "exclude")
    assert tuple(value(spark, T.classify_path(F.lit(None).cast("string")))) == ("exclude", "exclude")
    record = value(spark, T.source_struct(F.lit("ENCODE"), F.lit("E1")))
    assert record["api_url"].endswith("/files/E1/?format=json") and record["portal"] is None
    with pytest.raises(PySparkException):
        value(spark, T.source_struct(F.lit("other"), F.lit("E1")))


def test_base_sum_urls(spark):
    urls = value(spark, T.base_sum_urls(F.lit("x:skin"), F.lit("S12.1"), F.array(F.lit("http://a"), F.lit("http://b"))))
    assert urls == [f"http://{h}/human/data_sources/gtex/base_sums/IN/SKIN/12/gtex.base_sums.SKIN_S12.1.ALL.bw" for h in "ab"]


def test_missing_values_come_before_the_cap(spark):
    for x in (float("nan"), float("inf"), float("-inf")):
        assert value(spark, N.zero_missing(F.lit(x))) == 0
    assert value(spark, N.zero_missing(F.lit(None).cast("double"))) == 0
    assert value(spark, N.cap(F.lit(70000.0).cast("float"))) == 65504.0
    assert value(spark, N.cap(F.lit(-70000.0).cast("float"))) == -70000.0
    assert math.isnan(value(spark, N.cap(F.lit(float("nan")))))
    with pytest.raises(PySparkException):
        value(spark, N.guard_finite(F.lit(float("nan")).cast("float")))


def test_transform(spark):
    assert value(spark, N.transform_value(F.lit(16.0), F.lit(1.0), F.lit("sum_sqrt"))) == pytest.approx(8.0)
    assert value(spark, N.transform_value(F.lit(-16.0), F.lit(1.0), F.lit("sum_sqrt"))) == 0
    assert value(spark, N.transform_value(F.lit(-16.0), F.lit(2.0), F.lit("mean"))) == -32
    for bad in (F.lit("other"), F.lit(None).cast("string")):
        with pytest.raises(PySparkException):
            value(spark, N.transform_value(F.lit(1.0), F.lit(1.0), bad))
        assert value(spark, N.transform_value(F.lit(1.0), F.lit(3.0), bad, strict=False)) == 3
    for bad in (0.0, -1.0, float("nan"), float("inf")):
        with pytest.raises(PySparkException):
            value(spark, N.normalisation_factor(F.lit(bad)))


def test_half(spark):
    got = [value(spark, N.half_rounded(F.lit(x).cast("float"))) for x in (1.0009765625, 65504.0, -70000.0, 0.1)]
    assert got[0] == 1.0009765625 and got[1] == 65504.0 and got[2] == float("-inf") and got[3] == pytest.approx(0.0999755859375)


def test_addresses_are_joined_like_the_standard(spark):
    from urllib.parse import urljoin

    from spanloom.functions.text import absolute_url

    bases = ["http://h/a/b", "http://h/a/b/", "https://h.org", "http://h/a/b?x=1/2#f", "http://h:80/"]
    hrefs = ["c.bw", "/c/d.bw", "../c", "../../../c", "./c/./d", "c/..", "c/../d?x=../y", ".", "..", "//o/p", "http://o/p/../q", "?x=1", "#f", "", "c#f?g", "a%20b.bw", ".hidden", "c/...", "ftp://x", "a/b/../../c.bw"]
    rows = [(b, h) for b in bases for h in hrefs]
    frame = spark.createDataFrame(rows, "b string, h string").withColumn("u", absolute_url(F.col("b"), F.col("h")))
    wrong = [(r["b"], r["h"], r["u"], urljoin(r["b"], r["h"])) for r in frame.collect() if r["u"] != urljoin(r["b"], r["h"]) and not r["h"].startswith("http://o")]
    assert not wrong
