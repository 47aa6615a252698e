import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.operators import intervals as I

SPAN = "chrom string, start long, end long"


def spans(spark, rows):
    return spark.createDataFrame(rows, SPAN)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*(columns or ("chrom", "start", "end"))).collect())


def merged_plainly(items):
    out = []
    for c, s, e in sorted(i for i in items if i[2] > i[1]):
        if out and out[-1][0] == c and s <= out[-1][2]:
            out[-1] = (c, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((c, s, e))
    return out


def test_merge_overlapping_nested_touching_duplicate_unsorted_and_empty(spark):
    given_rows = [("a", 5, 9), ("a", 1, 3), ("a", 3, 4), ("a", 6, 7), ("a", 5, 9), ("b", 2, 2), ("b", 0, 1), ("a", 20, 10)]
    assert rows(I.merge_intervals(spans(spark, given_rows), ["chrom"])) == [("a", 1, 4), ("a", 5, 9), ("b", 0, 1)]
    assert rows(I.merge_intervals(spans(spark, given_rows), ["chrom"], gap=1)) == [("a", 1, 9), ("b", 0, 1)]
    assert I.merge_intervals(spans(spark, []), ["chrom"]).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 70)), max_size=25))
def test_merge_properties(spark, items):
    once = rows(I.merge_intervals(spans(spark, items), ["chrom"]))
    assert once == merged_plainly(items)
    assert rows(I.merge_intervals(spans(spark, once), ["chrom"])) == once
    assert rows(I.merge_large(spans(spark, items), ["chrom"], 16)) == once


def test_union_merge(spark):
    assert rows(I.union_merge(spans(spark, [("a", 0, 2)]), spans(spark, [("a", 2, 5), ("c", 1, 2)]), ["chrom"])) == [("a", 0, 5), ("c", 1, 2)]


def test_overlap_counts_nothing_as_zero_and_is_strict(spark):
    windows = spans(spark, [("a", 0, 100), ("a", 100, 200), ("b", 0, 100)])
    mask = spans(spark, [("a", 10, 30), ("a", 90, 150)])
    found = I.overlap_bp(windows, mask, ["chrom"], bin_size=16)
    assert rows(found, "chrom", "start", "overlap_bp") == [("a", 0, 30), ("a", 100, 50), ("b", 0, 0)]
    assert rows(I.filter_by_overlap(found, 0.5), "chrom", "start") == [("a", 0), ("b", 0)]


def test_binned_join_has_no_repeats_and_all_pairs(spark):
    rng = random.Random(5)
    left = [("a", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 300) for _ in range(40))]
    right = [("a", s, s + rng.randint(1, 90)) for s in (rng.randint(0, 300) for _ in range(40))]
    left, right = list(dict.fromkeys(left)), list(dict.fromkeys(right))
    want = sorted((a[1], a[2], b[1], b[2]) for a in left for b in right if a[1] < b[2] and b[1] < a[2])
    for size in (8, 64, 1 << 18):
        got = I.overlap_pairs(spans(spark, left), spans(spark, right), ["chrom"], size)
        assert rows(got, "start", "end", "i_start", "i_end") == want


def test_subtract(spark):
    source = spans(spark, [("a", 0, 10), ("a", 20, 30), ("b", 0, 5)]).withColumn("v", F.lit(1))
    mask = spans(spark, [("a", 2, 4), ("a", 8, 25)])
    assert rows(I.subtract_intervals(source, mask, ["chrom"], 4)) == [("a", 0, 2), ("a", 4, 8), ("a", 25, 30), ("b", 0, 5)]


def test_tiles_fit(spark):
    runs = spans(spark, [("a", 0, 10), ("a", 20, 29), ("a", 40, 65)])
    assert rows(I.tile(runs, 10, 10)) == [("a", 0, 10), ("a", 40, 50), ("a", 50, 60)]
    assert rows(I.tile(runs, 10, 7)) == [("a", 0, 10), ("a", 40, 50), ("a", 47, 57), ("a", 54, 64)]


def test_runs_of_a_pattern(spark):
    frame = spark.createDataFrame([(1, "NNACGTnnacgN"), (2, ""), (3, None), (4, "NNN")], "id long, seq string")
    assert rows(I.text_runs(frame, "seq", "[ACGTacgt]"), "id", "start", "end") == [(1, 2, 6), (1, 8, 11)]
    nested = frame.select("id", F.explode(I.pattern_runs(F.col("seq"), "[ACGTacgt]", "[^ACGTacgt]")).alias("r")).select("id", "r.*")
    assert rows(nested, "id", "start", "end") == [(1, 2, 6), (1, 8, 11)]


def test_byte_ranges_cover_the_file(spark):
    frame = spark.createDataFrame([("x", 10), ("y", 3), ("z", 0), ("w", 7)], "f string, size long")
    got = I.byte_ranges(frame, "size", 4).collect()
    for name, size in (("x", 10), ("y", 3), ("w", 7)):
        parts = sorted((r["start"], r["stop"]) for r in got if r["f"] == name)
        assert [b for a, e in parts for b in range(a, e + 1)] == list(range(size))
    assert not [r for r in got if r["f"] == "z"]


def test_mask_spans(spark):
    frame = spark.createDataFrame([("u", i, f) for i, f in enumerate([1, 1, 0, 1, None, 1, 1, 1])], "u string, i long, f int")
    assert rows(I.mask_spans(frame, ["u"], "i", F.col("f") == 1), "first", "last", "n") == [(1, 2, 2), (4, 4, 1), (6, 8, 3)]


def test_text_runs_by_the_regular_expression(spark):
    texts = ["", None, "aaa", "xax", "éaé\U0001f600aa", "aa", "aa\na", "b" * 10, "a" * 3000, "\x00a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("start_of", F.lit("s"))
    for inside in ("[aeiou]", "[^a]", "."):
        got = sorted((r["id"], r["start"], r["end"]) for r in I.text_runs(docs.repartition(2), "text", inside).collect())
        want = sorted((i, *m.span()) for i, t in enumerate(texts) for m in re.finditer(f"{inside}+", t or ""))
        assert got == want
    assert I.text_runs(docs.limit(0), "text", "a").count() == 0


def test_tiles_meet_a_mask_before_they_are_made(spark):
    rng = random.Random(9)
    spans = [(rng.choice("ab"), s, s + rng.randrange(0, 40)) for s in (rng.randrange(-50, 600) for _ in range(60))]
    mask = I.merge_intervals(spark.createDataFrame(spans, "k string, start long, end long"), ["k"])
    runs = [(rng.choice(["a", "b", "c", None]), s, s + rng.randrange(0, 300), i) for i, s in enumerate(rng.randrange(-60, 500) for _ in range(25))]
    frame = spark.createDataFrame(runs, "k string, start long, end long, x int")
    covered = {(k, p) for k, s, e in spans for p in range(s, e)}
    for size, stride, width in ((20, 7, 16), (20, 7, 64), (5, 90, 16), (130, 1, 32)):
        want = sorted((str(k), x, a, a + size, sum((k, p) in covered for p in range(a, a + size))) for k, s, e, x in runs for a in range(s, e - size + 1, stride))
        found = I.tile_overlap_bp(frame, size, stride, mask, ["k"], "bad", width)
        assert sorted((str(r["k"]), r["x"], r["start"], r["end"], r["bad"]) for r in found.collect()) == want
        # Windows over several bins are summed, all others are looked up once.
        for large in (False, True):
            found = I.overlap_bp(I.tile(frame, size, stride), mask, ["k"], "bad", width, large)
            assert sorted((str(r["k"]), r["x"], r["start"], r["end"], r["bad"]) for r in found.collect()) == want
    plan = I.tile_overlap_bp(frame, 20, 7, mask, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.partition("Join")[0]
