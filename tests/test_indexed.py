import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanloom.sources import bigwig, fasta, text
from spanloom.sources.ranged import RangedFile

SPAN = "chrom string, start long, end long"


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def write_tree_bigwig(path, chroms, runs, per_block=50, fan=8, total=1.0):
    """A file with an index of several levels and true extents; ``runs`` has
    (start, end, value) by chromosome."""
    key = max(map(len, chroms))
    tree = struct.pack("<IIIIQQ", bigwig.TREE_MAGIC, 8, key, 8, len(chroms), 0) + struct.pack("<BBH", 1, 0, len(chroms))
    for n, (name, size) in enumerate(chroms.items()):
        tree += name.encode().ljust(key, b"\0") + struct.pack("<II", n, size)
    tree_at = 104
    at = tree_at + len(tree) + 8
    data, level = b"", []
    for n, name in enumerate(chroms):
        own = runs.get(name, [])
        for k in range(0, len(own), per_block):
            items = own[k : k + per_block]
            packed = zlib.compress(struct.pack("<IIIIIBBH", n, items[0][0], items[-1][1], 0, 0, 1, 0, len(items)) + b"".join(struct.pack("<IIf", *i) for i in items), 0)
            level.append((n, items[0][0], n, items[-1][1], at + len(data), len(packed)))
            data += packed
    index_at = at + len(data)
    head_index = struct.pack("<IIQIIIIQII", bigwig.INDEX_MAGIC, fan, len(level), 0, 0, 9, 9, index_at, 1, 0)
    levels = [[level[i : i + fan] for i in range(0, len(level), fan)]]  # leaves first
    while len(levels[-1]) > 1:
        groups = levels[-1]
        levels.append([groups[i : i + fan] for i in range(0, len(groups), fan)])
    flat = lambda node: node[0] if isinstance(node[0], tuple) else flat(node[0])
    end = lambda node: node[-1] if isinstance(node[-1], tuple) else end(node[-1])
    size_of = lambda node, leaf: 4 + len(node) * (32 if leaf else 24)
    place, places = index_at + 48, {}
    for depth in range(len(levels) - 1, -1, -1):
        for node in levels[depth]:
            places[depth, id(node)] = place
            place += size_of(node, depth == 0)
    body = b""
    for depth in range(len(levels) - 1, -1, -1):
        for node in levels[depth]:
            body += struct.pack("<BBH", depth == 0, 0, len(node))
            for child in node:
                if depth == 0:
                    body += struct.pack("<IIIIQQ", *child)
                else:
                    a, b = flat(child), end(child)
                    body += struct.pack("<IIIIQ", a[0], a[1], b[2], b[3], places[depth - 1, id(child)])
    head = struct.pack("<IHHQQQHHQQIQ", bigwig.MAGIC, 4, 0, tree_at, at - 8, index_at, 0, 0, 0, 64, 4096, 0)
    path.write_bytes(head + struct.pack("<Qdddd", 1, 0, 0, total, 0) + tree + struct.pack("<Q", len(level)) + data + head_index + body)


@pytest.fixture(scope="module")
def track(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bw")
    rng = random.Random(1)
    chroms, runs = {f"chr{n}": 2_000_000 for n in range(1, 6)}, {}
    for name in chroms:
        at, own = 0, []
        while at < 1_990_000:
            a = at + rng.randrange(1, 60)
            at = a + rng.randrange(1, 60)
            own.append((a, at, float(rng.randrange(1, 99))))
        runs[name] = own
    for n in range(2):
        write_tree_bigwig(folder / f"t{n}.bw", chroms, runs)
    return folder, runs


def test_windows_read_little_more_than_their_own_bytes(spark, track):
    folder, runs = track
    rng = random.Random(3)
    spans = [(c, s, s + 3000) for c in ("chr1", "chr2", "chr4") for s in (rng.randrange(0, 1_990_000) for _ in range(4))] + [("chrZ", 0, 50)]
    windows = spark.createDataFrame(spans, SPAN)
    files = spark.createDataFrame([(f"t{n}", str(folder / f"t{n}.bw")) for n in range(2)], "track_id string, path string")
    got = rows(bigwig.read_bigwig_windows(files, windows))
    want = sorted((f"t{n}", c, a, b, v) for n in range(2) for c, own in runs.items() for a, b, v in own if any(c == w and a < e and b > s for w, s, e in spans))
    assert got == want
    regions = bigwig.regions_of(windows)
    blocks = bigwig.bigwig_blocks(files, regions)
    whole = (folder / "t0.bw").stat().st_size
    data = blocks.filter("track_id = 't0'").agg(F.sum("size")).first()[0]
    own = sum(12 for c, a, b, v in ((c, *r) for c, o in runs.items() for r in o) if any(c == w and a < e and b > s for w, s, e in spans))
    assert data < own + 2 * len(spans) * 50 * 12 + 40 * 2 * len(spans) and data < whole / 20
    file = bigwig.BigWigFile(RangedFile(str(folder / "t0.bw")))
    entries = list(file.entries(file.extents(regions)))
    assert len(entries) == blocks.filter("track_id = 't0'").count() and file.read.fetched < whole / 4  # pages of the index


def test_too_many_windows_meet_the_blocks_in_a_join(spark, track, monkeypatch):
    folder, _ = track
    spans = [("chr1", 1000 * k, 1000 * k + 30) for k in range(0, 900, 90)] + [("chr3", 5, 9), ("chr3", 7, 700)]
    windows = spark.createDataFrame(spans, SPAN)
    files = spark.createDataFrame([("t0", str(folder / "t0.bw"))], "track_id string, path string")
    want = rows(bigwig.read_bigwig_windows(files, windows))
    monkeypatch.setattr(bigwig, "MOST_EXTENTS", 3)
    assert bigwig.regions_of(windows) is None and rows(bigwig.read_bigwig_windows(files, windows)) == want
    with pytest.raises(ValueError, match="chr3"):
        bigwig.read_bigwig_windows(files, windows.union(spark.createDataFrame([("chr3", 0, 2_000_001)], SPAN)))


def test_a_window_past_the_end_fails(spark, track):
    folder, _ = track
    files = spark.createDataFrame([("t0", str(folder / "t0.bw"))], "track_id string, path string")
    with pytest.raises(PySparkException, match="track t0"):
        bigwig.read_bigwig_windows(files, spark.createDataFrame([("chr1", 1_999_990, 2_000_001)], SPAN)).collect()
    assert bigwig.read_bigwig_windows(files, spark.createDataFrame([("chr1", 1_999_990, 2_000_000)], SPAN)).count() == 0


def test_extents_by_brute_force():
    rng = np.random.default_rng(2)
    cuts = np.sort(rng.choice(1000, 40, replace=False))
    spans = {1: (cuts[::2], cuts[1::2]), 4: (np.array([10]), np.array([20]))}
    extents = bigwig.Extents(spans)
    for _ in range(500):
        first = int(rng.integers(0, 5))
        last = min(4, first + int(rng.integers(0, 2)))
        start, end = sorted(int(x) for x in rng.integers(0, 1001, 2))
        end += 1
        want = any((n, s) < (last, end) and (n, e) > (first, start) for n, (a, b) in spans.items() for s, e in zip(a, b)) if (first, start) < (last, end) else None
        if want is not None:
            assert extents.meets(first, start, last, end) == want
    starts = rng.integers(0, 1000, 300)
    assert extents.kept(1, starts, starts + 3).tolist() == [any(s < e and x + 3 > s and x < e for s, e in zip(*spans[1])) for x in starts]
    assert not extents.kept(2, starts, starts + 3).any()


def genome(tmp_path, ending="\n"):
    rng = random.Random(8)
    want, lines = {}, []
    for name, n, width in (("a", 1000, 60), ("b", 0, 60), ("c", 37, 60), ("d", 5003, 50), ("e", 120, 60)):
        want[name] = "".join(rng.choice("ACGTNacgt") for _ in range(n))
        lines += [f">{name} more words", *(want[name][i : i + width] for i in range(0, n, width))]
    path = tmp_path / "g.fa"
    path.write_bytes((ending.join(lines) + ending).encode())
    return str(path), want


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_fasta_index_and_windows(spark, tmp_path, ending):
    path, want = genome(tmp_path, ending)
    made = {r["chrom"]: r for r in fasta.make_fasta_index(spark, path, split=257).collect()}
    assert {c: r["length"] for c, r in made.items()} == {c: len(s) for c, s in want.items()}
    assert rows(fasta.make_fasta_index(spark, path)) == sorted(map(tuple, made.values()))
    index = spark.createDataFrame(list(made.values()), fasta.INDEX)
    rng = random.Random(9)
    spans = [(k, c, s, min(len(want[c]), s + rng.randrange(1, 300))) for k in range(40) for c in ("a", "c", "d", "e") for s in [rng.randrange(len(want[c]))]]
    windows = spark.createDataFrame(spans, "n int, chrom string, start long, end long")
    got = fasta.read_fasta_windows(spark, path, windows, index).collect()
    assert len(got) == len(spans) and all(r["seq"] == want[r["chrom"]][r["start"] : r["end"]] for r in got)
    scanned = {tuple(r)[:4]: r["seq"] for r in text.window_sequences(windows, text.read_fasta(spark, path)).collect()}
    assert scanned == {tuple(r)[:4]: r["seq"] for r in got}
    (tmp_path / "g.fa.fai").write_text("".join("\t".join(map(str, r)) + "\n" for r in made.values()))
    assert {tuple(r) for r in fasta.read_fasta_windows(spark, path, windows).collect()} == {tuple(r) for r in got}
    for bad in (("a", 990, 1001), ("x", 0, 5), ("a", 5, 5)):
        with pytest.raises(PySparkException, match="no sequence"):
            fasta.read_fasta_windows(spark, path, spark.createDataFrame([bad], SPAN), index).collect()


def test_only_the_bytes_of_a_window_are_read(spark, tmp_path):
    path, want = genome(tmp_path)
    index = fasta.make_fasta_index(spark, path).withColumnRenamed("chrom", "c")
    first, stop = fasta.byte_span(F.col("start"), F.col("end"))
    spans = spark.createDataFrame([("d", 100, 180), ("a", 59, 61)], SPAN).join(index, F.col("chrom") == F.col("c"))
    assert sorted(r[0] for r in spans.select(stop - first).collect()) == [3, 81]


def test_records_of_uneven_lines_have_no_index(spark, tmp_path):
    (tmp_path / "u.fa").write_text(">a\nACGT\nAC\nACGT\n>b\nAC\nA\n")
    with pytest.raises(PySparkException, match="different lengths"):
        fasta.make_fasta_index(spark, str(tmp_path / "u.fa")).collect()


def test_an_index_is_made_by_blocks(spark, tmp_path, monkeypatch):
    """A task holds a block and not its split; records may cross any border."""
    path, want = genome(tmp_path)
    monkeypatch.setattr(fasta, "BLOCK_BYTES", 128)
    made = fasta.make_fasta_index(spark, path)
    assert {r["chrom"]: r["length"] for r in made.collect()} == {c: len(s) for c, s in want.items()}
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0
    monkeypatch.undo()
    assert rows(made) == rows(fasta.make_fasta_index(spark, path))
