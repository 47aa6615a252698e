"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

1. One pass over the texts gives each document the hash of its shingle set and
   a MinHash signature. Documents with the same set are copies: one class, one
   row from here on.
2. The signature is cut into trees; a tree's label is a row of values and its
   prefixes are the nodes of a trie. Classes that share a prefix are candidates.
   The prefix is the longest one with which a pair at the threshold meets in
   some tree with the target probability, whatever else is in the table.
3. Classes that meet inside one Arrow batch are joined there; one root stands for
   them, with the distinct prefixes of all. Roots of one prefix are tied to the
   smallest of them, and the ties make candidate groups: a large bucket costs a
   row for a batch, never a pair.
4. Groups are cut into blocks of bounded size; each pair of blocks is one task
   unit that compares exact shingle sets. It returns, for each class, a count of
   links and one tie; no row is made for a pair.
5. Each class keeps its smallest verified tie; the other ties join the ends of
   such ties, and these make the final classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.arrays import WordHashes, mixed, odd_factors, run_hashes, text_slices
from spanloom.llm.components import connected_components
from spanloom.llm.stages import written

SHINGLE = 5
TREES, DEPTH = 16, 8
#: A block holds about this many classes and shingles at most (or one class);
#: smaller groups are cut into up to ``BLOCKS`` blocks of ``LEAST_CLASSES``, so
#: that one group is the work of many tasks.
BLOCK_CLASSES, BLOCK_SHINGLES, LEAST_CLASSES, BLOCKS = 1024, 1 << 20, 128, 16


def shingle_sets(texts: list[bytes], words: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than five words are one
    shingle, no words none."""
    split = [raw.split() for raw in texts]
    hashes, starts = words.of(split)
    runs = run_hashes(hashes, SHINGLE)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        else:
            out.append(run_hashes(hashes[a:b], int(b - a), 13 + int(b - a)) if b > a else np.empty(0, np.uint64))
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a shingle set."""
    total = mixed(shingles).sum(keepdims=True, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total += np.bitwise_xor.reduce(mixed(shingles + np.uint64(1)), keepdims=True) if len(shingles) else np.uint64(0)
    return int(mixed(total + np.uint64(len(shingles))).astype(np.int64)[0])


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` MinHash values (32 bits) of each set; zeros for an empty one."""
    out = np.zeros((len(sets), count), np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    if filled:
        flat = np.concatenate([sets[i] for i in filled])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in filled])[:-1]))
        for k, factor in enumerate(odd_factors(count, 17)):
            drawn = flat * factor
            drawn ^= drawn >> np.uint64(29)
            drawn *= np.uint64(0xBF58476D1CE4E5B9)
            out[filled, k] = np.minimum.reduceat(drawn >> np.uint64(32), starts).astype(np.uint32)
    return out


def _signed(docs: DataFrame, id: str, text: str, trees: int, depth: int) -> DataFrame:
    rows = docs.selectExpr(f"`{id}` as doc_id", f"cast(`{text}` as binary) as text", f"xxhash64(cast(`{text}` as binary)) as text_hash")
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                sets = shingle_sets(texts, words)
                drawn = signatures(sets, trees * depth)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), batch.column(2).slice(start, len(texts)), pa.array([set_hash(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([row.tobytes() for row in drawn], pa.binary())],
                    names=["doc_id", "text_hash", "node", "n_shingles", "signature"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, node long, n_shingles long, signature binary")


def _local_roots(keys: np.ndarray) -> np.ndarray:
    """For each row the first row of its component; rows are tied where they have
    one value in one column."""
    columns = [np.unique(column, return_inverse=True)[1] for column in keys.T]
    label = np.arange(len(keys))
    while True:
        before = label
        for column in columns:
            least = np.full(len(keys), len(keys))
            np.minimum.at(least, column, label)
            label = np.minimum(label, least[column])
        label = label[label]
        if (label == before).all():
            return label


def _met(classes: DataFrame, trees: int, depth: int, prefix: int) -> DataFrame:
    """(node, root, bucket): ``node`` and the root of its batch's component (with
    no bucket), and the distinct buckets of each root (with no node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_factors(prefix, 23)
        tree = np.arange(1, trees + 1, dtype=np.uint64)
        for batch in batches:
            if batch.num_rows:
                values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, trees, depth)[:, :, :prefix].astype(np.uint64)
                keys = mixed(((values * factors).sum(axis=2, dtype=np.uint64) + tree * np.uint64(0x9E3779B97F4A7C15)).ravel()).reshape(-1, trees)
                nodes = np.asarray(batch.column(0))
                first = _local_roots(keys)
                tied = np.flatnonzero(first != np.arange(len(first)))
                pairs = np.unique(np.stack((np.repeat(nodes[first], trees), keys.ravel().astype(np.int64))), axis=1)
                n, m = len(tied), pairs.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(nodes[tied]), pa.nulls(m, pa.int64())]), pa.array(np.concatenate((nodes[first[tied]], pairs[0]))), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(pairs[1])])],
                    names=["node", "root", "bucket"],
                )

    return classes.filter("n_shingles > 0").select("node", "signature").mapInArrow(run, "node long, root long, bucket long")


def _candidate_groups(classes: DataFrame, trees: int, depth: int, prefix: int) -> DataFrame:
    """(node, component) of the classes that share a bucket with another one."""
    met = written(_met(classes, trees, depth, prefix))
    rows = met.filter(F.col("bucket").isNotNull()).select("root", "bucket")
    heads = rows.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("most")).filter("a < most").select("bucket", "a")
    ties = rows.join(heads, "bucket").filter("root <> a").select("a", F.col("root").alias("b")).distinct()
    groups = written(connected_components(ties))
    local = met.filter(F.col("node").isNotNull()).select("node", "root")
    roots = local.select("root").unionByName(groups.select(F.col("node").alias("root"))).distinct()
    members = local.unionByName(roots.select(F.col("root").alias("node"), "root"))
    return members.join(groups.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("component", "root").alias("component"))


def prefix_for(threshold: float, target_recall: float, trees: int, depth: int) -> int:
    """Longest prefix that a pair at the threshold shares in one of the trees
    with probability ``target_recall`` or more; 1 where none reaches it."""
    return next((p for p in range(depth, 1, -1) if 1 - (1 - threshold**p) ** trees >= target_recall), 1)


def _compare(left: list[tuple], right: list[tuple] | None, threshold: float) -> list[tuple[int, int, int]]:
    """(node, links, tie): links weigh the copies of the partner. ``right`` None:
    all pairs within ``left``."""
    rows = left + (right or [])
    ids = np.unique(np.concatenate([row[2] for row in rows]), return_inverse=True)[1]
    cuts = np.cumsum([0, *(len(row[2]) for row in rows)])
    sizes = np.diff(cuts)
    copies = np.array([row[1] for row in rows])
    mark = np.zeros(int(ids.max()) + 1, bool)
    links = np.zeros(len(rows), np.int64)
    label = np.arange(len(rows))
    for i in range(len(left)):
        first = i + 1 if right is None else len(left)
        if first == len(rows):
            continue
        own = ids[cuts[i] : cuts[i + 1]]
        mark[own] = True
        common = np.add.reduceat(mark[ids[cuts[first] :]], cuts[first:-1] - cuts[first], dtype=np.int64)
        mark[own] = False
        linked = first + np.flatnonzero(common >= threshold * (sizes[i] + sizes[first:] - common) - 1e-9)
        if len(linked):
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            met = np.unique(label[np.append(linked, i)])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return [(row[0], int(n), rows[label[k]][0]) for k, (row, n) in enumerate(zip(rows, links)) if n]


def _verified(docs: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, id: str, text: str) -> DataFrame:
    """(node, links, tie) of all pairs of blocks of every candidate group."""
    members = groups.join(classes.select("node", "n_copies", "n_shingles", "first_id"), "node")
    sizes = members.groupBy("component").agg(F.greatest(F.least(F.lit(BLOCKS), F.ceil(F.count(F.lit(1)) / LEAST_CLASSES)), F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"))
    placed = written(members.join(sizes, "component").select("node", "component", "n_copies", "first_id", "n_blocks", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block")))
    wanted = placed.select(F.col("first_id").alias("doc_id")).distinct()
    rows = docs.selectExpr(f"`{id}` as doc_id", f"cast(`{text}` as binary) as text")
    rows = rows.join(wanted.withColumnRenamed("doc_id", "wanted"), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                found = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "shingles"])

    # Rows that repeat a text would repeat its set in every unit.
    content = rows.mapInArrow(sets, "node long, shingles binary").dropDuplicates(["node"])
    partners = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda j: F.struct(F.least("block", j).alias("low"), F.greatest("block", j).alias("high")))
    units = placed.join(content, "node").select("component", "node", "n_copies", "block", "shingles", F.explode(partners).alias("unit")).select("component", "unit.low", "unit.high", "node", "n_copies", "block", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        parts = zip(*(table.column(c).to_pylist() for c in ("node", "n_copies", "shingles", "block")))
        order = sorted(((node, n, np.frombuffer(shingles, np.uint64), block) for node, n, shingles, block in parts), key=lambda row: row[0])
        found = _compare(order, None, threshold) if low == high else _compare([r for r in order if r[3] == low], [r for r in order if r[3] == high], threshold)
        return pa.table({name: pa.array([f[k] for f in found], pa.int64()) for k, name in enumerate(("node", "links", "tie"))})

    return units.groupBy("component", "low", "high").applyInArrow(compare, "node long, links long, tie long")


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = 0.8, target_recall: float = 0.999, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """``doc_id, class_id, n_links, class_key, text_hash`` for each row of ``docs``.

    ``class_id`` is the smallest id of the connected documents; ``n_links`` the
    number of other rows whose five-word shingle sets have a Jaccard similarity
    of ``threshold`` or more with this row's, copies included. Words are runs of
    ``[^\\x20\\x09-\\x0D]``, unchanged. A text of one to four words is one
    shingle; texts without words (null ones too) are copies of each other and
    of nothing else. Repeated rows are copies. Null ids are kept and count as
    the smallest class name only where a class has no other. ``class_key`` tells
    classes apart also without an id, ``text_hash`` rows of one id. An empty
    table gives no row; further columns are ignored.
    """
    signed = written(_signed(docs, id, text, trees, depth))
    classes = written(signed.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    groups = _candidate_groups(classes, trees, depth, prefix_for(threshold, target_recall, trees, depth))
    found = _verified(docs, classes, groups, threshold, id, text)
    # One tie of each class and the distinct ties between their ends; a class has
    # a tie for each pair of blocks at most.
    linked = written(found.groupBy("node").agg(F.sum("links").alias("links"), F.min("tie").alias("head"), F.collect_set("tie").alias("ties")))
    joined = connected_components(linked.select(F.col("head").alias("a"), F.explode("ties").alias("b")))
    links = linked.select("node", "links", "head").join(joined.select(F.col("node").alias("head"), "component"), "head").select("node", "links", "component")
    named = classes.select("node", "first_id", "n_copies").join(links, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    by_node = named.join(names, "component").select("node", "class_id", F.col("component").alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"))
    return signed.select("doc_id", "text_hash", "node").join(by_node, "node").select("doc_id", "class_id", "n_links", "class_key", "text_hash")


def keep_first(docs: DataFrame, classes: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, all columns of ``docs``: one with the id that names
    it, of those the one with the smallest hash of its text. Rows with a null id
    or with one id are apart where their classes are."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = classes.groupBy("class_key").agg(F.min(order).alias("first")).select("first.*")
    keys = ["__none", "__id", "__hash"]
    wanted = first.select(F.col("none").alias("__none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("text_hash").alias("__hash"))
    given = F.col(f"`{id}`")
    hashed = docs.select("*", given.isNull().alias("__none"), F.coalesce(given.cast("string"), F.lit("")).alias("__id"), F.xxhash64(F.col(f"`{text}`").cast("binary")).alias("__hash"))
    # One exchange by the three keys serves both steps.
    return hashed.join(wanted, keys, "left_semi").dropDuplicates(keys).select(*(F.col(f"`{c}`") for c in docs.columns))
