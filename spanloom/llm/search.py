"""Ranked lexical search: branch and bound over FP-trees of documents.

The items are the queries. A document is cut down to the terms of the items, with
their frequencies, and its terms are ordered by the number of documents that hold
them, the most frequent first. Sorted vectors share their first terms, so the
documents of a block form an FP-tree: a node is the run of documents that share a
path. Each node knows, for every term below it, the greatest term frequency, and
the least length factor ``m``; both together bound the score of any document under
it. For each item the tree is searched depth first, the best bound next, and a
branch is left when its bound is below the item's current last place.

Blocks of documents lie wherever their rows are; no document is shuffled. A task
sends at most ``top`` rows an item, whatever the number of its documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.arrays import FOLD, text_slices
from spanloom.llm.stages import written

#: Terms of documents held in one tree; a tree has one document at least.
TREE_TERMS = 600_000
#: Runs of documents up to this size are no nodes of their own.
LEAST_NODE = 32
#: Bytes of item texts whose terms go out as one vocabulary; more items take
#: another pass over the documents.
ITEM_BYTES = 16 << 20
#: Fixed values of the score.
SCALE, TF_FACTOR, M_FACTOR = 1_000_000_000, 1000, 12


def terms_of(raw: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case."""
    return raw.translate(FOLD).split()


def _restricted(rows: DataFrame, vocabulary) -> DataFrame:
    """``id, n, terms, tfs`` of each document with a term: the number of its terms,
    and those of the vocabulary with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary.value)}
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                found = [terms_of(raw) for raw in texts]
                sizes = np.array(list(map(len, found)), np.int64)
                codes = np.fromiter((number.get(term, -1) for terms in found for term in terms), np.int64, int(sizes.sum()))
                of = np.repeat(np.arange(len(texts)), sizes)
                keys, tfs = np.unique((of * len(number) + codes)[codes >= 0], return_counts=True)
                per_row = np.bincount(keys // len(number), minlength=len(texts)) if number else np.zeros(len(texts), np.int64)
                offsets = pa.array(np.concatenate(([0], np.cumsum(per_row))), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32())) for values in (keys % max(len(number), 1), tfs)]
                made = pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(sizes), *lists], names=["id", "n", "terms", "tfs"])
                yield made.filter(pa.array(sizes > 0))

    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<int>")


def gain(tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight: more for a greater frequency, less for a greater ``m``."""
    return SCALE * tfs // (TF_FACTOR * tfs + M_FACTOR * m)


class _Node:
    """The parts of a run of documents: single documents and smaller runs. Their
    terms lie one after another, each with its gain, those of a run with the
    greatest frequencies and the least ``m`` in it."""

    __slots__ = ("low", "high", "documents", "runs", "terms", "gains", "starts", "greatest", "least_m")


class Tree:
    """FP-tree of a block. ``ranks`` (ascending in each row) and ``tfs`` lie behind
    one another, ``starts`` says where each row begins; ``m`` is one per row."""

    def __init__(self, starts: np.ndarray, ranks: np.ndarray, tfs: np.ndarray, m: np.ndarray):
        big = ranks.astype(">u4").tobytes()
        keys = [big[4 * a : 4 * b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
        self.order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.starts, self.ranks, self.tfs, self.m = starts, ranks, tfs, m
        self.shared = self._shared_terms()
        self.nodes: list[_Node] = []
        self._grow()
        for node in reversed(self.nodes):  # parts are made after what they are part of
            self._fill(node)

    def _shared_terms(self) -> np.ndarray:
        """How many first terms each row shares with the next one in order."""
        one, two = self.order[:-1], self.order[1:]
        sizes = np.diff(self.starts)
        least = np.minimum(sizes[one], sizes[two])
        shared = least.copy()
        total = int(least.sum())
        if total:
            begins = np.cumsum(least) - least
            at = np.arange(total) - np.repeat(begins, least)
            same = self.ranks[np.repeat(self.starts[one], least) + at] == self.ranks[np.repeat(self.starts[two], least) + at]
            filled = np.flatnonzero(least)
            shared[filled] = np.minimum.reduceat(np.where(same, np.repeat(least, least), at), begins[filled])
        return shared

    def _grow(self) -> None:
        """Cut each run where the fewest terms are shared, from the whole block down."""
        waiting: list[tuple[int, int, _Node | None, int]] = [(0, len(self.order), None, 0)]
        while waiting:
            low, high, above, place = waiting.pop()
            node = _Node()
            node.low, node.high = low, high
            self.nodes.append(node)
            if above is not None:
                above.runs[place] = node
            inner = self.shared[low : high - 1]
            cuts = low + 1 + np.flatnonzero(inner == inner.min()) if high - low > 1 else np.empty(0, np.int64)
            lows, highs = np.concatenate(([low], cuts)), np.concatenate((cuts, [high]))
            large = highs - lows > LEAST_NODE
            node.runs = [None] * int(large.sum())
            waiting += [(int(a), int(b), node, k) for k, (a, b) in enumerate(zip(lows[large], highs[large]))]
            inside = np.ones(high - low, bool)
            for a, b in zip(lows[large] - low, highs[large] - low):
                inside[a:b] = False
            node.documents = self.order[low:high][inside]

    def _fill(self, node: _Node) -> None:
        rows = node.documents
        sizes = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        terms, tfs, ms = [self.ranks[at]], [self.tfs[at]], [np.repeat(self.m[rows], sizes)]
        for run in node.runs:
            terms.append(run.greatest[0])
            tfs.append(run.greatest[1])
            ms.append(np.full(len(run.greatest[0]), run.least_m))
        lengths = np.concatenate((sizes, [len(x) for x in terms[1:]])).astype(np.int64)
        node.terms, tf = np.concatenate(terms), np.concatenate(tfs)
        node.gains = gain(tf, np.concatenate(ms))
        node.starts = np.concatenate(([0], np.cumsum(lengths)))
        node.least_m = min([int(self.m[rows].min())] if len(rows) else [], default=1 << 62)
        node.least_m = min([node.least_m, *(run.least_m for run in node.runs)])
        by_term = np.argsort(node.terms, kind="stable")
        known = node.terms[by_term]
        first = np.flatnonzero(np.concatenate(([True], known[1:] != known[:-1]))) if len(known) else np.empty(0, np.int64)
        node.greatest = (known[first], np.maximum.reduceat(tf[by_term], first)) if len(first) else (known, tf)

    def search(self, weights: np.ndarray, best: Best, ids: np.ndarray, nulls: np.ndarray) -> None:
        """Offer to ``best`` every document that may have a place; ``weights`` is one per term."""
        waiting = [(1 << 62, self.nodes[0])]
        while waiting:
            bound, node = waiting.pop()
            if bound < best.least:
                continue
            sums = np.concatenate(([0], np.cumsum(weights[node.terms] * node.gains)))
            totals = sums[node.starts[1:]] - sums[node.starts[:-1]]
            own = totals[: len(node.documents)]
            good = own >= best.least
            if good.any():
                rows = node.documents[good]
                best.offer(own[good], ids[rows], nulls[rows])
            below = totals[len(node.documents) :]
            open_ = np.flatnonzero(below >= best.least)
            waiting += [(int(below[k]), node.runs[k]) for k in open_[np.argsort(below[open_], kind="stable")]]


class Best:
    """The places of an item: highest score first, equal scores by id, null ids last."""

    def __init__(self, top: int):
        self.top, self.least = top, 1
        self.scores, self.ids, self.nulls = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        every = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids)), np.concatenate((self.nulls, nulls))
        kept = np.lexsort((every[1], every[2], -every[0]))[: self.top]
        self.scores, self.ids, self.nulls = (values[kept] for values in every)
        if len(kept) == self.top:
            self.least = int(self.scores[-1])


def _ranked(vectors: DataFrame, plan, top: int, item_kind: str, item_type: pa.DataType) -> DataFrame:
    """``item_no, item_id, doc_id, score``: up to ``top`` documents an item from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, items, documents, all_terms = plan.value
        best = [Best(top) for _ in items]
        weights = np.zeros(int(rank_of.max(initial=-1)) + 1, np.int64)

        def search(table: pa.Table) -> None:
            lists = table["terms"].combine_chunks()
            starts = lists.offsets.to_numpy().astype(np.int64)
            ranks = rank_of[lists.flatten().to_numpy()]
            tfs = table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            starts = starts - starts[0]
            order = np.lexsort((ranks, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
            m = np.array([75 + 25 * n * documents // all_terms for n in table["n"].to_pylist()], np.int64)
            ids = table["id"].combine_chunks()
            tree = Tree(starts, ranks[order], tfs[order], m)
            nulls, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            for (_, ranks_of_item, weights_of_item), places in zip(items, best):
                weights[ranks_of_item] = weights_of_item
                tree.search(weights, places, ids, nulls)
                weights[ranks_of_item] = 0

        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = np.cumsum(np.diff(table["terms"].combine_chunks().offsets.to_numpy()))
            done = 0
            while done < len(sizes):
                before = int(sizes[done - 1]) if done else 0
                until = max(int(np.searchsorted(sizes, before + TREE_TERMS - size, side="right")), done + (not held))
                held.append(table.slice(done, until - done))
                size += (int(sizes[until - 1]) if until else 0) - before
                done = until
                if done < len(sizes):
                    search(pa.concat_tables(held))
                    held, size = [], 0
        if held and sum(t.num_rows for t in held):
            search(pa.concat_tables(held))
        for no, ((item_id, _, _), places) in enumerate(zip(items, best)):
            n = len(places.scores)
            if n:
                ids = pa.array(places.ids, pa.int64(), mask=places.nulls)
                yield pa.RecordBatch.from_arrays([pa.array([no] * n, pa.int32()), pa.array([item_id] * n, item_type), ids, pa.array(places.scores)], names=["item_no", "item_id", "doc_id", "score"])

    return vectors.select("id", "n", "terms", "tfs").mapInArrow(run, f"item_no int, item_id {item_kind}, doc_id bigint, score bigint")


def _weights(frequency: dict[int, int], documents: int, items: list[tuple], number: dict[bytes, int]) -> tuple[np.ndarray, list[tuple]]:
    """The place of each term by frequency, and each item's terms with their weights times repeats."""
    by_frequency = sorted(frequency, key=lambda term: (-frequency[term], term))
    rank_of = np.full(len(number), -1, np.int64)
    rank_of[by_frequency] = np.arange(len(by_frequency))
    made = []
    for item_id, terms in items:
        codes, repeats = np.unique(np.array([number[t] for t in terms if number[t] in frequency], np.int64), return_counts=True)
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency[int(c)] + 1))) for c in codes]
        made.append((item_id, rank_of[codes], repeats * np.array(weight, np.int64)))
    return rank_of, made


def search_documents(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = 20) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each row of ``items`` the ``top`` rows
    of ``docs`` with the highest scores above 0, ranked from 1; equal scores are
    ordered by ascending id (an integer; null ids last).

    Null and blank texts have no terms: such a document is not counted and found by
    no item, such an item finds nothing. Repeated rows, of documents and of items,
    count and rank each on their own. A very long text is one vector. Empty tables
    give no rows; further columns are ignored, whatever their names. Items go out
    in blocks of bounded size, each with one pass over the documents.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = docs.selectExpr(f"cast(`{id}` as bigint) as id", f"cast(`{text}` as binary) as text")
    asked = written(items.selectExpr(f"`{item_id}` as item_id", f"cast(coalesce(`{item_text}`, '') as binary) as text"))
    field = asked.schema["item_id"]
    item_type = asked.select("item_id").limit(0).toArrow().schema.field(0).type
    blocks = -(-(asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // ITEM_BYTES)
    found = []
    for block in range(blocks):
        queries = [(r["item_id"], terms_of(bytes(r["text"]))) for r in asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()]
        number = {term: i for i, term in enumerate(sorted({t for _, terms in queries for t in terms}))}
        vectors = written(_restricted(rows, context.broadcast(list(number))))
        documents, all_terms = vectors.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequency = {r["term"]: r["count"] for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
        rank_of, weighted = _weights(frequency, documents, queries, number)
        plan = context.broadcast((rank_of, weighted, documents, all_terms))
        found.append(_ranked(vectors, plan, top, field.dataType.simpleString(), item_type).withColumn("block", F.lit(block)))
    if not found:
        return spark.createDataFrame([], f"item_id {field.dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    best_first = W.partitionBy("block", "item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
