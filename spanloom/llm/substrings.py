"""Repeated-passage removal with suffix automata of reference shards.

A word goes when a window of ``length`` words over it also starts in a document
with a smaller id. Windows are routed by their minimiser, the least-hashed
five-word run inside them: equal windows have equal minimisers, and neighbouring
windows mostly share one, so they travel as one short snippet.

1. Each slice of texts sends every minimiser once to its hash bucket; buckets
   tell which minimisers two documents share. Those shared inside a slice are
   known there already, so a passage in very many documents sends one entry for
   a slice, not for a document.
2. Snippets around shared minimisers are made distinct, keeping the smallest
   document of each. Words travel as 32 bits of their hash: the windows of one
   minimiser would have to differ in words that collide to be taken for equal.
   The windows of minimisers in very many documents are snippets of their own.
3. The distinct snippets of a range of minimisers form a reference shard of
   bounded size. Its suffix automaton carries the smallest document of every
   state; the snippets are streamed through it, and the state of each matching
   statistic that reaches ``length`` names the first document of that window.
4. The answers return to the documents, whose windows are removed where another
   document comes first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.arrays import WordHashes, mixed, odd_factors, run_hashes, runs_inside, text_slices
from spanloom.llm.stages import written

ANCHOR = 5
#: Words of one automaton at most (or one minimiser's snippets).
SHARD_WORDS = 100_000
#: A minimiser of this many documents or more is hot: each of its windows goes to
#: a shard of its own hash. The list of hot ones is broadcast and kept to a fixed
#: size by a higher limit where there are more.
HOT_DOCUMENTS, HOT_LIST = 20_000, 1_000_000
#: Bytes of text for each bucket of minimisers, and for each four shards.
BUCKET_BYTES = 4 << 20
#: Bytes of text from which snippets are made distinct at once.
SNIPPET_BYTES = 8 << 20
NULL_ID = -(2**63)


def minimisers(hashes: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts of a slice: first window, last window and anchor of each run
    of windows that share their minimiser; windows count from the slice's start."""
    grams = run_hashes(hashes, ANCHOR)
    span = length - ANCHOR + 1
    n = len(hashes) - length + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    least = grams[:n].copy()
    for k in range(1, span):
        np.minimum(least, grams[k : k + n], out=least)
    inside = runs_inside(starts, length)
    opens = np.ones(n, bool)
    opens[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    first = np.flatnonzero(opens & inside)
    closes = np.ones(n, bool)
    closes[:-1] = opens[1:] | ~inside[1:]
    return first, np.flatnonzero(closes & inside), least[first]


def _owners(starts: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, windows, "right") - 1


def snippet_keys(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the words of each snippet, by prefix sums of a polynomial."""
    factor = int(odd_factors(1, 37)[0])
    powers = np.cumprod(np.full(len(hashes), factor, np.uint64))
    back = np.cumprod(np.full(len(hashes), pow(factor, -1, 1 << 64), np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * powers, dtype=np.uint64)))
    return mixed((sums[last + length] - sums[first]) * back[first] + (last - first).astype(np.uint64))


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences with the smallest document
    of every state."""

    def __init__(self, sequences: list[tuple[list[int], int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.first = [-1], [0], [2**63 - 1]
        for words, doc in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word, doc)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            parent = self.link[state]
            if self.first[state] < self.first[parent]:
                self.first[parent] = self.first[state]

    def _add(self, size: int, link: int, first: int, moves: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.first.append(first)
        self.next.append(moves)
        return len(self.size) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        copy = self._add(self.size[p] + 1, self.link[q], 2**63 - 1, dict(self.next[q]))
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int, doc: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            at = q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
            if doc < self.first[at]:
                self.first[at] = doc
            return at
        new = self._add(self.size[last] + 1, 0, doc, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
        return new

    def first_documents(self, words: list[int], length: int) -> list[int]:
        """Smallest document of each window of ``length`` words, by the matching
        statistics of ``words``; -1 marks a window that does not occur."""
        out, state, matched = [], 0, 0
        following, link, size = self.next, self.link, self.size
        for at, word in enumerate(words, 1):
            while state and word not in following[state]:
                state = link[state]
                matched = size[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            while link[state] >= 0 and size[link[state]] >= length:
                state = link[state]
                matched = size[state]
            if at >= length:
                out.append(self.first[state] if matched >= length else -1)
        return out


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The id orders documents; a hash of id and text names a row."""
    number, content = F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(NULL_ID)), F.col(f"`{text}`").cast("binary")
    return docs.select(F.xxhash64(number, content).alias("row_key"), number.alias("doc_id"), content.alias("text"))


def _shared_anchors(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """(row_key, anchor, n_docs) of minimisers that two rows or more have;
    ``n_docs`` is null but for one row without ``row_key`` for each hot one."""
    limit = HOT_DOCUMENTS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            ids = np.asarray(batch.column("row_key"))
            for start, texts in text_slices(batch, "text"):
                hashes, starts = words.of([raw.split() for raw in texts])
                first, _, anchors = minimisers(hashes, starts, length)
                if not len(anchors):
                    continue
                owner = ids[start : start + len(texts)][_owners(starts, first)]
                order = np.lexsort((owner, anchors))
                anchors, owner = anchors[order], owner[order]
                new = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])))
                anchors, owner = anchors[new], owner[new]
                lead = np.concatenate(([True], anchors[1:] != anchors[:-1]))
                group = np.cumsum(lead) - 1
                tail = np.concatenate((np.flatnonzero(lead)[1:], [len(anchors)])) - 1
                here = owner[np.flatnonzero(lead)] != owner[tail]  # shared inside this slice
                single, owners = anchors[lead], owner[lead]
                sizes = np.diff(np.concatenate((np.flatnonzero(lead), [len(anchors)]))).astype(np.uint32)
                bucket = (single >> np.uint64(40)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = [(b, single[order[x:y]], owners[order[x:y]], sizes[order[x:y]], False) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if y > x]
                known = here[group]
                if known.any():
                    out.append((int(anchors[0] >> np.uint64(40)) % buckets, anchors[known], owner[known], sizes[:0], True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1].tobytes() for o in out], pa.binary()), pa.array([o[2].astype(np.int64).tobytes() for o in out], pa.binary()), pa.array([o[3].tobytes() for o in out], pa.binary()), pa.array([o[4] for o in out])],
                    names=["bucket", "anchors", "owners", "sizes", "known"],
                )

    def meet(table: pa.Table) -> pa.Table:
        known = np.asarray(table.column("known"))
        anchors = [np.frombuffer(x, np.uint64) for x in table.column("anchors").to_pylist()]
        owners = [np.frombuffer(x, np.int64) for x in table.column("owners").to_pylist()]
        join = lambda parts, want, kind: np.concatenate([np.empty(0, kind), *(p for p, k in zip(parts, known) if k == want)])
        a, o = join(anchors, False, np.uint64), join(owners, False, np.int64)
        n = np.concatenate([np.empty(0, np.uint32), *(np.frombuffer(x, np.uint32) for x in table.column("sizes").to_pylist())])
        order = np.lexsort((o, a))
        a, o, n = a[order], o[order], n[order].astype(np.int64)
        hot, total = a[:0], n[:0]
        if len(a):
            lead = np.concatenate(([True], a[1:] != a[:-1]))
            begin = np.flatnonzero(lead)
            end = np.concatenate((begin[1:], [len(a)])) - 1
            total = np.add.reduceat(n, begin)
            hot, total = a[begin][total >= limit], total[total >= limit]
            keep = (o[begin] != o[end])[np.cumsum(lead) - 1]
            a, o = a[keep], o[keep]
        found = np.concatenate((a, join(anchors, True, np.uint64), hot)).astype(np.int64)
        docs = np.concatenate((o, join(owners, True, np.int64)))
        return pa.table(
            {
                "row_key": pa.concat_arrays([pa.array(docs), pa.nulls(len(hot), pa.int64())]),
                "anchor": pa.array(found),
                "n_docs": pa.concat_arrays([pa.nulls(len(docs), pa.int64()), pa.array(total, pa.int64())]),
            }
        )

    sent = rows.mapInArrow(send, "bucket long, anchors binary, owners binary, sizes binary, known boolean")
    return sent.groupBy("bucket").applyInArrow(meet, "row_key long, anchor long, n_docs long")


def _hot_anchors(shared: DataFrame) -> np.ndarray:
    """The hot minimisers, ``HOT_LIST`` at most."""
    found, limit = shared.filter(F.col("n_docs").isNotNull()), HOT_DOCUMENTS
    while found.filter(F.col("n_docs") >= limit).count() > HOT_LIST:
        limit *= 2
    return np.array([r["anchor"] for r in found.filter(F.col("n_docs") >= limit).collect()], np.int64).astype(np.uint64)


def _snippets(joined: DataFrame, length: int, shards: int, hot) -> DataFrame:
    """The snippets of shared minimisers: with ``shards``, each distinct one of a
    slice as (shard, key, doc_id, anchor, words), the smallest document named;
    without, every one as (key, doc_id, row_key, first_window)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            ids, rows, shared = np.asarray(batch.column("doc_id")), np.asarray(batch.column("row_key")), batch.column("anchors")
            for start, texts in text_slices(batch, "text", SNIPPET_BYTES):
                hashes, starts = words.of([raw.split() for raw in texts])
                first, last, anchor = minimisers(hashes, starts, length)
                # A minimiser is shared for all its documents or for none.
                wanted = np.isin(anchor, np.asarray(shared.slice(start, len(texts)).flatten()).astype(np.uint64))
                if not wanted.any():
                    continue
                first, last, anchor = first[wanted], last[wanted], anchor[wanted]
                apart = np.isin(anchor, hot.value)
                count = np.where(apart, last - first + 1, 1)
                at = np.repeat(np.arange(len(first)), count)
                step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                first, apart, anchor = first[at] + step, apart[at], anchor[at]
                last = np.where(apart, first, last[at])
                owner = _owners(starts, first)
                keys, docs = snippet_keys(hashes, first, last, length), ids[start + owner]
                anchor = np.where(apart, keys, anchor)
                if not shards:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(docs), pa.array(rows[start + owner]), pa.array(first - starts[owner])], names=["key", "doc_id", "row_key", "first_window"])
                    continue
                order = np.lexsort((docs, keys))
                order = order[np.concatenate(([True], keys[order][1:] != keys[order][:-1]))]
                size = last[order] - first[order] + length
                cuts = np.concatenate(([0], np.cumsum(size)))
                flat = np.repeat(first[order] - cuts[:-1], size) + np.arange(cuts[-1])
                content = pa.Array.from_buffers(pa.binary(), len(order), [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer((hashes[flat] >> np.uint64(32)).astype(np.uint32))])
                yield pa.RecordBatch.from_arrays([pa.array(((anchor[order] >> np.uint64(8)) % np.uint64(shards)).astype(np.int64)), pa.array(keys[order].astype(np.int64)), pa.array(docs[order]), pa.array(anchor[order].astype(np.int64)), content], names=["shard", "key", "doc_id", "anchor", "words"])

    return joined.mapInArrow(run, "shard long, key long, doc_id long, anchor long, words binary" if shards else "key long, doc_id long, row_key long, first_window long")


def _first_documents(snippets: DataFrame, length: int) -> DataFrame:
    """(key, firsts): the smallest document of each window of each snippet."""

    def run(table: pa.Table) -> pa.Table:
        keys, docs, anchors = (np.asarray(table.column(c)) for c in ("key", "doc_id", "anchor"))
        order = np.lexsort((docs, keys, anchors))
        order = order[np.concatenate(([True], keys[order][1:] != keys[order][:-1]))]
        keys, docs, anchors = keys[order], docs[order], anchors[order]
        words = [np.frombuffer(w, np.uint32) for w in table.column("words").take(pa.array(order)).to_pylist()]
        begins = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1], [True]))).tolist()
        out: list = [None] * len(words)
        held: list[int] = []
        size = 0

        def answer() -> None:
            shard = SuffixAutomaton([(sequences[i], int(docs[i])) for i in held])
            for i in held:
                out[i] = shard.first_documents(sequences[i], length)

        sequences: dict[int, list[int]] = {}
        for a, b in zip(begins, begins[1:]):
            if b - a == 1:  # one snippet: all its windows are first in its document
                out[a] = [int(docs[a])] * (len(words[a]) - length + 1)
                continue
            for i in range(a, b):
                sequences[i] = words[i].tolist()
                size += len(words[i])
            held += range(a, b)
            if size >= SHARD_WORDS:
                answer()
                held, size = [], 0
                sequences.clear()
        if held:
            answer()
        return pa.table({"key": pa.array(keys), "firsts": pa.array(out, pa.list_(pa.int64()))})

    return snippets.groupBy("shard").applyInArrow(run, "key long, firsts array<bigint>")


def remove_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = 13) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged; kept words are joined by
    one space. Windows are judged on the input. Null and empty texts have no
    words; texts under ``length`` words lose none; rows that repeat a ``doc_id``
    are the same document, so neither is before the other, and each is judged by
    its own text; a null ``doc_id`` is smaller than any other. An empty table
    gives no row. Further columns are ignored.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, id, text)
    # What a bucket and a shard hold is bounded by bytes of text, at every size.
    pieces = math.ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / BUCKET_BYTES)
    found = written(_shared_anchors(rows, length, max(2 * tasks, pieces)))
    hot = spark.sparkContext.broadcast(_hot_anchors(found))
    shared = found.filter(F.col("n_docs").isNull()).groupBy("row_key").agg(F.collect_set("anchor").alias("anchors"))
    joined = rows.join(shared, "row_key").select("row_key", "doc_id", "text", "anchors")
    firsts = _first_documents(_snippets(joined, length, max(4 * tasks, 4 * pieces), hot), length)
    answers = (
        _snippets(joined, length, 0, hot)
        .join(firsts, "key")
        .select("doc_id", "row_key", "first_window", F.filter(F.transform("firsts", lambda d, i: F.when(d < F.col("doc_id"), i)), lambda i: i.isNotNull()).alias("gone"))
        .filter(F.size("gone") > 0)
        .groupBy("row_key")
        .agg(F.flatten(F.collect_set(F.transform("gone", lambda i: F.col("first_window") + i))).alias("windows"))
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = batch.column(2)
            for start, texts in text_slices(batch, "text"):
                sizes, removed, kept = [], [], []
                for i, raw in enumerate(texts):
                    words = raw.split()
                    gone = windows[start + i]
                    n = 0
                    if gone.is_valid:
                        edge = np.zeros(len(words) + 1, np.int64)
                        at = np.unique(np.asarray(gone.values))
                        at = at[at + length <= len(words)]
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + length, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        n = len(words) - int(stay.sum())
                        left = [w for w, s in zip(words, stay) if s]
                    sizes.append(len(words))
                    removed.append(n)
                    kept.append(b" ".join(left if gone.is_valid else words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    out = rows.join(answers, "row_key", "left").select("doc_id", "text", "windows").mapInArrow(rewrite, "doc_id long, n_words long, n_removed long, kept binary")
    return out.select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept_text"))
