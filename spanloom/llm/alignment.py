"""Token alignment of two tokenizers by the byte offsets where both end a token.

Each text is encoded twice, by a byte-level BPE vocabulary (A) on a space and the
text, and by a sentencepiece model (B), which adds that space itself. The ends of
the tokens, counted in bytes, go into one dictionary end -> index for each side;
the sorted intersection of their keys slices both id lists into groups, and each
slice is expanded into its links, the pairs of tokens whose bytes overlap.

No token of either side goes on from a character into a space behind it, so a text
falls into chunks there that are encoded and aligned apart. Chunks are mostly single
words and repeat; a task aligns each one once and keeps it.

Counts of id pairs are taken over the whole corpus. A task counts the pairs of a
slice of texts before anything is sent, so what is shuffled is a row for each
distinct pair of a slice, and a text's links travel as positions in the table of
its slice. Totals come back to the slices by a join on the pair.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm.arrays import text_slices
from spanloom.llm.bpe import PATTERN, byte_symbols
from spanloom.llm.stages import written

#: Fixed value: how a sentencepiece model writes a space.
SPACE = "▁"
#: Chunks and characters of chunks that a task keeps; it starts anew beyond them.
CHUNKS, CHUNK_CHARS = 250_000, 16 << 20
#: New chunks aligned at once.
ADDED = 1 << 15


#: A text's chunks: each begins with a space that follows no white space, and the
#: last one has the white space at the end.
CHUNK = re.compile(r" \s*\S+(?:[^\S ]\s*\S+)*(?:\s+\Z)?| \s*\Z")
WHOLE = re.compile(r".+", re.DOTALL)


class ByteLevel:
    """Side A: ids of a byte-level BPE; strings of special tokens are plain text."""

    def __init__(self, content: str):
        data = json.loads(content)
        of_symbol = byte_symbols()
        self.symbols = {byte: symbol for symbol, byte in of_symbol.items()}
        self.model = Tokenizer.from_str(content).model
        self.bytes_of = [b""] * (max(data["model"]["vocab"].values()) + 1)
        for token, i in data["model"]["vocab"].items():
            self.bytes_of[i] = bytes(of_symbol[c] for c in token) if all(c in of_symbol for c in token) else token.encode()
        self.pieces = regex.compile(PATTERN)

    def encode(self, chunk: str) -> list[int]:
        """Ids of a chunk with its space."""
        shown = [piece.encode().decode("latin-1").translate(self.symbols) for piece in self.pieces.findall(chunk)]
        return [token.id for piece in shown for token in self.model.tokenize(piece)]


class Pieces:
    """Side B: ids of a sentencepiece model, which adds the first space itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        #: Whether chunks have the ids that they have inside a text: no piece has a
        #: space after another character, and white space stays as it is.
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces) and b"".join(self.bytes_of[i] for i in self.model.encode("a  b ")) == b" a  b "

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode([chunk[1:] for chunk in chunks], num_threads=1)


def slices(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side lie before each common end, in order."""
    index_a, index_b = dict(zip(ends_a.tolist(), count(1))), dict(zip(ends_b.tolist(), count(1)))
    common = sorted(index_a.keys() & index_b.keys())
    before = (np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))
    return next(before), next(before)


def expanded(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cuts_a: np.ndarray) -> np.ndarray:
    """The links of all slices in order, each as A id * 2**32 + B id.

    Two overlapping tokens share the bytes up to the first end of the two, so each
    end inside a slice closes one link, and the common end of a slice closes its
    last one: the ends of A that are no cut, and all ends of B, are one link each.
    """
    inner = np.ones(len(ends_a), bool)
    inner[cuts_a - 1] = False
    first_b = np.searchsorted(ends_b, ends_a[inner])
    first_a = np.searchsorted(ends_a, ends_b)
    links = np.concatenate((ids_a[inner] << 32 | ids_b[first_b], ids_a[first_a] << 32 | ids_b))
    return links[np.argsort(np.concatenate((ends_a[inner], ends_b)), kind="stable")]


class Separated:
    """Decimal ids with what follows them, for ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int):
        self.text = [f"{i}{mark}" for i in range(ids) for mark in (",", "|", ";", "\n")]

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, last: np.ndarray) -> list[str]:
        """The groups with their ids in order, a text for each run of slices;
        ``last`` are the runs' last tokens of B."""
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        codes_a, codes_b = ids_a * 4, ids_b * 4
        codes_a[cuts_a - 1] += 1
        codes_b[cuts_b - 1] += 2
        codes_b[last] += 1
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + np.repeat(cuts_b - sizes_b, sizes_a)] = codes_a
        codes[np.arange(len(ids_b)) + np.repeat(cuts_a, sizes_b)] = codes_b
        return "".join(map(self.text.__getitem__, codes.tolist())).split("\n")[:-1]


class Aligner:
    """Both tokenizers of a task, and the chunks that it has aligned so far."""

    def __init__(self, vocabulary: str, model: bytes):
        self.a, self.b = ByteLevel(vocabulary), Pieces(model)
        self.sizes_a, self.sizes_b = (np.array(list(map(len, side.bytes_of))) for side in (self.a, self.b))
        self.separated = Separated(max(len(self.sizes_a), len(self.sizes_b)))
        self.chunks = CHUNK if self.b.apart else WHOLE
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        #: Tokens of A and of B, and groups, of each chunk; -1 where it has none.
        self.counts = np.empty((0, 3), np.int64)
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.chars = 0

    def _add(self, chunks: list[str]) -> None:
        """Align new chunks, laid behind one another."""
        all_a, all_b, whole = [], [], np.ones(len(chunks), bool)
        piece_a, piece_b = self.a.bytes_of.__getitem__, self.b.bytes_of.__getitem__
        for k, (chunk, ids_b) in enumerate(zip(chunks, self.b.encode(chunks))):
            ids_a, raw = self.a.encode(chunk), chunk.encode()
            self.chars += len(chunk)
            if b"".join(map(piece_a, ids_a)) != raw or b"".join(map(piece_b, ids_b)) != raw:  # a text with it has no tokens
                ids_a, ids_b, whole[k] = [], [], False
            all_a.append(ids_a)
            all_b.append(ids_b)
        counts = np.array([list(map(len, all_a)), list(map(len, all_b)), [0] * len(chunks)], np.int64).T
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (all_a, all_b))
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        cuts_a, cuts_b = slices(ends_a, ends_b)
        reached = np.searchsorted(cuts_b, np.cumsum(counts[:, 1]), "right")  # every chunk ends in a cut
        counts[:, 2] = np.diff(reached, prepend=0)
        links = expanded(ids_a, ids_b, ends_a, ends_b, cuts_a)
        last = (np.cumsum(counts[:, 1]) - 1)[whole]
        groups = iter(self.separated.groups(ids_a, ids_b, cuts_a, cuts_b, last))
        self.groups += [next(groups) if filled else "" for filled in whole.tolist()]
        borders = np.concatenate(([0], np.cumsum(counts[:, 0] + counts[:, 1] - counts[:, 2]))) * 8
        raw_links, places = links.tobytes(), borders.tolist()
        self.links += [raw_links[i:j] for i, j in zip(places, places[1:])]
        counts[~whole] = -1
        self.number.update(zip(chunks, range(len(self.counts), len(self.counts) + len(chunks))))
        self.counts = np.concatenate((self.counts, counts))

    def numbers(self, texts: list[bytes]) -> list[list[int]]:
        """The chunks of each text by number; none where a text has no tokens."""
        if len(self.number) > CHUNKS or self.chars > CHUNK_CHARS:
            self._forget()
        cut = []
        for raw in texts:
            text = raw.decode("utf-8", "replace")
            cut.append(self.chunks.findall(" " + text) if raw and text.encode() == raw else [])
        number = self.number
        new = list({chunk: None for chunks in cut for chunk in chunks if chunk not in number})
        for first in range(0, len(new), ADDED):
            self._add(new[first : first + ADDED])
        lost = set(np.flatnonzero(self.counts[:, 0] < 0).tolist())
        found = [list(map(number.__getitem__, chunks)) for chunks in cut]
        return [[] if lost and not lost.isdisjoint(own) else own for own in found]


_loaded: dict[tuple, Aligner] = {}


class _Slice:
    """Texts of a slice, aligned: their rows, their links and the distinct pairs."""

    def __init__(self, aligner: Aligner, texts: list[bytes], with_groups: bool, with_digest: bool):
        numbers = aligner.numbers(texts)
        groups = [";".join(map(aligner.groups.__getitem__, own)) for own in numbers] if with_groups or with_digest else []
        self.groups = groups if with_groups else [""] * len(texts)
        self.digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups] if with_digest else [""] * len(texts)
        sizes = np.array(list(map(len, numbers)))
        # Links of the distinct chunks, with their pairs' places in the slice's table.
        # Few pairs are distinct, so a hash table finds them faster than a sort.
        which, chunks = pd.factorize(np.fromiter(chain.from_iterable(numbers), np.int64, int(sizes.sum())))
        raw = [aligner.links[k] for k in chunks]
        places, self.pairs = pd.factorize(np.frombuffer(b"".join(raw), np.int64))
        n_links = np.array([len(r) // 8 for r in raw], np.int64)
        repeated = np.bincount(which, minlength=len(chunks))
        self.times = np.bincount(places, np.repeat(repeated, n_links), len(self.pairs)).astype(np.int64)
        begins = np.cumsum(n_links) - n_links
        own_links = n_links[which]
        at = np.repeat(begins[which] - (np.cumsum(own_links) - own_links), own_links) + np.arange(int(own_links.sum()))
        of_text = np.repeat(np.arange(len(texts)), sizes)
        totals = [np.bincount(of_text, values[which], len(texts)).astype(np.int64) for values in (*aligner.counts[chunks].T, n_links)]
        self.counts = list(zip(*(t.tolist() for t in totals)))
        self.links = [np.sort(own).tobytes() for own in np.split(places[at].astype(np.int32), np.cumsum(totals[3])[:-1])]


#: Rows of the written table: those of texts, and those of a slice's distinct pairs.
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PAIR_COLUMNS = "pair bigint, place int, times bigint"


def _encoded(docs: DataFrame, tokenizer_json: str, piece_model: str, key: str, with_groups: bool, with_digest: bool) -> DataFrame:
    context = docs.sparkSession.sparkContext
    with open(tokenizer_json, encoding="utf-8") as file:
        vocabulary = context.broadcast(file.read())
    with open(piece_model, "rb") as file:
        model = context.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = hash(vocabulary.value), hash(model.value)
        if mark not in _loaded:
            _loaded.clear()
            _loaded[mark] = Aligner(vocabulary.value, model.value)
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                done, block = _Slice(_loaded[mark], texts, with_groups, with_digest), next(numbers)
                n, m = len(texts), len(done.pairs)
                none = lambda kind, size: pa.nulls(size, kind)
                columns = [pa.array(np.full(n + m, block)), pa.array(np.arange(n + m) < n)]
                columns.append(pa.concat_arrays([batch.column(0).slice(start, n), none(batch.column(0).type, m)]))
                columns += [pa.array([*(c[k] for c in done.counts), *[None] * m], pa.int64()) for k in range(4)]
                for made in (done.groups, done.digests):
                    columns.append(pa.concat_arrays([pa.array(made, pa.string()), none(pa.string(), m)]))
                columns.append(pa.concat_arrays([pa.array(done.links, pa.binary()), none(pa.binary(), m)]))
                for made, kind in ((done.pairs, pa.int64()), (np.arange(m), pa.int32()), (done.times, pa.int64())):
                    columns.append(pa.concat_arrays([none(kind, n), pa.array(made, kind)]))
                yield pa.RecordBatch.from_arrays(columns, names=["block", "of_text", "id", *_COUNTS, "groups", "groups_sha256", "links", "pair", "place", "times"])

    schema = f"block bigint, of_text boolean, id {key}, {', '.join(f'{c} bigint' for c in _COUNTS)}, groups string, groups_sha256 string, links binary, {_PAIR_COLUMNS}"
    return docs.mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, tokenizer_json: str, piece_model: str, *, id: str = "doc_id", text: str = "text", outputs: tuple[str, ...] = ("groups",)
) -> DataFrame:
    """One row per input row: ``id, n_a, n_b, n_groups, n_links, n_best,
    count_sum`` and the chosen ``outputs``, ``groups`` (``a1,a2|b1;a3|b2,b3``)
    and ``groups_sha256``.

    ``n_best`` counts the links whose id pair is the most frequent of its B id in
    all of ``docs`` (ties included); ``count_sum`` adds up the corpus-wide counts
    of the links' pairs. Null and empty texts, and texts that one of the models
    does not give back byte by byte, have no tokens: zeros and empty strings.
    Repeated rows repeat and count each time; null ids are ids; an empty table
    gives no row; further columns are ignored, whatever their names. A very long
    text is one slice. Both tokenizers are files of fixed size, read on the driver.
    """
    kind = docs.select(id).schema[0].dataType.simpleString()
    rows = docs.selectExpr(f"`{id}` as id", f"cast(`{text}` as binary) as text")
    encoded = written(_encoded(rows, tokenizer_json, piece_model, kind, "groups" in outputs, "groups_sha256" in outputs))
    pairs = encoded.filter("not of_text").select("block", "pair", "place", "times")
    totals = pairs.groupBy("pair").agg(F.sum("times").alias("total")).withColumn("b", F.expr("pair & 4294967295"))
    # One row for each B id: no more rows than the model has pieces.
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = pairs.join(judged, "pair").select(F.col("block").alias("of_block"), "place", "total", "best")
    texts = encoded.filter("of_text").drop("of_text", "pair", "place", "times")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, bool)
        at = right["place"].to_numpy()
        total[at], best[at] = right["total"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        links = [np.frombuffer(value.as_py(), np.int32) for value in left["links"]]
        made = [pa.array([int(best[x].sum()) for x in links], pa.int64()), pa.array([int(total[x].sum()) for x in links], pa.int64())]
        return pa.table([left["id"], *[left[c] for c in _COUNTS], *made, *[left[c] for c in outputs]], names=["id", *_COUNTS, "n_best", "count_sum", *outputs])

    schema = f"id {kind}, {', '.join(f'{c} bigint' for c in (*_COUNTS, 'n_best', 'count_sum'))}" + "".join(f", {c} string" for c in outputs)
    return texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(summed, schema).withColumnRenamed("id", id)
