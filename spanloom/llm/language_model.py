"""Hierarchical Pitman-Yor language model over word pairs, words and spelling.

A word is drawn in the restaurant of the word before it (the first word after
the end of a text); the parent of these is one restaurant of words. Its own
parent spells a word byte by byte with restaurants for the contexts of two, one
and no bytes, each context sharing the restaurant of its shorter context as
parent, down to the uniform distribution. The end of a text is the empty word.
As in the base score, all words that were never learned are one event; its
probability is the chance of a new table times the spelling's mass outside the
vocabulary.

Seating is sampled by Gibbs sweeps. A sweep draws the tables of every pair given
the word probabilities of the sweep before; each sends one customer to the
restaurant of words, whose tables are drawn given the spelling and send theirs
to the spelling restaurants, from the longest context down. Predictive
probabilities are averaged over the sweeps kept.

Counts are gathered from the whole corpus in blocks: a block is a bounded slice
of texts as word codes with its own dictionary. Blocks send entries of words and
of pairs, not tokens, to hash buckets and get back values of each entry. A pair
seen once has one table, so only repeated pairs are drawn, in the bucket of
their word. The pairs of a context meet in one bucket, those of a frequent one
in several, and their number of tables is summed. Draws are a function of the
pair or word, the sweep and the model before it.
"""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.arrays import mixed, text_slices
from spanloom.llm.stages import discard, written

#: Bytes of text of a block; a task holds some twenty times as much at once.
BLOCK_BYTES = 12 << 20
#: Bytes of text for each bucket of words and pairs.
BUCKET_BYTES = 8 << 20
#: Symbols of the spelling: 256 bytes and one for "outside" (start, end of word).
OUT, SYMBOLS = 256, 257
SPELL_DISCOUNT, SPELL_STRENGTH, WORD_STRENGTH, PAIR_STRENGTH = 0.5, 1.0, 10.0, 1.0
#: Contexts with this many tokens, and one in ``HOT_SHARE`` of all, are cut up.
HOT_TOKENS, HOT_SHARE = 1 << 16, 4096
#: Sweeps in all, and those left out of the averages.
SWEEPS, BURN_IN = 4, 2
#: Customers seated one by one (31 at most); later ones in growing groups.
SINGLE = 24


class Codes(dict):
    """Codes of words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def uniform(keys: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the keys and the salt alone."""
    x = keys.copy()
    for s in salt:
        x = mixed(x + np.uint64((s * 0x9E3779B97F4A7C15 + 1) % 2**64))
    return (x >> np.uint64(11)).astype(np.float64) / 2**53


def seat(counts: np.ndarray, new_mass: np.ndarray, discount: float, keys: np.ndarray, sweep: int, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(tables, openings) of each dish after its ``counts`` customers sat down;
    ``openings`` has a bit for each of the first customers that opened a table.

    The seating of a dish with ``SINGLE`` customers or fewer is a Metropolis step
    on that of the ``last`` sweep. The proposal seats them one by one, a new
    table with probability ``m / (m + seated - discount * tables)``, ``m`` being
    ``new_mass``. A seating's weight given the other dishes is ``m`` for each new
    table and ``seated - discount * tables`` for each other customer, so weight
    over proposal is the product of ``m + seated - discount * tables``, and the
    ratio of these products accepts it. The step leaves the distribution of Gibbs
    sampling by single customers as it is. Further customers of a dish are drawn
    in groups that grow by a tenth, with the probability at the group's start.
    """
    tables = np.minimum(counts, 1).astype(np.float64)
    openings = np.zeros(len(counts), np.uint32)
    before = tables.copy()
    gain = np.ones(len(counts))
    live = np.flatnonzero(counts > 1)
    seated, step = 1, 0
    while len(live):
        size = 1 if seated < SINGLE else max(1, seated // 10)
        group = np.minimum(size, counts[live] - seated)
        t, m = tables[live], new_mass[live]
        whole = m + seated - discount * t
        opened = np.floor(group * m / whole + uniform(keys[live], sweep, step))
        tables[live] = t + opened
        if seated < SINGLE:
            openings[live] |= opened.astype(np.uint32) << np.uint32(seated)
            if last is not None:
                gain[live] *= whole / (m + seated - discount * before[live])
                before[live] += last[live] >> np.uint32(seated) & np.uint32(1)
        seated += size
        step += 1
        live = live[counts[live] > seated]
    if last is not None:
        stays = (counts <= SINGLE) & (uniform(keys, sweep, -1) >= gain)
        tables[stays], openings[stays] = before[stays], last[stays]
    return np.minimum(tables, counts), openings


@dataclass
class Spelling:
    """Predictive probabilities of a byte after one and two bytes; contexts of
    two bytes that were never seen use the shorter one. At most 257**2 rows."""

    row: np.ndarray  # of each two-byte context, -1 where it was never seen
    two: np.ndarray
    one: np.ndarray

    @classmethod
    def flat(cls) -> Spelling:
        return cls(np.full(SYMBOLS * SYMBOLS, -1, np.int32), np.empty((0, SYMBOLS)), np.full((SYMBOLS, SYMBOLS), 1 / SYMBOLS))

    def log10(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each word; ``words`` holds their bytes one after another."""
        context, symbol, starts = letters(words, lengths)
        if not len(starts):
            return np.empty(0)
        at = self.row[context]
        p = self.one[context % SYMBOLS, symbol]
        seen = at >= 0
        p[seen] = self.two[at[seen], symbol[seen]]
        return np.add.reduceat(np.log10(p), starts)


def letters(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(two-byte context, symbol) of every letter and word end; word starts."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths + 1)
    total = int(ends[-1]) if len(ends) else 0
    symbol = np.full(total, OUT, np.int64)
    inside = np.ones(total, bool)
    inside[ends - 1] = False
    symbol[inside] = words
    starts = ends - lengths - 1
    before = np.full(total, OUT, np.int64)
    before[1:] = symbol[:-1]
    before2 = np.full(total, OUT, np.int64)
    before2[2:] = symbol[:-2]
    before2[starts] = OUT
    return before2 * SYMBOLS + before, symbol, starts


def spelling_sweep(cells: np.ndarray, counts: np.ndarray, last: Spelling, sweep: int) -> Spelling:
    """Seat the customers of (two-byte context, symbol) cells; all arrays are
    bounded by the alphabet, whatever the corpus."""
    d, strength = SPELL_DISCOUNT, SPELL_STRENGTH
    context, symbol = cells // SYMBOLS, cells % SYMBOLS
    keys = mixed(cells.astype(np.uint64))
    seen, at = np.unique(context, return_inverse=True)
    two = np.zeros((len(seen), SYMBOLS))
    tables2 = np.zeros_like(two)
    rough = np.bincount(at, np.minimum(counts, 1), len(seen))
    tables2[at, symbol] = seat(counts, (strength + d * rough[at]) * last.one[context % SYMBOLS, symbol], d, keys, sweep)[0]
    two[at, symbol] = counts
    one = np.zeros((SYMBOLS, SYMBOLS))
    np.add.at(one, seen % SYMBOLS, tables2)
    flat = np.flatnonzero(one)
    below = np.full(SYMBOLS, 1 / SYMBOLS)
    tables1 = np.zeros(SYMBOLS * SYMBOLS)
    open1 = (one > 0).sum(axis=1)[flat // SYMBOLS]
    tables1[flat] = seat(one.ravel()[flat].astype(np.int64), (strength + d * open1) * below[flat % SYMBOLS], d, mixed(flat.astype(np.uint64) + np.uint64(1 << 40)), sweep)[0]
    tables1 = tables1.reshape(SYMBOLS, SYMBOLS)
    none = tables1.sum(axis=0)
    tables0 = np.minimum(none, 1)
    p0 = (none - d * tables0 + (strength + d * tables0.sum()) * below) / (strength + none.sum())
    p1 = (one - d * tables1 + (strength + d * tables1.sum(axis=1, keepdims=True)) * p0) / (strength + one.sum(axis=1, keepdims=True))
    p2 = (two - d * tables2 + (strength + d * tables2.sum(axis=1, keepdims=True)) * p1[seen % SYMBOLS]) / (strength + two.sum(axis=1, keepdims=True))
    row = np.full(SYMBOLS * SYMBOLS, -1, np.int32)
    row[seen] = np.arange(len(seen))
    return Spelling(row, p2, p1)


@dataclass
class State:
    """The model between two sweeps: totals and spelling, all of bounded size."""

    tokens: int
    words: int
    discount: float
    pair_discount: float
    customers: float
    tables: float
    spelling: Spelling


@dataclass
class Known:
    """A bucket's part of the vocabulary and the repeated pairs of its words."""

    totals: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    hashes: np.ndarray
    at: np.ndarray  # word of each pair
    keys: np.ndarray
    counts: np.ndarray
    types: np.ndarray  # distinct words after the pair's first one

    def seated(self, states: list[State]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables of pairs, customers of words, tables of words) by sweep."""
        customers, tables, seating = self.totals, np.minimum(self.totals, 1).astype(np.float64), None
        for sweep, state in enumerate(states):
            spelled = 10.0 ** state.spelling.log10(self.words, self.lengths)
            new_mass = (WORD_STRENGTH + state.discount * state.tables) * spelled
            p = (customers - state.discount * tables + new_mass) / (WORD_STRENGTH + state.customers)
            pairs, seating = seat(self.counts, (PAIR_STRENGTH + state.pair_discount * self.types) * p[self.at], state.pair_discount, self.keys, sweep, seating)
            customers = self.totals - np.bincount(self.at, self.counts - pairs, len(self.totals)).astype(np.int64)
            tables, _ = seat(customers, new_mass, state.discount, self.hashes, sweep)
            yield pairs, customers, tables


def packed(values: np.ndarray | bytes) -> bytes:
    """Compressed, all first bytes of the numbers before all second ones."""
    if isinstance(values, np.ndarray):
        values = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.compress(values, 1)


def unpacked(raw: bytes, kind: type = np.float64) -> np.ndarray:
    whole = np.frombuffer(zstandard.decompress(raw) if raw else b"", np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(whole.reshape(size, -1).T).reshape(-1).view(kind)


def _joined(words: list[bytes]) -> tuple[bytes, np.ndarray]:
    return b"".join(words), np.fromiter(map(len, words), np.uint32, len(words))


def _split(words: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    words = unpacked(words, np.uint8).tobytes()
    return [words[a:b] for a, b in zip([0, *ends], ends)]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


BLOCK_SCHEMA = "block long, ids binary, learns binary, sizes binary, codes binary, words binary, lengths binary, counts binary"


def _blocks(docs: DataFrame, id: str, text: str, learn: Column) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(-(2**63))).alias("id"), F.col(text).cast("binary").alias("text"), F.coalesce(learn, F.lit(True)).alias("learn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, learns = np.asarray(batch.column(0)), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for start, texts in text_slices(batch, "text", BLOCK_BYTES):
                codes, parts = Codes(), []
                end = np.array([codes[b""]], np.uint32)
                for raw in texts:
                    words = raw.translate(LOWER).split()
                    parts += (np.fromiter(map(codes.__getitem__, words), np.uint32, len(words)), end)
                sizes = np.array([len(a) + 1 for a in parts[::2]], np.uint32)
                flat = np.concatenate(parts)
                mask = np.repeat(learns[start : start + len(texts)], sizes)
                counts = np.bincount(flat[mask], minlength=len(codes)).astype(np.uint32)
                words, lengths = _joined(list(codes))
                values = (ids[start : start + len(texts)], learns[start : start + len(texts)], sizes, flat, words, lengths, counts)
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), *[pa.array([packed(v)], pa.binary()) for v in values]], names=["block", "ids", "learns", "sizes", "codes", "words", "lengths", "counts"])

    return rows.mapInArrow(run, BLOCK_SCHEMA)


#: ASCII capitals become small letters, every other byte stays.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MEET_SCHEMA = "block long, bucket long, at binary, totals binary, words binary, lengths binary"


def _meet(blocks: DataFrame, buckets: int) -> DataFrame:
    """Corpus counts by bucket: a row holds the bucket's part of the vocabulary
    (``block`` null), and one for each block where its words are in it."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, lengths, counts in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, counts = unpacked(lengths, np.uint32), unpacked(counts, np.uint32)
                listed = _split(words, lengths)
                hashes = _hashes(listed)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if y > x:
                        own = order[x:y]
                        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([block], pa.int64()), *[pa.array([packed(v)], pa.binary()) for v in (hashes[own], counts[own], b"".join([listed[i] for i in own]), lengths[own])]], names=["bucket", "block", "hashes", "counts", "words", "lengths"])

    def meet(table: pa.Table) -> pa.Table:
        hashes = [unpacked(x, np.uint64) for x in table.column("hashes").to_pylist()]
        found, first, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        counts = np.concatenate([unpacked(x, np.uint32) for x in table.column("counts").to_pylist()])
        totals = np.bincount(inverse, counts, len(found)).astype(np.int64)
        cuts = np.cumsum([0, *map(len, hashes)])
        lengths = np.concatenate([unpacked(x, np.uint32) for x in table.column("lengths").to_pylist()])
        whole = b"".join([unpacked(x, np.uint8).tobytes() for x in table.column("words").to_pylist()])
        ends = np.cumsum(lengths, dtype=np.int64)
        known = np.flatnonzero(totals > 0)
        place = np.full(len(found), -1, np.int32)
        place[known] = np.arange(len(known))
        answers = [packed(place[inverse[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
        at = first[known]
        vocabulary = b"".join([whole[a:b] for a, b in zip((ends[at] - lengths[at]).tolist(), ends[at].tolist())])
        bucket = table.column("bucket")[0].as_py()
        n = len(answers)
        return pa.table(
            {
                "block": pa.array([*table.column("block").to_pylist(), None], pa.int64()),
                "bucket": pa.array([bucket] * (n + 1), pa.int64()),
                "at": pa.array([*answers, None], pa.binary()),
                "totals": pa.array([None] * n + [packed(totals[known])], pa.binary()),
                "words": pa.array([None] * n + [packed(vocabulary)], pa.binary()),
                "lengths": pa.array([None] * n + [packed(lengths[at])], pa.binary()),
            }
        )

    sent = blocks.select("block", "words", "lengths", "counts").mapInArrow(send, "bucket long, block long, hashes binary, counts binary, words binary, lengths binary")
    return sent.groupBy("bucket").applyInArrow(meet, MEET_SCHEMA)


def _totals(vocabulary: DataFrame) -> tuple[int, int, int, int]:
    """Tokens, distinct words, words seen once, words seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for totals in batch.column(0).to_pylist():
                n = unpacked(totals, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (n.sum(), len(n), (n == 1).sum(), (n == 2).sum())], names=["n", "v", "once", "twice"])

    row = vocabulary.select("totals").mapInArrow(run, "n long, v long, once long, twice long").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v", "once", "twice")]).first()
    return tuple(row)


def _frequent(vocabulary: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the words with ``least`` tokens, by hash; bounded by
    the share of all tokens that each of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for totals, words, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                counts = unpacked(totals, np.int64)
                hot = np.flatnonzero(counts >= least)
                if len(hot):
                    listed = _split(words, unpacked(lengths, np.uint32))
                    yield pa.RecordBatch.from_arrays([pa.array(_hashes([listed[i] for i in hot]).astype(np.int64)), pa.array(counts[hot])], names=["word", "n"])

    rows = vocabulary.select("totals", "words", "lengths").mapInArrow(run, "word long, n long").toArrow()
    words, counts = (c.to_numpy() for c in rows.columns)
    words = words.astype(np.uint64)
    order = np.argsort(words)
    return words[order], counts[order].astype(np.int64)


def _looked_up(names: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: np.ndarray) -> np.ndarray:
    """``values`` by sorted ``names`` for ``wanted``, and ``other`` without one."""
    if not len(names):
        return other
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, values[at], other)


def _pair_keys(contexts: np.ndarray, followers: np.ndarray) -> np.ndarray:
    return mixed(contexts * np.uint64(0x9E3779B97F4A7C15) + followers)


@dataclass
class Pairs:
    """The distinct pairs of a block by bucket, then by hashes."""

    context: np.ndarray  # codes
    follower: np.ndarray
    cuts: np.ndarray  # of the buckets
    inverse: np.ndarray  # pair of each token

    @classmethod
    def of(cls, codes: np.ndarray, hashes: np.ndarray, buckets: int, hot: np.ndarray, parts: np.ndarray) -> Pairs:
        # Texts end with code 0, so the token before a first word is that end.
        by_hash = np.argsort(hashes)
        rank = np.empty(len(hashes), np.uint64)
        rank[by_hash] = np.arange(len(hashes), dtype=np.uint64)
        keys = rank[codes]
        keys[1:] |= keys[:-1] << np.uint64(32)
        keys[:1] |= rank[:1] << np.uint64(32)
        inverse, keys = _numbered(keys)
        context, follower = by_hash[(keys >> np.uint64(32)).astype(np.int64)], by_hash[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        split = _looked_up(hot, parts.astype(np.uint64), hashes, np.ones(len(hashes), np.uint64))[context]
        bucket = ((hashes[context] % np.uint64(buckets) + _pair_keys(hashes[context], hashes[follower]) % split) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        moved = np.empty(len(order), np.int32)
        moved[order] = np.arange(len(order), dtype=np.int32)
        return cls(context[order], follower[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), moved[inverse])


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key, distinct keys in order), with few arrays at a time."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return inverse, keys[new]


def _heads(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)


PAIR_SCHEMA = "block long, bucket long, at binary, contexts binary, degrees binary, types binary, totals binary, repeated binary, followers binary, once long, twice long"


def _meet_pairs(blocks: DataFrame, buckets: int, hot: np.ndarray, parts: np.ndarray) -> DataFrame:
    """Corpus counts of pairs by bucket, like ``_meet``."""
    held = blocks.sparkSession.sparkContext.broadcast((hot, parts))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, learns, sizes, codes, words, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = _hashes(_split(words, unpacked(lengths, np.uint32)))
                pairs = Pairs.of(unpacked(codes, np.uint32), hashes, buckets, *held.value)
                mask = np.repeat(unpacked(learns, bool), unpacked(sizes, np.uint32))
                counts = np.bincount(pairs.inverse[mask], minlength=len(pairs.context)).astype(np.uint32)
                for b, (x, y) in enumerate(zip(pairs.cuts[:-1], pairs.cuts[1:])):
                    if y > x:
                        own = pairs.context[x:y]
                        heads = _heads(own)
                        spelled, which = np.unique(hashes[pairs.follower[x:y]], return_inverse=True)
                        values = (hashes[own[heads]], np.diff(heads, append=y - x).astype(np.uint32), spelled, which.astype(np.uint32), counts[x:y])
                        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([block], pa.int64()), *[pa.array([packed(v)], pa.binary()) for v in values]], names=["bucket", "block", "contexts", "degrees", "followers", "which", "counts"])

    def meet(table: pa.Table) -> pa.Table:
        read = lambda name, kind: [unpacked(x, kind) for x in table.column(name).to_pylist()]
        given = [spelled[which] for spelled, which in zip(read("followers", np.uint64), read("which", np.uint32))]
        followers, degrees = np.concatenate(given), np.concatenate(read("degrees", np.uint32))
        names, which = np.unique(np.concatenate(read("contexts", np.uint64)), return_inverse=True)
        spelled, word = np.unique(followers, return_inverse=True)
        keys, inverse = np.unique(np.repeat(which, degrees) << 32 | word, return_inverse=True)
        totals = np.bincount(inverse, np.concatenate(read("counts", np.uint32)), len(keys)).astype(np.uint32)
        context = keys >> 32
        repeated = np.flatnonzero(totals > 1)
        cuts = np.cumsum([0, *map(len, given)])
        rows = [(block, np.diff(inverse[a:b], prepend=0).astype(np.uint32)) for block, a, b in zip(table.column("block").to_pylist(), cuts[:-1], cuts[1:])]
        store = (names, np.bincount(context, minlength=len(names)).astype(np.uint32), np.bincount(context[totals > 0], minlength=len(names)).astype(np.uint32), totals, repeated.astype(np.uint32), spelled[keys[repeated] & 0xFFFFFFFF])
        n, bucket = len(rows), table.column("bucket")[0].as_py()
        return pa.table(
            {
                "block": pa.array([*(r[0] for r in rows), None], pa.int64()),
                "bucket": pa.array([bucket] * (n + 1), pa.int64()),
                "at": pa.array([*(packed(r[1]) for r in rows), None], pa.binary()),
                **{name: pa.array([None] * n + [packed(v)], pa.binary()) for name, v in zip(("contexts", "degrees", "types", "totals", "repeated", "followers"), store)},
                "once": pa.array([0] * n + [int((totals == 1).sum())], pa.int64()),
                "twice": pa.array([0] * n + [int((totals == 2).sum())], pa.int64()),
            }
        )

    sent = blocks.select("block", "learns", "sizes", "codes", "words", "lengths").mapInArrow(send, "bucket long, block long, contexts binary, degrees binary, followers binary, which binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(meet, PAIR_SCHEMA)


def _hot_sums(rows: DataFrame, hot: np.ndarray) -> np.ndarray:
    """Sums of ``n`` by ``word`` in the order of ``hot``."""
    found = rows.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    words, n = found.column("word").to_numpy().astype(np.uint64), found.column("n").to_numpy().astype(np.float64)
    order = np.argsort(words)
    return _looked_up(words[order], n[order], hot, np.zeros(len(hot)))


def _hot_types(store: DataFrame, hot: np.ndarray) -> np.ndarray:
    """Distinct words after each hot one, over all of its buckets."""
    held = store.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for contexts, types in zip(*(c.to_pylist() for c in batch.columns)):
                names, n = unpacked(contexts, np.uint64), unpacked(types, np.uint32)
                own = np.isin(names, held.value)
                yield pa.RecordBatch.from_arrays([pa.array(names[own].astype(np.int64)), pa.array(n[own].astype(np.float64))], names=["word", "n"])

    return _hot_sums(store.select("contexts", "types").mapInArrow(run, "word long, n double"), hot)


KNOWN_SCHEMA = "bucket long, totals binary, words binary, lengths binary, contexts binary, followers binary, counts binary, types binary, sources binary, sizes binary, places binary"


def _known(vocabulary: DataFrame, store: DataFrame, buckets: int, hot: np.ndarray, types: np.ndarray) -> DataFrame:
    """The vocabulary with the repeated pairs of its words, a row for a bucket;
    ``sources`` and ``places`` say where the pairs came from."""
    held = store.sparkSession.sparkContext.broadcast((hot, types))
    names, kinds = ("contexts", "followers", "counts", "types", "places"), (np.uint64, np.uint64, np.uint32, np.uint64, np.uint32)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, contexts, degrees, types, totals, repeated, followers in zip(*(c.to_pylist() for c in batch.columns)):
                contexts, degrees, totals, repeated, followers = unpacked(contexts, np.uint64), unpacked(degrees, np.uint32), unpacked(totals, np.uint32), unpacked(repeated, np.uint32), unpacked(followers, np.uint64)
                types = _looked_up(*held.value, contexts, unpacked(types, np.uint32).astype(np.float64))
                context = np.repeat(np.arange(len(contexts)), degrees)[repeated]
                bucket = (followers % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])):
                    if y > x:
                        own = order[x:y]
                        values = (contexts[context[own]], followers[own], totals[repeated[own]], types[context[own]].astype(np.uint64), repeated[own])
                        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([source], pa.int64()), *[pa.array([packed(v)], pa.binary()) for v in values]], names=["bucket", "source", *names])

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["source"] is None)
        pairs = sorted((r for r in rows if r["source"] is not None), key=lambda r: r["source"])
        sources = np.array([r["source"] for r in pairs], np.int64)
        sizes = np.array([len(unpacked(r["places"], np.uint32)) for r in pairs], np.int64)
        values = {"totals": own["totals"], "words": own["words"], "lengths": own["lengths"], **{n: packed(np.concatenate([np.empty(0, k), *(unpacked(r[n], k) for r in pairs)])) for n, k in zip(names, kinds)}, "sources": packed(sources), "sizes": packed(sizes)}
        order = [f.split()[0] for f in KNOWN_SCHEMA.split(", ")[1:]]
        return pa.table({"bucket": pa.array([own["bucket"]], pa.int64()), **{n: pa.array([values[n]], pa.binary()) for n in order}})

    sent = store.select("bucket", "contexts", "degrees", "types", "totals", "repeated", "followers").mapInArrow(send, "bucket long, source long, " + ", ".join(f"{n} binary" for n in names))
    rows = vocabulary.select("bucket", "totals", "words", "lengths").unionByName(sent, allowMissingColumns=True)
    return rows.groupBy("bucket").applyInArrow(meet, KNOWN_SCHEMA)


def _known_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Known]]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths, contexts, followers = unpacked(row["lengths"], np.uint32), unpacked(row["contexts"], np.uint64), unpacked(row["followers"], np.uint64)
            if len(lengths):
                # Words are in the order of their hashes.
                hashes = _hashes(_split(row["words"], lengths))
                yield row, Known(unpacked(row["totals"], np.int64), unpacked(row["words"], np.uint8), lengths, hashes, np.searchsorted(hashes, followers), _pair_keys(contexts, followers), unpacked(row["counts"], np.uint32).astype(np.int64), unpacked(row["types"], np.uint64).astype(np.float64))


def _known_mass(vocabulary: DataFrame, spellings: list[Spelling]) -> float:
    """The mass that the averaged spelling gives to the learned words."""
    held = vocabulary.sparkSession.sparkContext.broadcast(spellings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                flat, sizes = unpacked(words, np.uint8), unpacked(lengths, np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array([float(sum((10.0 ** s.log10(flat, sizes)).sum() for s in held.value) / len(held.value))])], names=["mass"])

    return vocabulary.select("words", "lengths").mapInArrow(run, "mass double").agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]


def _sweep(known: DataFrame, states: list[State]) -> State:
    """One Gibbs sweep: pair and word tables in the tasks, then the spelling."""
    held = known.sparkSession.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _known_rows(batches):
            *_, (_, customers, tables) = part.seated(held.value)
            context, symbol, _ = letters(part.words, part.lengths)
            cells, inverse = np.unique(context * SYMBOLS + symbol, return_inverse=True)
            sent = np.bincount(inverse, np.repeat(tables, part.lengths.astype(np.int64) + 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((cells, [-1, -2]))), pa.array(np.concatenate((sent, [tables.sum(), customers.sum()])).astype(np.int64))], names=["cell", "n"])

    # At most 257**3 cells, whatever the corpus.
    rows = known.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, customers = rows.column("cell").to_numpy(), rows.column("n").to_numpy()
    tables, seated = (float(customers[cells == c].sum()) for c in (-1, -2))
    order = np.argsort(cells[cells >= 0])
    last = states[-1]
    spelling = spelling_sweep(cells[cells >= 0][order], customers[cells >= 0][order], last.spelling, len(states) - 1)
    return State(last.tokens, last.words, last.discount, last.pair_discount, seated, tables, spelling)


def _settled(known: DataFrame, states: list[State], kept: list[int], new_table: float, hot: np.ndarray) -> DataFrame:
    """Averages of the sweeps kept: probabilities of words (``kind`` 0), tables
    of repeated pairs for the bucket they came from (1), and tables over one of
    each hot context (2)."""
    held = known.sparkSession.sparkContext.broadcast((states, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, hot = held.value

        def rows(kind: int, *values: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(values[0]), pa.int32()), *[pa.array(v, k) if v is not None else pa.nulls(len(values[0]), k) for v, k in zip(values, kinds)]], names=["kind", "bucket", "a", "b", "word", "n"])

        for row, part in _known_rows(batches):
            drawn = list(part.seated(states[:-1]))
            pairs, customers, tables = (np.mean([drawn[s][k] for s in kept], axis=0) for k in range(3))
            total = np.mean([states[s + 1].customers for s in kept])
            spelled = np.mean([10.0 ** states[s + 1].spelling.log10(part.words, part.lengths) for s in kept], axis=0)
            p = (customers - states[0].discount * tables) / (WORD_STRENGTH + total) + new_table * spelled
            yield rows(0, [row["bucket"]], [row["totals"]], [packed(p)], None, None)
            sources, sizes, places = (unpacked(row[c], k) for c, k in (("sources", np.int64), ("sizes", np.int64), ("places", np.uint32)))
            cuts = np.cumsum([0, *sizes])
            if len(sources):
                yield rows(1, sources.tolist(), [packed(places[x:y]) for x, y in zip(cuts[:-1], cuts[1:])], [packed(pairs[x:y].astype(np.float32)) for x, y in zip(cuts[:-1], cuts[1:])], None, None)
            contexts = unpacked(row["contexts"], np.uint64)
            own = np.isin(contexts, hot)
            names, inverse = np.unique(contexts[own], return_inverse=True)
            if len(names):
                yield rows(2, [None] * len(names), None, None, names.astype(np.int64).tolist(), np.bincount(inverse, pairs[own] - 1).tolist())

    return known.mapInArrow(run, "kind int, bucket long, a binary, b binary, word long, n double")


ANSWER_SCHEMA = "block long, kind int, bucket long, a binary, b binary"


def _answered(kind: int, table: pa.Table, answers: list[tuple]) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    return pa.table({"block": pa.array([r[0] for r in answers], pa.int64()), "kind": pa.array([kind] * len(answers), pa.int32()), "bucket": pa.array([bucket] * len(answers), pa.int64()), **{c: pa.array([packed(r[k]) for r in answers], pa.binary()) for k, c in ((1, "a"), (2, "b"))}})


def _word_answers(met: DataFrame, settled: DataFrame, unseen: float) -> DataFrame:
    """Count and probability of each word of a block (``kind`` 0)."""

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next((r for r in rows if r["block"] is None), {"a": b"", "b": b""})
        counts, p = np.append(unpacked(own["a"], np.int64), 0), np.append(unpacked(own["b"]), unseen)
        answers = [(r["block"], unpacked(r["at"], np.int32)) for r in rows if r["block"] is not None]
        return _answered(0, table, [(block, counts[at], p[at]) for block, at in answers])

    asked = met.filter(F.col("block").isNotNull()).select("block", "bucket", "at")
    return asked.unionByName(settled.filter("kind = 0").select("bucket", "a", "b"), allowMissingColumns=True).groupBy("bucket").applyInArrow(meet, ANSWER_SCHEMA)


def _pair_answers(pairs: DataFrame, settled: DataFrame, discount: float, types: np.ndarray, hot: np.ndarray) -> DataFrame:
    """Discounted count of each pair of a block, and tables of each of its
    contexts in the bucket (``kind`` 1); ``types`` are tables of hot contexts."""
    held = pairs.sparkSession.sparkContext.broadcast((hot, types))

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["totals"] is not None)
        contexts, degrees, totals = unpacked(own["contexts"], np.uint64), unpacked(own["degrees"], np.uint32), unpacked(own["totals"], np.uint32)
        tables = np.minimum(totals, 1).astype(np.float64)
        for r in rows:
            if r["a"] is not None:
                tables[unpacked(r["a"], np.uint32)] = unpacked(r["b"], np.float32)
        context = np.repeat(np.arange(len(contexts)), degrees)
        whole = _looked_up(*held.value, contexts, np.bincount(context, tables, len(contexts)))
        kept = (totals - discount * tables).astype(np.float32)
        answers = []
        for r in rows:
            if r["at"] is not None:
                at = np.cumsum(unpacked(r["at"], np.uint32), dtype=np.int64)
                answers.append((r["block"], kept[at], whole[context[at][_heads(context[at])]]))
        return _answered(1, table, answers)

    rows = pairs.select("block", "bucket", "at", "contexts", "degrees", "totals")
    return rows.unionByName(settled.filter("kind = 1").select("bucket", "a", "b"), allowMissingColumns=True).groupBy("bucket").applyInArrow(meet, ANSWER_SCHEMA)


def _released(spark: SparkSession) -> None:
    """Spark deletes shuffles that nothing reads any more when the driver
    collects garbage; this asks for it once their rows are written."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def score_texts(docs: DataFrame, *, id: str = "doc_id", text: str = "text", learn: Column, sweeps: int = SWEEPS, burn_in: int = BURN_IN) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``learn`` is a condition on the columns of ``docs``: its rows are counted
    (a null condition counts). Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z in
    lower case and one end. ``base_score`` is the add-half unigram log10
    probability, ``score`` the model's. Null and empty texts have the end alone;
    repeated rows repeat and count again; further columns are ignored; without a
    learned row the spelling is uniform. Ids are taken as long.
    """
    spark = docs.sparkSession
    # What a bucket holds is bounded by bytes of text, at every size.
    volume = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(volume / BUCKET_BYTES))
    blocks = written(_blocks(docs, id, text, learn))
    met = written(_meet(blocks, buckets))
    vocabulary = met.filter(F.col("words").isNotNull())
    tokens, distinct, once, twice = _totals(vocabulary)
    least = max(HOT_TOKENS, tokens // HOT_SHARE)
    hot, frequency = _frequent(vocabulary, least)
    parts = np.minimum(-(-frequency // least), buckets)
    pairs = written(_meet_pairs(blocks, buckets, hot, parts))
    _released(spark)
    store = pairs.filter(F.col("block").isNull())
    types = _hot_types(store, hot)
    known = written(_known(vocabulary, store, buckets, hot, types))
    share = lambda once, twice: min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    discount, pair_discount = share(once, twice), share(*store.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("once", "twice")]).first())
    states = [State(tokens, distinct, discount, pair_discount, float(tokens), float(distinct), Spelling.flat())]
    for _ in range(sweeps if tokens else 0):
        states.append(_sweep(known, states))
    # The sweeps that are averaged: state s made the draws that led to state s + 1.
    kept = list(range(burn_in if len(states) > burn_in + 1 else 0, len(states) - 1))
    spellings = [states[s + 1].spelling for s in kept] or [states[0].spelling]
    tables, customers = (float(np.mean([getattr(states[s + 1], c) for s in kept])) if kept else 0.0 for c in ("tables", "customers"))
    new_table = (WORD_STRENGTH + discount * tables) / (WORD_STRENGTH + customers)
    unseen = new_table * max(1.0 - _known_mass(known, spellings), 1e-12)
    settled = written(_settled(known, states, kept, new_table, hot))
    _released(spark)
    types = types + _hot_sums(settled.filter("kind = 2").select("word", "n"), hot)
    answers = written(_word_answers(met, settled, unseen).unionByName(_pair_answers(pairs, settled, pair_discount, types, hot)))
    _released(spark)
    discard(met, pairs, known, settled)  # what follows reads the blocks and their answers
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "a", "b")).alias("answers"))
    joined = blocks.join(answers, "block").select("ids", "sizes", "codes", "words", "lengths", "answers")
    cut = spark.sparkContext.broadcast((hot, parts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, sizes, codes, words, lengths, given = (c[row].as_py() for c in batch.columns)
                sizes, codes, lengths = unpacked(sizes, np.uint32).astype(np.int64), unpacked(codes, np.uint32), unpacked(lengths, np.uint32)
                hashes = _hashes(_split(words, lengths))
                order = np.argsort((hashes % np.uint64(buckets)).astype(np.int64), kind="stable")
                given.sort(key=lambda a: (a["kind"], a["bucket"]))
                read = lambda kind, c, t: np.concatenate([unpacked(a[c], t) for a in given if a["kind"] == kind])
                counts, p = np.empty(len(hashes), np.int64), np.empty(len(hashes))
                counts[order], p[order] = read(0, "a", np.int64), read(0, "b", np.float64)
                base = np.log10((counts + 0.5) / (tokens + 0.5 * (distinct + 1)))
                own = Pairs.of(codes, hashes, buckets, *cut.value)
                # The contexts of a bucket follow each other, so a run is one answer.
                heads = np.unique(np.concatenate((_heads(own.context), own.cuts[:-1][np.diff(own.cuts) > 0])))
                tables = np.repeat(read(1, "b", np.float64), np.diff(heads, append=len(own.context)))
                after = (read(1, "a", np.float32) + (PAIR_STRENGTH + pair_discount * tables) * p[own.follower]) / (PAIR_STRENGTH + counts[own.context])
                after = np.log10(np.maximum(after, 1e-300))
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                total = lambda x: np.add.reduceat(x, starts)
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(ids, np.int64)), pa.array(sizes), pa.array(total((counts > 0)[codes].astype(np.int64))), pa.array(total(base[codes])), pa.array(total(after[own.inverse]))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    out = joined.mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.when(F.col("doc_id") != -(2**63), F.col("doc_id")).alias("doc_id"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
