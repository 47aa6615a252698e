"""Benchmark decontamination with spaced seeds.

A mask is a row of positions that count (1) or are ignored (0). The three masks
find every stretch of 13 words with two substitutions: whichever two words
differ, one of the masks still fits. Shorter items have masks of their own length
that each count one part of it, one part more than substitutions are allowed.

1. The benchmark is hashed under its masks at every offset: a table of seeds.
   Its hashes set the bits of a filter of fixed size.
2. Documents are hashed in the same way; those with seeds that pass the filter
   are written with the hashes of their words.
3. The join of test and training seeds gives alignments of a document with an
   item; each is verified around the hit: it counts where ``min_words``
   neighbouring words agree but for ``max_substitutions``.

The filter only saves rows; a benchmark that fills it costs a larger join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.arrays import FOLD, WordHashes, mixed, odd_factors, text_slices
from spanloom.llm.stages import written

#: Masks of weight seven that hit 13 words with any two substituted.
MASKS = ("1111100011", "110101111", "11100110101")


def mask_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash under ``mask`` of each run of its length (also across text borders)."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, len(mask), np.uint64)
    for k, factor in enumerate(odd_factors(len(mask), 29)):
        if mask[k] == "1":
            total += hashes[k : k + n] * factor
    return mixed(total)


#: Bits of the filter: a first, small table and a second one that is probed twice.
SMALL_BITS, LARGE_BITS = 22, 26


def short_masks(size: int, allowed: int) -> list[str]:
    """Masks of an item's own length that find it with ``allowed`` substitutions:
    each counts one of ``allowed + 1`` parts."""
    cuts = [size * k // (allowed + 1) for k in range(allowed + 2)]
    return ["".join("1" if a <= k < b else "0" for k in range(size)) for a, b in zip(cuts, cuts[1:]) if b > a]


def tolerance(size: int, min_words: int, max_substitutions: int) -> tuple[int, int]:
    """Words that must lie together, and how many of them may differ: for items
    under ``min_words`` the whole item and a share of the substitutions."""
    return (min_words, max_substitutions) if size >= min_words else (size, max_substitutions * size // min_words)


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item_row, item_id, words) with the hashes of the words; written, so that
    ``item_row`` stays what it is."""
    rows = benchmark.select(F.monotonically_increasing_id().alias("item_row"), F.col(f"`{item}`").alias("item_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                hashes, starts = words.of([raw.translate(FOLD).split() for raw in texts])
                parts = [hashes[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(start, len(texts)) for k in (0, 1)), pa.array(parts, pa.binary())], names=["item_row", "item_id", "words"])

    return written(rows.mapInArrow(run, f"item_row long, item_id {kind}, words binary"))


def _seeds(items: DataFrame, min_words: int, max_substitutions: int, masks: tuple[str, ...]) -> DataFrame:
    """(seed, item_row, place) of every mask at every offset of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = np.frombuffer(raw, np.uint64)
                size, allowed = tolerance(len(words), min_words, max_substitutions)
                for mask in (masks if len(words) >= min_words else short_masks(size, allowed)) if size else ():
                    found = mask_hashes(words, mask)
                    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array([row] * len(found), pa.int64()), pa.array(np.arange(len(found)))], names=["seed", "item_row", "place"])

    return items.select("item_row", "words").mapInArrow(run, "seed long, item_row long, place long")


def _positions(seeds: np.ndarray, small: int, large: int) -> list[np.ndarray]:
    """The bits of each seed: one of the first table, two of the second."""
    second = [seeds & np.uint64((1 << large) - 1), (seeds >> np.uint64(16)) & np.uint64((1 << large) - 1)]
    return [(seeds >> np.uint64(64 - small)).astype(np.int64), *(x.astype(np.int64) + (1 << small) for x in second)]


class SeedFilter:
    """A bit set of fixed size: a seed of the benchmark always passes."""

    def __init__(self, seeds: DataFrame, small: int, large: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = np.unique(np.concatenate(_positions(np.asarray(batch.column(0)).astype(np.uint64), small, large)))
                yield pa.RecordBatch.from_arrays([pa.array(places >> 5), pa.array(np.int64(1) << (places & 31))], names=["word", "bits"])

        # A row for each 32 bits of the filter at most, whatever the benchmark.
        found = seeds.select("seed").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        self.small, self.large = small, large
        self.words = np.zeros(((1 << small) + (1 << large)) >> 5, np.uint32)
        self.words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)

    def first(self) -> np.ndarray:
        """The first table, a byte for each bit."""
        return np.unpackbits(self.words[: 1 << (self.small - 5)].view(np.uint8), bitorder="little").view(bool)

    def passing(self, seeds: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places of the seeds that may be in the benchmark."""
        at = np.flatnonzero(first[seeds >> np.uint64(64 - self.small)])
        for probe in (1, 2):
            places = _positions(seeds[at], self.small, self.large)[probe]
            at = at[self.words[places >> 5] >> (places & 31).astype(np.uint32) & np.uint32(1) == 1]
        return at


def verified(text: np.ndarray, item: np.ndarray, shift: int, min_words: int, max_substitutions: int) -> tuple[int, int, int] | None:
    """(first word in the document, words, words that agree) of the stretches of
    this alignment within the tolerance, or None."""
    low, high = max(0, shift), min(len(text), shift + len(item))
    size, allowed = tolerance(len(item), min_words, max_substitutions)
    if not size or high - low < size:
        return None
    same = text[low:high] == item[low - shift : high - shift]
    total = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(total[size:] - total[:-size] >= size - allowed)
    if not len(good):
        return None
    covered = np.zeros(high - low + 1, np.int64)
    np.add.at(covered, good, 1)
    np.add.at(covered, good + size, -1)
    inside = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
    return low + int(inside[0]), len(inside), int(same[inside].sum())


def _overlaps(docs: DataFrame, carried: list[Column], benchmark: DataFrame, text: str, item: str, item_text: str, min_words: int, max_substitutions: int, masks: tuple[str, ...]) -> DataFrame:
    """The carried columns with ``item_id, first_word, n_words, n_same`` of the
    best overlap of each row of ``docs`` with each item."""
    items = _items(benchmark, item, item_text)
    seeds = written(_seeds(items, min_words, max_substitutions, masks))
    short = items.select((F.octet_length("words") / 8).cast("int").alias("n")).filter((F.col("n") > 0) & (F.col("n") < min_words)).distinct()
    used = [*masks, *(m for r in short.collect() for m in short_masks(*tolerance(r["n"], min_words, max_substitutions)))]  # under min_words sizes
    held = docs.sparkSession.sparkContext.broadcast(SeedFilter(seeds, SMALL_BITS, LARGE_BITS))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *carried, F.col(f"`{text}`").cast("binary").alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = WordHashes(), held.value.first()
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                hashes, starts = words.of([raw.translate(FOLD).split() for raw in texts])
                found, places = [], []
                for mask in used:
                    own = mask_hashes(hashes, mask)
                    at = held.value.passing(own, first)
                    at = at[at + len(mask) <= starts[np.searchsorted(starts, at, "right")]] if len(at) else at
                    found.append(own[at])
                    places.append(at)
                found, places = np.concatenate(found), np.concatenate(places)
                owner = np.searchsorted(starts, places, "right") - 1
                order = np.argsort(owner, kind="stable")
                found, places, owner = found[order], places[order], owner[order]
                hit = np.unique(owner)
                if len(hit):
                    cuts = np.append(np.searchsorted(owner, hit), len(owner))
                    take = pa.array(start + hit)
                    listed = lambda values: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))
                    content = pa.array([hashes[starts[i] : starts[i + 1]].tobytes() for i in hit], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(take) for f in kept), content, listed(found.astype(np.int64)), listed(places - starts[owner])], names=[*(f.name for f in kept), "words", "seeds", "places"])

    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    hits = written(rows.mapInArrow(search, f"{named}, words binary, seeds array<bigint>, places array<bigint>"))
    pairs = hits.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("x")).select("row", F.col("x.seeds").alias("seed"), F.col("x.places").alias("at"))
    met = pairs.join(seeds, "seed").select("row", "item_row", (F.col("at") - F.col("place")).alias("shift")).distinct()
    wanted = met.join(items.select("item_row", "item_id", F.col("words").alias("item_words")), "item_row")
    by_row = wanted.groupBy("row", "item_row", "item_id", "item_words").agg(F.collect_list("shift").alias("shifts"))
    joined = by_row.join(hits.drop("seeds", "places"), "row").select(*(f.name for f in kept if f.name != "row"), "item_id", "words", "item_words", "shifts")
    carry = [f for f in kept if f.name != "row"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, best = [], []
            for row, (words, item_words, shifts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("words", "item_words", "shifts")))):
                own, other = np.frombuffer(words, np.uint64), np.frombuffer(item_words, np.uint64)
                found = [f for s in sorted(shifts) if (f := verified(own, other, s, min_words, max_substitutions))]
                if found:
                    at.append(row)
                    best.append(max(found, key=lambda f: (f[2], -f[0])))
            if at:
                numbers = [pa.array([b[k] for b in best], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(pa.array(at)) for f in carry), batch.column("item_id").take(pa.array(at)), *numbers], names=[*(f.name for f in carry), "item_id", "first_word", "n_words", "n_same"])

    kind = items.schema["item_id"].dataType.simpleString()
    return joined.mapInArrow(check, "".join(f"{f.name} {f.dataType.simpleString()}, " for f in carry) + f"item_id {kind}, first_word long, n_words long, n_same long")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", min_words: int = 13, max_substitutions: int = 2, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, n_same``: the best verified overlap
    of each document row with each benchmark item.

    Words are runs of ASCII letters, digits and non-ASCII bytes, ASCII letters in
    lower case. Items under ``min_words`` count where the whole item is found,
    with substitutions in proportion. Null and empty texts and items overlap with
    nothing; repeated rows and items repeat; null ids stay null; an empty table
    or benchmark gives no row; further columns are ignored.
    """
    return _overlaps(docs, [F.col(f"`{id}`").alias("doc_id")], benchmark, text, item, item_text, min_words, max_substitutions, masks)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", min_words: int = 13, max_substitutions: int = 2, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """The rows of ``docs`` (all columns) without a verified overlap with any
    item. Rows with one text share their fate, so rows are told apart by two
    hashes and the length of their texts; null and empty texts stay."""
    content = F.col(f"`{text}`").cast("binary")
    marks = {"__x": F.xxhash64(content), "__m": F.hash(content), "__n": F.octet_length(content)}
    gone = _overlaps(docs, [c.alias(n) for n, c in marks.items()], benchmark, text, item, item_text, min_words, max_substitutions, masks).select(*marks).distinct()
    marked = docs.select("*", *(c.alias(n) for n, c in marks.items()))
    return marked.join(gone, list(marks), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
