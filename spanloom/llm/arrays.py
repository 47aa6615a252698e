"""NumPy helpers for the operators that run inside Arrow batches.

Batches are handled in slices of bounded bytes, so the memory of a task depends
on the slice and on its longest single text, not on the batch or partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled at once.
SLICE_BYTES = 4 << 20
#: Distinct words whose hashes a task keeps; the table starts anew beyond it.
WORD_CACHE = 300_000

#: ASCII letters and digits stay (in lower case), other ASCII separates.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def text_slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, whole texts as UTF-8) of consecutive rows; null texts are empty."""
    column = batch.column(batch.schema.get_field_index(text))
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    start, held, size = 0, [], 0
    for row in range(len(column)):
        raw = column[row].as_py() or b""
        if held and size + len(raw) > max_bytes:
            yield start, held
            start, held, size = row, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield start, held


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen again."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words one after another, and where each text starts."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        hashes = np.empty(int(starts[-1]), np.uint64)
        for i, words in enumerate(texts):
            hashes[starts[i] : starts[i + 1]] = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        return hashes, starts


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums of products spread evenly."""
    x = values.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def odd_factors(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def run_hashes(hashes: np.ndarray, size: int, seed: int = 11) -> np.ndarray:
    """Hash of each run of ``size`` neighbours (also across text borders)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(odd_factors(size, seed)):
        total += hashes[k : k + n] * factor
    return mixed(total)


def runs_inside(starts: np.ndarray, size: int) -> np.ndarray:
    """True where a run of ``size`` words lies inside one text."""
    n = int(starts[-1]) - size + 1
    inside = np.ones(max(n, 0), bool)
    for border in starts[1:-1]:
        inside[max(0, border - size + 1) : border] = False
    return inside
