"""Byte-level BPE: pieces are merged in contiguous rank arrays, then decoded.

A piece (short word) is an array of part ids with the ranks of adjacent pairs
beside it. The smallest rank is found by a scan, its right boundary is deleted
and the two neighbouring ranks are looked up again, until no pair has a rank.
Pieces are few and repeat, so each task keeps a bounded table of encoded pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from spanloom.llm.arrays import text_slices

#: Fixed value: how a text is cut into pieces before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces kept encoded by a task; the table starts anew beyond it.
PIECE_CACHE = 250_000
#: Longer pieces use a heap instead of scans, with the same merges.
SCAN_LIMIT = 200
NO_RANK = 1 << 60


def byte_symbols() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, content: str):
        data = json.loads(content)
        symbols = byte_symbols()
        vocab = data["model"]["vocab"]
        raw = {token: bytes(symbols[c] for c in token) for token in vocab}
        self.special = {token["content"]: token["id"] for token in data["added_tokens"]}
        self.bytes_of = {i: raw[token] for token, i in vocab.items()} | {i: text.encode() for text, i in self.special.items()}
        self.byte_ids = [0] * 256
        for token, i in vocab.items():
            if len(raw[token]) == 1:
                self.byte_ids[raw[token][0]] = i
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        #: (left id, right id) as one number -> rank; rank -> id of the merged part.
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.pieces = regex.compile(PATTERN)
        self.split_special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def merge(self, piece: bytes) -> list[int]:
        parts = [self.byte_ids[b] for b in piece]
        if len(parts) > SCAN_LIMIT:
            return self._merge_long(parts)
        rank_of = self.ranks.get
        ranks = [rank_of(a << 32 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            parts[at] = self.merged[least]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 32 | parts[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << 32 | parts[at + 1], NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(self.ranks[key], i, parts[i], parts[i + 1]) for i in range(n - 1) if (key := parts[i] << 32 | parts[i + 1]) in self.ranks]
        heapq.heapify(queue)
        alive = [True] * n
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = right[i]
            if not alive[i] or j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], right[i] = self.merged[rank], False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (key := parts[x] << 32 | parts[y]) in self.ranks:
                    heapq.heappush(queue, (self.ranks[key], x, parts[x], parts[y]))
        return [p for p, keep in zip(parts, alive) if keep]

    def piece(self, text: str) -> tuple[int, str, bytes]:
        """(number of ids, ids joined by commas, bytes decoded from the ids)."""
        found = self.known.get(text)
        if found is None:
            ids = self.merge(text.encode())
            found = len(ids), ",".join(map(str, ids)), b"".join(self.bytes_of[i] for i in ids)
            if len(self.known) >= PIECE_CACHE:
                self.known.clear()
            if len(text) <= SCAN_LIMIT:
                self.known[text] = found
        return found

    def encode(self, text: str) -> list[tuple[int, str, bytes]]:
        """The encoded pieces of a whole text; special tokens are pieces too."""
        parts = self.split_special.split(text) if self.split_special and any(t in text for t in self.special) else (text,)
        done: list[tuple[int, str, bytes]] = []
        known, piece = self.known, self.piece
        for part in parts:
            if part in self.special:
                i = self.special[part]
                done.append((1, str(i), self.bytes_of[i]))
            else:
                done += [known.get(x) or piece(x) for x in self.pieces.findall(part)]
        return done


_loaded: dict[int, Vocabulary] = {}


def encode_decode(docs: DataFrame, tokenizer_json: str, *, id: str = "doc_id", text: str = "text", outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per input row: ``id``, ``n_tokens`` and the chosen outputs.

    ``outputs``: ``ids`` (array<int>), ``decoded`` (string), ``ids_sha256`` of the
    decimal ids joined by commas, ``decoded_sha256`` of the decoded UTF-8. A null
    text is empty and has no ids; repeated rows repeat; an empty table gives no
    row; bytes that are no UTF-8 become U+FFFD before they are encoded; further
    columns are ignored, whatever their names. ``tokenizer_json`` is read on the driver; the
    vocabulary is a parameter of fixed size and goes out as one broadcast.
    """
    with open(tokenizer_json, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    kinds = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    key = docs.select(id).schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = hash(content.value)
        vocabulary = _loaded.get(mark)
        if vocabulary is None:
            _loaded.clear()
            vocabulary = _loaded[mark] = Vocabulary(content.value)
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                counts: list[int] = []
                made: dict[str, list] = {name: [] for name in outputs}
                for raw in texts:
                    pieces = vocabulary.encode(raw.decode("utf-8", "replace"))
                    counts.append(sum(p[0] for p in pieces))
                    joined = ",".join([p[1] for p in pieces])
                    decoded = b"".join([p[2] for p in pieces])
                    for name in outputs:
                        if name == "ids":
                            made[name].append(np.array(joined.split(","), np.int32) if joined else np.empty(0, np.int32))
                        elif name == "decoded":
                            made[name].append(decoded.decode("utf-8", "replace"))
                        elif name == "ids_sha256":
                            made[name].append(hashlib.sha256(joined.encode()).hexdigest())
                        else:
                            made[name].append(hashlib.sha256(decoded).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(counts, pa.int64()), *[pa.array(made[name], kinds[name][1]) for name in outputs]],
                    names=["id", "n_tokens", *outputs],
                )

    schema = ", ".join([f"id {key.dataType.simpleString()}", "n_tokens bigint", *[f"{name} {kinds[name][0]}" for name in outputs]])
    rows = docs.selectExpr(f"`{id}` as id", f"cast(`{text}` as binary) as text")
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)
