"""Secret scans: fixed patterns, and a battery of randomness tests.

Long tokens are candidates. The encoding of each is inferred from its characters,
and three tests ask whether it could be drawn uniformly from that alphabet:
chi-squared uniformity of the symbols, runs of character classes, and the serial
correlation of neighbouring symbols. Fisher's method makes one p-value of the
three; its negative logarithm says how far a token is from random.

What passes for random depends on the length, so false discoveries are controlled
by encoding and length. The null hypothesis is ordinary text: the short words of
all documents, run together and cut to the lengths of tokens, take the same tests.
The share of them that look at least as random is a candidate's p-value, and the
procedure of Benjamini and Hochberg picks the candidates of each encoding and
length. Where ordinary text of a length can look random, nothing is picked.

A task counts its ordinary strings by encoding, length and distance, so a table of
fixed size is summed over the corpus, and texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from math import erfc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.arrays import text_slices
from spanloom.llm.stages import written

#: The contract's kinds with their patterns (on bytes, ``assign`` on
#: lower-cased ones) and the characters that the named group has at least.
PATTERNS = (
    ("assign", re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(rb"[0-9a-f]+"), 0, 24),
)
#: The same matches as those of ``hex`` that are kept, found without the short ones.
LONG_HEX = re.compile(rb"[0-9a-f]{24,}")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Runs of token characters from this length on are candidates.
LEAST_LENGTH = 20
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{20,}={0,2}")

#: The alphabets, in the order in which they are tried.
DIGITS, UPPER, SMALL = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", DIGITS + "abcdef"), ("upper_hex", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"), ("base36", DIGITS + SMALL), ("upper_base36", DIGITS + UPPER),
    ("base62", DIGITS + UPPER + SMALL), ("base64", UPPER + SMALL + DIGITS + "+/"), ("base64url", UPPER + SMALL + DIGITS + "-_"),
)
#: Shortest lengths of the strata; also the lengths of ordinary strings.
LENGTHS = (20, 24, 32, 40, 48, 64, 96, 128)
#: Distances from random are counted in steps of this, up to a last bin for all beyond.
STEP, BINS = 0.05, 200
#: Share of false discoveries, and the least p-value of the battery for a discovery.
DISCOVERY_RATE, LEAST_P = 0.05, 0.001

_CHARACTERS = DIGITS + UPPER + SMALL
_DROPPED = bytes(c for c in range(256) if chr(c) not in _CHARACTERS)


class Encoding:
    """An alphabet with the moments that its tests have for uniform symbols."""

    def __init__(self, name: str, alphabet: str):
        self.name, self.k = name, len(alphabet)
        self.members = frozenset(alphabet.encode())
        #: Symbol of each byte; ordinary characters outside the alphabet are folded into it.
        self.symbol = np.zeros(256, np.int64)
        for place, c in enumerate(_CHARACTERS):
            self.symbol[ord(c)] = place % self.k
        for place, c in enumerate(alphabet):
            self.symbol[ord(c)] = place
        kind = lambda c: 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3
        self.kind = np.array([kind(c) for c in alphabet])
        share = np.bincount(self.kind, minlength=4) / self.k
        self.change = 1 - float((share**2).sum())
        self.change_twice = float((share * (1 - share) ** 2).sum())


_ENCODINGS = [Encoding(*e) for e in ENCODINGS]


def inferred(token: bytes) -> int | None:
    """The first alphabet that holds the token; none for numbers."""
    seen = set(token)
    if seen <= set(DIGITS.encode()):
        return None
    return next((i for i, e in enumerate(_ENCODINGS) if seen <= e.members), None)


def _two_sided(z: np.ndarray) -> np.ndarray:
    return np.fromiter(map(erfc, (np.abs(z) / np.sqrt(2)).tolist()), float, len(z))


def distances(encoding: Encoding, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Negative logarithm (base 10) of the battery's p-value for each string of
    bytes; they lie behind one another, ``starts`` has one entry more."""
    n = np.diff(starts)
    of = np.repeat(np.arange(len(n)), n)
    x, k = encoding.symbol[data], encoding.k
    counts = np.bincount(of * k + x, minlength=len(n) * k).reshape(len(n), k)
    # The statistic has mean k - 1 and variance 2 (k - 1) (n - 1) / n; a scaled
    # chi-squared with both gives its tail by Wilson and Hilferty's cube root.
    statistic = k * (counts.astype(float) ** 2).sum(1) / n - n
    variance = 2 * (k - 1) * (n - 1) / n
    freedom, scale = 2 * (k - 1) ** 2 / variance, variance / (2 * (k - 1))
    z = (np.cbrt(statistic / (scale * freedom)) - (1 - 2 / (9 * freedom))) / np.sqrt(2 / (9 * freedom))
    uneven = np.fromiter(map(erfc, (z / np.sqrt(2)).tolist()), float, len(z)) / 2
    inner = of[1:] == of[:-1]
    pairs = n - 1
    changed = np.bincount(of[1:][inner], (encoding.kind[x[1:]] != encoding.kind[x[:-1]])[inner], len(n))
    p = encoding.change
    spread = pairs * p * (1 - p) + 2 * (pairs - 1) * (encoding.change_twice - p * p)
    runs = _two_sided((changed - pairs * p) / np.sqrt(spread))
    centred = x - (k - 1) / 2
    product = np.bincount(of[1:][inner], (centred[1:] * centred[:-1])[inner], len(n))
    serial = _two_sided(product / ((k * k - 1) / 12) / np.sqrt(pairs))
    half = -sum(np.log(np.maximum(q, 1e-300)) for q in (uneven, runs, serial))
    return (half - np.log1p(half + half * half / 2)) / np.log(10)


def stratum(encoding: int, length: int) -> int:
    return encoding * len(LENGTHS) + int(np.searchsorted(LENGTHS, length, side="right")) - 1


def bin_of(distance: np.ndarray) -> np.ndarray:
    return np.minimum(distance / STEP, BINS).astype(np.int64)


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) in bytes, in order."""
    found = []
    for place, (_, pattern, group, least) in enumerate(PATTERNS):
        shown = raw.translate(LOWER) if place == 0 else raw
        for m in (LONG_HEX if place == 2 else pattern).finditer(shown):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), place, m.end()))
    return sorted(found)


def candidates(raw: bytes) -> tuple[list[tuple[int, int]], list[bytes]]:
    """Spans of long tokens in bytes, and the text between them. A token with
    symbols of both 64-letter alphabets is taken apart at ``+`` and ``/``."""
    spans, between, last = [], [], 0
    for m in CANDIDATE.finditer(raw):
        between.append(raw[last : m.start()])
        last = m.end()
        token = m.group()
        if (b"+" in token or b"/" in token) and (b"-" in token or b"_" in token):
            spans += [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(rb"[A-Za-z0-9_-]{20,}={0,2}", token)]
        else:
            spans.append(m.span())
    between.append(raw[last:])
    return spans, between


def ordinary_strings(raw: bytes, between: list[bytes]) -> list[tuple[int, bytes]]:
    """(encoding, string): the words of a text run together and cut; lengths and
    encodings take turns, from a place that the text decides."""
    text = b"".join(between).translate(None, _DROPPED)
    turn, at, made = zlib.crc32(raw) % (len(LENGTHS) * len(_ENCODINGS)), 0, []
    while at + LENGTHS[turn % len(LENGTHS)] <= len(text):
        size = LENGTHS[turn % len(LENGTHS)]
        made.append((turn // len(LENGTHS) % len(_ENCODINGS), text[at : at + size]))
        at += size
        turn += 1
    return made


def _judged(strings: list[tuple[int, bytes]]) -> np.ndarray:
    """stratum * (BINS + 1) + bin of each (encoding, string)."""
    keys = np.zeros(len(strings), np.int64)
    kinds = np.fromiter((e for e, _ in strings), np.int64, len(strings))
    for e, encoding in enumerate(_ENCODINGS):
        at = np.flatnonzero(kinds == e)
        if len(at):
            chosen = [strings[i][1] for i in at]
            sizes = np.array(list(map(len, chosen)))
            distance = distances(encoding, np.frombuffer(b"".join(chosen), np.uint8), np.concatenate(([0], np.cumsum(sizes))))
            strata = e * len(LENGTHS) + np.searchsorted(LENGTHS, sizes, side="right") - 1
            keys[at] = strata * (BINS + 1) + bin_of(distance)
    return keys


_SPAN = pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("stratum", pa.int32()), ("bin", pa.int32())])
_SPAN_SQL = "array<struct<start: int, place: int, end: int, kind: string, stratum: int, bin: int>>"
#: A base span is below every limit.
_BASE = {"stratum": -1, "bin": -1}


def _slice_rows(texts: list[bytes], ordinary: np.ndarray, tested: np.ndarray) -> list[tuple[list[int], str, list[dict]]]:
    """(counts by kind, digest, all spans) of each text; both histograms grow."""
    rows, waiting, strings = [], [], []
    for raw in texts:
        base = base_spans(raw)
        tokens, between = candidates(raw)
        strings += ordinary_strings(raw, between)
        free = []
        for start, end in tokens:
            encoding = inferred(raw[start:end].rstrip(b"="))
            if encoding is not None and not any(s < end and start < e for s, _, e in base):
                free.append((start, end, encoding))
        at = lambda b: b
        if (base or free) and not raw.isascii():
            letters = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
            at = letters.__getitem__
        spans = [{"start": int(at(s)), "place": p, "end": int(at(e)), "kind": PATTERNS[p][0], **_BASE} for s, p, e in base]
        joined = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
        rows.append(([sum(p == k for _, p, _ in base) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest(), spans))
        for start, end, encoding in free:
            kind = f"random_{_ENCODINGS[encoding].name}"
            waiting.append((spans, {"start": int(at(start)), "place": len(PATTERNS) + encoding, "end": int(at(end)), "kind": kind}, (encoding, raw[start:end].rstrip(b"="))))
    ordinary += np.bincount(_judged(strings), minlength=len(ordinary))
    keys = _judged([w[2] for w in waiting])
    tested += np.bincount(keys, minlength=len(tested))
    for (spans, span, _), key in zip(waiting, keys.tolist()):
        spans.append(span | {"stratum": key // (BINS + 1), "bin": key % (BINS + 1)})
    return rows


_NAMES = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "stratum", "bin", "ordinary", "tested"]


def _scanned(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of texts, and at the end of a task those of its histograms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(_ENCODINGS) * len(LENGTHS) * (BINS + 1)
        ordinary, tested, id_type = np.zeros(size, np.int64), np.zeros(size, np.int64), None
        for batch in batches:
            id_type = batch.column(0).type
            for start, texts in text_slices(batch, "text"):
                done = _slice_rows(texts, ordinary, tested)
                columns = [batch.column(0).slice(start, len(texts)), *[pa.array([r[0][k] for r in done], pa.int64()) for k in range(3)]]
                columns += [pa.array([r[1] for r in done], pa.string()), pa.array([r[2] for r in done], pa.list_(_SPAN))]
                columns += [pa.nulls(len(texts), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        filled = np.flatnonzero(ordinary + tested)
        if len(filled):
            columns = [pa.nulls(len(filled), t) for t in (id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(_SPAN))]
            columns += [pa.array(filled // (BINS + 1), pa.int32()), pa.array(filled % (BINS + 1), pa.int32()), pa.array(ordinary[filled]), pa.array(tested[filled])]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return rows.mapInArrow(run, f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans {_SPAN_SQL}, stratum int, bin int, ordinary bigint, tested bigint")


def discovery_limits(histogram: DataFrame, rate: float = DISCOVERY_RATE, least_p: float = LEAST_P) -> DataFrame:
    """``stratum, limit``: the last bin of each stratum that the step-up procedure
    accepts, from ``stratum, bin, ordinary, tested``. The p-value of a bin is the
    share of ordinary strings up to it, one more than seen."""
    summed = histogram.groupBy("stratum", "bin").agg(F.sum("ordinary").alias("ordinary"), F.sum("tested").alias("tested"))
    every = W.partitionBy("stratum")
    up_to = every.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    p_value = (F.sum("ordinary").over(up_to) + 1) / (F.sum("ordinary").over(every) + 1)
    judged = summed.select("stratum", "bin", (p_value * F.sum("tested").over(every) <= rate * F.sum("tested").over(up_to)).alias("passes"))
    return judged.filter(F.col("passes") & (F.col("bin") * STEP <= -np.log10(least_p))).groupBy("stratum").agg(F.max("bin").alias("limit"))


def scan_secrets(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``id, n_assign, n_access, n_hex, base_sha256, spans``
    and ``found``, the spans as an array of ``start, end, kind``.

    Base spans (whole matches, in code points) always stay; a token that touches
    one is no candidate. Tokens found by the battery are of the kinds
    ``random_<encoding>``. Null texts are empty; repeated rows repeat; null ids
    stay; an empty table gives no row; further columns are ignored, whatever their
    names; very long texts and tokens are tested whole.
    """
    kind = docs.select(id).schema[0].dataType.simpleString()
    rows = docs.selectExpr(f"`{id}` as id", f"cast(`{text}` as binary) as text")
    scanned = written(_scanned(rows, kind))
    # One row for each stratum at most: encodings times lengths.
    limits = {r["stratum"]: r["limit"] for r in discovery_limits(scanned.filter("stratum is not null").select("stratum", "bin", "ordinary", "tested")).collect()}
    limit = F.create_map(*[F.lit(x) for pair in {-1: 0, **limits}.items() for x in pair])
    shown: Column = F.array_sort(F.filter("spans", lambda s: s["bin"] <= F.coalesce(limit[s["stratum"]], F.lit(-2))))
    texts = scanned.filter("stratum is null").withColumn("spans", shown)
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    found = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return texts.select(F.col("id").alias(id), "n_assign", "n_access", "n_hex", "base_sha256", joined.alias("spans"), found.alias("found"))
