import collections
import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from spanloom.llm import secret_scan as S
from spanloom.llm.secret_scan import scan_secrets

RNG = random.Random(11)
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WORDS = "the of and interval sequence running total hidden markov quality language model corpus Sampling Filter train over window hash".split()
PATTERNS = {
    "assign": (re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def plain_base(text):
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        found += [(m.start(), place, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for clash in ("id", "spans", "stratum", "bin", "tested", "limit"):
        docs = docs.withColumn(clash, F.lit("x"))
    return {r["doc_id"]: r for r in scan_secrets(docs.repartition(3)).collect()}


def test_base_spans_by_brute_force(spark):
    hexes = "0123456789abcdef" * 3
    texts = [
        None, "", "token: a password: hunter22", "TOKEN='ABCdef.123'", "api_key=secret:abcdefg", "été é Password = \"pässword\" secret:" + "x" * 6,
        "AKIA" + "Z" * 16, "AKIAKIAKIA" + "0" * 9, "AKIA" + "A" * 15, hexes, "\U0001f600" + hexes + "g" + hexes[:23], "ſecret=abcdefgh toKen=abcdefgh",
        "secret=secret=abcdef; token:token:token:tokens", "passwd==abcdefgh", "secret\t=abcdef", "secret=\nabcdefg", "apikey:AKIA" + "Q" * 20 + " " + hexes,
    ]
    pieces = ["token", "Secret", "=", ":", " ", "'", "é", "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "password", "api_key", ".", "\n"]
    texts += ["".join(RNG.choice(pieces) for _ in range(RNG.randrange(2, 40))) for _ in range(300)]
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        base = plain_base(text)
        counts = collections.Counter(x.split(":")[0] for x in base)
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [counts[k] for k in PATTERNS], text
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert [x for x in got[i]["spans"].split(",") if x and not x.startswith("random_")] == base


def test_random_tokens_are_found_and_ordinary_ones_left(spark):
    texts, planted = [], set()
    for i in range(400):
        text = prose(150)
        if i % 4 == 0:
            token = "".join(RNG.choice(B64) for _ in range(RNG.choice((32, 40, 48, 64))))
            text = f"é {text} {token} {prose(20)}"
            planted.add((i, text.index(token), text.index(token) + len(token)))
        if i % 4 == 1:
            text += " " + RNG.choice(("getIntervalSequenceRunningTotal", "/usr/local/share/corpus/language/model", "z" * 40, "ABCDEFGHIJKLMNOPQRSTUVWXYZ012345", "-1234567890" * 4))
        texts.append(text)
    got = scanned(spark, texts)
    found = {(i, s["start"], s["end"]) for i, r in got.items() for s in r["found"] if s["kind"].startswith("random_")}
    assert len(found & planted) >= 0.9 * len(planted) and len(found - planted) <= 0.1 * len(found)
    assert not {i for i, _, _ in found if i % 4 == 1}
    for i, r in got.items():
        assert r["spans"] == ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["found"])


def test_nothing_is_random_where_ordinary_text_could_be(spark):
    """Without ordinary strings there is no null distribution and no discovery."""
    assert scanned(spark, ["".join(RNG.choice(B64) for _ in range(40))])[0]["spans"] == ""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scan_secrets(empty).collect() == []


def test_very_long_tokens_repeats_and_null_ids(spark):
    token = "".join(RNG.choice(B64[:62]) for _ in range(1 << 20))
    rows = [(None, token + " " + prose(3000))] * 2 + [(1, "x" * (1 << 20))] + [(2, prose(400))] * 30
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["spans"] for r in got if r["doc_id"] is None) == [f"random_base62:0:{1 << 20}"] * 2
    assert all(r["spans"] == "" for r in got if r["doc_id"] is not None) and len(got) == 33


def plain_distance(token, encoding):
    """The battery with plain numbers."""
    name, alphabet = S.ENCODINGS[encoding]
    k, n, x = len(alphabet), len(token), [alphabet.index(c) for c in token]
    statistic = sum((x.count(s) - n / k) ** 2 / (n / k) for s in range(k))
    mean, variance = k - 1, 2 * (k - 1) * (n - 1) / n
    freedom, scale = 2 * mean**2 / variance, variance / (2 * mean)
    uneven = math.erfc(((statistic / scale / freedom) ** (1 / 3) - 1 + 2 / (9 * freedom)) / math.sqrt(2 / (9 * freedom)) / math.sqrt(2)) / 2
    kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s" for c in alphabet]
    p = sum(kinds[a] != kinds[b] for a in range(k) for b in range(k)) / k**2
    twice = sum(kinds.count(q) / k * (1 - kinds.count(q) / k) ** 2 for q in "dlus")
    changes = sum(kinds[a] != kinds[b] for a, b in zip(x, x[1:]))
    runs = math.erfc(abs(changes - (n - 1) * p) / math.sqrt((n - 1) * p * (1 - p) + 2 * (n - 2) * (twice - p * p)) / math.sqrt(2))
    serial = math.erfc(abs(sum((a - (k - 1) / 2) * (b - (k - 1) / 2) for a, b in zip(x, x[1:])) / ((k * k - 1) / 12) / math.sqrt(n - 1)) / math.sqrt(2))
    half = -sum(math.log(q) for q in (uneven, runs, serial))
    return -math.log10(math.exp(-half) * (1 + half + half * half / 2))


def test_battery_by_plain_numbers_and_its_level():
    for e, (_, alphabet) in enumerate(S.ENCODINGS):
        tokens = ["".join(RNG.choice(alphabet) for _ in range(RNG.randrange(20, 90))) for _ in range(400)]
        data, starts = np.frombuffer("".join(tokens).encode(), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
        got = S.distances(S._ENCODINGS[e], data, starts)
        assert np.allclose(got, [plain_distance(t, e) for t in tokens])
        assert (got > 2).mean() < 0.04  # random strings are rarely far from random


def test_step_up_procedure_by_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for stratum in range(6):
        ordinary = np.bincount(rng.integers(5 * stratum, 200, 4000), minlength=201)
        tested = np.bincount(np.concatenate((rng.integers(0, 20, 30), rng.integers(30, 200, 200))), minlength=201)
        rows += [(stratum, b, int(o), int(t)) for b, (o, t) in enumerate(zip(ordinary, tested)) if o or t]
        values = sorted((1 + ordinary[: b + 1].sum()) / (1 + ordinary.sum()) for b in range(201) for _ in range(tested[b]))
        accepted = [p for k, p in enumerate(values, 1) if p <= S.DISCOVERY_RATE * k / len(values)]
        bins = [b for b in range(61) if accepted and (1 + ordinary[: b + 1].sum()) / (1 + ordinary.sum()) <= accepted[-1]]
        expected[stratum] = int(tested[: max(bins, default=-1) + 1].sum())
    got = {r["stratum"]: r["limit"] for r in S.discovery_limits(spark.createDataFrame(rows, "stratum int, bin int, ordinary long, tested long")).collect()}
    for stratum, n in expected.items():
        assert sum(t for s, b, _, t in rows if s == stratum and b <= got.get(stratum, -1)) == n
