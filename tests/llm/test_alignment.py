import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm import alignment
from spanloom.llm.alignment import align_tokenizers

BYTE_LEVEL, PIECE_MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
STRANGE = ["", None, " ", "\n", "a  b \t\r\n c ", "ends in space ", "x▁y", "<|endoftext|> </s><s> <unk> <0x41>", "é é \U0001f600 日本語テキスト 　x", "a\x00b", "aaaa" * 900, "don't 12345 ---- __init__", "a\n b", "a \n b\n  c", "word\n\n", "x\x1c y\x85 z", "\u2003 a\u00a0 b", "  \t a  ", "s \r\n\r\n s", "\n \n x \n", "a" + " " * 300 + "b" + "\n" * 50]


def plain(texts):
    """The contract, token by token."""
    a_model = Tokenizer.from_file(BYTE_LEVEL)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    rows, counts = [], collections.Counter()
    for text in texts:
        a, b, groups, links = [], [], [], []
        if text:
            encoded = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(symbols[c] for c in token)) for i, token in zip(encoded.ids, encoded.tokens)]
            for i in b_model.encode(text):
                piece = b_model.id_to_piece(i)
                b.append((i, bytes([int(piece[3:-1], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) != (" " + text).encode() or b"".join(x for _, x in b) != (" " + text).encode():
                a, b = [], []
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, raw in side:
                found.append((at, at + len(raw), i))
                at += len(raw)
            spans.append(found)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        for low, high in zip([0, *common], common):
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= high) for side in spans))
        for s, e, i in spans[0]:
            links += [(i, j) for t, f, j in spans[1] if s < f and t < e]
        counts.update(links)
        rows.append((len(a), len(b), len(common), links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(n_a, n_b, n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), groups) for n_a, n_b, n, links, groups in rows]


def test_alignment_by_brute_force(spark):
    rng = random.Random(7)
    words = ["the", "tion", "Then", "erblest", "internationalization", "été", "2024", "x_y", "   ", "\n"]
    texts = [*STRANGE, *(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(60)), "same", "same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for clash in ("id", "block", "pair", "links", "n_a", "of_text"):
        docs = docs.withColumn(clash, F.lit("x"))
    got = {r["doc_id"]: r for r in align_tokenizers(docs.repartition(5), BYTE_LEVEL, PIECE_MODEL, outputs=("groups", "groups_sha256")).collect()}
    assert len(got) == len(texts)
    for i, expected in enumerate(plain(texts)):
        r = got[i]
        assert tuple(r)[1:8] == expected, texts[i]
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")


def test_slices_share_their_counts(spark, monkeypatch):
    """Counts are those of the corpus, not of a slice; null and repeated ids stay."""
    texts = ["erblest tion erblest", "tion tions", "erblest", None] * 12
    docs = spark.createDataFrame([(None if i % 5 == 0 else i % 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(9)
    got = sorted(tuple(r)[1:7] for r in align_tokenizers(docs, BYTE_LEVEL, PIECE_MODEL).collect())
    assert got == sorted(row[:6] for row in plain(texts))


def test_no_rows_and_one_very_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(empty, BYTE_LEVEL, PIECE_MODEL).collect() == []
    long = "Erblest tions, then 42 internationals. " * 30_000
    r = align_tokenizers(spark.createDataFrame([(1, long)], "doc_id long, text string"), BYTE_LEVEL, PIECE_MODEL, outputs=("groups",)).collect()[0]
    assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["groups"].count(";") == r["n_groups"] - 1
    assert sum(len(side.split(",")) for g in r["groups"].split(";") for side in g.split("|")) == r["n_a"] + r["n_b"]


def test_chunks_are_aligned_like_whole_texts():
    with open(BYTE_LEVEL, encoding="utf-8") as a, open(PIECE_MODEL, "rb") as b:
        apart = alignment.Aligner(a.read(), b.read())
    rng = random.Random(2)
    characters = "ab \n\t'1.é\u3000\x1c\u2581"
    texts = ["".join(rng.choice(characters) for _ in range(rng.randrange(0, 40))).encode() for _ in range(3000)]
    split = alignment._Slice(apart, texts, True, True)
    assert apart.chunks is alignment.CHUNK and all("".join(alignment.CHUNK.findall(" " + t.decode())) == " " + t.decode() for t in texts)
    apart.chunks = alignment.WHOLE
    apart._forget()
    whole = alignment._Slice(apart, texts, True, True)
    assert split.groups == whole.groups and split.counts == whole.counts and split.digests == whole.digests
    pairs = [{i: sorted(s.pairs[np.frombuffer(x, np.int32)].tolist()) for i, x in enumerate(s.links)} for s in (split, whole)]
    assert pairs[0] == pairs[1]
