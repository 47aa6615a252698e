import collections
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from spanloom.llm import search as S
from spanloom.llm.search import Best, Tree, search_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=20):
    """The contract's formula for every document and item."""
    bags = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    number, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    frequency = collections.Counter(t for _, bag in bags for t in bag)
    rows = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            m, score = 100 - 25 + 25 * sum(bag.values()) * number // total, 0
            for term in TERM.findall((text or "").translate(LOWER)):
                if term in bag:
                    weight = math.floor(1000 * math.log((2 * number + 2) / (2 * frequency[term] + 1)))
                    score += weight * (1_000_000_000 * bag[term] // (1000 * bag[term] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows, key=str)


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["The", "the", "É", "é", "x-y", "a_b", "日本", "K"]
    texts = [" ".join(rng.choice(words[: rng.choice((5, 68))]) for _ in range(rng.choice((0, 3, 20, 90)))) for _ in range(n)]
    return texts + [texts[3]] * 40 + [None, "", "--- !", "w1\nw2\tw3\x00w4\x7fw5", "the " * 30]


def frames(spark, docs, items):
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for clash in ("id", "n", "terms", "tfs", "rank", "score", "block", "item_no"):
        d, q = d.withColumn(clash, F.lit("x")), q.withColumn(clash, F.lit("x"))
    return d, q


def test_ranking_by_brute_force(spark, monkeypatch):
    texts = made(1, 260)
    docs = list(enumerate(texts)) + [(None, texts[5]), (7, texts[7]), (7, texts[8])]
    items = [(i, t) for i, t in enumerate(made(2, 12))] + [(3, "w1 w2 W2 w40"), (3, "w1 w2 W2 w40"), (None, "é É"), (99, "absent")]
    d, q = frames(spark, docs, items)
    got = sorted((tuple(r) for r in search_documents(d.repartition(3), q).collect()), key=str)
    assert got == plain(docs, items)
    monkeypatch.setattr(S, "ITEM_BYTES", 2000)  # several passes
    assert sorted((tuple(r) for r in search_documents(d.repartition(5), q).collect()), key=str) == got


def test_no_rows_and_one_very_long_text(spark):
    d, q = frames(spark, [(1, "word " * 400_000 + "rare")], [(1, "rare word"), (2, None)])
    assert [tuple(r) for r in search_documents(d, q).collect()] == plain([(1, "word " * 400_000 + "rare")], [(1, "rare word")])
    assert search_documents(d.limit(0), q).collect() == [] and search_documents(d, q.limit(0)).collect() == []


def test_trees_of_any_shape_find_the_best(monkeypatch):
    """Copies, prefixes of one another and rows without terms; small nodes, so that bounds decide."""
    monkeypatch.setattr(S, "LEAST_NODE", 2)
    rng = np.random.default_rng(3)
    for _ in range(30):
        rows = [np.sort(rng.choice(12, rng.integers(0, 9), replace=False)) for _ in range(50)]
        rows += [rows[0]] * 7 + [np.arange(k) for k in range(10)]
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        ranks, tfs = np.concatenate(rows).astype(np.int64), rng.integers(1, 5, int(starts[-1]))
        m, weights, ids = rng.integers(75, 200, len(rows)), rng.integers(0, 9, 12) * rng.integers(0, 2, 12), rng.integers(0, 40, len(rows))
        tree, best = Tree(starts, ranks, tfs, m), Best(5)
        assert sorted(i for node in tree.nodes for i in node.documents.tolist()) == list(range(len(rows)))
        tree.search(weights, best, ids, np.zeros(len(rows), bool))
        scores = [int((weights[ranks[a:b]] * S.gain(tfs[a:b], m[k])).sum()) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
        assert list(zip((-best.scores).tolist(), best.ids.tolist())) == sorted((-s, i) for s, i in zip(scores, ids.tolist()) if s > 0)[:5]


def test_branches_under_the_last_place_are_left(monkeypatch):
    """A rare pair of terms in one part of the tree: most nodes are never opened."""
    monkeypatch.setattr(S, "LEAST_NODE", 4)
    rows = [[k % 40, 40 + k % 7, 60] for k in range(4000)]
    starts, ranks = np.arange(0, 12001, 3), np.array(rows).ravel()
    tree, best, weights = Tree(starts, ranks, np.ones(12000, np.int64), np.full(4000, 100)), Best(20), np.zeros(61, np.int64)
    weights[[5, 43]], opened = (900, 700), []
    monkeypatch.setattr(Best, "offer", lambda self, s, i, n, offer=Best.offer: (opened.append(len(s)), offer(self, s, i, n))[1])
    tree.search(weights, best, np.arange(4000), np.zeros(4000, bool))
    assert len(best.ids) == 20 and set((best.ids % 40).tolist()) == {5}
    assert sum(opened) < 1000
