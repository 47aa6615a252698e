import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanloom.llm import decontaminate as D
from spanloom.llm.bpe import encode_decode
from spanloom.llm.chat import escape, fold_events, format_conversations, read_back, render, unescape
from spanloom.llm.components import connected_components
from spanloom.llm.language_model import score_texts
from spanloom.llm.near import keep_first, near_duplicates
from spanloom.llm.quality import document_features, fit, isotonic, remainder, score_documents, score_features
from spanloom.llm.substrings import SuffixAutomaton, remove_repeats

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RNG = random.Random(4)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def frame(spark, texts, ids=None):
    rows = list(zip(ids if ids is not None else range(len(texts)), texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("node", "key", "words", "score", "block", "item_id"):
        docs = docs.withColumn(clash, F.lit("x"))
    return docs


# --- chat ---------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "plain", "</s>[INST] ok [/INST]", "a\\b<\\s>", "<s><s>[INST", "\\", "x\n\\[INST]\\", "é\U0001f600</s>"])
def test_escaping_is_reversible_and_leaves_no_control(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))
    formatted, spans = render([("user", text), ("assistant", text), ("", "")])
    assert read_back(formatted) == [("user", text), ("assistant", text), ("", "")]
    assert [unescape(formatted[a:b]) for a, b in spans] == [text]


def test_events_fold_to_final_messages(spark):
    log = [
        ("c", 0, 0, "user", "message", "hi"), ("c", 1, 1, "assistant", "message", ""), ("c", 2, 1, None, "delta", "he"), ("c", 3, 1, None, "delta", "llo"),
        ("c", 4, 2, "user", "message", "more"), ("c", 5, 3, "assistant", "message", "gone"), ("c", 6, 2, None, "edit", "less"),
        ("c", 7, 3, "assistant", "message", "new"), ("c", 8, 3, None, "regenerate", None), ("c", 9, 3, None, "delta", "best"), ("d", 0, 0, None, None, None),
    ]
    RNG.shuffle(log)
    events = spark.createDataFrame(log, "conv_id string, seq long, turn long, role string, kind string, text string").withColumn("start", F.lit(1))
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in fold_events(events).collect()}
    assert got[("c", 0)] == ("user", "hi") and got[("c", 1)] == ("assistant", "hello") and got[("c", 2)][1] == "less" and got[("c", 3)][1] == "best"
    assert got[("d", 0)] == ("", "")
    whole = format_conversations(fold_events(events)).filter("conv_id = 'c'").first()
    assert [m[1] for m in read_back(whole["formatted"])] == ["hi", "hello", "less", "best"]
    assert format_conversations(fold_events(events.limit(0))).count() == 0


def plain_fold(log):
    """Final messages of a log with distinct sequence numbers, event by event."""
    turns, roles = {}, {}
    for conv, _, turn, role, kind, text in sorted(log, key=lambda e: e[1]):
        if role is not None:
            roles[conv, turn] = role
        if kind in ("edit", "regenerate"):
            for key in [k for k in turns if k[0] == conv and k[1] > turn]:
                del turns[key]
        if kind == "delta":
            old = turns.get((conv, turn), (None, ""))
            turns[conv, turn] = (old[0] if old[0] is not None else role, old[1] + (text or ""))
        else:
            turns[conv, turn] = (role, "" if kind == "regenerate" else text or "")
    return {k: (r if r is not None else roles.get(k, ""), t) for k, (r, t) in turns.items()}


def test_folding_by_brute_force(spark):
    rng = random.Random(8)
    log = []
    for seq in range(600):
        kind = rng.choices(["message", "delta", "edit", "regenerate"], [3, 6, 1, 1])[0]
        log.append((f"c{rng.randint(0, 9)}", seq, rng.randint(0, 6), rng.choice([None, "user", "assistant"]), kind, rng.choice([None, "a", "</s>", "long text ", "\\n"])))
    want = plain_fold(log)
    rng.shuffle(log)
    events = spark.createDataFrame(log, "conv_id string, seq long, turn long, role string, kind string, text string").repartition(4)
    assert {(r["conv_id"], r["turn"]): (r["role"], r["text"]) for r in fold_events(events).collect()} == want


def test_one_very_long_turn(spark):
    text = "[INST]\\x " * 200_000
    row = format_conversations(spark.createDataFrame([("c", 1, "assistant", text)], "conv_id string, turn long, role string, text string")).first()
    assert read_back(row["formatted"]) == [("assistant", text)]
    assert unescape(row["formatted"][row["loss_spans"][0]["start"] : row["loss_spans"][0]["end"]]) == text


# --- quality ------------------------------------------------------------------


def test_classifier_separates_and_handles_empties(spark):
    good = [prose(60).replace(" w", ". W", 3) for _ in range(150)]
    bad = [prose(30).replace(" ", "### ") for _ in range(75)] + [("spam " * 40) for _ in range(75)]
    texts = good + bad + ["", None]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(7, None), (9999, 1)], "doc_id long, quality int")
    part = remainder("doc_id", 4)
    model = fit(document_features(docs), labels, ridge_rows=part.isin(0, 1), calibration_rows=part == 3)
    rows = score_documents(docs, model).collect()
    assert sorted(map(tuple, score_features(document_features(docs), model).collect())) == sorted(map(tuple, rows))
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["doc_id"] < 300]
    assert sum(r["predicted"] == (r["doc_id"] < 150) for r in held) / len(held) > 0.95
    none = fit(document_features(docs), labels.limit(0), ridge_rows=part.isin(0, 1), calibration_rows=part == 3)
    assert {r["score"] for r in score_documents(docs, none).collect()} == {0.5}


def test_classifier_by_plain_numpy(spark):
    from spanloom.llm import quality as Q

    texts = [prose(RNG.randint(5, 80)) + ("!" * RNG.randint(0, 9)) for _ in range(160)] + ["", None]
    docs = frame(spark, texts)
    truth = {i: int(RNG.random() < 0.3 + 0.5 * ("!" in (t or ""))) for i, t in enumerate(texts) if i % 5}
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, quality int")
    part = remainder("doc_id", 4)
    model = fit(document_features(docs), labels, ridge_rows=part.isin(0, 1), calibration_rows=part == 3, components=40)
    got = {r["doc_id"]: r["score"] for r in score_documents(docs, model).collect()}
    x = np.array([Q.statistics((t or "").encode()) for t in texts])
    of = np.array([zlib.crc32(str(i).encode()) % 4 for i in range(len(texts))])
    known = np.array([i in truth for i in range(len(texts))])
    y = np.array([truth.get(i, 0) for i in range(len(texts))], float)
    train, calibrate = known & (of < 2), known & (of == 3)
    scale = x[train].std(axis=0)
    z = np.clip((x - x[train].mean(axis=0)) / np.where(scale > 1e-9, scale, 1), -8, 8)
    rng = np.random.default_rng(Q.SEED)
    w, phase = rng.normal(0, 1 / Q.WIDTH, (x.shape[1], 40)), rng.uniform(0, 2 * np.pi, 40)
    phi = np.hstack((np.sqrt(2 / 40) * np.cos(z @ w + phase), np.ones((len(z), 1))))
    beta = np.linalg.solve(phi[train].T @ phi[train] + Q.RIDGE * train.sum() / 40 * np.eye(41), phi[train].T @ y[train])
    raw = np.clip(phi @ beta, Q.LOW, Q.HIGH)
    assert np.allclose(model.weights, beta, atol=1e-5)
    bins = collections.defaultdict(list)
    for r, label in zip(raw[calibrate], y[calibrate]):
        bins[int((r - Q.LOW) / (Q.HIGH - Q.LOW) * Q.BINS)].append(label)
    at = sorted(bins)
    knots = isotonic(np.array([Q.LOW + (b + 0.5) * (Q.HIGH - Q.LOW) / Q.BINS for b in at]), np.array([np.mean(bins[b]) for b in at]), np.array([len(bins[b]) for b in at], float))
    want = np.clip(np.interp(raw, *knots), 0, 1)
    assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-3)
    # The features approximate a Gaussian kernel.
    wide = np.hstack([np.sqrt(2 / 4000) * np.cos(z @ rng.normal(0, 1 / Q.WIDTH, (x.shape[1], 4000)) + rng.uniform(0, 2 * np.pi, 4000))])
    kernel = np.exp(-((z[:, None] - z[None]) ** 2).sum(axis=2) / (2 * Q.WIDTH**2))
    assert np.abs(wide @ wide.T - kernel).max() < 0.1


def test_isotonic_is_monotone():
    x = np.linspace(-0.9, 1.9, 20)
    knots, values = isotonic(x, np.array([0, 1, 0, 0, 1, 0, 1, 1, 0, 1] * 2, float), np.ones(20))
    assert (np.diff(values) >= 0).all() and (np.diff(knots) > 0).all()


# --- language model -----------------------------------------------------------


def test_base_score_by_brute_force_and_better_model(spark):
    texts = [None, "", "The the THE", *(prose(40) for _ in range(60)), *(f"only{i} seen{i} here" for i in range(20))]
    docs = frame(spark, texts)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    rows = score_texts(docs, learn=~held).collect()
    assert len(rows) == len(texts)
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in enumerate(texts)}
    learned = collections.Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(learned.values()), len(learned)
    for r in rows:
        ws = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in learned for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((learned[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert r["score"] < 0
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert score_texts(docs.limit(0), learn=F.lit(True)).count() == 0


def test_seating_has_the_distribution_of_gibbs_sampling():
    from spanloom.llm.language_model import seat

    d, mass, many = 0.6, 0.35, 20_000
    for count in (2, 5, 9):
        # Weight of each number of tables: mass ** t times the generalised Stirling number.
        stirling = {1: 1.0}
        for n in range(1, count):
            stirling = {t: stirling.get(t - 1, 0) + (n - d * t) * stirling.get(t, 0) for t in range(1, n + 2)}
        weights = np.array([mass**t * stirling[t] for t in range(1, count + 1)])
        keys = np.arange(many, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        last = None
        for sweep in range(12):
            tables, last = seat(np.full(many, count), np.full(many, mass), d, keys, sweep, last)
        got = np.bincount(tables.astype(int), minlength=count + 1)[1:] / many
        assert np.abs(got - weights / weights.sum()).max() < 0.012
        # One customer at a time, by hand, agrees.
        rng = random.Random(count)
        sizes, seen = [1] * count, collections.Counter()
        for turn in range(30_000):
            k = rng.choices(range(len(sizes)), sizes)[0]
            sizes[k] -= 1
            sizes = [x for x in sizes if x]
            at = rng.choices(range(len(sizes) + 1), [*(x - d for x in sizes), mass])[0]
            sizes = [*sizes, 1] if at == len(sizes) else [x + (i == at) for i, x in enumerate(sizes)]
            seen[len(sizes)] += 1
        assert max(abs(seen[t] / 30_000 - got[t - 1]) for t in range(1, count + 1)) < 0.03


def test_known_words_are_scored_above_the_base(spark):
    rng = random.Random(2)
    follow = {w: rng.sample(VOCABULARY, 6) for w in VOCABULARY}

    def chain(n):
        words = [rng.choice(VOCABULARY)]
        while len(words) < n:
            words.append(rng.choice(follow[words[-1]]))
        return " ".join(words)

    texts = [chain(60) for _ in range(300)]
    rows = score_texts(frame(spark, texts), learn=F.col("doc_id") >= 40).collect()
    held = [r for r in rows if r["doc_id"] < 40 and r["n_known"] == r["n_tokens"]]
    assert len(held) > 20
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.3 * sum(r["n_tokens"] for r in held)


def test_repeated_rows_null_ids_and_a_very_long_text_are_scored(spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = score_texts(frame(spark, ["a b", "a b", None, long], ids=[1, 1, None, 2]), learn=F.lit(True)).collect()
    assert len(rows) == 4 and len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    assert {r["n_tokens"] for r in rows} == {3, 1, 200_001} and {r["train_tokens"] for r in rows} == {200_008}


def test_word_contexts_count(spark, monkeypatch):
    from spanloom.llm import language_model

    chain = [f"c{i}" for i in range(30)]
    texts = [" ".join(chain[k : k + 12]) for k in range(18)] * 4
    inside = chain[5:15]
    mixed_up = [inside[i] for i in (3, 0, 7, 4, 9, 1, 6, 2, 8, 5)]
    docs = frame(spark, [*texts, " ".join(inside), " ".join(mixed_up), "never seen", "c1 never"])
    learn = F.col("doc_id") < len(texts)
    rows = {r["doc_id"]: r for r in score_texts(docs, learn=learn).collect()}
    n = len(texts)
    assert rows[n]["base_score"] == pytest.approx(rows[n + 1]["base_score"])
    assert rows[n]["score"] > rows[n + 1]["score"] + 5
    assert len(rows) == n + 4 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows.values())
    # Cutting frequent contexts into parts changes no score.
    monkeypatch.setattr(language_model, "HOT_TOKENS", 8)
    monkeypatch.setattr(language_model, "HOT_SHARE", 1 << 20)
    cut = {r["doc_id"]: r["score"] for r in score_texts(docs, learn=learn).collect()}
    assert cut == pytest.approx({k: r["score"] for k, r in rows.items()})


# --- decontamination ----------------------------------------------------------


def test_masks_tolerate_any_two_substitutions():
    import itertools

    for bad in itertools.combinations(range(13), 2):
        assert any(all(o + k not in bad for k, c in enumerate(m) if c == "1") for m in D.MASKS for o in range(13 - len(m) + 1))


def plain_overlap(text, item, least=13, tolerated=2):
    w, b = (x.encode().translate(D.FOLD).split() for x in (text, item))
    size = min(least, len(b))
    allowed = tolerated if size >= least else tolerated * size // least
    return size > 0 and any(sum(w[i + k] == b[j + k] for k in range(size)) >= size - allowed for i in range(len(w) - size + 1) for j in range(len(b) - size + 1))


def test_short_masks_tolerate_their_substitutions():
    import itertools

    for size in range(1, 13):
        allowed = D.tolerance(size, 13, 2)[1]
        masks = D.short_masks(size, allowed)
        assert all(len(m) == size for m in masks)
        for bad in itertools.combinations(range(size), allowed):
            assert any(all(k not in bad for k, c in enumerate(m) if c == "1") and "1" in m for m in masks)


def test_overlaps_by_brute_force(spark):
    items = [prose(n) for n in (30, 17, 13, 12, 11, 10, 9, 8, 7, 6, 4, 1)] + ["", None]
    texts = [None, "", prose(5)]
    for item in items[:12]:
        words = item.split()
        for changes in (0, 1, 1, 2, 3, 6):
            broken = list(words)
            for k in RNG.sample(range(len(broken)), min(changes, len(broken))):
                broken[k] = "zz"
            texts.append(f"{prose(20)} {' '.join(broken).upper()}, {prose(20)}")
    texts += [prose(50) for _ in range(20)] + [texts[3], items[0], " ".join(items[0].split()[4:18])]
    docs = frame(spark, texts)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("place", F.lit("x"))
    got = {(r["doc_id"], r["item_id"]) for r in D.find_overlaps(docs, benchmark).collect()}
    assert got == {(i, j) for i, text in enumerate(texts) for j, item in enumerate(items) if plain_overlap(text or "", item or "")}
    kept = {r["doc_id"] for r in D.decontaminate(docs, benchmark).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in got}
    assert D.decontaminate(docs, benchmark).columns == docs.columns
    assert D.find_overlaps(docs, benchmark.limit(0)).count() == 0 and D.decontaminate(docs, benchmark.limit(0)).count() == len(texts)
    assert D.decontaminate(docs.limit(0), benchmark).count() == 0


def test_overlap_of_repeated_rows_items_and_a_very_long_text(spark):
    item = prose(40)
    long = " ".join(f"n{i}" for i in range(200_000))
    docs = frame(spark, [item, item, f"{long} {item} {long}", long], ids=[1, 1, None, 2])
    benchmark = spark.createDataFrame([(5, item), (5, item), (None, item.upper())], "item_id long, text string")
    rows = D.find_overlaps(docs, benchmark).collect()
    assert sorted((str(r["doc_id"]), str(r["item_id"]), r["first_word"], r["n_words"], r["n_same"]) for r in rows) == sorted(
        (d, i, f, 40, 40) for d, f in (("1", 0), ("1", 0), ("None", 200_000)) for i in ("5", "5", "None")
    )
    assert [r["doc_id"] for r in D.decontaminate(docs, benchmark).collect()] == [2]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(D, "SMALL_BITS", 5)
    monkeypatch.setattr(D, "LARGE_BITS", 6)
    items = [prose(25) for _ in range(30)]
    texts = [f"{prose(9)} {items[i]} {prose(4)}" for i in range(0, 30, 3)] + [prose(60) for _ in range(10)]
    got = {(r["doc_id"], r["item_id"]) for r in D.find_overlaps(frame(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if plain_overlap(t, x)}


# --- near duplicates ----------------------------------------------------------


def test_links_and_classes_by_brute_force(spark):
    base = [prose(80) for _ in range(12)]
    texts = [None, "", "  ", "one two", "one two", "one two three four five"]
    for text in base:
        words = text.split()
        texts.append(text)
        for changes in (0, 1, 1, 2, 3, 5):
            near = list(words)
            for k in RNG.sample(range(80), changes):
                near[k] = "new"
            texts.append("\n".join(near))
    docs = frame(spark, texts)

    def shingles(t):
        w = (t or "").encode().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    links = {i: {j for j in range(len(texts)) if j != i and (sets[i] == sets[j] or (sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])))} for i in range(len(texts))}
    names = list(range(len(texts)))
    for _ in names:
        names = [min([names[i], *(names[j] for j in links[i])]) for i in range(len(texts))]
    classes = near_duplicates(docs)
    for r in classes.collect():
        assert (r["class_id"], r["n_links"]) == (names[r["doc_id"]], len(links[r["doc_id"]]))
    assert {r["doc_id"] for r in keep_first(docs, classes).collect()} == set(names)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "q r s t u v", "q r s t u v"], ids=[3, 3, None, 8])
    classes = near_duplicates(docs)
    assert sorted((str(r["doc_id"]), r["class_id"], r["n_links"]) for r in classes.collect()) == [("3", 3, 1), ("3", 3, 1), ("8", 8, 1), ("None", 8, 1)]
    assert sorted(str(r["doc_id"]) for r in keep_first(docs, classes).collect()) == ["3", "8"]


def test_one_row_of_each_class_stays(spark):
    texts = ["a b c d e f", "g h i j k l", "m n o p q r", "m n o p q r", "s t u v w x", "y z a b c d", "y z a b c d"]
    docs = frame(spark, texts, ids=[None, None, None, 5, 6, 6, None])
    kept = keep_first(docs, near_duplicates(docs))
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("None", texts[0]), ("None", texts[1]), ("5", texts[3]), ("6", texts[4]), ("6", texts[5])])


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    from spanloom.llm import near

    words = prose(120).split()
    texts = [" ".join([*words[: i % 100], f"x{i}", *words[i % 100 + 1 :]]) for i in range(90)]
    whole = sorted(map(tuple, near_duplicates(frame(spark, texts)).collect()))
    monkeypatch.setattr(near, "LEAST_CLASSES", 16)
    assert sorted(map(tuple, near_duplicates(frame(spark, texts)).collect())) == whole
    assert {w[1] for w in whole} == {0}


def test_links_at_the_threshold_among_easy_ones(spark):
    rng = random.Random(8)
    texts = []
    for k in range(1700):
        words = prose(49, rng).split()
        changed = 5 if k < 200 else 1
        # 40 of 50 shingles in common, or 44 of 46.
        texts += [" ".join(words), " ".join([*words[:-changed], *(f"n{k}x{i}" for i in range(changed))])]
    links = {r["doc_id"]: r["n_links"] for r in near_duplicates(frame(spark, texts)).collect()}
    assert sum(links[2 * k] for k in range(200)) == 200
    assert sum(links[2 * k] for k in range(200, 1700)) == 1500


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(3)
    names = rng.sample(range(10**6), 700)
    path, star, tail = names[:300], names[300:600], names[600:]
    edges = list(zip(path, path[1:])) + [(max(star), s) for s in star] + [(star[0], tail[0])] + [(tail[i // 2], tail[i]) for i in range(1, 100)]
    edges += [(b, a) for a, b in edges[:50]] + edges[:20]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {n: min(path) for n in path} | {n: min(star + tail) for n in star + tail}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_in_many_batches_by_brute_force(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(120):
        words = list(base)
        for k in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randint(0, 30)}"
        texts.append(" ".join(words))
    texts += [prose(60, rng) for _ in range(60)] + texts[:7]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    link = [[j for j in range(len(texts)) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(texts))]
    label = list(range(len(texts)))
    for _ in texts:
        label = [min([label[i], *(label[j] for j in link[i])]) for i in range(len(texts))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates(frame(spark, texts)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {i: (label[i], len(link[i])) for i in range(len(texts))}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (7, 7), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(1, 41)} == {1} and got[100] == got[50] == 50


# --- repeats ------------------------------------------------------------------


def plain_removal(texts, length=13):
    words = [(t or "").encode().split() for t in texts]
    first = {}
    for i, w in enumerate(words):
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = []
    for i, w in enumerate(words):
        gone = {k + j for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] < i for j in range(length)}
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def test_removal_by_brute_force(spark):
    shared = [prose(n) for n in (13, 14, 30, 60)]
    texts = [None, "", prose(12), prose(13)]
    for _ in range(25):
        texts.append(" ".join([prose(RNG.randint(0, 30)), RNG.choice(shared), prose(RNG.randint(0, 9)), RNG.choice(shared)[10:], prose(5)]))
    texts += ["same " * 40, "same " * 14, texts[5], texts[6] + "\n\ttail", "la " * 200]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(plain_removal(texts)))
    assert remove_repeats(frame(spark, texts).limit(0)).count() == 0


def test_hot_minimisers_go_window_by_window(spark, monkeypatch):
    from spanloom.llm import substrings

    monkeypatch.setattr(substrings, "HOT_DOCUMENTS", 4)
    common = prose(11)
    texts = [f"{prose(6)} {common} {prose(RNG.randint(1, 3))} {prose(9)}" for _ in range(30)] + [f"{common} same tail here for all of these"] * 3
    texts += [texts[4], f"{prose(4)} {texts[9]}"]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in remove_repeats(frame(spark, texts)).collect()}
    assert got == dict(enumerate(plain_removal(texts)))


def test_same_and_null_ids_in_removal(spark):
    text = prose(20)
    rows = remove_repeats(frame(spark, [text, text, text], ids=[4, 4, None])).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in rows) == [("4", 20), ("4", 20), ("None", 0)]


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    first, other, own = prose(20), prose(20), " ".join(f"own{i}" for i in range(40))
    texts = [first, f"{other} {first}", own, f"{own} {other}", f"{first} {own}"]
    rows = remove_repeats(frame(spark, texts, ids=[1, 2, 2, 3, None])).collect()
    got = {(r["doc_id"], r["n_words"]): (r["n_removed"], r["kept_text"]) for r in rows}
    assert got[1, 20] == (20, "")  # the row without an id comes first
    assert sorted(r["n_removed"] for r in rows if r["doc_id"] == 2) == [20, 40]
    assert len(rows) == 5 and got[None, 60] == (0, f"{first} {own}")


def test_ids_with_several_texts_by_brute_force(spark):
    shared = [prose(25) for _ in range(4)]
    rows = [(RNG.randint(0, 9), " ".join([prose(RNG.randint(0, 15)), RNG.choice(shared), prose(4)])) for _ in range(40)]
    rows += rows[:5]
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, i), i)
    want = []
    for i, t in rows:
        w = t.split()
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = remove_repeats(frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_one_very_long_text_in_removal(spark):
    words = [f"w{i}" for i in range(150_000)]
    rows = remove_repeats(frame(spark, [" ".join(words[70_000:70_050]), " ".join(words), " ".join(words[100:])])).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {0: 0, 1: 50, 2: 149_900}


def test_automaton_finds_first_documents():
    rng = random.Random(1)
    for _ in range(60):
        docs = [([rng.randint(0, 3) for _ in range(rng.randint(1, 25))], d) for d in rng.sample(range(90), 6)]
        automaton = SuffixAutomaton(docs)
        query = [rng.randint(0, 3) for _ in range(30)]
        for size in (1, 3, 5):
            want = []
            for k in range(len(query) - size + 1):
                hits = [d for w, d in docs if any(w[j : j + size] == query[k : k + size] for j in range(len(w) - size + 1))]
                want.append(min(hits, default=-1))
            assert automaton.first_documents(query, size) == want


# --- BPE ----------------------------------------------------------------------

ODD = ["", None, "a\x1cb\x85d\xa0e f", "  x\n\n y\t", "<|endoftext|>a<|endoftext|> b<|endo", "don't I'LL we've", "​wide　line", "a" * 1000, "ab" * 300 + "1234567890", "日本語 é́ 😀👩‍👩‍👧 ½ Ⅷ", "\x00\x01\x7f", "x\r\ny\r\n  z", "_foo__bar--baz...!!"]


def test_ids_equal_the_library(spark):
    library = Tokenizer.from_file(TOKENIZER)
    texts = [*ODD, *(prose(30) for _ in range(5))]
    for r in encode_decode(frame(spark, texts), TOKENIZER, outputs=("ids", "decoded", "ids_sha256", "decoded_sha256")).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded"] == decoded == (texts[r["doc_id"]] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert encode_decode(frame(spark, texts).limit(0), TOKENIZER).count() == 0
