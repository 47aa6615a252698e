import datetime
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from spanloom.llm import license_scan as L
from spanloom.llm.line_rules import line_frequency_rules
from spanloom.llm.pseudonyms import luhn_sum, pseudonymise

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"


def base_counts(text):
    raw = (text or "").encode()
    words = WORD.findall(raw)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x.encode())]
    return len(words), len(b"".join(words).decode()), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


CASES = [None, "", " \t\n", "one", "a b c d e", "a b c d e f a b c d e x a b c d e", "x\nx\n\nx\ny", "é# <ü>\x0b$  z", "w " * 300, "la la la la la la la", "l1 a\n" * 7 + "end"]


def test_base_counts_by_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(CASES)], DOCS)
    for r in line_frequency_rules(docs).collect():
        want = base_counts(CASES[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_common_lines_go_and_depleted_documents_fall(spark):
    own = " ".join(f"w{i}" for i in range(12))
    rows = [(i, f"Share this  page now\n{own} d{i}", "h") for i in range(5)] + [(5, "share THIS page now\nshare this page now\n" * 9 + own, "h"), (6, f"share this page now\n{own}", "other"), (7, f"Share this page now {own}", None)]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, DOCS).withColumn("cleaned", F.lit(1)).withColumn("line_key", F.lit(2)).withColumn("removed", F.lit(3))
    out = line_frequency_rules(docs, max_docs=4).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r for r in out}
    assert got[1]["cleaned"] == f"{own} d1" and got[1]["kept"] and got[1]["n_words_left"] == 13
    assert got[5]["cleaned"] == own and not got[5]["kept"]
    assert got[6]["cleaned"].startswith("share") and got[7]["kept"]
    assert line_frequency_rules(docs.limit(0)).count() == 0


PII = "Card 4417744280351547, mail und.34@mail7.example.com; tel +1 (017) 555-7713. ip 97.51.17.173! 2024-02-29 31.12.1999 078-05-1120 token 04dbebab91ab85687d33eeaaf9ac699e1188f962"


def test_pseudonyms_keep_formats_and_links(spark):
    rows = [(1, PII), (2, f"again {PII} end"), (3, None), (4, ""), (5, "9807915762804490 300.1.1.1 2024-02-30 v 4.0.1 2 3"), (1, PII), (None, "x@y.zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_replaced", F.lit("old"))
    out = pseudonymise(docs, key="k").collect()
    first = next(r for r in out if r["doc_id"] == 1)
    assert first["n_replaced"] == 8 and len(out) == len(rows)
    shape = lambda s: re.sub("[a-z]", "a", re.sub(r"\d", "9", s))
    keep = r"ip [\d.]+|token \w+"
    assert shape(re.sub(keep, "", first["text"])) == shape(re.sub(keep, "", PII))
    for value in ("4417744280351547", "und.34@", "555-7713", "97.51.17.173", "2024-02-29", "31.12.1999", "078-05-1120", "04dbebab"):
        assert value not in first["text"]
    assert re.search(r"token [0-9a-f]{40}$", first["text"])
    assert next(r for r in out if r["doc_id"] == 2)["text"] == f"again {first['text']} end"
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[3]["text"] is None and by_id[4]["text"] == "" and by_id[5]["text"] == rows[4][1] and by_id[5]["n_replaced"] == 0
    assert pseudonymise(docs, key="other").filter("doc_id = 2").first()["text"] != by_id[2]["text"]


def test_feistel_is_a_permutation(spark):
    cards = spark.range(1000).select(F.concat(F.lit("400000000000"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("p")).withColumn("text", F.concat("p", F.pmod(10 - luhn_sum(F.concat("p", F.lit("0"))) % 10, F.lit(10)).cast("string")))
    out = pseudonymise(cards.select("text"), key="k").select("text", (luhn_sum(F.col("text")) % 10).alias("check")).collect()
    assert len({r["text"] for r in out}) == 1000 and all(r["check"] == 0 for r in out)
    days = spark.range(0, 73049, 61).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pseudonymise(days, key="k").select("text").distinct().count() == days.count()


def mixed(half, r, key):
    return int(hashlib.sha256(f"{key}|{r}|{half}".encode()).hexdigest()[:15], 16)


def feistel(a, b, m, n, key):
    for r in range(10):
        a, b = ((a + mixed(b, r, key)) % m, b) if r % 2 == 0 else (a, (b + mixed(a, r, key)) % n)
    return a, b


def by_hand(kind, value, key="k"):
    """The pseudonym of a valid value, worked out in plain Python."""
    if kind == "address":
        o = [int(x) for x in value.split(".")]
        low = [0 if x < 10 else 10 if x < 100 else 100 for x in o]
        size = [{0: 10, 10: 90, 100: 156}[x] for x in low]
        d = [x - y for x, y in zip(o, low)]
        a, b = feistel(d[0] * size[1] + d[1], d[2] * size[3] + d[3], size[0] * size[1], size[2] * size[3], key + "|address")
        return ".".join(str(x + y) for x, y in zip((a // size[1], a % size[1], b // size[3], b % size[3]), low))
    if kind == "social":
        area, group, serial = map(int, value.split("-"))
        a, b = feistel(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key + "|social")
        area = a + (2 if a >= 665 else 1)
        return f"{area:03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    if kind == "card":
        digits = [c for c in value if c.isdigit()]
        body = digits[:-1]
        half = len(body) // 2
        left, right = int("".join(body[:half])), int("".join(body[half:]))
        a, b = feistel(left, right, 10**half, 10 ** (len(body) - half), key + "|card|")
        new = f"{a:0{half}}{b:0{len(body) - half}}"
        new += str(-sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(new))) % 10)
        rest = iter(new)
        return "".join(next(rest) if c.isdigit() else c for c in value)
    year, month, day, style, walks = kind[1](value)
    n = (datetime.date(year, month, day) - datetime.date(1900, 1, 1)).days
    while True:
        a, b = feistel(n // 229, n % 229, 319, 229, key + "|date")
        n = a * 229 + b
        new = datetime.date(1900, 1, 1) + datetime.timedelta(n)
        if not walks or new.day > 12:
            return style.format(y=new.year, m=new.month, d=new.day)


ints = lambda v: [int(x) for x in re.split("[-/.]", v)]
ISO = ("date", lambda v: (*ints(v), "{y}-{m:02}-{d:02}", False))
SHORT = ("date", lambda v: (*ints(v), "{y}/{m}/{d}", False))
DOTTED = ("date", lambda v: (*ints(v)[::-1], "{d:02}.{m:02}.{y}", False))
MONTHS = ("date", lambda v: (ints(v)[2], *ints(v)[:2], "{m:02}/{d:02}/{y}", False))
DAYS = ("date", lambda v: (*ints(v)[::-1], "{d:02}/{m:02}/{y}", True))


def test_pseudonyms_by_brute_force(spark):
    cases = [("address", v) for v in ("10.1.1.1", "255.255.255.255", "0.0.0.0", "97.51.17.173")] + [("social", v) for v in ("078-05-1120", "665-01-0001", "667-99-9999", "001-01-0001", "899-50-5000")]
    cases += [("card", "4417744280351547"), ("card", "4417 7442 8035 1547"), (ISO, "1900-01-01"), (ISO, "2099-12-31"), (ISO, "2024-02-29"), (SHORT, "1999/7/30"), (DOTTED, "31.12.1999"), (MONTHS, "12/25/1999"), (MONTHS, "03/04/1950"), (DAYS, "25/12/1999"), (DAYS, "31/01/2000")]
    got = [r["text"] for r in pseudonymise(spark.createDataFrame([(i, v) for i, (_, v) in enumerate(cases)], "doc_id long, text string"), key="k").orderBy("doc_id").collect()]
    assert got == [by_hand(kind, v) for kind, v in cases]


def test_what_does_not_validate_stays(spark):
    texts = ["010.1.1.1", "256.1.1.1", "000-12-1234", "666-12-1234", "912-12-1234", "123-00-1234", "123-45-0000", "2023-02-29", "13/13/2000", "31/12/2100", "4417744280351548"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["text"] for r in pseudonymise(docs, key="k").collect()} == set(texts)
    moved = ["2024-01-05T10:00:00Z", "3/7/1990", "1.5.1990"]
    out = {r["text"] for r in pseudonymise(spark.createDataFrame([(t,) for t in moved], "text string"), key="k").collect()}
    assert not out & set(moved) and any(t.endswith("T10:00:00Z") for t in out)


def test_day_first_dates_are_permuted(spark):
    days = spark.range(0, 73049, 7).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d")).filter(F.dayofmonth("d") > 12).select(F.date_format("d", "dd/MM/yyyy").alias("text"))
    new = [r["text"] for r in pseudonymise(days, key="k").collect()]
    assert len(set(new)) == len(new) and all(int(t[:2]) > 12 for t in new)


def test_long_runs_end(spark):
    size = 1 << 20
    units = [".c", "a", "a.", "0", "f", "1.", "1-", "12 ", "+1 ", "a@", "a@b.", "2000-01-01", "1234 ", "-"]
    texts = [t for unit in units for t in ("a@b" + unit * (size // len(unit)), unit * (size // len(unit)) + "@b.c")]
    out = pseudonymise(spark.createDataFrame([(t,) for t in texts], "text string").repartition(8), key="k").select(F.length("text").alias("n")).collect()
    assert sorted(r["n"] for r in out) == sorted(map(len, texts))


def test_the_key_is_a_setting(spark):
    from spanloom.llm.queries import KEY_SETTING, pseudonym_key

    spark.conf.set(KEY_SETTING, "own")
    assert pseudonym_key(spark) == "own"
    spark.conf.unset(KEY_SETTING)
    assert pseudonym_key(spark) == "trial"


def test_lines_count_documents_not_rows(spark):
    line = "the same line here"
    rows = [(1, f"{line}\n{i}", "h") for i in range(9)] + [(2, line, "h"), (3, line, "h")] + [(None, line, "i")] * 9 + [(None, f"{line} \n{i}", "i") for i in range(3)]
    docs = spark.createDataFrame(rows, DOCS)
    out = line_frequency_rules(docs, max_docs=3, min_words=1).collect()
    assert len(out) == len(rows)
    # Three documents of "h" hold the line; of "i" four different texts without id do.
    assert all(r["n_words_left"] == r["n_words"] for r in out if r["doc_id"] is not None)
    assert sorted(r["cleaned"] for r in out if r["doc_id"] is None) == [""] * 9 + ["0", "1", "2"]
    assert "cleaned" not in line_frequency_rules(docs, cleaned=False).columns


def test_very_long_texts_of_lines_and_licenses(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    notice = "Licensed under the MIT License."
    docs = spark.createDataFrame([(1, f"{long} {notice} {long}", "h"), (2, "\n".join(f"l{i}" for i in range(200_000)), "h")], DOCS)
    got = {r["doc_id"]: r for r in line_frequency_rules(docs, cleaned=False).collect()}
    assert (got[1]["n_words"], got[1]["n_repeat_words"]) == (400_000 + len(notice.split()), 400_000)
    assert got[2]["n_dup_lines"] == 0 and got[2]["kept"]
    assert [(r["doc_id"], r["license"]) for r in L.scan_licenses(docs).collect()] == [(1, "MIT")]


def test_whole_licenses_are_told_apart(spark):
    texts = [L.MIT, L.ISC, f"{L.BSD_TWO} {L.BSD_END}", f"{L.BSD_TWO} {L.BSD_THIRD} {L.BSD_END}", L.UNLICENSE, L.MIT.replace("sell copies", "sell no copies").replace("TORT", "WRONG")]
    docs = spark.createDataFrame([(i, f"Copyright 2020 A Person\n\n{t}\nend of it") for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["license"]) for r in L.scan_licenses(docs).collect())
    assert [x for x in got if x[0] < 5] == [(0, "MIT"), (1, "ISC"), (2, "BSD-2-Clause"), (3, "BSD-3-Clause"), (4, "Unlicense")]
    assert (5, "MIT") in got


def test_templates_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.txt").write_text("you may use\nthis text as you like it")
    assert L.read_templates(spark, str(tmp_path)) == [("Own-1", "you may use\nthis text as you like it")]


def test_licenses_by_brute_force(spark):
    filler = " ".join(f"q{i}" for i in range(60))
    texts = [None, "", "short", *(f"{filler} {t.upper()} {filler}" for _, t in L.TEMPLATES), f"{filler} Released under the licence. {filler}", "Released under\nthe MIT, License"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("template", F.lit(1)).withColumn("hashes", F.lit(2))

    def shingles(text):
        w = [x for x in re.split(r"[\x00-\x2C\x2E\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    share = {(i, n): len(shingles(t) & shingles(x)) / len(shingles(t)) for i, x in enumerate(texts) for n, (_, t) in enumerate(L.TEMPLATES)}
    want = set()
    for i in range(len(texts)):
        hits = {n for n in range(len(L.TEMPLATES)) if share[i, n] >= 0.8}
        rival = lambda a, b: a != b and len(shingles(L.TEMPLATES[a][1]) & shingles(L.TEMPLATES[b][1])) >= 0.8 * len(shingles(L.TEMPLATES[a][1]))
        want |= {(i, L.TEMPLATES[a][0]) for a in hits if not any(rival(a, b) and (share[i, b], len(shingles(L.TEMPLATES[b][1]))) > (share[i, a], len(shingles(L.TEMPLATES[a][1]))) for b in hits)}
    got = L.scan_licenses(docs).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == want
    assert len(got) == len(want) and L.scan_licenses(docs.limit(0)).count() == 0


def test_bands_guarantee_retrieval():
    assert 1 - (1 - L.PIECE / L.WINDOW) ** L.BANDS >= 1 - 1e-6
    assert L.bands_for(1.0, 0.99) == 1
    for n in range(L.LEAST, 400):  # more pieces than shingles that may lack
        assert n // L.PIECE > n - math.ceil(0.8 * n)
        assert all(any(k * L.STRIDE <= at and at + L.PIECE <= k * L.STRIDE + L.WINDOW for k in range(n)) for at in range(0, n - L.PIECE + 1, 7))


def test_texts_at_the_limit_and_many_long_templates(spark):
    """Every text keeps four fifths of one of 300 long templates, or just under."""
    rng = random.Random(6)
    templates = [(f"L{k}", " ".join(f"t{rng.randrange(5000)}" for _ in range(1000))) for k in range(300)]
    texts = []
    for k in range(60):
        words = templates[k * 5][1].split()
        for place in range(0, 1000, 25 if k % 2 else 20):  # each changed word takes five of the 996 shingles
            words[place + 2] = f"x{place}"
        texts.append(" ".join(["before", *words, "behind"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["license"]) for r in L.scan_licenses(docs.repartition(4), templates=templates).collect()}
    assert got == {(k, f"L{k * 5}") for k in range(1, 60, 2)}


@pytest.mark.parametrize("name", ["op2_feistel_pseudonyms", "op3_line_frequency", "op10_license_scan"])
def test_native_plans_have_no_python(spark, name):
    from spanloom.llm.catalog import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


