import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from spanloom.llm.arrays import FOLD
from spanloom.llm.decontaminate import find_overlaps, tolerance
from spanloom.llm.near import near_duplicates
from spanloom.llm.pseudonyms import pseudonymise
from spanloom.llm.quality import document_features, fit, remainder, score_documents
from spanloom.llm.queries import pseudonym_key
from spanloom.llm.stages import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = written(stage(spark, docs, SF))
    return found


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns_and_shrink(outputs):
    names = ["", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(names, names[1:-1]):
        assert outputs[after].columns == outputs[before].columns
        assert ids(outputs[after]) <= ids(outputs[before])
    assert ids(outputs["bpe"]) == ids(outputs["pii"]) == ids(outputs["benchmark_decontamination"])


def test_low_quality_goes(spark, outputs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = outputs["quality_classifier"].join(labels, "doc_id").groupBy("quality").count()
    counts = {r["quality"]: r["count"] for r in kept.collect()}
    total = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
    assert counts[1] >= 0.9 * total[1] and counts.get(0, 0) <= 0.4 * total[0]


def test_one_of_each_class_stays(outputs):
    classes = {r["doc_id"]: r["class_id"] for r in near_duplicates(outputs["quality_classifier"]).collect()}
    assert ids(outputs["ngram_jaccard_join"]) == set(classes.values())


def test_overlaps_are_gone_and_nothing_else(spark, outputs):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = ids(find_overlaps(outputs["ngram_jaccard_join"], benchmark))
    assert ids(outputs["benchmark_decontamination"]) == ids(outputs["ngram_jaccard_join"]) - hit


def test_pii_changes_and_tokens_decode(outputs):
    before = {r["doc_id"]: r["text"] for r in outputs["benchmark_decontamination"].collect()}
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in outputs["pii"].collect()}
    assert all(len(t) == n for t, n in after.values())
    assert all(before[i] == t for i, (t, _) in after.items() if not any(c.isdigit() for c in before[i]))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in outputs["bpe"].collect():
        assert library.decode(list(r["ids"]), skip_special_tokens=False) == after[r["doc_id"]][0]
        assert len(r["ids"]) == r["n_tokens"]


def test_empty_tables_pass(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_texts_and_extra_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).withColumn("node", F.lit("x")).withColumn("text", F.when(F.col("doc_id") % 9 != 0, F.col("text")))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert 0 < corpus_pipeline.run(spark, str(tmp_path)).count() <= 40


def plain_first(texts):
    """Smallest id of each group of texts linked by five-word shingles, by pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    order = sorted(texts)
    for n, i in enumerate(order):
        for j in order[n + 1 :]:
            a, b = sets[i], sets[j]
            if (not a and not b) or (a and b and 10 * len(a & b) >= 8 * len(a | b)):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {root(i) for i in texts}


def plain_overlap(text, item):
    w, b = (np.array([hash(x) for x in t.encode().translate(FOLD).split()]) for t in (text or "", item or ""))
    size, allowed = tolerance(len(b), 13, 2)
    if not size or len(w) < size:
        return False
    same = (w[:, None] == b[None, :]).astype(np.int16)
    rows, columns = len(w) - size + 1, len(b) - size + 1
    return sum(same[k : k + rows, k : k + columns] for k in range(size)).max() >= size - allowed


def test_the_whole_pipeline_by_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("labels", "benchmark"))
    part = remainder("doc_id", 4)
    model = fit(document_features(docs), labels, ridge_rows=part.isin(0, 1), calibration_rows=part == 3)
    good = {r["doc_id"] for r in score_documents(docs, model).filter("score >= 0.7").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    kept = plain_first(texts)
    items = [r["text"] for r in benchmark.collect()]
    clean = {i for i in kept if not any(plain_overlap(texts[i], item) for item in items)}
    assert 0 < len(clean) < len(kept) < len(texts)
    new = {r["doc_id"]: r["text"] for r in pseudonymise(docs.filter(F.col("doc_id").isin(*clean)), key=pseudonym_key(spark)).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_padding()
    library.no_truncation()
    want = {}
    for i, text in new.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), ids, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], list(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
