"""Thin queries: each operator over its whole table, with the contract's columns."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.alignment import align_tokenizers
from spanloom.llm.bpe import encode_decode
from spanloom.llm.chat import fold_events, format_conversations, read_back, unescape
from spanloom.llm.decontaminate import find_overlaps
from spanloom.llm.language_model import score_texts
from spanloom.llm.license_scan import scan_licenses
from spanloom.llm.line_rules import line_frequency_rules
from spanloom.llm.near import near_duplicates
from spanloom.llm.pseudonyms import pseudonymise
from spanloom.llm.quality import document_features, fit, remainder, score_features
from spanloom.llm.search import search_documents
from spanloom.llm.secret_scan import scan_secrets
from spanloom.llm.stages import written
from spanloom.llm.substrings import remove_repeats
from spanloom.session import table


#: The contract's own conversation, whose texts hold control strings.
OWN_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contract's columns, all read back from the formatted text and mask."""
    for batch in batches:
        rows = []
        for conv, formatted, spans in zip(*(column.to_pylist() for column in batch.columns)):
            turns = read_back(formatted)
            trained = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
            whole = hashlib.sha256()
            for role, text in turns:
                whole.update(f"{role}\n{text}\n".encode())
            rows.append((conv, len(turns), whole.hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest(), len(formatted)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(OWN_CONVERSATION, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    # Every row is a turn of its own, also where turns are repeated. Its log is what
    # a client would have streamed: a draft, an edit (or, of an assistant, a
    # regeneration), and the text in pieces.
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    half = F.floor(F.length("text") / 2).cast("int")
    first, rest = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))
    event = lambda n, kind, text: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), text.alias("text"))
    draft = event(0, "message", F.lit("draft"))
    edited = F.array(draft, event(1, "edit", first), event(2, "delta", rest))
    drawn_again = F.array(draft, event(1, "regenerate", F.lit(None).cast("string")), event(2, "delta", first), event(3, "delta", rest))
    placed = rows.select("conv_id", place.alias("turn"), "role", "text")
    streamed = placed.select("conv_id", "turn", "role", F.explode(F.when(F.col("role") == "assistant", drawn_again).otherwise(edited)).alias("e"))
    events = streamed.select("conv_id", "turn", (F.col("turn") * 4 + F.col("e.n")).alias("seq"), F.when(F.col("e.n") == 0, F.col("role")).alias("role"), "e.kind", "e.text")
    formatted = format_conversations(fold_events(events))
    return formatted.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: Setting that names the secret key; pseudonyms link within one key. The key for
#: trial runs hides nothing, as anybody can read it here.
KEY_SETTING, TRIAL_KEY = "spark.spanloom.pseudonym.key", "trial"


def pseudonym_key(spark: SparkSession) -> str:
    """The key of the setting; a warning where it is unset."""
    key = spark.conf.get(KEY_SETTING, None)
    if key is None:
        logging.getLogger(__name__).warning("%s is not set: the pseudonyms of this run can be undone by anybody", KEY_SETTING)
    return TRIAL_KEY if key is None else key


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, key=pseudonym_key(spark))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency_rules(table(spark, sf_dir, "documents"), cleaned=False)


def op4_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = written(document_features(table(spark, sf_dir, "documents")))
    part = remainder("doc_id", 4)
    model = fit(features, table(spark, sf_dir, "labels"), ridge_rows=part.isin(0, 1), calibration_rows=part == 3)
    scored = score_features(features, model)
    return scored.select("doc_id", (part == 2).alias("held_out"), "score", "predicted")


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False))
    scored = score_texts(table(spark, sf_dir, "documents"), learn=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), outputs=("ids_sha256", "decoded_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *models, outputs=("groups_sha256",))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("found")
