"""Declared schemas of the manifests; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

from spanloom.functions.text import SOURCE_FIELDS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


WINDOW = T.StructType([T.StructField("chrom", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
REGION = T.StructType([*WINDOW.fields, T.StructField("bad_bp", T.LongType()), T.StructField("bad_fraction", T.DoubleType())])
PREPROCESSING = T.StructType([T.StructField("scale", T.DoubleType()), T.StructField("sum_stat", T.StringType()), T.StructField("clip_soft", T.DoubleType()), T.StructField("clip", T.DoubleType())])
TRACK = T.StructType([*_strings("id", "dataset", "assay", "provider", "strand", "strand_pair", "description"), T.StructField("source", T.StructType(_strings(*SOURCE_FIELDS))), T.StructField("preprocessing", PREPROCESSING)])
SHARD = T.StructType([*_strings("shard_id", "split"), T.StructField("num_windows", T.IntegerType()), T.StructField("windows", T.ArrayType(WINDOW))])
TARGET_MANIFEST = T.StructType([*_strings("index", "identifier", "file", "clip", "clip_soft", "scale", "sum_stat", "strand_pair", "description")])
SIGNAL = T.StructType([T.StructField("track_id", T.StringType()), *WINDOW.fields, T.StructField("value", T.FloatType())])
STATUS = T.StructType([T.StructField("original_index", T.LongType()), *_strings("split", "shard_id", "status")])
FAILURE = T.StructType(_strings("track_id", "provider", "error"))
COMMIT = T.StructType([T.StructField("shard_id", T.StringType()), T.StructField("batch_index", T.IntegerType())])
