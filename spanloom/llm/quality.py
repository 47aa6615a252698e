"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Statistics of a whole text are mapped to cosines whose inner products
approximate a Gaussian kernel. Every partition sums its part of the normal
equations; the sums are of fixed size, so the driver solves one small system
however large the training set. Scores are calibrated by isotonic regression on
rows that the ridge did not see, over a fixed number of score bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.arrays import text_slices
from spanloom.llm.stages import written

#: Random features, kernel width (in standard deviations), ridge weight.
COMPONENTS, WIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 7
#: Score bins of the calibration, over ridge scores from -1 to 2.
BINS, LOW, HIGH = 3000, -1.0, 2.0

#: Groups of bytes whose shares are statistics.
GROUPS = (b"#*$%&|<>", b"!", b"?", b".", b",", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"|", b"\n", bytes(range(128, 256)), b"@_=/\\{}[]()+~^`\"'")
CLASS = np.zeros((256, len(GROUPS)))
for _g, _members in enumerate(GROUPS):
    CLASS[list(_members), _g] = 1
NAMES = ("log_words", "log_bytes", "word_bytes", "distinct_for_length", "distinct_pairs", "distinct_words", "duplicate_lines", "long_words", "short_words", *[f"share_{g}" for g in range(len(GROUPS))])


def statistics(raw: bytes) -> np.ndarray:
    """Statistics of one whole text; an empty text has zeros."""
    words = raw.split()
    n = len(words)
    out = np.zeros(len(NAMES))
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASS / max(len(raw), 1)
    out[9:] = np.sqrt(shares)
    if n:
        sizes = np.fromiter(map(len, words), np.int64, n)
        distinct = set(words)
        pairs = len(set(zip(words, words[1:])))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out[:9] = (
            np.log1p(n), np.log1p(len(raw)), sizes.mean(), len(distinct) / n**0.9, 1 - (n - 1 - pairs) / max(n - 1, 1),
            len(distinct) / n, 1 - len(set(lines)) / max(len(lines), 1), (sizes > 14).mean(), (sizes < 3).mean(),
        )
    return out


def _batch_statistics(batch: pa.RecordBatch, text: str) -> np.ndarray:
    return np.array([statistics(raw) for _, texts in text_slices(batch, text) for raw in texts]).reshape(-1, len(NAMES))


def document_features(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features array<double>) per row; null and empty texts have zeros,
    repeated rows and null ids their own rows, an empty table none."""
    kind = docs.select(id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(_batch_statistics(batch, "text")), pa.list_(pa.float64()))], names=["doc_id", "features"])

    return docs.selectExpr(f"`{id}` as doc_id", f"cast(`{text}` as binary) as text").mapInArrow(run, f"doc_id {kind}, features array<double>")


@dataclass
class QualityModel:
    """Arrays of fixed size; ``weights`` None: no usable label, every score 0.5."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: tuple[np.ndarray, np.ndarray] | None
    components: int = COMPONENTS

    def mapped(self, features: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        spread = rng.normal(0, 1 / WIDTH, (len(self.mean), self.components))
        phase = rng.uniform(0, 2 * np.pi, self.components)
        z = np.clip((features - self.mean) / self.scale, -8, 8)
        return np.hstack((np.sqrt(2 / self.components) * np.cos(z @ spread + phase), np.ones((len(z), 1))))

    def raw(self, features: np.ndarray) -> np.ndarray:
        return self.mapped(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), 0.5)
        raw = np.clip(self.raw(features), LOW, HIGH)
        return np.clip(raw, 0, 1) if self.knots is None else np.clip(np.interp(raw, *self.knots), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators; block centres and values, joined by lines later."""
    blocks: list[list[float]] = []
    for at, value, w in zip(x, y, weight):
        blocks.append([at * w, value * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    centres, values = np.array([b[0] / b[2] for b in blocks]), np.array([(b[1] + 0.5 * 1e-3) / (b[2] + 1e-3) for b in blocks])
    return np.concatenate(([LOW - 1e-9], centres, [HIGH + 1e-9])), np.concatenate(([values[0] * 0.5], values, [(values[-1] + 1) / 2]))


def fit(features: DataFrame, labels: DataFrame, *, id: str = "doc_id", label: str = "quality", ridge_rows: Column, calibration_rows: Column, components: int = COMPONENTS) -> QualityModel:
    """Fit on the labelled rows; ``ridge_rows`` and ``calibration_rows`` are
    conditions on ``doc_id`` that choose the rows of each part. Rows without a
    label or with a null one are left out; all others count, repeated ones again.
    """
    named = labels.select(F.col(id).alias("doc_id"), F.col(label).cast("double").alias("label")).filter(F.col("label").isNotNull())
    rows = written(features.join(named, "doc_id").select("features", "label", F.coalesce(ridge_rows, F.lit(False)).alias("ridge"), F.coalesce(calibration_rows, F.lit(False)).alias("calibrate")))
    training = rows.filter("ridge")
    width = len(NAMES)
    sums = training.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate"), *[F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(width)], *[F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(width)]).first()
    if not sums["n"] or sums["rate"] in (0.0, 1.0):
        return QualityModel(np.zeros(width), np.ones(width), None, None, components)
    mean = np.array([sums[f"m{i}"] for i in range(width)])
    scale = np.array([sums[f"s{i}"] if sums[f"s{i}"] > 1e-9 else 1.0 for i in range(width)])
    model = QualityModel(mean, scale, None, None, components)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components + 1, components + 2))
        for batch in batches:
            if batch.num_rows:
                x = model.mapped(np.array(batch.column(0).to_pylist()))
                total[:, :-1] += x.T @ x
                total[:, -1] += x.T @ np.asarray(batch.column(1))
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(total), pa.int64()), pa.array(range(len(total)), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], names=["part", "line", "terms"])

    def summed(table: pa.Table) -> pa.Table:
        terms = np.sum([np.asarray(x.as_py()) for x in table.column("terms")], axis=0)
        return pa.table({"part": pa.array([0], pa.int64()), "line": table.column("line").slice(0, 1), "terms": pa.array([terms], pa.list_(pa.float64()))})

    schema = "part long, line long, terms array<double>"
    partial = training.select("features", "label").mapInArrow(equations, schema)
    lines = partial.groupBy("part", "line").applyInArrow(summed, schema).groupBy("line").applyInArrow(summed, schema)
    system = np.array([r["terms"] for r in sorted(lines.collect(), key=lambda r: r["line"])])
    model.weights = np.linalg.solve(system[:, :-1] + RIDGE * sums["n"] / components * np.eye(components + 1), system[:, -1])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(np.array(batch.column(0).to_pylist()).reshape(-1, width)), LOW, HIGH)
            yield pa.RecordBatch.from_arrays([pa.array(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int64)), batch.column(1)], names=["bin", "label"])

    counts = rows.filter("calibrate").select("features", "label").mapInArrow(binned, "bin long, label double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).collect()
    if counts:
        counts.sort(key=lambda r: r["bin"])
        model.knots = isotonic(np.array([LOW + (r["bin"] + 0.5) * (HIGH - LOW) / BINS for r in counts]), np.array([r["rate"] for r in counts]), np.array([float(r["n"]) for r in counts]))
    return model


def score_documents(docs: DataFrame, model: QualityModel, *, id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row; null texts count as empty ones,
    repeated rows repeat, further columns are ignored."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.score(_batch_statistics(batch, "text")))], names=["doc_id", "score"])

    rows = docs.selectExpr(f"`{id}` as doc_id", f"cast(`{text}` as binary) as text").mapInArrow(run, f"doc_id {kind}, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score_features(features: DataFrame, model: QualityModel, *, threshold: float = 0.7) -> DataFrame:
    """``score_documents`` of rows of ``document_features``, whose texts are not
    read again."""
    held = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(1).flatten()).reshape(batch.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.score(rows))], names=["doc_id", "score"])

    kind = features.schema["doc_id"].dataType.simpleString()
    scored = features.select("doc_id", "features").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` (all columns) that score ``threshold`` or more; a null
    text scores as an empty one, and a model without labels scores 0.5."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.score(_batch_statistics(batch, text)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def remainder(id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % modulus
