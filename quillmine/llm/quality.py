"""Quality classifier by compression: zstandard dictionaries of good and bad text, and a calibrated score.

Plan. A bounded sample of labelled documents trains two dictionaries and, on documents that the dictionaries have not seen, a
logistic calibration. Scoring is one pass without a shuffle: a text is cut into short pieces, each compressed with
either dictionary. The score's inputs are the normalised difference of the compressed sizes and the smaller size as a
share of the text, which tells text that repeats itself (either dictionary then serves equally well).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import appended, carried, table, texts

PIECE = 512  # bytes; a dictionary tells most about the first few hundred
LEVEL = 3
DICTIONARY_BYTES = 110 << 10
SAMPLE_DOCUMENTS = 2000  # of either label, at most
SAMPLE_BYTES = 24 << 20  # of either label, at most; whole texts
LONGEST = 8  # a text of over this part of the bytes counts as very long
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def cut(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def dictionary(sample: list[bytes]) -> bytes:
    """The content of a dictionary; of a sample too small to train one, the sample's own end."""
    pieces = [p for t in sample for p in cut(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # intercept, difference, share

    def scorer(self):
        """A function from a text to its score."""
        measure = Measure(self.good, self.bad)
        w = self.weights

        def score(text: bytes) -> float:
            d, share = measure(text)
            z = min(max(w[0] + w[1] * d + w[2] * share, -60.0), 60.0)
            return float(1 / (1 + np.exp(-z)))

        return score


class Measure:
    """Inputs of the score: (bad - good) / larger of the compressed sizes, and the smaller size by the text's size; an empty text: 0, 0."""

    def __init__(self, good: bytes, bad: bytes):
        self.compress = []
        for content in (good, bad):
            held = zstandard.ZstdCompressionDict(content or b"\x00" * 8)
            held.precompute_compress(level=LEVEL)
            self.compress.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False).compress)

    def __call__(self, text: bytes) -> tuple[float, float]:
        if not text:
            return 0.0, 0.0
        pieces = cut(text)
        good, bad = (sum(map(len, map(c, pieces))) for c in self.compress)
        return (bad - good) / max(bad, good), min(bad, good) / len(text)


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic regression, by Newton steps with a small ridge."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        curve = weight * p * (1 - p) + 1e-9
        w += np.linalg.solve((a.T * curve) @ a + 1e-2 * np.eye(len(w)), a.T @ (weight * (y - p)) - 1e-2 * w)
    slope = w[1:] / scale
    return float(w[0] - slope @ mean), *map(float, slope)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int, max_bytes: int) -> DataFrame:
    """(quality, text, at): whole texts of labelled documents, none held out, in a seeded order.

    Of either label ``most`` documents at most, and as many of them as ``max_bytes`` hold; texts of over ``max_bytes`` / LONGEST come
    last, shorter ones first, so that a very long text takes no other's place.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"))
    known = known.distinct().withColumn("_at", F.xxhash64(F.lit(5), "_id"))
    ids = reduce(DataFrame.unionByName, (known.where(F.col("quality") == q).orderBy("_at", "_id").limit(most) for q in (0, 1)))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text != ''")
    long = F.greatest(F.octet_length("text"), F.lit(max_bytes // LONGEST))
    held = F.sum(F.octet_length("text")).over(W.partitionBy("quality").orderBy(long, "_at", "_id", "text"))
    rows = rows.join(F.broadcast(ids), "_id").withColumn("_held", held)  # twice ``most`` ids bound the broadcast, and the windows
    return rows.where(F.col("_held") <= max_bytes).select("quality", "text", F.struct("_at", "_id", "text").alias("at"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCUMENTS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Half of each sample trains a dictionary, the other half the calibration, weighted to the labels' true shares.

    One task trains on the sample, whose size is bounded; the driver gets the model alone. The only document of a label does both. Where a
    label has no document with a text, nothing tells the labels apart, and all texts get the share of label 1 among the labels (0.5
    without labels). Labels that are null or neither 0 nor 1, and those without id, are not learned from.
    """
    shares = {q: n for q, n in labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("quality").count().collect()}  # two rows
    total = sum(shares.values())

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for q, text in zip(batch.column(0).to_pylist(), texts(batch, "text"), strict=True):
                found[q].append(text)
        if not all(found.values()):
            return
        good, bad = (dictionary(found[q][::2]) for q in (1, 0))
        measure = Measure(good, bad)
        x = {q: np.array([measure(t) for t in found[q][1::2] or found[q]]) for q in (1, 0)}
        y = np.r_[np.ones(len(x[1])), np.zeros(len(x[0]))]
        weight = np.r_[np.full(len(x[1]), shares[1] / total / len(x[1])), np.full(len(x[0]), shares[0] / total / len(x[0]))] * len(y)
        weights = calibrate(np.r_[x[1], x[0]], y, weight)
        yield pa.RecordBatch.from_arrays([pa.array([good], pa.binary()), pa.array([bad], pa.binary()), pa.array([weights], pa.list_(pa.float64()))], names=["good", "bad", "weights"])

    rows = sample(docs, labels, id_col, text_col, most, max_bytes).repartition(1).sortWithinPartitions("quality", "at").drop("at")
    model = rows.mapInArrow(train, "good binary, bad binary, weights array<double>").first()
    if model is None:
        p = min(max(shares.get(1, 0) / total if total else 0.5, 1e-6), 1 - 1e-6)
        return Model(b"", b"", (float(np.log(p / (1 - p))), 0.0, 0.0))
    return Model(bytes(model["good"]), bytes(model["bad"]), tuple(model["weights"]))


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and ``carry`` as the struct carried.

    Null counts as empty; an empty text gets the score of inputs 0, 0. Scores depend on the text alone, whole however long: equal texts
    have equal scores, and rows are judged one by one, repeated ones alike. A null id is not held out. An empty table gives no rows. Columns
    of ``docs`` that have names of the result are read only as members of ``carried``.
    """

    def make():
        score = model.scorer()

        def work(found: list[bytes | None]) -> list[pa.Array]:
            return [pa.array([score(t or b"") for t in found], pa.float64())]

        return work

    out = appended(docs, text_col, carried(id_col, carry), "score double", make)
    more = ["carried"] if carry else []
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *more)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit(docs, table(spark, sf_dir, "labels")))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good, all columns as they were.

    Null and empty texts have the score of inputs 0, 0 and stay or go together; repeated rows share their fate. An empty table stays empty.
    """
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, carry=docs.columns).where("predicted = 1").select("carried.*")
