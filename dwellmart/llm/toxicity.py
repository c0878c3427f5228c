"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, pairs of neighbours and pairs with one word between, each hashed into
one table and counted as present or not. FTRL-proximal learns with a rate of its own for every feature,
and its L1 term keeps features at exactly zero until they have earned a weight, so the model is a short
list of (feature, weight).

Training takes a bounded sample of labelled texts (``MOST_TEXTS``), chosen by a hash of their id, whose
features are made in parallel, one text for each id however many rows it has; the updates themselves run one after another in one task, as the method
wants. The weights, at most ``2^BITS`` and usually some hundreds, are broadcast with the scoring function.
Scoring takes whole texts, without a shuffle.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.llm.stored import fold, stored, temporary, text_bytes

BITS = 20
MOST_TEXTS = 12_000
#: Different hash values of ids that the sample of labels is taken from.
HASHES = 1 << 62
PASSES = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 20.0, 0.01
#: A toxic example counts so many times, since about one in ten is toxic.
TOXIC_WEIGHT = 3
#: A text is called toxic from this score on.
TOXIC_FROM = 0.7
#: Everything but letters, digits and bytes of other scripts parts words; A-Z become a-z.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
#: Words whose features are made at a time.
_CHUNK = 1 << 16


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """The distinct features of a text, ascending. A text without words has none."""
    words = text.translate(_WORD_BYTES).split()
    shift = np.uint64(64 - bits)
    found = [np.zeros(0, np.int32)]
    for start in range(0, len(words), _CHUNK):
        part = words[start : start + _CHUNK + 2]
        own = np.fromiter(map(zlib.crc32, part), np.uint64, len(part)) + np.uint64(1)
        mixed = own * _MIX[0]
        pairs = (mixed[:-1] ^ (own[1:] * _MIX[1])) * _MIX[2]
        skips = (mixed[:-2] ^ (own[2:] * _MIX[2])) * _MIX[1]
        last = min(len(part), _CHUNK)
        grams = np.concatenate([(mixed * _MIX[1])[:last], pairs[:last], skips[:last]]) >> shift
        found.append(np.unique(grams.astype(np.int32)))
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """Sparse weights of a fitted model; without any, every text scores as the bias says."""

    bias: float = 0.0
    index: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bits: int = BITS

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits)
        table[self.index] = self.weight
        return table

    def score(self, text: bytes, dense: np.ndarray) -> float:
        total = self.bias + dense[features(text, self.bits)].sum()
        return float(1 / (1 + np.exp(-min(max(total, -35.0), 35.0))))


class Ftrl:
    """FTRL-proximal for logistic loss; the bias is the last coordinate and has no L1 term."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.l1 = np.full((1 << bits) + 1, L1)
        self.l1[-1] = 0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        over = np.sign(z) * np.maximum(np.abs(z) - self.l1[at], 0)
        return -over / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, toxic: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-min(max(w.sum(), -35.0), 35.0))) - toxic
        gradient *= TOXIC_WEIGHT if toxic else 1
        n = self.n[at]
        step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - step * w
        self.n[at] += gradient**2


_EXAMPLES = "place long, toxic int, grams array<int>"
_WEIGHTS = "feature int, weight double"


def _examples(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [features(text, bits) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("toxic"), pa.array(grams, pa.list_(pa.int32()))],
            names=["place", "toxic", "grams"],
        )


def _train(batches: Iterator[pa.RecordBatch], bits: int, passes: int) -> Iterator[pa.RecordBatch]:
    examples = []
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        examples += zip((g.values.to_numpy() for g in batch.column("grams")), toxic, strict=True)
    model = Ftrl(bits)
    for _ in range(passes):
        for grams, toxic in examples:
            model.learn(grams, toxic)
    weights = model.weights(np.arange(len(model.z)))
    at = np.union1d(np.flatnonzero(weights), [len(weights) - 1])
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(weights[at])], names=["feature", "weight"])


def hashes_taken(labels: int, most: int) -> int:
    """How many of ``HASHES`` hash values to take of so many labels to get about ``most`` of them."""
    return HASHES if labels <= most else HASHES * most // labels


def training_rows(labels: DataFrame, folds: int = 3, held_out: int = 1, most: int = MOST_TEXTS) -> DataFrame:
    """(label_id, toxic, place): at most about ``most`` labelled ids outside the held-out fold.

    Labels that are NULL or without id are left out; of several labels of one id toxic wins. The sample
    is by a hash of the id, at the rate that gives ``most`` rows.
    """
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)
    )
    known = stored(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    place = F.xxhash64(F.col("doc_id").cast("string"))
    return known.where(F.pmod(place, F.lit(HASHES)) < hashes_taken(known.count(), most)).select(
        F.col("doc_id").alias("label_id"), "toxic", place.alias("place")
    )


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, passes: int = PASSES, most: int = MOST_TEXTS) -> Model:
    """Learn from the texts of ``docs`` whose ids have labels in the training folds.

    An id is one example: of several different texts of one id, that with the least hash is learnt from.
    """
    with temporary(docs.sparkSession):
        chosen = training_rows(labels, most=most)
        # The labels side has at most about `most` rows of 16 bytes.
        texts = docs.select("doc_id", text_bytes(F.col("text")).alias("text")).join(
            F.broadcast(chosen), F.col("doc_id") == F.col("label_id")
        )
        # Combined before the shuffle, so the copies of one id are one row of each task.
        first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
        texts = texts.groupBy("label_id", "toxic", "place").agg(first)
        examples = texts.select("text", "toxic", "place").mapInArrow(partial(_examples, bits=bits), _EXAMPLES)
        rows = examples.repartition(1).sortWithinPartitions("place", "toxic").mapInArrow(
            partial(_train, bits=bits, passes=passes), _WEIGHTS
        )
        found = stored(rows, "weights").toArrow().sort_by("feature")
    feature, weight = found["feature"].to_numpy(), found["weight"].to_numpy()
    last = 1 << bits
    return Model(
        float(weight[feature == last].sum()), feature[feature < last], weight[feature < last], bits
    )


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic. NULL counts as empty, and empty texts score as the bias says."""

    @F.arrow_udf("double")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = model.dense()
        for texts in parts:
            yield pa.array([model.score(t, dense) for t in texts.to_pylist()], pa.float64())

    return of(text_bytes(text))


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Documents -> (doc_id, held_out, score, predicted), one row per row, repeated rows too.

    Without usable labels every score is a half, so nothing is called toxic. An empty table gives no rows. Only
    doc_id and text are read, and only text for the score.
    """
    model = fit(docs, labels, **options)
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), score(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that score below ``TOXIC_FROM``, with all their columns."""
    model = fit(docs, labels, **options)
    return docs.where(score(F.col("text"), model) < TOXIC_FROM)
