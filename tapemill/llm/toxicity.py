"""Toxicity scores from a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram in a text. Its log-count ratio compares the share of toxic rows
that have it with the share of other rows. The features whose ratio stands out most are kept, each valued at its
ratio, and a regularised logistic regression is fitted to them. The score is its probability.

Learning takes a sample of the labelled rows, SAMPLE_ROWS at the most, in the order of a hash of their id.
Counting and featurising run as Spark jobs; the driver sees FEATURES counts and the sample's kept features.
Scores use the whole text and nothing else.

Defined cases: null and empty texts get the score of a text without any feature; labels other than 0 and 1 are
not learned from; of several labels of one id the highest counts; without both labels among the rows to learn
from, every score is the share of label 1 (0 if there are none). Rows without an id are not held out. Repeated
rows are scored each. Other columns are ignored, so their names cannot clash.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tapemill.llm.common import bound_batches, map_rows
from tapemill.llm.ngrams import gram_slots

SAMPLE_ROWS = 20_000
SIZES = (3, 4, 5)
BITS = 18
FEATURES = 4096
# A feature must occur in so many sampled rows, with a log ratio of so many standard deviations.
LEAST_ROWS = 3
LEAST_STRENGTH = 4.0
THRESHOLD = 0.7
_RIDGE = 1e-3
# Steps of the fit, which ends where no slope exceeds the limit.
_STEPS, _FLAT = 400, 2e-5


@dataclass
class ToxicityModel:
    """`place` has the feature of each slot, or -1; `weights` are ratio times coefficient, by feature."""

    bias: float
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    place: np.ndarray = field(default_factory=lambda: np.full(1 << BITS, -1, np.int16))

    def features(self, text: str) -> np.ndarray:
        found = []
        for slots in gram_slots(text, SIZES, BITS):
            places = self.place.take(slots)
            found.append(places[places >= 0])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int16)

    def score(self, text: str) -> float:
        return float(_sigmoid(self.bias + self.weights[self.features(text)].sum()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def held_out(id_column: str = "doc_id") -> Column:
    checksum = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(checksum % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str) -> DataFrame:
    usable = labels.where(F.col(label_column).isin(0, 1) & ~held_out(id_column))
    one = usable.groupBy(id_column).agg(F.max(label_column).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64(id_column), id_column).limit(SAMPLE_ROWS)
    # At most SAMPLE_ROWS ids and labels are broadcast.
    texts = docs.select(id_column, F.coalesce(text_column, F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), id_column).select("label", "text").repartition(12)


def _class_counts(sample: DataFrame) -> DataFrame:
    """In how many rows of either label each slot occurs; slot -1 has the rows themselves."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        counts, rows = np.zeros((2, 1 << BITS), np.int64), [0, 0]
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                rows[label] += 1
                own = list(gram_slots(text, SIZES, BITS))
                if own:
                    counts[label][np.unique(np.concatenate(own))] += 1
        slots = np.flatnonzero(counts.any(axis=0))
        yield [[-1, *slots.tolist()], [rows[0], *counts[0][slots].tolist()], [rows[1], *counts[1][slots].tolist()]]

    partial = map_rows(sample, ["label", "text"], "slot int, clean bigint, toxic bigint", rows_of)
    return partial.groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    sample = _sample(docs, labels, id_column, text_column, label_column).persist()
    try:
        return _fitted(sample)
    finally:
        sample.unpersist()


def _fitted(sample: DataFrame) -> ToxicityModel:
    rows = sample.groupBy("label").count().collect()
    of = {row["label"]: row["count"] for row in rows}
    clean, toxic = of.get(0, 0), of.get(1, 0)
    if not clean or not toxic:
        share = toxic / max(clean + toxic, 1)
        return ToxicityModel(bias=float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    # Log ratio of the smoothed shares, and its size in standard deviations.
    p, q = (F.col("toxic") + 1) / F.lit(toxic + 2), (F.col("clean") + 1) / F.lit(clean + 2)
    ratio = F.log(p / q)
    spread = F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    kept = (
        _class_counts(sample)
        .where((F.col("slot") >= 0) & (F.col("clean") + F.col("toxic") >= LEAST_ROWS))
        .select("slot", ratio.alias("ratio"), F.abs(ratio / spread).alias("strength"))
        .where(F.col("strength") >= LEAST_STRENGTH)
        .orderBy(F.desc("strength"), "slot")
        .limit(FEATURES)
        .collect()
    )
    model = ToxicityModel(bias=0.0, weights=np.zeros(len(kept)))
    model.place[[row["slot"] for row in kept]] = np.arange(len(kept))
    ratios = np.array([row["ratio"] for row in kept])

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            yield [batch["label"], [model.features(text).tobytes() for text in batch["text"]]]

    found = map_rows(sample, ["label", "text"], "label int, features binary", rows_of).collect()
    model.bias, coefficients = _logistic(
        [np.frombuffer(row["features"], np.int16) for row in found], np.array([row["label"] for row in found]), ratios
    )
    model.weights = coefficients * ratios
    return model


def _logistic(features: list[np.ndarray], labels: np.ndarray, values: np.ndarray) -> tuple[float, np.ndarray]:
    """Ridge-regularised logistic regression on sparse rows, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    column = np.concatenate(features) if features else np.zeros(0, np.int64)
    entry = values[column]
    n, width = len(labels), len(values)
    # Steps follow from the largest curvature, which power iteration finds.
    direction, curvature = np.ones(width + 1), 1.0
    for _ in range(20):
        direction = direction / np.linalg.norm(direction)
        along = np.bincount(row, entry * direction[column], n) + direction[-1]
        direction = np.append(np.bincount(column, entry * along[row], width), along.sum()) / n
        curvature = np.linalg.norm(direction)
    step = 4 / (1.2 * curvature + 4 * _RIDGE)
    bias = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    point = ahead = np.append(np.zeros(width), bias)
    for t in range(_STEPS):
        error = _sigmoid(np.bincount(row, entry * ahead[column], n) + ahead[-1]) - labels
        slope = np.append(np.bincount(column, entry * error[row], width) / n + _RIDGE * ahead[:-1], error.mean())
        if np.abs(slope).max() < _FLAT:
            break
        moved = ahead - step * slope
        ahead = moved + t / (t + 3) * (moved - point)
        point = moved
    return float(point[-1]), point[:-1]


def toxicity(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> Column:
    """Score of the whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    bound_batches()

    @pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series([own.score(text or "") for text in texts], dtype="float64")

    return score(F.col(text_column))
