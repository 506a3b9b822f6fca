"""Quality scores from supervised subword embeddings.

A text's features are its words, the character n-grams of each word with its ends marked, and pairs of neighbouring
words, by hash; a pair of equal words is one feature whatever the word. Each feature has a vector, a text is the mean of
its features' vectors, counted with repeats, and a softmax over the labels follows. Vectors and outputs are learned by
stochastic gradient descent in numpy, one text at a time.

Learning takes a sample of the labelled rows, SAMPLE_ROWS at the most, in the order of a hash of their id. It is dealt
into SHARDS partitions; in each of EPOCHS rounds a task per shard goes once through its texts from the shared
parameters, and the driver takes the mean of the shards' parameters (a fixed number of values, SHARDS times). Fewer
rows make fewer shards, of SHARD_ROWS, and more rounds, until each shard took STEPS steps or ROUNDS are over. Scores
use the whole text and nothing else; as the output is linear in the mean, the vectors are first turned into what each
feature adds to it.

Defined cases: null and empty texts and white space have no features and get the score of the outputs' constants, near
the share of label 1; labels other than 0 and 1 are not learned from; of several labels of one id the highest
counts, of several texts of one id the smallest; without both labels among the rows to learn from, every score is the
share of label 1 (0 if there are none). Rows without an id are not held out. Repeated rows are scored each. Other
columns are ignored, so their names cannot clash.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from tapemill.llm.common import bound_batches, map_rows
from tapemill.llm.toxicity import held_out
from tapemill.llm.wordhash import P1, STEP, mix

SAMPLE_ROWS = 6_000
SHARDS = 6
SHARD_ROWS = 1_000
EPOCHS = 6
STEPS, ROUNDS = 6_000, 40
RATE = 2.0
SIZES = (3, 4, 5)
# What a shard sends back stays below a megabyte: 2**BITS vectors of WIDTH floats.
BITS = 15
WIDTH = 6
THRESHOLD = 0.5
# Characters that are worked on at once.
BLOCK = 1 << 18
# An odd number, and the number that it makes 1 with, modulo 2**64.
_BASE = int(P1)
_INVERSE = pow(_BASE, -1, 1 << 64)
# Hash of a pair of equal words.
_SAME = np.uint64(1)


def _blocks(text: str) -> Iterator[list[str]]:
    """The text's words, in groups of about BLOCK characters; a longer word is a group of its own."""
    words = text.split()
    begin = size = 0
    for i, word in enumerate(words):
        if i > begin and size + len(word) >= BLOCK:
            yield words[begin:i]
            begin, size = i, 0
        size += len(word) + 1
    if words:
        yield words[begin:]


def _powers(base: int, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    made[:1] = 1
    return np.cumprod(made, dtype=np.uint64)


_LOOKUP: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers 0 to n-1 of an odd number, modulo 2**64."""
    if base not in _LOOKUP:
        _LOOKUP[base] = _powers(base, 2 * BLOCK)
    return _LOOKUP[base][:n] if n <= 2 * BLOCK else _powers(base, n)


def _word_hashes(points: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Of each word, a polynomial over its code points, from differences of one running sum."""
    running = np.cumsum(points * _power_table(_BASE, len(points)), dtype=np.uint64)
    first, last = spaces[:-1], spaces[1:] - 1
    return (running[last] - running[first]) * _power_table(_INVERSE, len(points))[first]


def slots_of(text: str) -> Iterator[np.ndarray]:
    """Slots of all features of the text, with repeats, in arrays of bounded size."""
    before = np.zeros(0, np.uint64)
    for words in _blocks(text):
        # A space stands for the marks at a word's ends.
        marked = f" {' '.join(words)} "
        points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
        space = points == 32
        hashes = _word_hashes(points, np.flatnonzero(space))
        yield _slot(hashes)
        pairs = np.concatenate([before, hashes])
        first, second = pairs[:-1], pairs[1:]
        yield _slot(np.where(first == second, _SAME, first * STEP + second))
        before = hashes[-1:]
        for n in SIZES:
            count = len(points) - n + 1
            if count <= 0:
                continue
            code, within = np.full(count, n, np.uint64), np.ones(count, bool)
            for k in range(n):
                code = code * STEP + points[k : k + count]
                if 0 < k < n - 1:
                    within &= ~space[k : k + count]
            yield _slot(code[within])


def _slot(codes: np.ndarray) -> np.ndarray:
    return (mix(codes) >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of the text with their counts."""
    counts = np.zeros(1 << BITS, np.int64)
    for slots in slots_of(text):
        counts += np.bincount(slots, minlength=1 << BITS)
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


@dataclass
class QualityModel:
    """Vectors by slot, outputs by label (0, 1) and their constants."""

    vectors: np.ndarray
    outputs: np.ndarray
    constants: np.ndarray

    @classmethod
    def fresh(cls, share: float) -> "QualityModel":
        vectors = np.random.default_rng(0).uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH))
        constants = np.log([1 - share + 1e-9, share + 1e-9])
        return cls(vectors.astype(np.float32), np.zeros((2, WIDTH), np.float32), constants.astype(np.float32))

    def learn(self, label: int, slots: np.ndarray, counts: np.ndarray, rate: float) -> None:
        """One step of gradient descent on the log loss of one text."""
        shares = (counts / max(counts.sum(), 1)).astype(np.float32)
        rows = self.vectors[slots]
        mean = shares @ rows
        raw = self.outputs @ mean + self.constants
        error = np.exp(raw - raw.max())
        error /= error.sum()
        error[label] -= 1
        back = error @ self.outputs
        self.outputs -= rate * np.outer(error, mean)
        self.constants -= rate * error / 10
        self.vectors[slots] = rows - rate * shares[:, None] * back

    def weights(self) -> np.ndarray:
        """What each slot adds to the log odds of label 1, before the mean is taken."""
        return self.vectors.astype(np.float64) @ (self.outputs[1] - self.outputs[0]).astype(np.float64)

    def offset(self) -> float:
        return float(self.constants[1] - self.constants[0])


def score(text: str, weights: np.ndarray, offset: float) -> float:
    """Softmax of the outputs for the mean vector, for label 1."""
    total, size = 0.0, 0
    for slots in slots_of(text):
        total += float(weights[slots].sum())
        size += len(slots)
    return float(1 / (1 + np.exp(-np.clip(offset + total / max(size, 1), -500, 500))))


def _chosen(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    usable = labels.where(F.col(label_column).isin(0, 1) & ~held_out(id_column) & F.col(id_column).isNotNull())
    one = usable.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)


def _sample(docs: DataFrame, chosen: DataFrame, id_column: str, text_column: str) -> DataFrame:
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    # At most SAMPLE_ROWS ids and labels are broadcast, and one text of each id goes on.
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))


def _featured(sample: DataFrame, shards: int) -> DataFrame:
    """Shard, label and features; shard and order follow from the id alone, and a shard lies in one partition."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            own = [features(text) for text in batch["text"]]
            yield [batch["shard"], batch["label"], *([a.astype(np.int32).tobytes() for a in part] for part in zip(*own, strict=True))]

    key = F.xxhash64("id")
    dealt = sample.select("label", "text", key.alias("key"), F.pmod(key, F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "key")
    kind = "shard int, label int, slots binary, counts binary"
    return map_rows(dealt, ["shard", "label", "text"], kind, rows_of)


def _round(featured: DataFrame, model: QualityModel, begin: float, end: float, shard_rows: float) -> QualityModel:
    """Every shard learns from its rows, at a rate that falls from `begin` to `end`; the mean of what they learned."""
    shared = featured.sparkSession.sparkContext.broadcast(model)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        rows = ((batch[name][i] for name in columns) for batch in batches for i in range(len(batch["label"])))
        for shard, own_rows in groupby(map(tuple, rows), key=itemgetter(0)):
            own, seen = QualityModel(*(a.copy() for a in vars(shared.value).values())), 0
            for _, label, slots, counts in own_rows:
                rate = begin + (end - begin) * min(1.0, seen / shard_rows)
                own.learn(label, np.frombuffer(slots, np.int32), np.frombuffer(counts, np.int32), rate)
                seen += 1
            yield [[shard], [seen], *([a.tobytes()] for a in vars(own).values())]

    columns = ["shard", "label", "slots", "counts"]
    kind = "shard int, seen int, vectors binary, outputs binary, constants binary"
    learned = map_rows(featured, columns, kind, rows_of).collect()
    shared.destroy()
    learned.sort(key=itemgetter("shard"))
    mean = []
    for name, like in vars(model).items():
        total = sum(row["seen"] * np.frombuffer(row[name], np.float32).astype(np.float64) for row in learned)
        mean.append((total / sum(row["seen"] for row in learned)).reshape(like.shape).astype(np.float32))
    return QualityModel(*mean)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> QualityModel:
    chosen = _chosen(labels, id_column, label_column)
    shards = min(SHARDS, max(1, chosen.count() // SHARD_ROWS))
    featured = _featured(_sample(docs, chosen, id_column, text_column), shards).persist()
    try:
        of = {row["label"]: row["count"] for row in featured.groupBy("label").count().collect()}
        rows, good = sum(of.values()), of.get(1, 0)
        model = QualityModel.fresh(good / max(rows, 1))
        if good in (0, rows):
            return model
        rates = np.linspace(RATE, 0, max(EPOCHS, min(ROUNDS, STEPS * shards // rows)) + 1)
        for begin, end in zip(rates, rates[1:], strict=False):
            model = _round(featured, model, float(begin), float(end), rows / shards)
        return model
    finally:
        featured.unpersist()


def quality(docs: DataFrame, model: QualityModel, text_column: str = "text") -> Column:
    """Probability of label 1 for the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights(), model.offset()))

    bound_batches()

    @pandas_udf(DoubleType())
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, offset = shared.value
        for texts in batches:
            yield pd.Series([score(text or "", weights, offset) for text in texts], dtype="float64")

    return scores(F.col(text_column))
