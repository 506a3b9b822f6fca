"""Language identification with error-correcting output codes.

Each learned language has a codeword of signs. For every bit of it, a binary classifier over hashed character
n-grams tells the languages with a plus from those with a minus: its weights are log ratios of the two sides'
n-gram frequencies, its output is their mean over the text, in units of its spread. A text gets the language
whose codeword has the least weighted loss: the loss of a bit falls exponentially with agreement, and counts by
how reliable the bit is for that language on the training rows. A text whose two best codewords are close is
flagged as ambiguous.

Learning takes a sample of the labelled rows, SAMPLE_ROWS at the most, in the order of a hash of their id;
counts are summed by Spark. Predictions use the whole text and nothing else.

Defined cases: null texts and texts without a letter are `und` with score 0; rows without a label are not
learned from; rows without an id are learned from like others and not held out; with no rows to learn from,
everything is `und`; with one language, that language is predicted. Repeated rows are predicted each. Other
columns are ignored, so their names cannot clash.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tapemill.llm.common import bound_batches, map_rows
from tapemill.llm.ngrams import gram_slots

UNKNOWN = "und"
SAMPLE_ROWS = 12_000
SIZES = (1, 2, 3, 4)
BITS = 15
# Up to so many languages, all splits of them into two sides are bits; beyond, random splits.
EXHAUSTIVE = 7
# A text is ambiguous when the best language's share is below this.
SURE = 0.6


def code_matrix(n: int) -> np.ndarray:
    """Codewords of n classes as rows of +1 and -1; columns are distinct, and no column is constant."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in product((-1, 1), repeat=n - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    random, bits = np.random.default_rng(n), int(np.ceil(10 * np.log2(n)))
    while True:
        drawn = random.choice(np.array([-1, 1], np.int8), (2 * bits, n))
        # A column and its negative are one bit.
        drawn = random.permutation(np.unique(drawn * drawn[:, :1], axis=0))
        codes = drawn[np.abs(drawn.sum(axis=1)) < n][:bits].T
        if len(np.unique(codes, axis=0)) == n:
            return codes


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    reliability: np.ndarray
    sharpness: float = 1.0

    def margins(self, text: str) -> np.ndarray:
        total, count = np.zeros(self.weights.shape[1]), 0
        for slots in gram_slots(text, SIZES, BITS):
            total += self.weights.take(slots, axis=0).sum(axis=0, dtype=np.float64)
            count += len(slots)
        return total / max(count, 1) / self.scale

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Loss of each language, by row of margins."""
        agreement = np.clip(margins[:, None, :] * self.codes, -20, 20)
        return (np.exp(-agreement) * self.reliability).sum(axis=2)

    def shares(self, margins: np.ndarray) -> np.ndarray:
        losses = self.losses(margins) * self.sharpness
        shares = np.exp(losses.min(axis=1, keepdims=True) - losses)
        return shares / shares.sum(axis=1, keepdims=True)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def held_out(id_column: str = "doc_id") -> Column:
    checksum = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(checksum % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """The labelled rows with the lowest hashes; the bound is found on hashes alone."""
    usable = docs.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull() & ~held_out(id_column))
    order = F.xxhash64(id_column)
    lowest = usable.select(order.alias("order")).orderBy("order").limit(SAMPLE_ROWS + 1)
    edge = lowest.agg(F.count("*").alias("n"), F.max("order").alias("last")).first()
    if edge["n"] > SAMPLE_ROWS:
        usable = usable.where(order < edge["last"])
    return usable.select(F.col(label_column).alias("label"), F.col(text_column).alias("text"))


def _gram_counts(sample: DataFrame) -> list[Row]:
    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                own = counts.setdefault(label, np.zeros(1 << BITS, np.int64))
                for slots in gram_slots(text, SIZES, BITS):
                    own += np.bincount(slots, minlength=1 << BITS)
        for label, own in counts.items():
            slots = np.flatnonzero(own)
            yield [[label] * len(slots), slots.tolist(), own[slots].tolist()]

    partial = map_rows(sample, ["label", "text"], "label string, slot int, n bigint", rows_of)
    return partial.groupBy("label", "slot").agg(F.sum("n").alias("n")).collect()


def train(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> LanguageModel:
    # So many partitions hold the sample well; each sends a table of bounded size to the sum.
    sample = _sample(docs, id_column, text_column, label_column).repartition(12)
    rows = _gram_counts(sample)
    languages = sorted({row["label"] for row in rows})
    place = {language: i for i, language in enumerate(languages)}
    counts = np.zeros((len(languages), 1 << BITS))
    for row in rows:
        counts[place[row["label"]], row["slot"]] = row["n"]
    codes = code_matrix(len(languages))
    # Each language counts alike on its side, however many rows it has.
    rates = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    plus = (codes > 0).astype(float)
    sides = [(side.T @ rates) / side.sum(axis=0)[:, None] for side in (plus, 1 - plus)] if codes.size else [[], []]
    weights = np.log(sides[0] / sides[1]).T.astype(np.float32) if codes.size else np.zeros((1 << BITS, 0), np.float32)
    bits = codes.shape[1]
    model = LanguageModel(languages, codes, weights, np.ones(bits), np.ones(codes.shape))
    return _calibrated(model, sample) if bits else model


def _calibrated(model: LanguageModel, sample: DataFrame) -> LanguageModel:
    """Spread of the margins, reliability of the bits and sharpness of the shares, from the sample's margins."""
    bits = model.codes.shape[1]

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            yield [batch["label"], [model.margins(text).tolist() for text in batch["text"]]]

    found = map_rows(sample, ["label", "text"], "label string, margins array<double>", rows_of).collect()
    truth = np.array([model.languages.index(row["label"]) for row in found])
    raw = np.array([row["margins"] for row in found]).reshape(len(found), bits)
    model.scale = np.maximum(np.abs(raw).mean(axis=0), 1e-9)
    margins = raw / model.scale
    right = (margins * model.codes[truth] > 0).astype(float)
    for i in range(len(model.languages)):
        model.reliability[i] = right[truth == i].mean(axis=0) + 1e-3
    model.reliability /= model.reliability.sum(axis=1, keepdims=True)
    losses = model.losses(margins)
    best = None
    for sharpness in 2.0 ** np.arange(-2, 8):
        scores = -sharpness * losses
        scores -= scores.max(axis=1, keepdims=True)
        likelihood = (scores[np.arange(len(truth)), truth] - np.log(np.exp(scores).sum(axis=1))).mean()
        if best is None or likelihood > best:
            best, model.sharpness = likelihood, float(sharpness)
    return model


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> Column:
    """Struct column: lang_pred, score (share of the best language, 0 to 1) and ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    bound_batches()

    @pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            languages, scores, ambiguous = [], [], []
            for text in texts:
                if not own.languages or text is None or not has_letter(text):
                    found = (UNKNOWN, 0.0, True)
                elif len(own.languages) == 1:
                    found = (own.languages[0], 1.0, False)
                else:
                    shares = own.shares(own.margins(text)[None])[0]
                    i = int(shares.argmax())
                    found = (own.languages[i], float(shares[i]), bool(shares[i] < SURE))
                for column, value in zip((languages, scores, ambiguous), found, strict=True):
                    column.append(value)
            yield pd.DataFrame({"lang_pred": languages, "score": scores, "ambiguous": ambiguous})

    return predict(F.col(text_column))
