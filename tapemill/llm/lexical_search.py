"""The highest-scoring documents for each item by weighted terms, by norm buckets in the manner of LEMP.

A document is a vector of impacts, one coordinate for each term that some item holds: the term's weight times its
saturated share in the document, all integers. A score is the product with the item's term counts. Vectors are ordered
by length, longest first, and searched in buckets of neighbours:

- by Cauchy and Schwarz no score in a bucket exceeds the item's length times the longest vector's; a bucket below the
  item's tenth score so far is skipped, and vectors too short for every item are not even read from the table;
- inside a bucket the item's focus coordinates, those that can add most there, are summed first. A vector goes on only if
  its sum plus a bound of the coordinates left (their largest impacts, or the lengths of both remainders) reaches the
  tenth score;
- survivors are scored over all coordinates in 64-bit integers.

The longest vectors (a share of HEAD) are searched first, by all tasks side by side, and their tenth scores start
the search of the rest. Items are taken in blocks of BLOCK_BYTES of text (or one item, if longer), whose terms and
counts are broadcast; each block goes over all documents.

Defined cases: null texts and texts without a term are no documents (they do not count in N); items without a term, or
without a document that scores above 0, have no rows. Rows without a document id count in N, L and df and are not
ranked, for want of a name. Repeated document rows are ranked each; of items that are the same in id and text one
counts, and items that share an id and differ in text are ranked each. Equal scores are ordered by id. Empty tables give
no rows. Only the named columns are read, so other names cannot clash.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapemill.llm.common import map_rows, saved

TOP = 10
HEAD = 1 / 16
BUCKET_ROWS = 4096
BUCKET_POSTINGS = 1 << 21
BLOCK_BYTES = 8 << 20
# Bounds are sums of doubles: they get this much more, so that rounding prunes nothing.
_SLACK = 1 + 1e-9

# Terms are runs of ASCII letters, digits and bytes of other characters; A-Z become a-z, the rest separates.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Items:
    """A block of items: the slot of each term, and of each item its slots, their counts and its length."""

    slot: dict[bytes, int]
    slots: list[np.ndarray]
    counts: list[np.ndarray]
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> "Items":
        slot: dict[bytes, int] = {}
        slots, counts = [], []
        for text in texts:
            held = Counter(terms_of(text))
            slots.append(np.array([slot.setdefault(term, len(slot)) for term in held], np.int64))
            counts.append(np.array(list(held.values()), np.int64))
        return cls(slot, slots, counts, np.array([math.sqrt(float(c @ c)) for c in counts]))


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list]:
    """The items in blocks, each collected by itself once its size is known."""
    rows = items.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text")
    ).distinct()
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    while blocks:
        place = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
        sizes = rows.groupBy(place).agg(F.sum(F.octet_length("text") + 16).alias("size"), F.count("*").alias("n"))
        if not sizes.where((F.col("size") > 2 * BLOCK_BYTES) & (F.col("n") > 1)).limit(1).count():
            break
        blocks *= 2
    for block in range(blocks):
        yield rows.where(place == block).orderBy("id", "text").collect()


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _counted(docs: DataFrame, items: Items, id_column: str, text_column: str) -> DataFrame:
    """Of each text with a term: the number of its terms, and the slots that it holds with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(items.slot)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        slot_of = shared.value.get
        for batch in batches:
            ids, sizes, slots, counts = [], [], [], []
            for doc, text in zip(batch["doc"], batch["text"], strict=True):
                terms = terms_of(text)
                if terms:
                    held = Counter(map(slot_of, terms))
                    held.pop(None, None)
                    ids.append(doc)
                    sizes.append(len(terms))
                    slots.append(np.fromiter(held.keys(), np.int32, len(held)))
                    counts.append(np.fromiter(held.values(), np.int32, len(held)))
            yield [ids, sizes, _lists(slots, pa.int32()), _lists(counts, pa.int32())]

    texts = docs.where(F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).cast("binary").alias("text")
    )
    return map_rows(texts, ["doc", "text"], "doc bigint, n bigint, slots array<int>, counts array<int>", rows_of)


def _weights(counted: DataFrame, n: int, terms: int) -> np.ndarray:
    """Weight of each slot; no more rows are collected than the block has terms."""
    held = np.zeros(terms, np.int64)
    for row in counted.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():
        held[row["slot"]] = row["count"]
    return np.floor(1000 * np.log((2 * n + 2) / (2 * held + 1))).astype(np.int64)


def _impacts(counted: DataFrame, n: int, total: int, weights: np.ndarray) -> DataFrame:
    """Impact vectors with their lengths, longest first; vectors without a positive impact are left out."""
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        weight = shared.value
        for batch in batches:
            ids, lengths, kept, values = [], [], [], []
            for doc, size, slots, counts in zip(*(batch[c] for c in ("doc", "n", "slots", "counts")), strict=True):
                slots, counts = np.array(slots, np.int64), np.array(counts, np.int64)
                spread = 25 + 75 * size * n // total
                impact = weight[slots] * (1_000_000_000 * counts // (1000 * counts + 8 * spread))
                some = impact > 0
                if some.any():
                    ids.append(doc)
                    kept.append(slots[some])
                    values.append(impact[some])
                    lengths.append(math.sqrt(float(np.square(values[-1].astype(float)).sum())))
            yield [ids, lengths, _lists(kept, pa.int32()), _lists(values, pa.int64())]

    made = map_rows(
        counted.where(F.col("doc").isNotNull() & (F.size("slots") > 0)),
        ["doc", "n", "slots", "counts"],
        "doc bigint, length double, slots array<int>, impacts array<bigint>",
        rows_of,
    )
    # Equal vectors, such as those of copies, are dealt by their ids.
    return made.repartitionByRange(F.desc("length"), "doc").sortWithinPartitions(F.desc("length"), "doc")


class Bucket:
    """Vectors of similar length, by row and by slot."""

    def __init__(self, docs: np.ndarray, lengths: np.ndarray, starts: np.ndarray, slots, impacts, terms: int):
        self.docs, self.lengths, self.starts, self.slots, self.impacts = docs, lengths, starts, slots, impacts
        self.longest = lengths.max()
        self.squares = np.square(lengths)
        by_slot = np.argsort(slots, kind="stable")
        self.rows = np.repeat(np.arange(len(docs)), np.diff(starts))[by_slot]
        self.posted = impacts[by_slot]
        self.first = np.searchsorted(slots[by_slot], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        np.maximum.at(self.most, slots, impacts)

    def search(self, slots: np.ndarray, counts: np.ndarray, least: int, dense: np.ndarray):
        """Rows that score `least` or more, with their scores; `dense` is scratch space of zeros by slot."""
        most = counts * self.most[slots]
        order = np.argsort(-most, kind="stable")
        order = order[most[order] > 0]
        left = most[order].sum() - np.cumsum(most[order])
        # Focus: coordinates until those left cannot reach the limit alone.
        focus = int(np.searchsorted(-left, -(least - 1))) + 1
        if not len(order) or left[0] + most[order[0]] < least:
            return self.docs[:0], self.posted[:0]
        summed, seen = np.zeros(len(self.docs), np.int64), np.zeros(len(self.docs))
        for at in order[:focus]:
            span = slice(self.first[slots[at]], self.first[slots[at] + 1])
            summed[self.rows[span]] += counts[at] * self.posted[span]
            seen[self.rows[span]] += np.square(self.posted[span].astype(float))
        rest = counts[order[focus:]].astype(float)
        beyond = math.sqrt(float(rest @ rest)) * np.sqrt(np.maximum(self.squares - seen, 0) + 1e-12 * self.squares)
        bound = summed + np.minimum(beyond, float(left[min(focus, len(left)) - 1]))
        rows = np.flatnonzero((bound * _SLACK >= least) & (summed > 0))
        if not len(rows):
            return self.docs[:0], self.posted[:0]
        dense[slots] = counts
        sizes = self.starts[rows + 1] - self.starts[rows]
        begins = np.cumsum(sizes) - sizes
        entries = np.repeat(self.starts[rows] - begins, sizes) + np.arange(sizes.sum())
        scores = np.add.reduceat(dense[self.slots[entries]] * self.impacts[entries], begins)
        dense[slots] = 0
        reached = scores >= least
        return self.docs[rows[reached]], scores[reached]


def _buckets(batches: Iterator[dict[str, list]], terms: int) -> Iterator[Bucket]:
    docs, lengths, slots, impacts, sizes = [], [], [], [], []

    def made() -> Bucket:
        starts = np.concatenate([[0], np.cumsum(sizes)])
        return Bucket(np.array(docs), np.array(lengths), starts, np.concatenate(slots), np.concatenate(impacts), terms)

    postings = 0
    for batch in batches:
        for doc, length, own, values in zip(*(batch[c] for c in ("doc", "length", "slots", "impacts")), strict=True):
            docs.append(doc)
            lengths.append(length)
            slots.append(np.array(own, np.int64))
            impacts.append(np.array(values, np.int64))
            sizes.append(len(own))
            postings += len(own)
            if len(docs) >= BUCKET_ROWS or postings >= BUCKET_POSTINGS:
                yield made()
                docs, lengths, slots, impacts, sizes = [], [], [], [], []
                postings = 0
    if docs:
        yield made()


def _searched(vectors: DataFrame, items: Items, least: np.ndarray, top: int) -> DataFrame:
    """Each task's best documents for each item, `top` at the most, none below the item's limit."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, least))

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own, limits = shared.value
        limits, dense = limits.copy(), np.zeros(len(own.slot), np.int64)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own.slots]
        for bucket in _buckets(batches, len(own.slot)):
            for item in np.flatnonzero(own.lengths * bucket.longest * _SLACK >= limits):
                docs, scores = bucket.search(own.slots[item], own.counts[item], int(limits[item]), dense)
                if len(docs):
                    docs = np.concatenate([best[item][0], docs])
                    scores = np.concatenate([best[item][1], scores])
                    kept = np.lexsort((docs, -scores))[:top]
                    best[item] = docs[kept], scores[kept]
                    if len(kept) == top:
                        limits[item] = max(limits[item], scores[kept[-1]])
        counts = [len(docs) for docs, _ in best]
        if sum(counts):
            yield [
                np.repeat(np.arange(len(best)), counts),
                np.concatenate([docs for docs, _ in best]),
                np.concatenate([scores for _, scores in best]),
            ]

    return map_rows(
        vectors, ["doc", "length", "slots", "impacts"], "item int, doc bigint, score bigint", rows_of
    )


def _best(found: DataFrame, top: int) -> DataFrame:
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)


def _ranked(docs: DataFrame, rows: list, id_column: str, text_column: str, top: int) -> DataFrame:
    """Item (place among `rows`), rank, document and score, for one block of items."""
    items = Items.of([row["text"] for row in rows])
    counted = saved(_counted(docs, items, id_column, text_column), "search-counts")
    n, total = counted.agg(F.count("*"), F.sum("n")).first()
    if not n:
        return counted.select(F.lit(0).alias("item"), F.lit(0).alias("rank"), "doc", F.col("n").alias("score")).limit(0)
    vectors = saved(_impacts(counted, n, total, _weights(counted, n, len(items.slot))), "search-vectors")
    cut = vectors.agg(F.percentile_approx("length", 1 - HEAD)).first()[0] or 0.0
    # Only scores above 0 count.
    least = np.ones(len(rows), np.int64)
    head = saved(_best(_searched(vectors.where(F.col("length") >= cut), items, least, top), top), "search-head")
    for row in head.where(F.col("rank") == top).collect():
        least[row["item"]] = row["score"]
    able = np.array(items.lengths) > 0
    shortest = float((least[able] / items.lengths[able]).min() / _SLACK) if able.any() else 0.0
    rest = vectors.where((F.col("length") < cut) & (F.col("length") >= shortest))
    return _best(head.drop("rank").union(_searched(rest, items, least, top)), top)


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` documents of each item, all if fewer score above 0."""
    spark, kind = docs.sparkSession, items.schema[item_id_column].dataType.simpleString()
    found = []
    for rows in _blocks(items, item_id_column, item_text_column):
        names = spark.createDataFrame([(i, row["id"]) for i, row in enumerate(rows)], f"item int, item_id {kind}")
        ranked = _ranked(docs, rows, id_column, text_column, top)
        found.append(
            ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")
        )
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.union, found)
