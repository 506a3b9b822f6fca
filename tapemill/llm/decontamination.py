"""Benchmark passages in training texts, also edited ones: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of word characters. For the n-grams of all test items, Spark counts in how many
texts each occurs. Of every SPACING consecutive n-grams of an item, the rarest is a seed, so every stretch of an
item keeps a seed, however often the item was copied into the corpus. Where LEAST_SEEDS seeds of an item (or its
only one) lie on nearby diagonals of a text, the item is aligned with that stretch; the score is the best local
alignment over that of the item with itself. From FLAGGED on, the text is contaminated; so it is, whatever the
score, if the alignment is worth EXCERPT equal words, as an excerpt of a long item is.

The items are collected in parts of PART_WORDS words at the most; each part is a table of bounded size that all
tasks get, and a larger benchmark takes more such columns, not a larger table.

Defined cases: null and empty texts have no matches; items that are null or shorter than an n-gram match
nothing; several items with one text match each; repeated rows are matched each; an empty benchmark gives no
matches. Other columns are ignored, so their names cannot clash. Texts of any length are searched whole.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tapemill.llm.common import bound_batches, map_rows

N = 3
SPACING = 2
LEAST_SEEDS = 2
FLAGGED = 0.4
EXCERPT = 13
PART_WORDS = 2_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
_BITS = 21
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Items:
    """A part of the benchmark: word numbers of its items (from 1; 0 is any other word) and its n-grams, sorted."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    # Of each n-gram that is a seed, its places as (item, position).
    places: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    # How many seeds of each item must lie together.
    least: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, rows: list[tuple]) -> "Items":
        vocabulary: dict[str, int] = {}
        words = [
            np.array([vocabulary.setdefault(word, len(vocabulary) + 1) for word in words_of(text)], np.int64)
            for _, text in rows
        ]
        made = cls([i for i, _ in rows], words, vocabulary)
        made.codes = np.unique(np.concatenate([ngrams(own) for own in words] or [made.codes]))
        return made

    def numbers(self, text: str) -> np.ndarray:
        found = words_of(text)
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of a text's words where an n-gram of the benchmark begins, and which."""
        codes = ngrams(numbers)
        known = numbers > 0
        at = np.flatnonzero(reduce(np.logical_and, [known[k : len(known) - N + 1 + k] for k in range(N)]))
        if not len(at) or not len(self.codes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.searchsorted(self.codes, codes[at])
        place[place == len(self.codes)] = 0
        right = self.codes[place] == codes[at]
        return at[right], place[right]

    def seed(self, frequency: np.ndarray) -> None:
        """Keep the places of the rarest n-gram of every SPACING consecutive ones; ties go to the lower code."""
        self.places, self.least = {}, [LEAST_SEEDS] * len(self.words)
        for item, own in enumerate(self.words):
            slots = np.searchsorted(self.codes, ngrams(own))
            if not len(slots):
                continue
            cost = frequency[slots]
            chosen = {
                start + min(range(len(cost[start : start + SPACING])), key=lambda k: (cost[start + k], slots[start + k]))
                for start in range(max(1, len(slots) - SPACING + 1))
            }
            self.least[item] = min(LEAST_SEEDS, len(chosen))
            for position in chosen:
                self.places.setdefault(int(slots[position]), []).append((item, position))

    def matches(self, text: str) -> list[tuple]:
        """(item id, score, first word, word after the last) of each item that the text has, best stretch each."""
        numbers = self.numbers(text)
        at, slots = self.hits(numbers)
        diagonals: dict[int, list[int]] = {}
        for position, slot in zip(at.tolist(), slots.tolist(), strict=True):
            for item, start in self.places.get(slot, ()):
                diagonals.setdefault(item, []).append(position - start)
        found = []
        for item, starts in sorted(diagonals.items()):
            own = self.words[item]
            best = (0.0, 0, 0)
            for low, high in _stretches(sorted(starts), len(own) // 2 + N, self.least[item]):
                first = max(0, low - len(own) // 4 - N)
                window = numbers[first : high + len(own) + len(own) // 4 + N]
                score, begin, end = align(own, window)
                best = max(best, (score / (MATCH * len(own)), first + begin, first + end))
            if best[0] >= min(FLAGGED, EXCERPT / len(own)):
                found.append((self.ids[item], *best))
        return found


def ngrams(numbers: np.ndarray) -> np.ndarray:
    if len(numbers) < N:
        return np.zeros(0, np.int64)
    return reduce(lambda code, k: code << _BITS | numbers[k : len(numbers) - N + 1 + k], range(N), np.int64(0))


def _stretches(starts: list[int], reach: int, least: int) -> Iterator[tuple[int, int]]:
    """First and last of the groups of `least` diagonals or more, no further than `reach` from one to the next."""
    group = [starts[0]]
    for start in [*starts[1:], None]:
        if start is not None and start - group[-1] <= reach:
            group.append(start)
            continue
        if len(group) >= least:
            yield group[0], group[-1]
        group = [start]


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: best local score, and the stretch of the window that it spans."""
    n = len(window)
    slope = GAP * np.arange(n + 1)
    row, begins = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(window == word, MATCH, MISMATCH)
        made, source = row + GAP, begins.copy()
        diagonal = row[:-1] + step
        better = diagonal > made[1:]
        made[1:][better], source[1:][better] = diagonal[better], begins[:-1][better]
        # Gaps in the item: the best value to the left, less what the way from there costs.
        lifted = made - slope
        reached = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == reached, np.arange(n + 1), 0))
        made, source = reached + slope, source[origin]
        fresh = made <= 0
        row = np.where(fresh, 0, made)
        begins = np.where(fresh, np.arange(n + 1), source)
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), int(begins[end]), end)
    return best


def _parts(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[Items]:
    rows, size = [], 0
    for row in benchmark.select(id_column, text_column).orderBy(id_column, text_column).toLocalIterator():
        n = len(words_of(row[1] or ""))
        if n < N:
            continue
        if rows and size + n > PART_WORDS:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append(tuple(row))
        size += n
    if rows:
        yield Items.of(rows)


def _frequencies(docs: DataFrame, items: Items, text_column: str) -> np.ndarray:
    """In how many texts each n-gram of the benchmark occurs; counted within each task first."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own = shared.value
        counts = np.zeros(len(own.codes), np.int64)
        for batch in batches:
            for text in batch[text_column]:
                if text:
                    counts[np.unique(own.hits(own.numbers(text))[1])] += 1
        slots = np.flatnonzero(counts)
        yield [slots.tolist(), counts[slots].tolist()]

    partial = map_rows(docs, [text_column], "slot int, n bigint", rows_of)
    frequency = np.zeros(len(items.codes), np.int64)
    for row in partial.groupBy("slot").agg(F.sum("n").alias("n")).collect():
        frequency[row["slot"]] = row["n"]
    return frequency


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
) -> Column:
    """Column over `docs`: array of (item_id, score, first word, word after the last), empty for a clean text."""
    kind = f"array<struct<item_id:{benchmark.schema[item_id_column].dataType.simpleString()},score:double,"
    kind += "first_word:int,end_word:int>>"
    found = []
    for items in _parts(benchmark, item_id_column, item_text_column):
        items.seed(_frequencies(docs, items, text_column))
        found.append(_match_column(docs, items, text_column, kind))
    return F.concat(*found) if found else F.array().cast(kind)


def _match_column(docs: DataFrame, items: Items, text_column: str, kind: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    bound_batches()

    @pandas_udf(kind)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        names = ("item_id", "score", "first_word", "end_word")
        for texts in batches:
            found = [[dict(zip(names, m, strict=True)) for m in own.matches(text)] if text else [] for text in texts]
            yield pd.Series(found, dtype=object)

    return matches(F.col(text_column))
