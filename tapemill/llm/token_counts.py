"""Exact token counts of every prefix of a text, for byte-fallback piece models, by dynamic programming.

The encoding of a prefix ends in one piece, and what stands before that piece is the encoding of a shorter
prefix. So the table of a text needs, for each prefix, its last piece and its count: among the pieces that end
there, exactly one can follow the last piece of the shorter prefix, namely the one that merging the two pieces'
characters gives back as these two pieces. No prefix is ever encoded anew. A piece never has a space mark after
another character, so the table of a text is made up of the tables of its words (leading spaces included),
which are kept per worker.

Defined cases: a null text counts as empty and has no tokens; unknown characters count as their UTF-8 bytes;
repeated rows are counted each; other columns are ignored, so their names cannot clash. Texts of any length are
counted whole. Models must be of the merging kind, with identity normalisation and a dummy prefix.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from tapemill.llm.common import bound_batches, map_rows

SPACE = "▁"
# Words kept per worker before the table starts anew; bounds its memory only.
KEPT_WORDS = 600_000
_UNKNOWN = -1
_COUNTERS: dict[str, "PrefixCounter"] = {}


class PrefixCounter:
    """Prefix tables of one model. A word is named by its text without the first space before it."""

    def __init__(self, model_path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.pieces: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(model.vocab_size()):
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            text = model.id_to_piece(i).replace(SPACE, " ")
            self.pieces[text], self.score[text] = i, model.get_score(i)
        self.text = {i: text for text, i in self.pieces.items()}
        self.longest = max(map(len, self.pieces))
        self.follows: dict[tuple[int, int], bool] = {}
        self.counts: dict[str, int] = {}
        probe = " a  probe\n ofé <s> 中\U0001f600 "
        if self.count(probe) != len(model.encode(probe)):
            raise ValueError(f"{model_path} is not a merging model with identity normalisation and byte fallback")

    def _merged(self, text: str) -> list[str]:
        symbols = list(text)
        while True:
            best = None
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = (score, i)
            if best is None:
                return symbols
            i = best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    def _can_follow(self, before: int, piece: int) -> bool:
        if before == _UNKNOWN:
            found = len(self._merged(self.text[piece])) == 1
        else:
            pair = [self.text[before], self.text[piece]]
            found = self._merged("".join(pair)) == pair
        self.follows[before, piece] = found
        return found

    def _extend(self, word: str, last: list[int], count: list[int]) -> None:
        """Fill the table of a word from the prefix it has already."""
        pieces, follows, longest = self.pieces, self.follows, self.longest
        for end in range(len(last), len(word) + 1):
            for begin in range(max(0, end - longest), end):
                piece = pieces.get(word[begin:end])
                if piece is None:
                    continue
                ok = follows.get((last[begin], piece))
                if ok or (ok is None and self._can_follow(last[begin], piece)):
                    last.append(piece)
                    count.append(count[begin] + 1)
                    break
            else:
                last.append(_UNKNOWN)
                count.append(count[end - 1] + len(word[end - 1].encode()))

    def table(self, name: str) -> list[int]:
        """Counts of all prefixes of a word with its spaces, the empty prefix first."""
        last, count = [_UNKNOWN], [0]
        self._extend(" " + name, last, count)
        return count

    def learn(self, names: set[str]) -> None:
        """Counts of whole words; in sorted order, each starts from the table of the prefix it shares."""
        last, count, previous = [_UNKNOWN], [0], ""
        for name in sorted(names):
            word = " " + name
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :], count[shared + 1 :]
            self._extend(word, last, count)
            self.counts[name] = count[-1]
            previous = word

    @staticmethod
    def words(text: str) -> list[str]:
        """Names of the words of a text, in order; with its spaces, a text is their concatenation."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " ":
            return [word[1:] for word in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def count_all(self, texts: list[str | None]) -> list[int]:
        words = [self.words(text or "") for text in texts]
        if len(self.counts) > KEPT_WORDS:
            self.counts.clear()
        counts = self.counts
        self.learn(set().union(*words).difference(counts))
        return [sum(map(counts.__getitem__, own)) for own in words]

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... code points of a text."""
        steps, before = [0], 0
        for name in self.words(text):
            own = self.table(name)
            steps.extend(before + n for n in own[1:])
            before += own[-1]
        # The space put before a text is no code point of it.
        return np.array([0, *steps[2:]] if text else steps, "<i4")


def counter(model_path: str) -> PrefixCounter:
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = PrefixCounter(model_path)
    return _COUNTERS[model_path]


def count_tokens(text: Column, model_path: str) -> Column:
    """Number of tokens of a whole text, without begin or end tokens."""

    bound_batches()

    @pandas_udf(LongType())
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(model_path)
        for texts in batches:
            yield pd.Series(own.count_all(texts.tolist()), dtype="int64")

    return counts(text)


def prefix_tables(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, n_tokens, and prefix_counts, little-endian 32-bit counts of all prefixes."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own = counter(model_path)
        for batch in batches:
            tables = [own.prefix_counts(text or "") for text in batch[text_column]]
            yield [batch[id_column], [int(t[-1]) for t in tables], [t.tobytes() for t in tables]]

    schema = f"{id_column} {docs.schema[id_column].dataType.simpleString()}, n_tokens bigint, prefix_counts binary"
    return map_rows(docs, [id_column, text_column], schema, rows_of)


@pandas_udf(LongType())
def tokens_before(tables: pd.Series, positions: pd.Series) -> pd.Series:
    """Token count of the prefix of so many code points (of the whole text beyond its end), from the stored table."""
    counts = [np.frombuffer(t, "<i4") for t in tables]
    return pd.Series([int(c[min(max(p, 0), len(c) - 1)]) for c, p in zip(counts, positions, strict=True)])


@pandas_udf(LongType())
def longest_prefix(tables: pd.Series, budgets: pd.Series) -> pd.Series:
    """Code points of the longest prefix that takes no more tokens than the budget, from the stored table."""
    counts = [np.frombuffer(t, "<i4") for t in tables]
    return pd.Series([int(np.flatnonzero(c <= max(b, 0))[-1]) for c, b in zip(counts, budgets, strict=True)])
