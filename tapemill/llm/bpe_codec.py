"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

The frequent words of the corpus are found by counts that Spark makes over all rows; with their ids, they are
compiled into a minimal acyclic transducer: states with equal futures are one state, and the numbers on a path's arcs add up to
the place of the word's ids. Its file lies in the shared folder, each executor fetches it once and maps it into
memory. A word outside the lexicon is merged by rank, exactly as the model's merge list says, so the lexicon
decides the speed and never the result.

Defined cases: a null text encodes as the empty text, to no ids, and decodes to the empty text; the model's own
special strings inside a text become their ids, which is the library's default; repeated rows are encoded each;
other columns are ignored, so their names cannot clash. An empty table gives an empty lexicon and no rows.
Texts of any length are encoded whole.
"""

import heapq
import json
import mmap
import re
import sys
import uuid
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.llm.common import map_rows, saved
from tapemill.session import work_dir

# Bounds of the lexicon: words of so many parts of texts, of so many bytes at the most. Other words are merged.
LEXICON_WORDS = 65_536
LEXICON_WORD_BYTES = 48
# Words kept per worker before its tables start anew; bounds its memory only.
KEPT_WORDS = 300_000
# Merged with a heap from this length on.
LONG_WORD = 64
# Fixed value: the split of a text before merging, as the models of this kind define it.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# Where no space follows white space, a text may be cut before each space, and its parts split on their own.
_ENTANGLED = re.compile(r"\s ")

_SLOT_BITS = 18
_FREE = np.uint64(2**64 - 1)


def _slot(keys: np.ndarray, salt: int) -> np.ndarray:
    return ((keys + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


_MODELS: dict[str, "Model"] = {}
_ENCODERS: dict[tuple[str, str], "Encoder"] = {}


class Model:
    """Vocabulary and merge ranks of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # Bytes that stand for themselves in the vocabulary; the others follow from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        byte_of = {chr(b if b in plain else next(others)): b for b in range(256)}
        vocab = spec["model"]["vocab"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in text)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.id_of_byte = [vocab[c] for c, _ in sorted(byte_of.items(), key=lambda item: item[1])]
        pairs = spec["model"]["merges"]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.tables = self._rank_tables()
        self.special_split = re.compile("|".join(map(re.escape, self.special))) if self.special else None

        self.first_rank = self._rank_of(*np.divmod(np.arange(1 << 16), 256), bytes_only=True)

    def _rank_tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs by hash; those whose slot is taken go on to the next table."""
        keys = np.array([a << 32 | b for a, b in self.rank], np.uint64)
        ranks, tables, salt = np.arange(len(keys), dtype=np.int32), [], 1
        while len(keys):
            slots, first = np.unique(_slot(keys, salt), return_index=True)
            held, of = np.full(1 << _SLOT_BITS, _FREE), np.zeros(1 << _SLOT_BITS, np.int32)
            held[slots], of[slots] = keys[first], ranks[first]
            tables.append((held, of))
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, ranks, salt = keys[left], ranks[left], salt + 1
        return tables

    def _rank_of(self, a: np.ndarray, b: np.ndarray, bytes_only: bool = False) -> np.ndarray:
        """Ranks of pairs of ids (or of bytes); the number of rules where there is none."""
        if bytes_only:
            of_byte = np.array(self.id_of_byte)
            a, b = of_byte[a], of_byte[b]
        keys = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        found = np.full(len(keys), len(self.merged), np.int32)
        for salt, (held, ranks) in enumerate(self.tables, 1):
            slots = _slot(keys, salt)
            right = held[slots] == keys
            found[right] = ranks[slots[right]]
        return found

    def decode(self, ids: bytes) -> str:
        """Text of ids that stand as little-endian 32-bit integers."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank is merged, the leftmost first, until none is left."""
        return list(memoryview(self.merge_all([word])[0]).cast("I"))

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers; words of like length are merged side by side."""
        made: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                made[i] = array("I", self._merge_long([self.id_of_byte[b] for b in word])).tobytes()
            elif word:
                by_width.setdefault(max(4, 1 << (len(word) - 1).bit_length()), []).append(i)
        for width, places in by_width.items():
            for start in range(0, len(places), 1 << 13):
                own = places[start : start + (1 << 13)]
                for i, ids in zip(own, self._merge_rows([words[i] for i in own], width), strict=True):
                    made[i] = ids
        return made

    def _merge_rows(self, words: list[bytes], width: int) -> Iterator[bytes]:
        none, n = len(self.merged), len(words)
        raw, sizes = _padded(words)
        width = raw.shape[1]
        columns = np.arange(width)
        ids = np.where(columns < sizes[:, None], np.array(self.id_of_byte, np.int32)[raw], -1)
        ranks = np.full((n, width), none, np.int32)
        ranks[:, :-1] = self.first_rank[raw[:, :-1].astype(np.int32) << 8 | raw[:, 1:]]
        ranks[columns >= sizes[:, None] - 1] = none
        merged = np.array(self.merged, np.int32)
        open_rows = np.arange(n)
        while len(open_rows):
            at = ranks[open_rows].argmin(axis=1)
            lowest = ranks[open_rows, at]
            going = lowest < none
            open_rows, at, lowest = open_rows[going], at[going], lowest[going]
            rows = np.arange(len(open_rows))
            # The merged pair takes the left place, the rest moves up.
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            moved = np.take_along_axis(ids[open_rows], take, axis=1)
            moved[:, -1] = -1
            moved[rows, at] = merged[lowest]
            ids[open_rows] = moved
            take = np.minimum(columns + (columns >= at[:, None]), width - 1)
            shifted = np.take_along_axis(ranks[open_rows], take, axis=1)
            shifted[:, -1] = none
            for left in (at - 1, at):
                right = np.minimum(left + 1, width - 1)
                pair = (left >= 0) & (left + 1 < width) & (moved[rows, right] >= 0)
                shifted[rows[left >= 0], left[left >= 0]] = none
                shifted[rows[pair], left[pair]] = self._rank_of(moved[rows[pair], left[pair]], moved[rows[pair], right[pair]])
            ranks[open_rows] = shifted
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        return (flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))

    def _merge_long(self, ids: list[int]) -> list[int]:
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        waiting: list[tuple[int, int, int, int]] = []

        def consider(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (rank := self.rank.get((ids[left], ids[right]))) is not None:
                heapq.heappush(waiting, (rank, left, ids[left], ids[right]))

        for left, right in enumerate(after):
            consider(left, right)
        while waiting:
            rank, left, a, b = heapq.heappop(waiting)
            right = after[left]
            if ids[left] != a or right < 0 or ids[right] != b:
                continue
            ids[left], ids[right] = self.merged[rank], -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            consider(before[left], left)
            consider(left, after[left])
        return [i for i in ids if i >= 0]


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words as rows of one width, and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max(initial=1))
    raw = b"".join(word.ljust(width, b"\0") for word in words)
    return np.frombuffer(raw, np.uint8).reshape(len(words), width), sizes


class Lexicon:
    """Words and their ids as one block of bytes; `find_all` walks the block itself, which may be a mapped file.

    The block holds the sorted keys of the arcs (state and label), their targets and numbers, where the ids of
    each word begin, the ids, and which states are final.
    """

    def __init__(self, block: mmap.mmap | bytes):
        states, arcs, words, ids = np.frombuffer(block, "<i8", 4).tolist()
        self.keys = np.frombuffer(block, "<i8", arcs, 32)
        ends = list(accumulate([32 + 8 * arcs, 4 * arcs, 4 * arcs, 4 * (words + 1), 4 * ids]))
        self.targets, self.numbers, self.starts = (
            np.frombuffer(block, "<i4", n, at) for n, at in zip((arcs, arcs, words + 1), ends, strict=False)
        )
        self.ids = memoryview(block)[ends[3] : ends[4]]
        self.finals = np.frombuffer(block, np.uint8, states, ends[4])

    def find_all(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word as little-endian 32-bit integers; None for a word that the lexicon lacks."""
        if not words or not len(self.keys):
            return [None] * len(words)
        short = [word if len(word) <= LEXICON_WORD_BYTES else b"" for word in words]
        raw, sizes = _padded(short)
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        walking = np.flatnonzero(sizes)
        lost = sizes == 0
        for step in range(raw.shape[1]):
            walking = walking[sizes[walking] > step]
            keys = state[walking] << 8 | raw[walking, step]
            arcs = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            there = self.keys[arcs] == keys
            lost[walking[~there]] = True
            walking, arcs = walking[there], arcs[there]
            place[walking] += self.numbers[arcs]
            state[walking] = self.targets[arcs]
        found = ~lost & (self.finals[state] > 0)
        place[~found] = 0
        spans = zip(found.tolist(), self.starts[place].tolist(), self.starts[place + 1].tolist(), strict=True)
        return [bytes(self.ids[4 * a : 4 * b]) if ok else None for ok, a, b in spans]

    def find(self, word: bytes) -> bytes | None:
        return self.find_all([word])[0]


def compile_lexicon(ids_of: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of the words, as the block that `Lexicon` reads."""
    words = sorted(ids_of)
    # A state is (final, arcs); equal states are shared as soon as no further word can change them.
    shared: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, {}]]

    def close(depth: int) -> None:
        while len(path) > depth:
            final, arcs = path.pop()
            state = (final, tuple(arcs.items()))
            number = shared.setdefault(state, len(states))
            if number == len(states):
                states.append(state)
            path[-1][1][closing.pop()] = number

    closing: list[int] = []
    previous = b""
    for word in words:
        common = next((i for i, (a, b) in enumerate(zip(word, previous, strict=False)) if a != b), None)
        common = min(len(word), len(previous)) if common is None else common
        close(common + 1)
        for label in word[common:]:
            path.append([False, {}])
            closing.append(label)
        path[-1][0] = True
        previous = word
    close(1)
    states.append((path[0][0], tuple(path[0][1].items())))

    # Targets come before their states, so the root is last; it is written first.
    below: list[int] = []
    for final, arcs in states:
        below.append(final + sum(below[target] for _, target in arcs))
    root = len(states) - 1
    order = [root, *range(root)]
    renumbered = {old: new for new, old in enumerate(order)}
    keys, targets, numbers, finals = array("q"), array("i"), array("i"), bytearray()
    for old in order:
        final, arcs = states[old]
        passed = int(final)
        for label, target in arcs:
            keys.append(renumbered[old] << 8 | label)
            targets.append(renumbered[target])
            numbers.append(passed)
            passed += below[target]
        finals.append(final)
    ids = [ids_of[word] for word in words]
    starts = array("i", accumulate(map(len, ids), initial=0))
    flat = array("I", [i for own in ids for i in own])
    sizes = array("q", [len(order), len(keys), len(words), len(flat)])
    return b"".join(map(bytes, (sizes, keys, targets, numbers, starts, flat, finals)))


class Encoder:
    """Encodes batches of texts; words and parts seen lately are kept."""

    def __init__(self, model: Model, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon
        self.words: dict[str, bytes] = {}
        # Parts of a text between single spaces, each with the space before it.
        self.parts: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        raw = [word.encode() for word in words]
        found = self.lexicon.find_all(raw)
        merged = iter(self.model.merge_all([word for word, ids in zip(raw, found, strict=True) if ids is None]))
        for word, ids in zip(words, found, strict=True):
            self.words[word] = next(merged) if ids is None else ids

    def _cut(self, text: str) -> list[tuple[list[str], list[str], bytes]]:
        """Stretches of a text as words, parts that follow them, and the ids of a special string that ends them."""
        stretches, start = [], 0
        if self.model.special_split is not None:
            for match in self.model.special_split.finditer(text):
                tail = array("I", [self.model.special[match[0]]]).tobytes()
                stretches.append((*_split(text[start : match.start()]), tail))
                start = match.end()
        return [*stretches, (*_split(text[start:] if start else text), b"")]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian 32-bit integers."""
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        if len(self.parts) > KEPT_WORDS:
            self.parts.clear()
        words, parts = self.words, self.parts
        cuts = [self._cut(text or "") for text in texts]
        new = set().union(*(own for cut in cuts for _, own, _ in cut)).difference(parts)
        # Letters after a space are one word.
        split = {part: [" " + part] if part.isalpha() else SPLIT.findall(" " + part) for part in new}
        self._learn(set().union(*split.values(), *(own for cut in cuts for own, _, _ in cut)).difference(words))
        for part, own in split.items():
            parts[part] = words[own[0]] if len(own) == 1 else b"".join(map(words.__getitem__, own))
        return [
            b"".join([*map(words.__getitem__, own), *map(parts.__getitem__, more), tail])
            if len(cut) == 1
            else b"".join(
                piece
                for own, more, tail in cut
                for piece in (*map(words.__getitem__, own), *map(parts.__getitem__, more), tail)
            )
            for cut in cuts
            for own, more, tail in cut[:1]
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _split(text: str) -> tuple[list[str], list[str]]:
    """Words of a text, and the parts that follow them, each after a space."""
    if _ENTANGLED.search(text):
        return SPLIT.findall(text), []
    first, *parts = text.split(" ")
    return SPLIT.findall(first), parts


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _encoder(model_path: str, lexicon_name: str) -> Encoder:
    """This worker's encoder; it maps the executor's copy of the lexicon."""
    key = (model_path, lexicon_name)
    if key not in _ENCODERS:
        with open(SparkFiles.get(lexicon_name), "rb") as file:
            block = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model(model_path), Lexicon(block))
    return _ENCODERS[key]


def count_parts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """How often each part between spaces occurs in all texts."""
    parts = docs.select(F.explode(F.split(F.col(text_column), " ")).alias("part"))
    return parts.groupBy("part").agg(F.count("*").alias("n"))


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS, text_column: str = "text") -> set[str]:
    """The words of the most frequent parts: of those that occur twice or more, `most` at the most.

    Parts of one frequency class are taken together or not at all, so no more than `most` rows reach the driver.
    """
    counts = count_parts(docs, text_column).where((F.col("n") > 1) & (F.octet_length("part") < LEXICON_WORD_BYTES))
    counts = saved(counts.withColumn("class", F.floor(F.log2("n") * 16).cast("int")), "part-counts")
    sizes = counts.groupBy("class").count().collect()
    room, lowest = most, None
    for size in sorted(sizes, reverse=True):
        room -= size["count"]
        if room < 0:
            break
        lowest = size["class"]
    if lowest is None:
        return set()
    frequent = counts.where(F.col("class") >= lowest).select("part").collect()
    return {word for row in frequent for word in SPLIT.findall(" " + row["part"])}


def share_lexicon(spark: SparkSession, words: set[str], model_path: str) -> str:
    """Compile the words, put the file into the shared folder, and have executors fetch it. Returns its name."""
    rules = model(model_path)
    raw = [word.encode() for word in words]
    block = compile_lexicon({word: memoryview(ids).cast("I") for word, ids in zip(raw, rules.merge_all(raw), strict=True)})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    jvm, context = spark._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(work_dir(spark, "lexicon"), name)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        stream.write(bytearray(block))
    finally:
        stream.close()
    context.addFile(target.toString())
    return name


def encode(
    docs: DataFrame,
    model_path: str,
    lexicon_name: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """Per row: its id, n_tokens, and ids as little-endian 32-bit integers.

    With `decoded`, also `text`, decoded from the ids in the same pass, so that texts cross to Python once.
    """

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        assert sys.byteorder == "little"
        own = _encoder(model_path, lexicon_name)
        for batch in batches:
            ids = own.encode_all(batch[text_column])
            texts = [list(map(own.model.decode, ids))] if decoded else []
            yield [batch[id_column], [len(i) // 4 for i in ids], ids, *texts]

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, n_tokens bigint, ids binary" + (", text string" if decoded else "")
    return map_rows(docs, [id_column, text_column], schema, rows_of)


def decode(encoded: DataFrame, model_path: str, id_column: str = "doc_id") -> DataFrame:
    """Adds `text`, decoded from `ids`; bytes that are no UTF-8 become replacement characters."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own = model(model_path)
        for batch in batches:
            yield [batch[id_column], batch["n_tokens"], batch["ids"], list(map(own.decode, batch["ids"]))]

    kind = encoded.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, n_tokens bigint, ids binary, text string"
    return map_rows(encoded, [id_column, "n_tokens", "ids"], schema, rows_of)
