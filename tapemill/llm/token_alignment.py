"""Alignment of two tokenizers' tokens, with corpus-wide counts of aligned id pairs under a minimal perfect hash.

A text is cut by tokenizer A (byte-level BPE, of a space and the text) and by tokenizer B (sentence pieces, which add the
space). Byte offsets where tokens of both end cut the tokens into groups; the two tokens that end there are linked.

- `aligned` runs both tokenizers once, proves that the tokens' bytes are those of the text, and keeps the ids. For
  Latin texts A's merges run in a faster library, from the vocabulary of the same file. That library merges the pair
  whose joined bytes have the least id, the other the pair with the least rule. Both do the same if every entry, cut by
  itself, is one token: where two neighbours join to an entry and nothing crossed its ends, the merges inside were those
  of the entry alone, whose last one is a rule. Other texts go to the first library, as the two may class letters of
  recent Unicode versions differently.
- `distinct_pairs` aligns the kept ids and takes the distinct linked pairs, first within each task.
- A minimal perfect hash (levels of bit arrays, in each the keys that meet no other; a key's index is the rank of its
  bit) gives every pair its place in a dense vector; keys are kept by place, so that a foreign pair is told.
- Every task counts its pairs in such a vector; the vectors are summed in a tree, FAN_IN at a time and in pieces of
  PIECE places, so no task holds more than FAN_IN pieces.
- `pair_figures` aligns the kept ids once more and looks up its pairs' counts.

What is broadcast has a bound: pairs go by SHARD_PAIRS, sharded by their B id so that an id's highest count is known
within its shard, and each shard takes a pass over the kept ids (one shard below SHARD_PAIRS pairs).

Defined cases: texts that are null or empty, or whose tokens of either kind do not join to the space and the text (such
as one with U+2581, which B reads as a space), have no tokens: zeros and an empty digest. Repeated rows, also of one
id or without an id, count and are returned each. Very long texts are tokenized whole, one at a time. Empty tables
give no rows. Only the named columns are read, so other names cannot clash.
"""

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.bpe_codec import SPLIT, Model
from tapemill.llm.common import map_rows, saved
from tapemill.llm.wordhash import STEP, mix

SHARD_PAIRS = 1 << 21
PIECE = 1 << 16
FAN_IN = 16
# Texts are tokenized in groups of so many characters, or one by one, if longer.
GROUP_CHARS = 1 << 18
# Distinct pairs that a task holds before it hands them on.
KEPT_PAIRS = 1 << 20

# Texts of characters that are classed alike since long.
_LATIN = re.compile("[\\x00-\\u024f]*").fullmatch

_KEPT = "doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, a binary, b binary"


class Tokenizers:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model = Model(path_a)
        self.bytes_a = model.bytes_of
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in model.special.values()}
        self.latin = tiktoken.Encoding("latin", pat_str=SPLIT.pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(x) for x in part]) for part in (self.bytes_a, self.bytes_b))
        # An id with what may follow it in the text of groups.
        self.written = [f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for end in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _grouped(self, texts: list[str]) -> Iterator[list[str]]:
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARS:
                yield group
                group, size = [], 0
            group.append(text)
            size += len(text)
        if group:
            yield group

    def both(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of either kind for each text; none if they do not stand for the text's bytes."""
        nothing = np.zeros(0, np.int64)
        for group in self._grouped(texts):
            marked = [" " + text for text in group]
            found = [self.latin.encode_ordinary(text) if _LATIN(text) else None for text in marked]
            others = [text for text, ids in zip(marked, found, strict=True) if ids is None]
            left = iter(self.a.encode_batch_fast(others, add_special_tokens=False))
            found = [next(left).ids if ids is None else ids for ids in found]
            for text, a, b in zip(marked, found, self.b.encode(group, num_threads=1), strict=True):
                whole = text.encode()
                right = len(text) > 1 and all(
                    b"".join(map(part.__getitem__, ids)) == whole for part, ids in ((self.bytes_a, a), (self.bytes_b, b))
                )
                yield (np.array(a, np.int64), np.array(b, np.int64)) if right else (nothing, nothing)

    def shared_ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens that end together; ids may be those of many texts in a row."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        place = np.minimum(np.searchsorted(ends_b, ends_a), max(len(ends_b) - 1, 0))
        at_a = np.flatnonzero(ends_b[place] == ends_a) if len(b) else np.zeros(0, np.int64)
        return at_a, place[at_a]

    def groups_text(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """`a1,a2|b1;a3|b2,b3`: ids of either kind by group, in order."""
        group_a = np.searchsorted(at_a, np.arange(len(a)))
        group_b = np.searchsorted(at_b, np.arange(len(b)))
        entry_a, entry_b = a * 3, b * 3
        entry_a[at_a] += 1
        entry_b[at_b] += 2
        order = np.argsort(np.concatenate([group_a, group_b]), kind="stable")
        return "".join(map(self.written.__getitem__, np.concatenate([entry_a, entry_b])[order].tolist()))[:-1]


_TOKENIZERS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    if (path_a, path_b) not in _TOKENIZERS:
        _TOKENIZERS[path_a, path_b] = Tokenizers(path_a, path_b)
    return _TOKENIZERS[path_a, path_b]


class PerfectHash:
    """Places 0 to n-1 of n distinct 64-bit keys, by levels of bit arrays; keys that meet go on to the next level."""

    def __init__(self, keys: np.ndarray):
        self.sizes, self.words, self.before = [], [], []
        left, total = keys.astype(np.uint64), 0
        while len(left):
            size = max(64, 2 * len(left))
            place = self._place(left, len(self.sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            bits = np.zeros(-(-size // 64) * 64, np.uint8)
            bits[:size] = alone
            words = np.packbits(bits, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int64)
            self.sizes.append(size)
            self.words.append(words)
            self.before.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())
            left = left[~alone[place]]
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self._index(keys.astype(np.uint64))] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(int(STEP) * (level + 1) % (1 << 64))
        return (mix(keys + salt) % np.uint64(size)).astype(np.int64)

    def _index(self, keys: np.ndarray) -> np.ndarray:
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, words, before) in enumerate(zip(self.sizes, self.words, self.before, strict=True)):
            place = self._place(keys[open_], level, size)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (words[word] >> bit & np.uint64(1)).astype(bool)
            under = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[hit]] = (before[word] + np.bitwise_count(under))[hit]
            open_ = open_[~hit]
        return found

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 for one that is not in the hash."""
        found = self._index(keys)
        if len(self.keys):
            found[self.keys[found] != keys] = -1
        return found


def aligned(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text"):
    """Per row: id, numbers of tokens and groups, digest of the groups, and the ids themselves (little-endian)."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own = tokenizers(path_a, path_b)
        for batch in batches:
            rows = []
            for doc, (a, b) in zip(batch["doc_id"], own.both([t or "" for t in batch["text"]]), strict=True):
                at_a, at_b = own.shared_ends(a, b)
                digest = hashlib.sha256(own.groups_text(a, b, at_a, at_b).encode()).hexdigest() if len(a) else ""
                ids = [part.astype(np.uint32).tobytes() for part in (a, b)]
                rows.append((doc, len(a), len(b), len(at_a), digest, *ids))
            yield list(zip(*rows, strict=True))

    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(texts, ["doc_id", "text"], _KEPT.format(kind=kind), rows_of)


def _links(own: Tokenizers, batch: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (A id, B id) of the links of a batch in order, and their number by row."""
    a, b = (np.frombuffer(b"".join(batch[side]), np.uint32).astype(np.int64) for side in "ab")
    at_a, at_b = own.shared_ends(a, b)
    row_of = np.repeat(np.arange(len(batch["a"])), [len(ids) // 4 for ids in batch["a"]])
    return (a[at_a] << 32 | b[at_b]).astype(np.uint64), np.bincount(row_of[at_a], minlength=len(batch["a"]))


def distinct_pairs(kept: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The distinct linked pairs: key (A id in the upper half) and B id."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own, held = tokenizers(path_a, path_b), np.zeros(0, np.uint64)
        for batch in batches:
            held = np.union1d(held, _links(own, batch)[0])
            if len(held) > KEPT_PAIRS:
                yield [held.astype(np.int64)]
                held = held[:0]
        yield [held.astype(np.int64)]

    pairs = map_rows(kept, ["a", "b"], "pair bigint", rows_of).distinct()
    return pairs.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))


def _counted(kept: DataFrame, path_a: str, path_b: str, places: PerfectHash) -> np.ndarray:
    """How many links of the corpus hold each pair, by place: dense vectors of all tasks, summed in a tree."""
    shared = kept.sparkSession.sparkContext.broadcast(places)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own, counts = tokenizers(path_a, path_b), np.zeros(len(shared.value.keys), np.int64)
        for batch in batches:
            index = shared.value.index(_links(own, batch)[0])
            counts += np.bincount(index[index >= 0], minlength=len(counts))
        task = TaskContext.get().partitionId()
        pieces = [(at, part) for at in range(0, len(counts), PIECE) if (part := counts[at : at + PIECE]).any()]
        yield [[at for at, _ in pieces], [task] * len(pieces), [part.tobytes() for _, part in pieces]]

    kind = "start bigint, node int, counts binary"
    summed = saved(map_rows(kept, ["a", "b"], kind, rows_of), "pair-counts")

    def add(key: tuple, group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(part.as_py(), np.int64) for part in group.column("counts"))
        columns = [pa.array([key[0].as_py()], pa.int64()), pa.array([key[1].as_py()], pa.int32())]
        return pa.table([*columns, pa.array([total.tobytes()], pa.binary())], ["start", "node", "counts"])

    nodes = (summed.agg(F.max("node")).first()[0] or 0) + 1
    while nodes > 1:
        summed = summed.withColumn("node", (F.col("node") / FAN_IN).cast("int"))
        summed = summed.groupBy("start", "node").applyInArrow(add, kind)
        nodes = -(-nodes // FAN_IN)
    counts = np.zeros(len(places.keys), np.int64)
    for row in summed.collect():
        part = np.frombuffer(row["counts"], np.int64)
        counts[row["start"] : row["start"] + len(part)] = part
    return counts


def _looked_up(kept: DataFrame, path_a: str, path_b: str, places: PerfectHash, counts: np.ndarray) -> DataFrame:
    """`kept` with the figures of this shard's pairs added to n_best and count_sum."""
    b_ids = (places.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    highest = np.zeros(b_ids.max(initial=0) + 1, np.int64)
    np.maximum.at(highest, b_ids, counts)
    shared = kept.sparkSession.sparkContext.broadcast((places, counts, counts == highest[b_ids]))
    columns = kept.columns

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        own, (hashed, count, best) = tokenizers(path_a, path_b), shared.value
        for batch in batches:
            keys, sizes = _links(own, batch)
            index = hashed.index(keys)
            known = index >= 0
            ends = np.cumsum(sizes)
            for name, values in (("n_best", best), ("count_sum", count)):
                # The last place is for links of other shards.
                sums = np.cumsum(np.where(known, values[index], 0)) if len(values) else np.zeros(len(keys), np.int64)
                upto = np.concatenate([[0], sums])[ends]
                batch[name] = np.array(batch[name]) + np.diff(upto, prepend=0)
            yield [batch[name] for name in columns]

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in kept.schema)
    return map_rows(kept, columns, schema, rows_of)


def pair_figures(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text"):
    """Per row: numbers of tokens, groups and links, of links that are the B id's most frequent, the sum of counts, and
    the digest of the groups."""
    kept = saved(aligned(docs, path_a, path_b, id_column, text_column), "aligned-tokens")
    pairs = saved(distinct_pairs(kept, path_a, path_b), "aligned-pairs")
    shards = max(1, -(-pairs.count() // SHARD_PAIRS))
    zero = F.lit(0).cast("bigint")
    kept = kept.withColumn("n_best", zero).withColumn("count_sum", zero)
    for shard in range(shards):
        own = pairs.where(F.pmod(F.xxhash64("b_id"), F.lit(shards)) == shard).select("pair")
        places = PerfectHash(own.toArrow().column(0).to_numpy().astype(np.uint64))
        kept = _looked_up(kept, path_a, path_b, places, _counted(kept, path_a, path_b, places))
        if shard < shards - 1:
            kept = saved(kept, "aligned-figures")
    # As no token is without bytes, one token of either kind ends where a group does: a link each.
    return kept.select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
