"""Exact self-join of texts by the Jaccard similarity of their word n-grams, by universe partitioning.

A text's set are the hashes of its distinct shingles of SHINGLE words. Texts are joined by size band: a pair
belongs to the band of the smaller set, which spans a factor of two; a set also takes part in the band below if
it is not too large for a partner there. In a band, the hash of a shingle says into which of its segments it
falls. Two sets that are similar enough differ in at most H shingles, so of H+1 segments at least one is the
same in both. A set's signatures are its segments that are not empty. In bands of small sets each shingle is a
segment of its own. A band has enough segments for those that a set leaves empty; in DELETED of them,
signatures with one shingle deleted are indexed too: such a segment also finds sets that differ in it by one
shingle, and counts for two. A set too large for the band's own members only looks up as many segments as it
needs, those with most shingles, which the fewest others have.

Candidates are linked in two rounds. First each member of a signature's bucket is compared with the bucket's
smallest; what that links is one component. After that, members of different components are compared: all of a bucket
of up to CROWD members; of a crowded one only with the sets that cannot do without it. A set leaves out crowded buckets
as long as its other segments suffice, and then takes the least crowded first; that is the cost-based allocation of what
it must look up. Members of crowded buckets are compared in blocks, as arrays within a task. Two sets that meet in many
crowded buckets are a candidate in the one of the smallest signature: each carries its smallest KNOWN signatures, and
a candidate is left to a smaller signature that both carry. Every candidate is verified on the words of both
texts. So no pair is lost, and a large group of copies costs in proportion to its size.

Defined cases: words are runs of characters other than ASCII white space, with A to Z lower-cased; a text of
fewer words than a shingle has them all as its one shingle; null texts and texts without words have an empty
set and link with nothing; rows without an id are left out; rows that share an id are one document, which has
the links of all of them and the size of the largest set. Ids must be integers. Other columns are ignored, so their names cannot clash.
Texts of any length are taken whole; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapemill.llm.common import bound_batches, map_rows, narrow_batches, saved
from tapemill.llm.graph import components
from tapemill.llm.wordhash import P1, P2, STEP, mix, run_hashes, word_hashes, words_of

SHINGLE = 5
# Least similarity, in percent; links need 100 * intersection >= LEAST * union.
LEAST = 75
# Sets below this size have a segment for each shingle.
SMALL = 32
# Segments of a band, by its largest set, and some more.
SEGMENTS, MORE = 0.36, 6
DELETED = 4
CROWD = 16
# Members of a crowded bucket are compared in blocks of about so many, by sketches of so many bytes at the most.
BLOCK = 1024
MOST_BYTES = 1024
# Signatures of crowded buckets that a set carries; a pair that has smaller ones in common meets again, and is lost nowhere.
KNOWN = 64
# Ids up to so many are broadcast; more are joined.
BROADCAST_IDS = 500_000


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    words = word_hashes(words_of(text or ""))
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    return np.unique(run_hashes(words, n))


def _alike(shared: int, total: int) -> bool:
    return shared > 0 and 100 * shared >= LEAST * (total - shared)


def _shingles(text: str) -> frozenset:
    words = words_of(text)
    n = min(SHINGLE, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def similar(a: str, b: str) -> bool:
    """The exact test, on words."""
    return _similar(_shingles(a), _shingles(b))


def _similar(first: frozenset, second: frozenset) -> bool:
    return _alike(len(first & second), len(first) + len(second))


def sketch(tokens: np.ndarray) -> bytes:
    """Which of 2**k equal ranges of hashes a set has any in, as bits; four to eight ranges for each shingle."""
    k = max(3, len(tokens).bit_length() + 2)
    cells = np.zeros(1 << k, np.uint8)
    cells[(tokens >> np.uint64(64 - k)).astype(np.int64)] = 1
    return np.packbits(cells).tobytes()


def _folded(held: bytes, n: int) -> np.ndarray:
    """A sketch of n bytes, by taking neighbouring ranges together."""
    cells = np.frombuffer(held, np.uint8)
    return cells if len(cells) == n else np.packbits(np.unpackbits(cells).reshape(8 * n, -1).any(axis=1))


def at_most_shared(a: bytes, size_a: int, b: bytes, size_b: int) -> int:
    """No set of this sketch and size shares more with one of the other.

    Each range that both have holds one common shingle, and further ones only if both have several there.
    """
    n = min(len(a), len(b))
    x, y = _folded(a, n), _folded(b, n)
    spare = min(size_a - int(np.bitwise_count(x).sum()), size_b - int(np.bitwise_count(y).sum()))
    return int(np.bitwise_count(x & y).sum()) + spare


def _difference(a: int, b: int) -> int:
    """The most shingles that sets of these sizes may differ in and be similar."""
    return (100 - LEAST) * (a + b) // (100 + LEAST)


def band(size: int) -> int:
    return size.bit_length() - 1


def bands(size: int) -> list[int]:
    own = band(size)
    below = (1 << own) - 1
    return [own, own - 1] if own and LEAST * size <= 100 * below else [own]


def needed(size: int, number: int) -> int:
    """How many segments of a band a set must look up, for partners up to its own size."""
    return _difference(size, min(size, (2 << number) - 1)) + 1


def segments(number: int) -> int:
    """Segments of a band; 0 stands for one for each shingle."""
    largest = (2 << number) - 1
    return int(SEGMENTS * largest) + MORE if largest >= SMALL else 0


def signatures(tokens: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A set's signatures in a band, whether each has a shingle deleted, and for how much it counts.

    A segment counts for one, or for two if what it is with one shingle deleted is looked up, too; a signature
    with one deleted counts for nothing of its own.
    """
    size, m = len(tokens), segments(number)
    salt = mix(np.array([number + 1], np.uint64) * STEP)
    if not m:
        return mix(tokens ^ salt), np.zeros(size, bool), np.ones(size, np.int64)
    # Tokens are mixed hashes: the upper half of one more product is even enough to deal them among m segments.
    half = np.uint64(32)
    place = (((tokens ^ salt) * P1 >> half) * np.uint64(m) >> half).astype(np.int16 if m < 1 << 15 else np.int64)
    order = np.argsort(place, kind="stable")
    place, tokens = place[order], mix(tokens[order] ^ salt)
    edges = np.empty(size + 1, bool)
    edges[0] = edges[size] = True
    np.not_equal(place[1:], place[:-1], out=edges[1:size])
    edges = np.flatnonzero(edges)
    starts, counts = edges[:-1], edges[1:] - edges[:-1]
    held = place[starts].astype(np.int64)
    sums = np.add.reduceat(tokens, starts)
    names = mix(held.astype(np.uint64) * STEP + salt)
    exact = mix(sums + names)
    # One shingle deleted, in the first segments, where that leaves any.
    double = (held < DELETED) & (counts > 1)
    group = np.repeat(np.flatnonzero(double), counts[double])
    inside = np.repeat(double, counts)
    deleted = mix(sums[group] - tokens[inside] + names[group])
    worth = 1 + double
    if size >= 2 << number:
        # Too large for the band's own members: look up what is needed, the best-filled segments first.
        need = needed(size, number) - 2 * int(double.sum())
        single = np.flatnonzero(~double)
        single = single[np.argsort(-counts[single], kind="stable")]
        # Some more than needed, so that some may be left out.
        single = single[: max(0, need) + 4 + max(0, need) // 8]
        chosen = np.concatenate([np.flatnonzero(double), single])
        exact, worth = exact[chosen], worth[chosen]
    if worth.sum() < needed(size, number):
        raise ValueError(f"a set of {size} fills too few segments of band {number}")
    worth = np.concatenate([worth, np.zeros(len(deleted), np.int64)])
    return np.concatenate([exact, deleted]), np.arange(len(worth)) >= len(exact), worth


# Size of a set and its 128-bit digest, before its sketch.
_DIGEST = np.dtype([("size", "<i4"), ("low", "<i8"), ("high", "<i8")])
_DIGEST_ROW = -1


def _digest(tokens: np.ndarray) -> bytes:
    sums = [mix(tokens ^ salt).sum(dtype=np.uint64).astype(np.int64) for salt in (P1, P2)]
    return np.array((len(tokens), *sums), _DIGEST).tobytes() + sketch(tokens)


def _signed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Signatures of all sets, and a row with the digest of each, from one pass over the texts.

    `kind` holds, from the lowest bit, whether the signature has a shingle deleted, the band in 7 bits, for how
    much the set counts it in 2 bits, and by how much all of them in the band count for more than it needs; it is
    negative in digest rows, which are spread by their id.
    """

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            names, ids, kinds, digests = [], [], [], []
            for doc, text in zip(batch[id_column], batch[text_column], strict=True):
                tokens = shingle_set(text)
                digests.append(_digest(tokens))
                for number in bands(len(tokens)) if len(tokens) else ():
                    found, deleted, worth = signatures(tokens, number)
                    spare = int(worth.sum()) - needed(len(tokens), number)
                    names.append(found)
                    ids.append(np.full(len(found), doc, np.int64))
                    # Without its deleted ones, a segment still counts for one.
                    lost = np.where(deleted, 1, worth)
                    kinds.append((spare << 10 | lost << 8 | number << 1 | deleted).astype(np.int32))
            if names:
                columns = (np.concatenate(names).view(np.int64), np.concatenate(ids), np.concatenate(kinds))
                yield [*map(pa.array, columns), pa.nulls(len(columns[0]), pa.binary())]
            yield [batch[id_column], batch[id_column], [_DIGEST_ROW] * len(digests), digests]

    schema = "signature bigint, doc bigint, kind int, digest binary"
    return map_rows(docs, [id_column, text_column], schema, rows_of)


def _shared(signed: DataFrame) -> DataFrame:
    """Rows of the signatures that several documents have, with the smallest that has it undeleted; and digests."""
    read = pa.schema(
        [("signature", pa.int64()), ("doc", pa.int64()), ("kind", pa.int32()), ("digest", pa.binary())]
    )
    schema = "signature bigint, doc bigint, kind int, first bigint, size int, low bigint, high bigint, sketch binary"
    out = to_arrow_schema(T._parse_datatype_string(schema))

    def digests(rows: pa.RecordBatch) -> pa.RecordBatch:
        raw = rows.column(3).to_pylist()
        heads = np.frombuffer(b"".join(r[: _DIGEST.itemsize] for r in raw), _DIGEST)
        known = [*rows.columns[:3], pa.nulls(len(raw), pa.int64())]
        parts = [pa.array(np.ascontiguousarray(heads[name])) for name in _DIGEST.names]
        return pa.record_batch([*known, *parts, pa.array([r[_DIGEST.itemsize :] for r in raw], pa.binary())], schema=out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            apart = batch.column(2).to_numpy() < 0
            if apart.any():
                yield digests(batch.filter(pa.array(apart)))
                batch = batch.filter(pa.array(~apart))
            held.append(batch.select([0, 1, 2]))
        table = pa.Table.from_batches(held, pa.schema(list(read)[:3]))
        del held
        names = table.column(0).to_numpy()
        order = np.argsort(names)
        # Most signatures are of one document: only the others are looked at any further.
        alike = names[order][1:] == names[order][:-1]
        order = order[np.append(alike, False) | np.append(False, alike)] if len(names) else order
        names, ids, kinds = names[order], *(table.column(i).to_numpy()[order] for i in (1, 2))
        del table
        order = np.lexsort((ids, kinds & 1, names))
        names, ids, kinds = names[order], ids[order], kinds[order]
        if not len(names):
            return
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(names))))
        several = np.logical_or.reduceat(ids != ids[starts][group], starts) & (kinds[starts] % 2 == 0)
        kept = several[group]
        columns = [pa.array(c) for c in (names[kept], ids[kept], kinds[kept], ids[starts][group][kept])]
        yield pa.record_batch([*columns, *(pa.nulls(int(kept.sum()), field.type) for field in list(out)[4:])], schema=out)

    return signed.repartition("signature").mapInArrow(work, schema)


def _plausible(pairs: DataFrame, digests: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches do not rule them out."""
    sides = [
        digests.select(F.col("doc").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"of_{side}"))
        for side in "ab"
    ]
    sizes = [side.select(side.columns[:2]) for side in sides]
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    sized = pairs.join(sizes[0], "a").join(sizes[1], "b").where(100 * low >= LEAST * high)
    sized = sized.join(sides[0].drop("size_a"), "a").join(sides[1].drop("size_b"), "b")

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            kept = []
            for a, b, total_a, total_b, of_a, of_b in zip(*batch.values(), strict=True):
                if _alike(at_most_shared(of_a, total_a, of_b, total_b), total_a + total_b):
                    kept.append((a, b))
            yield [[a for a, _ in kept], [b for _, b in kept]]

    return map_rows(sized, ["a", "b", "size_a", "size_b", "of_a", "of_b"], "a bigint, b bigint", rows_of).distinct()


def _verified(pairs: DataFrame, digests: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Links among candidate pairs, tested on the words of their texts."""
    pairs = saved(_plausible(pairs, digests), "ngram-pairs")
    ids = saved(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "ngram-ids")
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
    few = ids.count() <= BROADCAST_IDS
    texts = saved(texts.join(F.broadcast(ids) if few else ids, "doc"), "ngram-texts")
    sides = [texts.select(F.col("doc").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab"]

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        known, tokens, words = None, None, None
        for batch in batches:
            links = []
            for a, b, first, second in zip(*batch.values(), strict=True):
                # Pairs of one document mostly follow one another.
                if first != known:
                    known, tokens, words = first, shingle_set(first), None
                others = shingle_set(second)
                shared = len(np.intersect1d(tokens, others, assume_unique=True))
                # Hashes may say too much, never too little; words decide.
                if _alike(shared, len(tokens) + len(others)):
                    words = _shingles(first) if words is None else words
                    if _similar(words, _shingles(second)):
                        links.append((a, b))
            yield [[a for a, _ in links], [b for _, b in links]]

    joined = pairs.join(sides[1], "b").join(sides[0], "a")
    return saved(map_rows(joined, ["a", "b", "text_a", "text_b"], "a bigint, b bigint", rows_of), "ngram-verified")


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every document: size of its set, smallest id that links lead to."""
    docs = docs.where(F.col(id_column).isNotNull())
    shared = _shared(_signed(docs, id_column, text_column))
    with narrow_batches(docs.sparkSession):
        found = saved(shared, "ngram-shared")
    digests = found.where(F.col("kind") == _DIGEST_ROW).select("doc", "size", "low", "high", "sketch")
    shared = found.where(F.col("kind") != _DIGEST_ROW).select("signature", "doc", "kind", "first")
    filled = digests.where("size > 0")
    # Equal sets are linked; of each, the smallest id stands for all from here on.
    same = filled.groupBy("size", "low", "high").agg(F.min("doc").alias("stand_in"))
    equal = filled.join(same, ["size", "low", "high"]).where("doc != stand_in").select("doc", "stand_in").distinct()
    equal = saved(equal, "ngram-equal")
    # An id with several sets stands for itself: the signatures of its other sets are not those of the stand-in.
    sets = filled.groupBy("doc").agg(*[f(F.struct("size", "low", "high")).alias(n) for f, n in ((F.min, "a"), (F.max, "b"))])
    replaced = equal.join(sets.where("a != b").select("doc"), "doc", "left_anti")

    stands = shared.join(replaced, "doc", "left").withColumn("doc", F.coalesce("stand_in", "doc")).drop("stand_in")
    members = saved(stands.where("doc != first").distinct(), "ngram-members")
    verify = lambda pairs: _verified(pairs, digests, docs, id_column, text_column)
    links = verify(members.select(F.col("first").alias("a"), F.col("doc").alias("b")).distinct())
    linked = saved(components(links), "ngram-linked")
    links = linked.select(F.col("id").alias("a"), F.col("component").alias("b"))
    still = _unsettled(members, linked, digests)
    links = links.unionByName(verify(_remaining(still, digests)))
    places = components(links.unionByName(equal.select(F.col("stand_in").alias("a"), F.col("doc").alias("b"))))
    sizes = digests.groupBy("doc").agg(F.max("size").cast("bigint").alias("n_shingles"))
    joined = sizes.join(places, sizes["doc"] == places["id"], "left")
    return joined.select(F.col("doc").alias(id_column), "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def _unsettled(members: DataFrame, linked: DataFrame, digests: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with sizes of document and bucket."""
    placed = members.join(linked, members["doc"] == linked["id"], "left")
    placed = placed.select("signature", "doc", "kind", F.coalesce("component", "doc").alias("component"))
    each = placed.groupBy("signature", "component").agg(F.count("*").alias("n"))
    mixed = each.groupBy("signature").agg(F.sum("n").alias("members"), F.count("*").alias("components"))
    mixed = mixed.where("components > 1").select("signature", "members")
    sizes = digests.groupBy("doc").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    return saved(placed.join(mixed, "signature").join(sizes, "doc"), "ngram-mixed")


def _remaining(still: DataFrame, digests: DataFrame) -> DataFrame:
    """Pairs of a bucket that neither its smallest document nor a component has settled."""
    sides = [
        still.where(F.col("members") <= CROWD).select(
            "signature", *[F.col(name).alias(f"{name}_{end}") for name in ("doc", "kind", "component", "least", "most")]
        )
        for end in "ab"
    ]
    alike = "doc_a < doc_b AND component_a != component_b AND (kind_a & kind_b & 1) = 0"
    alike += f" AND 100 * most_a >= {LEAST} * least_b AND 100 * most_b >= {LEAST} * least_a"
    pairs = sides[0].join(sides[1], "signature").where(alike)
    pairs = pairs.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    return pairs.unionByName(_crowded_pairs(still.where(F.col("members") > CROWD), digests)).distinct()


def _crowded_pairs(crowded: DataFrame, digests: DataFrame) -> DataFrame:
    """Plausible pairs of sets that cannot do without a crowded bucket with the bucket's other members.

    A bucket's asking members are cut into blocks, and so are all its members; each pair of blocks is one group,
    compared within a task as arrays, one group after the other. Only plausible pairs leave it, each from the bucket
    of the smallest signature that the two are known to meet in.
    """
    # The cheapest of its crowded buckets that a set cannot do without, by what it counts them for.
    own = Window.partitionBy("doc", F.expr("kind & 254"))
    lost = F.expr("kind >> 8 & 3")
    costs = crowded.withColumns(
        {
            "lacking": F.sum(lost).over(own) - F.min(F.expr("kind >> 10")).over(own),
            "before": F.sum(lost).over(own.orderBy("members", "signature").rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    asks = (F.coalesce("before", F.lit(0)) < F.col("lacking")).alias("asks")
    rows = saved(costs.select("signature", "doc", "kind", "component", "members", asks), "ngram-crowded")
    asked = rows.groupBy("signature").agg(F.count_if("asks").alias("asking")).where("asking > 0")
    of_doc = digests.select("doc", "size", "sketch")
    rows = rows.join(asked, "signature").join(of_doc, "doc").join(_known(rows), "doc", "left")
    left, right = (F.ceil(F.col(name) / BLOCK).cast("int") for name in ("asking", "members"))
    own_block = lambda n: F.pmod(F.xxhash64("doc"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["signature", "doc", "kind", "component", "size", "sketch"]
    wanted, held = F.col("wanted").alias("known"), F.col("held").alias("known")
    asking = rows.where("asks").select(*columns, F.lit(True).alias("asks"), wanted, own_block(left).alias("x"), every(right).alias("y"))
    others = rows.select(*columns, F.lit(False).alias("asks"), held, own_block(right).alias("y"), every(left).alias("x"))
    dealt = asking.unionByName(others).select("signature", "x", "y", *columns[1:], "asks", "known")
    keys = dealt.columns[:3]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((0, 2), np.int64)
        for group in _groups(batches, len(keys)):
            found = np.concatenate([found, _met(group)])
            if len(found) > 1 << 16:
                # A pair may meet in several buckets: it leaves the task once, or seldom more.
                found = np.unique(found, axis=0)
                if len(found) > 1 << 15:
                    yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
                    found = found[:0]
        found = np.unique(found, axis=0)
        yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    bound_batches(dealt.sparkSession)
    sorted_groups = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_groups.mapInArrow(work, "a bigint, b bigint").distinct()


def _known(rows: DataFrame) -> DataFrame:
    """Of each set, the smallest signatures of crowded buckets that it asks for (wanted) or is in (held).

    Those with a shingle deleted are left out, as two such do not meet in their bucket.
    """
    plain = rows.where("kind & 1 = 0")
    smallest = lambda column: F.slice(F.array_sort(F.collect_set(column)), 1, KNOWN)
    return plain.groupBy("doc").agg(
        smallest(F.when(F.col("asks"), F.col("signature"))).alias("wanted"), smallest(F.col("signature")).alias("held")
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the first columns, of sorted rows."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = pa.concat_tables([rest, table]) if rest is not None else table
        columns = [rest.column(i).to_numpy() for i in range(keys)]
        edges = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        for start, end in zip([0, *edges], edges, strict=False):
            yield rest.slice(start, end - start)
        if len(edges):
            rest = rest.slice(edges[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _met(group: pa.Table) -> np.ndarray:
    """Plausible pairs of a group's asking and other rows that are not left to a smaller signature."""
    signature = group.column(0)[0].as_py()
    docs, kinds, parts, sizes = (group.column(i).to_numpy() for i in range(3, 7))
    sketches, asking = group.column(7).to_pylist(), group.column(8).to_numpy()
    i, j = _plausible_in(np.flatnonzero(asking), np.flatnonzero(~asking), kinds, parts, sizes, sketches)
    if len(i):
        smaller = [frozenset(x for x in own or () if x < signature) for own in group.column(9).to_pylist()]
        here = [smaller[a].isdisjoint(smaller[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
        i, j = i[here], j[here]
    return np.column_stack([np.minimum(docs[i], docs[j]), np.maximum(docs[i], docs[j])])


def _words(side: np.ndarray, held: list[bytes], n: int) -> np.ndarray:
    """Sketches folded to n bytes, filled up with zeros, as rows of 64-bit words."""
    made = np.zeros((len(side), max(8, n)), np.uint8)
    for row, i in zip(made, side, strict=True):
        row[:n] = _folded(held[i], n)
    return made.view(np.uint64)


def _plausible_in(
    rows: np.ndarray, others: np.ndarray, kinds: np.ndarray, parts: np.ndarray, sizes: np.ndarray, held: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and another that differ in component and that sizes and sketches do not rule out."""
    if not len(rows) or not len(others):
        return rows[:0], others[:0]
    n = min(MOST_BYTES, *(len(held[i]) for i in (*rows, *others)))
    a, b = (_words(side, held, n) for side in (rows, others))
    spare_a, spare_b = (
        sizes[side].astype(np.int64) - np.bitwise_count(own).sum(axis=1, dtype=np.int64)
        for side, own in ((rows, a), (others, b))
    )
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # So many rows at a time that the comparison takes some megabytes.
    step = max(1, (8 << 20) // (len(others) * n))
    for start in range(0, len(rows), step):
        some, end = rows[start : start + step], start + step
        shared = np.bitwise_count(a[start:end, None] & b[None]).sum(axis=2, dtype=np.int64)
        shared += np.minimum(spare_a[start:end, None], spare_b[None])
        total = sizes[some][:, None].astype(np.int64) + sizes[others][None]
        open_pairs = (100 * shared >= LEAST * (total - shared)) & (parts[some][:, None] != parts[others][None])
        open_pairs &= (kinds[some][:, None] & kinds[others][None] & 1) == 0
        i, j = np.nonzero(open_pairs)
        found.append((some[i], others[j]))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])
