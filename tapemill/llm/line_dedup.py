"""Removal of multi-line passages that the corpus has already, in DataFrame operations only.

A text is cut into chunks of whole lines. Each line is hashed, and a rolling hash over WINDOW line hashes ends
a chunk where it is 0 modulo SPACING. So where chunks end depends on the last lines only, and a passage is cut
alike wherever it stands, but for its first and last lines. Chunks of two lines or more whose hash occurs more
than once are compared byte by byte, by grouping on their text; all occurrences but the first are removed. The
first is the one in the document with the smallest id, and there the one at the smallest position.

Only hashes are shuffled to find candidates, and texts of candidates alone to compare them; both are
pre-aggregated within each task. A chunk that a third of the corpus has stands in many rows of a join, which
Spark splits, as the other side has it once.

Defined cases: null texts stay null; empty texts and texts of one line stay as they are, and so do chunks of
white space alone; a text that loses all its chunks becomes empty. Rows that share an id count as one document
and keep or lose a chunk together, so repeated rows do not empty each other; rows without an id stay as they
are and do not count. Other columns are passed through, whatever their names; an empty table stays empty.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import saved

WINDOW = 2
SPACING = 3
# Fixed values of the rolling hash.
BASE = 31
MODULUS = 1_000_003


def _once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once per row, also if lambdas below use it for every element."""
    return frame.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint")


def _chunked(texts: DataFrame, text_column: str) -> DataFrame:
    """Adds `_chunks`: the chunks of each text, which joined by line ends give it again."""
    lines = _once(texts, "_lines", F.split(F.col(text_column), "\n", -1))
    hashed = _once(lines, "_hashes", F.transform("_lines", _line_hash))

    def ends_chunk(i: Column) -> Column:
        # The lines before the first count as 0.
        terms = [F.coalesce(F.get("_hashes", i - 1 - k), F.lit(0)) * BASE**k for k in range(WINDOW)]
        return (i == F.array_size("_lines")) | (reduce(add, terms) % MODULUS % SPACING == 0)

    ended = _once(hashed, "_ends", F.filter(F.sequence(F.lit(1), F.array_size("_lines")), ends_chunk))

    def chunk(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("_ends", k - 1), F.lit(0))
        text = F.array_join(F.slice("_lines", start + 1, end - start), "\n")
        return F.struct((end - start).alias("lines"), text.alias("text"))

    return _once(ended, "_chunks", F.transform("_ends", chunk)).drop("_lines", "_hashes", "_ends")


def _occurrences(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Multi-line chunks as (id, position, chunk), and whether the text has the chunk further up."""
    keyed = docs.where(F.col(id_column).isNotNull() & F.contains(F.col(text_column), F.lit("\n")))
    keyed = keyed.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = _once(_chunked(keyed, "text").drop("text"), "texts", F.col("_chunks.text"))
    parts = texts.select("id", "texts", F.posexplode("_chunks").alias("position", "chunk"))
    parts = parts.where((F.col("chunk.lines") > 1) & F.col("chunk.text").rlike(r"\S"))
    again = F.array_position("texts", F.col("chunk.text")) <= F.col("position")
    return parts.select("id", "position", F.col("chunk.text").alias("chunk"), again.alias("again"))


def repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, position, hash) of every occurrence of a repeated chunk but the first."""
    found = _occurrences(docs, id_column, text_column).withColumn("hash", F.xxhash64("chunk"))
    hashes = found.groupBy("hash").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.max(F.col("again").cast("int")).alias("again")
    )
    hashes = hashes.where((F.col("low") != F.col("high")) | (F.col("again") > 0)).select("hash")
    # Written once, as it is read twice and is a small part of what the join has to move.
    candidates = saved(found.join(hashes, "hash"), "repeated-chunks")
    # Equal hashes are no proof: from here on, texts are compared.
    firsts = candidates.groupBy("hash", "chunk").agg(F.min("id").alias("first"))
    later = candidates.join(firsts, ["hash", "chunk"]).where((F.col("id") != F.col("first")) | F.col("again"))
    return later.select("id", "position", "hash")


def remove_repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` without the repeated chunks in their texts, and `removed_chunks`, how many each lost."""
    later = repeated_chunks(docs, id_column, text_column)
    removed = later.groupBy("id").agg(F.collect_set(F.struct("position", "hash")).alias("removed"))
    # Columns are numbered meanwhile, so that none clashes with those used here.
    place = {name: f"in_{i}" for i, name in enumerate(docs.columns)}
    rows = docs.toDF(*place.values()).withColumns(
        {"id": F.col(place[id_column]), "whole": F.col(place[text_column])}
    )
    joined = rows.join(removed, "id", "left")
    # Only texts that lose something are cut up again.
    joined = joined.withColumn("text", F.when(F.col("removed").isNotNull(), F.col("whole")))

    def stays(chunk: Column, position: Column) -> Column:
        place = F.struct(position.alias("position"), F.xxhash64(chunk["text"]).alias("hash"))
        return ~F.array_contains("removed", place)

    kept = _once(_chunked(joined, "text"), "_kept", F.filter("_chunks", stays))
    text = F.coalesce(F.array_join(F.col("_kept.text"), "\n"), F.col("whole"))
    lost = F.coalesce(F.array_size("_chunks") - F.array_size("_kept"), F.lit(0))
    columns = [(text if name == text_column else F.col(place[name])).alias(name) for name in docs.columns]
    return kept.select(*columns, lost.alias("removed_chunks"))
