"""The corpus operators as registered queries with production parameters, and their SQL twins."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapemill.llm import language_id, quality, toxicity
from tapemill.llm.bpe_codec import encode, frequent_words, share_lexicon
from tapemill.llm.common import table
from tapemill.llm.decontamination import benchmark_matches
from tapemill.llm.embedding_dedup import near_vectors
from tapemill.llm.html_extraction import extract_text
from tapemill.llm.lexical_search import top_documents
from tapemill.llm.line_dedup import BASE, MODULUS, SPACING, remove_repeated_chunks
from tapemill.llm.ngram_join import similar_documents
from tapemill.llm.substring_dedup import shared_passages
from tapemill.llm.token_alignment import pair_figures
from tapemill.llm.token_counts import count_tokens

TOKEN_LIMIT = 4096


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document and whether it goes beyond the limit."""
    n_tokens = count_tokens(F.col("text"), public_tokenizers.path("piece_bpe_32k.model"))
    counted = table(spark, sf_dir, "documents").select("doc_id", "text", n_tokens.alias("n_tokens"))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page and its length in code points."""
    extracted = table(spark, sf_dir, "pages").select("page_id", "url", extract_text(F.col("html")).alias("text"))
    return extracted.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document shares with an earlier one, with its place in both."""
    return shared_passages(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    predicted = docs.select("doc_id", language_id.held_out().alias("held_out"), found.alias("found"))
    return predicted.select("doc_id", "held_out", "found.*")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id", toxicity.held_out().alias("held_out"), toxicity.toxicity(docs, model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


_OP6_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT a, b FROM link UNION SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a),
least_id AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links,
  least(e.vec_id, coalesce(least_id.b, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(least_id.b, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least_id ON least_id.a = e.vec_id"""


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    lexicon = share_lexicon(spark, frequent_words(docs), path)
    return encode(docs, path, lexicon, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a benchmark passage, the item, the score and the words that it spans."""
    docs = table(spark, sf_dir, "documents")
    matches = benchmark_matches(docs, table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode(matches).alias("match")).select("doc_id", "match.*")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated multi-line chunks."""
    docs = table(spark, sf_dir, "documents")
    return remove_repeated_chunks(docs).select("doc_id", "text", "removed_chunks")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set and the component that its links lead to."""
    return similar_documents(table(spark, sf_dir, "documents"))


# All pairs that share a shingle, and the smallest id that links lead to.
_OP10_SQL = """
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM word)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reached AS (
  SELECT a, b FROM link UNION SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a)
SELECT d.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles,
  least(d.doc_id, coalesce(min(reached.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN size USING (doc_id) LEFT JOIN reached ON reached.a = d.doc_id
GROUP BY d.doc_id, size.n"""


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Every document that shares a term with an item, scored and ranked.
_OP11_SQL = """
WITH term AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM term GROUP BY doc_id, t),
doc AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM doc),
spread AS (SELECT doc_id, 25 + (75 * n * n_docs) // total AS m FROM doc, corpus),
weight AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY t),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (t) JOIN weight USING (t) JOIN spread USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"), quality.quality(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document's tokens of two tokenizers line up, and how common its pairs are in the corpus."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return pair_figures(table(spark, sf_dir, "documents"), *paths)


# Lines with their hashes, chunks from the rolling hash, and the chunks left after the first occurrence.
_OP9_SQL = f"""
WITH line AS (
  SELECT doc_id, u.line AS line, u.i AS i
  FROM documents, unnest(list_zip(string_split(text, chr(10)),
    range(1, len(string_split(text, chr(10))) + 1))) AS t(u0), LATERAL (SELECT u0[1] AS line, u0[2] AS i) u),
hashed AS (
  SELECT *, CAST(concat('0x', substr(md5(line), 1, 8)) AS BIGINT) AS h FROM line),
rolled AS (
  SELECT *, (h + {BASE} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0))
    % {MODULUS} % {SPACING} = 0 AS ends FROM hashed),
numbered AS (
  SELECT *, coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM rolled),
chunk AS (
  SELECT doc_id, n, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS size
  FROM numbered GROUP BY doc_id, n),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, n) AS rank FROM chunk),
marked AS (
  SELECT *, size > 1 AND regexp_matches(chunk, '\\S') AND rank > 1 AS removed FROM ranked)
SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY n) FILTER (NOT removed), '') AS text,
  CAST(count(*) FILTER (removed) AS INTEGER) AS removed_chunks
FROM marked GROUP BY doc_id"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = (
        op1_token_counts,
        op2_html_extraction,
        op3_substring_dedup,
        op4_language_id,
        op5_toxicity,
        op6_embedding_dedup,
        op7_bpe_codec,
        op8_decontamination,
        op9_line_dedup,
        op10_ngram_join,
        op11_ranked_search,
        op12_quality,
        op13_token_alignment,
    )
    return {query.__name__: query for query in queries}


def llm_oracles() -> dict[str, str]:
    return {
        "op6_embedding_dedup": _OP6_SQL,
        "op9_line_dedup": _OP9_SQL,
        "op10_ngram_join": _OP10_SQL,
        "op11_ranked_search": _OP11_SQL,
    }
