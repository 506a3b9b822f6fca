"""Connected components of undirected links, as Spark jobs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import saved


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(id, component) of every id that occurs in `links` (a, b); the component is its smallest id.

    Large-star and small-star steps take turns: each points a vertex's neighbours at the smallest of them, until
    every vertex points at its component's smallest id. A vertex with very many neighbours is one row of a
    pre-aggregated minimum and many rows of a join that Spark can split. Each round is written to the shared
    folder. Null ids and links of an id with itself are ignored; repeated links count once.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = saved(edges, purpose)
    before = _digest(edges)
    while True:
        edges = saved(_small_star(_large_star(edges)), purpose)
        after = _digest(edges)
        if after == before:
            break
        before = after
    pointed = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return pointed.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a vertex point at the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(smallest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours point at the smallest of these."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
