"""Exact near-duplicate links among vectors of one label, by dual traversal of cover trees.

Vectors are scaled to length 1 in double precision, where a cosine of LEAST is a distance. A label with many
vectors is dealt out to LEADERS of its own, the top of its tree; each leader's vectors, cut by a hash into
blocks of about BLOCK, are one node. A node's tree has nested levels with halving radii: the centres of a level
are those of the level above and some more, and each vector is within a level's radius of its centre. Two nodes
are compared only if their balls come within the distance; their trees are then descended together, level by
level, and pairs of centres whose covering radii rule out a pair are dropped with all that is below them. Pairs
of vectors that are left are decided by their cosine. Nothing is approximated: where the vectors leave nothing
to prune, as unrelated ones in many dimensions do, all pairs of a label's blocks are computed.

A pair of nodes yields for each vector how many others it is linked to and one link into its local component,
so a large group of copies yields rows in proportion to its size.

Defined cases: vectors that are null, of length 0, or hold null or non-finite components, and vectors without
a label, link with nothing and are their own component; vectors of different dimensions do not link. Rows
without an id are left out. Rows that share an id are one vector, the smallest in order of label and components,
so repeated rows count once. Ids must be integers. Other columns are ignored, so their names cannot clash; an
empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapemill.llm.common import map_rows, saved
from tapemill.llm.graph import components

LEAST = 0.98
BLOCK = 1024
# Of one label, and of all labels together; the latter are a table that all tasks get.
LEADERS = 32
ALL_LEADERS = 4096
# Trees that a task keeps while it goes through its pairs of nodes.
KEPT_TREES = 32
RADII = (2.0, 1.0, 0.5, 0.25, 0.125)
_SLACK = 1e-9


def _reach(least: float) -> float:
    """The distance of unit vectors with this cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * least))) + _SLACK


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """One row (id, label, dims, unit) per vector that can link."""
    one = vectors.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("bigint").alias("id"))
    one = one.agg(F.min(F.struct(F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))).alias("row"))
    wide = one.select("id", "row.label", F.transform("row.vector", lambda x: x.cast("double")).alias("v"))
    wide = wide.where(F.col("label").isNotNull() & F.col("v").isNotNull())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    # Scaled by the largest component first, so that no square overflows or vanishes.
    peak = F.aggregate("v", F.lit(0.0), lambda top, x: F.greatest(top, F.abs(x)))
    sound = wide.where(~bad).withColumn("peak", peak).where("peak > 0")
    scaled = sound.withColumn("v", F.transform("v", lambda x: x / F.col("peak")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    scaled = scaled.withColumn("length", length)
    unit = F.transform("v", lambda x: x / F.col("length"))
    return scaled.select("id", "label", F.size("v").alias("dims"), unit.alias("unit"))


def _leaders(units: DataFrame) -> dict[tuple, np.ndarray]:
    """Leaders of the labels that have several blocks: vectors far from one another, out of a bounded sample."""
    counts = units.groupBy("label", "dims").count().where(F.col("count") > BLOCK)
    large = counts.orderBy(F.desc("count"), "label", "dims").limit(ALL_LEADERS // LEADERS)
    order = F.row_number().over(Window.partitionBy("label", "dims").orderBy(F.xxhash64("id"), "id"))
    sample = units.join(F.broadcast(large.select("label", "dims")), ["label", "dims"]).withColumn("order", order)
    found: dict[tuple, list] = {}
    for row in sample.where(F.col("order") <= 2 * LEADERS).orderBy("label", "dims", "order").collect():
        found.setdefault((row["label"], row["dims"]), []).append(row["unit"])
    return {key: _spread(np.array(units)) for key, units in found.items()}


def _spread(points: np.ndarray) -> np.ndarray:
    """Farthest-first choice of up to LEADERS points."""
    chosen, far = [0], np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(LEADERS, len(points)) and far.max() > _SLACK:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def _nodes(units: DataFrame, leaders: dict[tuple, np.ndarray]) -> DataFrame:
    """(node, label, dims, ids, points, centre, radius) with the vectors of a node as one block of bytes."""
    shared = units.sparkSession.sparkContext.broadcast(leaders)

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        for batch in batches:
            nearest = []
            for label, dims, unit in zip(batch["label"], batch["dims"], batch["unit"], strict=True):
                own = shared.value.get((label, dims))
                nearest.append(int((own @ np.array(unit)).argmax()) if own is not None else 0)
            yield [batch["id"], batch["label"], batch["dims"], batch["unit"], nearest]

    kind = units.schema["label"].dataType.simpleString()
    schema = f"id bigint, label {kind}, dims int, unit array<double>, leader int"
    dealt = saved(map_rows(units, ["id", "label", "dims", "unit"], schema, rows_of), "vector-leaders")
    cells = dealt.groupBy("label", "dims", "leader").agg(F.ceil(F.count("*") / BLOCK).alias("cuts"))
    cut = dealt.join(cells, ["label", "dims", "leader"])
    cut = cut.withColumn("node", F.concat_ws("/", "label", "dims", "leader", F.pmod(F.xxhash64("id"), "cuts")))

    def block(groups: pa.Table) -> pa.Table:
        points = np.array(groups["unit"].to_pylist())
        ids = np.array(groups["id"].to_pylist(), np.int64)
        order = np.argsort(ids)
        points, ids = points[order], ids[order]
        # The vector nearest to the mean is the centre.
        centre = points[int((points @ points.mean(axis=0)).argmax())]
        radius = float(np.linalg.norm(points - centre, axis=1).max())
        row = {"node": groups["node"][0].as_py(), "label": groups["label"][0].as_py(), "dims": points.shape[1]}
        row |= {"ids": ids.tobytes(), "points": points.tobytes(), "centre": centre.tolist(), "radius": radius}
        return pa.Table.from_pylist([row], schema=out)

    schema = f"node string, label {kind}, dims int, ids binary, points binary, centre array<double>, radius double"
    out = to_arrow_schema(T._parse_datatype_string(schema))
    return saved(cut.select("node", "label", "id", "unit").groupBy("node").applyInArrow(block, schema), "vector-nodes")


class CoverTree:
    """Nested levels of a node's vectors; `levels` has for each the centres and, for each centre, its parent's place."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        centres, owner = np.array([0]), np.zeros(len(points), np.int64)
        self.levels.append((centres, np.array([0])))
        for radius in RADII[1:]:
            centres, parents, owner = self._refined(centres, owner, radius)
            self.levels.append((centres, parents))
        # Below the last level are the vectors themselves.
        self.levels.append((np.arange(len(points)), owner))

    def _refined(self, above: np.ndarray, owner: np.ndarray, radius: float):
        """Centres within `radius` of all vectors of their parent; the parent is the first of its centres."""
        centres, parents, found = [], [], np.zeros(len(owner), np.int64)
        for place, first in enumerate(above):
            left = np.flatnonzero(owner == place)
            centre = first
            while True:
                # Of unit vectors, the cosine tells the distance.
                near = self.points[left] @ self.points[centre] >= 1 - radius * radius / 2
                near[left == centre] = True
                found[left[near]] = len(centres)
                centres.append(centre)
                parents.append(place)
                left = left[~near]
                if not len(left):
                    break
                centre = left[0]
        return np.array(centres), np.array(parents), found


def linked_pairs(a: CoverTree, b: CoverTree, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors of two trees whose cosine is `least` or more."""
    reach = _reach(least)
    open_pairs = np.ones((1, 1), bool)
    for level, (in_a, in_b) in enumerate(zip(a.levels, b.levels, strict=True)):
        if level:
            # Children of the pairs that are still open.
            open_pairs = open_pairs[in_a[1]][:, in_b[1]]
        rows, columns = np.flatnonzero(open_pairs.any(axis=1)), np.flatnonzero(open_pairs.any(axis=0))
        if not len(rows):
            break
        cosines = a.points[in_a[0][rows]] @ b.points[in_b[0][columns]].T
        if level == len(RADII):
            close = cosines >= least
        else:
            # What is below a centre lies within its radius.
            close = np.sqrt(np.maximum(0, 2 - 2 * cosines)) <= reach + 2 * RADII[level]
        kept = np.zeros_like(open_pairs)
        kept[np.ix_(rows, columns)] = open_pairs[np.ix_(rows, columns)] & close
        open_pairs = kept
    return np.nonzero(open_pairs)


def _local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that links lead to, for each of n places."""
    found = np.arange(n)
    while len(a):
        before = found.copy()
        low = np.minimum(found[a], found[b])
        np.minimum.at(found, a, low)
        np.minimum.at(found, b, low)
        found = found[found]
        if (found == before).all():
            break
    return found


def _compared(pairs: DataFrame, least: float) -> DataFrame:
    """(id, n, other) for each vector linked within a pair of nodes; `other` is the smallest of its component."""

    def rows_of(batches: Iterator[dict[str, list]]) -> Iterator[list]:
        trees: dict[str, CoverTree] = {}

        def tree(node: str, points: bytes, dims: int) -> CoverTree:
            # A node stands in several pairs; a few trees are kept.
            found = trees.pop(node, None) or CoverTree(np.frombuffer(points, np.float64).reshape(-1, dims))
            if len(trees) >= KEPT_TREES:
                trees.pop(next(iter(trees)))
            trees[node] = found
            return found

        for batch in batches:
            for dims, node_a, ids_a, points_a, node_b, ids_b, points_b in zip(*batch.values(), strict=True):
                ids = [np.frombuffer(own, np.int64) for own in (ids_a, ids_b)]
                a, b = linked_pairs(tree(node_a, points_a, dims), tree(node_b, points_b, dims), least)
                if node_a == node_b:
                    a, b = a[a < b], b[a < b]
                    names, second = ids[0], b
                else:
                    names, second = np.concatenate(ids), b + len(ids[0])
                counts = np.bincount(np.concatenate([a, second]), minlength=len(names))
                # Names are in order within a node, not across two: the smallest is found by rank.
                rank = np.argsort(np.argsort(names, kind="stable"), kind="stable")
                found = _local_components(len(names), rank[a], rank[second])
                by_rank = np.sort(names)
                linked = np.flatnonzero(counts)
                yield [names[linked].tolist(), counts[linked].tolist(), by_rank[found[rank[linked]]].tolist()]

    columns = ["dims", "node_a", "ids_a", "points_a", "node_b", "ids_b", "points_b"]
    return map_rows(pairs, columns, "id bigint, n bigint, other bigint", rows_of)


def near_vectors(
    vectors: DataFrame,
    least: float = LEAST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector; kept is the smallest of each component."""
    units = saved(usable(vectors, id_column, vector_column, label_column), "vector-units")
    nodes = _nodes(units, _leaders(units))
    balls = nodes.select("node", "label", "dims", "centre", "radius")
    left, right = (balls.select(*[F.col(name).alias(f"{name}_{side}") for name in balls.columns]) for side in "ab")
    same = (F.col("label_a") == F.col("label_b")) & (F.col("dims_a") == F.col("dims_b"))
    apart = F.aggregate(
        F.zip_with("centre_a", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x
    )
    near = F.sqrt(apart) <= F.col("radius_a") + F.col("radius_b") + F.lit(_reach(least) + _SLACK)
    both = left.join(right, same & (F.col("node_a") <= F.col("node_b"))).where(near).select("node_a", "node_b")
    blocks = nodes.select("node", "dims", "ids", "points")
    of_a = blocks.select(F.col("node").alias("node_a"), "dims", F.col("ids").alias("ids_a"), F.col("points").alias("points_a"))
    of_b = blocks.select(F.col("node").alias("node_b"), F.col("ids").alias("ids_b"), F.col("points").alias("points_b"))
    found = saved(_compared(both.join(of_a, "node_a").join(of_b, "node_b"), least), "vector-links")

    counts = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    places = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    ids = vectors.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("bigint").alias("id")).distinct()
    joined = ids.join(counts, "id", "left").join(places, "id", "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
