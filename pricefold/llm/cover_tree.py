"""Operator 9: exact cosine links between vectors by dual traversal of cover trees.

On the unit sphere a cosine of at least c is a distance of at most sqrt(2 - 2c). A node of a cover tree has a centre and
a covering radius; its children are the points of a net of half the radius. For two nodes, the distance of the centres
and the radii bound all distances between their members: the pair is left out if even the smallest is too large, taken
whole if even the largest is small enough, and otherwise replaced by the children of the wider node.

The top of the tree is fitted on a bounded sample and shared by all tasks; every vector is then put under its nearest
top node, and pairs of top nodes that may hold links are traversed in parallel, each in blocks of bounded size. Where a
node has no useful net, since its members lie about as far from each other as from the centre, its pairs are computed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricefold.llm.common import counted, stored
from pricefold.llm.components import components

COSINE = 0.9
SAMPLE = 4096
BLOCK = 8192
_MOST_NODES = 1024
_CHILDREN = 64
_LEAF = 256
_STRIPE = 1024
# Distances are trusted to this much, so that no pair is left out or taken for a rounding error.
_SLACK = 1e-6


def net(points: np.ndarray, radius: float, most: int, first: np.ndarray | None = None) -> np.ndarray | None:
    """Rows of ``points`` more than ``radius`` apart that cover the others; None if there are more than ``most``.

    ``first`` names rows to start from, so the net of one level holds that of the level above.
    """
    least = np.full(len(points), np.inf)
    chosen: list[int] = []
    todo = list(first) if first is not None else [0]
    while True:
        for row in todo:
            chosen.append(int(row))
            least = np.minimum(least, _distances(points, points[row : row + 1])[:, 0])
        farthest = int(least.argmax())
        if least[farthest] <= radius:
            return np.array(chosen)
        if len(chosen) >= most:
            return None
        todo = [farthest]


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (left @ right.T)))


def top_nodes(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres of the deepest level of nested nets with halving radii that has at most ``most`` nodes."""
    chosen, radius = np.zeros(1, int), 2.0
    while radius > _SLACK:
        radius /= 2
        finer = net(sample, radius, most, chosen)
        if finer is None:
            break
        chosen = finer
    return sample[chosen]


class Node:
    """Rows of a matrix of unit vectors, with a centre and the radius that covers them."""

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: np.ndarray):
        self.points, self.rows, self.centre = points, rows, centre
        self.radius = float(_distances(points[rows], centre[None])[:, 0].max()) + _SLACK
        self._children: list[Node] | None = None

    def children(self) -> list[Node]:
        """Nodes of a net of half the radius; none if the node is small or the net would be wide."""
        if self._children is None:
            self._children = []
            if len(self.rows) > _LEAF and self.radius > 4 * _SLACK:
                own = self.points[self.rows]
                nearest = int(_distances(own, self.centre[None])[:, 0].argmin())
                chosen = net(own, self.radius / 2, _CHILDREN, np.array([nearest]))
                if chosen is not None and len(chosen) > 1:
                    home = (own @ own[chosen].T).argmax(axis=1)
                    self._children = [
                        Node(self.points, self.rows[home == place], own[row]) for place, row in enumerate(chosen)
                        if (home == place).any()
                    ]
        return self._children


class Links:
    """Counts of links by row, and links that tie together all rows that have any."""

    def __init__(self, weights: list[np.ndarray], cosine: float):
        self.weights, self.cosine = weights, cosine
        self.counts = [np.zeros(len(weight), np.int64) for weight in weights]
        self.ties: list[np.ndarray] = []

    def whole(self, a: int, left: np.ndarray, b: int, right: np.ndarray) -> None:
        """Every row of one set is linked with every row of the other."""
        self.counts[a][left] += int(self.weights[b][right].sum())
        self.counts[b][right] += int(self.weights[a][left].sum())
        self._tie(a, left, b, right[:1])
        self._tie(b, right, a, left[:1])

    def among(self, a: int, rows: np.ndarray) -> None:
        """The rows of one set are all linked with each other."""
        self.counts[a][rows] += int(self.weights[a][rows].sum()) - self.weights[a][rows]
        self._tie(a, rows[1:], a, rows[:1])

    def computed(self, a: int, left: np.ndarray, b: int, right: np.ndarray, points: list, same: bool) -> None:
        """Links between two sets by their cosines; with ``same`` they are one set, each pair seen from both sides."""
        for start in range(0, len(left), _STRIPE):
            rows = left[start : start + _STRIPE]
            near = points[a][rows] @ points[b][right].T >= self.cosine
            if same:
                near[np.arange(len(rows)), np.arange(start, start + len(rows))] = False
            linked, others = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(linked):
                continue
            near, rows, columns = near[np.ix_(linked, others)], rows[linked], right[others]
            self.counts[a][rows] += near @ self.weights[b][columns]
            if not same:
                self.counts[b][columns] += self.weights[a][rows] @ near
            self._forest(a, rows, b, columns, near)

    def _forest(self, a: int, rows: np.ndarray, b: int, columns: np.ndarray, near: np.ndarray) -> None:
        """Tie each row and column to the first row of its component, which spreads along the links."""
        first = np.arange(len(rows))
        while True:
            reached = np.where(near, first[:, None], len(rows)).min(axis=0)
            spread = np.minimum(first, np.where(near, reached[None, :], len(rows)).min(axis=1))
            if (spread == first).all():
                break
            first = spread
        self._tie(a, rows, a, rows[first])
        self._tie(b, columns, a, rows[reached])

    def _tie(self, a: int, left: np.ndarray, b: int, right: np.ndarray) -> None:
        if len(left) and len(right):
            sides = np.empty((len(left), 4), np.int64)
            sides[:, 0], sides[:, 1], sides[:, 2], sides[:, 3] = a, left, b, right
            self.ties.append(sides)


def traverse(points: list[np.ndarray], weights: list[np.ndarray], cosine: float) -> Links:
    """Links within one set of unit vectors, or between two."""
    links = Links(weights, cosine)
    limit = math.sqrt(2.0 - 2.0 * cosine)
    roots = [Node(each, np.arange(len(each)), each[0]) for each in points if len(each)]
    if len(roots) < len(points) or not roots:
        return links
    last = len(points) - 1
    todo = [(roots[0], roots[-1])]
    while todo:
        left, right = todo.pop()
        if left is right and last == 0:
            if 2 * left.radius <= limit - _SLACK:
                links.among(0, left.rows)
            elif children := left.children():
                todo += [(x, y) for place, x in enumerate(children) for y in children[place:]]
            else:
                links.computed(0, left.rows, 0, left.rows, points, same=True)
            continue
        apart = float(_distances(left.centre[None], right.centre[None])[0, 0])
        if apart - left.radius - right.radius > limit + _SLACK:
            continue
        if apart + left.radius + right.radius <= limit - _SLACK:
            links.whole(0, left.rows, last, right.rows)
            continue
        wide, other = (left, right) if left.radius >= right.radius else (right, left)
        split = wide if wide.children() else other
        if not split.children():
            links.computed(0, left.rows, last, right.rows, points, same=False)
        elif split is left:
            todo += [(child, right) for child in left.children()]
        else:
            todo += [(left, child) for child in right.children()]
    return links


def _usable(vector: str) -> F.Column:
    """True for a vector without null or non-finite components that is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def linked_vectors(
    vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, block: int = BLOCK,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors with a cosine of at least ``cosine``, in double precision, are linked, whatever else their rows say.
    ``n_links`` counts the other rows that a row is linked with, ``component_id`` is the smallest id that it reaches, and
    ``kept`` marks the rows that have it. Vectors that are null, empty, zero or have null or non-finite components are
    linked with nothing, as are vectors of different lengths. Rows without an id link like others; a component of such
    rows only has a null id and none kept.

    Rows with equal vectors are one class with a weight, found by an aggregation. ``sample`` bounds the vectors that the
    top of the tree is fitted on; all classes are traversed. Tasks hold two blocks of about ``block`` vectors, and write
    counts and ties, whose number is linear in the vectors; pairs are never written.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.monotonically_increasing_id().alias("seen"), F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    rows = stored(rows.withColumn("usable", F.coalesce(_usable("vector"), F.lit(False))), "vectors")
    usable = rows.where("usable")
    classes = usable.groupBy("vector").agg(F.min("seen").alias("cls"), F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    classes = stored(classes, "vector-classes")
    sizes = [row[0] for row in classes.select(F.size("vector")).distinct().collect()]
    found = None
    for size in sorted(sizes):
        part = classes.where(F.size("vector") == size) if len(sizes) > 1 else classes
        links = _links(part, cosine, sample, block)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found, number = counted(found, "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"), number)
    told = classes.join(roots.withColumnRenamed("vertex", "cls"), "cls", "left").join(counts, "cls", "left")
    told = told.withColumn("root", F.coalesce("root", "cls"))
    least = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = told.join(least, "root").select(
        F.col("vector").alias("_vector"), "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n")
    )
    result = rows.join(told, F.col("usable") & (F.col("vector") == F.col("_vector")), "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _links(classes: DataFrame, cosine: float, sample: int, block: int) -> DataFrame:
    """Counts (a, null, n) and ties (a, b, 0) of the classes, from all pairs of top nodes that may hold links."""
    spark = classes.sparkSession
    total = classes.count()
    share = min(1.0, sample / max(1, total))
    order = F.shiftrightunsigned(F.xxhash64("cls"), 1)
    drawn = classes.where(order < int(share * ((1 << 63) - 1))).select("vector") if share < 1 else classes.select("vector")
    points = np.array([row[0] for row in drawn.collect()], float)
    if not len(points):
        points = np.array([row[0] for row in classes.select("vector").take(1)], float)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    blocks = -(-total // block)
    centres = spark.sparkContext.broadcast(top_nodes(points, min(_MOST_NODES, max(1, 4 * blocks))))
    limit = math.sqrt(2.0 - 2.0 * cosine)

    def unit(batch: pa.RecordBatch) -> np.ndarray:
        values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        scaled = values / np.abs(values).max(axis=1, keepdims=True)
        return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = _distances(unit(batch), centres.value)
            home = apart.argmin(axis=1)
            yield pa.RecordBatch.from_pydict({
                "cls": batch.column("cls"), "home": pa.array(home.astype(np.int32)),
                "apart": pa.array(apart[np.arange(len(home)), home]),
            })

    homes = classes.select("cls", "vector").mapInArrow(placed, "cls long, home int, apart double")
    nodes = {
        row["home"]: (row["rows"], row["radius"] + _SLACK)
        for row in homes.groupBy("home").agg(F.count("*").alias("rows"), F.max("apart").alias("radius")).collect()
    }
    parts = {home: -(-rows // block) for home, (rows, _) in nodes.items()}
    numbers, count = {}, 0
    for home in sorted(parts):
        numbers[home], count = count, count + parts[home]
    radii = np.full(len(centres.value), -np.inf)
    for home, (_, radius) in nodes.items():
        radii[home] = radius

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send each vector to its own block and to the blocks of the pairs that it may have a link in."""
        between = _distances(centres.value, centres.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                apart = _distances(unit(batch), centres.value)
                home = apart.argmin(axis=1)
                near = apart <= radii[None, :] + limit + _SLACK
                near &= between[home] <= radii[home][:, None] + radii[None, :] + limit + _SLACK
                rows, pairs, sides = [], [], []
                part = batch.column("spread").to_numpy()
                for row in range(batch.num_rows):
                    own = numbers[home[row]] + int(part[row] % parts[home[row]])
                    others = [
                        numbers[node] + place for node in np.flatnonzero(near[row]).tolist() for place in range(parts[node])
                    ]
                    for other in {own, *others}:
                        rows.append(row)
                        pairs.append(min(own, other) * count + max(own, other))
                        sides.append(int(own > other))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs, pa.int64()), pa.array(sides, pa.int32()),
                     *[batch.column(name).take(pa.array(rows, pa.int64())) for name in ("cls", "weight", "vector")]],
                    names=["pair", "side", "cls", "weight", "vector"],
                )

    def walked(key: tuple, held: pa.Table) -> pa.Table:
        batch = held.combine_chunks().to_batches()[0]
        ids, weight, side = (batch.column(name).to_numpy() for name in ("cls", "weight", "side"))
        vectors = unit(batch)
        one_block = key[0].as_py() // count == key[0].as_py() % count
        chosen = [np.arange(len(ids))] if one_block else [np.flatnonzero(side == which) for which in (0, 1)]
        links = traverse([vectors[rows] for rows in chosen], [weight[rows] for rows in chosen], cosine)
        parts = []
        for rows, counts in zip(chosen, links.counts):
            linked = counts > 0
            parts.append(told(ids[rows[linked]], None, counts[linked]))
        owned = [ids[rows] for rows in chosen]
        for ties in links.ties:
            ends = [owned[int(ties[0, at])][ties[:, at + 1]] for at in (0, 2)]
            parts.append(told(ends[0], ends[1], np.zeros(len(ties), np.int64)))
        return pa.Table.from_batches(parts)

    def told(a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
        other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), other, pa.array(n, pa.int64())], names=["a", "b", "n"])

    spread = classes.select("cls", "weight", "vector", F.shiftrightunsigned(F.xxhash64("cls"), 8).alias("spread"))
    sent = spread.mapInArrow(dealt, "pair long, side int, cls long, weight long, vector array<double>")
    return sent.groupBy("pair").applyInArrow(walked, "a long, b long, n long")
