"""Approximate nearest neighbours with a forest of random-projection trees.

Trees split a bounded sample at the median of random directions. Every row
falls into one leaf of each tree. A query walks all trees at once through one
priority queue, nearest branches first, and visits as many leaves as a
calibration on the sample needed for the wanted recall. Rows and queries meet
per leaf, where distances are computed exactly on the original vectors and
only the k best per query leave; those of all leaves are merged. A row that a
query meets in several trees is measured in the first of them only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_key, stored

K = 10
TREES = 6
LEAF = 96  # sample vectors in a leaf at most
SAMPLE = 20_000
RECALL = 0.95  # wanted on the sample; a larger table only brings neighbours closer
CALIBRATION = 200
COPY_SALTS = 16
CELL_ROWS, CELL_QUERIES = 4096, 1024


@dataclass
class Forest:
    """All trees in flat arrays; a child below 0 is leaf ``-child - 1``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int

    def leaf_of(self, x: np.ndarray, root: int) -> np.ndarray:
        node = np.full(len(x), root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            side = np.einsum("ij,ij->i", x[inner], self.normals[at]) > self.offsets[at]
            node[inner] = self.children[at, side.astype(int)]
        return -node - 1

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves of all trees, most promising first: a branch is worth its
        smallest margin on the way, negative past a split's other side."""
        margin = self.normals @ q - self.offsets if len(self.normals) else np.zeros(0)
        queue = [(-np.inf, root) for root in self.roots]
        heapq.heapify(queue)
        while queue:
            cost, node = heapq.heappop(queue)
            while node >= 0:
                m = margin[node]
                near, far = self.children[node, int(m > 0)], self.children[node, int(m <= 0)]
                heapq.heappush(queue, (max(cost, abs(m)), int(far)))
                node = int(near)
            yield -node - 1


def grow_forest(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots, leaves = [], [], [], [], 0

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            for _ in range(3):  # a direction on which all rows are equal cannot split
                direction = rng.normal(size=sample.shape[1])
                direction /= np.linalg.norm(direction)
                on = sample[rows] @ direction
                cut = np.median(on)
                right = on > cut
                if right.any() and not right.all():
                    at = len(normals)
                    normals.append(direction)
                    offsets.append(cut)
                    children.append([0, 0])
                    children[at] = [grow(rows[~right]), grow(rows[right])]
                    return at
        leaves += 1
        return -leaves

    for _ in range(trees):
        roots.append(grow(np.arange(len(sample))))
    return Forest(np.array(normals).reshape(-1, sample.shape[1]), np.array(offsets),
                  np.array(children, dtype=np.int64).reshape(-1, 2), roots, leaves)


def calibrate(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL, queries: int = CALIBRATION) -> int:
    """Leaves to visit so that sample queries find ``recall`` of their k nearest."""
    members: list[list[int]] = [[] for _ in range(forest.leaves)]
    for root in forest.roots:
        for row, at in enumerate(forest.leaf_of(sample, root)):
            members[at].append(row)
    found = np.zeros(forest.leaves)
    picks = np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int)
    total = 0
    for row in picks:
        d = ((sample - sample[row]) ** 2).sum(axis=1)
        d[row] = np.inf
        near = set(np.argsort(d, kind="stable")[:min(k, len(sample) - 1)].tolist())
        total += len(near)
        for step, at in enumerate(forest.visit(sample[row])):
            hit = near.intersection(members[at])
            found[step] += len(hit)
            near -= hit
            if not near:
                break
    if total == 0:
        return forest.leaves
    return int(min(forest.leaves, np.searchsorted(np.cumsum(found) / total, recall) + 1))


def _matrix(vectors) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _row_leaves(forest: Forest):
    """Each row once per tree, with its leaf there and in the trees before."""
    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = _matrix(frame["vector"])
                at = np.column_stack([forest.leaf_of(x, root) for root in forest.roots]).astype(np.int32)
                for tree in range(at.shape[1]):
                    yield frame.assign(leaf=at[:, tree], leaves=[row.tobytes() for row in at[:, :tree]])

    return leaves


def _query_leaves(forest: Forest, visits: int):
    """Each query once per leaf to visit, with all these leaves as bits."""
    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for vec_id, vector in zip(frame["vec_id"], frame["vector"], strict=True):
                walk = forest.visit(np.asarray(vector, dtype=np.float64))
                hit = [at for at, _ in zip(walk, range(visits), strict=False)]
                bits = np.zeros(forest.leaves, dtype=bool)
                bits[hit] = True
                yield pd.DataFrame({"vec_id": vec_id, "vector": [vector] * len(hit), "leaf": hit,
                                    "leaves": [np.packbits(bits).tobytes()] * len(hit)})

    return leaves


def _nearest(k: int):
    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            vectors, row_ids = _matrix(rows["vector"]), rows["vec_id"].to_numpy()
            # All rows of a leaf are of one tree, so they name equally many leaves.
            before = np.frombuffer(b"".join(rows["leaves"]), dtype=np.int32).reshape(len(rows), -1)
            for q_id, q, bits in zip(queries["vec_id"], queries["vector"], queries["leaves"], strict=True):
                visited = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))
                new = ~visited[before].any(axis=1) & (row_ids != q_id)
                x, ids = vectors[new], row_ids[new]
                d = np.sqrt(((x - np.asarray(q, dtype=np.float64)) ** 2).sum(axis=1))
                near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                near = near[np.lexsort((ids[near], d[near]))][:k]
                out += [(int(q_id), int(ids[i]), float(d[i])) for i in near]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) \
            .astype({"query_id": np.int64, "vec_id": np.int64, "score": np.float64})

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of rows that take part: an id, no null or non-finite
    component, not all zero, and the commonest length (ties: the shorter)."""
    v = F.col("embedding")
    rows = vectors.select("vec_id", v.alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (size.d if size else -1))


def nearest_neighbours(vectors: DataFrame, is_query, k: int = K, trees: int = TREES, leaf: int = LEAF,
                       sample_rows: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows found for each query row of ``vectors``
    (``vec_id, embedding``): ``query_id, rank, vec_id, score``, score being the
    exact Euclidean distance, ties to the smaller vec_id.

    ``is_query`` is a condition on ``vec_id``. All other usable rows are
    candidates, never the query's own id. Of many copies of one vector only the
    k + 1 smallest ids (per hash salt) can be among anyone's k nearest, so only
    those go on: a vector that a third of all rows share costs no more than any
    other. Repeated rows count once; one id with several vectors counts with
    its nearest, and queries with the smallest. An empty table gives an empty
    result. Other columns are not read. The forest is fitted on at most
    ``sample_rows`` rows (smallest hash keys).
    """
    schema = "query_id long, rank int, vec_id long, score double"
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(COPY_SALTS))
    copies = Window.partitionBy("vector", "salt").orderBy("vec_id")
    rows = usable(vectors).withColumn("salt", salt).withColumn("nth", F.dense_rank().over(copies)) \
        .where(F.col("nth") <= k + 1).dropDuplicates(["vector", "salt", "vec_id"]).select("vec_id", "vector")
    rows = stored(rows, "op1-vectors")
    # A few copies of one vector are enough to fit on, so the sample is distinct.
    sample = rows.select("vector", hash_key(F.lit("sample"), F.col("vec_id")).alias("key")) \
        .orderBy("key").limit(sample_rows).toPandas()
    if not len(sample):
        return vectors.sparkSession.createDataFrame([], schema)
    x = np.unique(_matrix(sample["vector"]), axis=0)
    x = x[np.random.default_rng(3).permutation(len(x))]
    forest = grow_forest(x, trees, leaf)
    visits = calibrate(forest, x, k, recall)

    kind = rows.schema["vector"].dataType.simpleString()
    schema_in = f"vec_id long, vector {kind}, leaf long, leaves binary"
    base = usable(vectors).where(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stored(base.mapInPandas(_query_leaves(forest, visits), schema_in), "op1-queries")
    placed = rows.mapInPandas(_row_leaves(forest), schema_in)
    # One row per leaf of the forest: bounded by the sample, not by the table.
    cells = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")) \
        .join(asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("q")), "leaf") \
        .select("leaf", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("rs"),
                F.ceil(F.col("q") / CELL_QUERIES).cast("int").alias("qs"))
    cells = F.broadcast(stored(cells, "op1-cells"))
    own = lambda count: F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = placed.join(cells, "leaf").withColumn("r", own("rs")).withColumn("c", every("qs"))
    right = asked.join(cells, "leaf").withColumn("c", own("qs")).withColumn("r", every("rs"))
    keys = ["leaf", "r", "c"]
    grouped = [side.select(*[F.col(c).alias(c) for c in (*keys, "vec_id", "vector", "leaves")]).groupBy(*keys)
               for side in (left, right)]
    found = grouped[0].cogroup(grouped[1]).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
