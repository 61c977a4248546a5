"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first search.

The tree is fitted on at most ``SAMPLE`` vectors (those with the smallest hash of their id): every node is split by k-means
into at most ``FAN`` children until it has at most ``LEAF`` of them. Every vector is then put into the leaf that
the nearest centres lead to. A query walks the tree with a priority queue, always opening the nearest centre that is left, and
lists leaves in the order it reaches them.

How many leaves are visited is calibrated: for ``PROBES`` vectors the true neighbours among all vectors are found in
blocks, and visits are widened until the leaves visited hold at least the share ``RECALL`` of them. A query goes on
beyond that while its leaves hold too few vectors.

Vectors of a leaf meet the queries that visit it in slices of bounded size, on both sides, so a leaf that holds a large share of
all vectors (equal ones cannot be parted) is worked on by many tasks. A slice leaves its nearest vectors only.

Defined results: a vector that is NULL, zero, empty, or holds NULL or non-finite components takes no part, nor does a row
without id or a vector whose length is not the most common one (the smaller, if two are). A row with the
query's own id is never its neighbour; other rows with equal ids are all candidates. Ties go to the smaller id. Fewer than ``k``
candidates are all returned. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Shared, map_batches, smallest_hashes, table
from millrace.session import materialise

SAMPLE = 20_000
FAN, LEAF = 8, 64
PROBES, RECALL = 200, 0.97
SLICE, QUERY_SLICE = 4_096, 1_024


class Tree:
    """Centres of the nodes, where the children of each node begin, and the numbers of the leaves."""

    def __init__(self, vectors: np.ndarray, seed: int = 0):
        random = np.random.default_rng(seed)
        self.centre = [vectors.mean(0)]
        self.child: list[list[int]] = [[]]
        open_nodes = [(0, np.arange(len(vectors)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if len(rows) <= LEAF:
                continue
            centres, label = k_means(vectors[rows], FAN, random)
            if len(centres) < 2:
                continue  # equal vectors
            for k, centre in enumerate(centres):
                self.centre.append(centre)
                self.child.append([])
                self.child[node].append(len(self.centre) - 1)
                open_nodes.append((len(self.centre) - 1, rows[label == k]))
        self.centre = np.array(self.centre)
        self.leaves = [n for n, c in enumerate(self.child) if not c]

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), np.int64)
        inner = [0]
        while inner:
            at = inner.pop()
            rows = np.flatnonzero(node == at)
            if not len(rows) or not self.child[at]:
                continue
            children = np.array(self.child[at])
            node[rows] = children[squared(vectors[rows], self.centre[children]).argmin(1)]
            inner.extend(self.child[at])
        return node

    def visits(self, vector: np.ndarray):
        """Leaves in the order in which best-bin-first search reaches them."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.child[node]:
                yield node
                continue
            children = self.child[node]
            for far, child in zip(((self.centre[children] - vector) ** 2).sum(1).tolist(), children):
                heapq.heappush(queue, (far, child))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of two arrays, fast rather than exact."""
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def k_means(vectors: np.ndarray, count: int, random: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres that have members, and the label of each vector."""
    centres = vectors[random.integers(len(vectors))][None]
    near = squared(vectors, centres)[:, 0].clip(0)
    while len(centres) < count and near.sum() > 1e-9 * max((vectors * vectors).sum(), 1e-300):
        pick = vectors[random.choice(len(vectors), p=near / near.sum())]
        centres = np.concatenate((centres, pick[None]))
        near = np.minimum(near, squared(vectors, pick[None])[:, 0].clip(0))
    label = np.zeros(len(vectors), np.int64)
    for _ in range(rounds):
        label = squared(vectors, centres).argmin(1)
        members = np.bincount(label, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, label, vectors)
        moved = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centres)
        if np.allclose(moved, centres):
            break
        centres = moved
    used, label = np.unique(label, return_inverse=True)
    return centres[used], label


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (as doubles) of the rows that take part."""
    value = F.col("vector")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & finite & F.exists(value, lambda x: x != 0))
    lengths = good.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    return good.where(F.size("vector") == (lengths[0].size if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equally long, whole vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def nearest(ids: np.ndarray, vectors: np.ndarray, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest (ids, exact distances), but for rows with the query's own id."""
    far = ((vectors - query) ** 2).sum(1)
    far[ids == own] = np.inf
    if len(far) > 4 * k:
        some = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
    else:
        some = np.arange(len(far))
    best = some[np.lexsort((ids[some], far[some]))[:k]]
    best = best[np.isfinite(far[best])]
    return ids[best], np.sqrt(far[best])


FOUND = "query_id long, vec_id long, score double"


def _found(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> dict:
    return {
        "query_id": pa.array(np.concatenate([np.zeros(0, np.int64), *[np.full(len(i), q, np.int64) for q, i, _ in parts]])),
        "vec_id": pa.array(np.concatenate([np.zeros(0, np.int64), *[i for _, i, _ in parts]])),
        "score": pa.array(np.concatenate([np.zeros(0), *[s for _, _, s in parts]])),
    }


def ranked(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(rows: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """True neighbours of a few stated queries among all rows, in blocks."""
    sent = Shared(rows.sparkSession, queries)

    def search(batches):
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), matrix(batch.column(1))
            yield pa.RecordBatch.from_pydict(_found([(q, *nearest(ids, vectors, q, v, k)) for q, v in sent.value] if len(ids) else []))

    return ranked(map_batches(rows.select("vec_id", "vector"), search, FOUND), k)


class Index:
    """All vectors with their leaf, the tree, the vectors in each leaf, and the calibrated number of visits."""

    def __init__(self, rows: DataFrame, k: int = 10, sample: int = SAMPLE, recall: float = RECALL):
        self.k = k
        spark = rows.sparkSession
        good = materialise(usable(rows), "vectors")
        drawn = smallest_hashes(good, "vec_id", sample).collect()
        self.empty = not drawn
        if self.empty:
            self.rows = good
            return
        self.tree = Tree(np.array([r.vector for r in drawn]))
        tree = Shared(spark, self.tree)

        def assign(batches):
            for batch in batches:
                leaf = tree.value.leaf_of(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "vector", "leaf"])

        self.rows = materialise(map_batches(good, assign, "vec_id long, vector array<double>, leaf long"), "leaves")
        self.sizes = {r.leaf: r.n for r in self.rows.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row per leaf
        # repeated ids would count as true neighbours of each other
        probes = {r.vec_id: np.array(r.vector) for r in drawn[:PROBES]}
        truth = exact(self.rows, list(probes.items()), k)
        needed = []
        asked = F.broadcast(truth.select("query_id", "vec_id"))  # at most PROBES * k rows
        for row in self.rows.select("vec_id", "leaf").join(asked, "vec_id").select("query_id", "leaf").collect():
            needed.append(next(i for i, leaf in enumerate(self.tree.visits(probes[row.query_id]), 1) if leaf == row.leaf))
        needed.sort()
        self.visits = needed[max(0, int(np.ceil(recall * len(needed))) - 1)] if needed else 1

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score of the nearest vectors found for rows of the index."""
        k = self.k
        if self.empty:
            return queries.sparkSession.range(0).selectExpr("id AS query_id", "0 AS rank", "id AS vec_id", "0D AS score")
        sent = Shared(queries.sparkSession, (self.tree, self.sizes, self.visits))

        def walk(batches):
            tree, sizes, visits = sent.value
            for batch in batches:
                ids, vectors = batch.column(0).to_numpy(), matrix(batch.column(1))
                took, leaves = [], []
                for i in range(len(ids)):
                    held = 0
                    for count, leaf in enumerate(tree.visits(vectors[i]), 1):
                        if sizes.get(leaf):
                            took.append(i)
                            leaves.append(leaf)
                            held += sizes[leaf]
                        if count >= visits and held > k:
                            break
                taken = batch.select([0, 1]).take(pa.array(took, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves, pa.int64())], names=["query_id", "vector", "leaf"])

        asked = materialise(map_batches(queries.select("vec_id", "vector"), walk, "query_id long, vector array<double>, leaf long"), "visits")
        pieces = F.broadcast(  # a row per leaf of the tree
            self.rows.groupBy("leaf").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
            .join(asked.groupBy("leaf").agg(F.ceil(F.count("*") / QUERY_SLICE).cast("int").alias("query_slices")), "leaf")
        )
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        deal = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        right = self.rows.join(pieces, "leaf").select("leaf", deal("vec_id", "slices").alias("slice"), every("query_slices").alias("part"), "vec_id", "vector")
        left = asked.join(pieces, "leaf").select("leaf", every("slices").alias("slice"), deal("query_id", "query_slices").alias("part"), "query_id", "vector")

        def compare(asking: pa.Table, held: pa.Table) -> pa.Table:
            if not asking.num_rows or not held.num_rows:
                return pa.table(_found([]))
            ids, vectors = held["vec_id"].to_numpy(), matrix(held["vector"].combine_chunks())
            wanted = matrix(asking["vector"].combine_chunks())
            return pa.table(_found([(q, *nearest(ids, vectors, q, v, k)) for q, v in zip(asking["query_id"].to_pylist(), wanted)]))

        keys = ("leaf", "slice", "part")
        return ranked(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, FOUND), k)


def op8_neighbours(spark, sf_dir):
    index = Index(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.where(F.col("vec_id") % 100 == 0))
