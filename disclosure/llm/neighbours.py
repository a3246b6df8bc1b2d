"""Approximate nearest neighbours with a forest of random-projection trees.

A tree splits the unit vectors at each node by their projection on the line through two random
sample vectors, at the sample's median. The trees are fitted on a bounded sample of at most about
``FIT_ROWS`` rows; every row is indexed, by its leaf in each tree. A query walks all trees
through one shared priority queue: leaves come out in order of the summed squared distances to
the splits that the walk crossed, whichever tree they belong to, until they hold ``share`` times
as many rows as there are (a row counts once per tree). The candidates of those leaves are
reranked by exact cosine in double precision.

How large ``share`` must be depends on the vectors: clustered ones need little, independent
directions (as in the test tables) nearly all. The default is set by recall against brute force.

Equal vectors are collapsed before indexing: of each, only the ``k + 1`` smallest ids can be
among the nearest ``k`` of any query, so nothing is lost and a large group of copies cannot fill
a leaf. Leaves of more than ``CELL_ROWS`` rows are dealt out as several cells. A task holds one
cell's rows and streams the cell's queries past them, so its memory is bounded; each vector is
shuffled once per tree, whatever the number of queries. Leaves are as many as the rows ask for, up
to what the sample can tell apart (``fit_rows`` is an argument); beyond, they are cut into cells.

Defined cases: a vector that is null, zero, of another dimension than most of the sample, or
that holds a null or non-finite component takes no part, nor does a null id; ties go to the
smaller id; fewer candidates than ``k`` are all returned; rows that share an id are one
candidate with its best vector, and every one of them queries; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosure.llm.stage import written

K = 5
TREES = 4
SHARE = 1.2
LEAF_ROWS = 400
FIT_ROWS = 20_000
FIT_LEAF = 8  # least sample rows in a leaf: with FIT_ROWS, up to 2,048 leaves in a tree
CELL_ROWS = 20_000
SEED = 7


@dataclass
class Forest:
    """Per tree, in heap order: directions (nodes x dim) and thresholds."""

    depth: int
    directions: list[np.ndarray]
    thresholds: list[np.ndarray]

    def margins(self, unit: np.ndarray) -> list[np.ndarray]:
        return [unit @ d.T - t for d, t in zip(self.directions, self.thresholds)]

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree."""
        out = np.zeros((len(unit), len(self.directions)), dtype=np.int32)
        rows = np.arange(len(unit))
        for tree, margin in enumerate(self.margins(unit)):
            node = np.zeros(len(unit), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (margin[rows, node] >= 0)
            out[:, tree] = node - (2**self.depth - 1)
        return out

    def search(self, unit: np.ndarray, sizes: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query row, tree and leaf of everything that is visited. ``sizes``: rows by tree, leaf."""
        margins = self.margins(unit)
        first_leaf = 2**self.depth - 1
        rows, trees, leaves = [], [], []
        for row in range(len(unit)):
            queue = [(0.0, tree, 0) for tree in range(len(margins))]
            seen = 0
            while queue and seen < enough:
                cost, tree, node = heapq.heappop(queue)
                while node < first_leaf:
                    margin = margins[tree][row, node]
                    side = 1 if margin >= 0 else 0
                    heapq.heappush(queue, (cost + margin * margin, tree, 2 * node + 2 - side))
                    node = 2 * node + 1 + side
                size = sizes[tree, node - first_leaf]
                if size:
                    seen += size
                    rows.append(row)
                    trees.append(tree)
                    leaves.append(node - first_leaf)
        return np.array(rows, dtype=np.int64), np.array(trees, dtype=np.int32), np.array(leaves, dtype=np.int32)


def fit(sample: np.ndarray, n_rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = SEED) -> Forest:
    """A forest for ``n_rows`` rows from the unit vectors of a sample."""
    deep = int(np.log2(max(1.0, n_rows / leaf_rows)))
    depth = max(0, min(deep, int(np.log2(max(1.0, len(sample) / FIT_LEAF)))))
    rng = np.random.default_rng(seed)
    nodes = 2**depth - 1
    directions, thresholds = [], []
    for _ in range(trees):
        lines = np.zeros((nodes, sample.shape[1]))
        middles = np.zeros(nodes)
        parts = {0: np.arange(len(sample))}
        for node in range(nodes):
            part = parts.pop(node)
            pick = rng.choice(part, 2) if len(part) else np.zeros(2, np.int64)
            line = sample[pick[0]] - sample[pick[1]] if len(part) else np.zeros(sample.shape[1])
            if not line.any():
                line = rng.normal(size=sample.shape[1])
            lines[node] = line / np.linalg.norm(line)
            along = sample[part] @ lines[node]
            middles[node] = np.median(along) if len(part) else 0.0
            parts[2 * node + 1], parts[2 * node + 2] = part[along < middles[node]], part[along >= middles[node]]
        directions.append(lines)
        thresholds.append(middles)
    return Forest(depth, directions, thresholds)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` (array of double) of the rows that take part."""
    finite = F.forall(
        "vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    return (
        vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .filter(finite & F.exists("vector", lambda x: x != 0.0))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _unit(matrix: np.ndarray) -> np.ndarray:
    if not len(matrix):
        return matrix
    scaled = _scaled(matrix)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two (which rounds nothing), so that squares stay finite."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1])


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of every pair, each summed in the same order, so that equal vectors tie exactly."""
    a, b = _scaled(queries), _scaled(vectors)
    norms = [np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (a, b)]
    return np.clip(np.einsum("ij,kj->ik", a, b) / (norms[0][:, None] * norms[1][None, :]), -1.0, 1.0)


def neighbours(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    share: float = SHARE,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``k`` found of every row where ``is_query``.

    ``is_query`` is a condition on ``id``, the row's id. Every row but those with the query's
    own id is a candidate.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    n = rows.count()
    portion = int(2**32 * min(1.0, fit_rows / max(n, 1)))
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(2**32)) < portion).select("vector").toArrow().combine_chunks()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample.num_rows:
        if n:  # fewer rows than the sample's hash let through
            sample = rows.select("vector").limit(fit_rows).toArrow().combine_chunks()
        else:
            return spark.createDataFrame([], schema)
    column = sample["vector"].combine_chunks()
    lengths = np.asarray(column.value_lengths())
    dim = int(np.bincount(lengths).argmax())
    rows = rows.filter(F.size("vector") == dim)
    forest = fit(_unit(_matrix(column.filter(pa.array(lengths == dim)))), n, trees, leaf_rows)
    model = spark.sparkContext.broadcast(forest)

    same = Window.partitionBy("vector").orderBy("id")
    distinct = rows.distinct().withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).drop("nth")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = model.value.leaves(_unit(_matrix(batch.column("vector"))))
            flat = pa.array(leaves.reshape(-1))
            ends = pa.array(np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.ListArray.from_arrays(ends, flat)],
                names=["id", "vector", "leaves"],
            )

    indexed = distinct.mapInArrow(assign, "id long, vector array<double>, leaves array<int>")
    indexed = written(indexed, "indexed")
    placed = indexed.select("id", "vector", F.posexplode("leaves").alias("tree", "leaf"))
    counted = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the forest
    sizes = np.zeros((trees, 2**forest.depth), dtype=np.int64)
    for r in counted:
        sizes[r["tree"], r["leaf"]] = r["n"]
    enough = share * float(sizes[0].sum())
    shared_sizes = spark.sparkContext.broadcast(sizes)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                unit = _unit(_matrix(part.column("vector")))
                row, tree, leaf = model.value.search(unit, shared_sizes.value, enough)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)), part.column("vector").take(pa.array(row)), pa.array(tree), pa.array(leaf)],
                    names=["id", "vector", "tree", "leaf"],
                )

    queries = rows.filter(is_query)
    visited = queries.mapInArrow(walk, "id long, vector array<double>, tree int, leaf int")
    # Cells: a leaf's rows in blocks of bounded size. Every vector goes to one cell of each tree, and
    # a query to the cells of the leaves it visits; in a cell the rows come first.
    row_blocks = spark.createDataFrame(
        [(t, x, int(-(-sizes[t, x] // CELL_ROWS))) for t in range(trees) for x in range(sizes.shape[1]) if sizes[t, x]],
        "tree int, leaf int, blocks int",
    )
    names = ["tree", "leaf", "block"]
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")
    cells = placed.join(F.broadcast(row_blocks), ["tree", "leaf"]).select("tree", "leaf", own, F.lit(0).alias("kind"), "id", "vector")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = visited.join(F.broadcast(row_blocks), ["tree", "leaf"]).select("tree", "leaf", every, F.lit(1).alias("kind"), "id", "vector")
    met = cells.unionByName(asked).repartition(*names).sortWithinPartitions(*names, "kind")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, parts, matrix = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(name)) for name in (*names, "kind")])
            cuts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))
            for begin, end in zip(cuts, np.append(cuts[1:], batch.num_rows)):
                now = tuple(key[:3, begin])
                if now != cell:
                    cell, ids, parts, matrix = now, [], [], None
                part_ids = np.asarray(batch.column("id"))[begin:end]
                vectors = _matrix(batch.column("vector").slice(begin, end - begin))
                if key[3, begin] == 0:
                    ids.append(part_ids)
                    parts.append(vectors)
                    continue
                if not parts:
                    continue
                if matrix is None:
                    row_ids, matrix = np.concatenate(ids), np.concatenate(parts)
                    order = np.argsort(row_ids, kind="stable")  # equal scores keep the smaller id first
                    row_ids, matrix = row_ids[order], matrix[order]
                for at in range(0, len(part_ids), 256):
                    asking = part_ids[at : at + 256]
                    scores = cosines(vectors[at : at + 256], matrix)
                    scores[asking[:, None] == row_ids[None, :]] = -np.inf
                    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                    top = np.take_along_axis(scores, best, axis=1)
                    real = np.isfinite(top)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(asking, real.sum(axis=1))), pa.array(row_ids[best][real]), pa.array(top[real])],
                        names=["query_id", "vec_id", "score"],
                    )

    found = met.mapInArrow(rerank, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
