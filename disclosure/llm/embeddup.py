"""Near-duplicate vectors by PCA-ordered tiled comparison.

Two vectors are linked when their labels are equal and their cosine is at least ``least``. Unit
vectors are rotated onto the principal axes of a bounded sample (a rotation changes no cosine),
so that the leading dimensions hold as much of every vector as possible.

*Tiles.* A cosine of ``least`` means a distance of at most ``sqrt(2 - 2 * least)``, so along every
axis linked vectors are no further apart than that. Vectors of a label are ordered along the first
:data:`LEADING` axes into cells of that width; only equal and adjacent cells meet. Cells of more
than :data:`TILE_ROWS` rows are cut into tiles by a hash, and every two tiles that meet are one
bounded group of a shuffle.

*Comparison.* Inside a meeting the products of the leading dimensions are accumulated first. What
the remaining dimensions can add is bounded by the product of the two suffix norms, and a pair
stops as soon as the cosine cannot reach the threshold any more. Pairs that get to the end are
decided by the cosine of the original vectors in double precision.

Equal vectors of a label are one class with a number of copies. No pair becomes a row: a meeting
gives each of its classes a count of links and a spanning forest of the links, so a group of near
copies of any size makes a linear number of rows per meeting. The comparisons themselves are
quadratic in the rows of adjacent cells; no partner is capped or left out.

Defined cases: a row with a null id, label or vector, or whose vector is empty, zero or holds a
null or non-finite component, is linked with nothing (``n_links`` 0, its own component, kept);
vectors of different lengths are never linked; every row counts as a vector of its own, also one
that repeats another's id, and rows that share an id are in one component; an empty table gives
no rows. Other columns are ignored. Equal vectors are told by two 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosure.llm.neardup import connect
from disclosure.llm.stage import written

LEAST = 0.98
LEADING = 2  # axes that order the tiles
TILE_ROWS = 4096
FIT_ROWS = 20_000  # rows of the sample that the axes are fitted on, about
FIRST_DIMS = 8  # dimensions multiplied first; doubled at every further step
SLACK = 1e-9  # for the rounding of bounds; the last comparison has none
# Half of the cells around a cell; the other half meet it from their side.
OFFSETS = [(0, 0), (1, 0), (0, 1), (1, 1), (1, -1)]
_PAIRS = 1 << 18  # pairs worked on at once


def taking_part(vector: Column, label: Column, key: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce(
        key.isNotNull() & label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0.0),
        F.lit(False),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two (which rounds nothing), so that squares stay finite."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1])


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", matrix, matrix))


def principal_axes(rows: DataFrame) -> np.ndarray | None:
    """Axes (columns, by falling variance) of a sample's unit vectors, of its most common length."""
    n = rows.count()
    portion = int(2**32 * min(1.0, FIT_ROWS / max(n, 1)))
    sample = rows.filter(F.pmod(F.col("h1"), F.lit(2**32)) < portion).select("vector").toArrow()
    if not sample.num_rows:
        return None
    column = sample["vector"].combine_chunks()
    lengths = np.asarray(column.value_lengths())
    unit = _scaled(_matrix(column.filter(pa.array(lengths == np.bincount(lengths).argmax()))))
    unit = unit / _norms(unit)[:, None]
    return np.linalg.eigh(unit.T @ unit)[1][:, ::-1].copy()


def rotated(matrix: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """Unit vectors on the axes; as they are if the axes have another number of dimensions."""
    unit = _scaled(matrix)
    unit = unit / _norms(unit)[:, None]
    return unit @ axes if axes is not None and axes.shape[0] == matrix.shape[1] else unit


def cells(classes: DataFrame, axes, width: float) -> DataFrame:
    """``classes`` with ``d`` (dimensions) and the cell ``cx, cy`` along the leading axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            lengths = np.asarray(vectors.value_lengths())
            place = np.zeros((batch.num_rows, LEADING), dtype=np.int32)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                lead = rotated(_matrix(vectors.take(pa.array(at))), axes.value)[:, :LEADING]
                place[at, : lead.shape[1]] = np.floor(lead / width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths.astype(np.int32)), pa.array(place[:, 0]), pa.array(place[:, 1])],
                names=[*batch.schema.names, "d", "cx", "cy"],
            )

    schema = f"h1 long, h2 long, label {classes.schema['label'].dataType.simpleString()}, id long, copies long, "
    return classes.mapInArrow(run, schema + "vector array<double>, d int, cx int, cy int")


def meetings(placed: DataFrame, tile_rows: int) -> DataFrame:
    """Every row at each meeting of its tile: ``label, d, cx, cy, off, x, y`` and its ``side``.

    Which cells have neighbours, and how many tiles they have, is found on one row per cell.
    """
    cell = ["label", "d", "cx", "cy"]
    tiles = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    tiles = written(tiles, "vector-tiles")
    ways = []
    for off, (dx, dy) in enumerate(OFFSETS):
        for side, sign in ((0, 1), (1, -1)) if off else ((0, 1),):
            ways.append(F.struct(F.lit(off).alias("off"), F.lit(side).alias("side"), F.lit(sign * dx).alias("dx"), F.lit(sign * dy).alias("dy")))
    asked = tiles.select(*cell, F.explode(F.array(*ways)).alias("w")).select(
        *cell, "w.off", "w.side", (F.col("cx") + F.col("w.dx")).alias("ox"), (F.col("cy") + F.col("w.dy")).alias("oy")
    )
    there = tiles.select("label", "d", F.col("cx").alias("ox"), F.col("cy").alias("oy"), F.col("tiles").alias("others"))
    around = asked.join(there, ["label", "d", "ox", "oy"]).groupBy(*cell).agg(F.collect_list(F.struct("off", "side", "others")).alias("ways"))
    plan = written(tiles.join(around, cell), "vector-meetings")  # at most nine ways for each cell
    own = F.pmod(F.col("h2"), F.col("tiles")).cast("int")
    met = (
        placed.join(plan, cell)
        .withColumn("own", own)
        .withColumn("w", F.explode("ways"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("w.others") - 1)))
    )
    inside, left = F.col("w.off") == 0, F.col("w.side") == 0
    x = F.when(inside, F.least("own", "other")).when(left, F.col("own")).otherwise(F.col("other"))
    y = F.when(inside, F.greatest("own", "other")).when(left, F.col("other")).otherwise(F.col("own"))
    side = F.when(inside, F.when(F.col("own") > F.col("other"), 1).otherwise(0)).otherwise(F.col("w.side"))
    # A meeting is named by the cell of its left side.
    at = lambda c, i: F.when(left, F.col(c)).otherwise(F.col(c) - F.element_at(F.array(*[F.lit(o[i]) for o in OFFSETS]), F.col("w.off") + 1))
    return met.select(
        "label", "d", at("cx", 0).alias("mx"), at("cy", 1).alias("my"), F.col("w.off").alias("off"), x.alias("x"), y.alias("y"),
        side.alias("side"), "h1", "h2", "id", "copies", "vector",
    )


def similar(left: np.ndarray, right: np.ndarray, axes: np.ndarray | None, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``i`` of ``left`` and ``j`` of ``right`` with a cosine of at least ``least`` (``i < j`` if the
    two are the same rows)."""
    a, b = rotated(left, axes), rotated(right, axes)
    d = a.shape[1]
    steps = []
    size = FIRST_DIMS
    while size < d:
        steps.append(size)
        size *= 2
    rest = lambda m: {s: np.sqrt(np.einsum("ij,ij->i", m[:, s:], m[:, s:])) for s in steps}
    rest_a, rest_b = rest(a), rest(b)
    exact_a, exact_b = _scaled(left), _scaled(right)
    norm_a, norm_b = _norms(exact_a), _norms(exact_b)
    first = steps[0] if steps else d
    found = []
    chunk = max(1, (_PAIRS * 8) // max(1, len(b)))
    for at in range(0, len(a), chunk):
        lead = a[at : at + chunk, :first] @ b[:, :first].T
        bound = lead + np.outer(rest_a[first][at : at + chunk], rest_b[first]) if steps else lead
        if same:
            bound = np.where(np.arange(len(b))[None, :] > np.arange(at, at + len(lead))[:, None], bound, -np.inf)
        ii, jj = np.nonzero(bound >= least - SLACK)
        sums = lead[ii, jj]
        for begin in range(0, len(ii), _PAIRS):
            i, j, total = ii[begin : begin + _PAIRS] + at, jj[begin : begin + _PAIRS], sums[begin : begin + _PAIRS]
            for step, low in enumerate(steps):
                high = steps[step + 1] if step + 1 < len(steps) else d
                total = total + np.einsum("ij,ij->i", a[i, low:high], b[j, low:high])
                most = total + rest_a[high][i] * rest_b[high][j] if high < d else total
                near = most >= least - SLACK
                i, j, total = i[near], j[near], total[near]
            cosine = np.einsum("ij,ij->i", exact_a[i], exact_b[j]) / (norm_a[i] * norm_b[j])
            found.append((i[cosine >= least], j[cosine >= least]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes ``0..n-1`` linked by ``i, j``: the smallest node reachable from each."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def _meet(axes, least: float):
    """Counts of links (``a, b`` the class's hashes, ``links``) and a spanning forest (``a, b`` ids,
    ``links`` null) of one meeting."""

    def run(meeting: pa.Table) -> pa.Table:
        side = meeting["side"].to_numpy()
        order = np.lexsort((meeting["id"].to_numpy(), side))
        meeting = meeting.take(pa.array(order))
        h1, h2, ids, copies = (meeting[name].to_numpy() for name in ("h1", "h2", "id", "copies"))
        matrix = _matrix(meeting["vector"].combine_chunks())
        cut = int((side == 0).sum())
        same = meeting["off"][0].as_py() == 0 and meeting["x"][0].as_py() == meeting["y"][0].as_py()
        shift = 0 if same else cut
        i, j = similar(matrix[:cut], matrix[shift:], axes.value, least, same) if cut and len(matrix) > shift else ((np.zeros(0, np.int64),) * 2)
        j = j + shift
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        linked = np.flatnonzero(links)
        top = smallest_reachable(len(ids), i, j)
        below = np.flatnonzero(top != np.arange(len(ids)))
        n = len(below)
        return pa.table(
            {
                "a": np.concatenate([h1[linked], ids[below]]),
                "b": np.concatenate([h2[linked], ids[top[below]]]),
                "links": pa.array(np.concatenate([links[linked], np.zeros(n)]).astype(np.int64), mask=np.arange(len(linked) + n) >= len(linked)),
            }
        )

    return run


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    ``component_id`` is the smallest id reachable over links; ``kept`` marks the rows that have it.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    named = named.withColumn("part", taking_part(F.col("vector"), F.col("label"), F.col("id")))
    plain = F.transform("vector", lambda x: x + F.lit(0.0))  # one zero only
    hashed = named.withColumn("vector", F.when(F.col("part"), plain)).select(
        "id", "label", "vector", "part", F.xxhash64("label", "vector").alias("h1"), F.xxhash64("vector", F.lit(1), "label").alias("h2")
    )
    classes = written(
        hashed.filter("part")
        .groupBy("h1", "h2")
        .agg(F.first("label").alias("label"), F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    axes = spark.sparkContext.broadcast(principal_axes(classes))  # dimensions squared
    width = max(np.sqrt(max(0.0, 2.0 - 2.0 * least)) * (1 + SLACK), 1e-6)
    placed = written(cells(classes, axes, width), "vector-cells")
    met = meetings(placed, tile_rows)
    found = met.groupBy("label", "d", "mx", "my", "off", "x", "y").applyInArrow(_meet(axes, least), "a long, b long, links long")
    found = written(found, "vector-links")
    totals = found.filter("links IS NOT NULL").groupBy(F.col("a").alias("h1"), F.col("b").alias("h2")).agg(F.sum("links").alias("links"))

    # An id that several classes have joins them.
    rows = written(hashed.select("id", "h1", "h2", "part"), "vector-rows")
    of_class = classes.select("h1", "h2", F.col("id").alias("first"))
    held = rows.filter("part").join(of_class, ["h1", "h2"]).select("id", "first").distinct()
    several = held.groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("hi")).filter("a <> hi")
    shared = held.join(several.select("id", "a"), "id").filter("a <> first").select("a", F.col("first").alias("b"))
    edges = written(found.filter("links IS NULL").select("a", "b").unionByName(shared), "vector-edges")
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = connect(written(ends.select("id", F.col("id").alias("component")), "labels"), edges)

    known = written(
        classes.select("h1", "h2", "id", "copies")
        .join(totals, ["h1", "h2"], "left")
        .join(labels, "id", "left")
        .select(
            "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        ),
        "vector-known",
    )
    joined = rows.filter("part").join(known, ["h1", "h2"])
    alone = rows.filter("NOT part").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    both = joined.select("id", "n_links", "component").unionByName(alone)
    return both.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
