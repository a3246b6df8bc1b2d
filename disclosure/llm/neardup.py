"""Near-duplicate classes by bottom-k sketches of word shingles.

One hash function orders all shingles; a document keeps its ``k`` smallest (its sketch, or the
whole set if that is smaller). Documents with equal sets are one class, represented by the
smallest id, and only representatives go on.

Candidates come from inverted lists of the kept values. Two sets of similarity 0.8 share at least
:func:`least_overlap` kept values (exactly for sets that fit the sketch, else but for a chance
of about 1e-6), so they also share one of the rarest ``k - overlap + 1`` values of each: only
those are listed, and most documents end up in no list at all. Within a list every member is
paired with one member chosen by hash, a different one in each list, so a group of copies of any
size gives a linear number of pairs and is connected by them. Members that then lie in different
components are compared with each other inside the tasks: a list is cut into blocks, every two
blocks meet in one task, and what comes out is never the pairs: at first the members with an
estimate that may be a link, then, from the full sets of these, a spanning forest of the links.

The union-sketch estimate filters every pair, and the exact Jaccard similarity of the full sets
confirms it: first the few best of each document, then those that still join two components,
then those inside the meetings. Pairs inside one component cannot change it.

The rows are linear in the listed values however large a group is; the comparisons inside the
tasks are quadratic only in the members of one list that are left in different components,
which are alike but below the threshold. With ``k`` at least the largest set's size every step is
exact; with the default, see :data:`LEAST_ESTIMATE`.

Components are found by hooking each onto its smallest neighbour and halving the paths. Nothing
but counts reaches the driver; every step is written to the shared scratch folder.

Defined cases: a text that is null or has no word has an empty set and is linked with nothing; a
text with fewer words than a shingle is one shingle; rows with equal ids are one document with the
largest of their sets, and share its component; a row with a null id is linked with nothing and
kept; an empty table gives no rows. Other columns are ignored. Hashes have 64 bits; equal sets
are told by two of them and their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosure.llm.stage import Scratch, written
from disclosure.llm.text import Words, blocks, lists, mix, span_hashes

SKETCH = 96
SIMILARITY = (80, 100)  # 100 * intersection >= 80 * union
BLOCK_MEMBERS = 1024  # members and shingles of a block of a long list, about
BLOCK_SHINGLES = 1 << 18
BEST = 3  # pairs of each document that are confirmed first
# Least union-sketch estimate, and least share of a sketch that similar sets have in common: a
# pair of similarity 0.8 falls below it with a chance of about one in a million.
LEAST_ESTIMATE = 0.58


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and hashes of the distinct shingles of every text, by row and hash; number of rows."""
    words = Words(column, lower=True)
    hashes = words.hashes()
    at, values = words.windows(hashes, size)
    rows = words.rows[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        begin = words.first[short]
        values = np.concatenate([values, span_hashes(hashes, begin, begin + words.counts[short])])
        rows = np.concatenate([rows, short])
    values = values.view(np.int64)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new], len(column)


def _set_hash(rows: np.ndarray, values: np.ndarray, n: int, salt: int) -> np.ndarray:
    """A hash of each row's whole set."""
    total = np.zeros(n, dtype=np.uint64)
    np.add.at(total, rows, mix(values.view(np.uint64) + np.uint64(salt)))
    return total.view(np.int64)


def sketches(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text", k: int = SKETCH) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b`` (hashes of the whole set) and ``sketch``, per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            rows, values, n = shingle_sets(batch.column(text), size)
            counts = np.bincount(rows, minlength=n)
            begin = np.cumsum(counts) - counts
            kept = np.arange(len(rows)) - begin[rows] < k
            sums = [pa.array(_set_hash(rows, values, n, salt)) for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(counts.astype(np.int64)), *sums, lists(values[kept], np.minimum(counts, k))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )

    schema = "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>"
    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, shingles``: the whole set of every row whose id and set (``id, set_a``) is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            rows, values, n = shingle_sets(batch.column(text), size)
            own = _set_hash(rows, values, n, 1) == np.asarray(batch.column("set_a"))
            counts = np.bincount(rows, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).filter(pa.array(own)), lists(values[own[rows]], counts[own])], names=["id", "shingles"]
            )

    texts = docs.select(F.col(key).cast("long").alias(key), text).join(
        wanted.withColumnRenamed("id", "wanted_id"), F.col(key) == F.col("wanted_id")
    )
    return texts.select(key, text, "set_a").mapInArrow(run, "id long, shingles array<long>")


def least_overlap(n: Column, k: int = SKETCH) -> Column:
    """Kept values that a set of ``n`` shares at least with any set of similarity 0.8.

    A set that fits the sketch and a partner of up to 1.25 times its size: 0.8 of the larger one,
    less what the partner cannot keep. Beyond, :data:`LEAST_ESTIMATE` of ``k``: of the ``k``
    smallest values of the union each is common with chance 0.8.
    """
    fits = F.least(F.ceil(n * F.lit(SIMILARITY[0]) / F.lit(SIMILARITY[1])), F.lit(k - k // 4))
    return F.when(n <= k, fits).otherwise(int(LEAST_ESTIMATE * k))


def prefixes(classes: DataFrame, k: int = SKETCH) -> DataFrame:
    """``value, id, n``: the rarest kept values of every set of size ``n``, as far as another set
    has them, too."""
    postings = classes.select("id", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = postings.join(shared, "value").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("held"))
    # Of the first size - overlap + 1 places, those of values that no other set has are left out.
    room = F.size("held") - least_overlap(F.col("n_shingles"), k) + 1
    return (
        held.join(classes.select("id", "n_shingles"), "id")
        .withColumn("room", room.cast("int"))
        .filter("room > 0")
        .select("id", "n_shingles", F.explode(F.slice("held", F.lit(1), F.col("room"))).alias("h"))
        .select(F.col("h.value").alias("value"), "id", F.col("n_shingles").alias("n"))
    )


def estimate(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Similarity from two sketches: the common share of the smallest values of their union
    (all of them if both sets fit)."""
    union = F.array_sort(F.array_union(a, b))
    top = F.when((F.size(a) < k) & (F.size(b) < k), union).otherwise(F.slice(union, 1, k))
    return F.size(F.array_intersect(top, F.array_intersect(a, b))) / F.size(top)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b, estimate`` of the pairs that the estimate lets pass."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch_{x}"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .withColumn("estimate", estimate(F.col("sketch_a"), F.col("sketch_b")))
        .filter(F.col("estimate") >= LEAST_ESTIMATE)
        .select("a", "b", "estimate")
    )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    low, high = SIMILARITY
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return (
        joined.withColumn("both", both)
        .filter(F.col("both") * high >= (F.size("set_a") + F.size("set_b") - F.col("both")) * low)
        .select("a", "b")
    )


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``id, component`` after the links (``a, b``) join components of ``labels``.

    ``labels`` needs a row only for ids in links; components are named by their smallest id.
    """
    of = lambda x: labels.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("c_a").alias("x"), F.col("c_b").alias("y"))
    edges = written(edges.filter("x <> y").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parents = both.groupBy("x").agg(F.min("y").alias("y"))
        parents = written(parents.select(F.col("x").alias("child"), F.least("x", "y").alias("parent")), "parents")
        while True:  # follow parents until all point at a root
            up = parents.select(F.col("child").alias("parent"), F.col("parent").alias("next"))
            further = written(
                parents.join(up, "parent").select("child", "parent", F.col("next")), "parents"
            )
            parents = further.select("child", F.col("next").alias("parent"))
            if further.filter("next <> parent").isEmpty():
                break
        moved = labels.join(parents.withColumnRenamed("child", "component"), "component", "left")
        labels = written(moved.select("id", F.coalesce("parent", "component").alias("component")), "labels")
        root = lambda x: parents.select(F.col("child").alias(x), F.col("parent").alias(f"r_{x}"))
        edges = edges.join(root("x"), "x").join(root("y"), "y").select(F.col("r_x").alias("x"), F.col("r_y").alias("y"))
        edges = written(edges.filter("x <> y").distinct(), "edges")
    return labels


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    of = lambda x: labels.select(F.col("id").alias(x), F.col("component").alias(f"c_{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter("c_a <> c_b").drop("c_a", "c_b")


def _several(rows: DataFrame, steps: Scratch) -> DataFrame:
    """``rows`` (``value, id, n, c``) of the lists with members in several components ``c``."""
    spread = rows.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    return rows.join(steps.written(spread.select("value"), "several"), "value")


def led(inside: DataFrame, steps: Scratch) -> DataFrame:
    """The undecided lists merged: every list goes to its member with the smallest hash, its leader.

    The lists of a group, which hold nearly the same members, mostly share a leader and become one
    list there. Two members of a list share its leader.
    """
    leader = inside.groupBy("value").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("l"))
    leader = steps.written(leader.select("value", F.col("l.id").alias("leader")), "leaders")
    rows = inside.join(leader, "value").select(F.col("leader").alias("value"), "id", "n", "c").distinct()
    return steps.written(rows, "led")


def shared_sets(whole: DataFrame, ids: DataFrame, steps: Scratch) -> DataFrame:
    """``id, shared``: the shingles of each set that another component has, too, where they are
    enough for a link (100 * shared >= 80 * n); the other sets can't be linked with any component.
    """
    low, high = SIMILARITY
    held = steps.written(whole.join(ids, "id").select("id", "c", "n", F.explode("shingles").alias("shingle")), "held")
    spread = held.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    spread = steps.written(spread.select("shingle"), "spread")
    found = held.join(spread, "shingle").groupBy("id", "n").agg(F.collect_list("shingle").alias("shared"))
    out = steps.written(found.filter(F.size("shared") * high >= F.col("n") * low).select("id", "shared"), "shared")
    steps.free(held, spread)
    return out


def at_meetings(rows: DataFrame, lists_of: DataFrame, weight: Column, steps: Scratch) -> DataFrame:
    """The members of lists dealt to meetings of two blocks ``x <= y`` of a list.

    A list is cut by a hash into blocks of about :data:`BLOCK_MEMBERS` members and
    :data:`BLOCK_SHINGLES` of ``weight``, so that a meeting is bounded however long the list is.
    ``lists`` are a member's lists: a pair is compared in the first one that both are in.
    """
    sizes = rows.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.sum(weight).alias("s"))
    blocks_of = F.greatest(F.ceil(F.col("m") / BLOCK_MEMBERS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int")
    sizes = steps.written(sizes.filter("m > 1").select("value", blocks_of.alias("blocks")), "list-sizes")
    met = (
        rows.join(sizes, "value")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("x", F.least("block", "other"))
        .withColumn("y", F.greatest("block", "other"))
    )
    return met.drop("blocks", "other").join(lists_of, "id")


def _padded(column: pa.ChunkedArray, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as a matrix, short rows filled up; and the lengths."""
    flat = column.combine_chunks()
    counts = np.asarray(flat.value_lengths())
    out = np.full((len(flat), max(1, int(counts.max()))), fill, dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < counts[:, None]] = np.asarray(flat.flatten())
    return out, counts


def _estimates(own: np.ndarray, others: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """:func:`estimate` of one sorted sketch with each row of ``others`` (sorted, filled up)."""
    before = np.searchsorted(own, others)  # own values below each of the others'
    both = own[np.minimum(before, len(own) - 1)] == others
    both &= np.arange(others.shape[1])[None, :] < counts[:, None]
    common = np.cumsum(both, axis=1)
    place = np.arange(others.shape[1])[None, :] + before - (common - both)  # place in the union
    union = len(own) + counts - common[:, -1]
    top = np.where((counts < k) & (len(own) < k), union, np.minimum(union, k))
    return (both & (place < top[:, None])).sum(axis=1) / top


def _met(k: int, exact: bool):
    """For a meeting: ``a, b``, pairs of similar sets that join two components, a spanning forest of
    them; without ``exact``, the list and id of every member with an estimate that may be a link.

    Pairs of one component, of sizes that can't be similar or with an earlier list in common are
    left out; the estimate passes the others on to the exact comparison of the shared shingles.
    """
    low, high = SIMILARITY

    def run(meeting: pa.Table) -> pa.Table:
        x, y, value = (meeting[name][0].as_py() for name in ("x", "y", "value"))
        meeting = meeting.take(pa.array(np.argsort(meeting["id"].to_numpy(), kind="stable")))
        ids, n, c, block = (meeting[name].to_numpy() for name in ("id", "n", "c", "block"))
        sketch, kept = _padded(meeting["sketch"], np.iinfo(np.int64).max)
        lists_, _ = _padded(meeting["lists"], np.iinfo(np.int64).max)
        earlier = lists_ < value
        group = c.copy()  # components as this meeting joins them
        mine, theirs = (block == x), (block == y)
        most = n
        if exact:
            flat = meeting["shared"].combine_chunks()
            most = held = np.asarray(flat.value_lengths()).astype(np.int64)
            codes, flat = np.unique(np.asarray(flat.flatten()), return_inverse=True)
            first = np.cumsum(held) - held
            marked = np.zeros(len(codes), dtype=bool)
        candidates = np.zeros(len(ids), dtype=bool)
        out = []
        for i in np.flatnonzero(mine):
            near = theirs & (group != group[i]) & (np.minimum(n, n[i]) * high >= np.maximum(n, n[i]) * low)
            # intersection >= 0.8 * union, with both sizes given: intersection * 1.8 >= 0.8 * (n_a + n_b)
            near &= np.minimum(most, most[i]) * (low + high) >= (n + n[i]) * low
            near[: i + 1 if x == y else 0] = False
            at = np.flatnonzero(near)
            own_lists = lists_[i][earlier[i]]
            if len(at) and len(own_lists):
                at = at[~(np.isin(lists_[at], own_lists) & earlier[at]).any(axis=1)]
            if len(at):
                at = at[_estimates(sketch[i, : kept[i]], sketch[at], kept[at], k) >= LEAST_ESTIMATE]
            if not len(at):
                continue
            if not exact:
                candidates[i] = candidates[at] = True
                continue
            marked[flat[first[i] : first[i] + held[i]]] = True
            begin = np.cumsum(held[at]) - held[at]
            spans = np.repeat(first[at] - begin, held[at]) + np.arange(held[at].sum())
            both = np.add.reduceat(marked[flat[spans]].astype(np.int64), begin)
            marked[flat[first[i] : first[i] + held[i]]] = False
            for j in at[both * high >= (n[at] + n[i] - both) * low]:
                if group[i] != group[j]:
                    group[group == group[j]] = group[i]
                    out.append((ids[i], ids[j]))
        if not exact:
            return pa.table({"a": np.full(candidates.sum(), value), "b": ids[candidates]})
        ends = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return run


def near_duplicates(
    docs: DataFrame, size: int = 5, key: str = "doc_id", text: str = "text", k: int = SKETCH
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links; ``kept`` marks the rows that have it.
    """
    steps = Scratch()
    written = steps.written
    sketched = written(sketches(docs, size, key, text, k), "sketches")
    rows = written(sketched.drop("sketch"), "sets")
    linkable = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    same = ["set_a", "set_b", "n_shingles"]
    copies = written(rows.filter(linkable).groupBy(*same).agg(F.min("doc_id").alias("id")), "copies")
    classes = written(
        sketched.filter(linkable)
        .join(copies.select("id", *[F.col(c).alias(f"of_{c}") for c in same]), F.col("doc_id") == F.col("id"))
        .filter(" AND ".join(f"{c} = of_{c}" for c in same))
        .groupBy("id")
        .agg(F.max_by(F.struct("n_shingles", "set_a", "sketch"), F.struct("n_shingles", "set_a")).alias("s"))
        .select("id", "s.n_shingles", "s.set_a", "s.sketch"),
        "classes",
    )
    steps.free(sketched)
    listed = written(prefixes(classes, k), "prefixes")
    low, high = SIMILARITY
    near_size = lambda m, n: F.least(m, n) * high >= F.greatest(m, n) * low
    pivots = listed.groupBy("value").agg(
        F.min(F.struct(F.xxhash64("value", "id").alias("h"), F.col("id").alias("id"), F.col("n").alias("n"))).alias("p"),
        F.count(F.lit(1)).alias("members"),
    )
    pivots = pivots.filter("members > 1").select("value", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"))
    chosen = listed.join(pivots, "value").filter((F.col("id") != F.col("pivot")) & near_size(F.col("n"), F.col("pivot_n")))
    pairs = chosen.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    pairs = written(_estimated(pairs, classes), "pairs")

    def sets_of(ends: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
        """Ids at the ends of pairs, and their full sets."""
        ids = written(ends.select(F.explode(F.array("a", "b")).alias("id")).distinct(), label)
        return ids, written(full_sets(docs, ids.join(classes.select("id", "set_a"), "id"), size, key, text), label)

    members, sets = sets_of(pairs, "sets")
    ends = pairs.select("a", "b", "estimate", F.explode(F.array("a", "b")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.desc("estimate"), F.xxhash64("a", "b"))
    first = ends.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= BEST).select("a", "b").distinct()
    labels = members.select("id", F.col("id").alias("component"))
    labels = connect(labels, confirmed(first, sets))
    labels = connect(labels, confirmed(_across(pairs, labels), sets))

    # What the chosen members did not decide: the other pairs of lists with several components.
    inside = listed.join(labels, "id", "left").select("value", "id", "n", F.coalesce("component", "id").alias("c"))
    undecided = written(_several(written(inside, "inside"), steps), "undecided")
    steps.free(listed, pairs, sets)
    rest = led(undecided, steps)
    steps.free(undecided)
    lists_of = written(rest.groupBy("id").agg(F.sort_array(F.collect_set("value")).alias("lists")), "lists")
    sketch_of = classes.select("id", "sketch")
    met = at_meetings(rest, lists_of, F.least(F.col("n"), F.lit(k)), steps).join(sketch_of, "id")
    near = met.groupBy("value", "x", "y").applyInArrow(_met(k, exact=False), "a long, b long")
    near = written(near.select(F.col("a").alias("value"), F.col("b").alias("id")).distinct(), "near")
    rest = written(rest.join(near, ["value", "id"]), "candidates")
    ids = written(rest.select("id", "c", "n").distinct(), "candidate-ids")
    whole = written(full_sets(docs, ids.join(classes.select("id", "set_a"), "id"), size, key, text), "candidate-sets")
    shared = shared_sets(whole, ids, steps)
    steps.free(whole)
    rest = rest.join(shared.select("id", F.size("shared").alias("held")), "id")
    met = at_meetings(written(rest, "candidates"), lists_of, F.col("held"), steps).join(shared, "id").join(sketch_of, "id")
    links = written(met.groupBy("value", "x", "y").applyInArrow(_met(k, exact=True), "a long, b long"), "rest-links")
    steps.free(shared)
    new = ids.select("id").join(labels.select("id"), "id", "left_anti")
    labels = written(labels.unionByName(new.select("id", F.col("id").alias("component"))), "labels")
    labels = connect(labels, links)

    found = copies.join(labels, "id", "left").select(*same, F.coalesce("component", "id").alias("component"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    found = written(found, "found")
    steps.free(classes, copies)
    by_row = rows.join(found, same, "left").select("doc_id", "n_shingles", own.alias("component"))
    return by_row.select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )
