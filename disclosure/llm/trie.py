"""Prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first turns is a node; its members are the conversations that start with
it. A node is named by its smallest member and its depth, so the node of a conversation at every
smaller depth (an ancestor) is one row of the table of paths, found by ``(conversation, depth)``.

*Nodes.* Turns get their places by one global sort: rows are placed inside their sort partition,
and one row per conversation and partition carries the number of rows before. In the same way a
prefix is the running sum of hashes of its turns, each with its place, so a conversation of any
length is spread over many tasks. Nodes are one aggregation by depth and sum.

*Rollup.* The weight of a node is the number of members' turns at or below it, which that same
aggregation gives. A component's centroid is its deepest node with more than half of the weight:
what hangs below it, and what is left above it, are components of at most half. Each round
finds the centroid of every component, sums the component's values at and below it, adds the sum
to the nodes on the path from the centroid to the component's top (and takes the weight off
them), and splits there. A node and one below it are in one component until the round that takes a
centroid between them, so every sum is added exactly once, and the rounds are as many as halvings
of the weight however deep the trie is. Components of at most :data:`SMALL` weight are finished
by the same rounds in numpy, many of them in one task.

Defined cases: a row with a null conversation id takes no part; a null role or text is empty;
turns are ordered by turn (null first), equal ones by the SHA-256 of role and text, so repeated
rows are repeated turns; a conversation without turns is a member of the root alone; an empty
table has no root and gives no rows. Other columns are ignored. Prefixes are told apart by 128
bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from disclosure.llm.stage import Scratch

SMALL = 16_384  # weight up to which a component is finished in one task
ENDS = 4096  # consecutive conversation ids whose text is joined in one row
_SUMS = ["s0", "s1", "s2", "s3"]
_UPPER = ["p0", "p1", "p2", "p3"]
_HALF = (1 << 32) - 1


def _placed(turns: DataFrame, steps: Scratch) -> DataFrame:
    """``conv, part, pos, turn_hash, bytes``: turns with their place (from 1) in their conversation."""
    given = turns.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL")
    hashed = given.select(
        "conv",
        "turn",
        F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.sha2("text", 256)), 256)).alias("turn_hash"),
        F.octet_length("text").cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("tie"),  # lets a sort cut repeated rows
    )
    ordered = hashed.orderBy("conv", F.col("turn").asc_nulls_first(), F.hex("turn_hash"), "tie")
    parts = ordered.select(
        "conv", "turn_hash", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    parts = steps.written(parts, "trie-sorted")
    chunks = parts.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    pos = F.col("at") - F.col("first") + F.col("before") + 1
    out = steps.written(parts.join(chunks, ["conv", "part"]).select("conv", "part", pos.alias("pos"), "turn_hash", "bytes"), "trie-placed")
    steps.free(parts)
    return out


def rebuilt(placed: DataFrame, base: Column, head: Column, steps: Scratch) -> tuple[DataFrame, DataFrame]:
    """``conv, part, pos, turn_hash, bytes`` of the rebuilt conversations, and ``conv, len`` of all of them.

    ``base`` and ``head`` are expressions over ``conv``: the conversation whose first ``head`` turns
    come first, before the own turns after the first ``head``.
    """
    counts = steps.written(placed.groupBy("conv").agg(F.max("pos").alias("own")), "trie-counts")
    asked = counts.select("conv", "own", base.alias("base"), head.cast("long").alias("head"))
    have = counts.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    convs = asked.join(have, "base", "left").select(
        "conv", "base", "head", F.least("head", F.coalesce("there", F.lit(0))).alias("taken"), "own"
    )
    convs = steps.written(convs.withColumn("len", F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))), "trie-convs")
    first = placed.join(convs.select(F.col("conv").alias("to"), F.col("base").alias("conv"), "head"), "conv").filter(
        F.col("pos") <= F.col("head")
    )
    first = first.select(F.col("to").alias("conv"), F.lit(-1).alias("part"), "pos", "turn_hash", "bytes")
    rest = placed.join(convs.select("conv", "head", "taken"), "conv").filter(F.col("pos") > F.col("head"))
    rest = rest.select("conv", "part", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "turn_hash", "bytes")
    return first.unionByName(rest), convs.select("conv", "len")


def prefixes(turns: DataFrame, convs: DataFrame, steps: Scratch) -> DataFrame:
    """``conv, pos, s0..s3, p0..p3, bytes, len``: every prefix of every conversation (also the empty one),
    its hash, and the hash of the prefix that is one turn shorter."""
    a, b = F.xxhash64("pos", "turn_hash"), F.xxhash64("turn_hash", "pos", F.lit(1))
    half = [h for x in (a, b) for h in (x.bitwiseAND(_HALF), F.shiftrightunsigned(x, 32))]
    own = turns.select("conv", "part", "pos", "bytes", *[h.alias(f"v{i}") for i, h in enumerate(half)])
    inside = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    running = own.select("conv", "part", "pos", "bytes", *[f"v{i}" for i in range(4)], *[F.sum(f"v{i}").over(inside).alias(f"r{i}") for i in range(4)])
    running = steps.written(running, "trie-running")
    chunks = running.groupBy("conv", "part").agg(*[F.max(f"r{i}").alias(f"r{i}") for i in range(4)])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv", "part", *[F.coalesce(F.sum(f"r{i}").over(before), F.lit(0)).alias(f"b{i}") for i in range(4)])
    rows = running.join(chunks, ["conv", "part"]).join(convs, "conv")
    nothing = F.lit(None).cast("long")
    sums = [(F.col(f"r{i}") + F.col(f"b{i}")).alias(s) for i, s in enumerate(_SUMS)]
    upper = [(F.col(f"r{i}") + F.col(f"b{i}") - F.col(f"v{i}")).alias(p) for i, p in enumerate(_UPPER)]
    rows = rows.select("conv", "pos", *sums, *upper, "bytes", "len")
    empty = convs.select(
        "conv", F.lit(0).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(s) for s in _SUMS],
        *[nothing.alias(p) for p in _UPPER], F.lit(0).cast("long").alias("bytes"), "len",
    )
    return steps.written(rows.unionByName(empty), "trie-prefixes")


def ends_digests(ends: DataFrame) -> DataFrame:
    """``conv, depth, ends_sha256`` of the nodes where conversations (``ender``) end.

    Ids are joined in rows of consecutive ids, and a node's rows go through SHA-256 one after the
    other, so neither a task nor a row ever holds all members of a node.
    """
    chunk = F.floor(F.col("ender") / ENDS)
    rows = ends.groupBy("conv", "depth", chunk.alias("chunk")).agg(F.sort_array(F.collect_list("ender")).alias("ids"))
    text = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    rows = rows.select("conv", "depth", "chunk", text.alias("text"))
    rows = rows.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def out(nodes):
            return pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in nodes], pa.int64()), pa.array([n[1] for n in nodes], pa.int64()), pa.array([n[2] for n in nodes], pa.string())],
                names=["conv", "depth", "ends_sha256"],
            )

        for batch in batches:
            done = []
            for conv, depth, part in zip(batch["conv"].to_pylist(), batch["depth"].to_pylist(), batch["text"].to_pylist()):
                if (conv, depth) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (conv, depth), hashlib.sha256(part.encode())
                else:
                    digest.update(b"," + part.encode())
            yield out(done)
        if node is not None:
            yield out([(*node, digest.hexdigest())])

    return rows.mapInArrow(run, "conv long, depth long, ends_sha256 string")


# ---------------------------------------------------------------- centroid decomposition

_NODE = ["conv", "depth", "parent", "weight", "leaf", "saved", "n_leaves", "saved_tokens", "top", "top_depth"]


def _split(nodes: DataFrame, paths: DataFrame, steps: Scratch) -> tuple[DataFrame, DataFrame]:
    """One round over all components: the finished centroids, and the nodes of the new components."""
    comp = ["top", "top_depth"]
    is_top = (F.col("conv") == F.col("top")) & (F.col("depth") == F.col("top_depth"))
    totals = nodes.filter(is_top).select(*comp, F.col("weight").alias("total"))
    heavy = nodes.join(totals, comp).filter(F.col("weight") * 2 > F.col("total"))
    centroid = heavy.groupBy(*comp).agg(F.max_by(F.struct("conv", "depth", "weight"), "depth").alias("c"))
    centroid = steps.written(centroid.select(*comp, F.col("c.conv").alias("cc"), F.col("c.depth").alias("cd"), F.col("c.weight").alias("cw")), "trie-centroids")

    # The ancestor one below the centroid's depth says whether a node hangs below the centroid.
    at = nodes.join(centroid, comp)
    below = paths.select(F.col("conv"), F.col("pos").alias("child_depth"), F.col("owner").alias("child"), F.col("up"))
    at = at.withColumn("child_depth", F.col("cd") + 1).join(below, ["conv", "child_depth"], "left")
    hangs = (F.col("depth") > F.col("cd")) & (F.col("up") == F.col("cc"))
    at = at.withColumn("hangs", F.coalesce(hangs, F.lit(False)))
    at = at.withColumn("is_c", (F.col("conv") == F.col("cc")) & (F.col("depth") == F.col("cd")))
    at = steps.written(at.select(*_NODE, "cc", "cd", "cw", "child", "hangs", "is_c"), "trie-at")
    sums = at.filter("hangs OR is_c").groupBy(*comp).agg(F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved"))
    sums = steps.written(centroid.join(sums, comp), "trie-totals")

    # Along the path from the centroid to the top.
    on_path = paths.join(sums, paths["conv"] == sums["cc"]).filter((F.col("pos") >= F.col("top_depth")) & (F.col("pos") <= F.col("cd")))
    on_path = steps.written(on_path.select(F.col("owner").alias("conv"), F.col("pos").alias("depth"), "cw", "t_leaf", "t_saved"), "trie-paths-up")
    add = at.drop("cw").join(on_path, ["conv", "depth"], "left")
    own = F.when(F.col("is_c"), F.col("leaf")).otherwise(0), F.when(F.col("is_c"), F.col("saved")).otherwise(0)
    add = (
        add.withColumn("n_leaves", F.col("n_leaves") + F.coalesce(F.col("t_leaf") - own[0], F.lit(0)))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce(F.col("t_saved") - own[1], F.lit(0)))
        .withColumn("weight", F.col("weight") - F.when(F.col("is_c"), 0).otherwise(F.coalesce("cw", F.lit(0))))
        .withColumn("top", F.when(F.col("hangs"), F.col("child")).otherwise(F.col("top")))
        .withColumn("top_depth", F.when(F.col("hangs"), F.col("cd") + 1).otherwise(F.col("top_depth")))
    )
    out = steps.written(add.select(*_NODE, "is_c"), "trie-round")
    steps.free(at, on_path, sums, centroid)
    return out.filter("is_c").drop("is_c"), out.filter("NOT is_c").drop("is_c")


def finish(conv, depth, parent, weight, leaf, saved, n_leaves, saved_tokens, top, top_depth) -> None:
    """Whole components at once, in place: ``n_leaves`` and ``saved_tokens`` become sums over subtrees
    inside each component, added to what they hold."""
    n = len(conv)
    order = np.lexsort((conv, depth))
    width = np.unique(conv)
    spot = lambda c, d: np.searchsorted(width, c) + d * len(width)
    keys = spot(conv, depth)[order]
    find = lambda c, d: order[np.searchsorted(keys, spot(c, d))]
    head = find(top, top_depth)
    up = np.full(n, -1)
    inner = np.flatnonzero(head != np.arange(n))
    up[inner] = find(parent[inner], depth[inner] - 1)
    alive = np.arange(n)
    while len(alive):
        heavy = alive[weight[alive] * 2 > weight[head[alive]]]
        heavy = heavy[np.argsort(depth[heavy], kind="stable")]
        center = np.full(n, -1)
        center[head[heavy]] = heavy  # the deepest is set last
        c = center[head]
        # Jump up to the top, or to the node right below the centroid.
        jump = np.where((up < 0) | (up == c), np.arange(n), up)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        hangs = np.zeros(n, dtype=bool)
        hangs[alive] = up[jump[alive]] == c[alive]
        centers = c[np.unique(head[alive])]
        total_leaf, total_saved = np.zeros(n, np.int64), np.zeros(n, np.int64)
        inside = alive[hangs[alive] | (alive == c[alive])]
        np.add.at(total_leaf, c[inside], leaf[inside])
        np.add.at(total_saved, c[inside], saved[inside])
        n_leaves[centers] += total_leaf[centers] - leaf[centers]
        saved_tokens[centers] += total_saved[centers] - saved[centers]
        walk, of = up[centers], centers
        while True:  # up to the tops
            of, walk = of[walk >= 0], walk[walk >= 0]
            if not len(walk):
                break
            n_leaves[walk] += total_leaf[of]
            saved_tokens[walk] += total_saved[of]
            weight[walk] -= weight[of]
            walk = up[walk]
        moved = alive[hangs[alive]]
        head[moved] = jump[moved]
        up[np.unique(jump[moved])] = -1
        gone = np.zeros(n, dtype=bool)
        gone[centers] = True
        alive = alive[~gone[alive]]


def _finished(bundle: pa.Table) -> pa.Table:
    columns = {name: bundle[name].fill_null(0).to_numpy().copy() for name in _NODE}  # a root's parent is null
    finish(**columns)
    return pa.table({name: columns[name] for name in ("conv", "depth", "n_leaves", "saved_tokens")})


def rollup(nodes: DataFrame, paths: DataFrame, steps: Scratch, small: int = SMALL) -> DataFrame:
    """``conv, depth, n_leaves, saved_tokens``: sums of ``leaf`` and ``saved`` over every node's subtree.

    ``nodes``: ``conv, depth, parent, weight, leaf, saved`` of one tree; ``paths``: ``conv, pos, owner, up``.
    """
    root = nodes.filter("depth = 0").first()
    if root is None:
        return nodes.select("conv", "depth", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    state = nodes.select(
        "conv", "depth", "parent", "weight", "leaf", "saved", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.lit(root["conv"]).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"),
    )
    done, finishing = [], []
    heaviest = root["weight"]
    while heaviest > small:
        centroids, state = _split(state, paths, steps)
        done.append(centroids)
        comp = ["top", "top_depth"]
        is_top = (F.col("conv") == F.col("top")) & (F.col("depth") == F.col("top_depth"))
        large = steps.written(state.filter(is_top & (F.col("weight") > small)).select(*comp, F.col("weight").alias("w")), "trie-large")
        finishing.append(state.join(large.select(*comp), comp, "left_anti"))
        state = state.join(large.select(*comp), comp, "left_semi")
        heaviest = large.agg(F.max("w")).first()[0] or 0
        if heaviest > small:
            state = steps.written(state, "trie-state")
    finishing = finishing or [state]
    left = finishing[0]
    for more in finishing[1:]:
        left = left.unionByName(more)
    left = steps.written(left.select(*_NODE), "trie-left")
    bundles = max(1, -(-left.count() // small))
    bundle = F.pmod(F.xxhash64("top", "top_depth"), F.lit(bundles))
    out = "conv long, depth long, n_leaves long, saved_tokens long"
    found = left.withColumn("bundle", bundle).groupBy("bundle").applyInArrow(_finished, out)
    for centroids in done:
        found = found.unionByName(centroids.select("conv", "depth", "n_leaves", "saved_tokens"))
    return steps.written(found, "trie-rolled")


def trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, small: int = SMALL) -> DataFrame:
    """One row per node of the trie of conversations ``conv_id, turn, role, text``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``. ``base`` and ``head`` over ``conv`` rebuild the conversations first (see
    :func:`rebuilt`); without them they are taken as they are.
    """
    steps = Scratch()
    placed = _placed(turns, steps)
    base = F.col("conv") if base is None else base
    head = F.lit(0) if head is None else head
    built, convs = rebuilt(placed, base, head, steps)
    rows = prefixes(built, convs, steps)
    found = rows.groupBy("pos", *_SUMS).agg(
        F.min("conv").alias("conv"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"),
        F.sum(F.col("len") - F.col("pos") + 1).alias("weight"),
        *[F.max(p).alias(p) for p in _UPPER],
    )
    found = steps.written(found.withColumnRenamed("pos", "depth"), "trie-found")
    names = ["depth", *_SUMS]
    above = found.select(F.col("conv").alias("parent"), (F.col("depth") + 1).alias("depth"), *[F.col(s).alias(p) for s, p in zip(_SUMS, _UPPER)])
    children = found.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(p).alias(s) for s, p in zip(_SUMS, _UPPER)])
    children = steps.written(children.agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    nodes = found.join(above, ["depth", *_UPPER], "left").join(children, names, "left").fillna(0, ["n_children"])
    saved = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0)
    nodes = steps.written(
        nodes.select(
            "conv", "depth", "parent", "n_convs", "n_children", "weight", *_SUMS,
            (F.col("n_children") == 0).cast("long").alias("leaf"), saved.cast("long").alias("saved"),
        ),
        "trie-nodes",
    )
    owners = nodes.select(F.col("depth").alias("pos"), *_SUMS, F.col("conv").alias("owner"), F.col("parent").alias("up"))
    paths = steps.written(rows.select("conv", "pos", "len", *_SUMS).join(owners, ["pos", *_SUMS]).select("conv", "pos", "len", "owner", "up"), "trie-paths")
    steps.free(placed, rows, found, children)
    rolled = rollup(nodes.select("conv", "depth", "parent", "weight", "leaf", "saved"), paths.drop("len"), steps, small)
    ends = paths.filter("pos = len").select(F.col("owner").alias("conv"), F.col("pos").alias("depth"), F.col("conv").alias("ender"))
    digests = steps.written(ends_digests(ends), "trie-ends")
    out = nodes.select("conv", "depth", "parent", "n_convs", "n_children").join(rolled, ["conv", "depth"]).join(digests, ["conv", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
