"""Mixing sources to target weights, in DataFrame operations only.

Each source's documents are permuted by hash and dealt into ``blocks`` blocks. A source's target
is met by whole passes over its blocks plus, in one more pass, the first blocks of a random
order; the last of them is cut between two documents, and the largest document that still fits
is added. The drawn blocks are split among output
shards by a tree: a node halves its shards and draws, source by source, how many of its blocks
go left (multivariate hypergeometric, by inverse distribution function on hashed uniforms), so
every shard has an exact block quota per source. Shards then take disjoint runs of the source's
permuted blocks and order their documents by hash.

Every random choice is a hash of ``seed`` and fixed keys: reruns agree on any cluster. What is
ordered in one task is a source's blocks, the documents of one cut block per source, or one row
per source; documents meet the plan by (source, block), so a hot source spreads over its blocks.

Defined cases: a null text has size 0 and is drawn like any other; null sources are one source,
last in order; rows with equal ids are separate documents; an empty table gives empty results.
Columns named like an output are replaced, other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3  # times a source, and so a document, may be taken
BLOCKS = 1024  # least number of blocks per source
SHARDS = 16
SHARD_WORDS = 2_000_000  # words of an output shard, about (see layout): some 12 MB of text
PLAN_ROWS = 100_000  # blocks of a plan that every task may hold, some 100 bytes each
SEED = 9


def measure(
    docs: DataFrame, text: str = "text", source: str = "source", blocks: int = BLOCKS, seed: int = SEED
) -> DataFrame:
    """``doc`` (the row), ``source``, ``size`` in words, permutation key ``place``, and ``block``."""
    place = F.xxhash64(F.lit(seed), *[F.col(c) for c in docs.columns])
    return docs.select(
        F.struct("*").alias("doc"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        place.alias("place"),
    ).transform(dealt, blocks, seed)


def dealt(measured: DataFrame, blocks: int, seed: int = SEED) -> DataFrame:
    """``measured`` with every document's ``block`` out of ``blocks``."""
    return measured.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "place"), F.lit(blocks)).cast("int"))


def layout(words: int, shard_words: int = SHARD_WORDS) -> tuple[int, int]:
    """Numbers of shards and of blocks per source for a corpus of ``words``: shards of about
    ``shard_words``, and blocks enough to deal out to every shard."""
    shards = max(1, -(-words // shard_words))
    return shards, max(BLOCKS, 1 << (4 * shards - 1).bit_length())


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row per source).

    Sources in code-point order (null last) weigh ``weights`` in turn and share all sizes; a
    target stops at ``most`` times its source's size and the excess goes to the others by
    weight. Sources fill up in order of size per weight, so the full ones are a prefix of that
    order: the first source that its share doesn't fill fixes the share of all after it.
    """
    every = Window.partitionBy()
    before = Window.orderBy("fill", "nth").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int")
    )
    spent = F.coalesce(F.sum("room").over(before), F.lit(0.0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    return (
        sizes.withColumn("nth", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
        .withColumn("weight", weight)
        .withColumn("room", F.col("source_size").cast("double") * most)
        .withColumn("fill", F.col("room") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every).cast("double") - spent)
        .withColumn("rest", rest)
        .withColumn("full", F.col("room") <= F.col("weight") * F.col("left") / F.col("rest"))
        .withColumn("open", F.min(F.when(~F.col("full"), F.struct("fill", "nth", "left", "rest"))).over(every))
        .select(
            "source",
            "source_size",
            F.when(
                F.col("open").isNull() | (F.struct("fill", "nth") < F.struct("open.fill", "open.nth")), F.col("room")
            )
            .otherwise(F.col("weight") * F.col("open.left") / F.col("open.rest"))
            .alias("target"),
        )
    )


def _uniform(*keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) * F.lit(2.0**-53)


def _bound(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once and appears in the expression once, however often
    ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(good: Column, total: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``good`` ones: the inverse of the
    distribution function at ``uniform``, folded from 12 standard deviations (and 12) below the
    mode to as many above, beyond which the weight is under double precision.

    Every step binds its values, so that the expression stays small: written out, each step would
    hold several copies of the ones before, and the tree splits many times."""
    given = F.struct(
        good.cast("double").alias("g"), total.cast("double").alias("n"), drawn.cast("double").alias("d"), uniform.alias("u")
    )

    def limits(v: Column) -> Column:
        bad = v["n"] - v["g"]
        return F.struct(
            *[v[c].alias(c) for c in ("g", "n", "d", "u")],
            bad.alias("bad"),
            F.greatest(F.lit(0.0), v["d"] - bad).alias("low"),
            F.least(v["d"], v["g"]).alias("high"),
        )

    def middle(v: Column) -> Column:
        g, n, d, bad = v["g"], v["n"], v["d"], v["bad"]
        mode = F.least(F.greatest(F.floor((d + 1) * (g + 1) / (n + 2)).cast("double"), v["low"]), v["high"])
        spread = F.sqrt(d * (g / n) * (bad / n) * (n - d) / F.greatest(n - 1, F.lit(1.0)))
        return F.struct(
            *[v[c].alias(c) for c in ("g", "d", "u", "bad", "low", "high")],
            mode.alias("mode"),
            (F.ceil(spread * 12).cast("double") + 12).alias("reach"),
        )

    def window(v: Column) -> Column:
        return F.struct(
            *[v[c].alias(c) for c in ("g", "d", "u", "bad", "mode")],
            F.greatest(v["low"], v["mode"] - v["reach"]).alias("lowest"),
            F.least(v["high"], v["mode"] + v["reach"]).alias("highest"),
        )

    def up(v: Column, k: Column) -> Column:  # weight of k + 1 over weight of k
        return (v["g"] - k) * (v["d"] - k) / ((k + 1) * (v["bad"] - v["d"] + k + 1))

    def steps(start: Column, stop: Column) -> Column:
        """start, start + 1, .. below stop (empty when start is stop)."""
        return F.when(
            start < stop, F.sequence(start.cast("long"), (stop - 1).cast("long"))
        ).otherwise(F.array().cast("array<bigint>"))

    one = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("s"))

    def add(acc: Column, ratio: Column) -> Column:
        return _bound(acc["w"] * ratio, lambda w: F.struct(w.alias("w"), (acc["s"] + w).alias("s")))

    def sums(v: Column) -> Column:
        above = F.aggregate(steps(v["mode"], v["highest"]), one, lambda a, k: add(a, up(v, k)))
        below = F.aggregate(
            F.reverse(steps(v["lowest"], v["mode"])), one, lambda a, k: add(a, F.lit(1.0) / up(v, k))
        )
        return F.struct(v.alias("v"), above["s"].alias("above"), below.alias("below"))

    def inverse(x: Column) -> Column:
        v, below = x["v"], x["below"]
        goal = v["u"] * (x["above"] + below["s"] - 1)
        start = F.struct(
            below["w"].alias("w"), below["w"].alias("s"), goal.alias("goal"), v["lowest"].cast("long").alias("k")
        )

        def walk(acc: Column, k: Column) -> Column:
            more = acc["s"] < acc["goal"]
            return _bound(
                acc["w"] * up(v, k),
                lambda w: F.struct(
                    w.alias("w"),
                    (acc["s"] + F.when(more, w).otherwise(F.lit(0.0))).alias("s"),
                    acc["goal"].alias("goal"),
                    F.when(more, k + 1).otherwise(acc["k"]).alias("k"),
                ),
            )

        return F.aggregate(steps(v["lowest"], v["highest"]), start, walk, lambda a: a["k"])

    found = _bound(_bound(_bound(_bound(_bound(given, limits), middle), window), sums), inverse)
    return F.when(total <= 0, F.lit(0).cast("long")).otherwise(found)


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``source, shard, quota``: blocks of each source for each shard, from ``source, quota``.

    Shards get equal numbers of blocks (to within rounding down the tree), and their sources
    are distributed as if the blocks had been shuffled and cut.
    """
    kind = "array<struct<source:string,quota:bigint>>"
    nodes = quotas.agg(
        F.sort_array(F.collect_list(F.struct(F.col("source"), F.col("quota").cast("long")))).cast(kind).alias("quotas")
    ).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "quotas")
    empty = F.array().cast("array<bigint>")
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
    for _ in range((shards - 1).bit_length()):
        middle = F.col("low") + F.floor((F.col("high") - F.col("low")) / 2).cast("int")
        nodes = nodes.withColumn("middle", middle).withColumn("total", total)
        share = (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low"))
        begin = F.struct(
            F.col("total").alias("rest"), F.round(F.col("total") * share).cast("long").alias("due"), empty.alias("out")
        )

        def draw(acc: Column, x: Column) -> Column:
            chance = _uniform(F.lit(seed), F.col("low"), F.col("high"), x["source"])
            return _bound(
                hypergeometric(x["quota"], acc["rest"], acc["due"], chance),
                lambda got: F.struct(
                    (acc["rest"] - x["quota"]).alias("rest"),
                    (acc["due"] - got).alias("due"),
                    F.concat(acc["out"], F.array(got)).alias("out"),
                ),
            )

        nodes = nodes.withColumn("taken", F.aggregate("quotas", begin, draw, lambda a: a["out"]))
        left = F.zip_with("quotas", "taken", lambda x, n: F.struct(x["source"].alias("source"), n.alias("quota")))
        right = F.zip_with(
            "quotas", "taken", lambda x, n: F.struct(x["source"].alias("source"), (x["quota"] - n).alias("quota"))
        )
        halves = F.array(
            F.struct(F.col("low").alias("low"), F.col("middle").alias("high"), left.cast(kind).alias("quotas")),
            F.struct(F.col("middle").alias("low"), F.col("high").alias("high"), right.cast(kind).alias("quotas")),
        )
        whole = F.array(F.struct(F.col("low"), F.col("high"), F.col("quotas").cast(kind).alias("quotas")))
        nodes = nodes.select(
            F.explode(F.when(F.col("high") - F.col("low") > 1, halves).otherwise(whole)).alias("n")
        ).select("n.low", "n.high", "n.quotas")
    return nodes.select(F.col("low").alias("shard"), F.inline("quotas")).select("source", "shard", "quota")


def plan(
    measured: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    shards: int = SHARDS,
    seed: int = SEED,
    written=lambda df, label: df,
) -> DataFrame:
    """One row per block: ``source, block, source_size, target, draws``.

    ``draws`` holds, for each time the block is drawn, ``epoch``, ``shard``, ``cut`` (null, or
    the largest ``place`` a drawn document may have) and ``only`` (null, or the one ``place``
    drawn). ``measured`` needs ``source``,
    ``size``, ``place``, ``block``; it is read several times. ``written`` may store a small
    table and read it back, so that later steps don't repeat the ones before.
    """
    blocks = written(measured.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sources = written(
        targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most), "mix-targets"
    ).withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    sources = sources.withColumn("due", F.col("target") - F.col("passes") * F.col("source_size"))

    by_source = lambda a, b: a.join(
        b.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "source", "block"), "block")
    ordered = by_source(blocks, sources).withColumn(
        "before", F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    # The extra pass: whole blocks up to the target; the block that crosses it is cut.
    ordered = written(
        ordered.withColumn("whole", F.col("before") + F.col("words") <= F.col("due")).withColumn(
            "crossing", ~F.col("whole") & (F.col("before") < F.col("due"))
        ),
        "mix-order",
    )
    crossing = ordered.filter("crossing").select(
        F.col("source").alias("of"), F.col("block").alias("in"), (F.col("due") - F.col("before")).alias("missing")
    )
    along = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    narrow = measured.select("source", "block", "size", "place")
    cuts = written(
        narrow.join(crossing, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")))
        .withColumn("upto", F.sum("size").over(along))
        .groupBy("source", "block", "missing")
        .agg(
            F.max(F.when(F.col("upto") <= F.col("missing"), F.col("place"))).alias("cut"),
            F.coalesce(F.max(F.when(F.col("upto") <= F.col("missing"), F.col("upto"))), F.lit(0)).alias("got"),
        )
        .select(F.col("source").alias("of"), F.col("block").alias("in"), "cut", (F.col("missing") - F.col("got")).alias("gap")),
        "mix-cuts",
    )
    drawn = ordered.join(cuts.select("of", "in", "cut"), F.col("crossing") & F.col("source").eqNullSafe(F.col("of")), "left")
    drawn = drawn.drop("of", "in")
    # What is still missing is less than the next document: the largest one that fits is added.
    behind = drawn.filter(~F.col("whole") & (F.col("due") > 0)).select(
        F.col("source").alias("s"), F.col("block").alias("b"), F.col("cut").alias("c"), "passes"
    )
    fills = (
        narrow.join(behind, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
        .filter(F.col("c").isNull() | (F.col("place") > F.col("c")))
        .join(cuts.select("of", "gap"), F.col("source").eqNullSafe(F.col("of")))
        .filter((F.col("size") > 0) & (F.col("size") <= F.col("gap")))
        .groupBy("source", "passes")
        .agg(F.max(F.struct("size", "place", "block")).alias("best"))
        .select(
            "source",
            "best.block",
            F.col("passes").cast("int").alias("epoch"),
            F.lit(None).cast("long").alias("cut"),
            F.col("best.place").alias("only"),
        )
    )
    extra = F.when(F.col("whole") & (F.col("due") > 0) | F.col("cut").isNotNull(), 1).otherwise(0)
    epochs = F.when(
        F.col("passes") + extra > 0, F.sequence(F.lit(0).cast("long"), (F.col("passes") + extra - 1).cast("long"))
    )
    units = written(
        drawn.select("source", "block", F.explode(epochs).alias("epoch"), "passes", "cut")
        .select(
            "source",
            "block",
            F.col("epoch").cast("int").alias("epoch"),
            F.when(F.col("epoch") == F.col("passes"), F.col("cut")).alias("cut"),
            F.lit(None).cast("long").alias("only"),
        )
        .unionByName(fills),
        "mix-units",
    )
    quotas = split_quotas(units.groupBy("source").agg(F.count(F.lit(1)).alias("quota")), shards, seed)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        quotas.withColumn("end", F.sum("quota").over(upto))
        .groupBy("source")
        .agg(F.sort_array(F.collect_list("end")).alias("ends"))
    )
    mixed = Window.partitionBy("source").orderBy(
        F.xxhash64(F.lit(seed + 3), "source", "block", "epoch"), "block", "epoch", "only"
    )
    dealt = (
        by_source(units.withColumn("nth", F.row_number().over(mixed)), ends)
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("nth"))))
        .groupBy("source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "cut", "only"))).alias("draws"))
        .select(F.col("source").alias("of"), F.col("block").alias("in"), "draws")
    )
    return ordered.join(
        dealt, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")), "left"
    ).select(
        "source",
        "block",
        "source_size",
        "target",
        F.coalesce("draws", F.array().cast("array<struct<epoch:int,shard:int,cut:bigint,only:bigint>>")).alias("draws"),
    )


def allocate(measured: DataFrame, planned: DataFrame, small: bool = False) -> DataFrame:
    """``measured`` with ``source_size``, ``target`` and its own ``draws`` (epoch, shard).

    A ``small`` plan (at most :data:`PLAN_ROWS` blocks) is sent to every task, so that the documents
    stay where they are; a longer one meets them by a shuffle on (source, block).
    """
    planned = planned.withColumnRenamed("source", "of").withColumnRenamed("block", "in")
    if small:
        planned = F.broadcast(planned)
    joined = measured.join(planned, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")))
    own = F.filter(
        "draws",
        lambda x: F.when(x["only"].isNotNull(), F.col("place") == x["only"]).otherwise(
            x["cut"].isNull() | (F.col("place") <= x["cut"])
        ),
    )
    return joined.drop("of", "in").withColumn(
        "draws", F.transform(own, lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard")))
    )


def mix(allocated: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document's columns once per draw, with ``shard`` and ``position``.

    ``position`` orders a shard's rows at random; see :func:`shuffled`.
    """
    names = [f.name for f in allocated.schema["doc"].dataType.fields if f.name not in ("shard", "position")]
    draws = allocated.select("doc", "place", F.explode("draws").alias("draw"))
    return draws.select(
        *[F.col("doc").getField(n).alias(n) for n in names],
        F.col("draw.shard").alias("shard"),
        F.xxhash64(F.lit(seed + 4), "place", "draw.epoch").alias("position"),
    )


def shuffled(mixed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``mixed`` dealt to exactly one partition per shard and ordered by ``position`` inside it."""
    return mixed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("position")
