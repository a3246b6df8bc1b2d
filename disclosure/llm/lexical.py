"""Ranked lexical search over a block-compressed index, by Block-Max MaxScore.

*Index.* Documents are dealt by a hash to shards of about :data:`SHARD_TERMS` terms. In a shard they
are numbered by id; a term's postings (document, occurrences) are cut into blocks of
:data:`BLOCK` postings, stored as byte-packed differences. A list carries its largest impact, a block
its last document and its largest impact; both are read without unpacking anything. The index
holds every term of every document and is written once; any number of query sets can be run on it.

*Search.* In every shard a query's lists are ordered by their global bound (weight times largest
impact). Lists whose bounds together cannot reach the score that is needed are non-essential:
candidates come from the essential lists alone, window after window of documents. For a
candidate, the block maxima of the non-essential lists, largest list first, tell whether it can
still get there; only the blocks of those that can are unpacked. The score that is needed is the
``k``-th best so far. One shard is searched first, and its ``k``-th scores are where the other shards
start from. Every shard gives at most ``k`` rows a query, which are merged by rank.

Scores are whole numbers: a term adds its weight times ``1e9 * tf div (1000 * tf + 20 * m)``.

Defined cases: terms are the maximal runs of ASCII letters and digits and of characters above
ASCII, A-Z lower-cased; a null or empty text has none; a document without terms, or with a null id,
takes no part and is not counted; rows that share an id are documents of their own; queries that
share an id are one query with all their terms, each once; a query without known terms has no
rows; a null query id is left out; an empty table gives no rows. Other columns are ignored. Terms
are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from disclosure.llm.stage import written
from disclosure.llm.text import IS_TERM, Words, blocks, lists

SHARD_TERMS = 1 << 21  # terms with repeats in a shard, about
BLOCK = 128  # postings in a block
WINDOW = 4096  # documents scored at once
QUERY_TERMS = 1 << 18  # terms of the queries that are searched together, about
TOP = 50

_INDEX = (
    "shard int, term long, n int, top long, last array<int>, best array<long>, start array<int>, "
    "widths array<int>, payload binary"
)


def terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, n, terms, tfs``: per row the number of terms, the distinct ones' hashes and their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            words = Words(batch.column(text), lower=True, inside=IS_TERM)
            rows, values = words.rows, words.hashes().view(np.int64)
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
            at = np.flatnonzero(new)
            tfs = np.diff(np.append(at, len(rows))).astype(np.int32)
            counts = np.bincount(rows[at], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(words.counts), lists(values[at], counts), lists(tfs, counts)],
                names=["id", "n", "terms", "tfs"],
            )

    given = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).filter(F.col(key).isNotNull())
    return given.mapInArrow(run, "id long, n long, terms array<long>, tfs array<int>").filter("n > 0")


def sizes(docs: DataFrame, key: str, text: str) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            counts = Words(batch.column(text), inside=IS_TERM).counts
            yield pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], names=["n", "l"])

    given = docs.filter(F.col(key).isNotNull()).select(F.col(text).cast("string").alias(text))
    row = given.mapInArrow(run, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return row["n"] or 0, row["l"] or 0


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _width(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def pack(values: np.ndarray, at: np.ndarray, width: np.ndarray, out: np.ndarray) -> None:
    """Writes each value little-endian at its place, in its width."""
    for byte in range(4):
        some = width > byte
        out[at[some] + byte] = (values[some] >> (8 * byte)) & 255


def build(shard: pa.Table, n_docs: int, n_terms: int) -> pa.Table:
    """The index rows of a shard: one per term, and one without a term for the documents."""
    shard = shard.take(pa.array(np.argsort(shard["id"].to_numpy(), kind="stable")))
    number = shard["shard"][0].as_py()
    ids, n = shard["id"].to_numpy(), shard["n"].to_numpy()
    m = 50 + (50 * n * n_docs) // n_terms
    column = shard["terms"].combine_chunks()
    doc = np.repeat(np.arange(len(ids)), np.asarray(column.value_lengths()))
    term = np.asarray(column.flatten())
    order = np.argsort(term, kind="stable")  # documents stay in order
    term, doc = term[order], doc[order]
    tf = np.asarray(shard["tfs"].combine_chunks().flatten())[order].astype(np.int64)
    impact = impacts(tf, m[doc])

    first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))  # of each list
    length = np.diff(np.append(first, len(term)))
    place = np.arange(len(term)) - np.repeat(first, length)
    opens = np.flatnonzero(place % BLOCK == 0)  # first posting of each block
    filled = np.diff(np.append(opens, len(term)))
    block = np.repeat(np.arange(len(opens)), filled)
    step = np.diff(doc, prepend=0)
    step[opens] = doc[opens]
    w_doc, w_tf = _width(np.maximum.reduceat(step, opens)), _width(np.maximum.reduceat(tf, opens))
    size = filled * (w_doc + w_tf)
    start = np.cumsum(size) - size
    payload = np.zeros(int(size.sum()), dtype=np.uint8)
    inside = np.arange(len(term)) - opens[block]
    pack(step, start[block] + inside * w_doc[block], w_doc[block], payload)
    pack(tf, (start + filled * w_doc)[block] + inside * w_tf[block], w_tf[block], payload)

    per_list = -(-length // BLOCK)
    list_first = np.cumsum(per_list) - per_list  # first block of each list
    list_start = start[list_first]
    list_end = np.append(list_start[1:], len(payload))
    relative = (start - np.repeat(list_start, per_list)).astype(np.int32)
    binary = pa.Array.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(np.append(list_start, len(payload)).astype(np.int64)), pa.py_buffer(payload)]
    ).cast(pa.binary())
    rows = pa.table(
        {
            "shard": pa.array(np.full(len(first), number, np.int32)),
            "term": pa.array(term[first]),
            "n": pa.array(length.astype(np.int32)),
            "top": pa.array(np.maximum.reduceat(impact, first)),
            "last": lists(doc[opens + filled - 1].astype(np.int32), per_list),
            "best": lists(np.maximum.reduceat(impact, opens), per_list),
            "start": lists(relative, per_list),
            "widths": lists((w_doc * 8 + w_tf).astype(np.int32), per_list),
            "payload": binary,
        }
    )
    assert list_end[-1] == len(payload)
    one = np.array([1])
    documents = pa.table(
        {
            "shard": pa.array([number], pa.int32()),
            "term": pa.array([None], pa.int64()),
            "n": pa.array([len(ids)], pa.int32()),
            "top": pa.array([0], pa.int64()),
            "last": lists(np.zeros(0, np.int32), one * 0),
            "best": lists(ids, one * len(ids)),
            "start": lists(np.zeros(0, np.int32), one * 0),
            "widths": lists(np.zeros(0, np.int32), one * 0),
            "payload": pa.array([m.astype("<i8").tobytes()], pa.binary()),
        }
    )
    return pa.concat_tables([rows, documents])


@dataclass
class Index:
    """Index rows, the documents and terms they count, and the number of shards."""

    rows: DataFrame
    n_docs: int
    n_terms: int
    shards: int


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_terms: int = SHARD_TERMS) -> Index:
    """Indexes every term of every row; the index is a written table."""
    n_docs, n_terms = sizes(docs, key, text)
    shards = max(1, -(-n_terms // shard_terms))
    dealt = terms(docs, key, text).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    rows = dealt.groupBy("shard").applyInArrow(lambda shard: build(shard, n_docs, n_terms), _INDEX)
    return Index(written(rows, "lexical-index"), n_docs, n_terms, shards)


# ---------------------------------------------------------------- search


class Shard:
    """The lists of one shard that a set of queries needs; blocks are unpacked when first read."""

    def __init__(self, rows: pa.Table):
        is_term = np.asarray(rows["term"].is_valid())
        documents = rows.filter(pa.array(~is_term))
        rows = rows.filter(pa.array(is_term))
        self.ids = np.asarray(documents["best"].combine_chunks().flatten())
        self.m = np.frombuffer(documents["payload"][0].as_py(), dtype="<i8")
        self.at = {t: i for i, t in enumerate(rows["term"].to_pylist())}
        self.top = rows["top"].to_pylist()
        split = lambda name: np.split(np.asarray(rows[name].combine_chunks().flatten()), self._cuts)
        counts = np.asarray(rows["last"].combine_chunks().value_lengths()) if len(rows) else np.zeros(0, np.int64)
        self._cuts = np.cumsum(counts)[:-1]
        self.last, self.best, self.start, self.widths = ([], [], [], []) if not len(rows) else map(split, ("last", "best", "start", "widths"))
        self.n = rows["n"].to_pylist()
        self.payload = rows["payload"].combine_chunks() if len(rows) else None
        self.unpacked = 0  # blocks
        self._open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block of list ``i``."""
        found = self._open.get((i, b))
        if found is None:
            n = min(BLOCK, self.n[i] - b * BLOCK)
            w_doc, w_tf = divmod(int(self.widths[i][b]), 8)
            raw = self.payload[i].as_buffer()
            at = int(self.start[i][b])
            doc = np.cumsum(np.frombuffer(raw, f"<u{w_doc}", n, at), dtype=np.int64)
            tf = np.frombuffer(raw, f"<u{w_tf}", n, at + n * w_doc)
            found = self._open[i, b] = (doc, impacts(tf, self.m[doc]))
            self.unpacked += 1
        return found

    def search(self, query: list[tuple[int, int]], k: int, needed: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best documents of a query (``term, weight``) that score at least ``needed``: positions
        and scores, best first, ties by position."""
        found = [(w * self.top[self.at[t]], self.at[t], w) for t, w in query if w > 0 and t in self.at]
        found.sort()
        bounds = np.cumsum([bound for bound, _, _ in found])
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for low in range(0, len(self.ids), WINDOW):
            high = min(low + WINDOW, len(self.ids))
            split = int(np.searchsorted(bounds, needed))  # lists before it are non-essential
            if split == len(found):
                break
            total = np.zeros(high - low, dtype=np.int64)
            for _, i, w in found[split:]:
                for b in range(int(np.searchsorted(self.last[i], low)), len(self.last[i])):
                    doc, impact = self.block(i, b)
                    begin, end = np.searchsorted(doc, (low, high))
                    total[doc[begin:end] - low] += w * impact[begin:end]
                    if self.last[i][b] >= high - 1:
                        break
            rest = int(bounds[split - 1]) if split else 0
            at = np.flatnonzero((total > 0) & (total + rest >= needed))
            score = total[at]
            for place in range(split - 1, -1, -1):
                _, i, w = found[place]
                rest = int(bounds[place - 1]) if place else 0
                b = np.searchsorted(self.last[i], at + low)
                most = np.where(b < len(self.last[i]), w * self.best[i][np.minimum(b, len(self.last[i]) - 1)], 0)
                near = score + most + rest >= needed
                at, score, b = at[near], score[near], b[near]
                for one in np.unique(b[b < len(self.last[i])]):
                    doc, impact = self.block(i, int(one))
                    mine = np.flatnonzero(b == one)
                    where = np.minimum(np.searchsorted(doc, at[mine] + low), len(doc) - 1)
                    score[mine] += np.where(doc[where] == at[mine] + low, w * impact[where], 0)
                near = score + rest >= needed
                at, score = at[near], score[near]
            docs, scores = np.append(docs, at + low), np.append(scores, score)
            best = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[best], scores[best]
            if len(docs) == k:  # a later document has to beat the last one
                needed = max(needed, int(scores[-1]) + 1)
        return docs, scores


def _searched(hits: DataFrame, queries, needed, k: int) -> DataFrame:
    """``item_id, doc_id, score``: the best of every shard in ``hits``."""

    def run(rows: pa.Table) -> pa.Table:
        shard = Shard(rows)
        items, docs, scores = [], [], []
        for item, query in queries.value.items():
            at, score = shard.search(query, k, needed.value.get(item, 1))
            items.append(np.full(len(at), item, np.int64))
            docs.append(shard.ids[at])
            scores.append(score)
        return pa.table({"item_id": np.concatenate(items), "doc_id": np.concatenate(docs), "score": np.concatenate(scores)})

    return hits.groupBy("shard").applyInArrow(run, "item_id long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(found: Index, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every query.

    Queries are searched in sets of about :data:`QUERY_TERMS` terms, which are what is broadcast.
    """
    spark = queries.sparkSession
    asked = terms(queries, key, text).select(F.col("id").alias("item"), F.explode("terms").alias("term")).distinct()
    asked = written(asked, "lexical-queries")
    sets = max(1, -(-asked.count() // QUERY_TERMS))
    index_terms = found.rows.filter("term IS NOT NULL")
    weight = F.floor(1000 * F.log(F.lit(2.0 * found.n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    out = None
    for number in range(sets):
        mine = asked.filter(F.pmod(F.xxhash64("item"), F.lit(sets)) == number)
        own = mine.select("term").distinct()
        hits = index_terms.join(own, "term", "left_semi").unionByName(found.rows.filter("term IS NULL"))
        hits = written(hits, "lexical-hits")
        df = hits.filter("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df"))
        weighed = mine.join(df, "term").groupBy("item").agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("ts"))
        shared = spark.sparkContext.broadcast({r["item"]: [(t["term"], t["w"]) for t in r["ts"]] for r in weighed.collect()})
        if not shared.value:
            continue
        seed = written(_searched(hits.filter("shard = 0"), shared, spark.sparkContext.broadcast({}), k), "lexical-seed")
        last = seed.groupBy(F.col("item_id")).agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c")).filter(F.col("c") >= k)
        needed = spark.sparkContext.broadcast({r["item_id"]: r["s"] for r in last.collect()})
        rest = _searched(hits.filter("shard > 0"), shared, needed, k)
        ranked = written(_ranked(rest.unionByName(seed), k), "lexical-ranked")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
