"""Toxicity by non-negative positive-unlabelled learning.

A logistic classifier in numpy is trained from confirmed toxic documents and unlabelled text. The
risk of calling unlabelled text clean is corrected by the class prior: the part of it that the
hidden toxic documents cause is taken away, and when that leaves less than nothing (the model
starts to fit single documents) the step goes the other way.

A document's features are its distinct words (letter runs, case folded) and their first 3 to 6
letters. Candidate features are those in at least ``MIN_SHARE`` of the positives, of these the
``candidates`` in the most positives; their document frequencies are counted over all documents,
and the ``KEPT`` that tell positives from all text best are used. The classifier is fitted on a
sample with documented bounds (at most ``positives`` confirmed toxic documents and about
``unlabelled`` others, chosen by hash of the id); the prior and all counts cover everything. The
three bounds are arguments of :func:`learn`; None takes everything.

Defined cases: a null or empty text has no features and scores by the prior alone; a document
labelled more than once is toxic if any of its rows says so; null labels are no labels; without
any confirmed toxic document, so also with an empty table, every score is 0. Rows are scored one
by one, whole texts of any length, and keep their other columns; columns named like an output are
replaced. Invalid UTF-8 counts as U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disclosure.llm.language import fold_table
from disclosure.llm.text import blocks, lists, span_hashes, utf8

POSITIVES = 10_000
UNLABELLED = 20_000
MIN_SHARE = 0.002
MIN_DOCS = 3
CANDIDATES = 1 << 17
KEPT = 4096
EVIDENCE = 8.0  # least log-likelihood gain of a feature over all positives
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.3


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct features of every text, ordered by row."""
    data, offsets = utf8(column)
    n = len(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    edges = np.searchsorted(leads, offsets)
    folded = fold_table()[points].astype(np.uint64)
    letter = np.concatenate([[False], folded > 0, [False]])
    cut = np.zeros(len(points) + 1, dtype=bool)
    cut[edges] = True
    inner = letter[1:-1]
    starts = np.flatnonzero(inner & (~letter[:-2] | cut[:-1]))
    ends = np.flatnonzero(inner & (~letter[2:] | cut[1:])) + 1
    rows = np.searchsorted(edges, starts, "right") - 1
    keys, owners = [span_hashes(folded, starts, ends, 0)], [rows]
    for size in PREFIXES:
        long = ends - starts >= size
        keys.append(span_hashes(folded, starts[long], starts[long] + size, 1))
        owners.append(rows[long])
    key, owner = np.concatenate(keys).view(np.int64), np.concatenate(owners)
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], key[new]


def _known(keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the sorted ``chosen``, and the place of those that are."""
    if not len(chosen):
        return np.zeros(len(keys), dtype=bool), np.zeros(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(chosen, keys), len(chosen) - 1)
    hit = chosen[at] == keys
    return hit, at[hit]


def document_frequency(docs: DataFrame, text: str = "text", among: np.ndarray | None = None) -> DataFrame:
    """``feature, n_docs`` over all documents, or only for the sorted features ``among``."""
    shared = None if among is None else docs.sparkSession.sparkContext.broadcast(among)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            _, keys = features(batch.column(text))
            if shared is not None:
                keys = keys[_known(keys, shared.value)[0]]
            keys, counts = np.unique(keys, return_counts=True)
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part]), pa.array(counts[part].astype(np.int64))], names=["feature", "n_docs"]
                )

    rows = docs.select(text).mapInArrow(run, "feature long, n_docs long")
    return rows.groupBy("feature").agg(F.sum("n_docs").alias("n_docs"))


def choose_features(
    positive: np.ndarray, everywhere: np.ndarray, n_positive: int, n_docs: int, kept: int = KEPT
) -> np.ndarray:
    """Places of the ``kept`` features whose rates differ most, by log-likelihood gain."""
    p = (positive + 0.5) / (n_positive + 1)
    q = (everywhere + 0.5) / (n_docs + 1)
    gain = n_positive * (p * np.log(p / q) + (1 - p) * np.log((1 - p) / np.maximum(1 - q, 1e-9)))
    gain[p <= q] = 0  # clean words are no evidence: one insult in a long text is still one
    best = np.argsort(-gain, kind="stable")[:kept]
    return np.sort(best[gain[best] >= EVIDENCE])


def train(
    rows: np.ndarray,
    places: np.ndarray,
    positive: np.ndarray,
    width: int,
    prior: float,
    steps: int = 600,
    rate: float = 0.05,
    decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative positive-unlabelled risk, by full-batch Adam steps.

    ``rows``/``places``: the features each sample document has; ``positive``: which documents
    are confirmed (the others are unlabelled). The loss is the bounded sigmoid one, so no single
    document can outweigh the rest of the estimate.
    """
    n = len(positive)
    weights = np.zeros(width + 1)
    weights[width] = np.log(prior / (1 - prior))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    share_p = positive / max(positive.sum(), 1)
    share_u = ~positive / max((~positive).sum(), 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=weights[places], minlength=n) + weights[width]
        chance = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        left = share_u @ chance - prior * (share_p @ chance)  # unlabelled risk, corrected
        bend = chance * (1 - chance)
        up = -prior * share_p * bend
        down = (share_u - prior * share_p) * bend
        slope = up + down if left >= 0 else -down
        grad = np.empty(width + 1)
        grad[:width] = np.bincount(places, weights=slope[rows], minlength=width)
        grad[width] = slope.sum()
        grad[:width] += decay * weights[:width]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        weights -= pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        np.maximum(weights[:width], 0, out=weights[:width])
    return weights[:width], float(weights[width])


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the bias (None: no toxic example was known)."""

    chosen: np.ndarray
    weights: np.ndarray
    bias: float | None

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(column))
        rows, keys = features(column)
        hit, at = _known(keys, self.chosen)
        z = np.bincount(rows[hit], weights=self.weights[at], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    positives: int | None = POSITIVES,
    unlabelled: int | None = UNLABELLED,
    candidates: int | None = CANDIDATES,
) -> Model:
    """Trains on ``docs`` (all text) and ``labels`` (only those that may be learned from)."""
    spark = docs.sparkSession
    judged = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    judged = judged.groupBy(F.col(key).alias("of")).agg((F.max(label) > 0).alias("toxic"))
    total = judged.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("p"))
    seen, toxic = total.first()
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), None)
    if not toxic:
        return nothing
    confirmed = judged.filter("toxic").select("of")
    if positives is not None:
        confirmed = F.broadcast(confirmed.orderBy(F.xxhash64("of"), "of").limit(positives))  # bounded by the argument
    of_positive = docs.select(key, text).join(confirmed, F.col(key) == F.col("of"), "left_semi")
    found = document_frequency(of_positive, text)
    n_positive = of_positive.count()
    if not n_positive:
        return nothing
    least = max(MIN_DOCS, int(np.ceil(MIN_SHARE * n_positive)))
    found = found.filter(F.col("n_docs") >= min(least, n_positive)).orderBy(F.desc("n_docs"), "feature")
    found = (found if candidates is None else found.limit(candidates)).toArrow()
    asked, positive = np.asarray(found["feature"]), np.asarray(found["n_docs"])
    order = np.argsort(asked)
    asked, positive = asked[order], positive[order]
    counted = document_frequency(docs, text, asked).toArrow()
    everywhere = np.zeros(len(asked), dtype=np.int64)
    _, at = _known(np.asarray(counted["feature"]), asked)
    everywhere[at] = np.asarray(counted["n_docs"])
    n_docs = docs.count()
    chosen = asked[choose_features(positive, everywhere, n_positive, n_docs)]
    shared = spark.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            rows, keys = features(batch.column(text))
            hit, at = _known(keys, shared.value)
            counts = np.bincount(rows[hit], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), lists(at.astype(np.int32), counts)], names=["positive", "places"]
            )

    share = 2**32 if unlabelled is None else int(2**32 * min(1.0, unlabelled / max(n_docs, 1)))
    sample = docs.select(key, text).join(confirmed, F.col(key) == F.col("of"), "left")
    sample = sample.select(F.col("of").isNotNull().alias("positive"), key, text).filter(
        F.col("positive") | (F.pmod(F.xxhash64(key), F.lit(2**32)) < share)
    )
    got = sample.select("positive", text).mapInArrow(run, "positive boolean, places array<int>").toArrow()
    got = got.combine_chunks()
    places = got["places"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    counts = np.asarray(places.value_lengths(), dtype=np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    prior = float(np.clip(toxic / seen, 1e-4, 0.9))
    mine = np.asarray(got["positive"].to_numpy(zero_copy_only=False) if got.num_rows else [], dtype=bool)
    weights, bias = train(rows, np.asarray(places.flatten(), dtype=np.int64), mine, len(chosen), prior)
    return Model(chosen, weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    added = ("score", "predicted")
    keep = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType(
        [*keep, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    names = [f.name for f in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            found = shared.value.scores(batch.column(text))
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=schema.names
            )

    return docs.select(*names).mapInArrow(run, schema)
