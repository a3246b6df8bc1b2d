"""Language identification with language-bitmask n-gram filters.

Training counts letter trigrams of every training text per language. A language contains a
trigram that makes up at least ``MIN_RATE`` of its trigrams and at least ``MIN_RATIO`` of the
rate in the language that uses it most. The contained pairs go into one bit-sliced Bloom filter:
a slot holds a mask with one bit per language, inserting sets the language's bit in ``HASHES``
slots, and the AND of a trigram's slots is the set of all languages that contain it, in one
lookup. A text's hits per language are counted, corrected for the filter's false positives, and
the language with most hits wins (ties: the first by name).

Sizes are bounded: at most ``1 / MIN_RATE`` trigrams per language are kept, and the filter has
``SLOTS_PER_ENTRY`` slots for each, rounded up to a power of two.

Defined cases: a text without letters (or null) is ``und`` with score 0; letters without any
known trigram get the commonest training language with score 0; without any labelled text, so
also with an empty table, all predictions are ``und``. Invalid UTF-8 counts as U+FFFD, which is no
letter; texts may be of any length, one that is longer than a block is a block of its own. Rows are judged one by one and keep their other columns; columns named
like an output are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disclosure.llm.text import blocks, mix, utf8

MIN_RATE = 2e-5
MIN_RATIO = 0.1
HASHES = 3
SLOTS_PER_ENTRY = 16
UNKNOWN = "und"

_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for anything else."""
    if not _FOLD:
        table = np.zeros(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and exact codes (21 bits a code point) of all trigrams around a letter, and letters per row.

    Anything but a letter counts as one kind of border; texts have a border at both ends.
    """
    data, offsets = utf8(column)
    n = len(column)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    starts = np.searchsorted(leads, offsets)
    # One border before every text and one at the end of all.
    folded = np.zeros(len(points) + n + 1, dtype=np.int64)
    shift = np.repeat(np.arange(1, n + 1), np.diff(starts))
    folded[np.arange(len(points)) + shift] = fold_table()[points]
    middle = np.flatnonzero(folded)
    codes = (folded[middle - 1] << 42) | (folded[middle] << 21) | folded[middle + 1]
    rows = np.searchsorted(starts + np.arange(n + 1), middle, "right") - 1
    return rows, codes, np.bincount(rows, minlength=n)


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, gram, n`` over all rows with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            names = batch.column(lang).dictionary_encode()
            label = np.asarray(names.indices)
            rows, codes, _ = trigrams(batch.column(text))
            order = np.lexsort((codes, label[rows]))
            a, b = label[rows][order], codes[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else []
            counts = np.diff(np.append(new, len(a))) if len(a) else []
            for at in range(0, len(new), 100_000):
                part = new[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.dictionary.take(pa.array(a[part])),
                        pa.array(b[part]),
                        pa.array(np.asarray(counts[at : at + 100_000], dtype=np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    schema = "lang string, gram long, n long"
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias(lang), text)
    return known.mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filter:
    """Languages by name, slot masks (``words`` of 64 languages each), false-positive rate per language."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    usual: int

    def places(self, codes: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.slots) - 1)
        seeds = [np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)) for i in range(HASHES)]
        return [(mix(codes.view(np.uint64) + s) & size).astype(np.int64) for s in seeds]

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """Bitmask of all languages that contain each trigram."""
        out = None
        for place in self.places(codes):
            out = self.slots[place] if out is None else out & self.slots[place]
        return out


def build_filter(entries: list[tuple[str, int]], totals: dict[str, int]) -> Filter:
    """``entries``: (language, trigram) pairs; ``totals``: trigrams counted per language."""
    languages = sorted(totals)
    place = {name: i for i, name in enumerate(languages)}
    grams = len({g for _, g in entries})
    size = 1 << max(10, (SLOTS_PER_ENTRY * max(grams, 1) - 1).bit_length())
    slots = np.zeros((size, max(1, -(-len(languages) // 64))), dtype=np.uint64)
    usual = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i)) if languages else -1
    made = Filter(languages, slots, np.zeros(len(languages)), usual)
    codes = np.array([g for _, g in entries], dtype=np.int64)
    owner = np.array([place[name] for name, _ in entries], dtype=np.int64)
    for at in made.places(codes):
        np.bitwise_or.at(slots, (at, owner // 64), np.uint64(1) << (owner % 64).astype(np.uint64))
    for i in range(len(languages)):
        bits = (slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        made.false_rate[i] = float(bits.mean()) ** HASHES
    return made


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Filter:
    """The filter of all rows of ``docs`` with a language. Counting is distributed; the driver
    gets the contained pairs, a bounded number per language."""
    counts = count_trigrams(docs, text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counts.join(totals.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of")).select(
        "gram", "lang", "total", (F.col("n") / F.col("total")).alias("rate")
    )
    kept = rates.filter(F.col("rate") >= MIN_RATE)
    best = kept.groupBy("gram").agg(
        F.max("rate").alias("best"), F.collect_list(F.struct("lang", "rate", "total")).alias("found")
    )
    pairs = best.select("gram", "best", F.explode("found").alias("f")).filter(
        F.col("f.rate") >= F.col("best") * MIN_RATIO
    )
    rows = pairs.select("f.lang", "gram", "f.total").collect()
    return build_filter([(r["lang"], r["gram"]) for r in rows], {r["lang"]: r["total"] for r in rows})


def predict(docs: DataFrame, model: Filter, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score`` (the winner's share of all
    corrected hits)."""
    added = ("lang_pred", "score")
    keep = [f for f in docs.schema.fields if f.name not in (*added, text)]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = [f.name for f in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labels = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in blocks(batches, text):
            rows, codes, letters = trigrams(batch.column(text))
            n = batch.num_rows
            best, top, total = np.full(n, -1), np.zeros(n), np.zeros(n)
            masks = model.masks(codes)
            for i, rate in enumerate(model.false_rate):
                bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                hits = np.bincount(rows, weights=bit.astype(np.float64), minlength=n)
                hits = np.maximum((hits - letters * rate) / (1 - rate), 0.0)
                total += hits
                better = hits > top
                best[better], top[better] = i, hits[better]
            best[(best < 0) & (letters > 0)] = model.usual
            score = np.divide(top, total, out=np.zeros(n), where=total > 0)
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(labels[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))], names=schema.names
            )

    return docs.select(*names, text).mapInArrow(run, schema)
