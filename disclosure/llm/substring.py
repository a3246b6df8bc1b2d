"""Substring deduplication by relative Lempel-Ziv parsing.

The reference of a document is what the documents with smaller ids say for the first time: a
reference block is a maximal run of consecutive phrases (``size`` words each) of one document that no
earlier document holds. So the index has one place per phrase however often it occurs, spread over
the cluster by hash of the phrase. A document is factored greedily against all blocks: a factor
starts at a word whose phrase a block holds and is the longest match there, that is, it grows as long
as the next phrase follows in the same block. At its end every phrase that crosses the boundary is
looked up again and may start the next factor, which then overlaps this one. A factor is ``size`` words
or longer; words covered by factors are removed. Phrases are judged on the input, not on what is left.

Against unpruned documents a longest match could be longer than against blocks: a passage whose
middle was said earlier elsewhere lies in three blocks and makes three overlapping factors. They cover
the same words. Every place of every phrase would have to be kept for that, and a phrase that a third of
all documents hold would meet them all in each.

Indexing every phrase would shuffle the corpus many times over. Whether a phrase can occur twice
is decided by its anchor, the smallest hash among its ``ANCHOR``-word sequences: equal phrases
have equal anchors, neighbouring phrases mostly share one, and only phrases whose anchor occurs
in two different documents are indexed. Documents that equal an earlier one word by word are one
factor each and neither looked up nor indexed.

Skew: hot anchors and phrases are reduced by map-side aggregation, and joined by sort-merge
joins that Spark splits; what meets in one task is one document's phrases.

Defined cases: a null text has no words; a text shorter than a phrase keeps all words; repeats
inside one document stay; rows with equal ids are not each other's reference; a row with a null
id has no order, so it is left as it is and no reference; an empty table gives no rows. Phrases
are told apart by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disclosure.llm.stage import written
from disclosure.llm.text import Words, blocks, mix, signed, span_hashes

PHRASE = 13  # words
ANCHOR = 5  # words

_MARKS = "array<struct<h:bigint,ref:bigint,pos:bigint>>"


def _documents(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every text's word sequence."""
    ends = words.first[1:]
    return span_hashes(hashes, words.first[:-1], ends, 0), span_hashes(hashes, words.first[:-1], ends, 1)


def _anchors(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and anchor of every phrase."""
    at = np.arange(max(0, len(hashes) - size + 1))
    at = at[words.rows[at] == words.rows[at + size - 1]] if len(at) else at
    short = np.arange(max(0, len(hashes) - ANCHOR + 1))
    # Sequences across texts are hashed, too, but no phrase covers them.
    grams = span_hashes(hashes, short, short + ANCHOR).view(np.int64)
    least = grams[at] if len(at) else np.zeros(0, np.int64)
    for step in range(1, size - ANCHOR + 1):
        np.minimum(least, grams[at + step], out=least)
    return at, least


def _distinct(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the first of every distinct (row, value); rows must not decrease."""
    change = np.ones(len(rows), dtype=bool)
    change[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(change)
    order = at[np.lexsort((at, values[at], rows[at]))]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows[order][1:] != rows[order][:-1]) | (values[order][1:] != values[order][:-1])
    return order[new]


def document_keys(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, a, b, n_words`` of every row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            words = Words(batch.column(text))
            a, b = _documents(words, words.hashes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), signed(a), signed(b), pa.array(words.counts)], names=["id", "a", "b", "n_words"]
            )

    return _narrow(docs, key, text).mapInArrow(run, "id long, a long, b long, n_words long")


def _narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), text)


def anchors(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """``anchor, doc``: the distinct anchors of every text, with the text's own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            words = Words(batch.column(text))
            hashes = words.hashes()
            own, _ = _documents(words, hashes)
            at, least = _anchors(words, hashes, size)
            rows = words.rows[at]
            kept = _distinct(rows, least)
            yield pa.RecordBatch.from_arrays(
                [pa.array(least[kept]), signed(own[rows[kept]])], names=["anchor", "doc"]
            )

    return _narrow(docs, key, text).mapInArrow(run, "anchor long, doc long")


def _listed(column: pa.Array, field: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every entry of a list column (a field of its structs)."""
    counts = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    values = column.flatten()
    if field is not None:
        values = pa.compute.struct_field(values, field)
    return np.repeat(np.arange(len(column)), counts), np.asarray(values, dtype=np.int64)


def _row_keys(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    return mix(values.view(np.uint64) + mix(rows.astype(np.uint64) + np.uint64(1)))


def phrases(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    """``h, g, id, pos`` of the distinct phrases with an anchor in the row's ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            words = Words(batch.column(text))
            hashes = words.hashes()
            at, least = _anchors(words, hashes, size)
            wanted = _row_keys(*_listed(batch.column("anchors")))
            at = at[np.isin(_row_keys(words.rows[at], least), wanted)]
            one = span_hashes(hashes, at, at + size, 0).view(np.int64)
            two = span_hashes(hashes, at, at + size, 1).view(np.int64)
            rows = words.rows[at]
            kept = _distinct(rows, one)
            ids = batch.column(key).take(pa.array(rows[kept]))
            place = at[kept] - words.first[rows[kept]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[kept]), pa.array(two[kept]), ids, pa.array(place.astype(np.int32))],
                names=["h", "g", "id", "pos"],
            )

    return docs.select(key, text, "anchors").mapInArrow(run, "h long, g long, id long, pos int")


def repeats(docs: DataFrame, size: int = PHRASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What to remove, by id: ``id``, ``marks`` (phrase hash and where the reference has it
    first) and ``whole`` (hash of a text that equals an earlier document, and that document)."""
    keys = written(document_keys(docs, key, text).filter(F.col("n_words") >= size), "document-keys")
    firsts = written(keys.groupBy("a", "b", "n_words").agg(F.min("id").alias("ref")), "firsts")
    same = [F.col(f"k.{c}") == F.col(f"f.{c}") for c in ("a", "b", "n_words")]
    whole = (
        keys.alias("k")
        .join(firsts.alias("f"), same[0] & same[1] & same[2])
        .filter(F.col("k.id") > F.col("f.ref"))
        .groupBy(F.col("k.id").alias("id"))
        .agg(F.collect_set(F.struct(F.col("k.a").alias("a"), F.col("f.ref").alias("ref"))).alias("whole"))
    )

    found = anchors(docs, size, key, text)
    shared = found.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    shared = written(shared.filter("lo <> hi").select("anchor"), "anchors")
    of_doc = found.join(shared, "anchor").groupBy("doc").agg(F.collect_set("anchor").alias("anchors"))
    of_id = of_doc.join(firsts.select(F.col("a").alias("doc"), F.col("ref").alias("id")), "doc")
    of_id = written(of_id.groupBy("id").agg(F.flatten(F.collect_list("anchors")).alias("anchors")), "anchored")

    of_id = of_id.withColumnRenamed("id", "anchored_id")
    texts = _narrow(docs, key, text).join(of_id, F.col(key) == F.col("anchored_id"))
    found_phrases = written(phrases(texts, size, key, text), "phrases")
    index = (
        found_phrases.groupBy("h", "g")
        .agg(F.min("id").alias("ref"), F.min_by("pos", "id").alias("ref_pos"), F.max("id").alias("last"))
        .filter("last > ref")
        .select(F.col("h").alias("ih"), F.col("g").alias("ig"), "ref", "ref_pos")
    )
    index = written(index, "index")
    known = found_phrases.join(index, (F.col("h") == F.col("ih")) & (F.col("g") == F.col("ig"))).filter("id > ref")
    marks = known.groupBy("id").agg(
        F.collect_list(F.struct("h", "ref", F.col("ref_pos").cast("long").alias("pos"))).alias("marks")
    )
    return written(
        marks.join(whole, "id", "full").select(
            "id",
            F.coalesce("marks", F.array().cast(_MARKS)).alias("marks"),
            F.coalesce("whole", F.array().cast("array<struct<a:bigint,ref:bigint>>")).alias("whole"),
        ),
        "repeats",
    )


class _Parse:
    """Factors of a block of texts, and the words they leave."""

    def __init__(self, batch: pa.RecordBatch, size: int, text: str):
        self.words = words = Words(batch.column(text))
        n = batch.num_rows
        hashes = words.hashes()
        own, _ = _documents(words, hashes)
        copied, key = _listed(batch.column("repeat_whole"), "a")
        _, ref = _listed(batch.column("repeat_whole"), "ref")
        hit = own[copied].view(np.int64) == key
        self.copy_of = np.full(n, -1, dtype=np.int64)
        self.copy_of[copied[hit]] = ref[hit]
        is_copy = np.zeros(n, dtype=bool)
        is_copy[copied[hit]] = True
        self.is_copy = is_copy & (words.counts >= size)

        rows, known = _listed(batch.column("repeat_marks"), "h")
        keys = _row_keys(rows, known)
        order = np.argsort(keys)
        at, found = words.windows(hashes, size)
        mine = _row_keys(words.rows[at], found.view(np.int64))
        place = np.minimum(np.searchsorted(keys[order], mine), max(len(keys) - 1, 0))
        ok = keys[order][place] == mine if len(keys) else np.zeros(len(at), dtype=bool)
        ok &= ~self.is_copy[words.rows[at]]
        at, place = at[ok], order[place[ok]] if len(keys) else place[:0]
        ref = _listed(batch.column("repeat_marks"), "ref")[1][place]
        pos = _listed(batch.column("repeat_marks"), "pos")[1][place]
        # A factor goes on while the next word's phrase is the next one of the same reference.
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (ref[1:] != ref[:-1]) | (pos[1:] != pos[:-1] + 1)
        new[1:] |= words.rows[at[1:]] != words.rows[at[:-1]]
        first = np.flatnonzero(new)
        grown = np.diff(np.append(first, len(at)))
        self.start, self.length = at[first], grown + size - 1
        self.ref, self.ref_pos = ref[first], pos[first]
        self.rows = words.rows[self.start]
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(cover, self.start, 1)
        np.add.at(cover, self.start + self.length, -1)
        self.gone = (np.cumsum(cover[:-1]) > 0) | self.is_copy[words.rows]
        self.removed = np.bincount(words.rows[self.gone], minlength=n).astype(np.int64)

    def kept_words(self, row: int, raw: bytes) -> bytes:
        w = self.words
        span = np.arange(w.first[row], w.first[row + 1])
        span = span[~self.gone[span]]
        return b" ".join([raw[i:j] for i, j in zip(w.starts[span].tolist(), w.ends[span].tolist())])

    def kept_text(self, row: int, raw: bytes) -> bytes:
        """The text without the removed words; a line break or space stays where they were."""
        w = self.words
        span = np.arange(w.first[row], w.first[row + 1])
        span = span[~self.gone[span]]
        if not len(span):
            return b""
        cut = np.flatnonzero(np.diff(span) > 1)
        begin = w.starts[span[np.concatenate([[0], cut + 1])]].tolist()
        end = w.ends[span[np.concatenate([cut, [len(span) - 1]])]].tolist()
        out = [raw[begin[0] : end[0]]]
        for at, i, j in zip(end, begin[1:], end[1:]):
            out += [b"\n" if b"\n" in raw[at:i] else b" ", raw[i:j]]
        return b"".join(out)

    def factors(self, n: int) -> list[list[dict]]:
        out: list[list[dict]] = [[] for _ in range(n)]
        first = self.words.first
        for i, row in enumerate(self.rows.tolist()):
            start = int(self.start[i] - first[row])
            out[row].append(
                {"start": start, "n_words": int(self.length[i]), "ref": int(self.ref[i]), "ref_start": int(self.ref_pos[i])}
            )
        for row in np.flatnonzero(self.is_copy).tolist():
            out[row] = [
                {"start": 0, "n_words": int(self.words.counts[row]), "ref": int(self.copy_of[row]), "ref_start": 0}
            ]
        return out


def _marked(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    names = {"id": "repeat_id", "marks": "repeat_marks", "whole": "repeat_whole"}
    return docs.join(found.withColumnsRenamed(names), F.col(key) == F.col("repeat_id"), "left").drop("repeat_id")


_FACTORS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("ref", T.LongType()),
            T.StructField("ref_start", T.IntegerType()),
        ]
    )
)


def without_repeats(docs: DataFrame, size: int = PHRASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated words cut out of the text, and ``n_words``, ``n_removed`` (words
    before, and removed) and ``factors`` (start, words, reference document and its start).

    Own columns of those names, or named ``repeat_*`` as the marks are, are replaced.
    """
    added = [("n_words", T.LongType()), ("n_removed", T.LongType()), ("factors", _FACTORS)]
    hidden = {"repeat_id", "repeat_marks", "repeat_whole", *(name for name, _ in added)}
    plain = docs.select(*[c for c in docs.columns if c not in hidden])
    schema = T.StructType(plain.schema.fields + [T.StructField(name, kind) for name, kind in added])
    names = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            parse = _Parse(batch, size, text)
            raw = parse.words.data.tobytes()
            column = batch.column(text)
            texts = column.to_pylist()
            for row in np.flatnonzero(parse.removed).tolist():
                texts[row] = parse.kept_text(row, raw).decode()
            own = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            factors = pa.array(
                parse.factors(batch.num_rows),
                pa.list_(
                    pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("ref", pa.int64()), ("ref_start", pa.int32())])
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(parse.words.counts), pa.array(parse.removed), factors], names=schema.names
            )

    return _marked(plain, repeats(plain, size, key, text), key).mapInArrow(run, schema)


def digests(docs: DataFrame, size: int = PHRASE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (kept words joined by one space) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            parse = _Parse(batch, size, text)
            raw = parse.words.data.tobytes()
            kept = [hashlib.sha256(parse.kept_words(row, raw)).hexdigest() for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(parse.words.counts), pa.array(parse.removed), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    plain = docs.select(F.col(key).cast("long").alias(key), text)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _marked(plain, repeats(plain, size, key, text), key).mapInArrow(run, schema)
