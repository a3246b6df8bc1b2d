"""Quality rules: base rules on a document's own words, and cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space runs as one space) and hashed; for every
host, the distinct documents that hold a line are counted. Lines held by more documents than the
host's limit are removed, and a document that loses too many of its words is rejected. Exact
copies of a text count as one document, so that copying a document doesn't condemn its lines.

Defined cases: a null text is empty (no words, fails the base rules); a null host is a host of
its own; rows with equal ids are judged one by one; an empty table gives no rows. A line of any
length is one hash; hot lines and hosts are counted with map-side partial sums. Other columns
are kept, columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from disclosure.llm.text import IS_SPACE, Words, blocks, lists, signed, span_hashes, utf8

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_SHARE = 0.30
# A host's limit: this share of its distinct documents, and at least so many documents.
LIMIT_SHARE = 0.02
LIMIT_DOCS = 20
# A document is depleted when less than this share of its words is left.
MIN_LEFT = 0.3

# --- Fixed values: characters counted as symbols. ---
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True

_FEATURES = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("text_key", T.LongType()),
    ("line_keys", T.ArrayType(T.LongType())),
    ("line_words", T.ArrayType(T.LongType())),
]


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose (row, key) occurs more than once, and those that have an earlier equal."""
    order = np.lexsort((keys, rows))
    same = (rows[order][1:] == rows[order][:-1]) & (keys[order][1:] == keys[order][:-1])
    many = np.zeros(len(rows), dtype=bool)
    later = np.zeros(len(rows), dtype=bool)
    later[order[1:]] = same  # lexsort is stable: the first of equals keeps its place
    many[order[1:]] = same
    many[order[:-1]] |= same
    return many, later


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans, rows and first words of the lines that hold a word (``first`` has one more entry)."""
    breaks = np.flatnonzero(words.data == 10)
    starts = np.unique(np.concatenate([words.offsets[:-1], breaks + 1]))
    starts = starts[starts < len(words.data)]
    ends = np.append(starts, len(words.data))[1:]
    # A line ends before its line break; the last line of a text has none.
    ends -= words.data[ends - 1] == 10
    first = np.searchsorted(words.starts, np.append(starts, len(words.data)))
    held = np.flatnonzero(first[1:] > first[:-1])
    rows = np.searchsorted(words.offsets, starts[held], "right") - 1
    return starts[held], ends[held], rows, np.append(first[held], len(words.starts))


def features(column: pa.Array) -> list[pa.Array]:
    words = Words(column)
    n = len(column)
    lead = ((words.data & 0xC0) != 0x80) & ~IS_SPACE[words.data]
    starts, ends, rows, first = _lines(words)
    exact = span_hashes(words.data, starts, ends)
    _, earlier = _repeated(rows, exact)
    lowered = Words(column, lower=True).hashes()
    keys = span_hashes(lowered, first[:-1], first[1:])
    plain = words.hashes()
    at, windows = words.windows(plain, REPEAT_WINDOW)
    many, _ = _repeated(words.rows[at], windows)
    cover = np.zeros(len(plain) + 1, dtype=np.int64)
    np.add.at(cover, at[many], 1)
    np.add.at(cover, at[many] + REPEAT_WINDOW, -1)
    covered = words.rows[np.cumsum(cover[:-1]) > 0]
    whole = span_hashes(words.data, words.offsets[:-1], words.offsets[1:], 1)
    per_line = np.bincount(rows, minlength=n)
    return [
        pa.array(words.counts),
        pa.array(_per_row(lead, words.offsets)),
        pa.array(_per_row(_IS_SYMBOL[words.data], words.offsets)),
        pa.array(np.bincount(rows[earlier], minlength=n).astype(np.int64)),
        pa.array(np.bincount(covered, minlength=n).astype(np.int64)),
        signed(whole),
        lists(keys.view(np.int64), per_line),
        lists(np.diff(first).astype(np.int64), per_line),
    ]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the base counts, a key of the text, and its lines' keys
    (``line_keys``, ``line_words``: every line that holds a word, in order)."""
    added = {name for name, _ in _FEATURES}
    keep = [f for f in docs.schema.fields if f.name != text and f.name not in added]
    schema = T.StructType(keep + [T.StructField(name, kind) for name, kind in _FEATURES])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            own = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(own + features(batch.column(text)), names=schema.names)

    return docs.select(*names, text).mapInArrow(run, schema)


def frequent_lines(
    measured: DataFrame, host: str = "source", share: float = LIMIT_SHARE, least: int = LIMIT_DOCS
) -> DataFrame:
    """``host, line_key, n_docs``: lines in more distinct documents of a host than its limit."""
    held = measured.select(
        F.col(host).alias("host"), "text_key", F.explode(F.array_distinct("line_keys")).alias("line_key")
    ).distinct()
    counts = held.groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") > least)
    hosts = measured.select(F.col(host).alias("of"), "text_key").distinct()
    hosts = hosts.groupBy("of").agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        counts.join(hosts, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("n_docs") > F.col("host_docs") * share)
        .select("host", "line_key", "n_docs")
    )


def judge(
    measured: DataFrame, frequent: DataFrame, host: str = "source", row_key: str = "doc_id", min_left: float = MIN_LEFT
) -> DataFrame:
    """``measured`` with ``removed_lines`` (keys), ``words_left``, ``base_failed`` and ``kept``."""
    key = F.xxhash64(F.col(row_key), F.col(host), F.col("text_key"))
    held = measured.select(key.alias("quality_row"), F.col(host).alias("in"), F.explode("line_keys").alias("of"))
    hits = (
        held.join(frequent, F.col("in").eqNullSafe(F.col("host")) & (F.col("of") == F.col("line_key")))
        .groupBy("quality_row")
        .agg(F.collect_set("line_key").alias("quality_hits"))
    )
    removed = F.coalesce("quality_hits", F.array().cast("array<bigint>"))
    lost = F.aggregate(
        F.zip_with("line_keys", "line_words", lambda x, n: F.when(F.array_contains("removed_lines", x), n).otherwise(0)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(round(100 * MAX_REPEAT_SHARE)) * F.col("n_words")
    )
    return (
        measured.withColumn("quality_key", key)
        .join(hits, F.col("quality_key") == F.col("quality_row"), "left")
        .withColumn("removed_lines", removed)
        .drop("quality_row", "quality_hits", "quality_key")
        .withColumn("words_left", F.col("n_words") - lost)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("words_left") >= F.col("n_words") * min_left))
    )


def without_lines(docs: DataFrame, text: str = "text", removed: str = "removed_lines") -> DataFrame:
    """``docs`` (with the keys of lines to remove) with those lines cut out of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text):
            column = batch.column(text)
            words = Words(column, lower=True)
            starts, ends, rows, first = _lines(words)
            keys = span_hashes(words.hashes(), first[:-1], first[1:]).view(np.int64)
            gone = [set(x or ()) for x in batch.column(removed).to_pylist()]
            raw = utf8(column)[0].tobytes()
            cuts: list[list[tuple[int, int]]] = [[] for _ in gone]
            for i, j, row, key in zip(starts.tolist(), ends.tolist(), rows.tolist(), keys.tolist()):
                if key in gone[row]:
                    cuts[row].append((i, j))
            texts = []
            for row, spans in enumerate(cuts):
                at, end = int(words.offsets[row]), int(words.offsets[row + 1])
                parts = []
                for i, j in spans:
                    parts.append(raw[at:i])
                    at = min(j + 1, end)
                texts.append(b"".join([*parts, raw[at:end]]).decode() if column[row].is_valid else None)
            place = batch.schema.get_field_index(text)
            yield batch.set_column(place, text, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)
