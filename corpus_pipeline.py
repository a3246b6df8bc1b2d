"""From raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on all
rows that its predecessor kept; :func:`run` writes each result and rereads it as the next stage's
input. All stages but the last return the columns of ``documents``.

Defined cases (the operators' own apply, too): an empty table passes every stage; a null text is
kept as it is until it is encoded as no tokens; a row without an id is never a duplicate; rows
that share an id are one document, of which the near-duplicate stage keeps the one with the longest
text (then the greatest in text, lang, source and n_chars). Texts of any length and columns besides
those of ``documents`` pass: whole texts are worked on, other columns are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.llm import bpe, mixing, neardup, substring, toxicity
from disclosure.llm.queries import vocabulary
from disclosure.llm.stage import prepare, written
from disclosure.sources.star import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document goes when it is more likely toxic than not.
REJECT = 0.5


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a classifier trained on all labels rejects."""
    prepare(spark)
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model, threshold=REJECT)
    return scored.filter("predicted = 0").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity 0.8)."""
    prepare(spark)
    docs = docs.select(*COLUMNS)
    found = neardup.near_duplicates(docs, size=5)
    kept = found.filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    left = docs.join(written(kept, "pipeline-kept"), F.col("doc_id") == F.col("id"), "left_semi")
    often = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(F.col("doc_id").alias("id"))
    often = written(often, "pipeline-repeated")
    order = F.struct(F.length("text").alias("length"), *[c for c in COLUMNS if c != "doc_id"])
    several = left.join(often, F.col("doc_id") == F.col("id"), "left_semi").groupBy("doc_id").agg(F.max(order).alias("row"))
    several = several.select("doc_id", *[f"row.{c}" for c in COLUMNS if c != "doc_id"]).select(*COLUMNS)
    single = left.join(often, F.col("doc_id") == F.col("id"), "left_anti")
    return single.unionByName(several).unionByName(docs.filter("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 or more words that an earlier document has; drops what is left empty."""
    prepare(spark)
    left = substring.without_repeats(docs.select(*COLUMNS))
    left = left.filter("n_removed < n_words OR n_words = 0")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents to their sources' targets and shuffles them inside output shards."""
    prepare(spark)
    measured = mixing.measure(docs.select(*COLUMNS)).drop("block")
    narrow = written(measured.drop("doc"), "mix-measured")
    shards, blocks = mixing.layout(narrow.agg(F.sum("size")).first()[0] or 0)
    planned = written(mixing.plan(mixing.dealt(narrow, blocks), shards=shards, written=written), "mix-plan")
    small = planned.count() <= mixing.PLAN_ROWS
    mixed = mixing.mix(mixing.allocate(mixing.dealt(measured, blocks), planned, small=small))
    return mixing.shuffled(mixed, shards).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source``, the token ids of the text, and digests of ids and decoded text."""
    prepare(spark)
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary(), with_ids=True)


STAGES = [
    ("toxicity", toxic_filter),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Training a classifier is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
