"""The registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from disclosure.llm import bpe, chat, embeddup, language, lengths, lexical, mixing, neardup, neighbours, quality, substring, toxicity, trie
from disclosure.llm.stage import prepare, remainder, written
from disclosure.sources.star import read_table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file, the same on every worker."""
    return public_tokenizers.path(name)


def op1_token_lengths(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    histogram = lengths.length_histogram(read_table(spark, sf, "documents"), vocabulary())
    return lengths.suffix_sums(written(histogram, "lengths"))


def op2_minhash(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return neardup.near_duplicates(read_table(spark, sf, "documents").select("doc_id", "text"), size=2)


def op3_substring(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return substring.digests(read_table(spark, sf, "documents").select("doc_id", "text"))


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf, "documents")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = language.learn(docs.filter(remainder("doc_id", 3) != 1).select("lang", "text"))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    tricky = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(chat.conversations(rows)))


def op6_bpe(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return bpe.round_trip(read_table(spark, sf, "documents").select("doc_id", "text"), vocabulary())


def op7_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return neighbours.neighbours(read_table(spark, sf, "embeddings"), F.col("id") % 50 == 0)


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "text")
    measured = written(quality.measure(docs), "quality-measured")
    judged = quality.judge(measured, quality.frequent_lines(measured))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    measured = written(
        mixing.measure(docs).select(F.struct("doc.doc_id").alias("doc"), "source", "size", "place"), "mix-measured"
    )
    shards, blocks = mixing.layout(measured.agg(F.sum("size")).first()[0] or 0)
    measured = mixing.dealt(measured, blocks)
    allocated = mixing.allocate(measured, mixing.plan(measured, shards=shards, written=written))
    return allocated.select(
        "doc.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("draws")).alias("taken"),
    )


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    labels = read_table(spark, sf, "labels").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels.filter(remainder("doc_id", 4) != 2))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op11_search(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    found = lexical.index(read_table(spark, sf, "documents"))
    return lexical.search(found, read_table(spark, sf, "benchmark"))


def op12_trie(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    head = F.crc32(F.col("conv").cast("string")) % 9
    return trie.trie(turns, base=F.col("conv") - F.col("conv") % 5, head=head)


def op13_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return embeddup.near_duplicates(read_table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_lengths": op1_token_lengths,
    "op2_minhash": op2_minhash,
    "op3_substring": op3_substring,
    "op4_language": op4_language,
    "op5_chat": op5_chat,
    "op6_bpe": op6_bpe,
    "op7_neighbours": op7_neighbours,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_search": op11_search,
    "op12_trie": op12_trie,
    "op13_embeddings": op13_embeddings,
}

# The same conversations in SQL. Escaping adds one backslash to a control string, so a formatted
# conversation is as long as its texts, their control strings (one more each) and its markers.
_CONTROLS = r"""([<\[])(\\*)(s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\]|END\])"""
OP5_SQL = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), numbered AS (
  SELECT *, row_number() OVER w - 1 AS pos, coalesce(lag(role) OVER w, '') AS state,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(text, '{_CONTROLS}', '\1\\\2\3', 'g')) AS text_chars,
    length(regexp_replace(role, '{_CONTROLS}', '\1\\\2\3', 'g')) AS role_chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, CASE WHEN state || '>' || role NOT IN
      ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') THEN pos
    WHEN pos = n - 1 AND role NOT IN ('user', 'assistant') THEN n END AS bad
  FROM numbered
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 8
    ELSE role_chars + 21 END) AS BIGINT) AS formatted_chars,
  min(bad) IS NULL AS valid, CAST(min(bad) AS INTEGER) AS bad_turn
FROM judged GROUP BY conv_id
"""

OP3_SQL = r"""
WITH given AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), phrases AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM given)
), firsts AS (
  SELECT p, min(doc_id) AS ref FROM phrases GROUP BY p
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM phrases JOIN firsts USING (p) WHERE doc_id > ref
), lost AS (
  SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t
  FROM (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS j FROM given) ANTI JOIN gone USING (doc_id, j)
  GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM given LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM given WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reached r JOIN both_ways l ON r.y = l.x
), found AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM found LEFT JOIN sizes USING (doc_id)
"""
OP8_SQL = rf"""
WITH given AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS p
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM given)
), often AS (
  SELECT doc_id, p FROM windows GROUP BY doc_id, p HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS j FROM windows JOIN often USING (doc_id, p)) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, text, line,
    array_to_string(regexp_extract_all({_LOWER.format("line")}, '{_WORD}'), ' ') AS plain,
    len(regexp_extract_all(line, '{_WORD}')) AS n
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM given)
), dups AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE n > 0 GROUP BY doc_id
), hosts AS (
  SELECT source, count(DISTINCT text) AS docs FROM given GROUP BY source
), frequent AS (
  SELECT l.source, plain FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE n > 0
  GROUP BY l.source, plain, docs
  HAVING count(DISTINCT text) > {quality.LIMIT_DOCS} AND count(DISTINCT text) > docs * {quality.LIMIT_SHARE}
), lost AS (
  SELECT doc_id, sum(n) AS n FROM lines l SEMI JOIN frequent f
  ON l.source IS NOT DISTINCT FROM f.source AND l.plain = f.plain GROUP BY doc_id
), counted AS (
  SELECT g.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(d.n, 0) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS lost
  FROM given g LEFT JOIN dups d USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN lost l USING (doc_id)
), judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND n_words - lost >= n_words * {quality.MIN_LEFT} AS kept
FROM judged
"""

OP13_SQL = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), taking AS (
  SELECT * FROM given WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.n, a.vec_id AS x, b.vec_id AS y FROM taking a JOIN taking b ON a.label = b.label AND len(a.v) = len(b.v)
  WHERE a.n <> b.n AND list_cosine_similarity(a.v, b.v) >= 0.98
), counted AS (
  SELECT n, count(*) AS c FROM links GROUP BY n
), reached AS (
  SELECT vec_id AS x, vec_id AS y FROM given WHERE vec_id IS NOT NULL
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
), found AS (
  SELECT x, min(y) AS component FROM reached GROUP BY x
)
SELECT g.vec_id, CAST(coalesce(c, 0) AS BIGINT) AS n_links, component AS component_id,
  g.vec_id IS NOT DISTINCT FROM component AS kept
FROM given g LEFT JOIN counted USING (n) LEFT JOIN found ON x = g.vec_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP11_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS w
  FROM documents WHERE doc_id IS NOT NULL
), taking AS (
  SELECT r, doc_id, w, len(w) AS n FROM docs WHERE len(w) > 0
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM taking
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS t
  FROM benchmark WHERE item_id IS NOT NULL
), postings AS (
  SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM taking) SEMI JOIN asked USING (t)
  GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, totals GROUP BY t, n_docs
), scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (t) JOIN weights USING (t), totals GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

# CRC-32 byte by byte and bit by bit, with its polynomial (reflected) 0xEDB88320 = 3988292384.
_CRC32 = """xor(list_reduce([ord(b)::BIGINT for b in string_split({}, '')], lambda crc, b:
    list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
    4294967295::BIGINT), 4294967295)"""
OP12_SQL = f"""
WITH given AS (
  SELECT conv_id AS c, coalesce(text, '') AS text, sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS hash,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, '')))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT c, c - c % 5 AS base, {_CRC32.format("CAST(c AS VARCHAR)")} % 9 AS h, max(pos) AS own FROM given GROUP BY c
), convs AS (
  SELECT a.*, least(a.h, coalesce(b.own, 0)) AS taken FROM heads a LEFT JOIN heads b ON b.c = a.base
), built AS (
  SELECT v.c, pos, text, hash FROM convs v JOIN given g ON g.c = v.base AND pos <= h
  UNION ALL
  SELECT v.c, pos - h + taken, text, hash FROM convs v JOIN given g ON g.c = v.c AND pos > h
), paths AS (
  SELECT c, pos AS depth, octet_length(encode(text)) AS bytes,
    sha256(string_agg(hash, '') OVER (PARTITION BY c ORDER BY pos)) AS node,
    coalesce(sha256(string_agg(hash, '') OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 'root') AS up,
    pos = max(pos) OVER (PARTITION BY c) AS ends
  FROM built
  UNION ALL
  SELECT c, 0, 0, 'root', NULL, c NOT IN (SELECT c FROM built) FROM convs
), nodes AS (
  SELECT node, any_value(up) AS up, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY node
), kids AS (
  SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up
), sums AS (
  SELECT p.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(CASE WHEN x.depth > 0 THEN (x.n_convs - 1) * x.bytes ELSE 0 END) AS saved
  FROM nodes x LEFT JOIN kids k ON k.node = x.node JOIN paths p ON p.c = x.conv_id AND p.depth <= x.depth GROUP BY p.node
)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, x.n_convs, coalesce(k.n, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM nodes x JOIN sums s ON s.node = x.node LEFT JOIN nodes u ON u.node = x.up LEFT JOIN kids k ON k.node = x.node
"""

ORACLES: dict[str, str] = {
    "op2_minhash": OP2_SQL,
    "op3_substring": OP3_SQL,
    "op5_chat": OP5_SQL,
    "op8_quality": OP8_SQL,
    "op11_search": OP11_SQL,
    "op12_trie": OP12_SQL,
    "op13_embeddings": OP13_SQL,
}
