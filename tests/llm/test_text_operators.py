"""BPE, token lengths, language, quality and toxicity."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from disclosure.llm import bpe, language, lengths, quality, toxicity
from disclosure.llm.queries import vocabulary
from disclosure.llm.stage import prepare, remainder
from disclosure.sources.star import read_table
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.conftest import CLASHING, ROWS


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def _random_texts(n: int = 1500) -> list[str]:
    rng = random.Random(5)
    parts = ["'s", "'ll", "'", "''", "'S", " ", "  ", "\n", "\t", "é", "ß", "٣", "½", "　", "!", "??", "-", "ing", "the"]
    parts += ["<|endoftext|>", "<|endof", "😀", "don't", "\x1c", "\x85", "́", "​", "漢字", "ZZ", "a", "bc", "0"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    texts += ["".join(rng.choice("abcdefgh etnio") for _ in range(200)) for _ in range(n // 5)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x3000, 0x9000)])) for _ in range(60)) for _ in range(n // 5)]
    return [*texts, "", "a" * 3000, "ab" * 700, " " * 300]


def test_bpe_equals_the_library(library):
    vocab = bpe.encoder(vocabulary())
    texts = _random_texts()
    flat, counts = vocab.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist()):
        ids = flat[at : at + n].tolist()
        at += n
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert vocab.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_merges_short_and_long_words_alike():
    vocab = bpe.encoder(vocabulary())
    words = [b"unbelievably", b"aaaaaaa", b"\xff\xfe\xfd", b"thntonat", b"zzz zz"]
    together = vocab.merged_together(words)
    assert [list(memoryview(x).cast("i")) for x in together] == [vocab.merged(w) for w in words]


def test_bpe_columns_round_trip(spark, edge_docs, library):
    prepare(spark)
    encoded = bpe.encode(edge_docs, vocabulary())
    assert set(CLASHING) <= set(encoded.columns)
    rows = bpe.decode(encoded, vocabulary()).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "") and r.n_tokens == len(r.token_ids) and r.id == "own"
    digests = bpe.round_trip(edge_docs.select("doc_id", "text"), vocabulary(), with_ids=True).collect()
    for r in digests:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, r.token_ids)).encode()).hexdigest()
    assert bpe.encode(edge_docs.filter("doc_id < 0"), vocabulary()).count() == 0


def test_length_sums(spark, edge_docs, no_docs, library):
    prepare(spark)
    docs = edge_docs.select("text", "source").unionByName(read_table(spark, SF001, "documents").select("text", "source"))
    sizes = [(r.source, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()]
    sums = lengths.suffix_sums(lengths.length_histogram(docs, vocabulary())).cache()
    for r in sums.collect():
        at_least = [n for _, n in sizes if n >= r.n_tokens]
        assert (r.docs_at_least, r.tokens_at_least) == (len(at_least), sum(at_least))
        assert r.n_docs == sum(n == r.n_tokens for _, n in sizes)
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for _, n in sizes)
        assert r.quantile == pytest.approx(sum(n <= r.n_tokens for _, n in sizes) / len(sizes))
    for r in lengths.at_limits(sums, [0, 1, 100, 4096, 10**6]).collect():
        assert r.truncated_tokens == sum(min(n, r.context_limit) for _, n in sizes)
        assert r.docs_at_least == sum(n >= r.context_limit for _, n in sizes)
    ordered = sorted(n for _, n in sizes)
    assert lengths.length_at(sums, 0.5).first().n_tokens == ordered[-(-len(ordered) // 2) - 1]
    by = lengths.suffix_sums(lengths.length_histogram(docs, vocabulary(), by=["source"]), by=["source"])
    got = {r.source: r.total_tokens for r in by.collect()}
    assert got == {s: sum(n for t, n in sizes if t == s) for s in {s for s, _ in sizes}}
    assert lengths.suffix_sums(lengths.length_histogram(no_docs, vocabulary())).count() == 0


def test_base_rules_equal_brute_force(spark, edge_docs):
    prepare(spark)
    docs = read_table(spark, SF001, "documents").select("doc_id", "source", "text")
    docs = docs.unionByName(edge_docs.select("doc_id", "source", "text"))
    texts = {(r.doc_id, None if r.text is None else len(r.text)): r.text for r in docs.collect()}
    measured = quality.measure(docs.withColumn("n_chars", F.length("text")))
    judged = quality.judge(measured, quality.frequent_lines(measured)).collect()
    assert len(judged) == docs.count()
    for r in judged:
        expected = brute.base_rules(texts[r.doc_id, r.n_chars])
        assert {k: r[k] for k in expected} == expected
        assert r.kept is False if r.base_failed else r.kept in (True, False)


def test_frequent_lines_are_removed_and_copies_count_once(spark, edge_docs, no_docs):
    prepare(spark)
    body = lambda i: " ".join(f"word{i}x{j}" for j in range(30))
    rows = [(i, "h", f"{body(i)}\nAll  rights RESERVED here\n{body(i + 500)}") for i in range(40)]
    rows += [(100 + i, "h", "all rights reserved here\n" * 1 + "all Rights reserved here " * 1 + "\n" + "x y z " * 3) for i in range(3)]
    rows += [(200 + i, "h", body(999)) for i in range(60)]  # copies of one text
    rows += [(300, None, body(7)), (301, None, body(7))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    measured = quality.measure(docs)
    frequent = quality.frequent_lines(measured)
    assert [(r.host, r.n_docs) for r in frequent.collect()] == [("h", 41)]
    judged = {r.doc_id: r for r in quality.judge(measured, frequent).collect()}
    assert judged[0].kept and judged[0].words_left == 60 and len(judged[0].removed_lines) == 1
    assert judged[210].kept and judged[300].kept and not judged[100].kept
    removed = docs.join(quality.judge(measured, frequent).select("doc_id", "removed_lines"), "doc_id")
    texts = {r.doc_id: r.text for r in quality.without_lines(removed).collect()}
    assert texts[3] == f"{body(3)}\n{body(503)}" and texts[210] == body(999)
    # A document that is nothing but frequent lines is depleted.
    only = spark.createDataFrame([(i, "h", "\n".join([body(1), body(2), f"tail {i}"])) for i in range(50)], docs.schema)
    m = quality.measure(only)
    assert {r.kept for r in quality.judge(m, quality.frequent_lines(m)).collect()} == {False}
    empty = quality.measure(no_docs)
    assert quality.judge(empty, quality.frequent_lines(empty)).count() == 0


def test_language_on_held_out_documents(spark, edge_docs, no_docs):
    prepare(spark)
    docs = read_table(spark, SF01, "documents")
    model = language.learn(docs.filter(remainder("doc_id", 3) != 1))
    found = language.predict(docs.filter(remainder("doc_id", 3) == 1), model)
    wrong = found.filter("lang_pred <> lang").count()
    assert wrong <= 0.02 * found.count()
    assert found.filter("score < 0 OR score > 1").count() == 0
    rows = language.predict(edge_docs, model).collect()
    assert len(rows) == len(ROWS) and set(CLASHING) - {"score"} <= set(rows[0].__fields__)
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[1].score == 0
    assert by_id[4].lang_pred in {"en", "de", "fr", "es"}
    digits = spark.createDataFrame([(1, "12 34 — !"), (2, "漢字")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.predict(digits, model).collect()}
    assert got == {1: "und", 2: "en"}
    nothing = language.learn(no_docs)
    assert {r.lang_pred for r in language.predict(edge_docs, nothing).collect()} == {"und"}
    assert language.predict(no_docs, model).count() == 0


def test_language_filter_returns_all_containing_languages():
    entries = [(f"l{i:03d}", g) for g in range(500) for i in range(130) if g % (i + 1) == 0]
    made = language.build_filter(entries, {f"l{i:03d}": 10 for i in range(130)})
    import numpy as np

    masks = made.masks(np.arange(500, dtype=np.int64))
    for g in range(500):
        for i in range(130):
            bit = int(masks[g, i // 64]) >> (i % 64) & 1
            assert bit or g % (i + 1)
    assert (made.false_rate < 0.2).all()


def test_toxicity_on_held_out_labels(spark, edge_docs, no_docs):
    prepare(spark)
    docs, labels = read_table(spark, SF01, "documents"), read_table(spark, SF01, "labels")
    model = toxicity.learn(docs, labels.filter(remainder("doc_id", 4) != 2))
    held = labels.filter(remainder("doc_id", 4) == 2).select("doc_id", "toxic")
    rows = toxicity.score(docs.join(held, "doc_id"), model).collect()
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    better = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert better > 0.75 and sum(x >= 0.3 for x in clean) <= 0.05 * len(clean)
    scored = toxicity.score(edge_docs, model).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    unlabelled = toxicity.learn(docs, labels.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(edge_docs, unlabelled).collect()} == {0.0}
    assert toxicity.learn(no_docs, labels).bias is None and toxicity.learn(docs, labels.filter("doc_id < 0")).bias is None
    assert toxicity.score(no_docs, model).count() == 0


def test_unlabelled_risk_is_corrected_by_the_prior():
    import numpy as np

    rng = np.random.default_rng(3)
    hidden = rng.random(4000) < 0.2
    confirmed = np.zeros(4000, dtype=bool)
    confirmed[np.flatnonzero(hidden)[:200]] = True
    # Feature 0 marks toxic text; feature 1 is noise.
    has = np.stack([hidden & (rng.random(4000) < 0.95), rng.random(4000) < 0.5])
    places, rows = np.nonzero(has)
    weights, bias = toxicity.train(rows, places, confirmed, 2, 0.2)
    assert weights[0] + bias > 0 > weights[1] + bias


def test_vocabulary_files_that_ask_for_more_are_refused(tmp_path):
    import json

    with open(vocabulary(), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [dict(spec["added_tokens"][0], lstrip=True)]}):
        path = tmp_path / "vocabulary.json"
        path.write_text(json.dumps(spec | change), encoding="utf-8")
        with pytest.raises(ValueError, match="vocabulary file"):
            bpe.Encoder(str(path))
