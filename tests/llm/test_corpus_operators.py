"""Near-duplicates, substrings, mixing, chat, neighbours, and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from disclosure.llm import chat, mixing, neardup, neighbours, substring
from disclosure.llm.queries import QUERIES
from disclosure.llm.stage import prepare, written
from disclosure.sources.star import read_table
from tests.conftest import SF001, SF01
from tests.llm import brute
from tests.llm.conftest import CLASHING, LONG, ROWS


def _texts(spark, folder):
    return [(r.doc_id, r.text) for r in read_table(spark, folder, "documents").select("doc_id", "text").collect()]


# ---------------------------------------------------------------- near-duplicates


def test_near_duplicates_equal_brute_force(spark):
    rows = QUERIES["op2_minhash"](spark, SF01).collect()
    docs = _texts(spark, SF01)
    expected = brute.components(docs)
    assert {r.doc_id: r.component_id for r in rows} == expected and len(rows) == len(docs)
    sizes = {i: len(brute.shingles(t)) for i, t in docs}
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicate_groups_and_chains(spark):
    prepare(spark)
    rng = random.Random(8)
    rows = []
    base = [f"b{rng.randrange(5000)}" for _ in range(150)]
    for i in range(120):  # a large group, each with a few changed words
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = [f"c{j}" for j in range(200)]
    for i in range(30):  # each like the next, the ends unlike
        rows.append((1000 + i, " ".join(chain[i * 5 :] + [f"d{j}" for j in range(i * 5)])))
    rows += [(2000 + i, f"short text number {i % 4}") for i in range(12)]
    shared = [f"s{j}" for j in range(60)]
    rows += [(3000 + i, " ".join(shared + [f"u{i}x{j}" for j in range(90)])) for i in range(60)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.components(rows)


def _group(n: int) -> list[tuple[int, str]]:
    """Documents alike below the threshold: each replaces two words of the same thirty."""
    rng = random.Random(5)
    base = [f"b{j}" for j in range(30)]
    rows = []
    for i in range(n):
        words = list(base)
        for place in rng.sample(range(30), 2):
            words[place] = f"n{i}x{place}"
        rows.append((i, " ".join(words)))
    return rows


def test_rows_grow_with_a_group_of_unlinked_documents_not_with_its_square(spark, monkeypatch):
    prepare(spark)
    made = {}
    real = neardup.Scratch.written

    def counted(self, df, label):
        out = real(self, df, label)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(neardup.Scratch, "written", counted)
    most = []
    for n in (150, 300, 600):
        made.clear()
        rows = _group(n)
        found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2)
        assert {r.doc_id: r.component_id for r in found.collect()} == brute.components(rows)
        most.append(max(v for label, v in made.items()))
    assert most[1] <= 2.5 * most[0] and most[2] <= 2.5 * most[1]


def test_near_duplicates_with_whole_sets_as_sketches_are_exact(spark, monkeypatch):
    """With ``k`` over every set's size no estimate decides anything."""
    prepare(spark)
    rng = random.Random(9)
    rows = []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(4000)}" for _ in range(400)]
        for i in range(20):
            words = list(base)
            for _ in range(rng.randint(20, 45)):  # around the threshold
                words[rng.randrange(400)] = f"n{rng.randrange(10**6)}"
            rows.append((group * 100 + i, " ".join(words)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2, k=10**6)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.components(rows)


def test_near_duplicate_meetings_of_many_blocks(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    rows = _group(120) + [(1000 + i, t) for i, t in _group(60)[::2]]
    rows += [(2000 + i, t.replace("b3 ", "b3x ")) for i, t in _group(40)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute.components(rows)


def test_near_duplicate_edge_cases(spark, edge_docs, no_docs):
    prepare(spark)
    rows = neardup.near_duplicates(edge_docs, size=2).collect()
    assert len(rows) == len(ROWS)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in rows)
    assert got[1, 1, True] == got[2, 2, True] == got[3, 3, True] == 1
    assert got[6, 6, True] == got[7, 6, False] == got[None, None, True] == 1 and got[10, 10, True] == 2
    sizes = {r.doc_id: r.n_shingles for r in rows}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[4] == sizes[5] == 1
    assert neardup.near_duplicates(no_docs, size=2).count() == 0


# ---------------------------------------------------------------- substrings


def test_substrings_equal_brute_force(spark):
    rows = QUERIES["op3_substring"](spark, SF01).collect()
    expected = brute.without_repeats(_texts(spark, SF01))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == expected


def test_substring_factors_name_their_reference(spark):
    prepare(spark)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(40):
        cut = rng.randrange(0, 30)
        inner = passage[cut : cut + rng.randint(5, 40)]
        rows.append((i, " ".join([word() for _ in range(rng.randint(0, 40))] + inner + [word() for _ in range(10)])))
    rows += [(50, rows[3][1]), (51, " ".join(["rep"] * 50)), (52, " ".join(["rep"] * 30) + "\nend here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    expected = brute.without_repeats(rows)
    for r in substring.without_repeats(docs).collect():
        words = brute.words(texts[r.doc_id])
        assert (r.n_words, r.n_removed) == expected[r.doc_id][:2]
        assert hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest() == expected[r.doc_id][2]
        covered = set()
        for f in r.factors:
            assert f.ref < r.doc_id and f.n_words >= 13
            theirs = brute.words(texts[f.ref])
            assert words[f.start : f.start + f.n_words] == theirs[f.ref_start : f.ref_start + f.n_words]
            covered |= set(range(f.start, f.start + f.n_words))
        assert len(covered) == r.n_removed


def test_substring_factors_are_greedy_longest_matches(spark):
    prepare(spark)
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10**6)}"
    passages = [[word() for _ in range(rng.randint(14, 60))] for _ in range(6)]
    rows = [(0, " ".join(passages[0][3:18])), (1, " ".join(passages[0])), (2, " ".join(passages[0]))]
    rows.append((3, " ".join([word(), *passages[0], word()])))
    for i in range(4, 60):  # parts of passages, some side by side, some with new words between
        out = []
        for _ in range(rng.randint(1, 4)):
            whole = rng.choice(passages)
            cut = rng.randrange(0, len(whole) // 2)
            out += whole[cut : cut + rng.randint(5, 50)] + [word() for _ in range(rng.choice([0, 0, 1, 15]))]
        rows.append((i, " ".join(out)))
    rows.append((60, " ".join(["rep"] * 40)))
    rows.append((61, " ".join(["rep"] * 60 + ["end"])))
    expected = brute.greedy_factors(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in substring.without_repeats(docs).collect():
        assert [tuple(f) for f in r.factors] == expected[r.doc_id], r.doc_id
    assert sum(map(len, expected.values())) > 80


def test_substring_edge_cases(spark, edge_docs, no_docs):
    prepare(spark)
    rows = substring.without_repeats(edge_docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[4].text == "one" and by_id[6].text == LONG
    assert by_id[7].text == "" and by_id[7].n_removed == 400
    assert by_id[8].n_removed == 800 and by_id[None].n_removed == 0 and by_id[None].text == LONG
    assert by_id[10].n_removed == 0 and by_id[9].text.startswith("Ünïcode") and by_id[9].id == "own"
    assert substring.without_repeats(no_docs).count() == 0


# ---------------------------------------------------------------- mixing


def _targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    return {r.source: r.target for r in mixing.targets(rows).collect()}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 50, None: 7},
        {"Z": 10, "a": 20, "é": 0, "😀": 5, "b": 400},
        {"only": 12},
        {"zero": 0},
        {},
    ],
)
def test_targets_equal_repeated_resharing(spark, sizes):
    assert _targets(spark, sizes) == pytest.approx(brute.targets(sizes), rel=1e-12)


def test_hypergeometric_follows_its_distribution(spark):
    cases = [(5, 20, 8), (0, 9, 3), (9, 9, 4), (1000, 3000, 1500), (70, 5000, 1), (3, 3, 3)]
    for good, total, drawn in cases:
        draws = spark.range(2000).select(
            mixing.hypergeometric(
                F.lit(good), F.lit(total), F.lit(drawn), mixing._uniform(F.lit(3), F.col("id"))
            ).alias("x")
        )
        x = np.array([r.x for r in draws.collect()])
        share = good / total
        spread = np.sqrt(drawn * share * (1 - share) * (total - drawn) / max(total - 1, 1))
        assert x.min() >= max(0, drawn - (total - good)) and x.max() <= min(good, drawn)
        assert abs(x.mean() - drawn * share) <= 5 * spread / np.sqrt(2000) + 1e-9
        assert abs(x.std() - spread) <= 0.1 * spread + 1e-9


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_quotas_are_exact(spark, shards):
    quotas = {"a": 100, "b": 7, None: 33, "c": 0}
    rows = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    out = mixing.split_quotas(rows, shards).collect()
    per_shard = Counter()
    for r in out:
        assert r.quota >= 0
        per_shard[r.shard] += r.quota
    assert {s: sum(r.quota for r in out if r.source == s) for s in quotas} == quotas
    assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= shards.bit_length()


def test_draw_stays_a_small_expression(spark):
    drawn = mixing.hypergeometric(*[F.col(c) for c in ("good", "total", "drawn", "uniform")])
    assert len(str(drawn)) < 5000


def test_small_plan_leaves_documents_in_place(spark, edge_docs):
    prepare(spark)
    measured = mixing.measure(edge_docs)
    planned = written(mixing.plan(measured, shards=2), "test-plan")
    here = mixing.allocate(measured, planned, small=True)
    text = here._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    key = lambda r: str((r.source, r.block, r.place, r.draws))
    assert sorted(map(key, here.collect())) == sorted(map(key, mixing.allocate(measured, planned).collect()))


def test_mix_meets_targets_and_agrees_on_reruns(spark):
    rows = QUERIES["op9_mixing"](spark, SF01).collect()
    again = QUERIES["op9_mixing"](spark, SF01).repartition(3).collect()
    assert sorted(rows) == sorted(again)
    docs = {r.doc_id: r for r in read_table(spark, SF01, "documents").collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == len(brute.words(docs[r.doc_id].text)) and 0 <= r.taken <= 3 * r["size"]
        sizes[source] += r["size"]
        taken[source] += r.taken
        target[source] = r.target
    assert target == pytest.approx(brute.targets(sizes), rel=1e-12)
    for source, want in target.items():
        assert abs(taken[source] - want) <= 0.05 * want


def test_mix_rows_shards_and_edge_cases(spark, edge_docs, no_docs):
    prepare(spark)
    docs = edge_docs.unionByName(
        spark.range(600).select(
            (F.col("id") + 100).alias("doc_id"),
            F.repeat(F.lit("some words "), (F.col("id") % 9 + 1).cast("int")).alias("text"),
            F.lit("en").alias("lang"),
            F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("source"),
            *[F.lit("own").alias(c) for c in CLASHING],
        )
    )
    measured = mixing.measure(docs)
    allocated = mixing.allocate(measured, mixing.plan(measured, shards=4))
    rows = allocated.collect()
    assert len(rows) == docs.count()
    assert all(r["size"] == len(brute.words(r.doc.text)) for r in rows)
    mixed = mixing.shuffled(mixing.mix(allocated), 4)
    out = mixed.collect()
    assert Counter(r.doc_id for r in out) == Counter({r.doc.doc_id: len(r.draws) for r in rows if r.draws})
    shards = Counter(r.shard for r in out)
    assert set(shards) == {0, 1, 2, 3} and max(shards.values()) < 2 * min(shards.values())
    assert [r.position for r in out if r.shard == 2] == sorted(r.position for r in out if r.shard == 2)
    assert "draws" in mixed.columns and out[0].block == "own"
    nothing = mixing.measure(no_docs)
    assert mixing.allocate(nothing, mixing.plan(nothing)).count() == 0


# ---------------------------------------------------------------- chat


def test_chat_reads_back_any_text(spark):
    rng = random.Random(2)
    parts = ["</s>", "<s>", "<s> ", "[INST]", "[/INST]", " [/INST]", "[SYS] ", "[END]", "[ROLE] ", " [/ROLE] ", "\\", "<", "["]
    parts += ["<\\/s>", "[\\\\INST]", "é😀", "\n", " ", "text", "$1", "/s>", "INST]", ""]
    roles = ["user", "assistant", "system", "tool", "", None, "[/ROLE] x", "User"]
    rows = []
    for conv in range(300):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, rng.choice(roles), text if rng.random() > 0.05 else None))
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shuffled = given.repartition(5, F.rand(1))
    out = chat.digests(chat.format_conversations(chat.conversations(shuffled)))
    expected = {}
    for conv in range(300):
        turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        learned = "".join(t for r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), digest(learned))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out.collect()}
    assert got == expected


def test_chat_order_and_segments(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a</s>")]
    rows += [(2, 0, "assistant", "x"), (3, 0, "user", "u"), (3, 1, "user", "v"), (4, 0, "system", "s")]
    rows += [(None, None, "user", "n"), (None, None, "user", "n"), (5, 2, "assistant", "late"), (5, 1, "user", "early")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_conversations(chat.conversations(given)).collect()}
    assert out[1].formatted == "[SYS] s [/SYS][INST] u [/INST]<s> a<\\/s></s>" and out[1].valid
    assert [(s.text, s.loss) for s in out[1].segments if s.loss] == [("a<\\/s>", True)]
    assert (out[2].bad_turn, out[3].bad_turn, out[4].bad_turn, out[None].bad_turn) == (0, 1, 1, 1)
    assert out[5].formatted == "[INST] early [/INST]<s> late</s>" and out[5].valid and out[5].bad_turn is None
    assert chat.format_conversations(chat.conversations(given.filter("conv_id > 9"))).count() == 0
    with pytest.raises(ValueError):
        chat.Template(role_before="<a<").controls()


# ---------------------------------------------------------------- neighbours


def _nearest(vectors, query, k=5):
    at = [i for i, _ in vectors]
    matrix = np.array([v for _, v in vectors], dtype=float)
    scores = matrix @ matrix[at.index(query)]
    scores /= np.linalg.norm(matrix, axis=1) * np.linalg.norm(matrix[at.index(query)])
    return sorted(((-s, i) for s, i in zip(scores, at) if i != query))[:k]


@pytest.mark.parametrize("folder", [SF01, "/root/testdata/sf0.1"])
def test_neighbours_recall(spark, folder):
    rows = QUERIES["op7_neighbours"](spark, folder).collect()
    vectors = [(r.vec_id, r.embedding) for r in read_table(spark, folder, "embeddings").collect()]
    hits = total = 0
    for query in [i for i, _ in vectors if i % 50 == 0]:
        expected = _nearest(vectors, query)
        got = sorted((r for r in rows if r.query_id == query), key=lambda r: r.rank)
        assert [r.rank for r in got] == [1, 2, 3, 4, 5]
        scores = {i: -s for s, i in _nearest(vectors, query, len(vectors))}
        assert all(r.score == pytest.approx(scores[r.vec_id], abs=1e-12) for r in got)
        hits += len({i for _, i in expected} & {r.vec_id for r in got})
        total += 5
    assert hits >= 0.9 * total


def test_neighbour_edge_cases(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (50, [0.0, 1e-200, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [3e200, 1e200, 0.0])]
    rows += [(4, None), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [None, 1.0, 1.0]), (9, [1.0])]
    rows += [(None, [1.0, 0.0, 0.0]), (100, [0.0, 0.0, 0.0])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.neighbours(given, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1), (0, 2), (0, 3), (0, 50), (50, 3), (50, 0), (50, 1), (50, 2)]
    assert got[0].score == got[1].score == 1.0
    assert neighbours.neighbours(given.filter("vec_id = 4"), F.col("id") % 50 == 0).count() == 0
    copies = [(i, [1.0, float(i % 3), 0.5]) for i in range(900)]
    given = spark.createDataFrame(copies, "vec_id long, embedding array<double>")
    rows = neighbours.neighbours(given, F.col("id") % 50 == 0, leaf_rows=50).collect()
    for r in rows:
        same = [i for i, _ in copies if i % 3 == r.query_id % 3 and i != r.query_id]
        assert r.vec_id == same[r.rank - 1] and r.score == pytest.approx(1.0, abs=1e-15)


def test_repeated_rows_take_no_neighbours_place(spark):
    """One id seven times with the vector of five others: all of them tie, and five are due."""
    rows = [(0, [1.0, 0.0])] + [(1, [0.6, 0.8])] * 7 + [(i, [0.6, 0.8]) for i in range(2, 7)] + [(0, [1.0, 0.0])] * 2
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.neighbours(given, F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, i, i) for i in range(1, 6)]


def test_every_vector_is_shuffled_once_per_tree(spark, monkeypatch):
    """What the cells are made of: one row a vector and tree, however many queries there are."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(2000)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for share in (2, 10):  # ten times the queries
        plan = neighbours.neighbours(given, F.col("id") % (100 // share) == 0, leaf_rows=100)._jdf.queryExecution().toString()
        assert "FlatMapCoGroups" not in plan and "CartesianProduct" not in plan


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    docs = read_table(spark, SF001, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        kept.append((name, docs))
        docs = written(stage(spark, docs, SF001), f"test-{name}")
    inputs = {name: {r.doc_id: r.text for r in d.collect()} for name, d in kept}
    assert all(d.columns == corpus_pipeline.COLUMNS for _, d in kept[1:])
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF001, "labels").collect()}
    gone = inputs["toxicity"].keys() - inputs["near_dedup"].keys()
    assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * sum(t == 0 for t in labels.values())
    groups = brute.components(sorted(inputs["near_dedup"].items()), size=5)
    assert inputs["substring_dedup"].keys() == set(groups.values())
    left = brute.without_repeats(sorted(inputs["substring_dedup"].items()))
    assert inputs["mixing"].keys() == {i for i, (n, gone, _) in left.items() if gone < n or not n}
    for i, text in inputs["mixing"].items():
        assert hashlib.sha256(" ".join(brute.words(text)).encode()).hexdigest() == left[i][2]
    drawn = Counter(r.doc_id for r in kept[-1][1].collect())
    assert max(drawn.values()) <= 3 and drawn.keys() <= inputs["mixing"].keys()
    out = docs.collect()
    assert Counter(r.doc_id for r in out) == drawn
    for r in out:
        assert r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256(inputs["bpe"][r.doc_id].encode()).hexdigest()


def test_pipeline_stages_accept_edge_rows(spark, edge_docs, no_docs):
    for rows in (edge_docs, no_docs):
        docs = rows.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF001), f"edge-{name}")
    assert docs.count() == 0
