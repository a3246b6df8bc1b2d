"""Ranked search, conversation trie and embedding near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from disclosure.llm import embeddup, lexical, trie
from disclosure.llm.queries import QUERIES
from disclosure.llm.stage import Scratch, prepare
from disclosure.sources.star import read_table
from tests.conftest import SF01
from tests.llm import brute
from tests.llm.conftest import LONG

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

# ---------------------------------------------------------------- ranked search


def _terms(text):
    return [brute.lower(t) for t in TERM.findall(text or "")]


def _ranking(docs, items, k=50):
    docs = [(i, Counter(_terms(t))) for i, t in docs if i is not None and _terms(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(_terms(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for doc, c in docs:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in ts
                if t in c
            )
            if score > 0:
                scored.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def _search(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    k = options.pop("k", 50)
    found = lexical.index(docs, **options)
    return sorted(tuple(r) for r in lexical.search(found, spark.createDataFrame(items, "item_id long, text string"), k=k).collect())


@pytest.mark.parametrize("shard_terms", [1 << 21, 40_000, 9000])
def test_search_equals_brute_force(spark, shard_terms):
    prepare(spark)
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF01, "documents").select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF01, "benchmark").select("item_id", "text").collect()][:12]
    assert _search(spark, docs, items, shard_terms=shard_terms) == _ranking(docs, items)


def test_search_with_common_terms_ties_and_query_sets(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(2)
    vocabulary = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))) for i in range(9000)]
    docs += [(20_000 + i, "t0 t7 t7 t200") for i in range(700)]  # many equal scores
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(25)] + [(99, "t0"), (98, "t7 t200 t0")]
    expected = _ranking(docs, items, k=10)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 40)  # several sets of queries
    for shard_terms in (1 << 21, 60_000):
        assert _search(spark, docs, items, shard_terms=shard_terms, k=10) == expected


def test_block_maxima_leave_blocks_packed():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n = 60_000
    rows = {"id": [], "n": [], "shard": [], "terms": [], "tfs": []}
    rare = set(rng.choice(n, 80, replace=False).tolist())
    for i in range(n):
        held = [1] + ([2] if i in rare else []) + ([3] if rng.random() < 0.4 else [])
        for name, value in zip(rows, (i, 20, 0, held, [1] * len(held))):
            rows[name].append(value)
    types = {"id": pa.int64(), "n": pa.int64(), "shard": pa.int32(), "terms": pa.list_(pa.int64()), "tfs": pa.list_(pa.int32())}
    built = lexical.build(pa.table({k: pa.array(v, types[k]) for k, v in rows.items()}), n, 20 * n)
    shard = lexical.Shard(built)
    weights = {1: 1, 2: 7000, 3: 900}
    docs, scores = shard.search(list(weights.items()), 10, 1)
    full = np.array([sum(weights[t] * int(lexical.impacts(np.array([1]), np.array([100]))[0]) for t in held) for held in rows["terms"]])
    best = np.lexsort((np.arange(n), -full))[:10]
    assert docs.tolist() == best.tolist() and scores.tolist() == full[best].tolist()
    blocks = sum(len(last) for last in shard.last)
    assert shard.unpacked < blocks / 2
    at = shard.at[3]
    together = np.concatenate([shard.block(at, b)[0] for b in range(len(shard.last[at]))])
    assert together.tolist() == [i for i, held in enumerate(rows["terms"]) if 3 in held]


def test_packed_values_of_every_width():
    import pyarrow as pa

    tfs = [1, 255, 256, 65_535, 65_536, 3_000_000]
    ids = [0, 200, 500, 70_000, 9_000_000, 2**40]
    rows = pa.table(
        {"id": pa.array(ids, pa.int64()), "n": pa.array(tfs, pa.int64()), "shard": pa.array([0] * 6, pa.int32()),
         "terms": pa.array([[-5]] * 6, pa.list_(pa.int64())), "tfs": pa.array([[t] for t in tfs], pa.list_(pa.int32()))}
    )
    shard = lexical.Shard(lexical.build(rows, 6, sum(tfs)))
    docs, scores = shard.search([(-5, 3)], 6, 1)
    m = [50 + 50 * n * 6 // sum(tfs) for n in tfs]
    expected = [3 * (10**9 * t // (1000 * t + 20 * x)) for t, x in zip(tfs, m)]
    assert sorted(zip(docs.tolist(), scores.tolist())) == list(enumerate(expected))
    assert [int(shard.ids[d]) for d in sorted(docs)] == ids


def test_search_edge_cases(spark, edge_docs, no_docs):
    prepare(spark)
    items = [(1, "ONE one two"), (1, "line"), (2, None), (3, ""), (4, "absent"), (None, "one"), (5, "漢字 ½ ünïcode"), (6, LONG)]
    queries = spark.createDataFrame([(*i, "own", 7) for i in items], "item_id long, text string, term string, rank int")
    got = sorted(tuple(r) for r in lexical.search(lexical.index(edge_docs), queries).collect())
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got == _ranking(docs, items) and {r[0] for r in got} == {1, 5, 6}
    assert lexical.search(lexical.index(no_docs), queries).count() == 0
    assert lexical.search(lexical.index(edge_docs), queries.filter("item_id = 2")).count() == 0
    long = [(1, "word " * 600_000 + "end"), (2, "end word")]  # larger than a block of text
    assert _search(spark, long, [(1, "end")]) == _ranking(long, [(1, "end")])


# ---------------------------------------------------------------- conversation trie


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _trie(rows, rebuild=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, _sha(_sha(role) + _sha(text)), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        own_saved = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += not children[node]
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
         _sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))))
        for k, m in members.items()
    )


def _build(spark, rows, rebuild=True, **options):
    df = spark.createDataFrame([(*r, 1, "own") for r in rows], "conv_id long, turn long, role string, text string, depth int, owner string")
    how = {"base": F.col("conv") - F.col("conv") % 5, "head": F.crc32(F.col("conv").cast("string")) % 9} if rebuild else {}
    return sorted(tuple(r) for r in trie.trie(df, **how, **options).collect())


def _conversations(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"text {rng.choice('ab')} {'é' * (t % 3)}"))
    return rows


@pytest.mark.parametrize("small", [1 << 14, 30, 1])
def test_trie_equals_brute_force_however_much_is_split_outside_tasks(spark, small):
    prepare(spark)
    rows = _conversations(60) + [(c, t, "user", "hot") for c in range(100, 130) for t in range(3)]
    if small == 1:
        rows = rows[:60]
    assert _build(spark, rows, small=small) == _trie(rows)


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF01, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op12_trie"](spark, SF01).collect()) == _trie(rows)


def test_very_long_and_very_wide_tries(spark):
    prepare(spark)
    chain = [(0, t, "user", f"turn {t}") for t in range(400)] + [(1, t, "user", f"turn {t}") for t in range(250)]
    assert _build(spark, chain, rebuild=False, small=100) == _trie(chain, rebuild=False)
    star = [(c, 0, "user", f"own {c}") for c in range(500)]
    assert _build(spark, star, rebuild=False, small=50) == _trie(star, rebuild=False)
    ends = [(c * 3000, 0, "user", "same") for c in range(-4, 12)]  # one node's ids over several rows of ids
    assert _build(spark, ends, rebuild=False) == _trie(ends, rebuild=False)


def test_rounds_are_as_many_as_halvings(spark, monkeypatch):
    rounds = []
    real = trie._split
    monkeypatch.setattr(trie, "_split", lambda *args: rounds.append(1) or real(*args))
    chain = [(0, t, "user", f"turn {t}") for t in range(500)]
    assert _build(spark, chain, rebuild=False, small=130) == _trie(chain, rebuild=False)
    assert len(rounds) <= 3  # 501 turns: 250, 125


def test_trie_edge_cases(spark):
    prepare(spark)
    rows = [
        (5, 1, None, None), (5, None, "user", "first"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (6, 0, "user", ""),
        (None, 0, "user", "no id"), (7, 3, "", None), (-3, 0, "user", "first"), (-3, 1, "x", "long " * 500_000), (2**40, 0, "user", "first"),
        (11, 0, "user", "only"),  # its base is absent, and its own turn is cut off if it takes any
    ]
    assert _build(spark, rows) == _trie(rows)
    assert _build(spark, rows, small=1) == _trie(rows)
    assert _build(spark, rows[5:6]) == []
    assert _build(spark, []) == []


def test_finish_sums_subtrees():
    rng = np.random.default_rng(6)
    parent = [-1]
    for i in range(1, 400):
        parent.append(int(rng.integers(max(0, i - 20), i)))
    depth = [0]
    for i in range(1, 400):
        depth.append(depth[parent[i]] + 1)
    weight = np.ones(400, np.int64)
    saved = rng.integers(0, 50, 400)
    expected = saved.copy()
    for i in range(399, 0, -1):
        weight[parent[i]] += weight[i]
        expected[parent[i]] += expected[i]
    conv = np.arange(400)
    leaf = np.array([i not in parent for i in range(400)], dtype=np.int64)
    got = [leaf.copy(), saved.copy()]
    trie.finish(conv, np.array(depth), np.array([max(p, 0) for p in parent]), weight, leaf, saved, *got, np.zeros(400, np.int64), np.zeros(400, np.int64))
    assert got[1].tolist() == expected.tolist() and got[0][0] == leaf.sum()


# ---------------------------------------------------------------- embedding near-duplicates


def _vectors(rows, least=0.98):
    """``vec_id, n_links, component_id, kept`` by all pairs."""
    ok = [
        v is not None and l is not None and i is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for i, v, l in rows
    ]
    unit = [np.ldexp(np.array(v), -np.frexp(np.abs(v).max())[1]) if good else None for (_, v, _), good in zip(rows, ok)]
    links = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]):
                if unit[a] @ unit[b] / (math.sqrt(unit[a] @ unit[a]) * math.sqrt(unit[b] @ unit[b])) >= least:
                    links[a].add(b)
                    links[b].add(a)
    near = defaultdict(set)  # between ids
    for a, others in links.items():
        near[rows[a][0]].update(rows[b][0] for b in others)
    component = {}
    for start in sorted(near):
        if start not in component:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in component:
                    component[x] = start
                    todo += near[x]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    out = []
    for a, (i, _, _) in enumerate(rows):
        c = component.get(i, i) if ok[a] else i
        out.append((i, len(links[a]), c, i == c))
    return sorted(out, key=key), key


def _near(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "vec_id long, embedding array<double>, label int, id string, links int")
    expected, key = _vectors(rows)
    got = sorted((tuple(r) for r in embeddup.near_duplicates(df, **options).collect()), key=key)
    return got, expected


def _clusters(rng, n, dim, spread, labels=3):
    centers = rng.normal(size=(6, dim))
    return [
        (i, [float(x) for x in centers[i % 6] + spread * rng.normal(size=dim)], None if i % 17 == 0 else int(i % labels)) for i in range(n)
    ]


@pytest.mark.parametrize("dim,spread", [(2, 0.05), (5, 0.1), (40, 0.14), (40, 0.02), (70, 0.145)])
def test_vectors_equal_brute_force(spark, dim, spread):
    prepare(spark)
    rows = _clusters(np.random.default_rng(dim), 240, dim, spread)
    rows += [(1000 + i, v, l) for i, v, l in rows[:40]]  # copies
    rows += [(2000 + i, [2.5 * x for x in v], l) for i, v, l in rows[40:60]]  # the same directions
    for tile_rows in (4096, 7):
        got, expected = _near(spark, rows, tile_rows=tile_rows)
        assert got == expected and any(r[1] for r in got)


def test_vectors_just_at_the_threshold():
    rng = np.random.default_rng(3)
    left = rng.normal(size=(300, 24))
    side = rng.normal(size=(300, 24))
    side -= left * (np.einsum("ij,ij->i", side, left) / np.einsum("ij,ij->i", left, left))[:, None]
    side *= (np.linalg.norm(left, axis=1) / np.linalg.norm(side, axis=1))[:, None]
    cosine = 0.98 + rng.choice([1, -1], 300) * 10.0 ** -rng.integers(3, 13, 300)
    right = left * cosine[:, None] + side * np.sqrt(1 - cosine**2)[:, None]
    axes = np.linalg.eigh(left.T @ left)[1][:, ::-1]
    i, j = embeddup.similar(left, right, axes, 0.98, same=False)
    found = {(a, b) for a, b in zip(i.tolist(), j.tolist())}
    exact = np.einsum("ij,ij->i", left, right) / (np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1))
    for n in range(300):
        if abs(exact[n] - 0.98) > 1e-14:
            assert ((n, n) in found) == (exact[n] >= 0.98)


def test_large_group_of_near_copies_makes_few_rows(spark, monkeypatch):
    prepare(spark)
    made = {}
    real = Scratch.written
    import disclosure.llm.embeddup as module

    written = module.written
    monkeypatch.setattr(module, "written", lambda df, label: made.setdefault(label, written(df, label)))
    rng = np.random.default_rng(8)
    center = rng.normal(size=30)
    rows = [(i, [float(x) for x in center + 0.03 * rng.normal(size=30)], 1) for i in range(400)]
    got, expected = _near(spark, rows)
    assert got == expected and all(r[1] == 399 for r in got)
    assert made["vector-links"].count() <= 9 * 2 * 400
    assert real is Scratch.written


def test_vector_edge_cases(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, -0.0], 1), (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1e-200, 1e-202], 1), (13, [1e200, -0.0], 1),
        (None, [1.0, 0.0], 1), (14, [0.0, 1.0], 1), (14, [1.0, 0.0], 1), (15, [0.0, 1.0], 1), (16, [-1.0, 0.0], 1), (2, [1.0, 0.0], 1), (17, [5.0], 1), (18, [3.0], 1),
    ]
    got, expected = _near(spark, rows)
    assert got == expected
    assert {r[0]: r[2] for r in got if r[0] in (14, 15)} == {14: 1, 15: 1}  # one id, two vectors
    got, expected = _near(spark, rows[4:9])
    assert got == expected
    assert _near(spark, [])[0] == []
