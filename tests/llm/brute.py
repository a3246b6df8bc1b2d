"""Plain-Python restatements of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def base_rules(text: str | None) -> dict:
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(found),
        "word_chars": sum(map(len, found)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(found) < 20 or 100 * len(covered) > 30 * len(found),
    }


def shingles(text: str | None, size: int = 2) -> frozenset:
    found = [lower(w) for w in words(text)]
    if not found:
        return frozenset()
    if len(found) < size:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def components(docs: list[tuple[int, str | None]], size: int = 2) -> dict[int, int]:
    """Smallest id reachable over links of 80 * union <= 100 * intersection."""
    sets = [(i, shingles(t, size)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: root(i) for i, _ in docs}


def without_repeats(docs: list[tuple[int, str | None]], size: int = 13) -> dict[int, tuple[int, int, str]]:
    """Words, removed words and digest of the kept words, by id."""
    first: dict[tuple, int] = {}
    for i, text in docs:
        found = words(text)
        for k in range(len(found) - size + 1):
            w = tuple(found[k : k + size])
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, text in docs:
        found = words(text)
        gone = {
            j
            for k in range(len(found) - size + 1)
            if first[tuple(found[k : k + size])] < i
            for j in range(k, k + size)
        }
        kept = " ".join(w for j, w in enumerate(found) if j not in gone)
        out[i] = (len(found), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def targets(sizes: dict[str | None, int], weights=(5, 2, 1), most=3) -> dict[str | None, float]:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, open_ = float(sum(sizes.values())), list(names)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] <= weight[s] * share]
        if not full:
            return out | {s: weight[s] * share for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def greedy_factors(docs: list[tuple[int, str | None]], size: int = 13) -> dict[int, list[tuple]]:
    """Per document: (start, words, reference, its start) of a greedy parse, by comparing words, against
    the blocks of new phrases of every earlier document."""
    texts = [(i, words(t)) for i, t in sorted(docs)]
    seen: set = set()
    blocks: list[tuple[int, int, list[str]]] = []  # document, first word, words
    out = {}
    for x, (i, found) in enumerate(texts):
        same = [j for j, other in texts[:x] if other == found and len(found) >= size]
        out[i] = [(0, len(found), same[0], 0)] if same else []
        at = len(found) if same else 0
        while at + size <= len(found):
            best = (0, 0, 0)
            for ref, begin, block in blocks:
                for k in range(len(block) - size + 1):
                    n = 0
                    while at + n < len(found) and k + n < len(block) and found[at + n] == block[k + n]:
                        n += 1
                    best = max(best, (n, ref, begin + k))
            if best[0] < size:
                at += 1
                continue
            out[i].append((at, *best))
            at += best[0] - size + 1  # the first phrase that crosses the factor's end
        run: list[int] = []
        for k in range(len(found) - size + 2):
            phrase = tuple(found[k : k + size])
            if len(phrase) == size and phrase not in seen:
                seen.add(phrase)
                run.append(k)
            elif run:
                blocks.append((i, run[0], found[run[0] : run[-1] + size]))
                run = []
    return out
