"""BPE encoding and decoding by speculation and verification.

Every distinct word of a block is first cut greedily into longest vocabulary entries, all words
at once. A cut is the true encoding exactly when merging would leave each adjacent pair of its
tokens apart, which is tested for all pairs at once by undoing the merges along the shared
border. Only words with a failing pair are merged step by step.

The vocabulary is a byte-level BPE file of the ``tokenizers`` library; its place is a parameter
and the file must exist on every worker. Results equal that library's ``encode(...,
add_special_tokens=False)`` and ``decode(..., skip_special_tokens=False)``: strings of added
tokens inside a text become those tokens.

Rows are handled one by one: nulls are empty texts (no tokens), repeated rows repeat, other
columns are kept and columns named like an output are replaced. Memory is bounded by the text
block, the vocabulary and a word memo of :data:`MEMO_WORDS` entries.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from disclosure.llm.text import blocks, lists, span_hashes, utf8

MEMO_WORDS = 300_000
SHORT_WORD = 64  # bytes; longer words are merged one by one with a heap

_LETTER, _NUMBER, _BLANK = 1, 2, 3
# --- Fixed values: white space as the word pattern of the vocabulary means it. ---
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# --- Fixed values: endings that the word pattern splits off after an apostrophe. ---
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_NONE = np.iinfo(np.int64).max
_LOADED: dict[str, Encoder] = {}


def _byte_symbols() -> dict[str, int]:
    """The vocabulary file's printable stand-in of each byte: itself where printable Latin-1,
    else the next free code point from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes() -> np.ndarray:
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE] = _BLANK
    return table


def _packed(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Flat ids as one little-endian int32 string per word."""
    raw = ids.astype("<i4").tobytes()
    to = (np.cumsum(counts) * 4).tolist()
    return [raw[i:j] for i, j in zip([0, *to[:-1]], to)]


def _check(spec: dict) -> None:
    """ValueError unless the file asks for just what is built here: byte-level BPE after the usual split
    into words, no normaliser, and added tokens that match as they stand."""
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        and spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError("The vocabulary file asks for steps that this encoder doesn't have")


class Encoder:
    """A byte-level BPE vocabulary with vectorised encoding of text blocks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _check(spec)
        symbols = _byte_symbols()
        spell = lambda token: bytes(symbols[c] for c in token)
        vocab = {spell(token): i for token, i in spec["model"]["vocab"].items()}
        self.added = {x["content"].encode(): x["id"] for x in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in [*vocab.items(), *self.added.items()]:
            self.bytes[i] = token
        self.ascii = [b"%d" % i for i in range(size)]
        self.of_byte = [vocab[bytes([b])] for b in range(256)]
        self.size = size
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        self.rank = np.full(size, -1, dtype=np.int64)  # -1: a single byte, there from the start
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = (spell(x) for x in (merge if isinstance(merge, list) else merge.split(" ")))
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            self.merges[i, j] = (rank, k)
            self.left[k], self.right[k], self.rank[k] = i, j, rank
        keys = np.array([i * size + j for i, j in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.made = np.array([k for _, k in self.merges.values()], dtype=np.int64)  # by rank
        self.byte_ids = np.array(self.of_byte, dtype=np.int64)
        self._build_trie(vocab)
        self.classes = _classes()
        self.memo: dict[bytes, bytes] = {}

    def _build_trie(self, vocab: dict[bytes, int]) -> None:
        """Sorted ``node * 256 + byte`` edges over the entries that merging can arrive at."""
        made = np.flatnonzero(self.rank >= 0)
        sound = np.zeros(self.size, dtype=bool)
        sound[self.of_byte] = True
        apart = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i, ok in sorted(zip(made.tolist(), apart.tolist()), key=lambda x: self.rank[x[0]]):
            sound[i] = ok and sound[self.left[i]] and sound[self.right[i]]
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for token, i in vocab.items():
            if not sound[i]:
                continue
            node = 0
            for b in token:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = nxt
            ends[node] = i
        edges = sorted((node * 256 + b, to) for node, x in enumerate(children) for b, to in x.items())
        self.edge_keys = np.array([k for k, _ in edges], dtype=np.int64)
        self.edge_to = np.array([to for _, to in edges], dtype=np.int64)
        self.node_token = np.array(ends, dtype=np.int64)

    # -------------------------------------------------------------- verification

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def compatible(self, a: np.ndarray, b: np.ndarray, joined: np.ndarray | None = None) -> np.ndarray:
        """Whether merging keeps tokens ``a`` and ``b`` apart when they stand side by side.

        The two pieces that touch at the border are followed back in time: undo whichever was
        made last and ask each time whether the touching pair would have merged before one of
        them was used up. Among equal merges the leftmost goes first. With ``joined`` the pair
        is known to merge at that rank and only earlier merges across the border count.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        until_x = np.full(len(x), _NONE) if joined is None else joined.copy()
        until_y = until_x.copy() if joined is None else joined - 1
        good = np.ones(len(x), dtype=bool)
        live = np.arange(len(x))
        while len(live):
            rank = self.pair_rank(x[live], y[live])
            bad = (rank < until_x[live]) & (rank <= until_y[live])
            good[live[bad]] = False
            live = live[~bad]
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            more = (rx >= 0) | (ry >= 0)
            live, rx, ry = live[more], rx[more], ry[more]
            undo_x = rx > ry
            i, j = live[undo_x], live[~undo_x]
            until_x[i], x[i] = rx[undo_x], self.right[x[i]]
            until_y[j], y[j] = ry[~undo_x], self.left[y[j]]
        return good

    # -------------------------------------------------------------- speculation

    def greedy(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of all words: flat ids, and tokens per word."""
        found_word, found_id = [], []
        word = np.arange(len(starts))
        at = starts.copy()
        while len(word):
            node = np.zeros(len(word), dtype=np.int64)
            best = np.full(len(word), -1, dtype=np.int64)
            best_end = at.copy()
            live = np.arange(len(word))
            step = at.copy()
            while len(live):
                keys = node[live] * 256 + data[step[live]]
                edge = np.minimum(np.searchsorted(self.edge_keys, keys), len(self.edge_keys) - 1)
                ok = self.edge_keys[edge] == keys
                live, edge = live[ok], edge[ok]
                node[live] = self.edge_to[edge]
                step[live] += 1
                token = self.node_token[node[live]]
                hit = live[token >= 0]
                best[hit], best_end[hit] = token[token >= 0], step[hit]
                live = live[step[live] < ends[word[live]]]
            found_word.append(word)
            found_id.append(best)
            at = best_end
            left = at < ends[word]
            word, at = word[left], at[left]
        if not found_word:
            return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        words, ids = np.concatenate(found_word), np.concatenate(found_id)
        return ids[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(starts))

    def merged(self, word: bytes) -> list[int]:
        """Exact encoding of one word: the merge of lowest rank first, leftmost among equals."""
        ids = [self.of_byte[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if m := self.merges.get((ids[i], ids[i + 1])):
                heap.append((m[0], i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.merges[a, b][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n and (m := self.merges.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q]))
        return [i for i in ids if i >= 0]

    def merged_together(self, words: list[bytes]) -> list[bytes]:
        """As :meth:`merged` for many short words: one merge per word and round."""
        sizes = np.array([len(w) for w in words])
        ids = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(ids), _NONE)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inside] = self.pair_rank(ids[inside], ids[inside + 1])
        done_owner, done_ids = [], []
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.concatenate([first, [len(ids)]]))
            least = np.repeat(np.minimum.reduceat(ranks, first), length)
            over = least == _NONE
            done_owner.append(owner[over])
            done_ids.append(ids[over])
            ids, owner, ranks, least = ids[~over], owner[~over], ranks[~over], least[~over]
            if not len(ids):
                break
            at = np.flatnonzero(ranks == least)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = self.made[ranks[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # places after the right parts are gone
            ids, owner, ranks = ids[keep], owner[keep], ranks[keep]
            for i in (at - 1, at):
                i = i[(i >= 0) & (i + 1 < len(ids))]
                same = owner[i] == owner[i + 1]
                i, end = i[same], i[~same]
                ranks[i] = self.pair_rank(ids[i], ids[i + 1])
                ranks[end] = _NONE
            if at[-1] == len(ids) - 1:
                ranks[-1] = _NONE
        owners, found = np.concatenate(done_owner), np.concatenate(done_ids)
        return _packed(found[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words)))

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian int32 bytes."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        ids, counts = self.greedy(data, starts, ends)
        owner = np.repeat(np.arange(len(words)), counts)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size)[which]
        failing = np.unique(owner[inside[~fine]])
        out = _packed(ids, counts)
        short = [i for i in failing.tolist() if len(words[i]) <= SHORT_WORD]
        for i in failing.tolist():
            if len(words[i]) > SHORT_WORD:
                out[i] = np.array(self.merged(words[i]), dtype="<i4").tobytes()
        if short:
            for i, exact in zip(short, self.merged_together([words[i] for i in short])):
                out[i] = exact
        return out

    # -------------------------------------------------------------- whole texts

    def _specials(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """Byte spans and ids of added tokens inside single texts, leftmost (then longest) first."""
        found = []
        for token, i in self.added.items():
            at = raw.find(token) if token else -1
            while at >= 0:
                if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(token) - 1, "right"):
                    found.append((at, at + len(token), i))
                at = raw.find(token, at + 1)
        kept: list[tuple[int, int, int]] = []
        for span in sorted(found, key=lambda s: (s[0], -s[1])):
            if not kept or span[0] >= kept[-1][1]:
                kept.append(span)
        return kept

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte spans of the words of all texts, and the added token each stands for (or -1)."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype="<u4")
        n = len(points)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        widths = np.ones(n, dtype=np.int64)
        for bound in (0x80, 0x800, 0x10000):
            widths += points >= bound
        place = np.concatenate([[0], np.cumsum(widths)])
        specials = self._specials(raw, offsets)
        hard = np.zeros(n + 1, dtype=bool)
        hard[np.searchsorted(place, offsets)] = True
        for start, end, _ in specials:
            hard[np.searchsorted(place, [start, end])] = True
        hard[0] = hard[n] = True
        kind = self.classes[points]
        begin = np.ones(n, dtype=bool)  # of a run of one class
        begin[1:] = (kind[1:] != kind[:-1]) | hard[1:n]
        start = begin.copy()
        # The last blank before other text stands alone, or goes to that text if it is a space.
        goes_on = ~hard[1:n] & (kind[1:] != _BLANK)
        start[:-1] |= goes_on & (kind[:-1] == _BLANK)
        start[1:] &= ~(goes_on & (points[:-1] == 32))
        quotes = np.flatnonzero(start & (points == 39))
        for i in quotes.tolist():
            for ending in _ENDINGS:
                j = i + 1 + len(ending)
                if j <= n and not hard[i + 1 : j].any() and all(points[i + 1 + k] == ord(c) for k, c in enumerate(ending)):
                    start[i + 1] = False
                    if j < n and not hard[j] and kind[j] == _LETTER:
                        start[j] = True
                    break
        first = np.flatnonzero(start)
        starts = place[first]
        which = np.full(len(starts), -1, dtype=np.int64)
        if specials:
            inside = np.zeros(len(starts), dtype=bool)
            for at, end, token in specials:
                i, j = np.searchsorted(starts, [at, end])
                inside[i + 1 : j] = True
                which[i] = token
            starts, which = starts[~inside], which[~inside]
        return starts, np.concatenate([starts[1:], [place[n]]]), which

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat token ids of a column of texts, and tokens per text."""
        data, offsets = utf8(column)
        starts, ends, special = self.cut(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        one, two = span_hashes(data, starts, ends, 0), span_hashes(data, starts, ends, 1)
        one[special >= 0] = special[special >= 0].astype(np.uint64)
        _, sample, which = np.unique(one, return_index=True, return_inverse=True)
        if (two[sample][which] != two).any():  # two words of the block share a 64-bit hash
            _, sample, which = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[i:j] for i, j in zip(starts[sample].tolist(), ends[sample].tolist())]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        codes = list(map(self.memo.get, words))
        missing = [i for i, code in enumerate(codes) if code is None]
        for i, code in zip(missing, self.encode_words([words[i] for i in missing])):
            codes[i] = self.memo[words[i]] = code
        for i in np.flatnonzero(special[sample] >= 0).tolist():
            codes[i] = np.array([special[sample[i]]], dtype="<i4").tobytes()
        pool = np.frombuffer(b"".join(codes), dtype="<i4")
        lengths = np.array([len(c) for c in codes], dtype=np.int64) // 4
        begin = np.cumsum(lengths) - lengths
        per_word = lengths[which]
        total = np.cumsum(per_word)
        ids = pool[np.arange(total[-1]) + np.repeat(begin[which] - (total - per_word), per_word)]
        rows = np.searchsorted(offsets, starts, "right") - 1
        return ids, np.bincount(rows, weights=per_word, minlength=len(column)).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", errors="replace")


def encoder(path: str) -> Encoder:
    """The vocabulary at ``path``, loaded once per process."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


# ---------------------------------------------------------------- DataFrame operators


def _mapped(docs: DataFrame, added: list[tuple[str, T.DataType]], work, read: str, sliced: bool = True) -> DataFrame:
    """``docs`` with columns ``added``, computed from column ``read`` block by block."""
    names = {name for name, _ in added}
    kept = [c for c in docs.columns if c not in names or c == read]
    fields = [f for f in docs.select(*kept).schema.fields if f.name not in names]
    schema = T.StructType(fields + [T.StructField(name, kind) for name, kind in added])
    keep = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, read) if sliced else batches:
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(columns + work(batch.column(read)), names=schema.names)

    return docs.select(*kept).mapInArrow(run, schema)


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``."""

    def work(column: pa.Array) -> list[pa.Array]:
        return [pa.array(encoder(path).encode(column)[1])]

    return _mapped(docs, [("n_tokens", T.LongType())], work, text)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and ``n_tokens``."""

    def work(column: pa.Array) -> list[pa.Array]:
        ids, counts = encoder(path).encode(column)
        return [lists(ids, counts), pa.array(counts)]

    return _mapped(docs, [("token_ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType())], work, text)


def decode(docs: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of each row's ids (null ids: null)."""

    def work(column: pa.Array) -> list[pa.Array]:
        vocab = encoder(path)
        return [pa.array([None if x is None else vocab.decode(x) for x in column.to_pylist()], pa.string())]

    return _mapped(docs, [("decoded", T.StringType())], work, ids, sliced=False)


def round_trip(docs: DataFrame, path: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``docs`` without the text, with ``n_tokens`` and digests of the ids and of their decoding
    (and ``token_ids`` themselves, if asked for).

    The ids are encoded and decoded as :func:`encode` and :func:`decode` do, in one pass.
    """

    def work(column: pa.Array) -> list[pa.Array]:
        vocab = encoder(path)
        flat, counts = vocab.encode(column)
        digests, decoded, at = [], [], 0
        for n in counts.tolist():
            ids = flat[at : at + n].tolist()
            at += n
            digests.append(hashlib.sha256(b",".join(map(vocab.ascii.__getitem__, ids))).hexdigest())
            decoded.append(hashlib.sha256(vocab.decode(ids).encode()).hexdigest())
        out = [pa.array(counts), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
        return [lists(flat, counts), *out] if with_ids else out

    added: list[tuple[str, T.DataType]] = [("token_ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    added += [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return _mapped(docs, added, work, text).drop(text)
