"""Token counts of documents under a unigram vocabulary, by dynamic programming on a trie of pre-tokens.

The best score of a prefix depends on the prefix alone. Distinct pre-tokens go into one trie, each node gets its
best score and number of pieces once, however many pre-tokens share it, and a pre-token's count
is read at its last node. The new pre-tokens of some texts make a trie of their own, whose nodes of equal
depth are scored together; the longest ones go through one that is built node by node.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashing import slices
from .packing import _CHUNK, odd
from .tables import id_and_text
from .workers import held

#: Pre-tokens of more bytes are scored one by one, so that one of them adds no level to the trie of all others.
_LONG = 64


class Steps:
    """The steps of a trie, (node, byte) to node, as a hash table in arrays."""

    def __init__(self, steps: dict[int, int]):
        keys = np.fromiter(steps, np.int64, len(steps))
        nodes = np.fromiter(steps.values(), np.int64, len(steps))
        self.bits = max(10, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nodes = np.zeros(1 << self.bits, np.int64)
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several for one slot the last stays
            here = self.keys[at] == keys
            self.nodes[at[here]] = nodes[here]
            keys, nodes, at = keys[~here], nodes[~here], (at[~here] + 1) & (1 << self.bits) - 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def follow(self, keys: np.ndarray) -> np.ndarray:
        """The node each key leads to, or -1."""
        at = self._slots(keys)
        met = self.keys[at]
        out = np.where(met == keys, self.nodes[at], -1)
        on = np.flatnonzero((met != keys) & (met >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (1 << self.bits) - 1
            met = self.keys[at[on]]
            here = met == keys[on]
            out[on[here]] = self.nodes[at[on[here]]]
            on = on[~here & (met >= 0)]
        return out


class PieceTrie:
    """Forward scores over a trie of byte strings. Pieces must include every single byte."""

    def __init__(self, pieces: dict[bytes, float], room: int = 300_000):
        self.room = room
        self.ending: dict[int, int] = {}  # trie of reversed pieces: node * 256 + byte -> node
        self.value: list[float | None] = [None]
        for piece, score in pieces.items():
            at = 0
            for b in reversed(piece):
                key = at << 8 | b
                if key not in self.ending:
                    self.ending[key] = len(self.value)
                    self.value.append(None)
                at = self.ending[key]
            self.value[at] = score
        self.steps = Steps(self.ending)
        self.values = np.array([np.nan if v is None else v for v in self.value])
        self._empty()

    def _empty(self) -> None:
        self.child: dict[int, int] = {}
        self.parent, self.byte, self.best, self.count = [0], [0], [0.0], [0]

    def tokens(self, pre_token: bytes) -> int:
        """Pieces of the best segmentation; the fewest among equally good ones."""
        if len(self.best) > self.room:
            self._empty()
        at, child = 0, self.child
        for b in pre_token:
            key = at << 8 | b
            node = child.get(key)
            if node is None:
                node = child[key] = self._node(at, b)
            at = node
        return self.count[at]

    def tokens_of(self, pre_tokens: list[bytes]) -> np.ndarray:
        """tokens of each of some pre-tokens."""
        lengths = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        long = lengths > _LONG
        if long.any():
            out = np.empty(len(pre_tokens), np.int64)
            out[long] = [self.tokens(p) for p in pre_tokens if len(p) > _LONG]
            out[~long] = self.tokens_of([p for p in pre_tokens if len(p) <= _LONG])
            return out
        order = sorted(range(len(pre_tokens)), key=pre_tokens.__getitem__)  # those with a common prefix stand together
        lengths = lengths[order]
        raw = np.frombuffer(b"".join([pre_tokens[k] for k in order]), np.uint8).astype(np.int64)
        first = lengths.cumsum() - lengths
        room = len(raw) + 1
        up, own, best, count = np.zeros(room, np.int64), np.zeros(room, np.int64), np.zeros(room), np.zeros(room, np.int64)
        last = np.zeros(len(lengths), np.int64)  # node of each pre-token's prefix; 0 is the root
        some, n = np.arange(len(lengths)), 1
        for depth in range(int(lengths.max(initial=0))):
            some = some[lengths[some] > depth]
            at, byte = last[some], raw[first[some] + depth]
            new = np.ones(len(some), bool)
            new[1:] = (at[1:] != at[:-1]) | (byte[1:] != byte[:-1])
            nodes = n + np.arange(int(new.sum()))
            last[some] = n - 1 + new.cumsum()
            up[nodes], own[nodes] = at[new], byte[new]
            best[nodes], count[nodes] = self._level(up, own, best, count, nodes)
            n += len(nodes)
        out = np.empty(len(pre_tokens), np.int64)
        out[order] = count[last]
        return out

    def _level(self, up: np.ndarray, own: np.ndarray, best: np.ndarray, count: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best scores, counts) of nodes of equal depth, as _node finds them one by one."""
        top, fewest = np.full(len(nodes), -np.inf), np.zeros(len(nodes), np.int64)
        on, walk, byte, at = np.arange(len(nodes)), np.zeros(len(nodes), np.int64), own[nodes], up[nodes]
        while len(on):
            walk = self.steps.follow(walk << 8 | byte)
            more = walk >= 0
            on, walk, at = on[more], walk[more], at[more]
            value = self.values[walk]
            s, c = best[at] + value, count[at] + 1
            better = (s > top[on] + 1e-9) | ((s > top[on] - 1e-9) & (c < fewest[on]))  # never where no piece ends
            top[on[better]], fewest[on[better]] = s[better], c[better]
            more = at > 0
            on, walk, at = on[more], walk[more], at[more]
            byte, at = own[at], up[at]
        return top, fewest

    def score(self, pre_token: bytes) -> float:
        self.tokens(pre_token)
        at = 0
        for b in pre_token:
            at = self.child[at << 8 | b]
        return self.best[at]

    def _node(self, parent: int, byte: int) -> int:
        """A new node; its score from those above it and the pieces that end here."""
        up, own, best, count, value = self.parent, self.byte, self.best, self.count, self.value
        node = len(best)
        up.append(parent)
        own.append(byte)
        ending, walk, at, b = self.ending.get, 0, parent, byte
        top, fewest = -math.inf, 0
        while True:
            walk = ending(walk << 8 | b)
            if walk is None:
                break
            if value[walk] is not None:
                s, c = best[at] + value[walk], count[at] + 1
                if s > top + 1e-9 or (s > top - 1e-9 and c < fewest):
                    top, fewest = s, c
            if not at:
                break
            b, at = own[at], up[at]
        best.append(top)
        count.append(fewest)
        return node


def rank_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probabilities that fall with a piece's rank by Zipf's law, for vocabularies that give only ranks."""
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {p: -math.log(r + 1) - total for p, r in ranks.items()}


class Counts:
    """Counts per text; chunks between white space are counted once and remembered, up to a bounded number."""

    def __init__(self, pieces: dict[bytes, float], pattern: str, remember: int = 200_000):
        import regex

        self.trie, self.split = PieceTrie(pieces), regex.compile(pattern).findall
        #: tokens, and pre-tokens in the bits from 32 on
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}  # what was known before; frequent chunks come over from it
        self.remember = remember

    def _new(self, chunks: list[str]) -> Iterator[tuple[str, int]]:
        """Counts of chunks by the trie of all their pre-tokens; letters after one blank are one pre-token."""
        plain, rest = [], []
        for c in chunks:
            (plain if (c[1:] if c[0] == " " else c).isalpha() else rest).append(c)
        parts = list(map(self.split, rest))
        tokens = self.trie.tokens_of(list(map(str.encode, chain(plain, chain.from_iterable(parts)))))
        yield from zip(plain, (tokens[: len(plain)] | 1 << 32).tolist(), strict=True)
        if rest:
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            sums = np.add.reduceat(tokens[len(plain) :], sizes.cumsum() - sizes)
            yield from zip(rest, (sums | sizes << 32).tolist(), strict=True)

    def _counts(self, chunks: set[str]) -> dict[str, int]:
        found = dict(zip(chunks, map(self.known.get, chunks), strict=True))
        missing = [c for c, n in found.items() if n is None]
        fresh = dict(zip(missing, map(self.older.get, missing), strict=True))
        fresh.update(self._new([c for c, n in fresh.items() if n is None]))
        if len(self.known) + len(fresh) > self.remember:
            self.known, self.older = {}, self.known
        found |= fresh
        long = [c for c in fresh if len(c) > _LONG]
        for c in long:
            del fresh[c]
        self.known |= fresh
        return found

    def count_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(pre-tokens, tokens) of each text; none for null and empty text."""
        pre, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        parts = [_CHUNK.findall(t) if t and not odd(t) else [] for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        some = np.flatnonzero(sizes)
        if len(some):
            counts = self._counts(set(chain.from_iterable(parts))).__getitem__
            both = np.fromiter(map(counts, chain.from_iterable(parts)), np.int64, sizes.sum())
            starts = (sizes.cumsum() - sizes)[some]
            pre[some] = np.add.reduceat(both >> 32, starts)
            tokens[some] = np.add.reduceat(both & 0xFFFFFFFF, starts)
        whole = [k for k, t in enumerate(texts) if t and not sizes[k]]
        if whole:
            parts = [self.split(texts[k]) for k in whole]
            pre[whole] = sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            tokens[whole] = np.add.reduceat(self.trie.tokens_of(list(map(str.encode, chain.from_iterable(parts)))), sizes.cumsum() - sizes)
        return pre, tokens

    def count(self, text: str | None) -> tuple[int, int]:
        pre, tokens = self.count_all([text])
        return int(pre[0]), int(tokens[0])


def public_counts(ranks: str = "byte_bpe_50k.tiktoken") -> Counts:
    """One for each worker process, as long as it counts."""
    import public_tokenizers

    def make() -> Counts:
        with open(public_tokenizers.path(ranks), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return Counts(rank_scores(table), public_tokenizers.PATTERN)

    return held("token counts", ranks, make)


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", counts=public_counts) -> DataFrame:
    """Returns doc_id, n_pre_tokens, n_tokens for every row.

    Null and empty texts have 0 of both; null ids and repeated rows are counted like others; an empty table gives no
    rows. Very long words are scored whole. No shuffle; a worker's trie and memory of chunks are bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counts()
        for part in slices(batches, 2000, 3_000_000):
            pre, tokens = counter.count_all(part["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(pre), pa.array(tokens)], ["doc_id", "n_pre_tokens", "n_tokens"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_pre_tokens long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: all documents."""
    from .tables import table

    return count_tokens(table(spark, sf_dir, "documents"))
