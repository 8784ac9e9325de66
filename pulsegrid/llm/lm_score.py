"""Masked pseudo-likelihood of documents under a small bidirectional window network.

Every word is predicted from the words around it, on both sides and without itself: embeddings by
place are added, pass a tanh, and a hierarchical softmax gives the word's probability: a binary tree over all words,
frequent ones near the root, with a logistic unit at each fork that sees the context. A document's score is the sum of
log p(word | context) over its words. A word outside the network's vocabulary is known to it by its bucket, a leaf
like a word, and has its own share of the bucket's corpus counts by a join; so probabilities add up to 1 over all words.
Words are told apart by 64-bit hashes.

Vocabulary and buckets grow with the corpus: the vocabulary with the square root of its words, so what is
broadcast stays small beside the input, and buckets in proportion to it.

Training covers the whole corpus: each task runs stochastic gradient descent over its texts from the same start, and the
tasks' networks are averaged, each row weighted by how often a task used it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import Block, slices
from .tables import frequent_from, id_and_text, written

_PLACES = (-2, -1, 1, 2)


class Tree:
    """Huffman tree over leaves of given mass: the forks above each leaf, the side it lies on, and the forks' log odds."""

    def __init__(self, mass: np.ndarray):
        n = len(mass)
        up = np.full(2 * n - 1, -1, np.int64)
        right = np.zeros(2 * n - 1, np.int8)
        odds = np.zeros(max(0, n - 1), np.float32)
        heap = [(float(m), k) for k, m in enumerate(mass)]
        heapify(heap)
        for fork in range(n, 2 * n - 1):
            (a, x), (b, y) = heappop(heap), heappop(heap)
            up[x] = up[y] = fork
            right[y] = 1
            odds[fork - n] = np.log(b / a)
            heappush(heap, (a + b, fork))
        leaf, at = np.arange(n), np.arange(n)
        steps = []
        while len(at):
            inner = up[at] >= 0
            leaf, at = leaf[inner], at[inner]
            steps.append((leaf, up[at] - n, 2 * right[at].astype(np.float32) - 1))
            at = up[at]
        leaf, fork, side = (np.concatenate(x) for x in zip(*steps, strict=True))
        order = np.argsort(leaf, kind="stable")
        self.fork, self.side, self.odds = fork[order], side[order].astype(np.float32), odds
        self.depth = np.bincount(leaf, minlength=n)
        self.first = self.depth.cumsum() - self.depth
        # Deepest leaves first, and among those of a depth, neighbours in the tree side by side.
        size, place = np.ones(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
        for x in range(2 * n - 2):
            size[up[x]] += size[x]
        left = np.zeros(n - 1, np.int64)
        of_left = np.flatnonzero(right[:-1] == 0)
        left[up[of_left] - n] = size[of_left]
        for x in range(2 * n - 3, -1, -1):
            place[x] = place[up[x]] + right[x] * left[up[x] - n]
        self.rank = np.empty(n, np.int64)
        self.rank[np.lexsort((place[:n], -self.depth))] = np.arange(n)

    def levels(self, leaves: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The ways from the root to some leaves in the order of rank, level by level, without the last leaves, whose ways have
        ended: (forks and sides of different leaves, where each of these begins, which of them each leaf is)."""
        begin = _changes(leaves)
        ends = np.append(begin[1:], len(leaves))
        which = np.zeros(len(leaves), np.int64)
        which[begin[1:]] = 1
        which = which.cumsum()
        leaves = leaves[begin]
        depth = self.depth[leaves]
        last = self.first[leaves] + depth - 1
        for level, n in enumerate(np.searchsorted(-depth, -np.arange(depth.max(initial=0))).tolist()):
            at = last[:n] - level
            yield self.fork.take(at), self.side.take(at), begin[:n], which[: ends[n - 1]]


def _changes(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))


@dataclass
class Vocabulary:
    """The most frequent words, by hash, and buckets for all others; leaves of one tree.

    bucket_mass holds the corpus counts of each bucket's words; without it they are taken as equal.
    """

    words: np.ndarray
    counts: np.ndarray
    other: float
    buckets: int = 64
    bucket_mass: np.ndarray | None = None

    def __post_init__(self):
        n = len(self.words)
        self.edge = n + self.buckets  # stands beyond the ends of a text
        self.order = np.argsort(self.words)
        self.sorted = self.words[self.order]
        # Hashes are even, so their first bits nearly tell their place among the sorted words.
        bits = (4 * n).bit_length()
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.sorted, np.arange(1 << bits, dtype=np.uint64) << self.shift) if n else np.zeros(1, np.int64)
        if self.bucket_mass is None:
            self.bucket_mass = np.full(self.buckets, max(1.0, self.other) / self.buckets)
        self.bucket_mass = np.maximum(self.bucket_mass, 1e-9)  # no word of the corpus meets an empty bucket
        self.tree = Tree(np.concatenate([self.counts, self.bucket_mass]))

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Leaves of words given by hash."""
        n = len(self.words)
        if not n:
            return bucket_of(words, self.buckets)
        at = np.minimum(self.begin.take((words >> self.shift).astype(np.int64)), n - 1)
        met = self.sorted.take(at)
        out = self.order.take(at)
        left = np.flatnonzero(met != words)
        beyond = met[left] > words[left]
        while len(left):  # those whose place is not yet passed look at the next one
            out[left[beyond]] = -1
            left = left[~beyond]
            at[left] += 1
            out[left[at[left] == n]] = -1
            left = left[at[left] < n]
            met, wanted = self.sorted.take(at[left]), words[left]
            found = met == wanted
            out[left[found]] = self.order.take(at[left[found]])
            left, beyond = left[~found], met[~found] > wanted[~found]
        rare = np.flatnonzero(out < 0)
        out[rare] = n + bucket_of(words[rare], self.buckets)
        return out


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return (words % np.uint64(buckets)).astype(np.int64)


def hashed(texts: pa.Array | list[str | None]) -> Block:
    """Hashes of the texts' words, A-Z lowered."""
    return Block(texts, True)


#: Words handled at once, neighbours in the tree of all in a batch, so that what is gathered for their ways through it stays
#: in a core's cache.
_AT_ONCE = 16384


class Network:
    """Embeddings by place, and for each fork of the tree its weights and, last, its log odds; float32, an array per lane
    of the width. Without training it gives each word its share of the corpus."""

    def __init__(self, vocabulary: Vocabulary, width: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        n, odds = vocabulary.edge + 1, vocabulary.tree.odds
        self.parts = {f"place {k}": (rng.standard_normal((width, n)) * 0.3).astype(np.float32) for k in range(len(_PLACES))}
        self.parts["forks"] = np.concatenate([np.zeros((width, len(odds)), np.float32), odds[None, :]])
        self.used = {name: np.zeros(x.shape[1], np.float32) for name, x in self.parts.items()}
        self.past = {name: np.full(x.shape[1], 1e-6, np.float32) for name, x in self.parts.items()}

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """What the context says, by lane, and ones that meet the forks' log odds."""
        places = [self.parts[f"place {k}"] for k in range(len(_PLACES))]
        out = np.ones((len(places[0]) + 1, len(context)), np.float32)
        at = np.ascontiguousarray(context.T)
        for lane in range(len(places[0])):
            total = sum(p[lane].take(c) for p, c in zip(places, at, strict=True))
            out[lane] = 1 - 2 / (1 + np.exp(np.minimum(2 * total, 60)))  # tanh, which is slow by itself
        return out

    def log_words(self, tree: Tree, context: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """log p(leaf | context) of each word, in the order of rank."""
        hidden, forks = self.hidden(context), self.parts["forks"]
        total = np.zeros(len(leaves), np.float32)
        for fork, side, _, which in tree.levels(leaves):
            each = fork.take(which)
            z = forks[-1].take(each)
            for h, w in zip(hidden[:-1], forks, strict=False):
                z += h[: len(z)] * w.take(each)
            z *= np.negative(side).take(which)
            total[: len(z)] -= np.log(1 + np.exp(np.minimum(z, 80, out=z), out=z))
        return total

    def _pull(self, tree: Tree, context: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where some words pull, in the order of rank: what comes back to their contexts; forks, how many words met each, and
        what comes to it. A fork is named once for words side by side that meet it."""
        h, weights = self.hidden(context), self.parts["forks"]
        back = np.zeros((len(h) - 1, len(leaves)), np.float32)
        w, products = np.empty((2, *h.shape), np.float32)
        forks, met, pulls = [], [], []
        for fork, side, begin, which in tree.levels(leaves):
            each, side = fork.take(which), side.take(which)
            n, new = len(each), _changes(fork)
            some, seen, product = w[:, :n], h[:, :n], products[:, :n]
            for lane, row in enumerate(weights):
                row.take(each, out=some[lane], mode="clip")
            z = np.multiply(seen, some, out=product).sum(0)
            z *= side
            pull = side / (1 + np.exp(np.minimum(z, 80, out=z), out=z))
            begin = begin[new]
            forks.append(fork[new])
            met.append(np.diff(begin, append=n))
            pulls.append(np.add.reduceat(np.multiply(seen, pull, out=product), begin, axis=1))
            back[:, :n] += np.multiply(some[:-1], pull, out=product[:-1])
        return back * (1 - h[:-1] * h[:-1]), np.concatenate(forks), np.concatenate(met), np.concatenate(pulls, 1)

    def learn(self, tree: Tree, context: np.ndarray, leaves: np.ndarray, rate: float) -> None:
        """One step on a batch of words. A column's steps get shorter with what it has moved before."""
        if not len(leaves):
            return
        order = np.argsort(tree.rank.take(leaves))
        context, leaves = context.T.take(order, 1).T, leaves.take(order)
        pulled = [self._pull(tree, context[k : k + _AT_ONCE], leaves[k : k + _AT_ONCE]) for k in range(0, len(leaves), _AT_ONCE)]
        back, forks, met, pulls = (np.concatenate(x, -1) for x in zip(*pulled, strict=True))
        self._move("forks", forks, met, pulls, rate)
        for place, at in enumerate(context.T):
            self._move(f"place {place}", at, None, back, rate)

    def _move(self, name: str, at: np.ndarray, met: np.ndarray | None, pulls: np.ndarray, rate: float) -> None:
        """Adds up what pulls at each column and moves those that were met."""
        part, past = self.parts[name], self.past[name]
        used = np.bincount(at, met, part.shape[1])
        columns = np.flatnonzero(used)
        self.used[name] += used
        total = np.stack([np.bincount(at, lane, part.shape[1]).take(columns) for lane in pulls])
        past[columns] += np.square(total).sum(0).astype(np.float32)
        part[:, columns] += (total * (rate / np.sqrt(past[columns]))).astype(np.float32)


def contexts(vocabulary: Vocabulary, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, their contexts, words per text) of some texts; places beyond a text hold the edge."""
    reach = max(_PLACES)
    ids = vocabulary.ids(block.words)
    at = np.arange(len(ids)) + reach * (block.doc + 1)
    padded = np.full(len(ids) + reach * (len(block.lengths) + 1), vocabulary.edge, np.int64)
    padded[at] = ids
    return ids, np.stack([padded[at + p] for p in _PLACES]).T, block.lengths


def vocabulary_size(words: int, least: int) -> int:
    """Words the network knows in a corpus of so many: twice their square root. A task's network is then that many rows,
    and all tasks' networks together stay small beside the texts they were trained on."""
    return max(least, 2 * isqrt(words))


def count_words(docs: DataFrame, least: int) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the table (word, n) of all words of the corpus, which stays in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 5000):
            words, n = np.unique(hashed(part["text"]).words, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    counted = written(docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    size = vocabulary_size(total, least)
    top = counted.where(F.col("n") >= frequent_from(counted, size)).collect()  # at most size rows
    top = sorted(((r.n, r.word) for r in top), key=lambda x: (-x[0], x[1]))
    words = np.array([w for _, w in top], np.int64).view(np.uint64)
    buckets = max(64, size // 128)

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(buckets)
        for part in batches:
            at = bucket_of(np.asarray(part["word"]).view(np.uint64), buckets)
            mass += np.bincount(at, np.asarray(part["n"]), buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(mass)], ["bucket", "n"])

    mass = np.zeros(buckets)
    for r in counted.mapInArrow(masses, "bucket long, n double").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        mass[r.bucket] = r.n
    counts = np.array([n for n, _ in top], float)
    mass -= np.bincount(bucket_of(words, buckets), counts, buckets)
    return Vocabulary(words, counts, float(total - counts.sum()), buckets, mass), counted


def train(docs: DataFrame, vocabulary: Vocabulary, *, rate: float = 0.5) -> Network:
    """One pass over all texts in every task, then the average of the tasks' networks."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the vocabulary's size
    batch = max(16384, vocabulary.edge)  # so a step's work on whole arrays stays in proportion to its words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        net = Network(v)
        words = 0
        for part in slices(batches, 500, 1_000_000):
            ids, context, _ = contexts(v, hashed(part["text"]))
            words += len(ids)
            for at in range(0, len(ids), batch):
                net.learn(v.tree, context[at : at + batch], ids[at : at + batch], rate)
        if words:
            yield _rows([(name, 0, x.tobytes(), net.used[name].tobytes()) for name, x in net.parts.items()])

    trained = docs.mapInArrow(run, _PARTS)
    net = Network(vocabulary)
    # Averages of averages: about as many groups as each has networks, so no task holds many.
    groups = max(1, round(docs.rdd.getNumPartitions() ** 0.5))
    some = trained.withColumn("some", F.spark_partition_id() % groups).groupBy("part", "some").applyInArrow(_average, _PARTS)
    for r in some.groupBy("part").applyInArrow(_average, _PARTS).collect():  # one network
        net.parts[r.part] = np.frombuffer(r["values"], np.float32).reshape(net.parts[r.part].shape).copy()
    return net


_PARTS = "part string, some int, values binary, used binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "some", "values", "used"])


def _average(table: pa.Table) -> pa.Table:
    """The mean of each row of arrays, weighted by its use; the plain mean of a row that none used."""
    rows = table.to_pylist()
    used = [np.frombuffer(r["used"], np.float32) for r in rows]
    total = np.sum(used, axis=0)
    values = 0
    for r, n in zip(rows, used, strict=True):
        share = np.where(total > 0, n / np.maximum(total, 1), 1 / len(rows)).astype(np.float32)
        values = values + np.frombuffer(r["values"], np.float32).reshape(-1, len(total)) * share
    return pa.Table.from_batches([_rows([(rows[0]["part"], rows[0]["some"], np.ascontiguousarray(values, np.float32).tobytes(), total.astype(np.float32).tobytes())])])


def log_likelihoods(vocabulary: Vocabulary, net: Network, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(words, summed log p(word or its bucket | context)) of each text."""
    return _summed(vocabulary, net, *contexts(vocabulary, hashed(texts)))


def _summed(vocabulary: Vocabulary, net: Network, ids: np.ndarray, context: np.ndarray, lengths: np.ndarray, batch: int = _AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    logs = np.empty(len(ids), np.float64)
    order = np.argsort(vocabulary.tree.rank.take(ids))
    places = np.ascontiguousarray(context.T)
    for at in range(0, len(ids), batch):
        some = order[at : at + batch]
        logs[some] = net.log_words(vocabulary.tree, places.take(some, 1).T, ids.take(some))
    ends = lengths.cumsum()
    sums = np.concatenate([[0.0], logs.cumsum()])
    return lengths, sums[ends] - sums[ends - lengths]


def score_documents(docs: DataFrame, *, vocabulary: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Trains on all texts, then returns doc_id, n_words, log_likelihood (sum), per_word (mean) for each row.

    Null and empty texts have no words, log_likelihood 0 and per_word null. Null ids and repeated rows are
    scored like others, and rows with equal texts score the same; an empty table gives no rows. The network knows
    `vocabulary` words, or more where the corpus is large; of words with equal counts all or none. A word beyond them gets
    its bucket's probability times its own share of the bucket's counts.
    """
    return trained_scores(docs, vocabulary=vocabulary, id_col=id_col, text_col=text_col)[0]


def trained_scores(docs: DataFrame, *, vocabulary: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Vocabulary, Network, DataFrame]:
    """The scores of score_documents, and what they were made with: vocabulary, network and the table (word, n) of all words."""
    rows = id_and_text(docs, id_col, text_col)
    words, counted = count_words(rows, vocabulary)
    net = train(rows, words)
    shared = docs.sparkSession.sparkContext.broadcast((words, net))  # bounded by the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, network = shared.value
        known = len(v.words)
        log_mass = np.log(v.bucket_mass)
        for part in slices(batches, 500, 1_000_000):
            block = hashed(part["text"])
            ids, context, n = contexts(v, block)
            n, total = _summed(v, network, ids, context, n)
            rare = ids >= known
            doc = block.doc[rare]
            total = total - np.bincount(doc, log_mass[ids[rare] - known], len(n))
            ends = np.concatenate([[0], np.bincount(doc, minlength=len(n)).cumsum()])
            found = pa.array(block.words[rare].view(np.int64))
            yield pa.RecordBatch.from_arrays([part["row"], part["doc_id"], pa.array(n), pa.array(total), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], ["row", "doc_id", "n_words", "total", "rare"])

    # The row number is only used from the written table on, so a task run again cannot change it.
    scored = written(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "row long, doc_id long, n_words long, total double, rare array<long>"))
    own = scored.select("row", F.explode("rare").alias("word")).join(counted, "word").groupBy("row").agg(F.sum(F.log("n")).alias("own"))
    out = scored.drop("rare").join(own, "row", "left").withColumn("log_likelihood", F.col("total") + F.coalesce("own", F.lit(0.0)))
    out = out.select("doc_id", "n_words", "log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")).alias("per_word"))
    return out, words, net, counted


def query(spark, sf_dir: str) -> DataFrame:
    """op2: all documents, scored by a network trained on all of them."""
    from .tables import table

    return score_documents(table(spark, sf_dir, "documents"))
