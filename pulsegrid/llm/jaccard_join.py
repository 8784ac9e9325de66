"""N-gram Jaccard self-join by T-occurrence search, and the groups its links form.

1. Each document's distinct word runs are hashed (56 bits) and sent, packed, to the tasks that own ranges
   of hashes; a block of documents sends a run once, however many of its documents have it. These tasks count in
   how many documents each run occurs and send the shared ones back.
2. Equal sets, by a 128-bit digest of two independent hashes, are one class. A class can have links only if
   enough of its set is shared. Its rarest runs, as many as two linked sets must have one of in common, name
   the classes it must be compared with.
3. Classes that are connected through such runs form neighbourhoods. In each, DivideSkip finds for a query
   set the sets that share at least T of its runs: short inverted lists are merged with a heap, the
   longest ones are probed by binary search.
4. A neighbourhood too large for a task is cut into chunks. All are compared with one chunk of pivots first; what these
   connect needs no more comparing, so only the sets left over are compared with all chunks.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .hashing import _M2, Block, bucket_bounds, mix, pack, pack_sorted, rolling, slices, unpack, unpack_sorted
from .tables import blocks_for, cut_lineage, dealt, default_tasks, id_and_text, steady, written
from .workers import begin

_HEAD = np.dtype([("id", "<i8"), ("known", "<i8"), ("key", "<i8"), ("n", "<i8"), ("a", "<i8"), ("b", "<i8")])
_SENT = "bucket int, block long, tokens binary, docs binary, local binary, head binary"
_SHARED = "block long, tokens binary, docs binary, counts binary, head binary, own_tokens binary, own_docs binary"
_ROWS = "doc_id long, row_key long, n long, a long, b long, shared binary, prefix int"
#: Stands for the document of a run that several documents of its block have.
_SEVERAL = 0xFFFF


def shingle_tokens(texts: pa.Array | list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, document, other 64-bit hash) of each distinct run, by token; a document of fewer words is one run as a whole."""
    block = Block(texts, True)
    h, at = block.runs(size)
    other = block.runs(size, _M2)[0]
    doc = block.doc[at]
    short = np.flatnonzero((block.lengths > 0) & (block.lengths < size))
    if len(short):
        whole = [[rolling(block.words[block.starts[d] : block.ends[d]], int(block.lengths[d]), m)[0] for d in short] for m in (0x9E3779B97F4A7C15, _M2)]
        lengths = block.lengths[short].astype(np.uint64)
        h = np.concatenate([h, mix(np.array(whole[0], np.uint64) + lengths)])
        other = np.concatenate([other, mix(np.array(whole[1], np.uint64) + lengths)])
        doc = np.concatenate([doc, short])
    h = h >> np.uint64(8)
    order = np.lexsort((doc, h)) if len(short) else np.argsort(h, kind="stable")
    h, doc, other = h[order], doc[order], other[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new], other[new]


def _send(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("near duplicates")
        bounds = bucket_bounds(buckets)
        block = TaskContext.get().partitionId() << 32
        for part in slices(batches, 1000, 2_000_000):
            tokens, doc, other = shingle_tokens(part["text"], size)
            head = np.zeros(part.num_rows, _HEAD)
            head["id"] = np.asarray(pa.compute.fill_null(part["doc_id"], 0))
            head["known"] = np.asarray(pa.compute.is_valid(part["doc_id"]))
            head["key"] = np.asarray(part["row_key"])
            head["n"] = np.bincount(doc, minlength=part.num_rows)
            for name, hashes in (("a", mix(tokens + np.uint64(0x1234567))), ("b", other)):
                total = np.zeros(part.num_rows, np.uint64)
                np.add.at(total, doc, hashes)
                head[name] = total.view(np.int64)
            new = np.ones(len(tokens), bool)
            new[1:] = tokens[1:] != tokens[:-1]
            local = np.diff(np.flatnonzero(np.r_[new, True]))
            several = local > 1
            once, docs = tokens[new], np.where(several, _SEVERAL, doc[new]).astype("<u2")
            cuts = [0, *np.searchsorted(once, bounds).tolist(), len(once)]
            rows = [(k, block, pack_sorted(once[x:y]), pack(docs[x:y]), pack(local[x:y][several[x:y]].astype("<u2")), None) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
            own = np.repeat(several, local)
            rows.append((block % buckets, block, pack_sorted(tokens[own]), pack(doc[own].astype("<u2")), None, pack(head.view(np.uint8))))
            yield _batch(rows, [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()], _SENT)
            block += 1

    return run


def _batch(rows: list[tuple], kinds: list, schema: str) -> pa.RecordBatch:
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


_SHARED_KINDS = [pa.int64(), *[pa.binary()] * 6]


def _share(table: pa.Table) -> pa.Table:
    """Keeps the tokens of a range that occur in several documents, with their counts."""
    begin("near duplicates")
    sent = table.to_pylist()
    rows = [(x["block"], None, None, None, x["head"], x["tokens"], x["docs"]) for x in sent if x["head"] is not None]
    sent = [(x["block"], unpack_sorted(x["tokens"]), unpack(x["docs"], "<u2"), unpack(x["local"], "<u2")) for x in sent if x["head"] is None]
    if sent:
        tokens = np.concatenate([t for _, t, _, _ in sent])
        weight = np.ones(len(tokens), np.int64)
        weight[np.concatenate([d for _, _, d, _ in sent]) == _SEVERAL] = np.concatenate([n for _, _, _, n in sent])
        order = np.argsort(tokens, kind="stable")
        new = np.ones(len(tokens), bool)
        new[1:] = tokens[order[1:]] != tokens[order[:-1]]
        place = np.empty(len(tokens), np.int64)
        place[order] = new.cumsum() - 1
        counts = np.bincount(place, weight).astype(np.int64)[place]
        at = 0
        for block, t, d, _ in sent:
            n = counts[at : at + len(t)]
            at += len(t)
            shared = n > 1
            if shared.any():
                rows.append((block, pack_sorted(t[shared]), pack(d[shared]), pack(n[shared].astype("<u8")), None, None, None))
    return pa.Table.from_batches([_batch(rows, _SHARED_KINDS, _SHARED)])


def _gather(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """A row per document of a block; shared tokens, rarest first, where enough are shared."""
        sent = table.to_pylist()
        mine = next(x for x in sent if x["head"] is not None)
        head = unpack(mine["head"], np.uint8).view(_HEAD)
        sent = [(unpack_sorted(x["tokens"]), unpack(x["docs"], "<u2"), unpack(x["counts"], "<u8")) for x in sent if x["head"] is None]
        n = head["n"]
        least = -(-n * percent // 100)
        shared: list[bytes | None] = [None] * len(head)
        prefix = np.zeros(len(head), np.int64)
        if sent:
            tokens, doc, counts = (np.concatenate(c) for c in zip(*sent, strict=True))
            several = doc == _SEVERAL
            names = np.argsort(tokens[several], kind="stable")
            own = unpack_sorted(mine["own_tokens"])
            own_counts = counts[several][names][np.searchsorted(tokens[several][names], own)]
            tokens = np.concatenate([tokens[~several], own])
            doc = np.concatenate([doc[~several], unpack(mine["own_docs"], "<u2")]).astype(np.int64)
            counts = np.concatenate([counts[~several], own_counts])
            have = np.bincount(doc, minlength=len(head))
            able = (100 * n >= percent * (n + 1)) & (have >= least)  # smaller sets link with equal ones only
            keep = able[doc]
            tokens, doc, counts = tokens[keep], doc[keep], counts[keep]
            order = np.lexsort((tokens, counts, doc))
            tokens = tokens[order]
            ends = np.bincount(doc, minlength=len(head)).cumsum()
            prefix = (n - least + 1) - (n - have)
            for d in np.flatnonzero(able).tolist():
                shared[d] = tokens[ends[d] - have[d] : ends[d]].tobytes()
        ids = pa.array(head["id"], mask=head["known"] == 0)
        return pa.table([ids, *[pa.array(head[c]) for c in ("key", "n", "a", "b")], pa.array(shared, pa.binary()), pa.array(prefix.astype(np.int32))], names=["doc_id", "row_key", "n", "a", "b", "shared", "prefix"])

    return run


def row_key() -> Column:
    """Tells the rows of an id apart by their text; equal rows have equal keys."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def shared_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row per document: its set's size n and digest (a, b), and its shared tokens if links are possible."""
    docs = steady(docs.select("doc_id", "text", row_key().alias("row_key")))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = blocks_for(chars, 16_000_000, default_tasks(docs.sparkSession))
    sent = docs.mapInArrow(_send(size, tasks), _SENT)
    shared = dealt(sent, "bucket", tasks).applyInArrow(_share, _SHARED)
    return dealt(shared, "block", tasks).applyInArrow(_gather(percent), _ROWS)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the runs a class must be looked up by: (token, node, null), and (null, node, other node) for classes of the batch
    that a run connects; of these only one stands in the tokens' rows, so a hot token has a row for each batch."""
    for batch in batches:
        tokens = [np.frombuffer(s, np.uint64)[:p] for s, p in zip(batch["shared"].to_pylist(), batch["prefix"].to_pylist(), strict=True)]
        owner = np.repeat(np.arange(len(tokens)), np.fromiter(map(len, tokens), np.int64, len(tokens)))
        flat = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        forest = Forest(len(tokens))
        for k in np.flatnonzero(flat[1:] == flat[:-1]).tolist():
            forest.union(int(owner[k]), int(owner[k + 1]))
        root = np.fromiter(map(forest.find, range(len(tokens))), np.int64, len(tokens))
        first = np.ones(len(flat), bool)
        first[1:] = flat[1:] != flat[:-1]  # all holders of a token have one root
        node = np.asarray(batch["node"])
        inner = np.flatnonzero(root != np.arange(len(tokens)))
        a = np.concatenate([node[root[owner[first]]], node[inner]])
        n, m = int(first.sum()), len(inner)
        token = pa.array(np.concatenate([flat[first].view(np.int64), np.zeros(m, np.int64)]), mask=np.r_[np.zeros(n, bool), np.ones(m, bool)])
        b = pa.array(np.concatenate([np.zeros(n, np.int64), node[root[inner]]]), mask=np.r_[np.ones(n, bool), np.zeros(m, bool)])
        yield pa.RecordBatch.from_arrays([token, pa.array(a), b], ["token", "a", "b"])


class Index:
    """Inverted lists of sets numbered by size; postings of a list ascend."""

    def __init__(self, owner: np.ndarray, token: np.ndarray, n_tokens: int):
        order = np.argsort(token, kind="stable")
        self.postings = owner[order]
        self.at = np.zeros(n_tokens + 1, np.int64)
        np.cumsum(np.bincount(token, minlength=n_tokens), out=self.at[1:])

    def lists(self, tokens: np.ndarray, low: int, high: int, skip: np.ndarray | None = None) -> list[np.ndarray]:
        """Non-empty parts of the tokens' lists within [low, high), without the sets to skip."""
        out = []
        for a, b in zip(self.at[tokens].tolist(), self.at[tokens + 1].tolist(), strict=True):
            if a < b:
                x = self.postings[a:b]
                if x[0] < low or x[-1] >= high:
                    x = x[np.searchsorted(x, low) : np.searchsorted(x, high)]
                if skip is not None and len(x):
                    x = x[~skip[x]]
                if len(x):
                    out.append(x)
        return out


def divide_skip(lists: list[np.ndarray], least: int, weight: float = 0.01) -> Iterator[tuple[int, int]]:
    """(number, occurrences) of the sets on at least `least` of the lists.

    The longest lists, fewer than `least`, are set aside. The others are merged by a heap that skips
    ahead where too few lists agree; what reaches the rest of the threshold is looked for in the long ones.
    """
    if len(lists) < least or least < 1:
        return
    lists = sorted(lists, key=len)
    long_n = min(least - 1, int(least / (weight * np.log2(max(2, len(lists[-1]))) + 1)), len(lists) - 1)
    short, long = lists[: len(lists) - long_n], lists[len(lists) - long_n :][::-1]
    need = least - long_n
    merged = list(_heap_merge([x.tolist() for x in short], need))
    numbers, counts = np.array([n for n, _ in merged], np.int64), np.array([c for _, c in merged], np.int64)
    alike = [x for x in long if len(x) <= 4 * len(numbers)]  # not much longer than the candidates: one search for the entries of all these lists
    if alike and len(numbers):
        entries = np.concatenate(alike)
        place = np.minimum(np.searchsorted(numbers, entries), len(numbers) - 1)
        counts = counts + np.bincount(place[numbers[place] == entries], minlength=len(numbers))
        long = [x for x in long if len(x) > 4 * len(numbers)]
    for k, x in enumerate(long):  # a search in each longer list for all candidates left
        able = counts + (len(long) - k) >= least
        if not able.all():
            numbers, counts = numbers[able], counts[able]
        if not len(numbers):
            return
        counts = counts + (x[np.minimum(np.searchsorted(x, numbers), len(x) - 1)] == numbers)
    able = counts >= least
    yield from zip(numbers[able].tolist(), counts[able].tolist(), strict=True)


def _heap_merge(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    heap = [(x[0], k, 0) for k, x in enumerate(lists)]
    heapify(heap)
    while len(heap) >= need:
        number = heap[0][0]
        popped = []
        while heap and heap[0][0] == number:
            popped.append(heappop(heap))
        if len(popped) >= need:
            yield number, len(popped)
            nexts = number + 1
        else:
            while heap and len(popped) < need - 1:
                popped.append(heappop(heap))
            if not heap:
                if len(popped) < need:
                    return
                nexts = number + 1
            else:
                nexts = heap[0][0]
        for _, k, p in popped:
            p = bisect_left(lists[k], max(nexts, number + 1), p)
            if p < len(lists[k]):
                heap.append((lists[k][p], k, p))
        heapify(heap)


def link_sets(sizes: np.ndarray, sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Which sets belong together: pairs (set, least set connected with it by links).

    sizes are whole set sizes, ascending; sets hold the shared tokens, enough to count overlaps. With sides
    (0 or 1) only links between sides are looked for. Sets already connected are not compared again.
    """
    count = len(sets)
    forest = Forest(count)
    lengths = np.fromiter(map(len, sets), np.int64, count)
    names, token = np.unique(np.concatenate(sets), return_inverse=True)
    ends = lengths.cumsum()
    own = [np.sort(token[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
    owner = np.repeat(np.arange(count), lengths)
    index = {s: Index(owner[m], token[m], len(names)) for s in (0, 1) for m in [np.ones(len(owner), bool) if sides is None else sides[owner] == s]} if sides is not None else {0: Index(owner, token, len(names))}
    giant, giant_size, rest, pivot = -1, 64, index, -1  # the largest component, and an index without most of it
    inside = np.zeros(count, bool)  # sets known to be in it

    def overlap_needed(a: int, b: int) -> int:
        return -(-percent * int(sizes[a] + sizes[b]) // (100 + percent))

    def linked(a: int, b: int) -> bool:
        return len(np.intersect1d(own[a], own[b], assume_unique=True)) >= overlap_needed(a, b)

    for q in range(count):
        low = int(np.searchsorted(sizes, -(-sizes[q] * percent // 100)))
        if low >= q:
            continue
        if pivot >= low and forest.find(q) != forest.find(giant) and (sides is None or sides[pivot] != sides[q]) and linked(q, pivot):
            forest.union(q, pivot)
        mine = forest.find(q)
        in_giant = giant >= 0 and mine == forest.find(giant)
        found = (rest if in_giant else index)[0 if sides is None else 1 - int(sides[q])]
        least = -(-percent * int(sizes[q] + sizes[low]) // (100 + percent))
        for c, n in divide_skip(found.lists(own[q], low, q, inside if in_giant else None), least):
            if forest.find(c) != forest.find(q) and n >= overlap_needed(q, c):
                forest.union(q, c)
        root = forest.find(q)
        if giant >= 0 and root == forest.find(giant):
            pivot, inside[q] = q, True
        if forest.size[root] >= 1.3 * giant_size:
            giant, giant_size, pivot = root, forest.size[root], q
            inside = np.fromiter((forest.find(k) == root for k in range(count)), bool, count)
            outside = ~inside[owner]
            rest = {s: Index(owner[m], token[m], len(names)) for s in index for m in [outside if sides is None else outside & (sides[owner] == s)]}
    return [(k, forest.find(k)) for k in range(count) if forest.find(k) != k]


def _link(percent: int):
    def run(table: pa.Table) -> pa.Table:
        begin("near duplicates")
        a: list[int] = []
        b: list[int] = []
        group, node, n, side = (np.asarray(table[c]) for c in ("group", "node", "n", "side"))
        data = table["shared"].to_pylist()
        order = np.lexsort((node, n, group))
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            if len(rows) < 2:
                continue
            sides = None if (side[rows] < 0).all() else side[rows].astype(np.int64)
            for x, y in link_sets(n[rows], [np.frombuffer(data[r], np.uint64) for r in rows.tolist()], percent, sides):
                a.append(int(node[rows[x]]))
                b.append(int(node[rows[y]]))
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _linked(placed: DataFrame, able: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Links inside each group of placed (bin, group, node, side); with sides 0 and 1 only those between them."""
    rows = placed.join(able.select("node", "n", "shared"), "node").select("bin", "group", "node", "n", "shared", "side")
    return cut_lineage(dealt(rows, "bin", tasks).applyInArrow(_link(percent), "a long, b long").where("a != b"))


def _neighbourhoods(able: DataFrame) -> DataFrame:
    """(node, neighbourhood) of classes that a run they must be looked up by connects with others."""
    posted = written(able.select("node", "shared", "prefix").mapInArrow(_postings, "token long, a long, b long"))
    tokens = posted.where("token is not null").select("token", "a")
    heads = tokens.groupBy("token").agg(F.min("a").alias("b"), F.max("a").alias("last")).where("b != last").select("token", "b")
    links = tokens.join(heads, "token").select("a", "b").where("a != b").distinct()
    return components(posted.where("token is null").select("a", "b").unionByName(links)).withColumnRenamed("component", "neighbourhood")


def _links(able: DataFrame, percent: int, chunk_tokens: int) -> list[DataFrame]:
    """Links (a, b) between classes that connect all that are connected."""
    weight = (F.octet_length("shared") / 8).alias("w")
    near = cut_lineage(able.select("node", weight).join(_neighbourhoods(able), "node"))
    sizes = near.groupBy("neighbourhood").agg(F.ceil(F.sum("w") / chunk_tokens).alias("chunks"))
    near = cut_lineage(near.join(sizes, "neighbourhood").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks")))
    total, most = near.agg(F.sum("w"), F.max("chunks")).first()
    tasks = blocks_for(total or 0, 4 * chunk_tokens, default_tasks(able.sparkSession))
    # Chunk 0 holds the pivots; it goes with each other chunk.
    beside = F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("long"))).when(F.col("chunk") == 0, F.sequence(F.lit(1).cast("long"), F.col("chunks") - 1)).otherwise(F.array("chunk"))
    group = F.when(F.col("chunks") == 1, F.col("neighbourhood")).otherwise(F.xxhash64("neighbourhood", "beside"))
    bin_ = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("neighbourhood"), F.lit(4 * tasks))).otherwise(F.col("group"))
    first = near.withColumn("beside", F.explode(beside)).withColumn("group", group).select("node", "group", bin_.alias("bin"), F.lit(-1).alias("side"))
    links = _linked(first, able, percent, tasks)
    if (most or 0) <= 2:
        return [links]
    large = near.where("chunks > 2")
    found = components(links.join(large.select(F.col("node").alias("a")), "a"))
    large = cut_lineage(large.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    heaviest = large.groupBy("neighbourhood", "component").agg(F.sum("w").alias("w")).groupBy("neighbourhood").agg(F.max_by("component", F.struct("w", "component")).alias("heaviest"))
    large = large.where("chunk > 0").join(heaviest, "neighbourhood")
    left = large.where("component != heaviest")
    parts = left.groupBy("neighbourhood").agg(F.ceil(F.sum("w") / chunk_tokens).alias("parts"))
    group = F.xxhash64("neighbourhood", F.lit("left"), "part", "beside")
    one = left.join(parts, "neighbourhood").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), "parts")).withColumn("beside", F.explode(F.sequence(F.lit(1).cast("long"), F.col("chunks") - 1)))
    other = large.join(parts, "neighbourhood").withColumn("beside", F.col("chunk")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    both = [x.select("node", group.alias("group"), group.alias("bin"), F.lit(k).alias("side")) for k, x in ((1, one), (0, other))]
    return [links, _linked(both[0].unionByName(both[1]), able, percent, tasks)]


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links between the classes of rows that share an id; None if no id has several."""
    some = rows.where("n > 0 and doc_id is not null")
    several = some.groupBy("doc_id").agg(F.min(F.struct("a", "b")).alias("x"), F.max(F.struct("a", "b")).alias("y")).where("x != y").select("doc_id")
    several = cut_lineage(several)
    if several.isEmpty():
        return None
    held = some.join(several, "doc_id").select("doc_id", "a", "b").distinct().join(classes.select("a", "b", "node"), ["a", "b"]).select("doc_id", F.col("node").alias("a"))
    return held.join(held.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b").where("a != b")


def jaccard_groups(docs: DataFrame, *, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = 100_000) -> DataFrame:
    """Groups of documents connected by links; two link when their sets' Jaccard similarity is percent / 100 or more.

    Returns a row per input row: doc_id, n_shingles (distinct runs of size words, A-Z lowered; fewer words
    are one run), component_id (least doc_id connected with it, itself included).

    Null or empty text, or text without words, has an empty set and links with nothing. A row without
    id takes part; its component_id is null only if no row with an id is connected. Rows that share an id
    are one node, whatever their texts, so their links are united. Equal sets are one class before anything is
    compared, so copies are never paired. A neighbourhood larger than chunk_tokens is compared in chunks, each task
    holding two; no pair of sets that are not connected yet goes uncompared. An empty table gives no rows.
    """
    rows = _rows_of(docs, id_col, text_col, size, percent)
    classes = _classes(rows)
    found = _grouped(rows, classes, [*_links(classes.where("shared is not null"), percent, chunk_tokens), _same_id(rows, classes)])
    return found.select("doc_id", "n_shingles", "component_id")


def jaccard_rows(docs: DataFrame, *, size: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", chunk_tokens: int = 100_000) -> DataFrame:
    """The same by row: rows of one id are connected by their texts only. Adds row_key, of id and text, and component, a
    number that the rows of a group share (null for an empty set)."""
    rows = _rows_of(docs, id_col, text_col, size, percent)
    classes = _classes(rows)
    return _grouped(rows, classes, _links(classes.where("shared is not null"), percent, chunk_tokens))


def _rows_of(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    return cut_lineage(shared_sets(id_and_text(docs, id_col, text_col), size, percent))


def _classes(rows: DataFrame) -> DataFrame:
    """A row per different set that is not empty; their numbers are fixed from the checkpoint on."""
    classes = rows.where("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("doc_id"), F.first("shared").alias("shared"), F.first("prefix").alias("prefix"))
    return cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))


def _grouped(rows: DataFrame, classes: DataFrame, links: list[DataFrame | None]) -> DataFrame:
    """Rows with their component and its least doc_id."""
    joined = components(_union([x for x in links if x is not None]))
    joined = cut_lineage(joined.join(classes.select("node", "doc_id"), "node"))
    least = joined.groupBy("component").agg(F.min("doc_id").alias("least"))
    joined = joined.join(least, "component").select("node", "component", "least")
    marked = classes.select("a", "b", "node", "doc_id").join(joined, "node", "left")
    marked = marked.select("a", "b", F.coalesce("component", "node").alias("component"), F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("least"))
    out = rows.drop("shared", "prefix").join(marked, ["a", "b"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), "row_key", "component")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op10: groups among all documents."""
    from .tables import table

    return jaccard_groups(table(spark, sf_dir, "documents"))
