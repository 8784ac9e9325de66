"""Removal of repeated passages: seeds from winnowed anchors, extended both ways.

1. Seed. Every window of `length` words has one anchor, the least hash among its runs of `seed` words.
   Equal windows have equal anchors. Documents meet at anchors that occur more than once.
2. Extend. Each such anchor is extended both ways to all windows it is the anchor of; their 120-bit hashes
   tell where an earlier place reads on the same. Windows with an earlier equal one lie in a repeat.
3. Windows that touch or overlap merge into maximal repeats, and their words are removed.

Places are compared as groups of equal windows, never as pairs. What moves between tasks is packed by blocks of
documents, and a block sends an anchor or window once however often it has it, so a passage in very many
documents puts at most one entry for each block into the task that owns it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import Block, bucket_bounds, mix, pack, pack_sorted, rolling, slices, unpack, unpack_sorted, words_of
from .tables import blocks_for, dealt, default_tasks, id_and_text, steady, with_carried
from .workers import begin

_LAST = np.iinfo(np.int64).max
_SENT = "bucket int, block long, tokens binary, checks binary, docs binary, places binary, ids binary, keys binary"
_BACK = "block long, docs binary, places binary, keys binary"
_SENT_KINDS = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
_BACK_KINDS = [pa.int64(), *[pa.binary()] * 3]


def anchors(block: Block, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of windows, place of each one's anchor, hash of the run at each place); places count through the block."""
    n = len(block.words)
    runs = mix(rolling(block.words, seed, 0x9E3779B97F4A7C15)) >> np.uint64(8)
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), runs
    width = length - seed + 1
    best, span = np.arange(len(runs)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        best = np.where(runs[left] <= runs[right], left, right)
        span += step
    starts = np.arange(len(best))
    inside = starts + length <= block.ends[block.doc[starts]]
    return starts[inside], best[inside], runs


def _rows(rows: list[tuple], kinds: list, schema: str) -> pa.RecordBatch:
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _keys(part: pa.RecordBatch) -> bytes:
    return pack(np.stack([np.asarray(part["k1"]), np.asarray(part["k2"])], 1).ravel())


def _seed(length: int, seed: int, buckets: int):
    """Sends each distinct anchor of a block to the task that owns its hash.

    Anchors that a block has several times are known to repeat; their places go straight back with the keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("repeated passages")
        bounds = bucket_bounds(buckets)
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, 500):
            block = Block(part["text"], False)
            _, at, hashes = anchors(block, length, seed)
            if len(at):
                at = np.unique(at)
                order = np.argsort(hashes[at])
                at, tokens = at[order], hashes[at[order]]
                doc = block.doc[at]
                place = (at - block.starts[doc]).astype("<u4")
                new = _first(tokens)
                often = np.bincount(new.cumsum() - 1)[new.cumsum() - 1] > 1
                rows = []
                for several, some in ((False, ~often), (True, often & new)):
                    t, d, p = tokens[some], doc[some], place[some]
                    cuts = [0, *np.searchsorted(t, bounds).tolist(), len(t)]
                    rows += [(k, number, pack_sorted(t[x:y]), None, None if several else pack(d[x:y].astype("<u2")), None if several else pack(p[x:y]), None, None) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
                rows.append((number % buckets, number, None, None, pack(doc[often].astype("<u2")), pack(place[often]), None, _keys(part)))
                yield _rows(rows, _SENT_KINDS, _SENT)
            number += 1

    return run


def _first(*values: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before, in any of the sorted columns."""
    new = np.ones(len(values[0]), bool)
    new[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
    return new


def _read(table: pa.Table):
    """Header rows to pass on, and the packed rows of a bucket."""
    rows = table.to_pylist()
    return [(x["block"], x["docs"], x["places"], x["keys"]) for x in rows if x["keys"] is not None], [x for x in rows if x["tokens"] is not None]


def _meet(table: pa.Table) -> pa.Table:
    """Anchors that also occur elsewhere go back to their blocks."""
    rows, sent = _read(table)
    if sent:
        parts = [unpack_sorted(x["tokens"]) for x in sent]
        weight = np.concatenate([np.full(len(t), 2 if x["docs"] is None else 1) for x, t in zip(sent, parts, strict=True)])
        _, place = np.unique(np.concatenate(parts), return_inverse=True)
        several = np.bincount(place, weight)[place] > 1
        at = 0
        for x, part in zip(sent, parts, strict=True):
            keep = several[at : at + len(part)]
            at += len(part)
            if x["docs"] is not None and keep.any():
                rows.append((x["block"], pack(unpack(x["docs"], "<u2")[keep]), pack(unpack(x["places"], "<u4")[keep]), None))
    return pa.Table.from_batches([_rows(rows, _BACK_KINDS, _BACK)])


def _to_documents(table: pa.Table) -> pa.Table:
    """A row per document of a block that has marked places: its key and these places, ascending."""
    keys = [x for x in table["keys"].to_pylist() if x is not None]
    sent = [x for x in zip(table["docs"].to_pylist(), table["places"].to_pylist(), strict=True) if x[0] is not None]
    k1, k2, places = [], [], []
    if keys and sent:
        pairs = unpack(keys[0], "<i8").reshape(-1, 2)
        doc = np.concatenate([unpack(d, "<u2") for d, _ in sent]).astype(np.int64)
        place = np.concatenate([unpack(p, "<u4") for _, p in sent])
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for d, some in zip(np.unique(doc).tolist(), np.split(place, cuts) if len(doc) else [], strict=True):
            k1.append(int(pairs[d, 0]))
            k2.append(int(pairs[d, 1]))
            places.append(some.astype("<u4").tobytes())
    return pa.table([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(places, pa.binary())], names=["k1", "k2", "places"])


def _extend(length: int, seed: int, buckets: int):
    """Sends the windows around repeated anchors to the tasks that own their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = bucket_bounds(buckets)
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, 500):
            block = Block(part["text"], False)
            marked = np.zeros(len(block.words), bool)
            for begin, seeds in zip(block.starts.tolist(), part["places"].to_pylist(), strict=True):
                marked[begin + np.frombuffer(seeds, "<u4").astype(np.int64)] = True
            starts, anchor, _ = anchors(block, length, seed)
            starts = starts[marked[anchor]]
            first = mix(rolling(block.words, length, 0x9E3779B97F4A7C15))[starts] >> np.uint64(8) if len(starts) else np.empty(0, np.uint64)
            check = mix(rolling(block.words, length, 0xC2B2AE3D27D4EB4F))[starts] if len(starts) else np.empty(0, np.uint64)
            if len(starts):
                doc = block.doc[starts]
                place = (starts - block.starts[doc]).astype("<u4")
                ids = np.asarray(pa.compute.fill_null(part["doc_id"], _LAST)).astype("<i8")[doc]
                order = np.lexsort((place, ids, check, first))
                first, check, doc, place, ids = first[order], check[order], doc[order].astype("<u2"), place[order], ids[order]
                late = _not_least(_first(first, check), ids, place)
                some = ~late
                columns = [c[some] for c in (first, check, doc, place, ids)]
                cuts = [0, *np.searchsorted(columns[0], bounds).tolist(), len(columns[0])]
                rows = [(k, number, pack_sorted(columns[0][x:y]), *[pack(c[x:y]) for c in columns[1:]], None) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
                rows.append((number % buckets, number, None, None, pack(doc[late]), pack(place[late]), None, _keys(part)))
                yield _rows(rows, _SENT_KINDS, _SENT)
            number += 1

    return run


def _not_least(new: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows of sorted groups, begun where new, that differ in (id, place) from their group's first."""
    least = np.flatnonzero(new)[new.cumsum() - 1]
    return (ids != ids[least]) | (place != place[least])


def _earlier(table: pa.Table) -> pa.Table:
    """Windows that an earlier place (smaller id, or same id and earlier start) also has go back to their blocks."""
    rows, sent = _read(table)
    if sent:
        docs, places = [unpack(x["docs"], "<u2") for x in sent], [unpack(x["places"], "<u4") for x in sent]
        tokens, checks = np.concatenate([unpack_sorted(x["tokens"]) for x in sent]), np.concatenate([unpack(x["checks"], "<u8") for x in sent])
        ids, place = np.concatenate([unpack(x["ids"], "<i8") for x in sent]), np.concatenate(places)
        order = np.lexsort((place, ids, checks, tokens))
        later = np.empty(len(order), bool)
        later[order] = _not_least(_first(tokens[order], checks[order]), ids[order], place[order])
        at = 0
        for x, d, p in zip(sent, docs, places, strict=True):
            keep = later[at : at + len(d)]
            at += len(d)
            if keep.any():
                rows.append((x["block"], pack(d[keep]), pack(p[keep]), None))
    return pa.Table.from_batches([_rows(rows, _BACK_KINDS, _BACK)])


def repeats(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal word ranges [start, end) that windows with these ascending starts cover."""
    if not len(starts):
        return []
    gaps = np.flatnonzero(np.diff(starts) > length)
    begins = starts[np.r_[0, gaps + 1]]
    ends = starts[np.r_[gaps, len(starts) - 1]] + length
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


_CUT = "doc_id long, n_words long, n_removed long, kept string, repeats array<array<long>>"


def _cut(length: int, as_is: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1000):
            n_words, n_removed, kept, spans = [], [], [], []
            for text, places in zip(part["text"].to_pylist(), part["places"].to_pylist(), strict=True):
                words = words_of(text, False)
                found = repeats(np.frombuffer(places, "<u4").astype(np.int64), length) if places else []
                n_words.append(len(words))
                n_removed.append(sum(e - s for s, e in found))
                for s, e in reversed(found):
                    del words[s:e]
                kept.append(text if as_is and not found else b" ".join(words).decode())
                spans.append([list(x) for x in found])
            extra = ["carried"] * ("carried" in part.schema.names)
            columns = [part["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*columns, *[part[c] for c in extra]], ["doc_id", "n_words", "n_removed", "kept", "repeats", *extra])

    return run


def dedup_substrings(docs: DataFrame, *, length: int = 20, seed: int = 8, id_col: str = "doc_id", text_col: str = "text", as_is: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Removes words covered by a window of length words that also starts earlier.

    Earlier means a smaller doc_id, or the same doc_id and an earlier start; windows are judged on the input.
    Returns a row per input row: doc_id, n_words, n_removed, kept (the words left, joined by one space; with as_is
    the text itself where nothing was removed), repeats (maximal removed word ranges [start, end)), and a
    struct of columns to carry if asked.

    Null text has no words; texts shorter than a window lose nothing. Rows without id count as one document
    after all others. Rows equal in id and text do not remove each other. An empty table gives no rows.
    Order and partitions of the rows do not matter. The text is shuffled once; both joins reuse that exchange.
    """
    rows = steady(id_and_text(docs, id_col, text_col, carry)).select("*", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("k2"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    least = default_tasks(docs.sparkSession)
    seeding, extending = blocks_for(chars, 64_000_000, least), blocks_for(chars, 24_000_000, least)
    by_document = "k1 long, k2 long, places binary"
    rows_dealt = rows.repartition(extending, "k1", "k2")
    sent = rows.select("text", "k1", "k2").mapInArrow(_seed(length, seed, seeding), _SENT)
    met = dealt(sent, "bucket", seeding).applyInArrow(_meet, _BACK)
    seeds = dealt(met, "block", seeding).applyInArrow(_to_documents, by_document).dropDuplicates(["k1", "k2"])
    # Blocks are counted through the rows of a task. A merge join hands them out by key, rows with equal keys are equal, so
    # a task that runs again makes the same blocks and its answers fit those of the first run.
    met_rows = rows_dealt.join(seeds.hint("merge"), ["k1", "k2"]).sortWithinPartitions("k1", "k2")
    windows = met_rows.mapInArrow(_extend(length, seed, extending), _SENT)
    later = dealt(windows, "bucket", extending).applyInArrow(_earlier, _BACK)
    covered = dealt(later, "block", extending).applyInArrow(_to_documents, by_document).dropDuplicates(["k1", "k2"])
    judged = rows_dealt.join(covered.hint("merge"), ["k1", "k2"], "left").drop("k1", "k2")
    return judged.mapInArrow(_cut(length, as_is), with_carried(_CUT, rows))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all documents, with a digest of the words kept."""
    from .tables import table

    return dedup_substrings(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The same result in DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, md5(array_to_string(w[k : k + 19], ' ')) AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS k FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + 19)) AS p FROM later),
lost AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t
         FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost ON d.doc_id = lost.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
