"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols are words instead of characters. Every pattern of a group has the same number m
of words, a block is two neighbouring words (one if m is 1). The shift table gives for a
block how far the search may move on, the suffix table gives for a block that ends patterns
the patterns to test, told apart by their first block, and each is then compared word by word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import blocks_for, cut_lineage, id_and_text, with_carried
from .workers import held

#: Bytes as the contract's word class sees them: A-Z lowered, other ASCII but a-z and 0-9 separate, the rest kept.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

Words = list[bytes]


def fold_words(text: str | None) -> Words:
    """Words of a text; none for null."""
    return text.encode().translate(_FOLD).split() if text else []


def windows(words: Words, size: int) -> Iterator[tuple[bytes, ...]]:
    """All runs of size words; the whole text if it is shorter, nothing if it has no word."""
    if 0 < len(words) <= size:
        yield tuple(words)
    else:
        for k in range(len(words) - size + 1):
            yield tuple(words[k : k + size])


class WuManber:
    """Search for patterns that all have the same number of words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.m = m = len(next(iter(patterns)))
        self.block = 2 if m > 1 else 1
        self.far = m - self.block + 1
        self.shift: dict = {}
        self.suffix: dict = defaultdict(lambda: defaultdict(list))
        for pattern, items in patterns.items():
            for end in range(self.block - 1, m):
                block = self._block(pattern, end)
                self.shift[block] = min(self.shift.get(block, self.far), m - 1 - end)
            self.suffix[self._block(pattern, m - 1)][self._block(pattern, self.block - 1)].append((list(pattern), items))
        self.suffix = {k: dict(v) for k, v in self.suffix.items()}

    def _block(self, words, end: int):
        return (words[end - 1], words[end]) if self.block == 2 else words[end]

    def search(self, words: Words) -> Iterator[tuple[int, list[str]]]:
        """Start of each occurrence, and the items whose window it is."""
        m, far, n = self.m, self.far, len(words)
        move, pair = self.shift.get, self.block == 2
        end = m - 1
        while end < n:
            block = (words[end - 1], words[end]) if pair else words[end]
            skip = move(block, far)
            if skip:
                end += skip
                continue
            start = end - m + 1
            for pattern, items in self.suffix[block].get((words[start], words[start + 1]) if pair else words[start], ()):
                if words[start : end + 1] == pattern:
                    yield start, items
            end += 1


def matchers(found: Iterable[tuple[bytes, str | None]]) -> list[WuManber]:
    """One search for each number of words that windows (words joined by blanks, item) have; nearly all have the full size."""
    by_length: dict[int, dict[tuple[bytes, ...], list]] = defaultdict(lambda: defaultdict(list))
    for window, item in found:
        words = tuple(window.split(b" "))
        by_length[len(words)][words].append(item)
    return [WuManber(p) for _, p in sorted(by_length.items())]


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(words, item) of all items' windows, each once; equal items are one. Stays in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                part = whole.slice(at, 200)
                found = list({(b" ".join(w), item): None for item, text in zip(part["item"].to_pylist(), part["text"].to_pylist(), strict=True) for w in windows(fold_words(text), size)})
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()), pa.array([i for _, i in found], pa.string())], ["words", "item"])

    return cut_lineage(items.mapInArrow(run, "words binary, item string").distinct())


def scan(words: Words, searches: list[WuManber]) -> tuple[list[list[int]], set[str]]:
    """Merged word spans [start, end) that occurrences cover, and the items found."""
    found = sorted((start, start + s.m, items) for s in searches for start, items in s.search(words))
    spans: list[list[int]] = []
    hit: set[str] = set()
    for start, end, items in found:
        hit.update(items)
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return spans, hit


_SPANS = pa.list_(pa.list_(pa.int64()))
_SCHEMA = "doc_id long, text string, n_words long, spans array<array<long>>, item_ids array<string>"


def benchmark_spans(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = 100_000, keep_text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Where windows of benchmark items occur in documents.

    Returns a row per input row: doc_id, n_words, n_hit (words inside any occurrence), spans
    (merged word ranges [start, end)), item_ids (distinct, sorted as strings), and text or a struct of columns to carry if asked.

    Null or empty text has no words, spans or items. An item without words matches nothing; an
    item without an id counts as hit but is not listed. Repeated documents or items each count as
    they are; an empty benchmark leaves everything clean. Documents are never shuffled. The items' windows are dealt by
    hash into blocks of about block_windows, so a long item is spread too, and one block is broadcast at a time: with more
    windows the documents are scanned once for each block, each pass cut off by a checkpoint.
    """
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    found = item_windows(items, window)
    n_blocks = blocks_for(found.count(), block_windows)
    context = docs.sparkSession.sparkContext
    rows = id_and_text(docs, id_col, text_col, carry)
    schema = with_carried(_SCHEMA, rows)
    out = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<long>>").alias("spans"), F.array().cast("array<string>").alias("item_ids"))
    for k in range(n_blocks):
        part = found if n_blocks == 1 else found.where(F.pmod(F.xxhash64("words"), F.lit(n_blocks)) == k)
        patterns = context.broadcast([(bytes(r.words), r.item) for r in part.collect()])  # about block_windows
        out = out.mapInArrow(_pass(patterns, keep_text or k + 1 < n_blocks), schema)
        if n_blocks > 1:
            out = cut_lineage(out)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return out.select("doc_id", *["text"] * keep_text, "n_words", n_hit.alias("n_hit"), "spans", "item_ids", *["carried"] * bool(carry))


def _pass(patterns, keep_text: bool):
    key = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = held("benchmark passages", key, lambda: matchers(patterns.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                counts, spans, items = [], [], []
                for text, before, known in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), batch["item_ids"].to_pylist(), strict=True):
                    words = fold_words(text)
                    new, hit = scan(words, searches)
                    counts.append(len(words))
                    spans.append(_merged(before + new) if before else new)
                    items.append(sorted({*known, *(x for x in hit if x is not None)}))
                text = batch["text"] if keep_text else pa.nulls(batch.num_rows, pa.string())
                extra = ["carried"] * ("carried" in batch.schema.names)
                columns = [batch["doc_id"], text, pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string())), *[batch[c] for c in extra]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_words", "spans", "item_ids", *extra])

    return run


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document against every benchmark item, with digests of the items found."""
    from .tables import table

    found = benchmark_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: The same result in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[k : k + m - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT r, m, k, array_to_string(w[k : k + m - 1], ' ') AS g
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS k FROM d, ms WHERE len(w) >= m)),
occ AS (SELECT r, k, bw.m AS m, item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.g = bw.g),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(k, k + m - 1)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM occ WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""
