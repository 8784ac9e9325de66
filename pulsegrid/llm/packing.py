"""Packing of tokenized documents into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows. What is left over is placed,
longest first, into the open window with the least room that still takes it; a segment tree
over the amounts of room finds that window. Each task packs what it reads, buffer by
buffer, so nothing is shuffled; windows that a buffer leaves open are packed again with the next.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import slices
from .tables import id_and_text
from .workers import held

#: A run of blanks and newlines with the run of other characters after it: no pre-token crosses its ends.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Other white space, where pre-tokens can depend on more than one chunk, and the vocabulary's special token.
_SPACES = [9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
_ODD = re.compile(f"[{''.join(map(chr, _SPACES))}]|<[|]endoftext[|]>")


_ODD_ASCII = re.compile("[\t\x0b-\r\x1c-\x1f]")


def odd(text: str) -> bool:
    """Whether a text has unusual white space or the special token's string."""
    return bool(_ODD_ASCII.search(text)) or "<|endoftext|>" in text if text.isascii() else bool(_ODD.search(text))


class Encoder:
    """Ids of whole texts for a byte-level BPE vocabulary, as its tokenizer file gives them.

    Nothing is remembered from text to text. Texts with unusual white space or the special token's string go through
    the tokenizer file itself, which is read when the first of them comes.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.vocabulary = vocabulary

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.vocabulary)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; none for null."""
        if not text:
            return b""
        ids = self.whole.encode(text, add_special_tokens=False).ids if odd(text) else self.bpe.encode_ordinary(text)
        return np.asarray(array("I", ids)).astype("<u4", copy=False).tobytes()


def public_encoder(vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken") -> Encoder:
    """One encoder for each worker process, as long as it packs."""
    import public_tokenizers

    path = public_tokenizers.path
    return held("packing", (vocabulary, ranks), lambda: Encoder(path(vocabulary), path(ranks), public_tokenizers.PATTERN))


class RoomTree:
    """Segment tree over the amounts of room 0..size; a leaf holds the open windows with that much."""

    def __init__(self, size: int):
        self.base = 1
        while self.base < size + 1:
            self.base *= 2
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        at = self.base + room
        while at:
            self.count[at] += 1
            at >>= 1

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out and returns (room, window) with the least room of at least need."""
        count, at = self.count, self.base + need
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.base
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


@dataclass
class Piece:
    """A run of ids of one document."""

    doc: int | None
    start: int
    total: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4


def cut(doc: int | None, ids: bytes, window: int) -> Iterator[Piece]:
    """Full windows first, then what is left."""
    for at in range(0, len(ids), 4 * window):
        yield Piece(doc, at // 4, len(ids) // 4, ids[at : at + 4 * window])


def best_fit_decreasing(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Windows as lists of pieces; ties go by document and place, so row order does not matter."""
    tree, filled = RoomTree(window), []
    for p in sorted(pieces, key=lambda p: (-len(p), p.doc is None, p.doc or 0, p.start, p.ids)):
        if len(p) == window:
            filled.append([p])
        elif found := tree.tightest(len(p)):
            filled[found[1]].append(p)
            tree.add(found[0] - len(p), found[1])
        else:
            filled.append([p])
            tree.add(window - len(p), len(filled) - 1)
    return filled


_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, *, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", buffer_tokens: int = 4_000_000, encoder=public_encoder) -> DataFrame:
    """Packs documents into sequences of at most window tokens.

    Returns a row per piece: doc_id, start (ids of its document before it), length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset (place in the sequence, gapless from 0).

    A document's ids end with end_id; null or empty text is that id alone. Null ids and repeated
    rows are packed as they are, each row for itself. No row is shuffled: a task packs its own
    rows in buffers of buffer_tokens ids (bounded memory), and a sequence never spans tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(), np.array([end_id], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 32
        waiting: list[Piece] = []
        tokens = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, tokens, sequence
            rows: list[tuple] = []
            filled, waiting, tokens, size = best_fit_decreasing(waiting, window), [], 0, 0
            fills = [sum(map(len, pieces)) for pieces in filled]
            enough = window - window // 64
            if sum(f for f in fills if f < enough) > buffer_tokens // 2:  # these would not fit better next time
                last = True
            for pieces, fill in zip(filled, fills, strict=True):
                if not last and fill < enough:
                    waiting += pieces
                    tokens += fill
                    continue
                at = 0
                for p in pieces:
                    rows.append((p.doc, p.start, len(p), p.ids, p.total, sequence, at))
                    at += len(p)
                sequence += 1
                size += fill
                if size > 1_000_000:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

        for part in slices(batches, 500, 1_000_000):
            for doc, ids in zip(part["doc_id"].to_pylist(), map(coder.encode, part["text"].to_pylist()), strict=True):
                for p in cut(doc, ids + end, window):
                    waiting.append(p)
                    tokens += len(p)
                    if tokens >= buffer_tokens:
                        yield from emit(False)
        yield from emit(True)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def query(spark, sf_dir: str) -> DataFrame:
    """op4: all documents, with a digest of each piece's ids in place of the ids."""
    from .tables import table

    return pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
