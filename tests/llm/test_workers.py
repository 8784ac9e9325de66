"""What Python workers keep, and what they need for a text."""

from __future__ import annotations

import gc
import random
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa

from pulsegrid.llm import jaccard_join, packing, token_counts, workers

ODD = [None, "", " ", "\n", " \n\t ", "a\n\n b  ", "Ünï ﬁ code　x  Y", "<|endoftext|> a \n\nb", "x" * 3000, " \n'll don't  \n\n é中文\x00 \x00", "é" * 70 + " ab\n"]


def test_another_operator_lets_go_of_the_encoder():
    encoder = weakref.ref(packing.public_encoder())
    assert packing.public_encoder() is encoder()
    jaccard_join._share(pa.table({"block": pa.array([], pa.int64()), "head": pa.array([], pa.binary())}))
    gc.collect()
    assert encoder() is None


def test_one_thing_is_held_by_key():
    first = workers.held("x", 1, lambda: [1])
    assert workers.held("x", 1, list) is first
    assert workers.held("x", 2, lambda: [2]) == [2]
    assert workers.held("x", 1, list) == []


def test_the_encoder_remembers_no_text():
    encoder = packing.public_encoder()
    words = [f"{k:x} {k * k:x}zq" for k in range(20_000)]
    encoder.encode(words[0])
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    for w in words:
        encoder.encode(w)
    kept = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert kept < 200_000


def test_ids_are_the_tokenizer_files():
    encoder = packing.public_encoder()
    for text in ODD:
        want = encoder.whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert [packing.odd(t) for t in ODD if t] == [bool(packing._ODD.search(t)) for t in ODD if t]


def test_tokens_of_many_pre_tokens_are_those_of_each():
    rng = random.Random(5)
    pieces = {bytes([b]): -5.0 for b in range(256)} | {bytes(rng.choices(b"ab\x00", k=n)): rng.choice([-1.0, -2.0, -4.0, -6.0]) for n in (2, 3, 4, 7, 90) for _ in range(12)}
    trie = token_counts.PieceTrie(pieces)
    words = [bytes(rng.choices(b"ab\x00c", k=rng.choice([0, 1, 2, 5, 30, 64, 65, 200]))) for _ in range(600)]
    assert trie.tokens_of(words).tolist() == [trie.tokens(w) for w in words]
    assert trie.tokens_of([]).tolist() == []


def test_counts_of_many_texts_score_their_new_pre_tokens_together(monkeypatch):
    counter = token_counts.public_counts()
    texts = [*ODD, *[f"{k:x} {k * k:x}zq, a-{k} It's\n\n x" for k in range(500)], *ODD]
    want = [(len(p), sum(counter.trie.tokens(x.encode()) for x in p)) for p in (counter.split(t or "") for t in texts)]
    for remember in (200_000, 50):
        counter.known, counter.older, counter.remember = {}, {}, remember
        scored = []
        monkeypatch.setattr(counter.trie, "tokens", lambda p: scored.append(p) or token_counts.PieceTrie.tokens(counter.trie, p))
        pre, tokens = counter.count_all(texts)
        monkeypatch.undo()
        assert list(zip(pre.tolist(), tokens.tolist(), strict=True)) == want
        assert all(len(p) > 64 for p in scored)  # all others by the levels of one trie
        assert len(counter.known) <= remember or not counter.older
    workers.begin("")
