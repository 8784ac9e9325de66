"""Each operator against a brute-force version, on awkward rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import components, decontaminate, fingerprint, hashing, jaccard_join, language_id, lm_score, packing, quality_rules, sharding, substring_dedup, token_counts

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SCHEMA = "doc_id long, text string, n_words string, shard string, block string, carried string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["ab", "cde", "f", "ghi", "jk", "lmno"]) + str(rng.randrange(40)) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls, empty and blank texts, ties, repeated rows, near copies, a long text, odd white space, a row without id."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [base, base, " ".join(near), None, "", " \n\t ", "one", "one", "two words", prose(2, 30) + " " + prose(1, 60), prose(3, 8000), "Ünï ﬁ code　x  Y", "<|endoftext|> a \n\nb", prose(2, 30) * 2]
    rows = [(10 * k, t, "x", "y", "z", "w") for k, t in enumerate(texts)]
    return [*rows, rows[0], (None, base, None, None, None, None), (None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(awkward(), SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=repr)


# Token counts


def best_count(word: bytes, scores: dict[bytes, float]) -> tuple[float, int]:
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[a][0] + scores[word[a:end]], best[a][1] + 1) for a in range(end) if word[a:end] in scores]
        top = max(s for s, _ in options)
        best.append((top, min(c for s, c in options if s > top - 1e-9)))
    return best[-1]


def test_trie_equals_direct_search():
    rng = random.Random(3)
    pieces = {bytes([b]): -5 - rng.random() for b in range(256)} | {bytes(rng.choices(b"abc", k=rng.randrange(2, 5))): -3 - 4 * rng.random() for _ in range(40)}
    trie = token_counts.PieceTrie(pieces, room=50)
    for _ in range(300):
        word = bytes(rng.choices(b"abcd", k=rng.randrange(0, 12)))
        score, count = best_count(word, pieces)
        assert trie.tokens(word) == count
        assert abs(trie.score(word) - score) < 1e-6


def test_token_counts(docs, nothing):
    import public_tokenizers
    import regex

    counter = token_counts.public_counts()
    split = regex.compile(public_tokenizers.PATTERN).findall
    expected = [(i, len(split(t or "")), sum(counter.trie.tokens(p.encode()) for p in split(t or ""))) for i, t, *_ in awkward()]
    assert by_id(token_counts.count_tokens(docs), "n_pre_tokens", "n_tokens") == sorted(expected, key=repr)
    assert token_counts.count_tokens(nothing).count() == 0


# Language-model scoring


def hashes(words):
    return hashing.Block([w.decode() for w in words], False).words


def test_scores_rise_with_training():
    texts = ["a b c d e f g h " * 40] * 20 + ["h g f e d c b a " * 40] * 2
    counts = Counter(w for t in texts for w in t.encode().split())
    words = sorted(counts)
    v = lm_score.Vocabulary(hashes(words), np.array([counts[w] for w in words], float), 0.0, buckets=2)
    net = lm_score.Network(v)
    before = lm_score.log_likelihoods(v, net, texts[:1])[1][0]
    assert abs(before - 320 * np.log(1 / 8)) < 1  # shares of the corpus
    ids, context, _ = lm_score.contexts(v, lm_score.hashed(texts))
    for _ in range(5):
        for at in range(0, len(ids), 512):
            net.learn(v.tree, context[at : at + 512], ids[at : at + 512], 0.3)
    n, after = lm_score.log_likelihoods(v, net, [texts[0], None, "", "a"])
    assert after[0] > before * 0.3
    assert n.tolist() == [320, 0, 0, 1]
    assert after[1] == after[2] == 0
    assert np.isfinite(after).all()


def direct_scores(v, net, text):
    """log p of each word of a text, fork by fork, and the sum of probabilities over all leaves at each word."""
    ids = v.ids(hashes((text or "").encode().lower().split())).tolist()
    line = [v.edge, v.edge, *ids, v.edge, v.edge]
    leaves = len(v.words) + v.buckets
    logs, sums = [], []
    for k, leaf in enumerate(ids):
        around = [line[k + 2 + p] for p in lm_score._PLACES]
        hidden = np.tanh(sum(net.parts[f"place {j}"][:, w].astype(float) for j, w in enumerate(around)))

        def log_p(x, hidden=hidden):
            out = 0.0
            for at in range(v.tree.first[x], v.tree.first[x] + v.tree.depth[x]):
                f = v.tree.fork[at]
                z = hidden @ net.parts["forks"][:-1, f] + net.parts["forks"][-1, f]
                out -= np.log1p(np.exp(-z * v.tree.side[at]))
            return out

        logs.append(log_p(leaf))
        sums.append(sum(np.exp(log_p(x)) for x in range(leaves)))
    return logs, sums


def test_word_probabilities_add_up_and_equal_direct_computation():
    rng = np.random.default_rng(2)
    words = [b"a", b"b", b"c", b"dd", b"e"]
    v = lm_score.Vocabulary(hashes(words), np.array([50.0, 30.0, 20.0, 3.0, 1.0]), 4.0, buckets=3, bucket_mass=np.array([2.0, 0.0, 5.0]))
    net = lm_score.Network(v)
    net.parts = {k: x + rng.standard_normal(x.shape).astype(np.float32) * 0.5 for k, x in net.parts.items()}
    for text in ("a b A c unknown dd e other a", "a"):
        logs, sums = direct_scores(v, net, text)
        assert np.allclose(sums, 1, atol=1e-4)
        assert np.allclose(lm_score.log_likelihoods(v, net, [text])[1][0], sum(logs), atol=1e-4)


def test_scores_of_the_query_equal_direct_sums(spark, docs):
    """The network that was trained, and each word's own share of its bucket, recomputed word by word."""
    got, v, net, counted = lm_score.trained_scores(docs, vocabulary=4)
    counts = {r.word % 2**64: r.n for r in counted.collect()}
    expected = []
    for i, t, *_ in awkward():
        if t and len(t) > 5000:
            continue
        logs, _ = direct_scores(v, net, t)
        rare = [h for h in hashes((t or "").encode().translate(hashing._LOWER).split()).tolist() if h not in v.words]
        own = sum(np.log(counts[h] / v.bucket_mass[h % v.buckets]) for h in rare)
        expected.append((i, len(logs), round(sum(logs) + own, 2)))
    found = [(r.doc_id, r.n_words, r.log_likelihood) for r in got.collect() if r.n_words < 5000]
    for (i, n, x), (j, m, y) in zip(sorted(expected, key=repr), sorted(found, key=repr), strict=True):
        assert (i, n) == (j, m) and abs(x - y) < 0.05


def test_lm_scoring(docs, nothing):
    got = lm_score.score_documents(docs, vocabulary=64).collect()
    words = {(i, len((t or "").encode().split())) for i, t, *_ in awkward()}
    assert {(r.doc_id, r.n_words) for r in got} == words
    assert len(got) == len(awkward())
    assert all((r.per_word is None) == (r.n_words == 0) and r.log_likelihood <= 0 for r in got)
    assert lm_score.score_documents(nothing).count() == 0


def test_rare_words_have_their_own_share(spark):
    """With a vocabulary of one word all others share buckets; a word's score still follows its own count."""
    common = [(k, " ".join(["the"] * 50)) for k in range(20)]
    rare = [(100 + k, f"w{k % 30}") for k in range(30)] + [(200 + k, "often") for k in range(90)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string")
    v, counted = lm_score.count_words(docs, 1)
    assert v.words[0] == hashes([b"the"])[0] and counted.count() == 32
    assert abs(v.bucket_mass.sum() + v.counts.sum() - 1120) < 1e-3
    v, _ = lm_score.count_words(docs.where("doc_id >= 100"), 1)
    assert len(v.words) <= lm_score.vocabulary_size(120, 1)
    # Two words of one bucket differ by the ratio of their counts, in the same (empty) context.
    few = spark.createDataFrame([(k, f"x{j}") for j in range(200) for k in range(1 + j % 2)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.score_documents(few.withColumn("doc_id", F.substring("text", 2, 9).cast("long")), vocabulary=1).collect()}
    by_bucket = {}
    for j in range(200):
        by_bucket.setdefault((int(hashes([f"x{j}".encode()])[0]) % 64, j % 2), []).append(got[j].log_likelihood)
    both = [b for b, odd in by_bucket if odd and (b, 0) in by_bucket]
    assert both
    assert all(abs(by_bucket[b, 1][0] - by_bucket[b, 0][0] - np.log(2)) < 1e-4 for b in both)


def small_network(words, texts, buckets=3):
    counts = Counter(w for t in texts for w in t.encode().split())
    v = lm_score.Vocabulary(hashes(words), np.array([counts[w] + 1 for w in words], float), 4.0, buckets=buckets)
    net = lm_score.Network(v)
    rng = np.random.default_rng(4)
    net.parts = {k: x + rng.standard_normal(x.shape).astype(np.float32) * 0.5 for k, x in net.parts.items()}
    return v, net


def test_a_training_step_equals_direct_sums(monkeypatch):
    """Pulls of each word at each fork and place, one by one in Python, whatever the pieces of a batch are."""
    monkeypatch.setattr(lm_score, "_AT_ONCE", 50)
    rng = random.Random(5)
    words = [f"w{k}".encode() for k in range(30)]
    texts = [" ".join(rng.choices([f"w{int(40 * rng.random() ** 2)}" for _ in range(9)], k=rng.randrange(0, 40))) for _ in range(12)]
    v, net = small_network(words, texts)
    ids, context, _ = lm_score.contexts(v, lm_score.hashed(texts))
    assert len(ids) > 120
    moved = {name: np.zeros(x.shape) for name, x in net.parts.items()}
    used = {name: np.zeros(x.shape[1]) for name, x in net.parts.items()}
    for leaf, around in zip(ids.tolist(), context.tolist(), strict=True):
        h = np.append(np.tanh(sum(net.parts[f"place {j}"][:, w].astype(float) for j, w in enumerate(around))), 1.0)
        back = np.zeros(len(h))
        for at in range(v.tree.first[leaf], v.tree.first[leaf] + v.tree.depth[leaf]):
            fork, side = v.tree.fork[at], v.tree.side[at]
            weights = net.parts["forks"][:, fork].astype(float)
            pull = side / (1 + np.exp(side * (h @ weights)))
            moved["forks"][:, fork] += pull * h
            used["forks"][fork] += 1
            back += pull * weights
        for j, w in enumerate(around):
            moved[f"place {j}"][:, w] += (back * (1 - h * h))[:-1]
            used[f"place {j}"][w] += 1
    expected = {k: x + moved[k] * 0.3 / np.sqrt(1e-6 + np.square(moved[k]).sum(0)) for k, x in net.parts.items()}
    net.learn(v.tree, context, ids, 0.3)
    for name, x in expected.items():
        assert np.allclose(net.parts[name], x, atol=1e-4)
        assert (net.used[name] == used[name]).all()


def test_a_training_step_adds_up_a_fork_once_for_neighbours(monkeypatch):
    """Words below a fork lie side by side, so what is scattered over the forks is far less than a value for each word, fork and lane."""
    rng = np.random.default_rng(6)
    words = [f"w{k}".encode() for k in range(400)]
    texts = [" ".join(f"w{int(k)}" for k in 400 * rng.random(3000) ** 3) for _ in range(3)]
    v, net = small_network(words, texts)
    ids, context, _ = lm_score.contexts(v, lm_score.hashed(texts))
    ways, lanes, added = int(v.tree.depth[ids].sum()), len(net.parts["forks"]), []
    plain = np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: (added.append(len(x)), plain(x, *a, **k))[1])
    net.learn(v.tree, context, ids, 0.3)
    assert net.used["forks"].sum() == ways
    places = 4 * lanes * len(ids)
    assert sum(added) - places < 0.5 * ways * lanes


def test_words_are_found_by_the_first_bits_of_their_hashes():
    rng = np.random.default_rng(7)
    top = 2**64 - 1
    for known in ([], [5], [0, top], [top - 2, top - 1, top], [0, 1, 2, 3, 2**63, 2**63 + 1], rng.integers(0, 2**64, 500, np.uint64).tolist()):
        known = np.array(known, np.uint64)
        rng.shuffle(known)
        v = lm_score.Vocabulary(known, np.ones(len(known)), 9.0, buckets=7)
        near = [(int(w) + d) % 2**64 for w in known for d in (-1, 0, 1)]
        asked = np.array([*near, 0, top, 2**62, *rng.integers(0, 2**64, 50, np.uint64).tolist()], np.uint64)
        place = {int(w): k for k, w in enumerate(known)}
        assert v.ids(asked).tolist() == [place.get(int(w), len(known) + int(w) % 7) for w in asked]
        assert v.ids(asked[:0]).tolist() == []


def test_network_grows_with_the_corpus():
    assert lm_score.vocabulary_size(1000, 8192) == 8192
    assert lm_score.vocabulary_size(5_000_000_000, 8192) > 2 * lm_score.vocabulary_size(1_000_000_000, 8192) * 0.99


# Quality


def test_rules_learn_a_bound():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] < 0.4) & (x[:, 1] > 0.3)).astype(float)
    model = quality_rules.RuleModel.fit(x[:1000], y[:1000], ["a", "b", "c"])
    assert ((model.score(x[1000:]) > 0.5) == (y[1000:] > 0.5)).mean() > 0.97
    assert 0 < len(model.rules) < 150


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((300, 2))
    model = quality_rules.RuleModel.fit(x, (x.sum(1) > 1).astype(float), ["a", "b"])
    df = spark.createDataFrame([(int(k), float(a), float(b)) for k, (a, b) in enumerate(x)], "k int, a double, b double")
    got = [r.s for r in df.select("k", model.column().alias("s")).orderBy("k").collect()]
    assert np.allclose(got, model.score(x))


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(10 * k, k % 2, 0) for k in range(14)] + [(None, 1, 0), (0, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_rules.fit_quality(docs, labels)
    got = quality_rules.score_quality(docs, model).collect()
    assert len(got) == len(awkward())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert quality_rules.score_quality(nothing, quality_rules.fit_quality(nothing, labels)).count() == 0
    assert quality_rules.keep_good(docs, model).columns == docs.columns


def test_held_out_rows_by_id(spark):
    from pulsegrid.llm.tables import held_out

    df = spark.range(200).select(F.col("id"), held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in df.collect())


# Packing


def test_tightest_room():
    rng = random.Random(5)
    tree, held = packing.RoomTree(50), []
    for k in range(2000):
        if rng.random() < 0.5 or not held:
            room = rng.randrange(51)
            tree.add(room, k)
            held.append(room)
        else:
            need = rng.randrange(51)
            fit = min((r for r in held if r >= need), default=None)
            found = tree.tightest(need)
            assert (found and found[0]) == fit
            if found:
                held.remove(fit)


@pytest.mark.parametrize("buffer", [4_000_000, 3_000])
def test_packing_round_trip(docs, nothing, buffer):
    from tokenizers import Tokenizer
    import public_tokenizers

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t, *_ in awkward())
    pieces = packing.pack(docs, buffer_tokens=buffer).collect()
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
        parts[p.doc_id, p.doc_tokens, p.start].append(tuple(np.frombuffer(p.ids, "<u4").tolist()))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    for (doc, ids), n in expected.items():
        for start in range(0, len(ids), 2048):
            assert parts[doc, len(ids), start].count(ids[start : start + 2048]) >= n
    assert sum(p.length for p in pieces) == sum(len(ids) * n for (_, ids), n in expected.items())
    assert packing.pack(nothing).count() == 0


# Decontamination


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(text, items, size=10):
    words = WORD.findall((text or "").encode().translate(hashing._LOWER))
    hit, found = set(), set()
    for item, t in items:
        w = WORD.findall((t or "").encode().translate(hashing._LOWER))
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            for at in range(len(words) - m + 1):
                if words[at : at + m] == w[k : k + m]:
                    hit.update(range(at, at + m))
                    found.add(item)
    return len(words), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("block_windows", [100_000, 25])
def test_decontamination(spark, docs, nothing, block_windows):
    items = [(1, prose(1, 15)), (10, "ONE"), (2, "two, words"), (3, None), (4, "..."), (5, prose(2, 12)), (5, prose(3, 11)), (None, prose(3, 25)), (7, "ghi1 ghi1 ghi1")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = [(i, *contaminated(t, items)) for i, t, *_ in awkward()]
    got = decontaminate.benchmark_spans(docs, benchmark, block_windows=block_windows)
    assert by_id(got, "n_words", "n_hit", "item_ids") == sorted(expected, key=repr)
    assert decontaminate.benchmark_spans(nothing, benchmark).count() == 0
    assert decontaminate.benchmark_spans(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_search_finds_every_occurrence():
    rng = random.Random(8)
    for m in (1, 2, 3, 5):
        words = [rng.choice([b"a", b"b"]) for _ in range(300)]
        patterns = {tuple(rng.choice([b"a", b"b"]) for _ in range(m)): [str(k)] for k in range(4)}
        found = Counter((at, x) for at, items in decontaminate.WuManber(patterns).search(words) for x in items)
        assert found == Counter((at, i[0]) for p, i in patterns.items() for at in range(len(words) - m + 1) if tuple(words[at : at + m]) == p)


# Sharding


def check_shards(rows, texts, shards):
    """The whole contract of a sharding, by brute force."""
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts if i is not None)
    assert len(rows) == len(texts)
    loads, of_text = [0] * shards, defaultdict(set)
    for s in range(shards):
        mine = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        loads[s] = sum(r.size for r in mine)
    for r in rows:
        of_text[r.text_crc32, r.size].add(r.shard)
    total = Counter()
    for _, t in texts:
        total[zlib.crc32((t or "").encode()), len((t or "").encode()) + 1] += len((t or "").encode()) + 1
    assert all(len(of_text[k]) == 1 for k, n in total.items() if n <= sum(loads) / shards / 4)
    return loads


def test_sharding_query(spark, tmp_path):
    """All documents of a table, with a hot text that no shard could hold, nulls, empty texts and repeated rows."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10**6 + k, "hot " * 400) for k in range(700)] + [(-1, None), (-2, ""), (None, "no id"), docs[0]]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sharding.query(spark, str(tmp_path)).collect()
    loads = check_shards(rows, docs, 8)
    assert max(loads) - min(loads) <= 0.001 * sum(loads)
    assert {(r.law, r.grown_shard, r.map_version) for r in rows} == {("bytes", None, 2)}
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"hot " * 400)}) == 8


def test_sharding(spark, docs, nothing, tmp_path):
    path = f"{tmp_path}/map"
    placed, used = sharding.shard(docs, shards=4, n_slots=64, map_path=path)
    assert sharding.SlotMap.read(spark, path, used.version) == sharding.SlotMap.latest(spark, path)
    rows = sharding.numbered(placed.withColumn("text_crc32", F.crc32(F.col("text").cast("binary"))), "doc_id", "size").collect()
    check_shards(rows, [(i, t) for i, t, *_ in awkward()], 4)
    again, edited = sharding.shard(docs, shards=4, n_slots=64, map_path=path)
    assert edited.version == used.version + 1 and edited.shard_of == used.shard_of
    assert sharding.shard(nothing)[0].count() == 0


def test_rebalancing_moves_few_slots():
    rng = random.Random(2)
    sizes = {k: rng.randrange(1, 1000) for k in range(1024)}
    first = sharding.SlotMap.initial(8, 1024).rebalanced(sizes)
    loads = first.loads(sizes)
    assert max(loads) - min(loads) <= 0.001 * max(loads)
    sizes[0] += 20_000
    second = first.rebalanced(sizes)
    assert second.version == first.version + 1
    assert sum(a != b for a, b in zip(first.shard_of, second.shard_of, strict=True)) < 120
    grown = second.rebalanced(sizes, 9)
    assert max(grown.loads(sizes)) - min(grown.loads(sizes)) <= 0.01 * max(grown.loads(sizes))


# Fingerprints


def canonical(text):
    import unicodedata

    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return re.sub(r"\s+", " ", folded).strip()


@pytest.mark.parametrize("weak", [False, True])
def test_fingerprints(docs, nothing, weak):
    hash_of = (lambda c: (F.length(c).cast("long") % 2, F.lit(0).cast("long"))) if weak else fingerprint.wide_hash
    got = fingerprint.fingerprint(docs, hash_of=hash_of).collect()
    assert len(got) == len(awkward())
    prints, texts = defaultdict(set), defaultdict(list)
    for i, t, *_ in awkward():
        texts[i].append(canonical(t))
    for r in got:
        if r.doc_id is not None:
            prints[r.fingerprint].update(texts[r.doc_id])
    assert all(len(x) == 1 for x in prints.values())
    assert len(prints) == len({t for i, x in texts.items() if i is not None for t in x})
    assert fingerprint.fingerprint(nothing).count() == 0


@pytest.mark.parametrize("weak", [False, True])
def test_fingerprint_query(spark, tmp_path, weak):
    texts = ["Aa bb cc", "aa  BB cc", "x", "", "aa bb dd", "zzz zzz", "aa bb cc", "Straße ΟΔΟΣ", "STRASSE οδος", "ŉ ﬁ\u3000½", "ʼn fi 1⁄2", None, "aé" * 50]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(2**60, "far away"), (None, "no id")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    hash_of = (lambda c: (F.length(c).cast("long"), F.lit(0).cast("long"))) if weak else fingerprint.wide_hash
    got = {r.doc_id: r for r in fingerprint.query(spark, str(tmp_path), hash_of).collect()}
    order = sorted(((float("-inf") if i is None else i, t or "") for i, t in rows), reverse=True)
    prints = {}
    for (i, t), (j, after) in zip(order, order[1:] + order[:1], strict=True):
        r = got[None if i == float("-inf") else i]
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == float(canonical(t) == canonical(edited))
        assert r.near_next == float(canonical(t) == canonical(after))
        for text, value in ((t, r.fingerprint), (edited, r.edited_fingerprint)):
            assert prints.setdefault(canonical(text), value) == value
    assert len(set(prints.values())) == len(prints)


def test_fingerprint_query_on_repeated_rows_and_nothing(spark, tmp_path):
    schema = "doc_id long, text string, canon string, row_key long"
    for name, rows in (("same", [(5, "one"), (5, "one"), (5, "two"), (5, None)]), ("single", [(1, "ab cd")]), ("empty", [])):
        spark.createDataFrame([(*r, "x", 1) for r in rows], schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = fingerprint.query(spark, f"{tmp_path}/{name}").collect()
        assert len(got) == len(rows)
        assert len({r.fingerprint for r in got}) == len({t or "" for _, t in rows})
    assert name == "empty"


def test_buckets_are_even_however_ids_are_spread(spark):
    """One far id, or no ids at all, do not bring the others into one bucket."""
    ids = spark.range(1000).select(F.col("id").alias("at"), F.xxhash64("id").alias("row_key"))
    far = ids.unionByName(spark.range(1).select(F.lit(2**60).alias("at"), F.lit(1).cast("long").alias("row_key")))
    same = ids.withColumn("at", F.lit(fingerprint._LEAST))
    for rows in (ids, far, same):
        starts = fingerprint.bucket_starts(rows, 7)
        sizes = [r["count"] for r in rows.groupBy(fingerprint.bucket_of(starts).alias("b")).count().collect()]
        assert len(sizes) == 7 and max(sizes) <= 144


# Substring deduplication


def deduplicated(rows, length=20):
    first = {}
    docs = [(float("inf") if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for (i, _), (order, w) in zip(rows, docs, strict=True):
        gone = {p for k in range(len(w) - length + 1) if first[tuple(w[k : k + length])] != (order, k) for p in range(k, k + length)}
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return out


def test_substring_dedup(docs, nothing):
    expected = deduplicated([(i, t) for i, t, *_ in awkward()])
    assert by_id(substring_dedup.dedup_substrings(docs), "n_words", "n_removed", "kept") == sorted(expected, key=repr)
    mixed = docs.orderBy(F.rand(5)).repartition(5)
    assert by_id(substring_dedup.dedup_substrings(mixed), "n_words", "n_removed", "kept") == sorted(expected, key=repr)
    assert substring_dedup.dedup_substrings(nothing).count() == 0


def test_substring_dedup_of_one_word(spark):
    rows = [(1, "a " * 30), (2, "a " * 50), (3, "b " * 19), (4, "b " * 20)]
    expected = deduplicated(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(substring_dedup.dedup_substrings(df), "n_words", "n_removed", "kept") == sorted(expected, key=repr)


def test_rolling_hashes():
    h = np.array([3, 1, 4, 1, 5, 9, 2, 6, 3, 1, 4], np.uint64)
    for size in range(1, 12):
        direct = [sum(int(x) * pow(7, size - 1 - k, 2**64) for k, x in enumerate(h[a : a + size])) % 2**64 for a in range(len(h) - size + 1)]
        assert hashing.rolling(h, size, 7).tolist() == direct
    assert len(hashing.rolling(h, 12, 7)) == 0


def test_words_of_a_block_have_hashes_of_their_own():
    rng = np.random.default_rng(6)
    some = ["", None, " \t ", "a\x00 a", "x" * 64 + " " + "x" * 65 + "\n" + "x" * 63, "é b\x85c\x0bD"]
    some += ["".join(rng.choice(list("abB \n\x0b\x00é"), rng.integers(0, 40))) for _ in range(200)]
    for lower in (False, True):
        words = [hashing.words_of(t, lower) for t in some]
        block = hashing.Block(pa.array(["z", *some]).slice(1), lower)
        assert block.lengths.tolist() == list(map(len, words)) and block.starts[1:].tolist() == block.ends[:-1].tolist()
        pairs = set(zip((w for x in words for w in x), block.words.tolist(), strict=True))
        assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert len(hashing.Block([], True).words) == 0 and hashing.Block([None], True).lengths.tolist() == [0]


# Languages


def test_viterbi_equals_every_path():
    from itertools import product

    rng = np.random.default_rng(4)
    for _ in range(60):
        s = -rng.random((7, 3)).astype(np.float32) * 6
        path = language_id.viterbi(s, 2.0)
        value = lambda p: sum(s[k, x] for k, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
        assert abs(value(path.tolist()) - max(value(p) for p in product(range(3), repeat=7))) < 1e-4


def test_best_paths_equal_a_search_text_by_text():
    rng = np.random.default_rng(5)
    for languages in (1, 2, 4):
        lengths = rng.integers(1, 30, 80)
        s = -rng.random((int(lengths.sum()), languages)).astype(np.float32) * rng.choice([0.5, 4], (len(lengths), 1)).repeat(lengths, 0)
        ends = lengths.cumsum()
        direct = [language_id.viterbi(s[a:b], 3.0) for a, b in zip(ends - lengths, ends, strict=True)]
        assert language_id.best_paths(s, lengths, 3.0).tolist() == np.concatenate(direct).tolist()


def test_new_words_score_by_their_trigrams():
    weights = {"^ab": np.array([3.0, 1.0]), "ab$": np.array([0.0, 5.0]), "^b$": np.array([2.0, 2.0]), "bab": np.array([1.0, 0.0])}
    model = language_id.LanguageModel(["x", "y"], np.ones(2), [], np.zeros((0, 2)), weights, {"latin": np.array([9.0, 9.0]), "greek": np.array([0.0, 9.0])})
    words = ["ab", "b", "babab", "γab", "яb", "-^ab", "ab"]
    mass = sum(weights.values())
    for word, got in zip(words, model.word_scores(words).tolist(), strict=True):
        run = word[1:] if word[0] == "-" else f"^{word}$"
        sums = sum((np.log((weights.get(run[k : k + 3], 0) + np.full(2, 0.5)) / (mass + 2.0)) for k in range(len(run) - 2)), np.zeros(2))
        own = {"γ": sums[1:], "я": np.zeros(0)}.get(word[0], sums)
        expected = [0, 0] if not len(own) else [model.floor if word[0] == "γ" and not k else max(x - own.max(), model.floor) for k, x in enumerate(sums)]
        assert np.allclose(got, expected)
    scorer = language_id.Scorer(model, room=3)
    found, letters = scorer.scores(words)
    assert np.allclose(found, model.word_scores(words), atol=1e-5) and letters.tolist() == list(map(language_id.letters_in, words))


def test_mixed_text_has_spans(spark, nothing, docs):
    english, german = "the house of the king and the old river", "das haus von dem könig und der alte fluss"
    rows = [(k, (english if k % 2 else german), "en" if k % 2 else "de") for k in range(40)]
    model = language_id.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    both = spark.createDataFrame([(1, f"{english} {english} {german}"), (2, None), (3, "12 !"), (4, "ΑΒΓ δε")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(both, model, penalty=4.0).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de"]
    assert [(s.first, s.end) for s in got[1].spans] == [(0, 18), (18, 27)]
    assert got[1].lang_pred == "en"
    assert got[2].lang_pred == got[3].lang_pred == "und"
    assert got[4].lang_pred in ("de", "en")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(docs, model).count() == len(awkward())
    none = language_id.fit_languages(nothing.withColumn("lang", F.lit("en")))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_trigrams_keep_the_ratio_between_languages(spark):
    """A word of one language that leaks into another tells new words apart however often it occurs."""
    rows = [("haus " * 3000 + "zzz " * 100, "de"), ("haus " * 60 + "yyy " * 3040, "en")]
    model = language_id.fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    de, en = model.word_scores(["hausa"])[0]
    assert de == 0 and en < -2


def test_long_runs_and_script_changes_are_whole(spark):
    runs = ["a", "hausboot", "abcdefghij" * 31, "abcабвгд日本語かなx", "я" * 61, "aб", "日" * 31]
    for run in runs:
        units = language_id.words_of(run)
        assert sum(map(language_id.letters_in, units)) == len(run)
        assert max(map(language_id.letters_in, units)) <= language_id.UNIT
        marked = f"^{run}$"
        assert list(map(language_id.trigram_of, language_id.trigram_codes(units)[0].tolist())) == [marked[k : k + 3] for k in range(len(run))]
    assert [language_id.script_of(u) for u in language_id.words_of("abcабв日か")] == ["latin", "cyrillic", "han", "kana"]
    english, german = "the house of the king and the old river", "das haus von dem könig und der alte fluss"
    model = language_id.fit_languages(spark.createDataFrame([(english, "en"), (german, "de")] * 20, "text string, lang string"))
    run = english.replace(" ", "") + german.replace(" ", "") * 9
    got = language_id.identify(spark.createDataFrame([(1, run)], "doc_id long, text string"), model, penalty=2.0).first()
    assert got.lang_pred == "de" and [s.lang for s in got.spans] == ["en", "de"]


def test_letters_and_marks():
    assert language_id.words_of("½ ² 12 _ Ⅳ ٣ ́") == []
    assert language_id.words_of("हिन्दी x²y a½b") == ["हिन्दी", "x", "y", "a", "b"]
    assert language_id.words_of("x² ½ Äb") == ["x", "äb"]


def test_runs_that_differ_after_many_letters_are_told_apart(spark):
    rows = [("ab" * 15 + "xyz" * 60, "en"), ("ab" * 15 + "uvw" * 60, "de")] * 5
    model = language_id.fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    docs = spark.createDataFrame([(1, "ab" * 15 + "xyz" * 57), (2, "ab" * 15 + "uvw" * 57), (3, "½ ²")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()} == {1: "en", 2: "de", 3: "und"}


def test_a_small_language_keeps_its_words(spark):
    """Words of a language with many rows do not push those of another out, and trigrams come from all words."""
    hot = [(" ".join(f"{a}{b}{c}o" for a in "abcdefgh" for b in "klmnp" for c in "acdefghik"), "en")] + [(" the" * k, "en") for k in range(1, 30)]
    model = language_id.fit_languages(spark.createDataFrame([*hot, ("zwu zwu xyu", "de")], "text string, lang string"), vocabulary=2)
    assert model.languages == ["de", "en"]
    assert set(model.words) == {"the", "zwu", "xyu"}
    assert {"^xy", "xyu", "yu$", "aka"} <= set(model.weights)
    got = language_id.identify(spark.createDataFrame([(1, "zwu xyux"), (2, "akao hpeo")], "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "de", 2: "en"}


# Near duplicates


def groups(rows, size=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(hashing._LOWER).split()
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    forest = components.Forest(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same) or (rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]):
                forest.union(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and sets[k]:
            least[forest.find(k)] = min(i, least.get(forest.find(k), i))
    return [(i, len(sets[k]), least.get(forest.find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("chunk", [1_000_000, 150])
def test_jaccard_groups(docs, nothing, chunk):
    expected = groups([(i, t) for i, t, *_ in awkward()])
    assert by_id(jaccard_join.jaccard_groups(docs, chunk_tokens=chunk), "n_shingles", "component_id") == sorted(expected, key=repr)
    assert jaccard_join.jaccard_groups(nothing).count() == 0


def test_rows_that_share_an_id_are_one_node(spark):
    a, b = prose(5, 40), prose(6, 40)
    rows = [(3, a), (7, a), (7, b), (9, b), (9, ""), (2**62 + 5, prose(7, 40)), (-4, "lone")]
    got = by_id(jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")), "component_id")
    assert got == sorted([(3, 3), (7, 3), (7, 3), (9, 3), (9, 9), (2**62 + 5, 2**62 + 5), (-4, -4)], key=repr)


def near_copies(seed: int, n: int) -> list[tuple]:
    """Near copies of three texts, short texts, repeated ids and rows."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        words = prose(rng.randrange(3), rng.choice([3, 4, 6, 7, 8, 60, 60])).split(" ")
        for _ in range(rng.randrange(3) if len(words) > 20 else 0):
            words[rng.randrange(len(words))] = f"x{rng.randrange(60)}"
        rows.append((rng.randrange(n) if k % 5 else None, " ".join(words)))
    return [*rows, *rows[:4]]


@pytest.mark.parametrize(("chunk", "unique"), [(100_000, False), (150, False), (150, True), (400, True)])
def test_random_near_copies_equal_brute_force(spark, chunk, unique):
    """Small chunks make neighbourhoods be compared by pivots and leftovers; order and partitions do not matter."""
    rows = near_copies(11 if unique else 12, 150)
    rows = [(k, t) for k, (_, t) in enumerate(rows)] if unique else rows
    expected = sorted(groups(rows), key=repr)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for some in (docs, docs.orderBy(F.rand(3)).repartition(5)):
        assert by_id(jaccard_join.jaccard_groups(some, chunk_tokens=chunk), "n_shingles", "component_id") == expected


def test_a_line_of_all_documents_is_sent_once_per_block():
    line = "this line stands in every one of the documents"
    texts = [f"{line} {prose(k, 12)}" for k in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts), pa.array(range(300), pa.int64())], ["doc_id", "text", "row_key"])
    tokens, doc, _ = jaccard_join.shingle_tokens(texts, 5)
    assert np.bincount(np.unique(tokens, return_inverse=True)[1]).max() == 300

    class Task:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": staticmethod(lambda: 0)})

    before, jaccard_join.TaskContext = jaccard_join.TaskContext, Task
    try:
        sent = [r for b in jaccard_join._send(5, 3)(iter([batch])) for r in b.to_pylist()]
    finally:
        jaccard_join.TaskContext = before
    inside = np.concatenate([hashing.unpack_sorted(r["tokens"]) for r in sent if r["head"] is None])
    assert len(inside) == len(np.unique(inside)) == len(np.unique(tokens))


def test_divide_skip_finds_all():
    rng = np.random.default_rng(6)
    for _ in range(200):
        lists = [np.flatnonzero(rng.random(60) < rng.random()) for _ in range(12)]
        lists = [x for x in lists if len(x)]
        least = int(rng.integers(1, 9))
        counts = np.bincount(np.concatenate(lists), minlength=60)
        assert dict(jaccard_join.divide_skip(lists, least)) == {k: int(c) for k, c in enumerate(counts.tolist()) if c >= least}


@pytest.mark.parametrize("sides", [False, True])
def test_links_among_many_near_copies(sides):
    rng = np.random.default_rng(9)
    base = np.arange(100, dtype=np.uint64)
    sets = []
    for k in range(150):
        own = base.copy()
        gone = rng.choice(100, int(rng.integers(0, 25)), replace=False)
        own[gone] = 1000 + rng.integers(0, 40, len(gone)).astype(np.uint64)
        sets.append(np.unique(own))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    side = rng.integers(0, 2, len(sets)) if sides else None
    forest = components.Forest(len(sets))
    for a in range(len(sets)):
        for b in range(a):
            same = len(np.intersect1d(sets[a], sets[b]))
            if (side is None or side[a] != side[b]) and 100 * same >= 75 * (sizes[a] + sizes[b] - same):
                forest.union(a, b)
    got = dict(jaccard_join.link_sets(sizes, sets, 75, side))
    assert {k: forest.find(k) for k in range(len(sets)) if forest.find(k) != k} == got


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1060)]
    forest = components.Forest(2000)
    for a, b in links:
        forest.union(a, b)
    expected = {x: forest.find(x) for a, b in links for x in (a, b) if a != b}
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == expected
