"""Language identification: script ranges, per-word scores, and Viterbi with a switching penalty.

A word's script leaves the languages seen with it. Words of the learned vocabulary, which each language has its own
share of, score by their counts per language, others by letter trigrams of all words. The best path through a text pays a penalty
for each change of language; its runs are the spans of a mixed text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import slices
from .tables import held_out, id_and_text, least_count, written

UNKNOWN = "und"
#: Runs of letters: where all characters are below U+0250 there are no marks, and the only word characters that are
#: neither letters nor digits are superscripts and fractions; elsewhere letters with the marks that follow them.
_LATIN_RUN = re.compile(r"[^\W\d_²³¹¼-¾]+")
#: What stays of a text of Latin-1 alone: its letters, and a blank for each other character.
_LETTERS = bytes(c if chr(c).isalpha() else 32 for c in range(256))
_RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: First and last code point of ranges that tell scripts apart (Unicode blocks; fixed values).
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
_SCRIPT_NAMES = (*dict.fromkeys(name for name, _, _ in SCRIPTS), "other")


@lru_cache(maxsize=65536)
def _script(letter: str) -> str:
    c = ord(letter)
    return next((name for name, low, high in SCRIPTS if low <= c <= high), "other")


#: Letters of a unit; longer runs are judged piece by piece.
UNIT = 30
_BEYOND_LATIN = re.compile(r"[^\x00-\u024f]")


def script_of(unit: str) -> str:
    """Script of a unit's first own letter; `other` outside the ranges."""
    return _script(unit[3 if unit[0] == "+" else 2 if unit[0] == "-" else 0])


def letters_in(unit: str) -> int:
    """Letters of a unit, without its marks and what it repeats of the unit before."""
    return len(unit) if unit[0] not in "+-" else len(unit) - (3 if unit[0] == "+" else 2) - unit.endswith("$")


def _pieces(run: str) -> list[str]:
    """A run of letters as units of one script and about UNIT letters at most; marks stay with their letter, unless they go on
    without end. A run of one unit stands for itself. Else the first piece begins with -^, the others with + and the two
    characters before them, the last ends in $, so the trigrams of the pieces are those of the run."""
    edges = [0]
    script = _script(run[0])
    for k, letter in enumerate(run):
        held = k - edges[-1]
        if unicodedata.category(letter)[0] == "M":
            if held >= 2 * UNIT:
                edges.append(k)
            continue
        now = _script(letter)
        if now != script or held >= UNIT:
            edges.append(k)
            script = now
    if len(edges) == 1:
        return [run]
    marked = f"^{run}$"
    edges.append(len(run) + 1)
    return [f"{'+' if a else '-'}{marked[max(0, a - 1) : b + 1]}" for a, b in zip(edges, edges[1:], strict=False)]


def words_of(text: str | None) -> list[str]:
    """Units of a text: runs of letters and their marks, lower case, split where they are long or change script."""
    if not text:
        return []
    text = text.lower()
    try:
        found = text.encode("latin-1").translate(_LETTERS).decode("latin-1").split()
        if not found or max(map(len, found)) <= UNIT:
            return found
    except UnicodeEncodeError:
        pass
    latin = not _BEYOND_LATIN.search(text)
    found = (_LATIN_RUN if latin else _RUN).findall(text)
    if not found or (latin and max(map(len, found)) <= UNIT):
        return found
    out = []
    for w in found:
        if len(w) <= UNIT and (latin or not _BEYOND_LATIN.search(w)):
            out.append(w)
        else:
            out += _pieces(w)
    return out


#: A trigram as a number: 21 bits for each of its code points, the first lowest.
_BITS = 21


def trigram_codes(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, index of its unit) of all trigrams of some units."""
    marked = [u[1:] if u[0] in "+-" else f"^{u}$" for u in units]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    if len(chars) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = chars[:-2] | chars[1:-1] << _BITS | chars[2:] << 2 * _BITS
    inside = owner[:-2] == owner[2:]
    return codes[inside], owner[:-2][inside]


def trigram_of(code: int) -> str:
    return "".join(chr(code >> k * _BITS & (1 << _BITS) - 1) for k in range(3))


@dataclass
class LanguageModel:
    """Word counts per language of a vocabulary, trigram weights and script counts of all words; a column per language."""

    languages: list[str]
    totals: np.ndarray
    words: list[str]
    counts: np.ndarray
    weights: dict[str, np.ndarray]
    scripts: dict[str, np.ndarray]
    floor: float = -8.0

    def __post_init__(self):
        n = max(1, len(self.languages))
        size = max(1, len(self.weights))
        mass = np.sum(list(self.weights.values()), axis=0) if self.weights else np.ones(n)
        codes = trigram_codes([f"+{g}" for g in self.weights])[0]
        order = np.argsort(codes)
        weights = np.array(list(self.weights.values()), float).reshape(-1, n)[order]
        self.codes = codes[order]
        #: Log shares of the trigrams, by code, and last those of one that was not seen.
        self.grams = np.log((np.concatenate([weights, np.zeros((1, n))]) + 0.5) / (mass + 0.5 * size))
        allowed = np.sum(list(self.scripts.values()), axis=0) if self.scripts else np.ones(n)
        self.candidates = {s: (c > 0.001 * allowed).tolist() for s, c in self.scripts.items()}

    def vocabulary_scores(self) -> np.ndarray:
        """The scores of all words of the vocabulary, as word_scores has them for others."""
        none = [False] * max(1, len(self.languages))
        may = np.array([self.candidates.get(script_of(w), none) for w in self.words], bool).reshape(len(self.words), -1)
        logs = np.log((self.counts + 0.1) / (self.totals + 1))
        top = np.where(may, logs, -np.inf).max(1, keepdims=True, initial=-np.inf)
        some = np.isfinite(top)
        return np.where(some, np.where(may, np.maximum(logs - np.where(some, top, 0), self.floor), self.floor), 0)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log scores per language, by trigrams, 0 for the best and not below the floor; equal if the script rules out all."""
        n = max(1, len(self.languages))
        codes, owner = trigram_codes(words)
        at = np.full(len(codes), len(self.codes))
        if len(self.codes):
            near = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            at = np.where(self.codes[near] == codes, near, at)
        sums = np.stack([np.bincount(owner, self.grams[at, k], len(words)) for k in range(n)], 1)
        none = [False] * n
        may = np.array([self.candidates.get(script_of(w), none) for w in words], bool).reshape(-1, n)
        top = np.where(may, sums, -np.inf).max(1, keepdims=True, initial=-np.inf)
        some = np.isfinite(top)
        return np.where(some, np.where(may, np.maximum(sums - np.where(some, top, 0), self.floor), self.floor), 0)


class Scorer(dict):
    """Rows of a score table by word; new words take a row each until a bounded number is reached."""

    def __init__(self, model: LanguageModel, room: int = 300_000):
        super().__init__()
        self.model, self.base = model, len(model.words)
        self.table = np.zeros((self.base + room, max(1, len(model.languages))), np.float32)
        self.letters = np.zeros(self.base + room, np.int64)
        if self.base:
            self.table[: self.base] = model.vocabulary_scores()
            self.letters[: self.base] = [letters_in(w) for w in model.words]
        self.update(zip(model.words, range(self.base), strict=True))
        self.vocabulary = dict(self)

    def __missing__(self, word: str) -> int:
        k = len(self)
        self[word] = k
        return k

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores per language, letters) of each word."""
        if len(self) + len(words) > len(self.table):
            self.clear()
            self.update(self.vocabulary)
        if len(self) + len(words) > len(self.table):  # more words than there is room for
            half = len(words) // 2
            return tuple(np.concatenate(x) for x in zip(self.scores(words[:half]), self.scores(words[half:]), strict=True))
        before = len(self)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if len(self) > before:
            new = list(islice(reversed(self), len(self) - before))[::-1]
            self.table[before : len(self)] = self.model.word_scores(new)
            self.letters[before : len(self)] = [letters_in(w) for w in new]
        return self.table[rows], self.letters[rows]


_scorers: dict[str, Scorer] = {}


def scorer_for(key: str, make) -> Scorer:
    """One scorer for each model and worker process, so tasks share what it has worked out."""
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(make())
    return _scorers[key]


def best_paths(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word, of texts that follow one another; a text has a word at least. Where no stretch of a text
    gains more than the penalty over its best single language, that one is the best path, and the search is not needed."""
    if scores.shape[1] == 1 or not len(scores):
        return np.zeros(len(scores), np.int64)
    starts = lengths.cumsum() - lengths
    sums = np.add.reduceat(scores, starts, dtype=np.float64)
    best = np.repeat(sums.argmax(1), lengths)
    at = np.arange(len(scores))
    others = scores.copy()
    others[at, best] = -np.inf
    gains = (others.max(1) - scores[at, best]).astype(np.float64)
    # Sums before and after each word; each text lies below all before it, so the least sum so far is its own.
    spans = 1 + 2 * np.add.reduceat(np.abs(gains), starts)
    lower = np.repeat(spans.cumsum() - spans, lengths)
    after = gains.cumsum()
    before = np.minimum.accumulate(after - gains - lower)
    rise = np.maximum.reduceat(after - lower - before, starts)
    error = 1e-9 * spans.sum()
    for text in np.flatnonzero(rise > penalty - error).tolist():
        some = slice(starts[text], starts[text] + lengths[text])
        best[some] = viterbi(scores[some], penalty)
    return best


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language per word of one text; of equal ones the first."""
    n, state = scores.shape[1], scores[0].astype(float).tolist()
    back = []
    for row in scores[1:].tolist():
        top = max(range(n), key=state.__getitem__)
        limit = state[top] - penalty
        came = [k if state[k] >= limit else top for k in range(n)]
        state = [(state[k] if state[k] >= limit else limit) + row[k] for k in range(n)]
        back.append(came)
    at = max(range(n), key=state.__getitem__)
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return np.array(path[::-1])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, lang, n) over a task's texts, handed on whenever there are many; word '' counts all words."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> pa.RecordBatch:
        words = [w for some in counts.values() for w in some]
        langs = [x for x, some in counts.items() for _ in range(len(some))]
        n = [n for some in counts.values() for n in some.values()]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(langs, pa.string()), pa.array(n, pa.int64())], ["word", "lang", "n"])

    for part in slices(batches, 200):
        for text, lang in zip(part["text"].to_pylist(), part["lang"].to_pylist(), strict=True):
            found = words_of(text)
            counts[lang].update(found)
            counts[lang][""] += len(found)
        if sum(map(len, counts.values())) > 300_000:
            yield flush()
    if counts:
        yield flush()


def _learned(languages: int):
    """From words and their counts, a column per language, to (code, scores per language): trigram weights, and script counts under
    the codes below 0, -1 for the first of _SCRIPT_NAMES."""

    def merged(codes: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, which = np.unique(np.concatenate(codes), return_inverse=True)
        values = np.concatenate(sums)
        return keys, np.stack([np.bincount(which, values[:, k], len(keys)) for k in range(languages)], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sums = [], []
        for part in batches:
            if not part.num_rows:
                continue
            words = part["word"].to_pylist()
            n = np.stack([np.asarray(part[f"n{k}"]) for k in range(languages)], 1).astype(float)
            total = n.sum(1, keepdims=True)
            found, owner = trigram_codes(words)
            scripts = np.array([-1 - _SCRIPT_NAMES.index(script_of(w)) for w in words])
            some = merged([found, scripts], [(n * np.log1p(total) / total)[owner], n])
            codes.append(some[0])
            sums.append(some[1])
            if sum(map(len, codes)) > 500_000:
                codes, sums = ([x] for x in merged(codes, sums))
                if len(codes[0]) > 250_000:
                    yield rows(codes[0], sums[0])
                    codes, sums = [], []
        if codes:
            yield rows(*merged(codes, sums))

    def rows(codes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * languages, pa.int32()), pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(codes), values], ["code", "v"])

    return run


def fit_languages(docs: DataFrame, *, vocabulary: int = 60_000, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Counts all words of the rows given, by language.

    Trigrams and scripts are learned from all of them; the driver gets one row per different trigram. Of each language
    the most frequent words (words with equal counts all or none) are scored by their own counts: `vocabulary` of them, or twice
    the root of the language's words where that is more. Others are scored by their trigrams. Rows with null text or language
    teach nothing; repeated rows count each; without any row every text is `und`.
    """
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = rows.mapInArrow(_count, "word string, lang string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = written(counts.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")))
    totals = {x: n for r in words.where("word = ''").collect() for x, n in r.by.items() if n}
    languages = sorted(totals)
    n = len(languages)
    if not n:
        return LanguageModel([], np.zeros(0), [], np.zeros((0, 1)), {}, {})
    words = words.where("word <> ''")
    # Different counts of a language are fewer than the square root of twice its words.
    sizes: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for r in words.select(F.explode("by").alias("lang", "n")).groupBy("lang", "n").count().collect():
        sizes[r["lang"]].append((r["n"], r["count"]))
    least = {x: least_count(sizes[x], max(vocabulary, 2 * math.isqrt(totals[x])) if vocabulary else 0) for x in languages}
    limits = F.create_map(*[F.lit(v) for pair in least.items() for v in pair])
    top = words.where(F.exists(F.map_entries("by"), lambda e: e["value"] >= limits[e["key"]])).select("word", *[F.coalesce(F.col("by")[x], F.lit(0)) for x in languages]).collect()
    key_sums = [F.sum(F.col("v")[k]) for k in range(n)]
    by_language = words.select("word", *[F.coalesce(F.col("by")[x], F.lit(0)).alias(f"n{k}") for k, x in enumerate(languages)])
    learned = by_language.mapInArrow(_learned(n), "code long, v array<double>").groupBy("code").agg(*key_sums).collect()
    grams = {trigram_of(r[0]): np.array(r[1:], float) for r in learned if r[0] >= 0}
    scripts = {_SCRIPT_NAMES[-1 - r[0]]: np.array(r[1:], float) for r in learned if r[0] < 0}
    return LanguageModel(languages, np.array([totals[x] for x in languages], float), [r[0] for r in top], np.array([r[1:] for r in top], float).reshape(-1, n), grams, scripts)


def identify(docs: DataFrame, model: LanguageModel, *, penalty: float = 12.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns doc_id, lang_pred, score, spans (lang, first unit, one past the last) per row. A unit is a run of letters,
    or a piece of it if it is long or changes script.

    lang_pred is the language with most letters in the spans; score is its share of letters times its
    probability against the other languages over the whole text. Null texts and texts without a letter are `und`
    with score 0 and no spans, as is everything if no language was learned. Digits, fractions, superscripts and marks
    alone are no letters. Of languages that score the same the first by name is taken. Null ids and repeated rows
    are handled like others. No shuffle.
    """
    languages = model.languages
    key = uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((languages, model.totals, model.words, model.counts, model.weights, model.scripts))  # vocabulary and trigrams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_for(key, lambda: LanguageModel(*shared.value))
        for part in slices(batches, 500, 1_000_000):
            texts = [words_of(text) if languages else [] for text in part["text"].to_pylist()]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            preds, sures, spans = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
            some = np.flatnonzero(lengths)
            if len(some):
                words, lengths = list(chain.from_iterable(texts)), lengths[some]
                scores, letters = scorer.scores(words)
                path = best_paths(scores, lengths, penalty)
                starts = lengths.cumsum() - lengths
                own = np.repeat(np.arange(len(some)), lengths)
                n = len(languages)
                shares = np.bincount(own * n + path, letters, len(some) * n).reshape(-1, n)
                pred = shares.argmax(1)
                text = np.arange(len(some))
                total = np.add.reduceat(scores, starts, dtype=np.float64)
                odds = np.exp(np.minimum(total - total[text, pred][:, None], 500)).sum(1)
                sures[some] = shares[text, pred] / shares.sum(1) / odds
                new = np.ones(len(path), bool)
                new[1:] = (path[1:] != path[:-1]) | (own[1:] != own[:-1])
                first = np.flatnonzero(new)
                end = np.append(first[1:], len(path))
                for k, lang in zip(some.tolist(), pred.tolist(), strict=True):
                    preds[k] = languages[lang]
                begins = starts[own[first]]
                for k, lang, a, b in zip(some[own[first]].tolist(), path[first].tolist(), (first - begins).tolist(), (end - begins).tolist(), strict=True):
                    spans[k].append({"lang": languages[lang], "first": a, "end": b})
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(preds, pa.string()), pa.array(sures, pa.float64()), pa.array(spans, kind)], ["doc_id", "lang_pred", "score", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first:long,end:long>>")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: languages of all documents, learned from those not held out."""
    from .tables import table

    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
