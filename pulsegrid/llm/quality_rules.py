"""Quality classifier: a sparse rule ensemble over text statistics, compiled into Spark columns.

Shallow trees are boosted on statistics of labelled documents. Every path from a root is a rule, a
conjunction of bounds; a logistic model with an L1 penalty over all rules keeps few of them. Rules and the
logistic sum are column expressions over the statistics. The statistics a kept rule needs, and no others, are taken from
texts in Arrow batches, where counting a class of characters is one pass over bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import held_out, id_and_text, with_carried
from .workers import begin

#: Labelled rows fitted on: at most so many, those with the least hashes of their ids.
FIT_ROWS = 20_000


def _share(chars: bytes):
    return lambda text, raw: (len(raw) - len(raw.translate(None, chars))) / len(text)


def _distinct(parts: list[bytes]) -> float:
    return len(set(parts)) / max(1, len(parts))


#: Statistics of a whole text that is not empty, from its characters and its UTF-8 bytes.
STATISTICS = {
    "log_chars": lambda text, raw: log1p(len(text)),
    "symbols": _share(b"!#$%&*+<=>@^_|~\\/{}[]"),
    "upper": _share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _share(b"0123456789"),
    "stops": _share(b".,;:?"),
    "breaks": _share(b"\n"),
    "word_chars": lambda text, raw: len(text) / max(1, len(raw.split())),
    "distinct_words": lambda text, raw: _distinct(raw.split()),
    "distinct_lines": lambda text, raw: _distinct(raw.split(b"\n")),
}


def statistics(text: str | None, names: tuple[str, ...] = tuple(STATISTICS)) -> list[float]:
    """The named statistics; all 0 for null and empty text."""
    if not text:
        return [0.0] * len(names)
    raw = text.encode()
    return [float(STATISTICS[n](text, raw)) for n in names]


def measured(rows: DataFrame, names: tuple[str, ...], *, keep_text: bool = False) -> DataFrame:
    """doc_id, a column per statistic, the text if asked, and the struct of columns to carry if rows have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("quality")
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                found = np.array([statistics(t, names) for t in part["text"].to_pylist()], float).reshape(part.num_rows, len(names))
                others = [c for c in ("text", "carried") if c in part.schema.names and (c != "text" or keep_text)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *[pa.array(c) for c in found.T], *[part[c] for c in others]], ["doc_id", *names, *others])

    return rows.mapInArrow(run, with_carried(", ".join(["doc_id long", *[f"{n} double" for n in names], *["text string"] * keep_text]), rows))


@dataclass(frozen=True)
class Rule:
    """Bounds (feature, above?, threshold) that all must hold."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, at in self.bounds:
            out &= (x[:, f] > at) == above
        return out

    def column(self, columns: list[Column]) -> Column:
        out = F.lit(True)
        for f, above, at in self.bounds:
            out = out & ((columns[f] > F.lit(at)) if above else (columns[f] <= F.lit(at)))
        return out


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, cuts: list[np.ndarray], depth: int, least: int, path: tuple = (), rows: np.ndarray | None = None) -> tuple[list[tuple[tuple, float]], list[tuple]]:
    """(leaves as (path, value), paths of all nodes but the root) of one tree fitted to the gradient."""
    rows = np.arange(len(x)) if rows is None else rows
    g, h = gradient[rows], hessian[rows]
    best = (1e-6, None, None)
    if depth and len(rows) >= 2 * least:
        total, weight = g.sum(), h.sum()
        for f, at in enumerate(cuts):
            if not len(at):
                continue
            cell = np.searchsorted(at, x[rows, f], "left")
            gs, hs, ns = (np.bincount(cell, w, len(at) + 1).cumsum()[:-1] for w in (g, h, np.ones(len(g))))
            fine = (ns >= least) & (len(rows) - ns >= least)
            gain = np.where(fine, gs**2 / (hs + 1) + (total - gs) ** 2 / (weight - hs + 1) - total**2 / (weight + 1), -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, float(at[k]))
    paths = [path] if path else []
    if best[1] is None:
        return [(path, float(g.sum() / (h.sum() + 1)))], paths
    _, f, at = best
    leaves = []
    for above in (False, True):
        some = rows[(x[rows, f] > at) == above]
        sub, more = _grow(x, gradient, hessian, cuts, depth - 1, least, (*path, (f, above, at)), some)
        leaves += sub
        paths += more
    return leaves, paths


def extract_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 24, depth: int = 3, rate: float = 0.3) -> list[Rule]:
    """Distinct rules of boosted trees; a rule and its complement count as one."""
    cuts = [np.unique(np.quantile(c, np.linspace(0.004, 0.996, 125))) for c in x.T]
    score = np.full(len(x), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    least = max(3, len(x) // 1000)
    rules: dict[tuple, Rule] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        leaves, paths = _grow(x, y - p, p * (1 - p), cuts, depth, least)
        for path, value in leaves:
            score += rate * value * Rule(path).holds(x)
        for path in paths:
            rule = Rule(tuple(sorted(path)))
            rules.setdefault(tuple(np.packbits(rule.holds(x) ^ rule.holds(x[:1])[0])), rule)
    return list(rules.values())


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient; the intercept is not penalised."""
    n, k = z.shape
    rate = 4.0 / (np.linalg.norm(np.c_[z, np.ones(n)], 2) ** 2 / n + 1e-9)
    w, b, v, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - rate * (z.T @ r) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        free = c - rate * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t2 * (new - w), free + (t - 1) / t2 * (free - b)
        w, b, t = new, free, t2
    return w, b


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules over named statistics."""

    names: tuple[str, ...]
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = 3e-4) -> RuleModel:
        """Without both labels the score is their share."""
        if not len(y) or y.min() == y.max():
            p = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
            return RuleModel(tuple(names), (), (), float(np.log(p / (1 - p))))
        rules = extract_rules(x, y)
        z = np.stack([r.holds(x) for r in rules], 1).astype(float)
        w, b = lasso_logistic(z, y, penalty)
        kept = np.flatnonzero(np.abs(w) > 1e-6)
        return RuleModel(tuple(names), tuple(rules[k] for k in kept), tuple(float(w[k]) for k in kept), float(b))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for r, w in zip(self.rules, self.weights, strict=True):
            total += w * r.holds(x)
        return 1 / (1 + np.exp(-total))

    def used(self) -> tuple[str, ...]:
        """Names of the statistics that a kept rule bounds."""
        some = {f for r in self.rules for f, _, _ in r.bounds}
        return tuple(n for k, n in enumerate(self.names) if k in some)

    def column(self) -> Column:
        """The score as an expression over the columns of the statistics used."""
        columns = [F.col(n) for n in self.names]
        total = F.lit(self.intercept)
        for r, w in zip(self.rules, self.weights, strict=True):
            total = total + F.when(r.column(columns), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_quality(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, label: str = "quality") -> RuleModel:
    """Fits on labelled rows that are not held out, at most fit_rows of them; their statistics reach the driver, no text."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id")))
    chosen = chosen.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = id_and_text(docs).join(F.broadcast(chosen), "doc_id")  # at most fit_rows rows
    rows = rows.select("doc_id", "text", F.struct("y").alias("carried"))
    names = tuple(STATISTICS)
    got = measured(rows, names).select("doc_id", "carried.y", *names).dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    return RuleModel.fit(got[list(names)].to_numpy(float), got["y"].to_numpy(float), list(names))


def scored(docs: DataFrame, model: RuleModel, *, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """doc_id, score, the text if asked, and a struct of columns to carry if asked."""
    rows = measured(id_and_text(docs, id_col, text_col, carry), model.used(), keep_text=keep_text)
    return rows.select("doc_id", model.column().alias("score"), *["text"] * keep_text, *["carried"] * bool(carry))


def score_quality(docs: DataFrame, model: RuleModel, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on) for every row.

    Null and empty texts are scored from statistics that are all 0. Null ids and repeated rows are
    scored like others. An empty table gives no rows. No shuffle.
    """
    return scored(docs, model, id_col=id_col, text_col=text_col).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel, *, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows that score at least the threshold, with the columns they came with."""
    others = tuple(c for c in docs.columns if c != text_col)
    good = scored(docs, model, text_col=text_col, carry=others, keep_text=True)
    return good.where(F.col("score") >= threshold).select(*[F.col("text").alias(c) if c == text_col else F.col(f"carried.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op3: every document scored by a model fitted on labelled rows that are not held out."""
    from .tables import table

    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
