"""Quality classifier: a generalised additive model with pairwise interactions.

Features are binned; shallow trees are boosted on one feature at a time, in a cycle, and each
adds to that feature's table of bin scores. The pairs of features whose residuals gain most get
tables over two coarse binnings. A score is a sum of table entries, looked up for whole batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, with_struct
from quillstone.llm.rules import MAX_LABELLED, RATIOS, labelled_statistics, with_statistics

FEATURES = ("n_words", *RATIOS)
BINS, COARSE = 48, 8
HELD_OUT_PART, PARTS = 2, 4
THRESHOLD = 0.7


@dataclass
class Model:
    """Bin bounds and scores: one table for each feature, one for each chosen pair."""

    features: tuple[str, ...]
    bounds: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """The sums of bin scores of rows of feature values."""
        out = np.full(len(x), self.intercept)
        for j, (bounds, t) in enumerate(zip(self.bounds, self.tables, strict=True)):
            out += t[np.searchsorted(bounds, x[:, j], side="right")]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _bounds(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1])) if len(v) else np.array([])


def _best_cut(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """Gain and place of the best cut of bins in two; place 0 if no cut gains."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = gl**2 / (hl + l2) + (g.sum() - gl) ** 2 / (h.sum() - hl + l2) - g.sum() ** 2 / (h.sum() + l2)
    i = int(gain.argmax())
    return (float(gain[i]), i + 1) if gain[i] > 1e-9 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, rate: float, l2: float = 1.0) -> np.ndarray:
    """Bin scores of a tree of at most two levels on sums of gradients and weights by bin."""
    out = np.zeros(len(g))
    _, cut = _best_cut(g, h, l2)
    spans = [(0, cut), (cut, len(g))] if cut else [(0, len(g))]
    for a, b in spans:
        _, c = _best_cut(g[a:b], h[a:b], l2)
        for s, e in ((a, a + c), (a + c, b)) if c else ((a, b),):
            out[s:e] = rate * g[s:e].sum() / (h[s:e].sum() + l2)
    return out


def _pair_sums(i: np.ndarray, j: np.ndarray, shape: tuple[int, int], w: np.ndarray) -> np.ndarray:
    return np.bincount(i * shape[1] + j, w, shape[0] * shape[1]).reshape(shape)


def pair_tree(g: np.ndarray, h: np.ndarray, rate: float, l2: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and scores of the best cut in four: one bound on each of the two features."""
    best, out = 0.0, np.zeros(g.shape)
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))

    def box(c: np.ndarray, a: int, b: int, s: int, e: int) -> float:
        return c[b, e] - c[a, e] - c[b, s] + c[a, s]

    whole = g.sum() ** 2 / (h.sum() + l2)
    for p in range(1, g.shape[0]):
        for q in range(1, g.shape[1]):
            parts = [(a, b, s, e) for a, b in ((0, p), (p, g.shape[0])) for s, e in ((0, q), (q, g.shape[1]))]
            gain = sum(box(cg, *x) ** 2 / (box(ch, *x) + l2) for x in parts) - whole
            if gain > best + 1e-9:
                best, out = gain, np.zeros(g.shape)
                for a, b, s, e in parts:
                    out[a:b, s:e] = rate * box(cg, a, b, s, e) / (box(ch, a, b, s, e) + l2)
    return best, out


def fit_gam(x: np.ndarray, y: np.ndarray, features: Sequence[str], rounds: int = 120, most_pairs: int = 4, pair_rounds: int = 30, rate: float = 0.15) -> Model:
    """The model of the probability of 1. With one class only, or no rows, the score is constant."""
    bounds = [_bounds(x[:, j], BINS) for j in range(x.shape[1])]
    coarse = [_bounds(x[:, j], COARSE) for j in range(x.shape[1])]
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Model(tuple(features), bounds, coarse, float(np.log(share / (1 - share))), [np.zeros(len(b) + 1) for b in bounds])
    if not len(y) or y.min() == y.max():
        return model
    at = [np.searchsorted(b, x[:, j], side="right") for j, b in enumerate(bounds)]
    by = [np.searchsorted(b, x[:, j], side="right") for j, b in enumerate(coarse)]
    f = np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = residual()
            step = shallow_tree(np.bincount(at[j], g, len(t)), np.bincount(at[j], h, len(t)), rate)
            t += step
            f += step[at[j]]
    g, h = residual()
    gains = []
    for i, j in combinations(range(len(bounds)), 2):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        gains.append((pair_tree(_pair_sums(by[i], by[j], shape, g), _pair_sums(by[i], by[j], shape, h), rate)[0], i, j))
    for _, i, j in sorted(gains, reverse=True)[:most_pairs]:
        model.pairs.append((i, j))
        model.pair_tables.append(np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)))
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            g, h = residual()
            step = pair_tree(_pair_sums(by[i], by[j], t.shape, g), _pair_sums(by[i], by[j], t.shape, h), rate)[1]
            t += step
            f += step[by[i], by[j]]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the CRC-32 of doc_id as text leaves the held-out remainder; false without a doc_id."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % PARTS == HELD_OUT_PART, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, **how) -> Model:
    """The model of quality from a bounded sample of the labelled rows that are not held out."""
    frame = labelled_statistics(docs, labels.where(~held_out()), most)
    return fit_gam(frame[list(FEATURES)].to_numpy(float), frame["quality"].to_numpy(float), FEATURES, **how)


def score_quality(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`df` with score (0 to 1) and predicted (1 from the threshold up).

    Null and empty texts are scored like any other, by statistics of zero. Columns named like a
    new one are replaced. No shuffle.
    """
    names = list(model.features)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns], 1)
            yield pa.array(model.score(x), pa.float64())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    numbers = with_statistics(df.select(F.struct("*").alias("_row"), F.col(f"`{text}`").alias("_text")), "_text")
    scored = numbers.select("_row", F.arrow_udf("double")(run)(*[F.col(n).cast("double") for n in names]).alias("_score"))
    made = F.struct(F.col("_score").alias("score"), F.when(F.col("_score") >= threshold, 1).otherwise(0).alias("predicted"))
    flat = scored.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], made.alias("_made"))
    return with_struct(flat, F.col("_made"), ["score", "predicted"]).drop("_made")


def op7_quality_gam(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, load(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
