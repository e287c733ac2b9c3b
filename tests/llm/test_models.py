"""The additive model and the mixture against plain loops."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.llm import gam, mixing, tokens
from quillstone.llm.common import load
from tests.llm.test_operators import plain_budgets


def bin_of(bounds, v: float) -> int:
    return sum(v >= b for b in bounds)


def plain_cut(g: list[float], h: list[float]) -> int:
    """The cut of bins in two that gains most, 0 if none does."""
    best, at = 1e-9, 0
    whole = sum(g) ** 2 / (sum(h) + 1)
    for c in range(1, len(g)):
        gain = sum(g[:c]) ** 2 / (sum(h[:c]) + 1) + sum(g[c:]) ** 2 / (sum(h[c:]) + 1) - whole
        if gain > best + 1e-12:
            best, at = gain, c
    return at


def plain_model(x, y, bounds, rounds: int, rate: float) -> tuple[float, list[list[float]]]:
    share = min(max(sum(y) / len(y), 1e-3), 1 - 1e-3)
    intercept = math.log(share / (1 - share))
    tables = [[0.0] * (len(b) + 1) for b in bounds]
    for _ in range(rounds):
        for j, t in enumerate(tables):
            g, h = [0.0] * len(t), [0.0] * len(t)
            for row, label in zip(x, y, strict=True):
                f = intercept + sum(u[bin_of(b, v)] for u, b, v in zip(tables, bounds, row, strict=True))
                p = 1 / (1 + math.exp(-f))
                g[bin_of(bounds[j], row[j])] += label - p
                h[bin_of(bounds[j], row[j])] += p * (1 - p)
            cut = plain_cut(g, h)
            for a, b in [(0, cut), (cut, len(g))] if cut else [(0, len(g))]:
                c = plain_cut(g[a:b], h[a:b])
                for s, e in ((a, a + c), (a + c, b)) if c else ((a, b),):
                    for i in range(s, e):
                        t[i] += rate * sum(g[s:e]) / (sum(h[s:e]) + 1)
    return intercept, tables


def test_boosting_equals_plain_loops():
    r = np.random.default_rng(5)
    x = r.random((120, 2)).round(2)
    y = ((x[:, 0] > 0.4) & (x[:, 1] < 0.7) | (r.random(120) < 0.1)).astype(float)
    model = gam.fit_gam(x, y, ["a", "b"], rounds=6, most_pairs=0)
    intercept, tables = plain_model(x.tolist(), y.tolist(), [b.tolist() for b in model.bounds], 6, 0.15)
    assert model.intercept == pytest.approx(intercept)
    for got, want in zip(model.tables, tables, strict=True):
        assert got.tolist() == pytest.approx(want, abs=1e-9)


def test_pair_cuts_equal_plain_loops_and_scores_are_sums():
    r = np.random.default_rng(6)
    g, h = r.normal(size=(5, 4)), r.random((5, 4))
    gain, out = gam.pair_tree(g, h, 0.5)
    best = (0.0, None)
    for p in range(1, 5):
        for q in range(1, 4):
            parts = [(slice(a, b), slice(s, e)) for a, b in ((0, p), (p, 5)) for s, e in ((0, q), (q, 4))]
            own = sum(g[x].sum() ** 2 / (h[x].sum() + 1) for x in parts) - g.sum() ** 2 / (h.sum() + 1)
            if own > best[0] + 1e-9:
                best = (own, parts)
    assert gain == pytest.approx(best[0])
    for x in best[1]:
        assert np.allclose(out[x], 0.5 * g[x].sum() / (h[x].sum() + 1))
    x = r.random((60, 3))
    model = gam.fit_gam(x, (x[:, 0] > x[:, 1]).astype(float), ["a", "b", "c"], rounds=4, most_pairs=2, pair_rounds=3)
    for row, got in zip(x, model.logit(x), strict=True):
        want = model.intercept + sum(t[bin_of(b, v)] for t, b, v in zip(model.tables, model.bounds, row, strict=True))
        want += sum(t[bin_of(model.coarse[i], row[i])][bin_of(model.coarse[j], row[j])] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert got == pytest.approx(want)


@pytest.mark.parametrize(("share", "counter"), [(0.3, "words"), (0.9, "words"), (1.4, "words"), (0.5, "tokens")])
def test_chosen_rows_equal_filling_by_hand(spark, sf_dir, share, counter):
    """Whole epochs, then the rows first in the seeded order that stay within the leaf's budget."""
    docs = load(spark, sf_dir, "documents").withColumn("domain", mixing.domain_of())
    count = tokens.token_count if counter == "tokens" else mixing.word_count
    got = sorted((r.doc_id, r.epoch, r.n_tokens) for r in mixing.mix_documents(docs.drop("domain"), share=share, count=count).collect())
    key = F.xxhash64("doc_id", "text")
    places = [mixing._place(17, F.lit(e).cast("int"), key).alias(f"p{e}") for e in range(3)]
    rows = docs.select("doc_id", "domain", "lang", "source", count(F.col("text")).alias("n"), *places).collect()
    leaves: dict[tuple, list] = {}
    for r in rows:
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    sizes = {k: sum(r.n for r in v) for k, v in leaves.items()}
    tree: dict = {}
    for d, lang, s in sizes:
        tree.setdefault(d, {}).setdefault(lang, {})[s] = 1
    weights = {0: mixing.WEIGHTS["domain"], 1: mixing.WEIGHTS["lang"]}
    budgets = plain_budgets(tree, {k: 2 * v for k, v in sizes.items()}, weights, share * sum(sizes.values()))
    want = []
    for k, rs in leaves.items():
        whole = math.floor(budgets[k] / sizes[k] + 1e-9) if sizes[k] else 0
        left, used = budgets[k] - whole * sizes[k], 0
        want += [(r.doc_id, e, r.n) for e in range(whole) for r in rs]
        if left > 1e-6:
            for r in sorted(rs, key=lambda r: r[f"p{whole}"]):
                used += r.n
                if used > left + 1e-6:
                    break
                want.append((r.doc_id, whole, r.n))
    assert got == sorted(want)
