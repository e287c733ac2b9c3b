"""Near copies against brute-force Jaccard."""

from __future__ import annotations

import random
from math import comb

import numpy as np
import pytest

import corpus_pipeline
from quillstone.llm import nearcopies, simhash


def plain_kept(rows: list[tuple[int, str]]) -> set[int]:
    """The smallest doc_id of each class that pairs of a five-word Jaccard of 0.8 or more make."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    up = {i: i for i in sets}

    def root(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i for i in up if up[i] == i}


def planted(seed: int) -> list[tuple[int, str]]:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    line = " ".join(word() for _ in range(12))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(r.choice((6, 12, 60, 200)))]
        for _ in range(8):  # similarities around the limit
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = word()
            texts.append(" ".join(w[: len(w) - r.randint(0, len(w) // 8)]))
        texts.append(line + " " + " ".join(word() for _ in range(30)))  # a common line
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "block"), [(1, nearcopies.BLOCK), (2, 5)])
def test_near_copies_equal_brute_force(spark, seed, block):
    rows = planted(seed)
    want = plain_kept(rows)
    got = {r.doc_id for r in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert got == want and 12 < len(want) < len(rows)


def test_the_stage_merges_pairs_that_fingerprints_of_four_bits_miss(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text rlike '[^ ]'")
    got = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).collect()}
    assert got == plain_kept([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("block", [nearcopies.BLOCK, 7])
def test_candidates_come_from_cells_of_segment_counts_alone(spark, block):
    draw = np.random.default_rng(3)
    rows, near = [], set()
    for i in range(60):  # fingerprints of no text: each with one that differs in a sixth of its bits
        bits = draw.integers(0, 2, 64 * nearcopies.WORDS, dtype=np.uint8)
        for k, b in enumerate((bits, bits ^ (draw.random(len(bits)) < nearcopies.FLIP).astype(np.uint8))):
            rows.append((2 * i + k, 2 * i + k, 100, bytearray(np.packbits(b, bitorder="little").tobytes())))
        near.add((2 * i, 2 * i + 1))
    points = spark.createDataFrame(rows, "id long, label long, n int, words binary")
    for segments in (2, 5):
        got = nearcopies.candidate_pairs(points, nearcopies.choices_of(segments), block=block).collect()
        assert {tuple(r) for r in got} == near and len(got) == len(near)


def test_a_bit_differs_no_more_often_than_the_choices_allow_for():
    def tosses(n: int) -> np.ndarray:
        return np.array([comb(n, i) for i in range(n + 1)]) / 2.0**n

    for a in range(4, 60):  # shingles of the smaller set, all of which may be shared
        for b in range(a, 5 * a // 4 + 1):
            for both in range(-(-4 * (a + b) // 9), a + 1):
                x = np.array([tosses(a - both)[2 * (c + np.arange(a - both + 1)) > a].sum() for c in range(both + 1)])
                y = np.array([tosses(b - both)[2 * (c + np.arange(b - both + 1)) > b].sum() for c in range(both + 1)])
                flip = (tosses(both) * (x * (1 - y) + y * (1 - x))).sum()
                assert flip <= (nearcopies.FLIP_FEW if b <= nearcopies.FEW else nearcopies.FLIP)


def test_fingerprints_begin_with_that_of_operator_nine():
    for text in ("", "one", "a b c d e f g h", " ".join(map(str, range(700)))):
        words = np.frombuffer(nearcopies.described(text)[2], "<u8")
        assert len(words) == nearcopies.WORDS and int(words[:1].view("<i8")[0]) == simhash.fingerprint(text, nearcopies.SHINGLE)


def test_a_group_gives_no_row_for_each_of_its_pairs(spark, monkeypatch):
    r = random.Random(5)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(160):  # two words of each are its own: most pairs lie just under the limit
        w = list(base)
        for k in r.sample(range(150), 2):
            w[k] = f"x{i}"
        rows.append((i, " ".join(w)))
    made = []

    def counted(step):
        def run(*a, **k):
            made.append((out := step(*a, **k)).count())
            return out

        return run

    for name in ("candidate_pairs", "verified"):
        monkeypatch.setattr(nearcopies, name, counted(getattr(nearcopies, name)))
    got = {r.doc_id for r in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_kept(rows) and len(made) > 1 and max(made) < 3 * len(rows)


def test_blocks_of_a_cluster_meet_each_other(spark):
    r = random.Random(7)
    rows = [(i, " ".join(f"w{k}" for k in range(40)) + " " + " ".join(f"x{r.randrange(3)}" for _ in range(6))) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_kept(rows)
    for block in (None, 4):
        assert {r.doc_id for r in nearcopies.one_of_each(frame, block=block).collect()} == want


def test_shared_shingles_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(nearcopies, "COLUMNS", 7)
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.choice(24, draw.integers(0, 24)).astype("<u8")) for _ in range(80)]
    found = {(i, j) for i, j in zip(*(x.tolist() for x in nearcopies.similar_pairs(sets)), strict=True)}
    plain = [set(s.tolist()) for s in sets]
    assert found == {(i, j) for i in range(80) for j in range(i + 1, 80) if 5 * len(plain[i] & plain[j]) >= 4 * len(plain[i] | plain[j])}
