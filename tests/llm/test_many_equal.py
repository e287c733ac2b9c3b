"""Many equal rows, long runs of numbers, and a choice that does not hang on the surrogates' key."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from quillstone.llm import mixing, pii, suffixes
from quillstone.llm.common import load
from tests.llm.test_operators import plain_repeats, words


def test_lists_of_spans_do_not_grow_with_equal_rows(spark):
    text = words(1, 300)
    sizes = {}
    for copies in (20, 5000):
        df = spark.createDataFrame([(7, text)], "doc_id long, text string").select("*", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("col")
        sizes[copies] = [len(r.spans) for r in suffixes.span_sets(suffixes.repeated_spans(suffixes.keyed(df))).collect()]
    assert sizes[20] == sizes[5000] and len(sizes[20]) == 1
    out = suffixes.remove_repeats(df).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in out] == [(len(text), len(text), 1, 5000)]


def test_equal_rows_among_others(spark):
    r = random.Random(6)
    texts = [words(9, 120)] * 60 + [words(r.randint(0, 9), 60) for _ in range(30)] + ["", words(9, 120) + " tail"]
    df = spark.createDataFrame([(i // 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(tuple(x)[1:] for x in suffixes.remove_repeats(df, length=80, zone=40).collect())
    assert got == sorted(plain_repeats([t.encode() for t in texts], 80))


@pytest.mark.parametrize("one", ["123-45-6789 ", "10.1.2.3 ", "4111 1111 1111 1111 ", "(555) 123-4567 "])
def test_long_runs_of_numbers_take_linear_time(one):
    pii.detect(one * 10)
    began = time.perf_counter()
    found = pii.detect(one * 200_000)
    assert len(found) > 100_000 and time.perf_counter() - began < 12


def test_finds_of_a_run_do_not_overlap():
    r = random.Random(4)
    parts = ["123-45-6789", "10.1.2.3", "4111 1111 1111 1111", "(555) 123-4567", "+49 30 1234 5678", "12345", "-", " ", ".", "999.1.1.1"]
    for _ in range(2000):
        spans = [s[0] for _, _, s in pii.detect("".join(r.choice(parts) + r.choice(["", " "]) for _ in range(12)))]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_the_key_does_not_change_which_documents_are_mixed(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    chosen = []
    for key in ("one key", "another"):
        new = pii.replace_entities(docs, key).select(*docs.columns)
        chosen.append(sorted((r.doc_id, r.epoch) for r in mixing.mix_documents(new, place_by=["doc_id"]).select("doc_id", "epoch").collect()))
    assert chosen[0] == chosen[1] and chosen[0]
