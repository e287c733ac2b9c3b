"""Long and adversarial inputs, recall of planted strings, and small cases at the edges."""

from __future__ import annotations

import random
import string
import time

import pytest
from pyspark.sql import functions as F

from quillstone.llm import decontam, secrets, suffixes, urls
from tests.llm.test_operators import plain_repeats, words

LONG = ("a" * 100_000 + "1a", "aB" * 50_000, "A" * 100_000, "Ab1" * 33_000, "1a" * 50_000, "-" * 100_000, "x." * 50_000, "token" * 20_000, "token " + " " * 100_000, "AKIA" * 25_000)


@pytest.mark.parametrize("n", range(len(LONG)))
def test_long_strings_are_scanned_in_linear_time(n):
    scan = secrets.scanner()
    scan("warm up qZ7xK2mPv9LrT4wYbN8sD3hJ")
    begin = time.perf_counter()
    scan(f"{LONG[n]} {LONG[n]}")
    assert time.perf_counter() - begin < 2


def test_many_candidates_beside_many_fixed_spans():
    text = " ".join(f"password={i:06d}x see abcdefgh{i:06d}qZ7xK2mPv9" for i in range(20_000))
    begin = time.perf_counter()
    found = secrets.scanner()(text)
    assert found[0] == 20_000 and found[3] > 15_000 and time.perf_counter() - begin < 20


@pytest.mark.parametrize(
    ("letters", "sizes"),
    [
        (string.ascii_letters + string.digits, (12, 16, 20, 24, 32, 40)),
        (string.ascii_lowercase + string.digits, (12, 16, 20, 24, 32, 40)),
        (string.ascii_letters + string.digits + "+/", (16, 24, 44)),
        (string.ascii_letters, (20, 24, 32, 40)),
        (string.ascii_lowercase, (20, 24, 32)),
        (string.ascii_uppercase, (20, 24, 32)),
    ],
)
def test_recall_of_planted_random_strings(letters, sizes):
    r, scan = random.Random(7), secrets.scanner()
    for size in sizes:
        planted = ["".join(r.choice(letters) for _ in range(size)) for _ in range(400)]
        found = sum(scan(f"the value is {s} and no more")[3] or sum(scan(f"the value is {s} and")[:3]) for s in planted)
        assert found >= 0.9 * len(planted), (letters, size)


def test_identifiers_and_short_words_are_left_alone():
    scan = secrets.scanner()
    for s in ("getUserByName", "parse_http_response", "MyClassName2", "test-case-12", "README.md", "user_name_list_v2", "2024-01-01T12", "donaudampfschiff", "SOME_CONSTANT_NAME", "module.function_name"):
        assert scan(f"see {s} here")[3] == 0, s


def test_hosts_of_many_labels_make_no_more_rows(spark):
    hosts = [".".join(["a"] * 20_000) + ".example.com", "a" * 50_000 + ".org", ".".join("b" * 5000) + "."]
    df = spark.createDataFrame([(i, f"http://{h}/en/7") for i, h in enumerate(hosts)], "page_id long, url string")
    begin = time.perf_counter()
    got = {r.page_id: r.rule for r in urls.judge_urls(df, keep=["page_id"]).collect()}
    assert got == {0: "example.com/en/7", 1: None, 2: None} and time.perf_counter() - begin < 20


def test_rules_of_three_labels_and_of_one(spark):
    rules = [urls.Rule("block", "a.b.c", ""), urls.Rule("allow", "c", "/x"), urls.Rule("block", "b.c", "/x/y")]
    cases = {"http://a.b.c/": "a.b.c", "http://z.a.b.c/x": "a.b.c", "http://b.c/x/yz": "b.c/x/y", "http://b.c/x": "c/x", "http://c/": None, "http://xa.b.c/x/y": "b.c/x/y"}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: r.rule for r in urls.judge_urls(df, rules, keep=["url"]).collect()} == cases


def test_short_items_mark_texts_that_are_equal_to_them(spark):
    docs = spark.createDataFrame([(1, " FORTY \n two"), (2, "it is forty two, he said"), (3, ""), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "forty two"), (8, ""), (9, " ")], "item_id long, text string")
    found = decontam.find_contamination(docs, items).collect()
    assert [tuple(r) for r in found] == [(1, 7, 0, 9)]
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, items).collect()) == [2, 3, 4]


def test_runs_repeated_very_often_go_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HEAVY_ROWS", 5)
    monkeypatch.setattr(suffixes, "HEAVY_KINDS", 50)
    r = random.Random(4)
    texts = ["q" * 150] * 40 + [words(r.randint(0, 30), 30) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(tuple(x) for x in suffixes.remove_repeats(df, length=60, zone=30).collect())
    assert [g[1:] for g in got] == plain_repeats([t.encode() for t in texts], 60)


def test_the_query_returns_what_is_left(spark, sf_dir):
    out = suffixes.op5_repeats(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("old")), "doc_id").toPandas()
    untouched = out[out.n_removed == 0]
    assert (untouched.text == untouched.old).all() and (out[out.n_removed == out.n_bytes].text == "").all()
    left = out.text.map(lambda t: len(t.encode()))
    assert ((left >= out.n_bytes - out.n_removed) & (left <= out.n_bytes - out.n_removed + 6 * out.n_spans)).all()
