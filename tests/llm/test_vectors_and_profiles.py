"""Centroid clustering, divergence of sources and document fingerprints, against SQL or brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillstone.llm import clusters, divergence, oneperm
from tests.llm.test_operators import DOCS, words
from tests.oracle import differences

VECS = "vec_id long, embedding array<float>, label int"


# 11 centroids


def plain_clusters(rows, dims, k, rounds, seed="2"):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        for n, vs in held.items():
            cs[n] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()) for i, c, d in found), key=repr)


def test_centroids_agree_with_sql(spark, sf_dir):
    assert differences(spark, sf_dir, clusters.op11_centroids, clusters.OP11_SQL) == ""


def test_centroids_of_odd_rows(spark):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(7, rows[7][1])] * 40  # repeated rows
    rows += [(None, [0.5, 0.5, -0.5, 0.25]), (None, [0.1] * 4), (100, None), (101, []), (102, [1.0] * 3), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan")] * 4), (105, [float("inf")] * 4), (106, [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS).repartition(5).withColumn("cluster", F.lit("x")).withColumn("DISTANCE", F.lit(1))
    got = clusters.cluster_vectors(df, dims=4, k=6, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, 4, 6, 3)


def test_centroids_of_few_equal_large_and_no_vectors(spark):
    few = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [-0.001, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in few], VECS)
    assert sorted(map(tuple, clusters.cluster_vectors(df, dims=2, k=5, rounds=2).collect()), key=repr) == plain_clusters(few, 2, 5, 2)
    large = spark.createDataFrame([(1, [3e38] * 64, 0), (2, [-3e38] * 64, 0)], VECS)
    assert [r.distance for r in clusters.cluster_vectors(large, k=1, rounds=0).orderBy("distance").collect()] == [0, 64 * (2 * clusters.BOUND) ** 2]
    assert clusters.cluster_vectors(df.where("vec_id > 9"), dims=2).collect() == []


def test_centroids_are_literals_and_sums_are_combined_before_the_shuffle(spark, sf_dir):
    vectors = clusters.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    near = vectors.select(clusters.nearest(F.col("v"), [[0] * 64, [1] * 64])["cluster"].alias("c")).groupBy("c").count()
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "partial_count" in plan


# 12 divergence


def plain_divergence(rows, least=3, top=200):
    docs = [(lang or "", source or "", re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        groups = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}

        def shares(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        for s, c in groups.items():
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in groups if o != s]
            found = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", found)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def test_divergence_agrees_with_sql(spark, sf_dir):
    assert differences(spark, sf_dir, divergence.op12_divergence, divergence.OP12_SQL) == ""


@pytest.mark.parametrize("block", [3, 40, 100_000])
def test_divergence_of_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "PRODUCTS", block)
    monkeypatch.setattr(divergence, "HELD", block)
    r = random.Random(block)
    texts = [" ".join(r.choice(["a", "B", "b", "ünï", "K", "x1y", "日本", "c d", "", "E-f"]) for _ in range(r.randint(0, 12))) for _ in range(80)]
    rows = [(t, r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "s3", None])) for t in texts]
    rows += [(None, "en", "silent"), ("", "fr", "one"), (None, "fr", "two"), ("q q q", "es", "alone"), ("q", "es", "alone"), ("q", "es", "alone"), ("a " * 3000, "en", "hot")] + [("a b c", "en", "hot")] * 50
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, lang string, source string").withColumn("part", F.lit(1)).withColumn("VALUE", F.lit(2)).repartition(6)
    assert sorted(map(tuple, divergence.divergence_audit(df).collect())) == plain_divergence(rows)


def test_divergence_of_an_empty_table(spark):
    assert divergence.divergence_audit(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_are_exact_for_large_counts():
    n = 4 * 10**12
    of = divergence.Lang(["a", "b"], {"a": 0, "b": 1}, np.array([n, 7], np.int64), 10**7)
    for c in (0, 1, 10**6, n - 5, n):
        assert of.shares(np.array([c]), np.array([0]))[0] == 1 + 10**9 * (c + 1) // (n + 10**7)


# 13 fingerprints


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<i" if isinstance(v, np.int32) else "<q", v), seed)
    return seed


def plain_digits(text, words=5, bins=128, bits=4):
    ws = [_signed(_chain([w.encode()])) for w in re.findall(r"[^\x20\x09-\x0D]+", text) or [""]]
    shingles = [ws] if len(ws) < words else [ws[i : i + words] for i in range(len(ws) - words + 1)]
    held = {}
    for h in map(_chain, shingles):
        b = h >> (64 - bins.bit_length() + 1)
        held[b] = min(held.get(b, h), h)
    out = []
    for b in range(bins):
        tried = [b, *(_chain([np.int32(b), np.int32(k)]) % bins for k in range(oneperm.ATTEMPTS))]
        places = {j: n for n, j in enumerate(sorted(held))}
        rest = sorted(held, key=lambda j: _signed(_chain([np.int32(b), np.int32(j)]) & ~255 | places[j]))
        value = next(held[j] for j in [*tried, *rest] if j in held)
        out.append(_chain([_signed(value), np.int32(b)]) % 2**bits)
    return out


def plain_likeness(a, b, bits=4):
    same = sum(x == y for x, y in zip(a, b, strict=True)) / len(a)
    return max(0.0, (same - 2.0**-bits) / (1 - 2.0**-bits))


def edited(text, following):
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def check_prints(rows, df):
    got = df.collect()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    texts = [rows[i][1] or "" for i in order]
    assert len({rows[i][0] for i in order}) == len(rows)
    want = {}
    for n, i in enumerate(order):
        text, following = texts[n], texts[(n + 1) % len(texts)]
        new = edited(text, following)
        d, e, f = map(plain_digits, (text, new, following))
        want[rows[i][0]] = (len(text), hashlib.sha256(new.encode()).hexdigest(), "".join(f"{x:x}" for x in d), "".join(f"{x:x}" for x in e), round(plain_likeness(d, e), 9), round(plain_likeness(d, f), 9))
    as_row = lambda r: (r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest(), r.fp, r.ep, round(r.near_edited, 9), round(r.near_next, 9))
    assert {r.doc_id: as_row(r) for r in got} == want and len(got) == len(rows)


def prints(df):
    return oneperm.edited_fingerprints(df).withColumn("fp", oneperm.as_hex(F.col("fingerprint"))).withColumn("ep", oneperm.as_hex(F.col("edited_fingerprint")))


def test_fingerprints_of_the_given_texts(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 6000")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check_prints(rows, prints(df.repartition(7)))


def test_fingerprints_of_odd_rows(spark):
    long = words(5, 30_000)
    texts = ["", None, " \n\t", "one", "one two three four", "one two three four five", "　ideographic　space", "é\U0001f642" * 40, long, long, words(1, 200), words(1, 200) + " more", "x" * 50_000]
    rows = [(i * 10**17 - 5 * 10**17, t) for i, t in enumerate(texts)] + [(None, "no id at all here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit(1)).withColumn("RANGE", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    check_prints(rows, prints(df.repartition(3)))
    by = {r.doc_id: r for r in prints(df).collect()}
    empty = [by[i] for i, t in rows if not (t or "").split()]
    assert len({r.fp for r in empty}) == 1 and by[rows[0][0]].near_next == 1.0


def test_fingerprints_of_repeated_rows_one_row_and_none(spark):
    text = words(3, 60)
    df = spark.createDataFrame([(1, text)] * 30 + [(2, words(4, 60))], "doc_id long, text string").repartition(6)
    got = prints(df).collect()
    assert len(got) == 31 and sum(r.near_next == 1.0 for r in got) == 29 and len({r.fp for r in got}) == 2
    one = prints(df.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_text == edited(words(4, 60), words(4, 60))
    assert prints(df.where("doc_id > 9")).collect() == []


def test_likeness_follows_the_jaccard_similarity(spark):
    r, rows, want = random.Random(9), [], []
    for n in range(150):
        a, share = [f"w{r.randrange(10**6)}" for _ in range(400)], r.random()
        b = a[: int(400 * share)] + [f"v{r.randrange(10**6)}" for _ in range(400 - int(400 * share))]
        sets = [{tuple(x[i : i + 5]) for i in range(396)} for x in (a, b)]
        want.append(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        rows.append((n, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "n long, a string, b string").select("n", oneperm.likeness(oneperm.fingerprint(F.col("a")), oneperm.fingerprint(F.col("b"))).alias("x"))
    gaps = np.array([x.x for x in df.orderBy("n").collect()]) - np.array(want)
    assert abs(gaps.mean()) < 0.015 and gaps.std() < 0.06


def test_short_texts_that_differ_are_not_alike(spark):
    rows = [(f"word{i}", f"other{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "a string, b string").select(oneperm.likeness(oneperm.fingerprint(F.col("a")), oneperm.fingerprint(F.col("b"))).alias("x"))
    assert max(r.x for r in df.collect()) < 0.15


def test_no_python_and_one_shuffle_of_texts(spark, sf_dir):
    plan = oneperm.op13_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
