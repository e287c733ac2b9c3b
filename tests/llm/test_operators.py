"""The corpus operators against brute force, on small tables with nulls, ties, repeats, long texts and odd columns."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstone.llm import decontam, gam, mixing, pii, rules, secrets, simhash, suffixes, tokens, urls
from quillstone.llm.common import load
from tests.oracle import differences

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text."""
    long = words(1, 60_000)
    rows = [
        (1, "", "en", "src1", 0),
        (2, None, None, None, None),
        (None, words(2, 80), "en", "src2", 3),
        (4, words(2, 80), "en", "src2", 3),
        (4, words(2, 80), "en", "src2", 3),
        (5, " \n\t ", "de", "src3", 3),
        (6, long, "fr", "src0", len(long)),
        (7, words(3, 90) + "\u00e9\U0001f642", "en", "src0", 9),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# 1 token counts


def test_tokens_equal_the_library(spark, sf_dir):
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=tokens.default_model())
    r = random.Random(5)
    chars = "  ▁▁\n\tabcthe日é́\x00ﬁ<s>🙂x12 \r  .,'’-"
    texts = ["".join(r.choice(chars) for _ in range(r.randint(0, 50))) for _ in range(3000)]
    texts += [t for (t,) in load(spark, sf_dir, "documents").select("text").collect()]
    count = tokens.counter()
    assert [count(t) for t in texts] == [len(p.encode(t)) for t in texts]


def test_tokens_of_odd_rows(odd, none):
    out = tokens.count_tokens(odd.withColumn("N_TOKENS", F.lit("x")))
    assert out.columns.count("n_tokens") == 1 and out.count() == odd.count()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in out.where("doc_id in (1, 2, 6)").collect()}
    assert got[1] == got[2] == (0, 0, False) and got[6][2]
    assert tokens.count_tokens(none).count() == 0


def test_a_word_longer_than_the_table_takes():
    count = tokens.counter()
    assert count("the" * 500) > 0


# 2 secrets

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_spans(text: str) -> list[str]:
    found = [(m.start(), 0, m.end()) for m in re.finditer(_ASSIGN, text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_base_spans_equal_plain_patterns(spark, sf_dir):
    r = random.Random(3)
    parts = ["token", "TOKEN", "to\u212aen", "passwd", "api_key", "APIKEY", "secret", ":", "=", " ", '"', "'", "abc123", "abcdef", "AKIA", "ABCDEFGH12345678", "é", "deadbeef0123", "x", "\n", "-"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    texts += [t for (t,) in load(spark, sf_dir, "documents").select("text").collect()]
    scan = secrets.scanner()
    for t in texts:
        want, got = plain_spans(t), scan(t)
        assert got[4] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[5].split(",") if got[5] else [])
        assert got[:3] == tuple(sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex"))


def test_random_strings_stand_out_and_known_ones_do_not():
    scan = secrets.scanner()
    key = "qZ7xK2mPv9LrT4wYbN8sD3hJ"
    assert "random:4:28" in scan(f"see {key} there")[5]
    for known in (hashlib.sha1(b"x").hexdigest().upper(), "123e4567-e89b-12d3-a456-426614174000", "my_long_identifier_name_here", "TheseAreWordsInCamelCase", "2024-01-01.12345678901234", "a" * 30):
        assert "random" not in scan(f"see {known} there")[5]


def test_secrets_of_odd_rows(odd, none):
    out = secrets.scan_secrets(odd)
    empty = out.where("doc_id = 2").first()
    assert (empty.n_assign, empty.base_sha256, empty.spans) == (0, hashlib.sha256(b"").hexdigest(), "")
    assert out.count() == odd.count() and secrets.scan_secrets(none).count() == 0


# 3 quality rules


def plain_statistics(text: str) -> tuple:
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen: dict[tuple, list[int]] = {}
    for i in range(len(ws) - 2):
        seen.setdefault(tuple(ws[i : i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_plain_ones(spark, sf_dir):
    r = random.Random(2)
    texts = ["".join(r.choice(["a", "b ", " ", "\n", "#", "é", "\u3000", "\x1c", "\x85", "a b c "]) for _ in range(r.randint(0, 40))) for _ in range(2000)]
    texts += [t for (t,) in load(spark, sf_dir, "documents").select("text").collect()]
    for t in texts:
        assert rules.text_statistics(t)[:5] == plain_statistics(t)


def test_a_decision_list_finds_planted_thresholds():
    r = np.random.default_rng(1)
    x = r.random((3000, 3))
    bad = (x[:, 0] > 0.8) | ((x[:, 1] > 0.6) & (x[:, 2] < 0.3))
    found = rules.learn_rules(x, bad, ["a", "b", "c"])
    hit = np.zeros(len(x), bool)
    for rule in found:
        hit |= rules.covered(rule, x, ["a", "b", "c"])
    assert (hit == bad).mean() > 0.97
    assert rules.learn_rules(x, np.zeros(len(x), bool), ["a", "b", "c"]) == []
    assert rules.learn_rules(x[:0], bad[:0], ["a", "b", "c"]) == []


def test_the_rules_expression_equals_the_rules_in_order(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    made = [(rules.Condition("n_words", False, 100.0),), (rules.Condition("mean_word", True, 4.0), rules.Condition("n_words", False, 500.0))]
    for r in rules.apply_rules(docs, made).collect():
        want = 1 if r.n_words < 100 else 2 if r.mean_word >= 4 and r.n_words < 500 else None
        assert r.rule_no == want and r.kept == (want is None and not r.base_failed)


def test_rules_of_odd_rows_and_empty_tables(spark, odd, none, sf_dir):
    labels = load(spark, sf_dir, "labels")
    out = rules.quality_rules(odd.withColumn("kept", F.lit(1)), labels)
    assert out.count() == odd.count() and not out.where("doc_id = 2").first().kept
    assert rules.quality_rules(none, labels.limit(0)).count() == 0


def test_held_out_quality_of_the_rules(spark):
    docs, labels = load(spark, "/root/testdata/sf0.01", "documents"), load(spark, "/root/testdata/sf0.01", "labels")
    judged = rules.quality_rules(docs, labels).join(labels, "doc_id").toPandas()
    asked = judged[~judged.base_failed]
    assert (asked.kept == (asked.quality == 1)).mean() > 0.97


# 4 surrogates


def test_surrogates_keep_type_script_and_punctuation():
    rewrite = pii.replacer("k")
    text = "Frau Anna Kowal (Άννα Παππά) a.b@c-d.co.uk +1 (017) 555-7713, 10.2.3.4 4111 1111 1111 1111 SHTI.06@MAIL5.EXAMPLE.COM!!"
    new, n, spans = rewrite(text)
    assert n == 7 and spans.startswith("name:5:15")
    assert re.fullmatch(r"Frau [A-Z][a-z]+ [A-Z][a-z]+ \(\S+ \S+\) \w\.\w@\w-\w\.\w\w\.uk \+\d \(\d{3}\) \d{3}-\d{4}, [\d.]+ \d{4} \d{4} \d{4} \d{4} [A-Z]{4}\.\d\d@[A-Z]{4}\d\.EXAMPLE\.COM!!", new), new
    assert new.split("Frau ")[1].split()[0] in pii.GIVEN["latin", "f"]
    assert new.split("(")[1].split()[0] in pii.GIVEN["greek", "f"]
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", new).group().replace(" ", "")
    assert pii.luhn(card)
    for old in ("Kowal", "a.b@c-d", "555-7713", "10.2.3.4", "4111 1111", "SHTI.06"):
        assert old not in new


def test_one_entity_one_surrogate_whatever_its_spelling():
    rewrite = pii.replacer("k")
    a, b = rewrite("+1 (017) 555-7713")[0], rewrite("+1 017 555 7713")[0]
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert rewrite("X.Y@Z.ORG")[0].lower() == rewrite("x.y@z.org")[0]
    assert rewrite("x.y@z.org")[0] != pii.replacer("other")("x.y@z.org")[0]


@pytest.mark.parametrize("size", [2, 7, 100, 1000])
def test_permutations_are_permutations(size):
    assert sorted(pii.permute(i, size, b"k") for i in range(size)) == list(range(size))


def test_short_emails_stay_distinct_and_all_change(spark):
    texts = [f"mail {a}{b}@{c}.org now" for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789" for c in ("qq", "zz")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = [r.text for r in pii.replace_entities(df, "k").orderBy("doc_id").collect()]
    assert len(set(out)) == len(texts) and all(a != b for a, b in zip(out, texts, strict=True))


def test_surrogates_of_odd_rows(odd, none):
    out = pii.replace_entities(odd.withColumn("entities", F.lit(1)), "k")
    assert out.where("doc_id = 2").first().text is None
    same = {(r.doc_id, r.text) for r in out.collect()}
    assert same == {(r.doc_id, r.text) for r in odd.collect()}
    assert pii.replace_entities(none, "k").count() == 0


def test_documents_change_where_they_hold_entities_only(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    out = pii.replace_entities(docs.select("doc_id", "text"), "k").toPandas().merge(docs.select("doc_id", F.col("text").alias("old")).toPandas(), on="doc_id")
    assert ((out.text != out.old) == (out.n_entities > 0)).all() and (out.n_entities > 0).any()
    pattern = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)")
    for old, new in zip(out.old, out.text, strict=True):
        assert not [m for m in pattern.findall(old) if m in new]


# 5 repeats


def plain_repeats(texts: list[bytes], length: int) -> list[tuple]:
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats_equal_brute_force(spark, seed):
    r = random.Random(seed)
    shared = [words(100 + i, 12) for i in range(4)] + ["ab" * 50, "z" * 90, "é" * 40]
    texts = [" ".join(r.choice([words(r.randint(0, 10**6), 5), r.choice(shared)]) for _ in range(r.randint(0, 8))) for _ in range(60)]
    texts += ["", "q" * 200, "q" * 200, texts[0], "ab" * 60]
    length, zone = 60, 30
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(tuple(x) for x in suffixes.remove_repeats(df, length=length, zone=zone).collect())
    assert [g[1:] for g in got] == plain_repeats([t.encode() for t in texts], length)


def test_repeats_of_odd_rows(spark, odd, none):
    got = {(r.doc_id, r.n_bytes): r for r in suffixes.remove_repeats(odd.withColumn("k1", F.lit(1))).collect()}
    assert got[2, 0].kept_sha256 == hashlib.sha256(b"").hexdigest() and got[1, 0].n_removed == 0
    twice = [r for r in suffixes.remove_repeats(odd).collect() if r.doc_id == 4]
    assert len(twice) == 2 and all(r.n_removed == r.n_bytes > 0 and r.n_spans == 1 for r in twice)
    assert suffixes.remove_repeats(none).count() == 0


def test_kept_bytes_are_returned(spark):
    df = spark.createDataFrame([(1, "x" * 399), (2, "y" * 500)], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(df, with_text=True).collect()}
    assert got == {1: b"x" * 399, 2: b""}  # the second repeats within itself


# 6 decontamination


def plain_distance(pattern: str, text: str) -> int:
    last = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        row = [i]
        for j, c in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != c)))
        last = row
    return min(last)


def test_bit_parallel_distance_equals_dynamic_programming():
    r = random.Random(4)
    for _ in range(300):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 90)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 60))) + p[: r.randint(0, len(p))]
        assert decontam.best_match(p, t)[0] == plain_distance(p, t)


def test_contamination_equals_brute_force(spark):
    r = random.Random(9)
    items = [words(i, 12) for i in range(6)]
    texts = [words(50, 30), ""]
    for item in items:
        for edits in (0, 2, 4, 9):
            chars = list(item)
            for _ in range(edits):
                chars[r.randrange(len(chars))] = r.choice("xyz")
            texts.append(f"{words(r.randint(0, 999), 9)} {''.join(chars).upper()} {words(r.randint(0, 999), 9)}".replace(" ", "\n ", 3))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "short"), (0, items[0])], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.distance for x in decontam.find_contamination(docs, bench).collect()}
    want = {}
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            d = plain_distance(item, decontam.normalised(t))
            if d <= decontam.budget(item, decontam.EDIT_RATE):
                want[i, j] = d
    assert got == want and 0 < len(want) < len(texts)
    blocks = {(x.doc_id, x.item_id): x.distance for x in decontam.find_contamination(docs, bench, block_chars=100).collect()}
    assert blocks == want
    kept = {x.doc_id for x in decontam.drop_contaminated(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}


def test_contamination_of_odd_rows(spark, odd, none, sf_dir):
    bench = load(spark, sf_dir, "benchmark")
    assert decontam.find_contamination(odd, bench).count() == 0
    assert decontam.find_contamination(odd, bench.limit(0)).count() == 0
    assert decontam.find_contamination(none, bench).count() == 0
    assert decontam.drop_contaminated(odd, bench).count() == odd.count()


# 7 additive model


def test_the_model_learns_a_feature_and_a_pair():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit_gam(x[:3000], y[:3000], ["a", "b", "c"])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert gam.fit_gam(x[:0], y[:0], ["a", "b", "c"]).score(x[:2]).tolist() == [0.5, 0.5]
    assert gam.fit_gam(x, np.ones(len(x)), ["a", "b", "c"]).score(x[:1])[0] > 0.99


def test_held_out_accuracy_and_division(spark):
    import zlib

    sf = "/root/testdata/sf0.01"
    out = gam.op7_quality_gam(spark, sf).toPandas()
    assert [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id] == out.held_out.tolist()
    both = out.merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = both[both.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97 and (held.predicted == held.quality).mean() > 0.95
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()


def test_scores_of_odd_rows(spark, odd, none, sf_dir):
    model = gam.fit_quality(odd, load(spark, sf_dir, "labels"))
    out = gam.score_quality(odd.withColumn("score", F.lit("x")).withColumn("n_words", F.lit("y")), model)
    assert out.count() == odd.count() and "n_words" in out.columns
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert gam.score_quality(none, model).count() == 0
    gam.fit_quality(none, load(spark, sf_dir, "labels").limit(0))


# 8 mixing


def plain_budgets(tree: dict, caps: dict, weights: dict, total: float, path: tuple = ()) -> dict:
    """Budgets of the leaves by filling siblings again and again."""
    if not isinstance(tree, dict):
        return {path: total}
    cap = {k: sum(v for p, v in caps.items() if p[: len(path) + 1] == (*path, k)) for k in tree}
    got, open_ones, left = dict.fromkeys(tree, 0.0), set(tree), total
    while open_ones and left > 1e-9:
        w = {k: weights.get(len(path), {}).get(k, 1.0) for k in open_ones}
        full = {k for k in open_ones if got[k] + left * w[k] / sum(w.values()) >= cap[k] - 1e-9}
        if not full:
            for k in open_ones:
                got[k] += left * w[k] / sum(w.values())
            break
        for k in full:
            left -= cap[k] - got[k]
            got[k] = cap[k]
        open_ones -= full
        left = total - sum(got.values())
    return {p: v for k in tree for p, v in plain_budgets(tree[k], caps, weights, got[k], (*path, k)).items()}


def test_budgets_equal_filling_by_hand(spark):
    r = random.Random(6)
    leaves = {(a, b): r.choice([5, 50, 500]) for a in "xyz" for b in "pqr"}
    weights = {0: {"x": 5.0, "y": 2.0}, 1: {"p": 3.0}}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "a string, b string, _tokens long")
    for share in (0.1, 0.5, 0.9, 1.5):
        rows = mixing.leaf_budgets(df, ["a", "b"], F.col("_all") * share, {"a": weights[0], "b": weights[1]}, 2).collect()
        tree = {a: {b: 1 for b in "pqr"} for a in "xyz"}
        want = plain_budgets(tree, {k: 2 * v for k, v in leaves.items()}, weights, share * sum(leaves.values()))
        for x in rows:
            assert x["_budget"] == pytest.approx(want[x.a, x.b], abs=1e-4)


def test_epochs_are_prefixes_within_budget(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    out = mixing.mix_documents(docs, share=1.2).toPandas()
    assert out.groupby(["doc_id", "epoch"]).size().max() == 1 and out.epoch.max() == 1
    again = mixing.mix_documents(docs.repartition(7), share=1.2).toPandas()
    assert sorted(zip(out.doc_id, out.epoch, strict=True)) == sorted(zip(again.doc_id, again.epoch, strict=True))
    total = sum(len(t.encode().split()) for (t,) in docs.select("text").collect())
    longest = out.n_tokens.max()
    assert 1.2 * total - longest * out.groupby(["domain", "lang", "source"]).ngroups <= out.n_tokens.sum() <= 1.2 * total
    first = set(out[out.epoch == 0].doc_id)
    assert set(out[out.epoch == 1].doc_id) <= first  # a second epoch starts after a whole first one


def test_mixing_odd_rows(spark, odd, none):
    out = mixing.mix_documents(odd.withColumn("epoch", F.lit("x")), share=2.0, epochs=2).toPandas()
    assert len(out[out.doc_id == 4]) == 4 and set(out.epoch) == {0, 1}
    assert mixing.mix_documents(none).count() == 0


def test_nothing_is_taken_of_an_empty_budget(spark, odd):
    assert mixing.mix_documents(odd, share=0.0).where("n_tokens > 0").count() == 0


# 9 near-duplicates


def plain_fingerprint(text: str) -> int:
    import xxhash

    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not ws:
        return 0
    parts = [" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids: list, prints: list[int], radius: int) -> list:
    forest = simhash.Forest(len(ids))
    x = np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x) <= radius).tolist():
            forest.join(i, j)
    roots = [forest.root(i) for i in range(len(ids))]
    least: dict[int, int] = {}
    for r, i in zip(roots, ids, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in roots]


def test_fingerprints_equal_plain_ones(spark, sf_dir):
    r = random.Random(8)
    texts = ["", " ", "one", "one TWO", "Ä B c D e", *("".join(r.choice(["Aa ", "b", " ", "\n", "\x1c", "É", "\u3000 "]) for _ in range(r.randint(0, 60))) for _ in range(500))]
    texts += [t for (t,) in load(spark, sf_dir, "documents").select("text").limit(50).collect()]
    for t in texts:
        assert simhash.fingerprint(t) & (1 << 64) - 1 == plain_fingerprint(t)


@pytest.mark.parametrize("block", [simhash.BLOCK, 5])
def test_components_equal_brute_force(spark, block):
    r = random.Random(11)
    prints = [r.getrandbits(64) for _ in range(60)]
    for p in list(prints[:20]):
        for _ in range(12):  # chains of near fingerprints
            for _ in range(r.randint(1, 6)):
                p ^= 1 << r.randrange(64)
            prints.append(p)
    prints += [0, 1, (1 << 64) - 1, prints[0]]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, fp long")
    roots = {x.fp: x.root for x in simhash.near_duplicate_classes(rows, block=block).collect()}
    want = plain_components(list(range(len(prints))), prints, 4)
    by_class: dict[int, set[int]] = {}
    for s, w in zip(signed, want, strict=True):
        by_class.setdefault(w, set()).add(roots[s])
    assert all(len(x) == 1 for x in by_class.values()) and len({next(iter(x)) for x in by_class.values()}) == len(by_class)


def test_the_embedding_never_exceeds_the_hamming_distance():
    r = np.random.default_rng(3)
    a, b = (r.integers(0, 1 << 64, 2000, dtype=np.uint64) for _ in range(2))
    d = simhash.embedding_distance(simhash.segment_counts(a), simhash.segment_counts(b))
    counts = [[(int(x) >> i & 1) + (int(x) >> i + 1 & 1) for i in range(0, 64, 2)] for x in (a[0], b[0])]
    assert d[0] == sum(abs(p - q) for p, q in zip(*counts, strict=True)) and (d <= np.bitwise_count(a ^ b)).all()


def test_near_duplicates_of_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    out = simhash.op9_simhash(spark, sf_dir).toPandas().sort_values("doc_id")
    texts = docs.orderBy("doc_id").select("text").toPandas().text
    prints = [plain_fingerprint(t) for t in texts]
    assert out.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    assert out.component_id.tolist() == plain_components(out.doc_id.tolist(), prints, 4)


def test_near_duplicates_of_odd_rows(spark, odd, none):
    out = simhash.near_duplicates(odd.withColumn("fp", F.lit("x")))
    got = {(r.doc_id, r.component_id) for r in out.collect()}
    assert out.count() == odd.count() and {(1, 1), (2, 1), (5, 1), (None, 1), (None, 4), (4, 4)} <= got
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7]
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0
    nameless = odd.where("doc_id is null")
    assert simhash.one_of_each(nameless.unionByName(nameless)).count() == 2


# 10 URL filter


def test_url_filter_agrees_with_its_sql(spark, sf_dir):
    assert differences(spark, sf_dir, urls.op10_url_filter, urls.OP10_SQL) == ""


def test_url_filter_on_odd_urls(spark):
    rows = [
        ("http://A.Example.COM/en/7?x", "a.example.com", "/en/7", "example.com/en/7", "allow"),
        ("http://example.com/en/8", "example.com", "/en/8", "com/en/", "block"),
        ("http://badexample.com/en/7", "badexample.com", "/en/7", "com/en/", "block"),
        ("x://m.example.net/de/8#", "m.example.net", "/de/8", "example.net/de/8", "block"),
        ("x://m.example.net/de/9", "m.example.net", "/de/9", "net/de/", "allow"),
        ("https://org/es/", "org", "/es/", "org/es/", "block"),
        ("https://org.uk/es/", "org.uk", "/es/", None, "allow"),
        ("https://a.org#/es/", "a.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://b://c.com/en/", "b:", "//c.com/en/", None, "allow"),
        ("l1\nl2://x.com/en/\ny", "x.com", "/en/\ny", "com/en/", "block"),
        ("http://.com/en/", ".com", "/en/", "com/en/", "block"),
        ("http:///en/", "", "/en/", None, "allow"),
    ]
    df = spark.createDataFrame([(i, r[0], "clash") for i, r in enumerate(rows)], "page_id long, url string, host string")
    both = df.unionByName(df)
    got = urls.judge_urls(both, keep=["page_id"]).collect()
    assert len(got) == 2 * len(rows)
    for r in got:
        assert (r.host, r["path"], r.rule, r.verdict) == rows[r.page_id][1:]
    assert urls.judge_urls(df.limit(0), keep=["page_id"]).count() == 0
    assert urls.judge_urls(df, rules=[urls.Rule("block", "nowhere", "/")], keep=[]).where("verdict = 'block'").count() == 0


def test_url_filter_uses_no_python(spark, sf_dir):
    plan = urls.op10_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
