"""Filter-split upserts, trees of any depth, as-of joins with hot keys, and views kept by deltas."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillstone.operators import joins, maintain, views

ROWS = "k string, n int, v double, created_at string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table_of(spark, seed, n, kinds):
    r = random.Random(seed)
    return {(r.choice([None, *[f"k{i}" for i in range(kinds)]]), r.choice([None, 1, 2])): (r.random(), f"c{seed}") for _ in range(n)}


@pytest.mark.parametrize("words", [1, 2, 1 << 17])
def test_upserts_equal_plain_ones_however_full_the_filter_is(spark, monkeypatch, words):
    monkeypatch.setattr(maintain, "FILTER_WORDS", words)
    old, new = table_of(spark, 1, 300, 200), table_of(spark, 2, 60, 400)
    frame = lambda rows: spark.createDataFrame([(*k, *v) for k, v in rows.items()], ROWS)
    target, batch = frame(old), frame(new)
    want = {k: (new[k][0], old[k][1]) if k in new and k in old else v for k, v in {**old, **new}.items()}
    assert rows_of(maintain.upsert(target, batch, ["k", "n"])) == rows_of(frame(want))
    assert rows_of(maintain.upsert(target, batch.limit(0), ["k", "n"])) == rows_of(target)
    assert rows_of(maintain.upsert(target.limit(0), batch, ["k", "n"])) == rows_of(batch)
    keyed = {k: v for k, v in old.items() if None not in k}
    fresh = {k: v for k, v in new.items() if None not in k}
    assert rows_of(maintain.insert_ignore(frame(keyed), frame(fresh), ["k", "n"])) == rows_of(frame({**fresh, **keyed}))
    keys = {k for k, _ in fresh}
    assert rows_of(maintain.replace_keys(frame(keyed), frame(fresh), "k")) == rows_of(frame({**{k: v for k, v in keyed.items() if k[0] not in keys}, **fresh}))


def test_what_a_batch_cannot_touch_is_not_shuffled(spark, tmp_path):
    spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "t"))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.range(3).select((F.col("id") * 7).alias("k"), F.lit(-1).cast("long").alias("v"))
    untouched, maybe = maintain.split_by_keys(target, batch, ["k"])
    assert untouched.count() + maybe.count() == 2000 and maybe.count() <= 5
    plan = untouched._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_word" in plan  # the filter's own


# trees


CATS = "category_id int, name string, parent_id int"


def test_a_chain_of_many_levels(spark):
    n = 5000
    rows = [(i, f"n{i}", i - 1 if i else None) for i in range(n)]
    got = joins.category_depths(spark.createDataFrame(rows, CATS)).select("category_id", "depth", F.try_element_at("path", F.lit(-2)).alias("up")).orderBy("category_id").collect()
    assert [(r.category_id, r.depth) for r in got] == [(i, i) for i in range(n)] and got[-1].up == n - 2
    last = joins.category_paths(spark.createDataFrame(rows[:40], CATS)).where("category_id = 39").first()
    assert last.full_path == " / ".join(f"n{i}" for i in range(40))


def test_ways_orphans_and_cycles(spark):
    rows = [(0, "root", 0), (1, "a", 0), (2, "b", 0), (3, "c", 1), (3, "c", 2), (4, "d", 3), (5, "e", 99), (6, "x", 7), (7, "y", 6), (8, "self", 8), (9, "below", 7), (10, None, 1)]
    got = {(r.category_id, tuple(r.path)) for r in joins.category_depths(spark.createDataFrame(rows, CATS)).collect()}
    assert got == {(0, (0,)), (1, (0, 1)), (2, (0, 2)), (3, (0, 1, 3)), (3, (0, 2, 3)), (4, (0, 1, 3, 4)), (4, (0, 2, 3, 4)), (10, (0, 1, 10))}
    assert joins.category_depths(spark.createDataFrame([], CATS)).count() == 0


@pytest.mark.parametrize("deep", [0, 9])
def test_a_cycle_below_a_root_is_named(spark, deep):
    chain = [(100 + i, "c", 99 + i if i else 0) for i in range(deep)]
    rows = [(0, "root", None), *chain, (1, "a", 99 + deep if deep else 0), (1, "a", 3), (2, "b", 1), (3, "c", 2)]
    with pytest.raises(ValueError, match="cycle"):
        joins.category_paths(spark.createDataFrame(rows, CATS))


# as-of joins


def test_a_hot_key_is_dealt_out_forwards_too(spark):
    r = random.Random(4)
    left = spark.createDataFrame([(i, r.choice(["hot", "hot", "hot", "k", None]), r.randint(0, 300)) for i in range(800)], "id int, k string, at int")
    right = spark.createDataFrame([(r.choice(["hot", "k", None]), r.randint(0, 300), r.choice([None, r.random()])) for _ in range(120)], "k string, at int, v double")
    plain, spread = (joins.asof_forward(left, right, ["k"], "at", "at", "v", 12, "next", ranges=n) for n in (None, 9))
    assert rows_of(plain) == rows_of(spread) and plain.where("next is not null").count() > 300


# sums


@pytest.mark.parametrize(("most", "terms"), [(10, 3), (50, 3), (4, 1), (5, 2)])
def test_the_best_subset_equals_all_of_them_tried(spark, monkeypatch, most, terms):
    from itertools import combinations

    monkeypatch.setattr(joins, "SUMS", 1000)
    joins._subset_finder.cache_clear()
    r = random.Random(most)
    rows = [(g, i, r.choice([None, float(r.randint(-30, 30))])) for g in range(12) for i in range(r.randint(0, 60))]
    goals = {g: r.choice([None, float(r.randint(-60, 60))]) for g in range(13)}
    got = joins.best_subset_sum(spark.createDataFrame(rows, "g int, i int, v double"), spark.createDataFrame(list(goals.items()), "g int, target double"), ["g"], "v", "i", most, terms)
    want = []
    for g, target in goals.items():
        top = [v for _, _, v in sorted((x for x in rows if x[0] == g and x[2] is not None), key=lambda x: (-abs(x[2]), x[1]))][:most]
        picks = [c for k in range(1, terms + 1) for c in combinations(range(most), k)]
        tried = [(abs(sum(top[p] for p in c) - (target or 0.0)), n, sum(top[p] for p in c)) for n, c in enumerate(picks) if c[-1] < len(top)]
        if top:
            err, n, s = min(tried) if target is not None else (None, 0, top[0])
            want.append((g, target, s, err, n))
    assert rows_of(got) == sorted(want, key=repr)


# views


def test_views_after_deltas_equal_views_from_scratch(spark, tmp_path):
    r = random.Random(8)
    columns = "id int, k string, x double, d int"
    held = {i: (i, r.choice([None, "a", "b", "c"]), r.choice([None, float(r.randint(0, 9))]), r.randint(0, 5)) for i in range(80)}
    frame = lambda rows: spark.createDataFrame(list(rows), columns)
    below = views.View("t_low", "t", ("k", "d"), {"total": "x"}, {"lo": "x"}, {"hi": "x"}, where="id % 5 <> 0")
    above = views.View("t_up", "t_low", ("k",), {"sum": "total", "rows": "n"}, {"lo": "lo"}, {"hi": "total"}, rows="groups")
    paths = views.create_views(spark, [above, below], {"t": frame(held.values())}, str(tmp_path / "kept"))
    for step in range(3):
        gone = [held.pop(i) for i in r.sample(sorted(held), 25)]
        come = [(i, r.choice([None, "a", "b", "z"]), r.choice([None, float(r.randint(-3, 9))]), r.randint(0, 5)) for i in range(100 * (step + 1), 100 * (step + 1) + 15)]
        held |= {x[0]: x for x in come}
        paths = views.refresh_views(spark, [above, below], paths, {"t": frame(held.values())}, {"t": views.Delta(frame(come), frame(gone))}, str(tmp_path / "kept"))
        kept = [rows_of(spark.table(v.name)) for v in (below, above)]
        views.create_views(spark, [above, below], {"t": frame(held.values())}, str(tmp_path / f"new{step}"))
        assert kept == [rows_of(spark.table(v.name)) for v in (below, above)]


def test_only_keys_that_lose_an_extremum_are_read_again(spark):
    view = views.View("v", "t", ("k",), least={"lo": "x"})
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2)], "k string, x int")
    wrong = spark.createDataFrame([("a", 77), ("b", 88)], "k string, x int")  # stands for the source after the delta
    delta = views.Delta(rows.limit(0), spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int"))
    assert rows_of(views.merge_delta(view, views._state(view, rows), delta, wrong)) == [("a", 1, 77), ("b", 1, 1)]


def test_views_in_a_circle_are_an_error():
    with pytest.raises(ValueError):
        views.in_order([views.View("a", "b", ("k",)), views.View("b", "a", ("k",))])
