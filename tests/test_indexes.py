"""Indexed cubes and text search against plain scans, and what they read."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillstone.operators import indexes, select


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def cube(spark, tmp_path_factory):
    r, root = random.Random(1), str(tmp_path_factory.mktemp("cube"))
    rows = [(f"s{r.randint(0, 5)}", f"2024-01-{r.randint(1, 28):02d}", float(i), r.choice([None, {}, {"area": r.choice("ABC"), "item": str(r.randint(0, 9))}, {"area": r.choice("ABC")}, {"item": None}])) for i in range(400)]
    df = spark.createDataFrame(rows, "series_id string, date string, value double, dimensions map<string,string>")
    indexes.index_cube(df, root, buckets=32)
    return df, root


@pytest.mark.parametrize("dims", [None, {}, {"area": "A"}, {"area": "B", "item": "3"}, {"area": "Z"}, {"none": "A"}, {"area": "A", "item": "77"}])
def test_an_indexed_cube_equals_a_scan(spark, cube, dims):
    df, root = cube
    for key, start in ((None, None), ("s1", "2024-01-10")):
        plain = select.read_cube(df, key, start, None, dims)
        got = indexes.read_indexed_cube(spark, root, key, start, None, dims)
        text = lambda x: rows_of(x.withColumn("dimensions", F.to_json("dimensions")))
        assert text(got) == text(plain.select(*got.columns))


def test_fewer_files_are_read_for_rarer_requests(spark, cube):
    _, root = cube
    files = lambda dims: len(indexes.read_indexed_cube(spark, root, dims=dims).inputFiles() if not dims else {f for (f,) in indexes.read_indexed(spark, root, [f"{k}\x1f{v}" for k, v in dims.items()]).select(F.input_file_name()).distinct().collect()})
    every = len([p for p in Path(root, "rows").rglob("*.parquet")])
    one, two = files({"area": "A"}), files({"area": "A", "item": "3"})
    assert two < one < every and len(indexes.buckets_with(spark, root, ["area\x1fA", "item\x1f3"])) <= 8


@pytest.mark.parametrize("term", ["", "x", "ab", "abc", "ABCD", "zzz", "12", "123", "ünï", "İst", "a b", "%_'"])
def test_indexed_search_equals_a_scan(spark, tmp_path, term):
    r = random.Random(3)
    words = ["abc", "abcd", "xab", "ÜNÏ", "İstanbul", "a b", "%_'", "", None]
    df = spark.createDataFrame([(r.choice([None, i, 1230 + i]), r.choice(words), (r.choice(words) or "") + (r.choice(words) or "")) for i in range(120)], "n int, a string, `b c` string")
    indexes.index_text(df, str(tmp_path / "t"), buckets=16)
    assert rows_of(indexes.search_indexed(spark, str(tmp_path / "t"), term)) == rows_of(select.search_any(df, term))


def test_rare_terms_read_few_buckets(spark, tmp_path):
    df = spark.range(2000).select("id", F.concat(F.lit("name "), F.lpad("id", 6, "0")).alias("name"))
    indexes.index_text(df, str(tmp_path / "t"), F.floor(F.col("id") / 20), buckets=64)
    found = indexes.buckets_with(spark, str(tmp_path / "t"), [("001234")[i : i + 3] for i in range(4)])
    assert 1 <= len(found) <= 8 and [r.id for r in indexes.search_indexed(spark, str(tmp_path / "t"), "001234").collect()] == [1234]
