"""Queries against their SQL where the given tables lack the rows that told them apart."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from quillstone.queries import oracle_sql, queries
from tests.oracle import connection, differences


def _differences(spark, folder: Path, name: str, **tables: pa.Table) -> str:
    for t, rows in tables.items():
        pq.write_table(rows, folder / f"{t}.parquet")
    return differences(spark, str(folder), queries()[name], oracle_sql()[name])


def test_page_text_keeps_references_that_no_semicolon_closes(spark, tmp_path):
    pages = ["<p>a &amp;&amp b</p>", "<p>&amp</p>", "x &am<b>p; y</b>", "&lt;b&gt; &quot;&#39; &nbsp;&copy;&middot; &amp;lt;", "&mdash;&apos;&eacute;&rsquo;&#8217;", "", None]
    rows = pa.table({"page_id": list(range(len(pages))), "html": pages})
    assert _differences(spark, tmp_path, "f07_page_text", pages=rows) == ""


def _lines(rows: list[tuple]) -> pa.Table:
    """Of lines (order, line number, price, discount, tax, flag)."""
    names = ("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return pa.table(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def test_a_reported_nonoperating_total_may_be_zero(spark, tmp_path):
    rows = [(1, 1, 50.0, 0.0, 0.0, "A"), (2, 1, 50.0, 0.0, 0.0, "A"), (2, 2, 70.0, 0.0, 0.0, "N"), (3, 1, 50.0, 0.1, 0.02, "N"), (4, 1, 50.0, 0.1, 0.02, "R"), (4, 2, 10.0, 0.0, 0.02, "R")]
    assert _differences(spark, tmp_path, "a16_nonoperating_total", lineitem=_lines(rows)) == ""


def test_lines_are_added_in_the_order_of_the_table(spark, tmp_path):
    """The difference is exactly the tolerance, and passes or fails by the order of addition; larger files are read first."""
    parts = [(5, 37983.31, "A"), (6, 96328.58, "A"), (6, 71214.03, "N")]
    for name, order in (("a", (0, 1, 2)), ("b", (0, 2, 1))):
        lines = tmp_path / name / "lineitem.parquet"
        lines.mkdir(parents=True)
        for i, (n, price, flag) in enumerate(parts[k] for k in order):
            more = [(10_000 * (i + 1) + j, 1, 1000.0 + j, 0.01, 0.02, "N") for j in range(1000 * i)]
            pq.write_table(_lines([(5488, n, price, 0.05, 0.05, flag), *more]), lines / f"{i}.parquet")
        sql = connection(str(tmp_path / name))
        sql.execute("SET threads = 1")  # with more, the SQL's own sums depend on the threads
        want = sql.sql(oracle_sql()["c10_cash_flow"]).fetchall()
        got = queries()["c10_cash_flow"](spark, str(tmp_path / name)).collect()
        assert sorted(map(tuple, got)) == sorted(want)
        assert [r.passed for r in got if r.accession == "5488"] == [name == "b"]


def test_filings_are_not_broadcast(spark, sf_dir):
    """Of tables that the planner takes for small."""
    for name in ("a10_shares", "c19_adjusted_filings"):
        assert "Broadcast" not in queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString(), name
