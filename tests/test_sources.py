"""Readers over small landed files, and streams."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.operators import maintain
from quillstone.schemas import TABLES
from quillstone.sources import landed
from quillstone.streaming import landing


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


INDEX = """CIK|Company Name|Form Type|Date Filed|Filename
--------------------------------------------------------
12|ACME INC|10-K|20240105|edgar/data/12/0000000012-24-000001.txt
000034|B CO|8-K|2024-02-06|edgar/data/34/0000000034-24-000002.txt
x|bad|8-K|2024-02-06|edgar/data/34/1.txt
34|short|8-K|edgar/data/34/1.txt
34|bad date|8-K|soon|edgar/data/34/1.txt

"""


def test_filing_index(spark, tmp_path):
    put(tmp_path / "2024/QTR1_master.idx", INDEX)
    (tmp_path / "2024/QTR2_master.gz").write_bytes(gzip.compress(INDEX.encode()))
    rows = landed.read_filing_index(spark, str(tmp_path / "2024")).orderBy("quarter", "cik").collect()
    assert len(rows) == 4
    r = rows[0]
    assert (r.cik, r.company_name, r.date_filed, r.accession, r.year, r.quarter) == ("0000000012", "ACME INC", dt.date(2024, 1, 5), "0000000012-24-000001", 2024, "QTR1")
    empty = landed.read_filing_index(spark, put(tmp_path / "e/only.idx", "CIK|Company Name|Form Type|Date Filed|Filename\n"))
    assert empty.count() == 0 and "accession" in empty.columns


def test_symbol_directory(spark, tmp_path):
    p = put(tmp_path / "n.txt", "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares\nAAA| A Corp |Q|N|N|100|Y|N\nBBB|B|Q|N|N|x\nFile Creation Time: 1|||||||\n")
    assert [(r.symbol, r.security_name, r.round_lot_size, r.etf) for r in landed.read_symbol_directory(spark, p, "nasdaq_listed").orderBy("symbol").collect()] == [("AAA", "A Corp", 100, "Y"), ("BBB", "B", None, None)]


def test_bls(spark, tmp_path):
    p = put(tmp_path / "s.txt", "series_id   \tseries_title\tseasonal\n  S1 \t t \tU\n \tx\tU\n")
    assert [(r.series_id, r.title, r.seasonal) for r in landed.read_bls_series(spark, p).collect()] == [("S1", "t", "U")]
    o = put(tmp_path / "o.json", {"Results": {"series": [{"seriesID": "S1", "data": [{"year": "2024", "period": "M02", "value": "1.5", "footnotes": [{"text": "p"}, {}]}, {"year": "2024", "period": "M13", "value": " ", "footnotes": []}]}]}})
    assert {(r.date, r.period, r.value, r.footnotes) for r in landed.read_bls_observations(spark, o).collect()} == {(dt.date(2024, 2, 1), "M02", 1.5, "p"), (dt.date(2024, 1, 1), "M13", None, "")}
    m = put(tmp_path / "m.json", {"Results": {"series": [{"seriesID": "S1", "catalog": {"series_id": "S1", "series_title": "T"}}, {"seriesID": "S2"}]}})
    assert [r.series_id for r in landed.read_series_metadata(spark, m).collect()] == ["S1"]


def test_cubes(spark, tmp_path):
    doc = {"structure": {"dimensions": {"observation": [{"id": "FREQ", "values": [{"id": "Q"}]}, {"id": "TIME", "values": [{"id": "2024-Q1"}, {"id": "2024-Q2"}]}]}}, "dataSets": [{"observations": {"0:0": ["1.5"], "0:1": [None]}}]}
    rows = landed.read_sdmx_json(spark, put(tmp_path / "c.json", doc), "X").orderBy("date").collect()
    assert [(r.date, r.value, r.dimensions, r.dimension_key) for r in rows] == [(dt.date(2024, 1, 1), 1.5, {"FREQ": "Q"}, "FREQ:Q"), (dt.date(2024, 4, 1), None, {"FREQ": "Q"}, "FREQ:Q")]
    wide = spark.createDataFrame([("A", "1", ":")], ["geo", "2020Q1", "2020Q2"])
    assert {(r.date, r.value) for r in landed.read_sdmx_table(wide, "X").collect()} == {(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 4, 1), None)}
    long = spark.createDataFrame([("A", "2020", "7")], ["geo", "TIME_PERIOD", "OBS_VALUE"])
    assert landed.read_sdmx_table(long, "X").first().dimensions == {"geo": "A"}


def test_catalogs(spark, tmp_path):
    put(tmp_path / "p/1.json", {"seriess": [{"id": "GDPUSA", "title": "t", "description": "d"}]})
    put(tmp_path / "p/2.json", {"seriess": [{"id": "GDPUSA", "title": "later"}, {"id": "X", "title": "x", "notes": "n"}]})
    assert {(r.series_id, r.title, r.notes, r.country) for r in landed.read_series_catalog(spark, str(tmp_path / "p")).collect()} == {("GDPUSA", "t", "d", "United States"), ("X", "x", "n", "United States")}
    c = put(tmp_path / "c.json", {"categories": [{"id": 1, "name": "a"}, {"id": 2, "name": "b", "parent_id": 1}]})
    assert {tuple(r) for r in landed.read_categories(spark, c).collect()} == {(1, "a", 0), (2, "b", 1)}
    for i, doc in enumerate(({"0": {"cik_str": 12, "ticker": "A", "title": "a", "exchange": "NYSE"}, "1": {"cik_str": 13, "ticker": "B", "title": "b"}}, [{"cik_str": 12, "ticker": "A", "title": "a", "exchange": "NYSE"}])):
        assert [r.cik for r in landed.read_company_exchange(spark, put(tmp_path / f"x{i}.json", doc)).collect()] == ["0000000012"]
    d = put(tmp_path / "d.json", {"datasets": [{"group": "b", "name": "n1"}, {"group": "A", "name": "n2"}]})
    assert [r.group for r in landed.dataset_groups(landed.read_dataset_catalog(spark, d)).collect()] == ["A", "b"]
    s = put(tmp_path / "s.json", {"code": "X", "dimensions": [{"id": "geo", "name": "Geo", "codes": [{"id": "A", "name": "a"}]}, {"id": "unit", "codes": []}]})
    st = landed.read_structures(spark, s)
    assert st.count() == 2 and landed.keywords(st).first().keywords == "geo, unit"
    ls = put(tmp_path / "l.json", [{"id": "D1", "name": ""}, {"title": "none"}])
    assert [tuple(r)[:2] for r in landed.read_dataset_list(spark, ls).collect()] == [("D1", "D1")]


def test_pages(spark):
    html = "<table><tr><th>h</th></tr><tr><td>1</td><td> <b>x</b> y</td></tr></table>"
    rows = landed.read_html_table(spark.createDataFrame([(1, html), (2, "| a | b | c |\ntext")], "page int, html string")).orderBy("page").collect()
    assert [(r.page, r.cells) for r in rows] == [(1, ["1", "x y", ""]), (2, ["a", "b", "c"])]
    listing = "<tr><td>IVV</td><td><a href='/us/products/1/x'>Core Fund</a></td></tr><tr><td></td></tr>"
    got = landed.parse_listing_table(spark.createDataFrame([(1, listing)], "page int, html string")).collect()
    assert [tuple(r)[1:] for r in got] == [("IVV", "Core Fund", "/us/products/1/x")]


def test_two_section_csv(spark, tmp_path):
    p = put(tmp_path / "IVV.csv", 'Fund as of,"x"\n\nName,Sector,Weight (%)\n"A, Inc",Tech,1.5\n\nTicker,Name,Sector,Weight (%)\nT1,B,Fin,2\n')
    rows = landed.read_two_section_csv(spark, p)
    one, two = (landed.section_records(rows, i).collect() for i in (1, 2))
    assert one[0].record == {"name": "A, Inc", "sector": "Tech", "weight_pct": "1.5"} and two[0].record["ticker"] == "T1" and one[0].file == "IVV"


def test_symbols_bars_candles_trades(spark, tmp_path):
    put(tmp_path / "q/AAA.json", [{"period": "0m", "buy": 3}])
    put(tmp_path / "q/BAD.json", "{")
    docs = landed.read_symbol_documents(spark, str(tmp_path / "q"), "analyst_recommendations").collect()
    assert [(r.symbol, r.document[0].buy) for r in docs if r.document] == [("AAA", 3)]
    p = put(tmp_path / "AAA.csv", "Date,Open,Close,Volume\n2024-01-02 00:00:00-05:00,1,2,3.0\nbad,1,2,3\n")
    bar = landed.read_ohlcv(spark, p).collect()
    assert [(b.symbol, b.date, b.open, b.high, b.volume) for b in bar] == [("AAA", dt.date(2024, 1, 2), 1.0, None, 3)]
    c = put(tmp_path / "c.json", [{"t": 1000, "T": 2000, "s": "BTC", "i": "1m", "o": "1", "c": "2", "h": "3", "l": "0.5", "v": "9", "n": 4}])
    got = landed.read_candles(spark, c).first()
    assert (got.t, got.T_end, got.h, got.n, got.start) == (1000, 2000, 3.0, 4, dt.datetime(1970, 1, 1, 0, 0, 1))
    t = put(tmp_path / "t.json", '{"coin":"BTC","side":"B","px":"1.5","sz":"2","time":1000,"tid":1}\n')
    assert landed.read_trades(spark, t).first().px == 1.5


def test_filings_and_archives(spark, tmp_path):
    put(tmp_path / "2024/QTR1/10-K_A/0001.txt", "body")
    assert [tuple(r) for r in landed.read_filings(spark, str(tmp_path), 2024, "QTR1", "10-K/A").collect()] == [("0001", "body")]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("0002.txt", "two")
        z.writestr("__MACOSX/0002.txt", "no")
        z.writestr("x.md", "no")
    assert [(r.accession, r.content) for r in landed.read_filings_zip(spark, str(tmp_path / "a.zip")).collect()] == [("0002", "two")]


def test_fact_files(spark, tmp_path):
    raw = {"balance_sheet": [{"concept": "us-gaap:Assets", "contextRef": "c", "unitRef": "u", "value": "5"}], "contexts": {"c": {"entity": {"scheme": "s/CIK", "identifier": "1"}, "period": {"instant": "2024-03-31"}, "dimensions": {}}}, "units": {"u": {"measures": {"numerator": ["iso4217:USD"], "denominator": []}}}}
    facts, contexts, units = landed.read_xbrl_json(spark, put(tmp_path / "acc1.xbrl.json", raw))
    assert (facts.first().accession, facts.first().concept, contexts.first().instant, units.first().numerator) == ("acc1", "us-gaap:Assets", "2024-03-31", ["iso4217:USD"])
    adj = {"ticker": "A", "2024-03-31": {"balance_sheet": {"us-gaap:Assets": 1234567890123.5}}}
    r = landed.read_adj_json(spark, put(tmp_path / "acc1.xbrl.adj.json", adj)).first()
    assert (r.accession, r.period, r.section, r.concept) == ("acc1", "2024-03-31", "balance_sheet", "us-gaap:Assets") and float(r.value) == 1234567890123.5


def test_missing_tables_are_empty(spark, tmp_path):
    assert landed.table(spark, str(tmp_path), "p", "series").schema == TABLES["series"].schema()


def test_streams_equal_batches(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    trades = events.select(F.col("event_type").alias("coin"), F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("px"), F.lit(1.0).alias("sz"), F.col("event_id").alias("tid"))
    trades.repartitionByRange(3, "time").write.parquet(str(tmp_path / "in"))
    stream = landing.stream_landing(spark, str(tmp_path / "in"), trades.schema, files_per_trigger=1)
    q = landing.candles(stream, "1h", "365 days").writeStream.outputMode("update").format("memory").queryName("bars").trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.sql("select coin, start, max(n) n, max(high) high from bars group by 1, 2")
    want = landing.candles(trades, "1h").select("coin", "start", "n", "high")
    assert last.exceptAll(want).count() == 0 and want.exceptAll(last).count() == 0


def test_landing_takes_a_file_once_and_upserts_hold(spark, tmp_path):
    schema = "k long, v string, at long"
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    spark.createDataFrame([(1, "a", 1), (1, "b", 2)], schema).write.mode("append").parquet(src)
    for _ in range(2):
        landing.land_available(landing.stream_landing(spark, src, schema), out, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    held = {"t": spark.createDataFrame([(1, "old", 0), (2, "x", 0)], schema)}

    def publish(df):
        held["t"] = spark.read.parquet(maintain.write_version(df, str(tmp_path / "t")))

    landing.stream_upsert(landing.stream_landing(spark, src, schema), lambda: held["t"], publish, ["k"], "at", str(tmp_path / "cp2")).awaitTermination()
    assert {tuple(r) for r in held["t"].collect()} == {(1, "b", 2), (2, "x", 0)}


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    schema = "k long, v string, at long"
    src, root, cp = (str(tmp_path / n) for n in ("src", "table", "cp"))

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = landing.stream_landing(spark, src, spark.createDataFrame([], schema).schema)
        landing.stream_upsert_table(stream, root, ["k"], "at", cp, buckets=16).awaitTermination()
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "table").rglob("*.parquet")}

    before = land([(i, "a", 1) for i in range(200)])
    after = land([(7, "b", 2), (8, "late", 0), (900, "new", 1)])
    got = {r.k: r.v for r in spark.read.parquet(root).collect()}
    assert len(got) == 201 and got[7] == "b" and got[8] == "a" and got[900] == "new"
    assert sum(p in after for p in before) >= len({p.rsplit("/", 1)[0] for p in before}) - 3


def test_archives_are_read_by_ranges_of_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "many #1.zip", "w") as z:
        for i in range(25):
            z.writestr(f"q/{i:04d}.txt", f"text {i}")
    got = landed.read_filings_zip(spark, str(tmp_path / "*.zip"), members_at_once=4).collect()
    assert {(r.accession, r.content) for r in got} == {(f"{i:04d}", f"text {i}") for i in range(25)} and len(got) == 25


def test_coins_and_file_names_with_signs(spark, tmp_path):
    m = put(tmp_path / "m.json", {"universe": [{"name": "BTC"}, {"x": 1}, {"name": "ETH"}]})
    assert [tuple(r) for r in landed.read_coins(spark, m).orderBy("ord").collect()] == [("BTC", 0), ("ETH", 2)]
    put(tmp_path / "d/A+B #1%.json", [{"period": "0m", "buy": 3}])
    assert landed.read_symbol_documents(spark, str(tmp_path / "d"), "analyst_recommendations").first().symbol == "A+B #1%"


def test_files_are_written_by_name(spark, tmp_path):
    df = spark.createDataFrame([("a/x 1.txt", "one"), ("b#.txt", None)], "name string, value string")
    for _ in range(2):
        assert maintain.write_files(df, str(tmp_path / "out")) == 2
    assert (tmp_path / "out/a/x 1.txt").read_text() == "one" and (tmp_path / "out/b#.txt").read_text() == "" and len([p for p in (tmp_path / "out").rglob("*") if p.is_file()]) == 2


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from quillstone.operators.checkpoints import use_checkpoints

    held = []
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, setCheckpointDir=held.append)
    with pytest.raises(ValueError):
        use_checkpoints(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))
    use_checkpoints(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: "hdfs:/shared")))
    assert held == ["hdfs:/shared"]


def test_fact_files_are_listed_by_tasks(spark, tmp_path):
    doc = {"balance_sheet": [{"concept": "us-gaap:Assets", "value": "5"}]}
    for name in ("a/one 1+%20é.xbrl.json", "a/two.json", "b/three.xbrl.json", "b/_hidden.json", "b/.hidden.json", "b/c/deeper.json"):
        put(tmp_path / name, doc)
    facts = landed.read_xbrl_json(spark, f"{tmp_path}/*")[0]
    assert sorted(r.accession for r in facts.collect()) == ["one 1+%20é", "three", "two"]
    assert [r.accession for r in landed.read_xbrl_json(spark, f"{tmp_path}/b")[0].collect()] == ["three"]
    assert "FileScan" not in facts._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        landed.read_xbrl_json(spark, f"{tmp_path}/no*")
