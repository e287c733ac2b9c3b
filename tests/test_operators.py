"""Operators that the queries do not reach, on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillstone.functions import dates, ids, numbers, text
from quillstone.operators import aggregate, checks, filing_text, joins, maintain, select, sets
from quillstone.operators import rules as R


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("got", "want"),
    [
        (lambda: ids.norm_cik(F.lit("320193")), "0000320193"),
        (lambda: ids.norm_cik(F.lit("x")), None),
        (lambda: ids.accession_of(F.lit("edgar/data/1/0000000001-20-000001.txt")), "0000000001-20-000001"),
        (lambda: ids.archive_path(F.lit("0000000001-20-000001")), "edgar/data/1/000000000120000001/0000000001-20-000001.txt"),
        (lambda: ids.archive_path(F.lit("1-2-3")), None),
        (lambda: ids.three_part_path(F.lit("edgar/data/1/0000000001-20-000001.txt")), "edgar/data/1/000000000120000001/0000000001-20-000001.txt"),
        (lambda: ids.slug(F.lit("8-K\\12")), "8-K_12"),
        (lambda: ids.is_ticker(F.lit("N/A")), False),
        (lambda: ids.is_ticker(F.lit("BRK1")), True),
        (lambda: ids.series_country(F.lit("XAUSX")), "United States"),
        (lambda: ids.series_country(F.lit("XAUSX"), strict=True), "Australia"),
        (lambda: ids.fact_label(F.lit("us-gaap:X"), F.create_map(F.lit("b:Axis"), F.lit("b:TwoMember"), F.lit("a:Axis"), F.lit("a:OneMember"))), "us-gaap:X [One, Two]"),
        (lambda: ids.fact_label(F.lit("us-gaap:X"), F.create_map().cast("map<string,string>")), "us-gaap:X"),
        (lambda: dates.sdmx_period_date(F.lit("2020-W01")), dt.date(2020, 1, 1)),
        (lambda: dates.sdmx_period_date(F.lit("2020-W01"), iso_weeks=True), dt.date(2019, 12, 30)),
        (lambda: dates.sdmx_period_date(F.lit("2020Q5")), None),
        (lambda: dates.bls_period_date(F.lit("2020"), F.lit("Q05")), None),
        (lambda: dates.parse_date_multi(F.lit("Jan 5, 2024")), dt.date(2024, 1, 5)),
        (lambda: dates.parse_date_multi(F.lit("nothing")), None),
        (lambda: dates.legacy_period(F.lit("March 31, 1999")), "1999-03-31"),
        (lambda: dates.period_key(F.lit("2024-02-10T00:00:00"), F.lit(None).cast("string")), "2024-02-29T00:00:00"),
        (lambda: numbers.parse_num(F.lit("1,234.5%")), 1234.5),
        (lambda: numbers.parse_num(F.lit("--")), None),
        (lambda: numbers.parse_num(F.lit("Infinity")), None),
        (lambda: numbers.parse_amounts(F.lit("Sales $ 1,200 (300) 4.5")), [1200.0, -300.0, 4.5]),
        (lambda: numbers.magnitude(F.lit("B")), 1e9),
        (lambda: numbers.cast_by_type(F.lit("1e3"), "int"), 1000),
        (lambda: numbers.cast_by_type(F.lit("x"), "bool"), None),
        (lambda: numbers.cast_by_type(F.lit("86400"), "datetime"), "1970-01-02 00:00:00"),
        (lambda: numbers.or_else(F.lit(0.0), F.lit(2.0)), 2.0),
        (lambda: numbers.approx_eq(F.lit(100.0), F.lit(95.0)), True),
        (lambda: numbers.approx_eq(F.lit(100.0), F.lit(94.9)), False),
        (lambda: numbers.signed_component(F.lit("us-gaap:InterestExpense"), F.lit(5.0)), -5.0),
        (lambda: numbers.signed_component(F.lit("us-gaap:OtherIncomeExpenseNet"), F.lit(5.0)), 5.0),
        (lambda: numbers.signed_component(F.lit("us-gaap:GainLossOnX"), F.lit(5.0)), 5.0),
        (lambda: text.strip_html(F.lit("<p>a&amp;b </p> <br>c")), "a&b c"),
        (lambda: text.snippet(F.lit("xx FORM 10-K annual"), 9), "FORM 10-K…"),
        (lambda: text.row_label(F.lit("  cost of sales....  1,234")), "Cost Of Sales"),
    ],
)
def test_functions(spark, got, want):
    assert one(spark, got()) == want


def test_coerced_values(spark):
    rows = spark.createDataFrame([("12",), ("1.5",), ("x",), ("",)], "v string").select(numbers.coerce_value(F.col("v")).alias("c")).collect()
    assert [(r.c and (r.c.i, r.c.d, r.c.s)) for r in rows] == [(12, None, None), (None, 1.5, None), (None, None, "x"), None]


def test_quarters_and_paths(spark):
    assert [(r.year, r.quarter) for r in dates.quarters(spark, 2023, "2024-02-01").collect()] == [(2023, f"QTR{i}") for i in (1, 2, 3, 4)] + [(2024, "QTR1")]
    p = one(spark, ids.quarter_path(F.lit("/a/2024/QTR2/10-K")))
    assert (p.year, p.quarter, p.form_type) == (2024, "QTR2", "10-K") and one(spark, ids.quarter_path(F.lit("/a/b"))) is None


def test_document_period_end(spark):
    facts = spark.createDataFrame(
        [("a", "dei:DocumentPeriodEndDate", "2024-03-31", 1), ("b", "dei:DocumentFiscalYearFocus", "2023", 1), ("b", "dei:DocumentFiscalPeriodFocus", "q3", 2), ("c", "dei:DocumentFiscalYearFocus", "2023", 1)],
        "accession string, concept string, value string, ord int",
    )
    assert {r.accession: r.doc_end for r in dates.document_period_end(facts).collect()} == {"a": dt.date(2024, 3, 31), "b": dt.date(2023, 9, 30), "c": None}


def test_upsert_twice_is_upsert_once_and_keeps_created_at(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    schema = "k long, v string, created_at timestamp, updated_at timestamp"
    target = spark.createDataFrame([(1, "a", t0, t0), (2, "b", t0, t0), (None, "n", t0, t0)], schema)
    batch = spark.createDataFrame([(2, None, t1, t1), (3, "c", t1, t1), (None, "m", t1, t1)], schema)
    once = maintain.upsert(target, batch, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, maintain.upsert(once, batch, ["k"]).collect()))
    assert {(r.k, r.v, r.created_at) for r in once.collect()} == {(1, "a", t0), (2, None, t0), (3, "c", t1), (None, "m", t0)}


def test_exchange_and_status_upserts(spark):
    companies = spark.createDataFrame([("1", "A", None)], "cik string, name string, exchange string")
    got = maintain.upsert_exchange(companies, spark.createDataFrame([("1", "NYSE"), ("2", "Nasdaq")], "cik string, exchange string"))
    assert {tuple(r) for r in got.collect()} == {("1", "A", "NYSE"), ("2", "Unknown", "Nasdaq")}
    status = spark.createDataFrame([], "survey string, status string, error string, rows long, updated_at timestamp")
    events = spark.createDataFrame([(" ap ", "failed", 404, "x" * 5000, 0, dt.datetime(2024, 1, 1))], "survey string, status string, code int, error string, rows long, at timestamp")
    row = maintain.sync_status_apply(status, events).first()
    assert (row.survey, row.status, len(row.error)) == ("AP", "failed:404", 4000)


def test_exports_and_archives(spark, tmp_path):
    df = spark.createDataFrame([("a", 2024, "QTR1", "10-K", "text a"), ("b", 2024, "QTR1", "10-K/A", "text b")], "accession string, year int, quarter string, form_type string, content string")
    assert maintain.compact_filings(df, str(tmp_path / "z")).count() == 0
    assert [tuple(r) for r in maintain.restore_filings(spark, str(tmp_path / "z"), 2024, "QTR1", "10-K/A").collect()] == [("b", "text b")]
    maintain.export_csv(spark.createDataFrame([("x", None)], "a string, b string"), ["b", "a"], str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True, emptyValue="").columns == ["b", "a"]
    maintain.export_per_key(spark.createDataFrame([("A/B", 1)], "k string, v int"), "k", str(tmp_path / "k"))
    assert spark.read.parquet(str(tmp_path / "k")).first().safe_key == "A_B"
    path = maintain.write_version(df, str(tmp_path / "t"), ["year"])
    assert spark.read.parquet(path).count() == 2
    maintain.write_adj_json(df.select("accession", "form_type", "quarter", "content"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).count() == 2


def test_selection_errors(spark):
    index = spark.createDataFrame([("0000000012", "Acme", "f1")], "cik string, company_name string, filename string")
    assert [r.filename for r in select.select_filings(index, cik="12").collect()] == ["f1"]
    with pytest.raises(ValueError):
        select.select_filings(index)
    with pytest.raises(ValueError):
        select.select_filings(index, colour="x")


def test_holdings_and_columns(spark):
    raw = spark.createDataFrame([("Name", "Sector", "-"), ("A", "Tech", "--"), ("B", "nan", "1"), ("C", None, "1")], "name string, sector string, weight string")
    assert [tuple(r) for r in select.clean_holdings(raw).collect()] == [("A", "Tech", "")]
    df = spark.createDataFrame([("X", "1.5")], ["Weight (%)", "Etf Ticker"]).toDF("Name", "Weight (%)")
    got = select.canonical_columns(df, ["etf_ticker", "name", "weight", "sector"], {"weight_pct": "weight"}, F.lit("ETF"))
    assert tuple(got.first()) == ("ETF", "X", "1.5", None)
    fixed = select.default_required(spark.createDataFrame([(None, None, None)], "ticker string, name string, updated_at timestamp"), "2024-01-01").first()
    assert fixed.ticker.startswith("_missing_") and fixed.name == "" and fixed.updated_at == dt.datetime(2024, 1, 1)
    typed = select.apply_schema(spark.createDataFrame([("s", {"a": "1", "b": "inf"})], "symbol string, properties map<string,string>"), {"a": "int", "b": "float", "c": "str"})
    assert tuple(typed.first()) == ("s", 1, None, None)


def test_fact_predicates(spark):
    values = ["1.5", " ", "(ixTransformError)", "abc", None]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(select.is_bad_value(F.col("v")).alias("b")).collect()
    assert [r.b for r in got] == [False, True, True, True, True]
    units = spark.createDataFrame([(["iso4217:USD"], [], "u1"), (["iso4217:USD"], ["shares"], "u2"), (None, None, "usd")], "n array<string>, d array<string>, u string")
    assert [r.x for r in units.select(select.is_currency_unit(F.col("n"), F.col("d"), F.col("u")).alias("x")).collect()] == [True, False, True]


def test_contexts_units_labels(spark):
    facts = spark.createDataFrame([("a", "c1", "u1", "x", "5"), ("a", "c9", None, "y", "6")], "accession string, contextRef string, unitRef string, concept string, value string")
    contexts = spark.createDataFrame([("a", "c1", "http://x/CIK", "1", "2024-01-01", None, None, {"k": "v"})], "accession string, contextRef string, scheme string, identifier string, instant string, startDate string, endDate string, dimensions map<string,string>")
    rows = {r.contextRef: r for r in joins.inline_contexts(facts, contexts).collect()}
    assert rows["c1"].entity_scheme == "CIK" and rows["c1"].period_instant == "2024-01-01" and rows["c9"].dimensions is None
    labels = spark.createDataFrame([("a", "x", "second", 2), ("a", "x", "first", 1)], "accession string, concept string, label string, ord int")
    assert {r.concept: r.label for r in joins.with_labels(facts, labels).collect()} == {"x": "first", "y": None}


def test_indentation_parents(spark):
    rows = [(1, 0, "Assets", True), (2, 2, "Current", True), (3, 4, "Cash", False), (4, 2, "Other", False), (5, 0, "Total", False)]
    df = spark.createDataFrame([(1, 1, *r) for r in rows], "doc int, table int, ord int, indent int, label string, is_header boolean")
    assert [r.parent for r in aggregate.indent_parent(df).orderBy("ord").collect()] == [None, "Assets", "Current", "Assets", None]


def test_sections_and_context(spark):
    text_ = "ITEM 1. Aaa body one ITEM 2. Bbb body two"
    heads = spark.createDataFrame([(1, "1", 1, 12, text_), (1, "2", text_.index("ITEM 2") + 1, text_.index("Bbb") + 4, text_)], "doc int, item string, start int, stop int, text string")
    assert {r.item: r.section for r in aggregate.sections(heads).collect()} == {"1": "body one", "2": "body two"}
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", " ", "b", "<TABLE>"])], "doc int, line_no int, line string")
    assert aggregate.context_lines(lines, 2).orderBy("line_no").collect()[-1].context == ["b"]


def test_shapes(spark):
    rec = spark.createDataFrame([("A", "2024-01", "F1")], "symbol string, period string, firm string")
    upg = spark.createDataFrame([("A", "2024-02-01", "F2", "Buy")], "symbol string, grade_date string, company string, toGrade string")
    assert {(r.date, r.firm, r.to_grade, r.source) for r in sets.recommendations(rec, upg).collect()} == {("2024-01", "F1", None, "recommendations"), ("2024-02-01", "F2", "Buy", "upgrades")}
    st = spark.createDataFrame([("A", "income", [{"_index": "Sales", "2024": "5", "2023": "x"}])], "symbol string, statement string, records array<map<string,string>>")
    assert {(r["item"], r.period, r.value) for r in sets.statements_long(st).collect()} == {("Sales", "2024", 5.0), ("Sales", "2023", None)}
    dei = spark.createDataFrame([("a", "dei:X", 1, "☒"), ("a", "dei:X", 2, "☒"), ("a", "dei:X", 3, "z"), ("a", "other", 1, "q")], "accession string, concept string, ord int, value string")
    assert aggregate.collect_dei(dei).first()["values"] == ["true", "z"]


def check(spark, facts, name):
    rows = [("f", s, c, float(v), i) for i, (s, c, v) in enumerate(facts)]
    df = spark.createDataFrame(rows, "accession string, section string, concept string, value double, ord int")
    return checks.run_checks(df, [name]).first()


BS, INC, CF, OTHER = "balance_sheet", "income_stmt", "cashflow", "other"


@pytest.mark.parametrize(
    ("name", "facts", "passed", "status"),
    [
        ("balance sheet identity", [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:Liabilities", 60), (BS, R.EQUITY[0], 35)], True, "checked"),
        ("balance sheet identity", [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:Liabilities", 60), (BS, R.EQUITY[0], 34)], False, "checked"),
        ("balance sheet identity", [(BS, "us-gaap:Assets", 100), (BS, R.EQUITY[1], 34)], True, "checked"),
        ("balance sheet identity", [(BS, "us-gaap:Assets", 100)], False, "missing"),
        ("balance sheet identity", [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:Liabilities", 50), (BS, R.EQUITY[0], 20), (BS, R.TEMPORARY_MEZZANINE[0], 20), (OTHER, R.TEMPORARY_OTHER[0], 10)], True, "checked"),
        ("assets by term", [(BS, "us-gaap:Assets", 100)], True, "skipped"),
        ("assets by term", [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:AssetsCurrent", 30), (BS, "us-gaap:AssetsNoncurrent", 40)], False, "checked"),
        ("assets by term", [(BS, "us-gaap:Assets", 100), (OTHER, "x:OtherAssetsCurrent", 30)], True, "checked"),
        ("liabilities by term", [(BS, "us-gaap:Liabilities", 100), (BS, "us-gaap:LiabilitiesCurrent", 30), (OTHER, "x:TaxesPayableNoncurrent", 70)], True, "checked"),
        ("gross profit", [(INC, R.REVENUE[0], 90), (INC, R.REVENUE[1], 100), (OTHER, R.COST[0], 40), (INC, "us-gaap:GrossProfit", 60)], True, "checked"),
        ("gross profit", [(INC, R.REVENUE[1], 100), (OTHER, R.COST[0], 40), (INC, "us-gaap:GrossProfit", 0)], True, "skipped"),
        ("operating income", [(INC, "us-gaap:GrossProfit", 60), (INC, "us-gaap:OperatingExpenses", 20), (INC, "us-gaap:OperatingIncomeLoss", 10), (OTHER, "us-gaap:OperatingIncomeLoss", 40)], True, "checked"),
        ("operating expenses", [(INC, "us-gaap:OperatingExpenses", 60), (INC, R.RESEARCH, 20), (INC, R.SELLING, 20), (INC, "x:OtherOpex", 20), (OTHER, "x:OtherOpex", 20)], True, "checked"),
        ("pretax income", [(INC, R.PRETAX[0], 80), (INC, "us-gaap:OperatingIncomeLoss", 100), (OTHER, "us-gaap:InterestExpense", 20)], True, "checked"),
        ("pretax income", [(INC, R.PRETAX[0], 80), (INC, "us-gaap:OperatingIncomeLoss", 100)], False, "checked"),
        ("pretax income", [(INC, R.PRETAX[0], 80), (INC, "us-gaap:OperatingIncomeLoss", 100), (OTHER, "us-gaap:InterestExpense [A]", 12), (OTHER, "us-gaap:InterestExpense [B]", 8)], True, "checked"),
        ("net income", [(INC, R.PRETAX[0], 80), (OTHER, R.TAX[0], 20), (INC, R.NET[0], 10), (INC, R.NET[1], 60)], True, "checked"),
        ("comprehensive income", [(INC, R.NET[0], 60), (INC, R.OCI[0], 5), (INC, R.COMPREHENSIVE[0], 65)], True, "checked"),
        ("cash flow", [(CF, R.OPERATING[1], 50), (CF, R.INVESTING[1], -20), (CF, R.FINANCING[1], -10), (CF, R.DISCONTINUED, 5), (CF, R.CASH_CHANGE[0], 25)], True, "checked"),
        ("cash flow", [(CF, R.OPERATING[0], 50), (CF, R.INVESTING[0], -20), (CF, R.FINANCING[0], -10), (CF, R.EXCHANGE_EFFECT[0], -10), (CF, R.CASH_CHANGE[0], 10)], True, "checked"),
        ("equity components", [(BS, R.EQUITY[0], 100), (BS, f"{R.EQUITY[0]} [CommonStock]", 40), (BS, f"{R.EQUITY[0]} [RetainedEarnings]", 60), (BS, f"{R.EQUITY[0]} [Parent]", 100), (BS, f"{R.EQUITY[0]} [SomeSegment]", 70)], True, "checked"),
        ("equity components", [(BS, R.EQUITY[0], 100), (BS, f"{R.EQUITY[0]} [CommonStock]", 90), (BS, f"{R.EQUITY[0]} [{R.AOCI_PARENTS[0]}]", 10), (BS, f"{R.EQUITY[0]} [{R.AOCI_PARENTS[1]}]", 10)], True, "checked"),
        ("revenue by kind", [(INC, R.REVENUE[0], 100), (INC, f"{R.REVENUE[0]} [Product]", 70), (INC, f"{R.REVENUE[0]} [Service]", 20)], False, "checked"),
        ("revenue by segment", [(INC, R.REVENUE[0], 100), *[(INC, f"{R.REVENUE[0]} [{s}]", 20) for s in R.SEGMENTS]], True, "checked"),
        ("revenue by segment", [(INC, R.REVENUE[0], 100), (INC, f"{R.REVENUE[0]} [{R.SEGMENTS[0]}]", 20)], True, "skipped"),
    ],
)
def test_checks(spark, name, facts, passed, status):
    got = check(spark, facts, name)
    assert (got.passed, got.status) == (passed, status), got


def test_equity_is_judged_by_the_form(spark):
    """A class of shares counts in annual filings, distributions in excess of income in quarterly ones."""
    base = [(BS, R.EQUITY[0], 100.0), (BS, f"{R.EQUITY[0]} [CommonStock]", 80.0), (BS, f"{R.EQUITY[0]} [CommonClassA]", 20.0), (BS, f"{R.EQUITY[0]} [AccumulatedDistributionsInExcessOfNetIncome]", -40.0)]
    forms = {"a": "10-K/A", "b": "20-F", "c": "10-Q", "d": None, "e": "10-kt"}
    rows = [(f, form, s, c, v, i) for f, form in forms.items() for i, (s, c, v) in enumerate(base)]
    df = spark.createDataFrame(rows, "accession string, form_type string, section string, concept string, value double, ord int")
    got = {r.accession: (r.passed, r.difference) for r in checks.run_checks(df, ["equity components"]).collect()}
    assert got == {"a": (True, 0.0), "b": (True, 0.0), "e": (True, 0.0), "c": (False, 60.0), "d": (False, 60.0)}


def test_chosen_checks_equal_all_of_them(spark):
    facts = [(BS, "us-gaap:Assets", 100.0), (BS, "us-gaap:Liabilities", 60.0), (INC, R.REVENUE[0], 100.0), (INC, f"{R.REVENUE[0]} [Product]", 70.0), (INC, f"{R.REVENUE[0]} [Service]", 20.0)]
    df = spark.createDataFrame([("f", s, c, v, i) for i, (s, c, v) in enumerate(facts)], "accession string, section string, concept string, value double, ord int")
    every = {r.check_name: tuple(r) for r in checks.run_checks(df).collect()}
    assert tuple(every) == checks.CHECKS
    some = checks.run_checks(df, ["revenue by kind", "balance sheet identity"]).collect()
    assert [tuple(r) for r in some] == [every["balance sheet identity"], every["revenue by kind"]]
    with pytest.raises(ValueError):
        checks.run_checks(df, ["no such check"])


def test_asof_in_ranges_equals_one_window(spark):
    import random

    r = random.Random(3)
    left = spark.createDataFrame([(i, r.choice(["hot", "hot", "hot", "k", None]), r.randint(0, 300)) for i in range(800)], "id int, k string, at int")
    right = spark.createDataFrame([(r.choice(["hot", "k", None]), r.randint(0, 300), r.choice([None, r.random()])) for _ in range(120)], "k string, at int, v double")
    plain, spread = (joins.asof_backward(left, right, ["k"], "at", "v", "last", ranges=n) for n in (None, 9))
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, spread.collect()), key=repr)
    assert plain.where("last is not null").count() > 500


def test_contexts_of_matches_stand_beside_them(spark):
    t = "x" * 700 + " revenue $5 million " + "y" * 300
    m = spark.createDataFrame([(t,), (None,), ("",)], "t string").select(filing_text.matches(F.col("t"), r"\$\d", context=True).alias("m")).collect()
    assert m[0].m[0].left == t[709 - 500 : 709] and m[0].m[0].right == t[711:911] and m[1].m is None and m[2].m == []


def test_many_matches_take_linear_time(spark):
    import time

    df = spark.createDataFrame([(1, "x and y " * 100_000)], "doc int, text string")
    filing_text.regex_matches(df, "text", " and ").count()
    begin = time.perf_counter()
    assert filing_text.regex_matches(df, "text", " and ").count() == 100_000 and time.perf_counter() - begin < 10


def test_references_are_decoded_once(spark):
    import html

    from quillstone.functions.text import unescape

    texts = ["a &amp;lt; b", "&lt;p&gt; &quot;x&quot; &#39;", "&eacute;&amp;&nbsp;", "R&D; AT&T", "&copy; 5 &middot; 6 &amp;copy;", "no", None, "&#x41;&amp;amp;"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", unescape(F.col("t")).alias("u")).orderBy("i").collect()
    assert [r.u for r in got] == [None if t is None else html.unescape(t) for t in texts]


def test_legacy_checks_and_failures(spark):
    rows = [("f", "Total Assets", 100.0, 1), ("f", "Total Liabilities And Equity", 90.0, 2), ("f", "Income Before Income Taxes", 50.0, 3), ("f", "Income Taxes [Costs]", 10.0, 4), ("f", "Net Income", 40.0, 5)]
    got = checks.run_legacy_checks(spark.createDataFrame(rows, "accession string, label string, value double, ord int"))
    assert [(r.passed, r.status) for r in got.collect()] == [(False, "checked"), (True, "skipped"), (True, "skipped"), (True, "checked"), (True, "skipped")]
    failed = checks.check_failures(got).first()
    assert failed.n_failed == 1 and failed.failed == ["assets = liabilities and equity (10.00%)"]


def test_guidance(spark):
    text_ = "Outlook for the group. For full year 2026 the company expects revenue of $540 million to $555 million? No: it expects revenue of $540 to $555 million. Net earnings positive. EPS of $1.10 to 1.30 a share. EPS of $1.20 a share."
    rows = filing_text.extract_guidance(spark.createDataFrame([(1, text_), (2, "short"), (3, None)], "doc int, text string")).collect()
    assert {(r.doc, r.category, r.metric, r.type_value, r.low, r.high, r.qualitative, r.period) for r in rows} >= {
        (1, "revenue", "revenue", "interval", 540.0, 555.0, None, "FY2026"),
        (1, "earnings", "eps", "interval", 1.1, 1.3, None, "FY2026"),
        (1, "earnings", "net_income", "qualitative", None, None, "positive", "FY2026"),
    }
    assert all(r.doc == 1 and r.type_value != "exact" for r in rows)


def test_reported_results_are_no_guidance(spark):
    df = spark.createDataFrame([(1, "The outlook for us is fine. In the Three Months Ended March 2024 revenue was $540 to $555 million, as expected by all.")], "doc int, text string")
    assert filing_text.extract_guidance(df).count() == 0


def test_match_positions_give_the_matches(spark):
    t = "é one. two..three... \U0001f642.end."
    rows = filing_text.regex_matches(spark.createDataFrame([(1, t)], "doc int, text string"), "text", r"\.+").collect()
    assert [r.raw for r in rows] == [".", "..", "...", ".", "."] and all(t[r.start : r.stop] == r.raw for r in rows)


def test_filing_kinds_and_narrative(spark):
    df = spark.createDataFrame([("a", "<html xmlns:ix='x'><ix:nonFraction>"), ("b", "-----BEGIN PRIVACY-ENHANCED MESSAGE-----"), ("c", "<HTML>"), ("d", "x"), ("e", None)], "accession string, content string")
    assert [r.kind for r in filing_text.classify_filing(df).orderBy("accession").collect()] == ["ixbrl", "legacy", "html", "legacy", "legacy"]
    assert [r.is_inline for r in filing_text.is_inline_xbrl(df).orderBy("accession").collect()] == [True, False, False, False, False]
    doc = "<DOCUMENT><TYPE>EX-99.1\n<DESCRIPTION>Press\n<TEXT><p>We expect fiscal year 2026 &amp; more</p></TEXT></DOCUMENT><DOCUMENT><TYPE>GRAPHIC\n<TEXT>guidance</TEXT></DOCUMENT>"
    rows = filing_text.narrative(spark.createDataFrame([("a", doc)], "accession string, content string")).orderBy("doc_no").collect()
    assert [(r.type, r.has_guidance) for r in rows] == [("EX-99.1", True)] and rows[0].text == "We expect fiscal year 2026 & more"
