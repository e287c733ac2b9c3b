"""Views of filings and early statements."""

from __future__ import annotations

from quillstone.operators import filing_text, filings, legacy

FACTS = "accession string, section string, ord long, concept string, contextRef string, unitRef string, value string"
CONTEXTS = "accession string, contextRef string, scheme string, identifier string, instant string, startDate string, endDate string, dimensions map<string,string>"
UNITS = "accession string, unitRef string, numerator array<string>, denominator array<string>"


def test_adjusted_filings(spark):
    facts = [
        ("a", "other", 0, "dei:DocumentPeriodEndDate", "d", None, "2024-03-31"),
        ("a", "balance_sheet", 1, "us-gaap:Assets", "c1", "usd", "10"),
        ("a", "balance_sheet", 2, "us-gaap:Assets", "c1", "usd", "11"),
        ("a", "balance_sheet", 3, "us-gaap:Liabilities", "c1", "usd", "4"),
        ("a", "balance_sheet", 4, "us-gaap:StockholdersEquity", "c1", "usd", "7"),
        ("a", "balance_sheet", 5, "us-gaap:StockholdersEquity", "c3", "usd", "6"),
        ("a", "balance_sheet", 6, "us-gaap:Assets", "c2", "usd", "99"),
        ("a", "balance_sheet", 7, "us-gaap:Bad", "c1", "usd", "(ixTransformError)"),
        ("a", "balance_sheet", 8, "us-gaap:Shares", "c1", "shares", "5"),
        ("a", "balance_sheet", 9, "us-gaap:NotesTextBlock", "c1", "usd", "5"),
    ]
    contexts = [("a", "c1", "s/CIK", "1", "2024-03-31", None, None, {}), ("a", "c2", "s/CIK", "1", "2023-12-31", None, None, {}), ("a", "c3", "s/CIK", "1", "2024-03-31", None, None, {"x:Axis": "x:CommonStockMember"})]
    units = [("a", "usd", ["iso4217:USD"], []), ("a", "shares", ["shares"], [])]
    got = filings.adjust_filings(spark.createDataFrame(facts, FACTS), spark.createDataFrame(contexts, CONTEXTS), spark.createDataFrame(units, UNITS))
    assert {(r.period, r.concept, r.value) for r in got.collect()} == {("2024-03-31", "us-gaap:Assets", 11.0), ("2024-03-31", "us-gaap:Liabilities", 4.0), ("2024-03-31", "us-gaap:StockholdersEquity", 7.0), ("2024-03-31", "us-gaap:StockholdersEquity [CommonStock]", 6.0)}


def test_shares(spark):
    schema = "accession string, concept string, value string, unitRef string, numerator array<string>, period_instant string, period_start string, period_end string, ord int"
    rows = [
        ("a", filings.OUTSTANDING[1], "100", "shares", None, "2024-03-31", None, None, 1),
        ("a", filings.OUTSTANDING[0], "102.5", "shares", None, "2024-03-31", None, None, 2),
        ("a", filings.BUYBACKS[0], "7", "shares", None, None, "2024-01-01", "2024-03-31", 3),
        ("a", filings.BUYBACKS[0], "9", "shares", None, None, "2023-04-01", "2024-03-31", 4),
        ("a", filings.DILUTION[0], "1", "shares", None, None, "2024-01-01", "2024-03-31", 5),
        ("a", filings.DILUTION[1], "2", "shares", None, None, "2024-01-01", "2024-03-31", 6),
        ("a", filings.DILUTION[1], "50", "shares", None, None, "2023-04-01", "2024-03-31", 7),
        ("a", filings.OUTSTANDING[0], "1", "usd", None, "2024-03-31", None, None, 8),
    ]
    got = filings.share_aggregate(spark.createDataFrame(rows, schema), spark.createDataFrame([("a", "2024-03-31")], "accession string, period string"))
    assert tuple(got.first()) == ("a", 102, 7, 3)


def test_listings_names_and_statements(spark):
    facts = spark.createDataFrame([("a", "dei:TradingSymbol", "abc", 1), ("a", "dei:EntityRegistrantName", " A Corp ", 2), ("b", "dei:NoTradingSymbolFlag", "true", 1)], "accession string, concept string, value string, ord int")
    docs = spark.createDataFrame([("a", ""), ("b", "<FILENAME>xyz-20240331.htm"), ("c", "<FILENAME>xyz-20240331.htm"), ("d", None)], "accession string, content string")
    index = spark.createDataFrame([("a", "1"), ("c", "2")], "accession string, cik string")
    companies = spark.createDataFrame([("1", "NYSE"), ("2", "Nasdaq")], "cik string, exchange string")
    got = {tuple(r) for r in filings.resolve_listing(docs, facts, index, companies).collect()}
    assert got == {("a", "ABC", "NYSE"), ("b", "NONE", "NONE"), ("c", "XYZ", "Nasdaq"), ("d", "NONE", "NONE")}
    assert [tuple(r) for r in filings.registrant_name(facts).collect()] == [("a", "A Corp")]
    named = spark.createDataFrame([("a", "us-gaap:Odd", "cash_flow")], "accession string, concept string, statement string")
    rows = spark.createDataFrame([("a", "us-gaap:Odd"), ("a", "us-gaap:Revenues"), ("a", "us-gaap:AssetsNet"), ("a", "us-gaap:Thing")], "accession string, concept string")
    assert {r.concept[8:]: r.statement for r in filings.assign_statement(rows, named).collect()} == {"Odd": "cash_flow", "Revenues": "income_statement", "AssetsNet": "balance_sheet", "Thing": "other"}
    raw = spark.createDataFrame([("a", [("p", "c"), ("p", "c")])], "accession string, calculations array<struct<parent:string,child:string>>")
    assert filings.link_tables(raw)["calculations"].count() == 1


EARLY = """CONSOLIDATED BALANCE SHEETS

<TABLE>
<CAPTION>
                         December 31, 1993   December 31, 1992
Current assets:
  Cash                        $ 1,200            1,000
  Inventories:
    Raw materials               300                (200)
Total assets                  1,500              1,200
</TABLE>
text
CONSOLIDATED STATEMENTS OF INCOME
<TABLE>
   Three Months Ended     Six Months Ended
   June 30,                June 30,
   1993     1992          1993    1992
Net sales    10   9    20   18
</TABLE>
BALANCE SHEET again
<TABLE>
x 1
</TABLE>
"""


def test_early_statements(spark):
    df = spark.createDataFrame([(1, EARLY, "1993-12-31"), (2, EARLY, "1993-06-30"), (3, "no tables", "1993-06-30")], "doc int, text string, period string")
    rows = legacy.legacy_statements(df).collect()
    balance = {r.label: r.value for r in rows if r.doc == 1 and r.kind == "balance_sheet"}
    assert balance == {"Cash [Current Assets:]": 1200.0, "Raw Materials [Inventories:]": 300.0, "Total Assets": 1500.0} or balance == {"Cash [Current Assets]": 1200.0, "Raw Materials [Inventories]": 300.0, "Total Assets": 1500.0}
    income = {r.label: (r.value, r["values"]) for r in rows if r.doc == 2 and r.kind == "income_statement"}
    assert income == {"Net Sales": (10.0, [10.0, 9.0, 20.0, 18.0])}


def test_early_filings(spark):
    content = f"-----BEGIN PRIVACY-ENHANCED MESSAGE-----\n\n<IMS-HEADER>\nACCESSION NUMBER: 0000000001-94-000001\nCONFORMED PERIOD OF REPORT: 19931231\n</IMS-HEADER>\n<DOCUMENT>\n<TEXT>\n{EARLY}</TEXT>\n</DOCUMENT>"
    r = legacy.legacy_filings(spark.createDataFrame([(1, content), (2, "nothing")], "doc int, content string")).orderBy("doc").collect()
    assert r[0].accession_number == "0000000001-94-000001" and r[0].period == "1993-12-31" and len(r[0].statements) == 4 and r[1].statements is None


def test_margin_guidance(spark):
    text = "Outlook for the group, full year 2026. Adjusted gross margin of 40% to 42%. GAAP and adjusted gross margin of approximately 38% and 41%. Adjusted gross margin at least 39%."
    got = {(r.metric, r.type_value, r.value, r.period) for r in filing_text.extract_guidance(spark.createDataFrame([(1, text)], "doc int, text string")).collect()}
    assert got == {("adjusted_gross_margin", "interval", 41.0, "FY2026"), ("gaap_gross_margin", "exact", 38.0, "FY2026"), ("adjusted_gross_margin", "exact", 41.0, "FY2026"), ("adjusted_gross_margin", "min", 39.0, "FY2026")}
