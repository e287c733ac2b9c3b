"""Queries of filing text: kinds, narrative tables, guidance of each kind, early statements and logs.

Each order stands for a text with a sentence of the pattern in question; years are ten on, as the
patterns take years from 2000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import filing_text, legacy
from quillstone.registry import register, table


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(k: Column, *values: Column | str | None) -> Column:
    listed = [F.lit(v) if not isinstance(v, Column) else v for v in values]
    return F.element_at(F.array(*listed), (k % len(values) + 1).cast("int"))


def _key() -> Column:
    return F.col("o_orderkey")


def _amount() -> Column:
    return _text(_key() % 800 + 100)


def _year(more: int = 10) -> Column:
    return _text(F.year("o_orderdate") + more)


_SQL_N, _SQL_FY = "(o_orderkey % 800 + 100)::DOUBLE", "'FY' || (year(o_orderdate) + 10)"


def _texts(spark: SparkSession, sf_dir: str, *parts: Column | str) -> DataFrame:
    """A text for each order. Orders are dealt out first, as a small table is one task's and its texts are long to read."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").repartition(tasks, "o_orderkey")
    return orders.select(_key().alias("doc"), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("text"))


def _found(df: DataFrame) -> DataFrame:
    return filing_text.extract_guidance(df).select("doc", "category", "period", "metric", "type_value", "value", "low", "high", "unit", "qualitative", "vs_prior")


def _row(metric: str, kind: str, value: str, low: str = "NULL::DOUBLE", high: str = "NULL::DOUBLE", unit: str = "NULL::VARCHAR", category: str = "earnings", words: str = "NULL::VARCHAR", prior: str = "NULL::VARCHAR", period: str = _SQL_FY, where: str = "true") -> str:
    """SQL of one piece of guidance for each order."""
    return f"SELECT o_orderkey AS doc, '{category}' AS category, {period} AS period, {metric} AS metric, '{kind}' AS type_value, {value} AS value, {low} AS low, {high} AS high, {unit} AS unit, {words} AS qualitative, {prior} AS vs_prior FROM orders WHERE {where}"


@register("t01_filing_kinds", "SELECT c_custkey, ['ixbrl', 'legacy', 'html', 'legacy', 'legacy', 'ixbrl'][(c_custkey % 6 + 1)::INT] AS kind FROM customer")
def t01_filing_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    content = _pick(k, "<html><IX:nonFraction>", "-----BEGIN Privacy-Enhanced MESSAGE-----", "<HTML><body>", "<SEC-DOCUMENT> text", "nothing", '<html xmlns:ix="x">')
    return filing_text.classify_filing(table(spark, sf_dir, "customer").select(k, F.concat(content, "c_name").alias("content"))).select("c_custkey", "kind")


@register("t02_inline_flags", "SELECT c_custkey, c_custkey % 4 = 1 AS is_inline FROM customer")
def t02_inline_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name space without facts, both, facts without a name space, neither; some have no text."""
    k = F.col("c_custkey")
    content = _pick(k, '<html xmlns:ix="x">', '<html xmlns:ix="x"><ix:nonNumeric name="a">', "<ix:header>", None)
    return filing_text.is_inline_xbrl(table(spark, sf_dir, "customer").select(k, content.alias("content"))).select("c_custkey", "is_inline")


@register(
    "p23_guidance_flags",
    "SELECT c_custkey, c_custkey % 6 IN (0, 1, 2) AS has_guidance FROM customer",
)
def p23_guidance_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the description, a word, a pattern; not for binary documents, other words or no text."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, _pick(k, "Outlook", "x", None, "guidance", "x", None).alias("description"), _pick(k, None, "our FORECAST is", "growth of 3.5% to 4%", "outlook", "we look out", None).alias("text"), _pick(k, "EX-99", "EX-99", None, "graphic", "EX-99", "EX-99").alias("type"))
    return filing_text.flag_guidance(rows).select("c_custkey", "has_guidance")


@register(
    "t04_narratives",
    """
    SELECT c_name AS accession, 1 AS doc_no, 'FORM 10-K ITEM 1. BUSINESS Overview: we make ' || c_mktsegment || ' & more. ITEM 2. PROPERTIES None: nowhere.' AS text, 'Overview: we make ' || c_mktsegment || ' & more.' AS item_1, 2 AS n_sections, c_custkey % 2 = 0 AS has_guidance
    FROM (SELECT c_name, c_custkey, c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' with an outlook' ELSE '' END AS c_mktsegment FROM customer)
    """,
)
def t04_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text and sections of a page, beside a block of facts and a picture."""
    more = F.when(F.col("c_custkey") % 2 == 0, " with an outlook").otherwise("")
    page = F.concat(F.lit("<DOCUMENT><TYPE>10-K\n<TEXT><p>FORM 10-K</p>\n<b>ITEM 1. BUSINESS</b> Overview: we make "), "c_mktsegment", more, F.lit(" &amp; more. <b>ITEM 2.</b> PROPERTIES None: nowhere.</TEXT></DOCUMENT>"))
    rest = F.lit("<DOCUMENT><TYPE>XML\n<TEXT>guidance</TEXT></DOCUMENT><DOCUMENT><TYPE>EX-101\n<TEXT><XBRL>x</XBRL></TEXT></DOCUMENT>")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), F.concat(page, rest).alias("content"))
    return filing_text.narrative(rows).select("accession", "doc_no", "text", F.try_element_at("sections", F.lit("item_1")).alias("item_1"), F.size("sections").alias("n_sections"), "has_guidance")


@register(
    "t07_revenue_ranges",
    _row("'revenue'", "interval", f"{_SQL_N} + 25", _SQL_N, f"{_SQL_N} + 50", "'million'", "revenue") + " UNION ALL " + _row("'revenue'", "interval", "1500.0", "1000.0", "2000.0", "'million'", "revenue", period="'FY' || (year(o_orderdate) + 11)"),
)
def t07_revenue_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range in millions after its year, and one in billions before its year."""
    high = _text(F.col("o_orderkey") % 800 + 150)
    first = ("In fiscal year ", _year(), " the company expects revenue of $", _amount(), " to $", high, " million. ", F.repeat(F.lit("Nothing of note. "), F.lit(12)))
    return _found(_texts(spark, sf_dir, *first, "It expects revenue of $1 to $2 billion for fiscal year ", _year(11), "."))


@register(
    "t08_revenue_singles",
    _row("'revenue'", "exact", _SQL_N, unit="'million'", category="revenue", where="o_orderkey % 2 = 0") + " UNION ALL " + _row("'revenue'", "interval", "15.0", "10.0", "20.0", "'million'", "revenue", where="o_orderkey % 2 = 1"),
)
def t08_revenue_singles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single value, which does not count where its period and metric have a range."""
    ranged = F.when(_key() % 2 == 1, " That means it expects revenue of $10 to $20 million.").otherwise("")
    return _found(_texts(spark, sf_dir, "For full year ", _year(), " the company expects revenue of $", _amount(), " million.", ranged))


@register("t09_per_share", _row("'eps'", "interval", "1.2", "1.1", "1.3", where="o_orderkey % 2 = 0") + " UNION ALL " + _row("'eps'", "exact", f"{_SQL_N} / 100", where="o_orderkey % 2 = 1"))
def t09_per_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range, whose first value alone does not count, or a single value."""
    value = F.when(_key() % 2 == 0, F.lit("EPS of $1.10 to 1.30")).otherwise(F.concat(F.lit("earnings per share of $"), F.format_string("%.2f", (_key() % 800 + 100) / 100)))
    out = _found(_texts(spark, sf_dir, "For full year ", _year(), " the company expects to report ", value, " for the year."))
    return out.withColumns({c: F.round(c, 6) for c in ("value", "low", "high")})


@register(
    "t10_net_income",
    _row("'net_income'", "interval", f"{_SQL_N} + 5", _SQL_N, f"{_SQL_N} + 10", "'million'", where="o_orderkey % 2 = 0") + " UNION ALL " + _row("'adjusted_net_income'", "qualitative", "NULL::DOUBLE", words="'breakeven'", where="o_orderkey % 2 = 1"),
)
def t10_net_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(_key() % 2 == 0, F.concat(F.lit("net income of $"), _amount(), F.lit(" to "), _text(_key() % 800 + 110), F.lit(" million"))).otherwise("adjusted net income Breakeven")
    return _found(_texts(spark, sf_dir, "For full year ", _year(), " the company expects to report ", value, " for the year."))


_MARGINS = (
    ("GAAP and adjusted gross margin of approximately 38% and 41%", (("gaap_gross_margin", "exact", "38.0"), ("adjusted_gross_margin", "exact", "41.0"))),
    ("adjusted gross margin of 40% to 42%", (("adjusted_gross_margin", "interval", "41.0"),)),
    ("adjusted gross margin of approximately 40.5%", (("adjusted_gross_margin", "exact", "40.5"),)),
    ("adjusted gross margin at least 39%", (("adjusted_gross_margin", "min", "39.0"),)),
    ("GAAP gross margin of 37%", (("gaap_gross_margin", "exact", "37.0"),)),
)


@register(
    "t11_gross_margins",
    " UNION ALL ".join(
        _row(f"'{m}'", kind, v, *(("40.0", "42.0") if kind == "interval" else ()), unit="'percent'", category="margins", where=f"o_orderkey % {len(_MARGINS)} = {i}")
        for i, (_, found) in enumerate(_MARGINS)
        for m, kind, v in found
    ),
)
def t11_gross_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(_texts(spark, sf_dir, "Outlook for the group, full year ", _year(), ". The group has ", _pick(_key(), *[s for s, _ in _MARGINS]), " in mind."))


_CHANGES = (("raised guidance", "raised"), ("lowered its outlook. It lowers forecast", "lowered"), ("reaffirmed guidance", "reiterated"), ("confirmed outlook", "maintained"), ("tightened range", "narrowed"), ("previously raised guidance", "maintained"), ("said nothing", None))


@register(
    "t12_changes",
    f"SELECT o_orderkey AS doc, ({[c for _, c in _CHANGES]!r})[(o_orderkey % {len(_CHANGES)} + 1)::INT] AS vs_prior FROM orders".replace("None", "NULL"),
)
def t12_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of change around the guidance, one of them about the past."""
    texts = _texts(spark, sf_dir, "The company ", _pick(_key(), *[w for w, _ in _CHANGES]), ". For full year ", _year(), " it expects revenue of $", _amount(), " million.")
    return _found(texts).select("doc", "vs_prior")


@register(
    "j18_nearest_metrics",
    "SELECT o_orderkey AS doc, CASE o_orderkey % 4 WHEN 0 THEN 'revenue' WHEN 1 THEN 'exome_and_genome_revenue' WHEN 2 THEN 'revenue' END AS metric FROM orders WHERE o_orderkey % 4 < 3",
)
def j18_nearest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric named last before the amount; none within reach, no guidance."""
    words = _pick(_key(), "revenue of", "exome and genome revenue of", F.concat(F.lit("exome and genome revenue, "), F.repeat(F.lit("and so on "), F.lit(8)), F.lit("and revenue of")), F.concat(F.lit("revenue "), F.repeat(F.lit("and so on "), F.lit(20))))
    return _found(_texts(spark, sf_dir, "For full year ", _year(), " the company expects to report ", words, " $", _amount(), " million.")).select("doc", "metric")


@register("j19_forward_looking", "SELECT o_orderkey AS doc FROM orders WHERE o_orderkey % 3 = 0")
def j19_forward_looking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in surroundings of guidance, of results, and of neither."""
    words = _pick(_key(), "the company expects revenue of", "the company expects revenue; it reported revenue of", "the company had revenue of")
    return _found(_texts(spark, sf_dir, "For full year ", _year(), " ", words, " $", _amount(), " million.")).select("doc")


# early filings

_EARLY = (
    "CONSOLIDATED BALANCE SHEETS\n\n<TABLE>\n<CAPTION>\n                         December 31, 1993   December 31, 1992\nCurrent assets:\n  Cash                        $ {a}            1,000\n  Inventories:\n    Raw materials               300                (200)\n"
    "Total assets                  1,500              1,200\n</TABLE>\ntext\nCONSOLIDATED STATEMENTS OF INCOME\n<TABLE>\n   Three Months Ended     Six Months Ended\n   June 30,                June 30,\n   1993     1992          1993    1992\nNet sales    {a}   9    20   18\n</TABLE>\n"
)


def _early(number: Column) -> Column:
    parts = _EARLY.split("{a}")
    return F.concat(*[x for i, p in enumerate(parts) for x in ([F.lit(p)] if i == 0 else [number, F.lit(p)])])


_EARLY_SQL = """
    SELECT s_suppkey AS doc, x.kind, x.label, CASE WHEN s_suppkey % 2 = x.even THEN CASE x.v WHEN -1 THEN s_suppkey + 10 ELSE x.v END END::DOUBLE AS value, x.n AS n_values
    FROM supplier, (VALUES ('balance_sheet', 'Cash [Current Assets]', 0, -1, 2), ('balance_sheet', 'Raw Materials [Inventories]', 0, 300, 2), ('balance_sheet', 'Total Assets', 0, 1500, 2), ('income_statement', 'Net Sales', 1, -1, 4)) x(kind, label, even, v, n)
"""


@register("t15_early_statements", _EARLY_SQL)
def t15_early_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balance sheet and an income statement, one of which shows the filing's period."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k.alias("doc"), _early(_text(k + 10)).alias("text"), F.when(k % 2 == 0, "1993-12-31").otherwise("1993-06-30").alias("period"))
    return legacy.legacy_statements(rows).select("doc", "kind", "label", "value", F.size("values").alias("n_values"))


@register("t16_early_filings", f"SELECT doc, '0000000001-94-' || lpad((doc % 1000000)::VARCHAR, 6, '0') AS accession_number, CASE WHEN doc % 2 = 0 THEN '1993-12-31' ELSE '1993-06-30' END AS period, kind, label, value FROM ({_EARLY_SQL})")
def t16_early_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with the statements of the first document."""
    k = F.col("s_suppkey")
    head = F.concat(F.lit("-----BEGIN PRIVACY-ENHANCED MESSAGE-----\n\n<IMS-HEADER>\nACCESSION NUMBER: 0000000001-94-"), F.lpad(_text(k % 1000000), 6, "0"), F.lit("\nCONFORMED PERIOD OF REPORT: "), F.when(k % 2 == 0, "19931231").otherwise("19930630"), F.lit("\n</IMS-HEADER>\n<DOCUMENT>\n<TEXT>\n"))
    rows = table(spark, sf_dir, "supplier").select(k.alias("doc"), F.concat(head, _early(_text(k + 10)), F.lit("</TEXT>\n</DOCUMENT><DOCUMENT><TEXT>more</TEXT></DOCUMENT>")).alias("content"))
    found = legacy.legacy_filings(rows)
    return found.select("doc", "accession_number", "period", F.explode("statements").alias("s")).select("doc", "accession_number", "period", "s.kind", "s.label", "s.value")


@register(
    "t18_log_lines",
    """
    SELECT 'A' || o_orderkey AS accession, ['main', 'main', 'small_cap', 'warning', 'error'][(o_orderkey % 6 + 1)::INT] AS kind, CASE WHEN o_orderkey % 6 IN (0, 2) THEN 'T' || o_custkey END AS ticker, CASE WHEN o_orderkey % 6 < 3 THEN 'NYSE' END AS exchange,
           CASE o_orderkey % 6 WHEN 1 THEN 1500.0 WHEN 2 THEN 17.5 END AS mkt_cap_mln, CASE WHEN o_orderkey % 6 < 3 THEN o_orderkey % 14 END AS failed, o_orderkey % 6 = 2 AS small_cap, CASE o_orderkey % 6 WHEN 3 THEN 'no ticker' WHEN 4 THEN 'bad: file' END AS message
    FROM orders WHERE o_orderkey % 6 < 5
    """,
)
def t18_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each form in a log for every customer; small caps stand after their header."""
    k = F.col("o_orderkey")
    name, failed = F.concat(F.lit("A"), _text(k)), _text(k % 14)
    ticker = F.concat(F.lit(" ticker=T"), _text("o_custkey"), F.lit(" exchange=NYSE"))
    line = _pick(k, F.concat(name, ticker, F.lit(": "), failed, F.lit("/14 failed")), F.concat(name, F.lit(" ticker=N/A exchange=NYSE mkt_cap=$1.5B: "), failed, F.lit("/14 failed  ")), F.concat(name, ticker, F.lit(": mkt_cap=$17.5M ("), failed, F.lit("/14 failed)")), F.concat(name, F.lit(": no ticker")), F.concat(name, F.lit(" [parse]: bad: file")), F.lit("noise"))
    kind = _pick(k, "check_failures", "check_failures", "check_failures", "check_warnings", "scrape_errors", "check_failures")
    file = F.concat(F.lit("logs/"), _text("o_custkey"), F.lit("/"), kind, F.lit(".log"))
    # failures of large companies come first, then the header, then the others
    place = F.when(k % 6 == 2, k + F.lit(1 << 40)).otherwise(k)
    orders = table(spark, sf_dir, "orders").select(file.alias("file"), place.alias("line_no"), line.alias("line"))
    heads = orders.select("file").where("file like '%check_failures%'").distinct().select("file", F.lit(1 << 40).alias("line_no"), F.lit(filing_text.SMALL_CAP_HEADER).alias("line"))
    heads = heads.withColumn("line_no", F.col("line_no") - 1)
    found = filing_text.parse_integrity_logs(orders.unionByName(heads))
    return found.select("accession", "kind", "ticker", "exchange", "mkt_cap_mln", "failed", "small_cap", "message")
