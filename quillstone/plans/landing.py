"""Queries of the readers: the tables are landed in the readers' formats, then read back and compared.

Files that hold many records each hold those of ten customers, or of one supplier, so that a file
does not grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import ids
from quillstone.operators import joins
from quillstone.operators.checkpoints import new_folder
from quillstone.operators.maintain import write_files
from quillstone.registry import register, table
from quillstone.sources import landed


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _lines(df: DataFrame, line: Column, root: str, **options: str) -> str:
    df.select(line.alias("value")).write.options(**options).text(root)
    return root


def _files(df: DataFrame, root: str, name: Column, value: Column) -> str:
    write_files(df.select(name.alias("name"), value.alias("value")), root)
    return root


def _by_tens(rows: DataFrame, key: str, record: Column, order: str) -> DataFrame:
    """(k, records): the records of ten keys, in order."""
    return rows.groupBy(F.floor(F.col(key) / 10).alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), record.alias("r")))), lambda x: x["r"]).alias("records"))


def _cik(c: str) -> Column:
    return F.lpad(_text(c), 10, "0")


@register(
    "s01_filing_index",
    """
    SELECT lpad(o_custkey::VARCHAR, 10, '0') AS cik, 'Company ' || o_custkey AS company_name, '10-' || o_orderstatus AS form_type, o_orderdate::DATE AS date_filed,
           'edgar/data/' || o_custkey || '/' || lpad(o_custkey::VARCHAR, 10, '0') || '-96-' || o_orderkey || '.txt' AS filename,
           lpad(o_custkey::VARCHAR, 10, '0') || '-96-' || o_orderkey AS accession, 1998 + (o_orderkey % 2) AS year, CASE WHEN o_orderkey % 2 = 0 THEN 'QTR3' ELSE 'QTR1' END AS quarter
    FROM orders WHERE o_orderkey % 7 <> 3
    """,
)
def s01_filing_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two quarters, one of them compressed; every seventh line is malformed in one of three ways."""
    orders, root = table(spark, sf_dir, "orders"), new_folder(spark, "landed")
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    name = F.concat(F.lit("edgar/data/"), _text("o_custkey"), F.lit("/"), _cik("o_custkey"), F.lit("-96-"), _text("o_orderkey"), F.lit(".txt"))
    good = F.concat_ws("|", _text("o_custkey"), F.concat(F.lit("Company "), _text("o_custkey")), F.concat(F.lit("10-"), "o_orderstatus"), day, name)
    bad = F.element_at(F.array(F.lit("-----------"), F.lit(""), F.lit("CIK|Company Name|Form Type|Date Filed|Filename"), F.concat(good, F.lit("|more"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    line = F.when(F.col("o_orderkey") % 7 == 3, bad).otherwise(good)
    even, odd = _lines(orders.where("o_orderkey % 2 = 0"), line, f"{root}/1998/QTR3"), _lines(orders.where("o_orderkey % 2 <> 0"), line, f"{root}/1999/QTR1", compression="gzip")
    return landed.read_filing_index(spark, [even, odd])


@register(
    "s02_year_quarter",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN year(o_orderdate) END AS year, CASE WHEN o_orderkey % 5 < 3 THEN 'QTR' || quarter(o_orderdate) END AS quarter FROM orders
    """,
)
def s02_year_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, quarter = _text(F.year("o_orderdate")), F.concat(F.lit("QTR"), _text(F.quarter("o_orderdate")))
    paths = [F.concat(F.lit("file:/x/"), year, F.lit("/"), quarter, F.lit(end)) for end in ("/10-K/a.txt", "_10-K.zip", "/b.idx")]
    odd = [F.concat(F.lit("/x/"), F.substring(year, 1, 3), F.lit("/"), quarter, F.lit("/a.txt")), F.concat(F.lit("/x/"), year, F.lit("/QTR5/a.txt"))]
    path = F.element_at(F.array(*paths, *odd), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return landed.with_year_quarter(table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path")), F.col("path")).drop("path")


@register(
    "s03_symbol_directory",
    """
    SELECT 'P' || p_partkey AS symbol, p_name AS security_name, 'Q' AS market_category, 'N' AS test_issue, CASE WHEN p_partkey % 4 <> 0 THEN 'N' END AS financial_status,
           CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 3 <> 0 THEN p_size END AS round_lot_size, CASE WHEN p_partkey % 4 <> 0 THEN 'Y' END AS etf, CASE WHEN p_partkey % 4 <> 0 THEN '' END AS nextshares FROM part
    """,
)
def s03_symbol_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded cells, a header and a trailer, short lines and lot sizes that are no numbers."""
    k, root = F.col("p_partkey"), new_folder(spark, "landed")
    short = F.concat_ws("|", F.concat(F.lit("P"), _text(k)), F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")), F.lit("Q"), F.lit("N"))
    line = F.when(k % 4 == 0, short).otherwise(F.concat_ws("|", short, F.lit("N"), F.when(k % 3 == 0, "x").otherwise(_text("p_size")), F.lit(" Y"), F.lit("")))
    part = table(spark, sf_dir, "part")
    edges = spark.createDataFrame([("Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares",), ("File Creation Time: 0101202400:00|||||||",), ("",)], "value string")
    part.select(line.alias("value")).unionByName(edges).write.text(root)
    return landed.read_symbol_directory(spark, root, "nasdaq_listed")


@register(
    "s04_series_catalog",
    """
    SELECT 'CU' || p_partkey AS series_id, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS title, p_brand AS area_code, NULL::VARCHAR AS item_code, 'S' AS seasonal,
           1990 + p_size AS begin_year, CASE WHEN p_partkey % 5 <> 0 THEN 2000 END AS end_year FROM part WHERE p_partkey % 11 <> 0
    """,
)
def s04_series_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded headers, blank titles that fall back to a synonym, lines without an id."""
    k, root = F.col("p_partkey"), new_folder(spark, "landed")
    pad = lambda c: F.concat(c, F.lit("   "))
    cells = {
        "series_id      ": pad(F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("CU"), _text(k)))),
        "area_code ": F.col("p_brand"),
        "series_title": F.when(k % 3 == 0, F.lit(" ")).otherwise(F.col("p_name")),
        "title": F.col("p_type"),
        "seasonality_code": F.lit("S "),
        "begin_year": _text(F.col("p_size") + 1990),
        "end_year  ": F.when(k % 5 == 0, "n/a").otherwise("2000"),
    }
    table(spark, sf_dir, "part").select(*[c.alias(n) for n, c in cells.items()]).write.csv(root, sep="\t", header=True)
    return landed.read_bls_series(spark, root)


def _observations(spark: SparkSession, sf_dir: str) -> str:
    k = F.col("o_orderkey")
    notes = F.array(F.struct(F.lit("P").alias("code"), F.when(k % 3 == 0, "preliminary").alias("text")), F.struct(F.lit("R").alias("code"), F.when(k % 2 == 0, "revised").alias("text")))
    value = F.when(k % 9 == 0, F.lit("-")).otherwise(_text("o_totalprice"))
    one = F.struct(_text(F.year("o_orderdate")).alias("year"), F.concat(F.lit("M"), F.date_format("o_orderdate", "MM")).alias("period"), value.alias("value"), notes.alias("footnotes"))
    series = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.struct(F.concat(F.lit("S"), _text(F.first("o_custkey"))).alias("seriesID"), F.collect_list(one).alias("data")).alias("s"))
    documents = _by_tens(series, "o_custkey", F.col("s"), "o_custkey")
    return _files(documents, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), _json(Results=F.struct(F.col("records").alias("series"))))


@register(
    "s05_observations",
    """
    SELECT 'S' || o_custkey AS series_id, date_trunc('month', o_orderdate)::DATE AS date, year(o_orderdate)::INT AS year, 'M' || strftime(o_orderdate, '%m') AS period,
           CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS value, concat_ws(', ', CASE WHEN o_orderkey % 3 = 0 THEN 'preliminary' END, CASE WHEN o_orderkey % 2 = 0 THEN 'revised' END) AS footnotes FROM orders
    """,
)
def s05_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.read_bls_observations(spark, _observations(spark, sf_dir))


@register(
    "o04_observations_by_date",
    "SELECT 'S' || o_custkey AS series_id, date_trunc('month', o_orderdate)::DATE AS date, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS value FROM orders ORDER BY 1, 2",
)
def o04_observations_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.in_date_order(landed.read_bls_observations(spark, _observations(spark, sf_dir)).select("series_id", "date", "value"))


_CUBE_SQL = """
    SELECT 'd' || (o_custkey // 10) AS code, make_date(year(o_orderdate), 1, 1) AS date, max(o_totalprice) AS value, 'GEO:C' || (o_custkey % 10) AS dimension_key
    FROM orders GROUP BY o_custkey, year(o_orderdate)
"""


@register("s06_sdmx_observations", _CUBE_SQL.replace("'d' || (o_custkey // 10) AS code", "'cube' AS code"))
def s06_sdmx_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers and the years are the two dimensions of a document; one key points beyond a code list."""
    year = F.year("o_orderdate")
    cells = table(spark, sf_dir, "orders").groupBy("o_custkey", year.alias("y")).agg(F.max("o_totalprice").alias("v"))
    entry = F.struct(F.concat(_text(F.col("o_custkey") % 10), F.lit(":"), _text(F.col("y") - 1990)).alias("key"), F.array(_text("v")).alias("value"))
    observations = cells.groupBy(F.floor(F.col("o_custkey") / 10).alias("k")).agg(F.map_from_entries(F.concat(F.collect_list(entry), F.array(F.struct(F.lit("0:99").alias("key"), F.array(F.lit("1")).alias("value"))))).alias("obs"))
    code = lambda c: F.struct(c.alias("id"), c.alias("name"))
    geo = F.struct(F.lit("GEO").alias("id"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: code(F.concat(F.lit("C"), _text(i)))).alias("values"))
    time = F.struct(F.lit("TIME_PERIOD").alias("id"), F.transform(F.sequence(F.lit(1990), F.lit(2029)), lambda i: code(_text(i))).alias("values"))
    value = _json(structure=F.struct(F.struct(F.array(geo, time).alias("observation")).alias("dimensions")), dataSets=F.array(F.struct(F.col("obs").alias("observations"))))
    root = _files(observations, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), value)
    return landed.read_sdmx_json(spark, root, "cube").select("code", "date", "value", "dimension_key")


@register(
    "s07_sdmx_table",
    """
    SELECT 'orders' AS code, date_trunc('quarter', o_orderdate)::DATE AS date, o_totalprice AS value, 'KEY:' || o_orderkey || '|PRIORITY:' || o_orderpriority AS dimension_key FROM orders
    UNION ALL SELECT 'parts', make_date(1990 + i::INT, 1, 1), CASE i WHEN 1 THEN p_size ELSE p_retailprice END, 'KEY:' || p_partkey FROM part, range(1, 3) r(i)
    """,
)
def s07_sdmx_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long frame, and a wide one whose columns are years."""
    quarter = F.concat(_text(F.year("o_orderdate")), F.lit("-Q"), _text(F.quarter("o_orderdate")))
    long = table(spark, sf_dir, "orders").select(_text("o_orderkey").alias("KEY"), F.col("o_orderpriority").alias("PRIORITY"), quarter.alias("TIME_PERIOD"), F.col("o_totalprice").alias("OBS_VALUE"))
    wide = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("KEY"), F.col("p_size").alias("1991"), F.col("p_retailprice").alias("1992"))
    return landed.read_sdmx_table(long, "orders").unionByName(landed.read_sdmx_table(wide, "parts")).select("code", "date", "value", "dimension_key")


@register("s08_indicator_table", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '1999-08-31 00:00:00'")
def s08_indicator_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.read_indicator_table(spark, f"{sf_dir}/orders.parquet", "1996-02-01", "1999-08-31").select("o_orderkey", "o_orderdate", "o_totalprice")


@register(
    "s09_series_pages",
    """
    WITH pages AS (SELECT 'CHN' || (o_orderkey % 5000) AS series_id, lpad((o_custkey // 10)::VARCHAR, 9, '0') AS page, o_orderkey AS pos, o_orderstatus AS title, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'text' END AS notes FROM orders)
    SELECT series_id, title, notes, 'China' AS country FROM pages QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY page, pos) = 1
    """,
)
def s09_series_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose series come again on others; notes that are missing fall back to the description."""
    k = F.col("o_orderkey")
    record = F.struct(F.concat(F.lit("CHN"), _text(k % 5000)).alias("id"), F.col("o_orderstatus").alias("title"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("notes"), F.lit("text").alias("description"))
    pages = _by_tens(table(spark, sf_dir, "orders"), "o_custkey", record, "o_orderkey")
    root = _files(pages, new_folder(spark, "landed"), F.concat(F.lpad(_text("k"), 9, "0"), F.lit(".json")), _json(seriess=F.col("records")))
    return landed.read_series_catalog(spark, root).select("series_id", "title", "notes", "country")


@register("s10_category_pages", "SELECT c_custkey AS category_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_nationkey END AS parent_id FROM customer")
def s10_category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    record = F.struct(k.alias("id"), F.col("c_name").alias("name"), F.when(k % 3 != 0, F.col("c_nationkey")).alias("parent_id"))
    customers = table(spark, sf_dir, "customer")
    pages = _by_tens(customers.unionByName(customers.where("c_custkey % 5 = 0")), "c_custkey", record, "c_custkey")
    root = _files(pages, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), _json(categories=F.col("records")))
    return landed.read_categories(spark, root)


@register(
    "s11_company_exchange",
    "SELECT lpad(c_custkey::VARCHAR, 10, '0') AS cik, 'T' || c_custkey AS ticker, c_name AS title, c_mktsegment AS exchange FROM customer WHERE c_custkey % 4 <> 1 AND c_custkey % 6 <> 2",
)
def s11_company_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists and dicts of records, some without an exchange or a number."""
    k = F.col("c_custkey")
    record = F.struct(F.when(k % 6 != 2, _text(k)).alias("cik_str"), F.concat(F.lit("T"), _text(k)).alias("ticker"), F.col("c_name").alias("title"), F.when(k % 4 != 1, F.col("c_mktsegment")).otherwise(" ").alias("exchange"))
    groups = _by_tens(table(spark, sf_dir, "customer"), "c_custkey", record, "c_custkey")
    as_map = F.map_from_entries(F.transform("records", lambda r, i: F.struct(_text(i).alias("key"), r.alias("value"))))
    value = F.when(F.col("k") % 2 == 0, F.to_json("records")).otherwise(F.to_json(as_map))
    return landed.read_company_exchange(spark, _files(groups, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), value))


@register(
    "s12_code_tables",
    """
    SELECT s_suppkey, s_name AS a, CASE WHEN s_suppkey % 2 = 0 THEN 'N ' || s_nationkey ELSE '' END AS b, CASE WHEN s_suppkey % 6 = 0 THEN 'x' ELSE '' END AS c FROM supplier WHERE s_suppkey % 5 <> 1
    UNION ALL SELECT s_suppkey, s_name, 'N ' || s_nationkey, '' FROM supplier WHERE s_suppkey % 5 = 1
    """,
)
def s12_code_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one to three cells; every fifth page has its table in lines instead."""
    k, td = F.col("s_suppkey"), lambda c: F.concat(F.lit('<td class="x"> <b>'), c, F.lit("</b>\n</td>"))
    nation = F.concat(F.lit("N "), _text("s_nationkey"))
    cells = F.concat(td(F.col("s_name")), F.when(k % 2 == 0, td(nation)).otherwise(""), F.when(k % 6 == 0, td(F.lit("x"))).otherwise(""))
    page = F.concat(F.lit("<table><tr><th>Code</th></tr><TR>"), cells, F.lit("</TR></table>"))
    lines = F.concat(F.lit("text\n | "), F.col("s_name"), F.lit(" | "), nation, F.lit(" |\nmore"))
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 5 == 1, lines).otherwise(page).alias("html"))
    rows = landed.read_html_table(pages)
    return rows.select("s_suppkey", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate("abc")])


@register(
    "s13_listing_table",
    "SELECT 'T' || (s_suppkey % 9999) AS ticker, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN '/us/products/' || s_suppkey END AS link FROM supplier WHERE s_suppkey % 4 <> 2",
)
def s13_listing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with links or without, and rows without a ticker."""
    k = F.col("s_suppkey")
    name = F.when(k % 3 != 0, F.concat(F.lit("<a href='/us/products/"), _text(k), F.lit("'>"), F.col("s_name"), F.lit("</a>"))).otherwise(F.col("s_name"))
    ticker = F.when(k % 4 != 2, F.concat(F.lit("T"), _text(k % 9999))).otherwise("no ticker")
    page = F.concat(F.lit("<table><tr><td>"), ticker, F.lit("</td><td>"), name, F.lit("</td></tr></table>"))
    return landed.parse_listing_table(table(spark, sf_dir, "supplier").select(page.alias("html"))).select("ticker", "name", "link")


def _holdings_files(spark: SparkSession, sf_dir: str) -> str:
    row = F.concat_ws(",", F.concat(F.lit('"P, ""'), _text("p_partkey"), F.lit('"""')), F.col("p_brand"), _text("p_size"))
    groups = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 10).alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]).alias("rows"))
    second = F.transform("rows", lambda r: F.concat(F.lit("T"), F.substring(r, 1, 1), F.lit(",x,1")))
    text = F.concat_ws("\r\n", F.lit("Fund Holdings as of,today"), F.lit(""), F.lit("Name,Sector,Weight (%)"), F.col("rows"), F.lit(""), F.lit("Ticker,Name,Weight (%)"), F.slice(second, 1, 2))
    return _files(groups, new_folder(spark, "landed"), F.concat(F.lit("F"), _text("k"), F.lit(".csv")), text)


@register("s14_two_sections", "SELECT 'F' || (p_partkey // 10) AS file, 'P, \"' || p_partkey || '\"' AS name, p_brand AS sector, p_size::VARCHAR AS weight_pct FROM part")
def s14_two_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first section of files with a preamble, two headers, blank lines and quoted cells."""
    rows = landed.read_two_section_csv(spark, _holdings_files(spark, sf_dir))
    get = lambda k: F.element_at("record", k).alias(k)
    return landed.section_records(rows, 1).select("file", get("name"), get("sector"), get("weight_pct"))


@register("w08_section_rows", "SELECT 'F' || k AS file, 2 AS section, least(n, 2)::BIGINT AS n FROM (SELECT p_partkey // 10 AS k, count(*) AS n FROM part GROUP BY 1)")
def w08_section_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed.read_two_section_csv(spark, _holdings_files(spark, sf_dir))
    return rows.where("section = 2 and not is_header").groupBy("file", F.col("section").cast("int").alias("section")).agg(F.count("*").alias("n"))


@register("s15_symbol_documents", "SELECT s_name AS symbol, s_nationkey::VARCHAR AS nation, CASE WHEN s_suppkey % 2 = 0 THEN 'even' END AS kind FROM supplier WHERE s_suppkey % 5 <> 0")
def s15_symbol_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each supplier, every fifth unreadable."""
    k = F.col("s_suppkey")
    value = F.when(k % 5 == 0, "{broken").otherwise(_json(nation=_text("s_nationkey"), kind=F.when(k % 2 == 0, "even")))
    root = _files(table(spark, sf_dir, "supplier"), new_folder(spark, "landed"), F.concat("s_name", F.lit(".json")), value)
    found = landed.read_symbol_documents(spark, root, "equity_info")
    return found.select("symbol", F.try_element_at("document", F.lit("nation")).alias("nation"), F.try_element_at("document", F.lit("kind")).alias("kind"))


#: Array documents by kind, with a number and a text field of each.
_ARRAYS = {
    "analyst_recommendations": ("buy", "period"),
    "eps_revisions": ("upLast7days", "period"),
    "revenue_estimates": ("numberOfAnalysts", "period"),
    "earnings_calendar": ("epsEstimate", "date"),
    "earnings_history": ("epsActual", "quarter"),
    "sec_filings": (None, "type"),
}


@register(
    "s17_document_kinds",
    f"""
    SELECT kind, s_name AS symbol, CASE WHEN kind <> 'sec_filings' THEN s_nationkey END::DOUBLE AS number, 'p' || (s_suppkey % 3) AS label
    FROM supplier, (SELECT unnest({list(_ARRAYS)}) AS kind)
    UNION ALL SELECT 'analyst_price_targets', s_name, s_acctbal, NULL FROM supplier
    UNION ALL SELECT 'financial_statements', s_name, s_nationkey, 'p' || (s_suppkey % 3) FROM supplier
    UNION ALL SELECT 'calendar', s_name, s_nationkey, 'p' || (s_suppkey % 3) FROM supplier
    """,
)
def s17_document_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of nine kinds, each with a field that its shape does not declare."""
    suppliers, root, out = table(spark, sf_dir, "supplier"), new_folder(spark, "landed"), []
    number, label, name = F.col("s_nationkey"), F.concat(F.lit("p"), _text(F.col("s_suppkey") % 3)), F.concat("s_name", F.lit(".json"))
    null = lambda kind: F.lit(None).cast(kind)
    for kind, (n, t) in _ARRAYS.items():
        record = F.struct(*([number.alias(n)] if n else []), label.alias(t), F.lit("x").alias("undeclared"))
        docs = landed.read_symbol_documents(spark, _files(suppliers, f"{root}/{kind}", name, F.to_json(F.array(record))), kind)
        first = F.get("document", F.lit(0))
        out.append(docs.select(F.lit(kind).alias("kind"), "symbol", (first[n].cast("double") if n else null("double")).alias("number"), first[t].alias("label")))
    docs = landed.read_symbol_documents(spark, _files(suppliers, f"{root}/targets", name, _json(mean=F.col("s_acctbal"), other=label)), "analyst_price_targets")
    out.append(docs.select(F.lit("analyst_price_targets").alias("kind"), "symbol", F.col("document.mean").alias("number"), null("string").alias("label")))
    for kind, value in (("financial_statements", F.to_json(F.array(F.struct(number.alias("n"), label.alias("t"))))), ("calendar", _json(n=number, t=label))):
        docs = landed.read_symbol_documents(spark, _files(suppliers, f"{root}/{kind}", name, value), kind)
        m = F.get("document", F.lit(0)) if kind == "financial_statements" else F.col("document")
        out.append(docs.select(F.lit(kind).alias("kind"), "symbol", m["n"].cast("double").alias("number"), m["t"].alias("label")))
    for df in out[1:]:
        out[0] = out[0].unionByName(df)
    return out[0]


@register(
    "s16_ohlcv",
    """
    SELECT s_name AS symbol, DATE '2024-01-01' + (s_suppkey % 300)::INT AS date, s_acctbal AS close, NULL::DOUBLE AS open, CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS volume, 'landed' AS source
    FROM supplier WHERE s_suppkey % 7 <> 0
    """,
)
def s16_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each supplier, without some columns, with volumes that are no numbers and days that are no dates."""
    k = F.col("s_suppkey")
    day = F.when(k % 7 == 0, F.lit("never")).otherwise(_text(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))))
    text = F.concat(F.lit("Date,Close,Volume\n"), day, F.lit(" 00:00:00,"), _text("s_acctbal"), F.lit(","), F.when(k % 3 == 0, "n/a").otherwise(_text(k)), F.lit("\n"))
    root = _files(table(spark, sf_dir, "supplier"), new_folder(spark, "landed"), F.concat("s_name", F.lit(".csv")), text)
    return landed.read_ohlcv(spark, root).select("symbol", "date", "close", "open", "volume", "source")


@register("s18_paged_csv", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority FROM orders")
def s18_paged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "landed")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").repartition(5).write.csv(root, header=True)
    return landed.read_paged_csv(spark, root)


@register("s19_dataset_groups", 'SELECT DISTINCT \'G\' || (p_size % 7) AS "group", NULL::VARCHAR AS name FROM part UNION ALL SELECT \'G\' || (p_size % 7), p_name FROM part')
def s19_dataset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's rows, and its distinct groups."""
    record = F.struct(F.concat(F.lit("G"), _text(F.col("p_size") % 7)).alias("group"), F.col("p_name").alias("name"), F.col("p_type").alias("description"))
    pages = _by_tens(table(spark, sf_dir, "part"), "p_partkey", record, "p_partkey")
    catalog = landed.read_dataset_catalog(spark, _files(pages, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), _json(datasets=F.col("records"))))
    return landed.dataset_groups(catalog).withColumn("name", F.lit(None).cast("string")).unionByName(catalog.select("group", "name"))


@register(
    "s20_candles",
    "SELECT epoch_ms(o_orderdate) AS t, o_orderdate AS start, 'C' || (o_custkey % 50) AS s, '1d' AS i, o_totalprice AS o, o_totalprice AS c, o_orderkey AS n FROM orders WHERE 'C' || (o_custkey % 50) <> 'C7'",
)
def s20_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles of the coins that the metadata lists."""
    root = new_folder(spark, "landed")
    coin, ms = F.concat(F.lit("C"), _text(F.col("o_custkey") % 50)), F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    record = F.create_map(*[x for n, c in (("t", ms), ("T", ms + 86_399_999), ("s", coin), ("i", F.lit("1d")), ("o", F.col("o_totalprice")), ("c", F.col("o_totalprice")), ("h", F.col("o_totalprice")), ("l", F.lit(0)), ("v", F.lit(1)), ("n", F.col("o_orderkey"))) for x in (F.lit(n), _text(c))])
    orders = table(spark, sf_dir, "orders")
    snapshots = orders.groupBy(F.floor(F.col("o_custkey") / 10).alias("k")).agg(F.collect_list(record).alias("records"))
    names = orders.select(coin.alias("name")).where("name <> 'C7'").distinct().agg(F.array_sort(F.collect_list(F.struct("name"))).alias("u"))  # 50 at most
    meta = _files(names, f"{root}/meta", F.lit("meta.json"), _json(universe=F.concat("u", F.array(F.struct(F.lit(None).cast("string").alias("name"))))))
    candles = landed.read_candles(spark, _files(snapshots, f"{root}/candles", F.concat(_text("k"), F.lit(".json")), F.to_json("records")))
    return candles.join(landed.read_coins(spark, meta), F.col("s") == F.col("coin"), "left_semi").select("t", "start", "s", "i", "o", "c", "n")


@register("s21_trades", "SELECT event_type AS coin, CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'A' END AS side, value AS px, 1.5 AS sz, make_timestamp(epoch_us(ts) // 1000 * 1000) AS time, event_id AS tid FROM events")
def s21_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_id") % 2 == 0, "B").otherwise("A")
    line = _json(coin=F.col("event_type"), side=side, px=_text("value"), sz=F.lit("1.5"), time=F.unix_millis(F.col("ts").cast("timestamp")), tid=F.col("event_id"))
    return landed.read_trades(spark, _lines(table(spark, sf_dir, "events"), line, new_folder(spark, "landed")))


@register("s22_filings", "SELECT s_name AS accession, 'text of ' || s_suppkey AS content FROM supplier WHERE s_suppkey % 3 = 0")
def s22_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter and form of three; another kind of file lies beside them."""
    form = F.element_at(F.array(F.lit("1998/QTR2/10-K_A/"), F.lit("1998/QTR2/10-K/"), F.lit("1998/QTR3/10-K_A/")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    suppliers, root = table(spark, sf_dir, "supplier"), new_folder(spark, "landed")
    _files(suppliers, root, F.concat(form, "s_name", F.lit(".txt")), F.concat(F.lit("text of "), _text("s_suppkey")))
    _files(suppliers, root, F.concat(form, "s_name", F.lit(".json")), F.lit("{}"))
    return landed.read_filings(spark, root, 1998, "QTR2", "10-K/A")


def _zipped(batches):
    import io
    import zipfile

    import pyarrow as pa

    for b in batches:
        out = []
        for names, texts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                for n, t in zip(names, texts, strict=True):
                    z.writestr(f"1998_QTR2/{n}.txt", t)
                    z.writestr(f"__MACOSX/{n}.txt", "no")
                z.writestr("readme.md", "no")
            out.append(held.getvalue())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["name", "value"])


@register("s23_zip_archives", "SELECT 'A' || (c_custkey // 10) AS archive, c_name AS accession, 'text of ' || c_custkey AS content FROM customer")
def s23_zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with the members of ten customers each, folders of another system and other files."""
    groups = table(spark, sf_dir, "customer").groupBy(F.concat(F.lit("A"), _text(F.floor(F.col("c_custkey") / 10)), F.lit(".zip")).alias("name")).agg(F.collect_list(F.struct("c_name", F.concat(F.lit("text of "), _text("c_custkey")).alias("t"))).alias("m"))
    archives = groups.select("name", F.col("m.c_name").alias("names"), F.col("m.t").alias("texts")).mapInArrow(_zipped, "name string, value binary")
    root = new_folder(spark, "landed")
    write_files(archives, root)
    found = landed.read_filings_zip(spark, f"{root}/*.zip", members_at_once=4)
    return found.withColumn("archive", F.regexp_extract("archive", r"([^/]+)\.zip$", 1))


def xbrl_files(spark: SparkSession, sf_dir: str) -> str:
    """A fact file for each customer, in 256 folders, as a pattern: three facts, two contexts, two units."""
    k, number = F.col("c_custkey"), _text("c_acctbal")

    def fact(concept: str, unit: str, value: Column, context: str | None = None) -> Column:
        ref = F.lit(context) if context else F.concat(F.lit("c"), _text(k % 2))
        return F.struct(F.lit(concept).alias("concept"), ref.alias("contextRef"), F.lit(unit).alias("unitRef"), value.alias("value"))

    def context(end: str, dimensions: Column) -> Column:
        entity = F.struct(F.lit("http://www.sec.gov/CIK").alias("scheme"), _text(k).alias("identifier"))
        return F.struct(entity.alias("entity"), F.struct(F.lit("1998-01-01").alias("startDate"), F.lit(end).alias("endDate")).alias("period"), dimensions.alias("dimensions"))

    def unit(measure: str) -> Column:
        return F.struct(F.struct(F.array(F.lit(measure)).alias("numerator"), F.array().cast("array<string>").alias("denominator")).alias("measures"))

    member, none = F.create_map(F.lit("us-gaap:Axis"), F.lit("us-gaap:PartMember")), F.create_map().cast("map<string,string>")
    doc = _json(
        balance_sheet=F.array(fact("us-gaap:Assets", "usd", number), fact("us-gaap:CommonStockSharesOutstanding", "shares", _text(k), "c0")),
        income_statement=F.array(fact("us-gaap:Revenues", "usd", F.when(k % 7 == 0, "(ix Error)").otherwise(number), "gone")),
        contexts=F.create_map(F.lit("c0"), context("1998-12-31", none), F.lit("c1"), context("1999-03-31", member)),
        units=F.create_map(F.lit("usd"), unit("iso4217:USD"), F.lit("shares"), unit("xbrli:shares")),
    )
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = F.concat(F.format_string("%02x/", F.pmod(F.xxhash64("c_name"), F.lit(256))), "c_name", F.lit(".xbrl.json"))
    return _files(table(spark, sf_dir, "customer").repartition(tasks, "c_custkey"), new_folder(spark, "landed"), name, doc) + "/*"


@register(
    "s24_raw_facts",
    """
    SELECT c_name AS accession, 'balance_sheet' AS section, 'us-gaap:Assets' AS concept, c_acctbal::DOUBLE AS value, c_custkey::VARCHAR AS entity_identifier, CASE WHEN c_custkey % 2 = 0 THEN '1998-12-31' ELSE '1999-03-31' END AS period_end, 'iso4217:USD' AS unit, CASE WHEN c_custkey % 2 = 1 THEN 'us-gaap:Axis:us-gaap:PartMember' ELSE '' END AS dims FROM customer
    UNION ALL SELECT c_name, 'balance_sheet', 'us-gaap:CommonStockSharesOutstanding', c_custkey, c_custkey::VARCHAR, '1998-12-31', 'xbrli:shares', '' FROM customer
    UNION ALL SELECT c_name, 'income_statement', 'us-gaap:Revenues', CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END, NULL, NULL, 'iso4217:USD', '' FROM customer
    """,
)
def s24_raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with their contexts and units; one context is unknown."""
    facts, contexts, units = landed.read_xbrl_json(spark, xbrl_files(spark, sf_dir))
    rows = joins.with_units(joins.inline_contexts(facts, contexts), units)
    dims = ids.dimension_key(F.col("dimensions"))
    return rows.select("accession", "section", "concept", F.col("value").try_cast("double").alias("value"), "entity_identifier", "period_end", F.get("numerator", F.lit(0)).alias("unit"), dims.alias("dims"))


@register(
    "s25_adjusted_facts",
    """
    SELECT c_name AS accession, '1998-12-31' AS period, 'balance_sheet' AS section, 'us-gaap:Assets' AS concept, c_acctbal::DOUBLE AS value FROM customer
    UNION ALL SELECT c_name, '1999-12-31', 'other', 'us-gaap:Shares', c_custkey FROM customer
    """,
)
def s25_adjusted_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = lambda s, k, v: F.create_map(F.lit(s), F.create_map(F.lit(k), _text(v)))
    periods = F.create_map(F.lit("1998-12-31"), sections("balance_sheet", "us-gaap:Assets", F.col("c_acctbal")), F.lit("1999-12-31"), sections("other", "us-gaap:Shares", F.col("c_custkey")))
    more = F.to_json(F.struct(F.col("c_mktsegment").alias("ticker"), F.lit("X").alias("exchange"), F.create_map(F.lit("a"), F.lit("b")).alias("dei")))
    text = F.concat(F.expr("left(t, length(t) - 1)"), F.lit(","), F.expr("substring(m, 2)"))
    rows = table(spark, sf_dir, "customer").withColumns({"t": F.to_json(periods), "m": more})
    root = _files(rows, new_folder(spark, "landed"), F.concat("c_name", F.lit(".xbrl.adj.json")), text)
    found = landed.read_adj_json(spark, root)
    return found.select("accession", "period", "section", "concept", F.col("value").cast("double").alias("value"))


@register("s26_product_tables", "SELECT c_name AS key, c_mktsegment AS value, 'metadata' AS source FROM customer")
def s26_product_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's stored table, and one of which nothing is stored."""
    root = new_folder(spark, "landed")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("key"), F.col("c_mktsegment").alias("value"), F.lit(None).cast("timestamp").alias("updated_at"))
    rows.write.parquet(f"{root}/macro/metadata")
    both = [landed.table(spark, root, "macro", n).select(F.col(k).alias("key"), F.col(v).alias("value"), F.lit(n).alias("source")) for n, k, v in (("metadata", "key", "value"), ("datasets", "code", "title"))]
    return both[0].unionByName(both[1])


@register("s27_missing_catalog", "SELECT s_suppkey, s_name FROM supplier")
def s27_missing_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    found = landed.read_parquet_or_empty(spark, f"{sf_dir}/supplier.parquet", suppliers.schema)
    return found.unionByName(landed.read_parquet_or_empty(spark, f"{new_folder(spark, 'landed')}/nothing", suppliers.schema))


@register(
    "s29_dataset_lists",
    "SELECT 'D' || p_partkey AS code, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_type ELSE 'D' || p_partkey END AS title, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS description, '1.0' AS version FROM part WHERE p_partkey % 13 <> 5",
)
def s29_dataset_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose ids and names go by different synonyms, or have none."""
    k = F.col("p_partkey")
    code = F.when(k % 13 != 5, F.concat(F.lit("D"), _text(k)))
    record = F.struct(
        F.when(k % 2 == 0, code).alias("id"), F.when(k % 2 != 0, code).alias("indicator_code"), F.when(k % 3 == 0, F.col("p_name")).alias("name"), F.when(k % 3 == 1, F.col("p_type")).alias("Name"), F.when(k % 2 == 0, F.col("p_brand")).alias("desc"), F.lit("1.0").alias("version")
    )
    spark.conf.set("spark.sql.caseSensitive", "true")  # two of the names differ by case only
    try:
        pages = _by_tens(table(spark, sf_dir, "part"), "p_partkey", record, "p_partkey")
        root = _files(pages, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), F.to_json("records"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    return landed.read_dataset_list(spark, root)


def _structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(F.struct(F.col("s_name").alias("id"), F.concat(F.lit("Name of "), "s_name").alias("name")))
    dimension = lambda i, n, c: F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), c.alias("codes"))
    none = F.array().cast("array<struct<id:string,name:string>>")
    value = _json(code=F.concat(F.lit("D"), _text("s_suppkey")), dimensions=F.array(dimension("GEO", "Place", codes), dimension("FREQ", "Frequency", none)))
    return landed.read_structures(spark, _files(table(spark, sf_dir, "supplier"), new_folder(spark, "landed"), F.concat("s_name", F.lit(".json")), value))


@register(
    "s30_structures",
    """
    SELECT 'D' || s_suppkey AS code, 'GEO' AS dimension, 'Place' AS dimension_name, s_name AS value, 'Name of ' || s_name AS value_name, 'FREQ, GEO' AS keywords FROM supplier
    UNION ALL SELECT 'D' || s_suppkey, 'FREQ', 'Frequency', NULL, NULL, 'FREQ, GEO' FROM supplier
    """,
)
def s30_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir)
    return rows.join(landed.keywords(rows), "code")


@register(
    "s31_series_metadata",
    """
    SELECT 'S' || c_custkey AS series_id, c_name AS series_title, c_mktsegment AS survey_name, upper(c_mktsegment) AS survey FROM customer WHERE c_custkey % 4 <> 2
    """,
)
def s31_series_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with a catalog, without one and with one that has no id; the survey's name by its abbreviation."""
    k = F.col("c_custkey")
    catalog = F.struct(F.when(k % 8 != 6, F.concat(F.lit("S"), _text(k))).alias("series_id"), F.col("c_name").alias("series_title"), F.col("c_mktsegment").alias("survey_name"))
    record = F.struct(F.concat(F.lit("S"), _text(k)).alias("seriesID"), F.when(k % 8 != 2, catalog).alias("catalog"))
    customers = table(spark, sf_dir, "customer")
    pages = _by_tens(customers, "c_custkey", record, "c_custkey")
    root = _files(pages, new_folder(spark, "landed"), F.concat(_text("k"), F.lit(".json")), _json(Results=F.struct(F.col("records").alias("series"))))
    surveys = landed.survey_lookup(customers.select(F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("survey_abbreviation"), F.col("c_mktsegment").alias("survey_name")))
    return landed.read_series_metadata(spark, root).join(surveys.withColumnRenamed("name", "survey_name"), "survey_name")
