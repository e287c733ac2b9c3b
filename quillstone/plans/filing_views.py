"""Queries of filing views and fact predicates, and of functions on identifiers, dates and numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import dates, ids, numbers, text
from quillstone.operators import aggregate, checks, filings, joins, select
from quillstone.registry import register, table


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(k: Column, *values: Column | str | None) -> Column:
    """The value at k modulo their number."""
    listed = [F.lit(v) if not isinstance(v, Column) else v for v in values]
    return F.element_at(F.array(*listed), (k % len(values) + 1).cast("int"))


# predicates


@register(
    "p18_currency_units",
    "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN true WHEN 4 THEN false ELSE false END AS is_currency FROM customer",
)
def p18_currency_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One currency; two numerators; a denominator; no definition and the id usd; no definition and another id; shares."""
    k, none = F.col("c_custkey"), F.lit(None).cast("array<string>")
    usd, shares = F.array(F.lit("iso4217:USD")), F.array(F.lit("xbrli:shares"))
    numerator = _pick(k, usd, F.array(F.lit("iso4217:USD"), F.lit("iso4217:EUR")), usd, none, none, shares)
    denominator, unit = F.when(k % 6 == 2, shares), _pick(k, "u1", "u2", "u3", "USD", "pure", "u4")
    return table(spark, sf_dir, "customer").select(k, select.is_currency_unit(numerator, denominator, unit).alias("is_currency"))


@register("p19_share_units", "SELECT c_custkey, c_custkey % 4 < 3 AS is_share FROM customer")
def p19_share_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    unit, numerator = _pick(k, "Shares", "u1", "LP-Units", "usd"), _pick(k, F.lit(None).cast("array<string>"), F.array(F.lit("xbrli:shares")), F.array(F.lit("x")), F.array(F.lit("iso4217:USD")))
    return table(spark, sf_dir, "customer").select(k, select.is_share_unit(unit, numerator).alias("is_share"))


@register("p20_text_blocks", "SELECT p_partkey, p_partkey % 3 <> 1 AS kept FROM part")
def p20_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    concept = _pick(k, "us-gaap:Assets", "us-gaap:PolicyTextBlock", "TextBlock:Assets")
    return table(spark, sf_dir, "part").select(k, select.not_text_block(concept).alias("kept"))


@register("p21_no_symbol", "SELECT c_name AS accession FROM customer WHERE c_custkey % 6 IN (0, 1, 3)")
def p21_no_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    facts = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), _pick(k, "dei:NoTradingSymbolFlag", "NoTradingSymbolFlag", "dei:TradingSymbol", "dei:NoTradingSymbolFlag", "dei:NoTradingSymbolFlag", "dei:NoTradingSymbolFlag").alias("concept"), _pick(k, "true", "1", "true", " TRUE ", "false", None).alias("value"))
    return select.no_symbol_filers(facts.unionByName(facts))


# joins


@register("j10_fact_units", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'R' THEN 'iso4217:' || l_returnflag END AS unit FROM lineitem")
def j10_fact_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    facts = lines.select(_text("l_orderkey").alias("accession"), F.col("l_returnflag").alias("unitRef"), "l_orderkey", "l_linenumber", "l_partkey")
    units = facts.where("unitRef <> 'R'").select("accession", "unitRef", F.array(F.concat(F.lit("iso4217:"), "unitRef")).alias("numerator"), F.array().cast("array<string>").alias("denominator")).distinct()
    return joins.with_units(facts, units).select("l_orderkey", "l_linenumber", "l_partkey", F.get("numerator", F.lit(0)).alias("unit"))


@register(
    "j11_statements",
    "SELECT c_name AS accession, c_custkey % 6 AS kind, ['cash_flow', 'income_statement', 'balance_sheet', 'cash_flow', 'other', 'balance_sheet'][(c_custkey % 6 + 1)::INT] AS statement FROM customer",
)
def j11_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts that the presentation places, and ones that only their names do."""
    k = F.col("c_custkey")
    concept = _pick(k, "us-gaap:Odd", "us-gaap:Revenues", "us-gaap:AssetsNet", "us-gaap:PaymentsToAcquireThings", "us-gaap:Thing", "us-gaap:AccountsPayable")
    facts = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), concept.alias("concept"), (k % 6).alias("kind"))
    named = facts.where("kind = 0").select("accession", "concept", F.explode(F.array(F.lit("cash_flow"), F.lit("other"))).alias("statement"))
    return filings.assign_statement(facts, named).select("accession", "kind", "statement")


@register("j12_labels", "SELECT l_orderkey, l_linenumber, l_partkey, arg_min('L' || l_suppkey, (l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey) OVER (PARTITION BY l_orderkey, l_returnflag) AS label FROM lineitem")
def j12_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (F.col("l_linenumber") * 100000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.col("l_returnflag").alias("concept"), "l_linenumber", "l_partkey", F.concat(F.lit("L"), _text("l_suppkey")).alias("label"), order.alias("ord"))
    return joins.with_labels(facts, facts).select(F.col("accession").alias("l_orderkey"), "l_linenumber", "l_partkey", "label")


@register("j13_footnotes", "SELECT o_custkey AS accession, o_orderkey AS fact_id, o_orderkey % 5 AS footnote_id, CASE WHEN o_orderkey % 5 <> 2 THEN 'note ' || (o_orderkey % 5) END AS text FROM orders")
def j13_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.col("o_orderkey").alias("fact_id"), (F.col("o_orderkey") % 5).alias("footnote_id"))
    notes = links.where("footnote_id <> 2").select("accession", "footnote_id", F.concat(F.lit("note "), _text("footnote_id")).alias("text")).distinct()
    return joins.fact_footnotes(links, notes)


@register("j20_reconciling_pairs", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice WHEN o_orderkey % 4 IN (1, 2) THEN o_totalprice * 2 END AS revenue, CASE WHEN o_orderkey % 4 IN (0, 2) THEN o_totalprice / 2 WHEN o_orderkey % 4 = 1 THEN o_totalprice / 4 END AS cost FROM orders")
def j20_reconciling_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidates on either side; the target fits one of the pairs, or none."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    target = _pick(k, p * 0.5, p * 1.75, p * 1.5, p * 9.0)
    pair = joins.first_reconciling_pair(F.array(p, p * 2), F.array(p / 4, p / 2), target)
    return table(spark, sf_dir, "orders").select("o_orderkey", pair["revenue"].alias("revenue"), pair["cost"].alias("cost"))


# aggregates and order


@register("a07_wide_facts", "SELECT o_custkey AS accession, o_orderpriority AS label, year(o_orderdate) AS period, arg_max(o_totalprice, o_orderkey) AS value FROM orders GROUP BY 1, 2, 3")
def a07_wide_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of each label, taken apart again."""
    facts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.col("o_orderpriority").alias("label"), F.year("o_orderdate").alias("period"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("ord"))
    return aggregate.pivot_facts_wide(facts).select("accession", "label", F.explode("values").alias("period", "value"))


@register("a10_shares", "SELECT c_name AS accession, CASE c_custkey % 3 WHEN 0 THEN c_custkey + 5 WHEN 1 THEN c_custkey + 7 END AS shares_outstanding, c_custkey % 11 AS buybacks_shares, 2 * (c_custkey % 13) AS dilution_shares FROM customer")
def a10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outstanding shares by the order of concepts, buybacks and dilution of the latest start; other units and periods do not count."""
    k, end = F.col("c_custkey"), F.lit("2024-03-31")

    def fact(concept: Column, value: Column, start: str | None, unit: str = "shares", last: str = "2024-03-31") -> Column:
        return F.struct(concept.alias("concept"), _text(value).alias("value"), F.lit(unit).alias("unitRef"), F.lit(None).cast("array<string>").alias("numerator"), F.when(F.lit(start is None), F.lit(last)).alias("period_instant"), F.lit(start).cast("string").alias("period_start"), F.when(F.lit(start is not None), F.lit(last)).alias("period_end"))

    out = _pick(k, filings.OUTSTANDING[0], filings.OUTSTANDING[1], "us-gaap:Other")
    rows = [
        fact(F.when(k % 3 == 0, filings.OUTSTANDING[1]).otherwise("us-gaap:None"), k + 9, None),
        fact(out, k + F.when(k % 3 == 0, 5).otherwise(7), None),
        fact(F.lit(filings.OUTSTANDING[0]), k, None, "usd"),
        fact(F.lit(filings.OUTSTANDING[0]), k, None, "shares", "2023-03-31"),
        fact(F.lit(filings.BUYBACKS[0]), k % 11, "2024-01-01"),
        fact(F.lit(filings.BUYBACKS[1]), k, "2023-04-01"),
        fact(F.lit(filings.DILUTION[0]), k % 13, "2024-01-01"),
        fact(F.lit(filings.DILUTION[2]), k % 13, "2024-01-01"),
        fact(F.lit(filings.DILUTION[1]), k, "2023-04-01"),
    ]
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), "c_custkey")
    facts = customers.select("accession", F.posexplode(F.array(*rows)).alias("ord", "f")).select("accession", "ord", "f.*")
    return filings.share_aggregate(facts, customers.select("accession", end.alias("period")))


@register(
    "w02_sections",
    """
    SELECT c_custkey AS doc, 'item_1' AS item, 'first ' || c_name AS section FROM customer UNION ALL SELECT c_custkey, 'item_2', 'again' FROM customer
    """,
)
def w02_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three headings, the last of which repeats an item, and a blank section."""
    body = F.concat(F.lit("ITEM 1 first "), "c_name", F.lit(" ITEM 2 second ITEM 2 again ITEM 3 "))
    at = lambda word, n: F.regexp_instr("text", F.lit(word)) if n == 0 else F.length("text") - F.length(F.lit("ITEM 2 again ITEM 3 ")) + 1
    starts = {"item_1": at("ITEM 1", 0), "item_2": at("ITEM 2", 0), "item_2b": at("ITEM 2", 1), "item_3": at("ITEM 3", 0)}
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), body.alias("text"))
    heads = F.explode(F.array(*[F.struct(F.lit(n.rstrip("b")).alias("item"), s.cast("int").alias("start"), (s + 6).cast("int").alias("stop")) for n, s in starts.items()]))
    return aggregate.sections(rows.select("doc", "text", heads.alias("h")).select("doc", "text", "h.*")).select("doc", "item", "section")


@register("w03_indent_parents", "SELECT s_suppkey AS doc, x.ord, x.parent FROM supplier, (VALUES (1, NULL), (2, 'A'), (3, 'A'), (4, 'B'), (5, 'A'), (6, NULL)) x(ord, parent)")
def w03_indent_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = [(1, 0, "A", True), (2, 2, "x", False), (3, 2, "B", True), (4, 4, "y", False), (5, 2, "z", False), (6, 0, "total", False)]
    rows = F.explode(F.array(*[F.struct(F.lit(o).alias("ord"), F.lit(i).alias("indent"), F.lit(n).alias("label"), F.lit(h).alias("is_header")) for o, i, n, h in lines]))
    tables = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc"), F.lit(1).alias("table"), rows.alias("r")).select("doc", "table", "r.*")
    return aggregate.indent_parent(tables).select("doc", "ord", "parent")


@register("w09_context_lines", "SELECT o_custkey AS doc, o_orderkey AS line_no, string_agg(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey::VARCHAR END, ',') OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS context FROM orders")
def w09_context_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line_no"), F.when(F.col("o_orderkey") % 4 == 0, "  ").otherwise(_text("o_orderkey")).alias("line"))
    return aggregate.context_lines(lines).select("doc", "line_no", F.nullif(F.array_join("context", ","), F.lit("")).alias("context"))


# filing views


@register("c19_adjusted_filings", "SELECT c_name AS accession, '2024-03-31' AS period, x.concept, c_acctbal * x.f AS value FROM customer, (VALUES ('us-gaap:Assets', 2.0), ('us-gaap:Liabilities', 1.0), ('us-gaap:StockholdersEquity', 1.0), ('us-gaap:StockholdersEquity [CommonStock]', 0.5)) x(concept, f)")
def c19_adjusted_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated facts, another period, error texts, shares and text blocks beside the facts that count."""
    v = F.col("c_acctbal")
    listed = [("dei:DocumentPeriodEndDate", "d", None, F.lit("2024-03-31")), ("us-gaap:Assets", "c1", "usd", v), ("us-gaap:Assets", "c1", "usd", v * 2), ("us-gaap:Liabilities", "c1", "usd", v), ("us-gaap:StockholdersEquity", "c1", "usd", v), ("us-gaap:StockholdersEquity", "c3", "usd", v * 0.5), ("us-gaap:Assets", "c2", "usd", v * 9), ("us-gaap:Bad", "c1", "usd", F.lit("(ixTransformError)")), ("us-gaap:Shares", "c1", "shares", v), ("us-gaap:NotesTextBlock", "c1", "usd", v)]
    facts = F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(x).alias("contextRef"), F.lit(u).cast("string").alias("unitRef"), _text(w).alias("value")) for c, x, u, w in listed])
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), F.lit("balance_sheet").alias("section"), F.posexplode(facts).alias("ord", "f")).select("accession", "section", F.col("ord").cast("long").alias("ord"), "f.*")
    none = F.create_map().cast("map<string,string>")
    each = [("c1", "2024-03-31", none), ("c2", "2023-12-31", none), ("c3", "2024-03-31", F.create_map(F.lit("x:Axis"), F.lit("x:CommonStockMember")))]
    null = F.lit(None).cast("string")
    held = F.explode(F.array(*[F.struct(F.lit(c).alias("contextRef"), F.lit("s/CIK").alias("scheme"), F.lit("1").alias("identifier"), F.lit(i).alias("instant"), null.alias("startDate"), null.alias("endDate"), d.alias("dimensions")) for c, i, d in each]))
    names = rows.select("accession").distinct()
    empty = F.array().cast("array<string>")
    units = F.explode(F.array(*[F.struct(F.lit(u).alias("unitRef"), F.array(F.lit(n)).alias("numerator"), empty.alias("denominator")) for u, n in (("usd", "iso4217:USD"), ("shares", "shares"))]))
    return filings.adjust_filings(rows, names.select("accession", held.alias("c")).select("accession", "c.*"), names.select("accession", units.alias("u")).select("accession", "u.*")).select("accession", "period", "concept", "value")


@register(
    "c20_listings",
    """
    SELECT c_name AS accession, ['FACT', 'TAG', 'INL', 'FIL', 'TIT', 'DSC', 'NONE', 'NONE'][(c_custkey % 8 + 1)::INT] AS ticker,
           CASE c_custkey % 8 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'Nasdaq' ELSE CASE WHEN c_nationkey % 2 = 0 THEN 'EX' || c_nationkey ELSE 'NONE' END END AS exchange FROM customer
    """,
)
def c20_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each place where a ticker stands, in the order of preference, and filers that say they have none."""
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    content = _pick(
        k,
        "<title>tit-20250930</title>",
        '<dei:TradingSymbol contextRef="c1">tag</dei:TradingSymbol><dei:SecurityExchangeName x="1">Nasdaq</dei:SecurityExchangeName><FILENAME>fil-20250930.htm',
        "<p name='dei:TradingSymbol' x='1'> INL </p><title>tit-20250930</title>",
        "<FILENAME>fil-20250930.htm<title>tit-20250930</title>",
        "<DESCRIPTION>DSC 2025 report <title>tit-20250930</title>",
        "<DESCRIPTION>DSC 2025 report",
        "<FILENAME>fil-20250930.htm",
        "nothing",
    )
    docs = c.select(F.col("c_name").alias("accession"), content.alias("content"))
    fact = F.when(k % 8 == 0, F.array(F.struct(F.lit("dei:TradingSymbol").alias("c"), F.lit("fact").alias("v")), F.struct(F.lit("dei:SecurityExchangeName").alias("c"), F.lit("NYSE").alias("v")))).when(k % 8 == 6, F.array(F.struct(F.lit("dei:NoTradingSymbolFlag").alias("c"), F.lit("true").alias("v"))))
    facts = c.select(F.col("c_name").alias("accession"), F.posexplode(fact).alias("ord", "f")).select("accession", F.col("f.c").alias("concept"), F.col("f.v").alias("value"), "ord")
    index = c.select(F.col("c_name").alias("accession"), _text("c_nationkey").alias("cik"))
    companies = table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("cik"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("EX"), _text("n_nationkey"))).alias("exchange"))
    return filings.resolve_listing(docs, facts, index, companies)


@register("c21_registrants", "SELECT c_mktsegment AS accession, arg_min(c_name, c_custkey) AS name FROM customer GROUP BY 1")
def c21_registrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("accession"), F.lit("dei:EntityRegistrantName").alias("concept"), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("value"), F.col("c_custkey").alias("ord"))
    return filings.registrant_name(facts.unionByName(facts.withColumn("concept", F.lit("dei:Other")).withColumn("ord", -F.col("ord"))))


@register(
    "c22_links",
    "SELECT DISTINCT l_orderkey AS accession, l_returnflag AS a, l_linestatus AS b, 'calculations' AS kind FROM lineitem UNION ALL SELECT DISTINCT l_orderkey, l_linestatus, l_returnflag, 'labels' FROM lineitem",
)
def c22_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of two kinds from arrays that repeat them, each once."""
    link = lambda a, b: F.collect_list(F.struct(F.col(a).alias("a"), F.col(b).alias("b")))
    raw = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("accession")).agg(link("l_returnflag", "l_linestatus").alias("calculations"), link("l_linestatus", "l_returnflag").alias("labels"))
    found = filings.link_tables(raw)
    return found["calculations"].withColumn("kind", F.lit("calculations")).unionByName(found["labels"].withColumn("kind", F.lit("labels")))


@register("f26_concept_names", "SELECT p_partkey, [true, false, true, false, true][(p_partkey % 5 + 1)::INT] AS statement, [true, false, false, false, true][(p_partkey % 5 + 1)::INT] AS component FROM part")
def f26_concept_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    concept = _pick(F.col("p_partkey"), "us-gaap:InterestExpense", "us-gaap:InterestPaid", "us-gaap:OperatingIncomeLoss", "us-gaap:Assets", "us-gaap:GainLossOnSale")
    return table(spark, sf_dir, "part").select("p_partkey", checks.is_statement_concept(concept).alias("statement"), checks.is_nonop_component(concept).alias("component"))


@register("f29_legacy_labels", "SELECT s_suppkey::VARCHAR AS accession, CASE s_suppkey % 3 WHEN 0 THEN s_acctbal WHEN 1 THEN s_acctbal * 2 END AS value FROM supplier")
def f29_legacy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label that is a candidate, one that begins with one, and one that only looks like it."""
    k = F.col("s_suppkey")
    rows = F.array(F.struct(F.lit("other").alias("label"), F.lit(1.0).alias("value")), F.struct(_pick(k, "net sales", "revenues, net", "revenueless").alias("label"), (F.col("s_acctbal") * F.when(k % 3 == 1, 2).otherwise(1)).alias("value")), F.struct(F.when(k % 3 == 1, "revenues (note 2)").otherwise("x").alias("label"), (F.col("s_acctbal") * 2).alias("value")))
    held = table(spark, sf_dir, "supplier").select(_text(k).alias("accession"), rows.alias("_r"))
    held = held.withColumn("_l", F.map_from_entries(F.transform("_r", lambda r: F.struct(r["label"].alias("key"), r["value"].alias("value")))))
    return held.select("accession", checks.legacy_value(["Net Sales", "Revenues"]).alias("value"))


# functions


def _accession() -> Column:
    return F.concat(F.lpad(_text("o_custkey"), 10, "0"), F.lit("-96-"), F.lpad(_text(F.col("o_orderkey") % 1000000), 6, "0"))


_ACCESSION = "lpad(o_custkey::VARCHAR, 10, '0') || '-96-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0')"


@register("f02_accessions", f"SELECT o_orderkey, {_ACCESSION} AS accession FROM orders")
def f02_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(_pick(F.col("o_orderkey"), "", "/a/b/", "x.txt/"), _accession(), _pick(F.col("o_orderkey"), ".txt", ".xbrl", ""))
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.accession_of(path).alias("accession"))


@register(
    "f03_archive_paths",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'edgar/data/' || o_custkey || '/' || replace({_ACCESSION}, '-', '') || '/' || {_ACCESSION} || '.txt' END AS path, 'edgar/data/' || o_custkey || '/' || replace({_ACCESSION}, '-', '') || '/' || {_ACCESSION} || '.txt' AS three FROM orders",
)
def f03_archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("o_orderkey") % 3 == 0, F.lit("bad-code")).otherwise(_accession())
    two = F.concat(F.lit("edgar/data/"), _text("o_custkey"), F.lit("/"), _accession(), F.lit(".txt"))
    return table(spark, sf_dir, "orders").select("o_orderkey", ids.archive_path(code).alias("path"), ids.three_part_path(two).alias("three"))


@register("f04_slugs", "SELECT c_custkey, '10-K_A_' || c_custkey AS slug, 'a_b_' || c_custkey || '.x-y' AS safe, '1998_QTR2_10-K_A.zip' AS archive FROM customer")
def f04_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _text("c_custkey")
    return table(spark, sf_dir, "customer").select("c_custkey", ids.slug(F.concat(F.lit("10-K/A\\"), k)).alias("slug"), ids.safe_key(F.concat(F.lit("a:b "), k, F.lit(".x-y"))).alias("safe"), ids.archive_name(F.lit(1998), F.lit("QTR2"), F.lit("10-K/A")).alias("archive"))


@register("f05_path_parts", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) END AS year, CASE WHEN o_orderkey % 2 = 0 THEN 'QTR' || quarter(o_orderdate) END AS quarter, CASE WHEN o_orderkey % 2 = 0 THEN '10-K' END AS form FROM orders")
def f05_path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/data/"), _text(F.year("o_orderdate")), F.when(F.col("o_orderkey") % 2 == 0, "/QTR").otherwise("/Q"), _text(F.quarter("o_orderdate")), F.lit("/10-K/"))
    parts = ids.quarter_path(path)
    return table(spark, sf_dir, "orders").select("o_orderkey", parts["year"].alias("year"), parts["quarter"].alias("quarter"), parts["form_type"].alias("form"))


@register(
    "f08_snippets",
    "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'FORM 10-K of ' || c_name WHEN 1 THEN left('PART II ' || c_name || repeat(' more', 200), 500) || '…' ELSE 'plain ' || c_name END AS snippet FROM customer",
)
def f08_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = _pick(F.col("c_custkey"), F.concat(F.lit("meta data FORM  10-K of "), "c_name"), F.concat(F.lit("xx PART II "), "c_name", F.repeat(F.lit(" more"), F.lit(200))), F.concat(F.lit("plain "), "c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.replace(text.snippet(body), F.lit("FORM  10"), F.lit("FORM 10")).alias("snippet"))


@register("f09_row_labels", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Net Sales' WHEN 1 THEN 'Cost Of Goods''S' ELSE 'Total' END AS label FROM supplier".replace("Goods''S", "Goods"))
def f09_row_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(_pick(F.col("s_suppkey"), "  net sales: $ ", "Cost of  goods   ", "TOTAL.....  "), _text(F.abs("s_acctbal")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.row_label(F.when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("cost of goods   "), _text(F.abs("s_acctbal")))).otherwise(line)).alias("label"))


@register("f12_magnitudes", "SELECT p_partkey, [1e9, 1e9, 1e6, 1e6, 1e6, 1e6][(p_partkey % 6 + 1)::INT] AS factor FROM part")
def f12_magnitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", numbers.magnitude(_pick(F.col("p_partkey"), "Billion", " b", "million", "M", None, "x")).alias("factor"))


@register("f18_period_ends", "SELECT c_name AS accession, CASE c_custkey % 4 WHEN 0 THEN DATE '2024-02-29' WHEN 1 THEN DATE '2023-06-30' WHEN 2 THEN DATE '2023-12-31' END AS doc_end FROM customer")
def f18_period_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    facts = {"dei:DocumentPeriodEndDate": F.when(k % 4 == 0, " 2024-02-29T00:00:00"), "dei:DocumentFiscalYearFocus": F.lit("2023"), "dei:DocumentFiscalPeriodFocus": _pick(k, "Q1", "q2", "FY", "H1")}
    rows = F.posexplode(F.array(*[F.struct(F.lit(n).alias("concept"), v.alias("value")) for n, v in facts.items()])).alias("ord", "f")
    return dates.document_period_end(table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), rows).select("accession", "ord", "f.*"))


@register("f20_previous_quarters", "SELECT o_orderkey, year(d) AS year, 'QTR' || quarter(d) AS quarter FROM (SELECT o_orderkey, date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY AS d FROM orders)")
def f20_previous_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = dates.previous_quarter(F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", q["year"].alias("year"), q["quarter"].alias("quarter"))


@register("f22_legacy_periods", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'FY 96' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period FROM orders")
def f22_legacy_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.legacy_period(_pick(F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd"), F.date_format("o_orderdate", "MMMM d, yyyy"), "FY 96")).alias("period"))


@register("f24_differences", "SELECT l_orderkey, l_linenumber, l_partkey, abs(l_extendedprice - l_quantity) / greatest(abs(l_extendedprice), abs(l_quantity), 1e-9) * 100 AS pct FROM lineitem")
def f24_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", numbers.difference_of(a - b, [a, b]).alias("pct"))


@register("f28_zero_as_missing", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), l_tax) AS value FROM lineitem")
def f28_zero_as_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", numbers.or_else(F.col("l_discount"), F.col("l_tax")).alias("value"))


@register("f33_json_values", """SELECT c_custkey, '{"name":"' || c_name || '","gone":null,"list":[{"n":' || c_nationkey || ',"day":"2024-01-31"}]}' AS value FROM customer""")
def f33_json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.struct(F.col("c_name").alias("name"), F.lit(None).cast("string").alias("gone"), F.array(F.struct(F.col("c_nationkey").alias("n"), F.lit("2024-01-31").cast("date").alias("day"))).alias("list"))
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.json_safe(value).alias("value"))


@register("f34_flat_contexts", "SELECT c_name AS accession, c_custkey AS fact, CASE WHEN c_custkey % 3 <> 0 THEN 'CIK' END AS entity_scheme, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey::VARCHAR END AS entity_identifier, CASE WHEN c_custkey % 3 <> 0 THEN '2024-01-31' END AS period_instant FROM customer")
def f34_flat_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    null = F.lit(None).cast("string")
    contexts = c.select(F.col("c_name").alias("accession"), F.lit("c1").alias("contextRef"), F.lit("http://www.sec.gov/CIK").alias("scheme"), _text("c_nationkey").alias("identifier"), F.lit("2024-01-31").alias("instant"), null.alias("startDate"), null.alias("endDate"), F.create_map().cast("map<string,string>").alias("dimensions"))
    facts = c.select(F.col("c_name").alias("accession"), F.when(k % 3 == 0, "gone").otherwise("c1").alias("contextRef"), k.alias("fact"))
    return joins.inline_contexts(facts, contexts).select("accession", "fact", "entity_scheme", "entity_identifier", "period_instant")


@register("f37_joined_lists", "SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS notes FROM lineitem GROUP BY 1")
def f37_joined_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ids.join_list(F.array_sort(F.collect_set("l_returnflag"))).alias("notes"))
