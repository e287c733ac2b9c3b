"""Queries of column functions and of small selections, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import dates, ids, numbers
from quillstone.operators import aggregate, joins, maintain, select
from quillstone.registry import register, table


@register(
    "f01_identifiers",
    """
    SELECT o_orderkey, lpad(o_custkey::VARCHAR, 10, '0') AS cik, lpad(o_custkey::VARCHAR, 10, '0') || '-96-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') AS accession,
           'edgar/data/' || o_custkey || '/' || lpad(o_custkey::VARCHAR, 10, '0') || '96' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') || '/' || lpad(o_custkey::VARCHAR, 10, '0') || '-96-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0') || '.txt' AS path,
           '10-' || o_orderstatus || '_A' AS slug, year(o_orderdate) AS path_year, '10-' || o_orderstatus AS path_form
    FROM orders
    """,
)
def f01_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    cik = ids.norm_cik(F.concat(F.lit("00"), F.col("o_custkey").cast("string")))
    name = F.concat(cik, F.lit("-96-"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"), F.lit(".txt"))
    parts = ids.quarter_path(F.concat(F.lit("/x/"), F.year("o_orderdate").cast("string"), F.lit("/QTR1/10-"), F.col("o_orderstatus")))
    return rows.select("o_orderkey", cik.alias("cik"), ids.accession_of(name).alias("accession"), ids.archive_path(name).alias("path"), ids.slug(F.concat(F.lit("10-"), "o_orderstatus", F.lit("/A"))).alias("slug"), parts.year.alias("path_year"), parts.form_type.alias("path_form"))


@register(
    "f10_amounts",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(sum(l_extendedprice - l_tax), 2) AS total, count(*) * 2 AS n FROM lineitem GROUP BY 1, 2, 3
    """,
)
def f10_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Net sales $ "), F.format_number("l_extendedprice", 2), F.lit("  ("), F.format_number("l_tax", 2), F.lit(")"))
    rows = table(spark, sf_dir, "lineitem").withColumn("a", numbers.parse_amounts(text))
    total = F.aggregate("a", F.lit(0.0), lambda s, x: s + x)
    return rows.groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.round(F.sum(total), 2).alias("total"), F.sum(F.size("a")).alias("n"))


@register(
    "f11_numbers",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE round(o_totalprice, 2) END AS value, CASE WHEN o_orderkey % 2 = 0 THEN 1e9 ELSE 1e6 END AS unit FROM orders",
)
def f11_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 10 == 3, "n/a").otherwise(F.concat(F.format_number("o_totalprice", 2), F.lit("%")))
    unit = F.when(F.col("o_orderkey") % 2 == 0, " Billion").otherwise("m")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(numbers.parse_num(raw), 2).alias("value"), numbers.magnitude(unit).alias("unit"))


@register(
    "f14_coerced",
    """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id END AS i, CASE WHEN event_id % 4 = 1 THEN value END AS d, CASE WHEN event_id % 4 = 2 THEN event_type END AS s FROM events
    """,
)
def f14_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.col("user_id").cast("string")).when(k == 1, F.format_string("%.2f", "value")).when(k == 2, F.col("event_type")).otherwise("")
    c = numbers.coerce_value(raw)
    return table(spark, sf_dir, "events").select("event_id", c.i.alias("i"), c.d.alias("d"), c.s.alias("s"))


@register(
    "f23_tolerance",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_extendedprice - l_extendedprice * (1 - l_discount * 1.01)) / greatest(l_extendedprice, l_extendedprice * (1 - l_discount * 1.01), 1e-9) * 100 <= 5 AS near FROM lineitem
    """,
)
def f23_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.approx_eq(price, price * (1 - F.col("l_discount") * 1.01)).alias("near"))


@register(
    "f25_signs",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN -o_totalprice ELSE o_totalprice END AS v, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE o_orderkey::DOUBLE + 1 END AS w FROM orders",
)
def f25_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, "us-gaap:InterestExpense").when(k == 1, "us-gaap:OtherIncomeExpenseNet").when(k == 2, "us-gaap:GainLossOnSale").otherwise("us-gaap:IncomeTaxExpenseBenefit")
    filled = numbers.or_else(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).otherwise(0.0), F.col("o_orderkey") + F.lit(1.0))
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.signed_component(name, F.col("o_totalprice")).alias("v"), filled.alias("w"))


@register(
    "f30_labels",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'us-gaap:X [' || l_returnflag || ', ' || l_linestatus || ']' AS label, 'a:Axis:x:' || l_returnflag || 'Member|b:Axis:x:' || l_linestatus AS key FROM lineitem",
)
def f30_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = F.create_map(F.lit("b:Axis"), F.concat(F.lit("x:"), "l_linestatus"), F.lit("a:Axis"), F.concat(F.lit("x:"), "l_returnflag", F.lit("Member")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ids.fact_label(F.lit("us-gaap:X"), dims).alias("label"), ids.dimension_key(dims).alias("key"))


@register(
    "f32_casts",
    "SELECT event_id, user_id AS i, value AS f, (event_id % 2 = 0) AS b, strftime(to_timestamp(user_id * 86400) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS t, NULL::BIGINT AS bad FROM events",
)
def f32_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = numbers.cast_by_type
    return table(spark, sf_dir, "events").select(
        "event_id",
        c(F.format_string("%d.0", "user_id"), "int").alias("i"),
        c(F.col("value").cast("string"), "float").alias("f"),
        c((F.col("event_id") % 2 == 0).cast("string"), "bool").alias("b"),
        c((F.col("user_id") * 86400).cast("string"), "datetime").alias("t"),
        c(F.lit("Infinity"), "int").alias("bad"),
    )


@register("f35_tickers", "SELECT c_custkey, length(t) BETWEEN 2 AND 5 AND t <> 'NONE' AS ok FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NONE' ELSE substr(c_mktsegment, 1, 1 + (c_custkey % 7)::INT) END AS t FROM customer)")
def f35_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.when(F.col("c_custkey") % 5 == 0, "NONE").otherwise(F.substring("c_mktsegment", F.lit(1), (1 + F.col("c_custkey") % 7).cast("int")))
    return table(spark, sf_dir, "customer").select("c_custkey", ids.is_ticker(t).alias("ok"))


@register("f39_quarters", "SELECT year(d) AS year, 'QTR' || quarter(d) AS quarter, count(o_orderkey) AS n FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1998-07-01', INTERVAL 3 MONTH)) AS d) LEFT JOIN orders ON date_trunc('quarter', o_orderdate) = d GROUP BY 1, 2")
def f39_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "quarter").alias("first_day")).agg(F.count("*").alias("k"))
    return dates.quarters(spark, 1995, "1998-08-15").join(counts, "first_day", "left").select("year", "quarter", F.coalesce("k", F.lit(0)).alias("n"))


@register("p08_symbols", "SELECT DISTINCT p_brand AS symbol FROM part WHERE NOT contains(p_brand, '$')")
def p08_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.symbols(select.drop_dollar_symbols(table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"))))


@register("p10_drop_mock", "SELECT c_custkey, c_mktsegment AS name FROM customer WHERE c_custkey % 3 <> 0")
def p10_drop_mock(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_mktsegment", F.lit("Mock"))).otherwise(F.col("c_mktsegment"))
    return select.drop_mock(table(spark, sf_dir, "customer").select("c_custkey", name.alias("name")))


@register("p12_clean_holdings", "SELECT c_custkey, c_name AS name, c_mktsegment AS sector, CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'w' END AS weight FROM customer WHERE c_custkey % 4 <> 0")
def p12_clean_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.when(k == 0, F.when(F.col("c_custkey") % 8 == 0, "nan").otherwise("Sector")).otherwise(F.col("c_mktsegment")).alias("sector"), F.when(k == 1, "--").otherwise("w").alias("weight"))
    return select.clean_holdings(rows)


@register("p17_bad_values", "SELECT event_id, event_id % 5 <> 0 AS bad FROM events")
def p17_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.col("value").cast("string")).when(k == 1, " ").when(k == 2, "(ixTransformValueError)").when(k == 3, F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", select.is_bad_value(raw).alias("bad"))


@register("p25_without_funds", "SELECT o_orderkey, c_name AS ticker FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'")
def p25_without_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    filings = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_name").alias("ticker"))
    return select.exclude_etfs(filings, customers.select(F.col("c_name").alias("ticker"), F.when(F.col("c_mktsegment") == "BUILDING", "etf").otherwise("EQUITY").alias("quote_type")))


@register("p26_status", "SELECT upper(t) AS survey, n FROM (SELECT DISTINCT event_type AS t FROM events) LEFT JOIN (SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1) ON t = event_type")
def p26_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    ledger = events.where("event_type <> 'view'").groupBy(F.upper("event_type").alias("survey")).agg(F.count("*").alias("n"))
    return select.status_of(ledger, events.select(F.concat(F.lit(" "), "event_type").alias("survey")))


@register("j02_company_names", "SELECT o_orderkey AS accession, 'Company ' || o_custkey AS company_name FROM orders WHERE o_orderstatus = 'P'")
def j02_company_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    index = orders.select(F.col("o_orderkey").alias("accession"), F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("company_name"))
    return joins.company_names(index, orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("accession")))


@register("j15_to_refresh", "SELECT DISTINCT c_name AS ticker FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")
def j15_to_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("ticker"))
    fresh = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return joins.tickers_to_refresh(customers, customers.join(fresh, "c_custkey"))


@register(
    "j09_contexts",
    "SELECT l_orderkey AS accession, l_linenumber AS ord, l_partkey AS p, CASE WHEN o_orderkey IS NOT NULL THEN 'CIK' END AS entity_scheme, o_custkey::VARCHAR AS entity_identifier, strftime(o_orderdate, '%Y-%m-%d') AS period_instant FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'",
)
def j09_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.lit("c").alias("contextRef"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").alias("p"))
    none = F.lit(None).cast("string")
    contexts = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("accession"), F.lit("c").alias("contextRef"), F.lit("http://x/CIK").alias("scheme"), F.col("o_custkey").cast("string").alias("identifier"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("instant"), none.alias("startDate"), none.alias("endDate"), F.create_map().cast("map<string,string>").alias("dimensions"))
    return joins.inline_contexts(facts, contexts).select("accession", "ord", "p", "entity_scheme", "entity_identifier", "period_instant")


@register("j23_failures_by_cap", "SELECT o_orderkey AS accession, c_name AS ticker, c_acctbal AS market_cap FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'")
def j23_failures_by_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("ticker"), F.col("c_acctbal").alias("market_cap"))
    failures = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").join(caps.select("c_custkey", "ticker"), F.col("o_custkey") == F.col("c_custkey"), "left").select(F.col("o_orderkey").alias("accession"), "ticker")
    return joins.failures_with_cap(failures, caps.select("ticker", "market_cap")).select("accession", "ticker", "market_cap")


@register(
    "a09_document_facts",
    "SELECT user_id AS accession, 'dei:' || event_type AS concept, count(DISTINCT value) AS n, arg_min(value, event_id) AS first_value FROM events GROUP BY 1, 2",
)
def a09_document_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "events").select(F.col("user_id").alias("accession"), F.concat(F.lit("dei:"), "event_type").alias("concept"), F.col("event_id").alias("ord"), F.col("value").cast("string").alias("value"))
    return aggregate.collect_dei(facts).select("accession", "concept", F.size("values").cast("long").alias("n"), F.element_at("values", 1).cast("double").alias("first_value"))


@register("a14_dimensioned", "SELECT l_orderkey AS accession, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS total FROM lineitem GROUP BY 1")
def a14_dimensioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    concept = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("us-gaap:X ["), "l_returnflag", F.lit("]"))).otherwise("us-gaap:X")
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), concept.alias("concept"), F.col("l_quantity").alias("value"))
    return aggregate.sum_dimensioned(facts, "us-gaap:X")


@register("a21_empty_statements", "SELECT l_orderkey AS accession, l_returnflag AS period, NOT bool_or(l_linenumber = 1) OR count(*) < 3 AS is_empty FROM lineitem GROUP BY 1, 2")
def a21_empty_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    concept = F.when(F.col("l_linenumber") == 1, "us-gaap:Assets").otherwise("us-gaap:Other")
    return aggregate.is_empty_statement(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.col("l_returnflag").alias("period"), concept.alias("concept"), F.col("l_quantity").alias("value")))


@register("a22_load_counts", "SELECT event_type AS survey, count(*) AS n_rows FROM events GROUP BY 1")
def a22_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.load_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "survey"))


@register(
    "w07_first_tables",
    "SELECT user_id AS doc, event_type AS kind, min(event_id) AS ord FROM events GROUP BY 1, 2",
)
def w07_first_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.first_table(table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_type").alias("kind"), F.col("event_id").alias("ord")))


@register(
    "w10_fallback",
    "SELECT user_id AS doc, arg_max(event_type, event_id) AS fallback FROM events WHERE event_type <> 'error' GROUP BY 1",
)
def w10_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = F.when(F.col("event_type") != "error", F.col("event_type"))
    return aggregate.fallback_period(table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), period.alias("period"), F.col("event_id").alias("start")))


@register(
    "k09_exchanges",
    """
    SELECT lpad(c_custkey::VARCHAR, 10, '0') AS cik, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Unknown' END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'OLD' ELSE c_mktsegment END AS exchange
    FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0
    """,
)
def k09_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("cik", ids.norm_cik(F.col("c_custkey").cast("string")))
    companies = rows.where("c_custkey % 2 = 0").select("cik", F.col("c_name").alias("name"), F.lit("OLD").alias("exchange"))
    return maintain.upsert_exchange(companies, rows.where("c_custkey % 3 <> 0").select("cik", F.col("c_mktsegment").alias("exchange")))
