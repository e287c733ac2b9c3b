"""Queries of table maintenance and exports, of selections and header repair; what is exported is read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import joins, maintain, select, sets, views
from quillstone.operators.checkpoints import new_folder
from quillstone.registry import register, table


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


@register("k04_replace_all", "SELECT c_custkey, c_name, TIMESTAMP '2024-01-31 10:00:00' AS updated_at FROM customer")
def k04_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain.replace_all(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "2024-01-31 10:00:00")


@register(
    "k08_sync_status",
    """
    SELECT 'S' || s_suppkey AS survey, CASE WHEN s_suppkey % 3 <> 0 THEN 'ok' WHEN s_suppkey % 2 = 0 THEN 'failed:' || s_nationkey ELSE 'synced' END AS status,
           CASE WHEN s_suppkey % 3 = 0 THEN 4000 ELSE 3 END AS error_length, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey ELSE 1 END AS rows
    FROM supplier WHERE s_suppkey % 5 <> 0 OR s_suppkey % 3 = 0
    """,
)
def k08_sync_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of most surveys, after events of every third one; its errors are longer than what is kept."""
    k, suppliers = F.col("s_suppkey"), table(spark, sf_dir, "supplier")
    at = F.lit("2024-01-31").cast("timestamp")
    status = suppliers.where(k % 5 != 0).select(F.concat(F.lit("S"), _text(k)).alias("survey"), F.lit("ok").alias("status"), F.lit("old").alias("error"), F.lit(1).cast("long").alias("rows"), at.alias("updated_at"))
    events = suppliers.where(k % 3 == 0).select(F.concat(F.lit(" s"), _text(k)).alias("survey"), F.when(k % 2 == 0, "failed").otherwise("synced").alias("status"), F.col("s_nationkey").alias("code"), F.repeat(F.lit("long "), F.lit(1000)).alias("error"), k.alias("rows"), at.alias("at"))
    return maintain.sync_status_apply(status, events).select("survey", "status", F.length("error").alias("error_length"), "rows")


@register("k10_export_csv", """SELECT c_custkey || ',' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END || ',"a, ""b"' AS line FROM customer""")
def k10_export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of an export with empty and quoted cells, without the headers."""
    root = f"{new_folder(spark, 'export')}/csv"
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"), F.lit('a, "b').alias("quoted"), F.lit("x").alias("left_out"))
    maintain.export_csv(rows, ["c_custkey", "segment", "quoted"], root)
    return spark.read.text(root).where("value <> 'c_custkey,segment,quoted'").select(F.col("value").alias("line"))


@register("k11_export_per_key", "SELECT c_custkey, replace(c_mktsegment, 'B', '/') || ' x' AS key, replace(replace(c_mktsegment, 'B', '/') || ' x', ' ', '_').replace('/', '_') AS safe_key FROM customer")
def k11_export_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{new_folder(spark, 'export')}/keys"
    key = F.concat(F.replace("c_mktsegment", F.lit("B"), F.lit("/")), F.lit(" x"))
    maintain.export_per_key(table(spark, sf_dir, "customer").select("c_custkey", key.alias("key")), "key", root)
    return spark.read.parquet(root)


@register("k12_filing_documents", "SELECT o_orderkey AS accession, o_totalprice AS total, '10-' || o_orderstatus AS form_type, 'QTR' || quarter(o_orderdate) AS quarter FROM orders")
def k12_filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document for each filing, in folders by form and quarter, of which two are then read."""
    root = f"{new_folder(spark, 'export')}/adj"
    quarter = F.concat(F.lit("QTR"), _text(F.quarter("o_orderdate")))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), F.col("o_totalprice").alias("total"), F.concat(F.lit("10-"), "o_orderstatus").alias("form_type"), quarter.alias("quarter"))
    maintain.write_adj_json(rows, root)
    found = spark.read.option("basePath", root).text(root)
    return found.select(F.from_json("value", "accession long, total double").alias("d"), "form_type", "quarter").select("d.*", "form_type", "quarter")


@register("k13_compacted_filings", "SELECT c_name AS accession, 'text of ' || c_custkey AS content, 0 AS n_different FROM customer WHERE c_nationkey % 4 = 2 AND c_custkey % 2 = 1")
def k13_compacted_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All filings are packed by year, quarter and form; one group is restored, with the number of groups that differ."""
    root = f"{new_folder(spark, 'export')}/packed"
    quarter, form = F.concat(F.lit("QTR"), _text(F.col("c_nationkey") % 4 + 1)), F.when(F.col("c_custkey") % 2 == 0, "10-K").otherwise("10-K/A")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), F.lit(1998).alias("year"), quarter.alias("quarter"), form.alias("form_type"), F.concat(F.lit("text of "), _text("c_custkey")).alias("content"))
    different = maintain.compact_filings(rows, root).agg(F.count("*").cast("int").alias("n_different"))
    return maintain.restore_filings(spark, root, 1998, "QTR3", "10-K/A").crossJoin(F.broadcast(different))  # the count is one row


@register("k14_views", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def k14_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over views, registered in order and refreshed after a load."""
    maintain.register_views(spark, {"upkeep_orders": table(spark, sf_dir, "orders")})
    maintain.register_views(spark, {"upkeep_large": spark.table("upkeep_orders").where("o_totalprice > 1000")})
    return spark.table("upkeep_large").groupBy("o_custkey").agg(F.count("*").alias("n"))


@register(
    "k14_kept_views",
    """
    WITH o AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0),
         c AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS lowest, max(o_totalprice) AS highest FROM o GROUP BY 1),
         k AS (SELECT n, count(*) AS customers, max(highest) AS top FROM c GROUP BY 1)
    SELECT o_custkey, n, total, lowest, highest, customers, top FROM c JOIN k USING (n)
    """,
)
def k14_kept_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored view by customer and one on top of it, after a first load, a second one and a deletion."""
    root, orders = new_folder(spark, "views"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    by_customer = views.View("upkeep_customers", "orders", ("o_custkey",), {"total": "o_totalprice"}, {"lowest": "o_totalprice"}, {"highest": "o_totalprice"})
    by_number = views.View("upkeep_numbers", "upkeep_customers", ("n",), most={"top": "highest"}, rows="customers")
    first, second, gone = orders.where("o_orderkey % 3 <> 0"), orders.where("o_orderkey % 3 = 0"), orders.where("o_orderkey % 7 = 0")
    both, none = [by_number, by_customer], orders.limit(0)
    paths = views.create_views(spark, both, {"orders": first}, root)
    paths = views.refresh_views(spark, both, paths, {"orders": orders}, {"orders": views.Delta(second, none)}, root)
    views.refresh_views(spark, both, paths, {"orders": orders.where("o_orderkey % 7 <> 0")}, {"orders": views.Delta(none, gone)}, root)
    kept = spark.table("upkeep_customers").withColumn("total", F.round("total", 2))
    return kept.join(spark.table("upkeep_numbers"), "n").select("o_custkey", "n", "total", "lowest", "highest", "customers", "top")


@register("p03_series_from_sql", "SELECT o_orderkey::VARCHAR AS series_id, 'id' AS source FROM orders WHERE o_totalprice > 100000 UNION ALL SELECT o_custkey::VARCHAR, 'first' FROM orders WHERE o_totalprice > 200000")
def p03_series_from_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("upkeep_series")
    known = select.series_from_sql(spark, "SELECT o_custkey, o_orderkey AS ID FROM upkeep_series WHERE o_totalprice > 100000;")
    first = select.series_from_sql(spark, "SELECT o_custkey, o_orderkey FROM upkeep_series WHERE o_totalprice > 200000")
    return known.withColumn("source", F.lit("id")).unionByName(first.withColumn("source", F.lit("first")))


@register("p02_select_in_order", "SELECT filename, count(*) AS n FROM (SELECT 'f' || o_orderkey AS filename FROM orders WHERE o_totalprice > 100000 UNION ALL SELECT DISTINCT 'f' || (o_orderkey % 100) FROM orders) GROUP BY 1")
def p02_select_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query with an order of its own, and one of all columns, which gives distinct names."""
    orders = table(spark, sf_dir, "orders")
    orders.select(F.concat(F.lit("f"), _text("o_orderkey")).alias("filename"), "o_totalprice").createOrReplaceTempView("upkeep_index")
    orders.select(F.concat(F.lit("f"), _text(F.col("o_orderkey") % 100)).alias("filename"), "o_orderstatus").createOrReplaceTempView("upkeep_names")
    own = select.select_filings_sql(spark, "SELECT filename FROM upkeep_index WHERE o_totalprice > 100000 ORDER BY o_totalprice DESC")
    return own.unionByName(select.select_filings_sql(spark, "SELECT * FROM upkeep_names;")).groupBy("filename").agg(F.count("*").alias("n"))


@register("p09_drop_dollar", "SELECT 'P' || p_partkey AS symbol FROM part WHERE p_partkey % 4 <> 0")
def p09_drop_dollar(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return select.drop_dollar_symbols(table(spark, sf_dir, "part").select(F.concat(F.lit("P"), _text(k), F.when(k % 4 == 0, "$A").otherwise("")).alias("symbol")))


@register(
    "p13_apply_schema",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS nation, c_acctbal AS balance, CASE WHEN c_custkey % 2 = 0 THEN true END AS even, c_mktsegment AS segment, NULL::VARCHAR AS gone,
           TIMESTAMP '2024-01-01' + (c_custkey % 1000) * INTERVAL 1 SECOND AS seen FROM customer
    """,
)
def p13_apply_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared fields of a property map: malformed and missing ones are null, undeclared ones go."""
    k = F.col("c_custkey")
    values = {"nation": F.when(k % 3 == 0, "x").otherwise(_text("c_nationkey")), "balance": _text("c_acctbal"), "even": F.when(k % 2 == 0, "true").otherwise("perhaps"), "segment": F.col("c_mktsegment"), "undeclared": F.lit("1"), "seen": _text(k % 1000 + 1704067200)}
    held = F.create_map(*[x for n, c in values.items() for x in (F.lit(n), c)])
    out = select.apply_schema(table(spark, sf_dir, "customer").select("c_custkey", held.alias("properties")), {"nation": "int", "balance": "float", "even": "bool", "segment": "str", "gone": "str", "seen": "datetime"})
    return out.withColumn("seen", F.col("seen").cast("timestamp"))


@register("p14_canonical_columns", "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'FUND' ELSE p_brand END AS etf_ticker, p_name AS name, p_size::VARCHAR AS weight_pct, NULL::VARCHAR AS sector FROM part")
def p14_canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with signs and spaces, an alias, a repeated header and a missing one."""
    rows = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 != 0, F.col("p_brand")).alias("ETF Ticker"), F.col("p_name").alias("Holding Name"), F.col("p_type").alias(" holding-name "), _text("p_size").alias("Weight (%)"), F.lit("x").alias("Other"))
    return select.canonical_columns(rows, ["etf_ticker", "name", "weight_pct", "sector"], {"holding_name": "name"}, F.lit("FUND"))


@register("p15_required_columns", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '_missing_' ELSE c_mktsegment END AS ticker, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, TIMESTAMP '2024-01-31' AS updated_at FROM customer")
def p15_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers in the names of missing tickers, which are of no order, are cut."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(k % 4 != 0, F.col("c_mktsegment")).otherwise(F.when(k % 8 == 0, " ")).alias("ticker"), F.when(k % 3 != 0, F.col("c_name")).alias("name"), F.lit(None).cast("timestamp").alias("updated_at"))
    out = select.default_required(rows, "2024-01-31")
    return out.withColumn("ticker", F.regexp_replace("ticker", r"^(_missing_)\d+$", "$1"))


@register("o01_ordered_names", "SELECT DISTINCT 'f' || (o_orderkey % 500) AS filename FROM orders WHERE o_orderstatus = 'F' ORDER BY 1 LIMIT 40")
def o01_ordered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names in order, the first forty: the limit is what the operator offers."""
    index = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), _text(F.col("o_orderkey") % 500)).alias("filename"), F.col("o_orderstatus").alias("form_type"))
    return select.select_filings(index, 40, form_type="F")


@register("o02_key_date_order", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_custkey = 7 ORDER BY o_custkey, o_orderdate")
def o02_key_date_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.read_series(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), 7, key_col="o_custkey", date_col="o_orderdate")


@register(
    "o03_small_caps_order",
    """
    WITH f AS (SELECT c_name AS accession, c_custkey % 200 AS ticker, CASE WHEN (c_custkey % 200) % 3 <> 0 THEN ((c_custkey % 200) % 5) * 4e8 END AS cap FROM customer)
    SELECT accession, CASE WHEN cap < 1e9 THEN 'small' ELSE 'large' END AS kind, row_number() OVER (PARTITION BY coalesce(cap < 1e9, false) ORDER BY cap DESC NULLS LAST, accession) AS place FROM f
    """,
)
def o03_small_caps_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lists in their order: largest first, unknown values last."""
    from pyspark.sql.window import Window

    k = F.col("c_custkey") % 200
    customers = table(spark, sf_dir, "customer")
    failures = customers.select(F.col("c_name").alias("accession"), k.alias("ticker"))
    caps = customers.select(k.alias("ticker")).distinct().where("ticker % 3 <> 0").withColumn("market_cap", (F.col("ticker") % 5) * F.lit(4e8))
    both = [x.select("accession", F.lit(n).alias("kind"), F.row_number().over(Window.partitionBy().orderBy(F.desc_nulls_last("market_cap"), "accession")).alias("place")) for x, n in zip(select.split_small_cap(failures, caps), ("large", "small"), strict=True)]
    return both[0].unionByName(both[1])


@register("o05_limited_catalog", "SELECT DISTINCT p_brand AS symbol FROM part ORDER BY 1 LIMIT 3")
def o05_limited_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A test run's limit, which is the feature."""
    return select.symbols(table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol")), 3)


@register(
    "u03_recommendations",
    """
    SELECT s_name AS symbol, '2024-01-01' AS date, 'Firm ' || s_nationkey AS firm, 'buy' AS to_grade, NULL::VARCHAR AS from_grade, NULL::VARCHAR AS action, 'recommendations' AS source FROM supplier
    UNION ALL SELECT s_name, '2024-02-02', NULL, 'hold', 'sell', 'up', 'upgrades' FROM supplier
    """,
)
def u03_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_name", "symbol")
    a = s.select("symbol", F.lit("2024-01-01").alias("period"), F.concat(F.lit("Firm "), _text("s_nationkey")).alias("company"), F.lit("buy").alias("toGrade"))
    b = s.select("symbol", F.lit("2024-02-02").alias("grade_date"), F.lit("hold").alias("grade"), F.lit("sell").alias("fromGrade"), F.lit("up").alias("action"))
    return sets.recommendations(a, b)


@register("u05_aligned_series", "SELECT o_orderdate::DATE AS date, min(o_totalprice) FILTER (o_orderstatus = 'F') AS F, min(o_totalprice) FILTER (o_orderstatus = 'O') AS O FROM orders GROUP BY 1")
def u05_aligned_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two series side by side, with a date of either."""
    from quillstone.operators.aggregate import pivot_series

    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderstatus").alias("series_id"), F.col("o_totalprice").alias("value"))
    return pivot_series(rows, ["F", "O"])


@register("u06_missing_keys", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def u06_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").alias("updated_at"))
    return select.stale_keys(table(spark, sf_dir, "customer").select("c_custkey"), catalog, "c_custkey", "2000-01-01")


@register("a04_category_counts", "SELECT r_regionkey AS category_id, count(n_nationkey) AS child_count, count(n_nationkey) > 0 AS is_branch FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1 UNION ALL SELECT 100 + n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey), (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) > 0 FROM nation UNION ALL SELECT 1000 + c_custkey, 0, false FROM customer")
def a04_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children and kind of regions, nations and customers as a tree."""
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("category_id"), F.col("r_name").alias("name"), F.lit(None).cast("long").alias("parent_id"))
    nation = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("category_id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("parent_id"))
    customer = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000).alias("category_id"), F.col("c_name").alias("name"), (F.col("c_nationkey") + 100).cast("long").alias("parent_id"))
    return joins.category_analysis(region.unionByName(nation).unionByName(customer)).select("category_id", "child_count", "is_branch")


@register("f36_statement_records", "SELECT s_name AS symbol, 'income' AS statement, 'Revenue' AS item, '2023' AS period, s_acctbal AS value FROM supplier UNION ALL SELECT s_name, 'income', 'Cost', '2024', CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END FROM supplier")
def f36_statement_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = lambda item, period, v: F.create_map(F.lit("_index"), F.lit(item), F.lit(period), v)
    cost = F.when(F.col("s_suppkey") % 2 == 0, _text("s_nationkey")).otherwise("n/a")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("symbol"), F.lit("income").alias("statement"), F.array(record("Revenue", "2023", _text("s_acctbal")), record("Cost", "2024", cost)).alias("records"))
    return sets.statements_long(rows)
