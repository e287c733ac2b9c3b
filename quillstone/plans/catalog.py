"""Catalog queries: weights, trees, upserts, selections and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import aggregate, indexes, joins, maintain, select, sets
from quillstone.operators.checkpoints import new_folder
from quillstone.registry import register, table


@register(
    "a01_weights",
    """
    SELECT n_name AS etf_ticker, coalesce(nullif(trim(r_name), ''), 'Unknown') AS sector, coalesce(nullif(trim(l_shipmode), ''), 'Unknown') AS location,
           round(sum(coalesce(l_extendedprice, 0)), 2) AS weight
    FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3
    """,
)
def a01_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    holdings = rows.select(F.col("n_name").alias("etf_ticker"), F.col("r_name").alias("sector"), F.concat("l_returnflag", "l_linestatus").alias("location"), F.col("l_extendedprice").alias("weight"))
    return aggregate.sector_location_weights(holdings).withColumn("weight", F.round("weight", 2))


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables as a category tree: world, region, nation, customer."""
    root = spark.range(1).select(F.lit(0).cast("long").alias("category_id"), F.lit("World").alias("name"), F.lit(0).cast("long").alias("parent_id"))
    regions = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("long").alias("category_id"), F.col("r_name").alias("name"), F.lit(0).cast("long").alias("parent_id"))
    nations = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("long").alias("category_id"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 1).cast("long").alias("parent_id"))
    customers = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1000).alias("category_id"), F.col("c_name").alias("name"), (F.col("c_nationkey") + 100).cast("long").alias("parent_id"))
    return root.unionByName(regions).unionByName(nations).unionByName(customers)


_TREE = """
WITH RECURSIVE categories AS (
  SELECT 0::BIGINT AS category_id, 'World' AS name, 0::BIGINT AS parent_id
  UNION ALL SELECT (r_regionkey + 1)::BIGINT, r_name, 0 FROM region
  UNION ALL SELECT (n_nationkey + 100)::BIGINT, n_name, (n_regionkey + 1)::BIGINT FROM nation
  UNION ALL SELECT c_custkey + 1000, c_name, (c_nationkey + 100)::BIGINT FROM customer
), cats AS (
  SELECT category_id, name, parent_id, name AS full_path, 0 AS depth FROM categories WHERE parent_id = 0 AND category_id = 0
  UNION ALL
  SELECT c.category_id, c.name, c.parent_id, p.full_path || ' / ' || c.name, p.depth + 1
  FROM categories c JOIN cats p ON c.parent_id = p.category_id AND c.category_id <> p.category_id
)
"""


@register("j05_category_paths", _TREE + "SELECT category_id, name, parent_id, full_path FROM cats")
def j05_category_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.category_paths(_tree(spark, sf_dir))


@register("j06_category_depths", _TREE + "SELECT category_id, name, parent_id, depth, depth + 1 AS path_length FROM cats")
def j06_category_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = joins.category_depths(_tree(spark, sf_dir))
    return rows.select("category_id", "name", "parent_id", "depth", F.size("path").alias("path_length"))


@register(
    "j07_category_analysis",
    _TREE
    + """SELECT c.category_id, c.name, c.parent_id, EXISTS (SELECT 1 FROM categories x WHERE x.parent_id = c.category_id) AS is_branch,
           (SELECT count(*) FROM categories x WHERE x.parent_id = c.category_id) AS child_count, coalesce(d.depth, 0) AS parent_count
         FROM categories c LEFT JOIN cats d ON c.category_id = d.category_id""",
)
def j07_category_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.category_analysis(_tree(spark, sf_dir))


@register(
    "j08_leaf_series",
    _TREE
    + """SELECT o_orderkey AS series_id FROM orders JOIN cats ON o_custkey + 1000 = cats.category_id
         WHERE full_path LIKE '%A%' AND full_path NOT LIKE '%ASIA%' AND strftime(o_orderdate, '%Y-%m-%d') >= '1995-06-01'
           AND NOT EXISTS (SELECT 1 FROM categories x WHERE x.parent_id = cats.category_id)""",
)
def j08_leaf_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = _tree(spark, sf_dir)
    series = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("series_id"), (F.col("o_custkey") + 1000).alias("category_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("observation_end"))
    return joins.leaf_series(joins.category_paths(tree), joins.category_analysis(tree), series, "%A%", ["%ASIA%"], "1995-06-01")


def _changed(orders: DataFrame) -> DataFrame:
    changed = orders.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    fresh = orders.where("o_orderkey % 10 = 1").withColumn("o_orderkey", -F.col("o_orderkey"))
    return changed.unionByName(fresh)


@register(
    "k01_upsert",
    """
    WITH batch AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 0
      UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 1
    )
    SELECT * FROM batch UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
    """,
)
def k01_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return maintain.upsert(orders, _changed(orders), ["o_orderkey"])


@register(
    "k02_insert_ignore",
    """
    SELECT * FROM orders
    UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 1
    """,
)
def k02_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return maintain.insert_ignore(orders, _changed(orders), ["o_orderkey"])


@register(
    "k03_append_new",
    """
    SELECT user_id, min(event_type) AS first_type FROM events WHERE user_id % 2 = 0 GROUP BY 1
    UNION ALL SELECT user_id, max(event_type) FROM events WHERE user_id % 2 = 1 GROUP BY 1
    """,
)
def k03_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    target = events.where("user_id % 2 = 0").groupBy("user_id").agg(F.min("event_type").alias("first_type"))
    batch = events.groupBy("user_id").agg(F.max("event_type").alias("first_type"))
    return maintain.append_new(target, batch, "user_id")


@register(
    "k05_replace_keys",
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5)
    UNION ALL SELECT l_orderkey, 1, sum(l_quantity) FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5) GROUP BY 1
    """,
)
def k05_replace_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    long_ones = lines.where("l_linenumber = 5").select("l_orderkey")
    batch = lines.join(long_ones, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.lit(1).alias("l_linenumber"), F.sum("l_quantity").alias("l_quantity"))
    return maintain.replace_keys(lines, batch, "l_orderkey")


@register(
    "k06_metadata",
    "SELECT event_type AS key, cast(max(event_id) AS VARCHAR) AS value, max(ts) AS updated_at FROM events GROUP BY 1",
)
def k06_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")

    def meta(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("event_type").alias("key")).agg(F.max("event_id").cast("string").alias("value"), F.max("ts").alias("updated_at"))

    return maintain.get_meta(maintain.set_meta(meta(events.where("event_id % 3 = 0")), meta(events)))


@register(
    "k07_ledger",
    """
    WITH q AS (SELECT year(o_orderdate) AS year, 'QTR' || quarter(o_orderdate) AS quarter, count(*) AS n, max(o_orderdate) AS at FROM orders GROUP BY 1, 2),
         old AS (SELECT year, quarter, CASE WHEN n % 2 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN n % 2 = 0 THEN 2 ELSE 0 END AS retry_count FROM q WHERE n % 5 <> 0),
         ev AS (SELECT year, quarter, CASE WHEN n % 3 = 0 THEN 'failed' ELSE 'success' END AS status FROM q WHERE n % 7 <> 0)
    SELECT coalesce(ev.year, old.year) AS year, coalesce(ev.quarter, old.quarter) AS quarter, coalesce(ev.status, old.status) AS status,
           CASE WHEN ev.status = 'failed' THEN coalesce(old.retry_count, 0) + 1 WHEN ev.status = 'success' THEN 0 ELSE old.retry_count END AS retry_count
    FROM ev FULL JOIN old ON ev.year = old.year AND ev.quarter = old.quarter
    """,
)
def k07_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    q = table(spark, sf_dir, "orders").groupBy(F.year(day).alias("year"), F.concat(F.lit("QTR"), F.quarter(day)).alias("quarter")).agg(F.count("*").alias("n"), F.max(day).alias("at"))
    old = q.where("n % 5 <> 0").select(
        "year",
        "quarter",
        F.when(F.col("n") % 2 == 0, "failed").otherwise("success").alias("status"),
        F.lit(None).cast("timestamp").alias("downloaded_at"),
        F.lit(None).cast("timestamp").alias("failed_at"),
        F.lit(None).cast("string").alias("error_message"),
        F.when(F.col("n") % 2 == 0, 2).otherwise(0).alias("retry_count"),
        F.col("at").alias("last_attempt"),
    )
    events = q.where("n % 7 <> 0").select("year", "quarter", F.when(F.col("n") % 3 == 0, "failed").otherwise("success").alias("status"), F.lit("late").alias("error_message"), "at")
    return maintain.ledger_apply(old, events).select("year", "quarter", "status", "retry_count")


@register(
    "w01_latest",
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def w01_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain.latest_by_key(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type", "value")


@register(
    "a19_first",
    "SELECT c_mktsegment, c_nationkey, c_custkey, c_name FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) = 1",
)
def a19_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintain.dedupe_first(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], [F.col("c_custkey")]).select("c_mktsegment", "c_nationkey", "c_custkey", "c_name")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a filing index."""
    return table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("company_name"),
        F.concat(F.lit("10-"), "o_orderstatus").alias("form_type"),
        F.to_date("o_orderdate").alias("date_filed"),
        F.concat(F.lit("edgar/data/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("o_orderkey").cast("string").alias("accession"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("QTR"), F.quarter("o_orderdate")).alias("quarter"),
    )


@register(
    "p01_select_filings",
    """
    SELECT DISTINCT 'edgar/data/' || o_custkey || '/' || o_orderkey || '.txt' AS filename FROM orders
    WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'O' AND 'company ' || o_custkey LIKE '%company 1%'
    """,
)
def p01_select_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.select_filings(_index(spark, sf_dir), year=1996, form_type="10-O", company_name="COMPANY 1")


@register(
    "p02_select_sql",
    "SELECT DISTINCT 'edgar/data/' || o_custkey || '/' || o_orderkey || '.txt' AS filename FROM orders WHERE quarter(o_orderdate) = 2",
)
def p02_select_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    maintain.register_views(spark, {"filing_index": _index(spark, sf_dir)})
    return select.select_filings_sql(spark, "SELECT * FROM filing_index WHERE quarter = 'QTR2';")


@register("p07_flagged_symbols", "SELECT DISTINCT p_brand AS symbol FROM part WHERE p_size % 7 = 1")
def p07_flagged_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("symbol"), F.when(F.col("p_size") % 7 == 1, " y ").alias("etf"))
    return select.etf_symbols(parts)


@register("p11_search_any", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(c_custkey::VARCHAR) LIKE '%12%' OR lower(c_name) LIKE '%12%' OR lower(c_mktsegment) LIKE '%12%'")
def p11_search_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.search_any(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "12")


@register("p11_indexed_search", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name LIKE '%0012%' OR lower(c_mktsegment) LIKE '%0012%' OR c_custkey::VARCHAR LIKE '%0012%'")
def p11_indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term in any column of stored rows, found by their trigrams."""
    root = f"{new_folder(spark, 'indexed')}/text"
    indexes.index_text(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), root, F.floor(F.col("c_custkey") / 50), buckets=64)
    return indexes.search_indexed(spark, root, "0012")


@register(
    "p27_series_in_roots",
    "SELECT c_custkey AS series_id, c_nationkey AS category_id FROM customer WHERE c_nationkey IN (1, 3, 5, 8)",
)
def p27_series_in_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("series_id"), F.col("c_nationkey").alias("category_id"))
    return select.series_in_roots(series, [8, 1, 3, 5, 5])


@register(
    "p24_small_caps",
    """
    SELECT o_orderkey AS accession, c_name AS ticker, c_acctbal AS market_cap FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND c_acctbal < 1000
    """,
)
def p24_small_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("ticker"), F.col("c_acctbal").alias("market_cap"))
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    failures = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("accession"), "ticker")
    return select.split_small_cap(failures, customers.select("ticker", "market_cap"), 1000.0)[1].select("accession", "ticker", "market_cap")


@register(
    "j01_exchange",
    """
    SELECT o_orderkey::VARCHAR AS accession, c_mktsegment AS exchange FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderkey % 3 = 0 AND c_mktsegment <> 'MACHINERY'
    """,
)
def j01_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    companies = table(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise(" ").alias("exchange"))
    return joins.exchange_for_accessions(index, companies, index.where(F.col("accession").cast("long") % 3 == 0).select("accession"))


@register(
    "j03_metadata",
    """
    SELECT o_orderkey::VARCHAR AS accession, lpad(o_custkey::VARCHAR, 10, '0') AS cik, o_orderdate::DATE AS date_filed FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def j03_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(".txt")).alias("accession"))
    return joins.filing_metadata(_index(spark, sf_dir), wanted).select("accession", "cik", "date_filed")


@register(
    "j04_exchange_names",
    "SELECT c_custkey, c_nationkey::VARCHAR AS exchange, coalesce(n_name, c_nationkey::VARCHAR) AS exchange_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20",
)
def j04_exchange_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("exchange"))
    names = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("symbol"), F.col("n_name").alias("name"))
    return joins.listed_with_exchange(other, names)


@register(
    "j22_integrity",
    """
    WITH f AS (SELECT user_id, count(*) AS n_failures, CASE WHEN user_id % 2 = 0 THEN 'N/A' ELSE 'T' || user_id END AS t FROM events WHERE event_type = 'purchase' GROUP BY user_id),
         e AS (SELECT user_id, count(*) AS n_errors FROM events WHERE event_type = 'error' OR event_type = 'signup' GROUP BY user_id),
         w AS (SELECT user_id, count(*) AS n_warnings FROM events WHERE event_type = 'view' GROUP BY user_id),
         k AS (SELECT user_id FROM f UNION SELECT user_id FROM e UNION SELECT user_id FROM w)
    SELECT k.user_id AS accession, n_failures, n_errors, n_warnings, coalesce(nullif(t, 'N/A'), 'C' || (k.user_id % 10)) AS ticker, 'NYSE' AS exchange
    FROM k LEFT JOIN f USING (user_id) LEFT JOIN e USING (user_id) LEFT JOIN w USING (user_id)
    """,
)
def j22_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("accession", F.col("user_id"))
    failures = events.where("event_type = 'purchase'").groupBy("accession").agg(F.count("*").alias("n_failures"))
    failures = failures.withColumn("ticker", F.when(F.col("accession") % 2 == 0, "N/A").otherwise(F.concat(F.lit("T"), F.col("accession").cast("string")))).withColumn("exchange", F.lit("N/A"))
    errors = events.where("event_type in ('error', 'signup')").groupBy("accession").agg(F.count("*").alias("n_errors"))
    warnings = events.where("event_type = 'view'").groupBy("accession").agg(F.count("*").alias("n_warnings"))
    filings = events.select("accession").distinct().withColumn("ticker", F.concat(F.lit("C"), (F.col("accession") % 10).cast("string"))).withColumn("exchange", F.lit("NYSE"))
    return joins.integrity_table(failures, warnings, errors, filings).select("accession", "n_failures", "n_errors", "n_warnings", "ticker", "exchange")


@register("a05_counts", "SELECT user_id AS accession, count(*) FILTER (event_type = 'purchase') AS n_errors, count(*) FILTER (event_type = 'view') AS n_warnings FROM events WHERE event_type IN ('purchase', 'view') GROUP BY 1")
def a05_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("user_id", "accession")
    return aggregate.integrity_counts(events.where("event_type = 'purchase'"), events.where("event_type = 'view'"))


@register("a03_loaded_quarters", "SELECT DISTINCT year(o_orderdate) AS year, 'QTR' || quarter(o_orderdate) AS quarter FROM orders WHERE year(o_orderdate) >= 1994")
def a03_loaded_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.loaded_quarters(_index(spark, sf_dir), 1994)


@register(
    "j14_pending_quarters",
    """
    WITH cal AS (SELECT year(d) AS year, 'QTR' || quarter(d) AS quarter FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2000-10-01', INTERVAL 3 MONTH)) AS d)),
         loaded AS (SELECT DISTINCT year(o_orderdate) AS year, 'QTR' || quarter(o_orderdate) AS quarter FROM orders)
    SELECT year, quarter FROM cal WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.year = cal.year AND l.quarter = cal.quarter) AND quarter <> 'QTR3'
    """,
)
def j14_pending_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillstone.functions.dates import quarters

    calendar = quarters(spark, 1990, "2000-11-15")
    ledger = calendar.where("quarter = 'QTR3'").select("year", "quarter", F.lit("success").alias("status")).unionByName(calendar.where("quarter = 'QTR1'").select("year", "quarter", F.lit("failed").alias("status")))
    return joins.pending_quarters(calendar, _index(spark, sf_dir), ledger)


@register("u01_updated_today", "SELECT DISTINCT user_id AS ticker FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) AND event_type IN ('purchase', 'signup')")
def u01_updated_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("ticker"), F.col("ts").alias("updated_at"), "event_type")
    today = events.agg(F.to_date(F.max("updated_at")).alias("day"))
    return sets.updated_today(events.where("event_type = 'purchase'"), events.where("event_type = 'signup'"), today)


@register(
    "u02_symbol_catalog",
    """
    WITH both_ AS (
      SELECT p_name AS symbol, p_type AS name, 'NASDAQ' AS exchange, 'nasdaqlisted' AS source FROM part WHERE p_size > 25
      UNION ALL SELECT c_name, c_mktsegment, coalesce(n_name, c_nationkey::VARCHAR), 'otherlisted' FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20
    )
    SELECT symbol, name, exchange, source FROM both_ WHERE symbol NOT LIKE '%$%'
    QUALIFY row_number() OVER (PARTITION BY symbol, exchange ORDER BY source, name) = 1
    """,
)
def u02_symbol_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    nasdaq = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_name").alias("symbol"), F.col("p_type").alias("security_name"), F.lit("N").alias("etf"))
    other = table(spark, sf_dir, "customer").select(F.col("c_name").alias("act_symbol"), F.col("c_mktsegment").alias("security_name"), F.col("c_nationkey").cast("string").alias("exchange"), F.lit("Y").alias("etf"))
    names = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("symbol"), F.col("n_name").alias("name"))
    return sets.symbol_catalog(nasdaq, other, names).select("symbol", "name", "exchange", "source")


@register("u07_distinct_codes", "SELECT c_nationkey, min(c_mktsegment) AS c_mktsegment FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1")
def u07_distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.distinct_codes(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@register(
    "u08_supplement",
    """
    SELECT c_name AS series_id, c_mktsegment AS title, n_name AS category_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0
    UNION ALL SELECT c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END, 'Found via search' FROM customer WHERE c_custkey % 2 = 1
    """,
)
def u08_supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    catalog = customers.where("c_custkey % 2 = 0").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("series_id"), F.col("c_mktsegment").alias("title"), F.col("n_name").alias("category_name"))
    info = customers.where("c_custkey % 3 = 0").select(F.col("c_name").alias("series_id"), F.col("c_mktsegment").alias("title"))
    return sets.supplement_catalog(catalog, customers.select(F.col("c_name").alias("series_id")), info)


@register(
    "f38_unpivot",
    """
    SELECT c_custkey, 'c_name' AS property, c_name AS value FROM customer
    UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
    """,
)
def f38_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.unpivot_properties(table(spark, sf_dir, "customer"), "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


@register(
    "u04_concat",
    """
    SELECT NULL::BIGINT AS c_custkey, n_name AS name, n_nationkey AS nationkey FROM nation
    UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer
    """,
)
def u04_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    b = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    return sets.concat_frames([a, b])
