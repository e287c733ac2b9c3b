"""Time-series queries: high-water marks, ranges, pivots, periods and as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import dates, ids, numbers
from quillstone.operators import aggregate, indexes, joins, select
from quillstone.operators.checkpoints import new_folder
from quillstone.registry import register, table


def _ranges(spark: SparkSession) -> int:
    """Ranges that a hot key of an as-of join is dealt to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@register("a02_high_water", "SELECT user_id, event_type, max(ts)::DATE AS last_date, max(ts)::DATE + 1 AS next_start FROM events GROUP BY 1, 2")
def a02_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.high_water(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")


@register(
    "p16_stale_keys",
    "SELECT DISTINCT user_id FROM events EXCEPT SELECT DISTINCT user_id FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)",
)
def p16_stale_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    today = events.agg(F.to_date(F.max("ts"))).scalar()
    catalog = events.groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    return select.stale_keys(events, catalog, "user_id", today)


@register("p04_read_series", "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate <= DATE '1996-06-30'")
def p04_read_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return select.read_series(orders, None, "1995-01-01", "1996-06-30", "o_custkey", "o_orderdate")


@register("p05_read_cube", "SELECT event_id, user_id, ts, value FROM events WHERE json_extract_string(props, '$.k') = '7'")
def p05_read_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = table(spark, sf_dir, "events").withColumn("dimensions", F.from_json("props", "map<string,string>"))
    return select.read_cube(cube, dims={"k": "7"}, key_col="user_id", date_col="ts").select("event_id", "user_id", "ts", "value")


@register("p05_indexed_cube", "SELECT event_id, user_id, ts, value FROM events WHERE json_extract_string(props, '$.k') = '7' AND event_type = 'click'")
def p05_indexed_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dimensions of a stored cube, found by its index."""
    root = f"{new_folder(spark, 'indexed')}/cube"
    own = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("kind"), "event_type"))
    indexes.index_cube(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", own.alias("dimensions")), root, buckets=64)
    return indexes.read_indexed_cube(spark, root, dims={"k": "7", "kind": "click"}, key_col="user_id", date_col="ts").select("event_id", "user_id", "ts", "value")


@register("p06_read_catalog", "SELECT o_orderkey, o_custkey AS category_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate FROM orders WHERE o_custkey IN (1, 5, 9, 14)")
def p06_read_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("category_id"), "o_orderdate")
    return select.read_catalog(orders, [1, 5, 9, 14])


@register(
    "a08_pivot_series",
    """
    SELECT ts::DATE AS date, arg_min(value, event_id) FILTER (event_type = 'view') AS view, arg_min(value, event_id) FILTER (event_type = 'click') AS click,
           arg_min(value, event_id) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY 1
    """,
)
def a08_pivot_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    return aggregate.pivot_series(events, ["view", "click", "purchase"], key="event_type", order="event_id")


@register(
    "f15_period_codes",
    """
    SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month_day, date_trunc('quarter', o_orderdate)::DATE AS quarter_day,
           make_date(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 7 END, 1) AS half_day, make_date(year(o_orderdate), 1, 1) AS year_day,
           NULL::DATE AS late_day
    FROM orders
    """,
)
def f15_period_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    year = F.year(d).cast("string")
    codes = {
        "month_day": F.concat(F.lit("M"), F.lpad(F.month(d).cast("string"), 2, "0")),
        "quarter_day": F.concat(F.lit("Q0"), F.quarter(d).cast("string")),
        "half_day": F.concat(F.lit("S0"), F.when(F.month(d) <= 6, "1").otherwise("2")),
        "year_day": F.when(F.month(d) % 2 == 0, "M13").otherwise("A00"),
        "late_day": F.lit("Q05"),
    }
    return table(spark, sf_dir, "orders").select("o_orderkey", *[dates.bls_period_date(year, c).alias(n) for n, c in codes.items()])


@register(
    "f16_sdmx_periods",
    """
    SELECT o_orderkey, date_trunc('quarter', o_orderdate)::DATE AS quarter_day, date_trunc('month', o_orderdate)::DATE AS month_day, make_date(year(o_orderdate), 1, 1) AS year_day,
           date_trunc('week', o_orderdate)::DATE AS week_day, o_orderdate::DATE AS day_day
    FROM orders
    """,
)
def f16_sdmx_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    y = F.year(d).cast("string")
    iso_year = F.extract(F.lit("YEAROFWEEK"), d).cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.sdmx_period_date(F.concat(y, F.when(F.month(d) % 2 == 0, "-Q").otherwise("q"), F.quarter(d).cast("string"))).alias("quarter_day"),
        dates.sdmx_period_date(F.concat(y, F.when(F.month(d) % 2 == 0, "M").otherwise("-"), F.date_format(d, "MM"))).alias("month_day"),
        dates.sdmx_period_date(y).alias("year_day"),
        dates.sdmx_period_date(F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")), iso_weeks=True).alias("week_day"),
        dates.sdmx_period_date(F.date_format(d, "yyyy-MM-dd")).alias("day_day"),
    )


@register(
    "f17_month_ends",
    """
    SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, strftime(last_day(o_orderdate), '%Y-%m-%d') || 'T00:00:00' AS with_time,
           year(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY) AS prev_year, 'QTR' || quarter(date_trunc('quarter', o_orderdate) - INTERVAL 1 DAY) AS prev_quarter
    FROM orders
    """,
)
def f17_month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    rows = table(spark, sf_dir, "orders")
    q = dates.previous_quarter(F.to_date(d))
    day = F.date_format(d, "yyyy-MM-dd")
    return rows.select("o_orderkey", dates.period_key(F.lit(None).cast("string"), day).alias("month_end"), dates.period_key(F.concat(day, F.lit("T00:00:00")), day).alias("with_time"), q.year.alias("prev_year"), q.quarter.alias("prev_quarter"))


@register(
    "f19_date_formats",
    "SELECT o_orderkey, o_orderdate::DATE AS long_day, o_orderdate::DATE AS short_day, o_orderdate::DATE AS slash_day, o_orderdate::DATE AS dash_day, strftime(o_orderdate, '%Y-%m-%d') AS legacy_day FROM orders",
)
def f19_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    forms = {"long_day": "MMMM d, yyyy", "short_day": "d MMM yyyy", "slash_day": "MM/dd/yyyy", "dash_day": "dd-MMM-yyyy"}
    parsed = [dates.parse_date_multi(F.date_format(d, f)).alias(n) for n, f in forms.items()]
    return table(spark, sf_dir, "orders").select("o_orderkey", *parsed, dates.legacy_period(F.date_format(d, "yyyyMMdd")).alias("legacy_day"))


@register("f21_epoch_ms", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def f21_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", dates.to_epoch_ms(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("ms"))


@register(
    "j16_asof_backward",
    """
    SELECT p.event_id, p.user_id, (SELECT max(s.ts) FROM events s WHERE s.user_id = p.user_id AND s.event_type = 'signup' AND s.ts <= p.ts) AS last_signup
    FROM events p WHERE p.event_type = 'purchase'
    """,
)
def j16_asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    signups = events.where("event_type = 'signup'").select("user_id", "ts", F.col("ts").alias("signup"))
    return joins.asof_backward(purchases, signups, ["user_id"], "ts", "signup", "last_signup", ranges=_ranges(spark)).drop("ts")


@register(
    "j17_asof_forward",
    """
    SELECT p.event_id, p.user_id, (SELECT min(s.ts) FROM events s WHERE s.user_id = p.user_id AND s.event_type = 'click' AND s.ts >= p.ts AND s.ts <= p.ts + INTERVAL 12 HOUR) AS next_click
    FROM events p WHERE p.event_type = 'view'
    """,
)
def j17_asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", F.col("ts").alias("click"))
    return joins.asof_forward(views, clicks, ["user_id"], "ts", "ts", "click", "interval 12 hours", "next_click", ranges=_ranges(spark)).drop("ts")


@register(
    "w04_rank_periods",
    """
    SELECT o_custkey AS accession, strftime(o_orderdate, '%Y-%m-%d') AS period,
           row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderdate >= DATE '1996-07-01' THEN 0 ELSE 1 END, abs(date_diff('day', DATE '1996-07-01', o_orderdate::DATE)), k) AS rank
    FROM (SELECT o_custkey, o_orderdate, min(o_orderkey) AS k FROM orders GROUP BY 1, 2)
    """,
)
def w04_rank_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("period"), F.col("o_orderkey").alias("ord"))
    ends = facts.select("accession").distinct().withColumn("doc_end", F.lit("1996-07-01").cast("date"))
    return aggregate.rank_periods(facts, ends)


@register(
    "w05_choose_period",
    """
    WITH f AS (SELECT o_custkey AS accession, strftime(o_orderdate, '%Y-%m-%d') AS period, min(o_orderkey) AS k, bool_or(o_orderstatus = 'F') AS filled FROM orders GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY accession ORDER BY k) AS rank FROM f)
    SELECT accession, arg_min(period, CASE WHEN filled THEN 0 ELSE 1000000 END + rank) AS period FROM r GROUP BY 1
    """,
)
def w05_choose_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("accession"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("period"), F.col("o_orderkey").alias("ord"), "o_orderstatus")
    ends = spark.createDataFrame([], "accession long, doc_end date")
    empties = facts.groupBy("accession", "period").agg((~F.bool_or(F.col("o_orderstatus") == "F")).alias("is_empty"))
    return aggregate.choose_period(aggregate.rank_periods(facts, ends), empties)


@register(
    "a18_modal_period",
    """
    WITH c AS (SELECT user_id AS accession, event_type AS period, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)
    SELECT accession, period FROM c QUALIFY row_number() OVER (PARTITION BY accession ORDER BY n DESC, f) = 1
    """,
)
def a18_modal_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.modal_period(table(spark, sf_dir, "events").select(F.col("user_id").alias("accession"), F.col("event_type").alias("period"), F.col("event_id").alias("ord")))


#: Ids of series made of a customer's number, with one of the codes, a code inside a word, or none.
_IDS = ("US", "AUS", "CAN", "CHN", "DEU", "FRA", "GBR", "ITA", "JPN", "MEX", "BRA", "IND", "KOR", "RUS", "ZAF", "XX")


@register(
    "f31_series_country",
    f"""
    SELECT c_custkey, CASE
      WHEN code LIKE '%US%' THEN 'United States' WHEN code LIKE '%CAN%' THEN 'Canada' WHEN code LIKE '%CHN%' THEN 'China' WHEN code LIKE '%DEU%' THEN 'Germany'
      WHEN code LIKE '%FRA%' THEN 'France' WHEN code LIKE '%GBR%' THEN 'United Kingdom' WHEN code LIKE '%ITA%' THEN 'Italy' WHEN code LIKE '%JPN%' THEN 'Japan'
      WHEN code LIKE '%MEX%' THEN 'Mexico' WHEN code LIKE '%BRA%' THEN 'Brazil' WHEN code LIKE '%IND%' THEN 'India' WHEN code LIKE '%KOR%' THEN 'South Korea'
      WHEN code LIKE '%ZAF%' THEN 'South Africa' ELSE 'United States' END AS country,
      CASE code WHEN 'AUS' THEN 'Australia' WHEN 'RUS' THEN 'Russia' END AS strict_country
    FROM (SELECT c_custkey, ({list(_IDS)})[(c_custkey % {len(_IDS)} + 1)::INT] AS code FROM customer)
    """,
)
def f31_series_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*map(F.lit, _IDS)), (F.col("c_custkey") % len(_IDS) + 1).cast("int"))
    series = F.concat(F.lit("gdp"), F.lower(code), F.lit("_"), F.col("c_custkey").cast("string"))
    strict = F.when(code.isin("AUS", "RUS"), ids.series_country(series, strict=True))
    return table(spark, sf_dir, "customer").select("c_custkey", ids.series_country(series).alias("country"), strict.alias("strict_country"))


@register(
    "f13_market_values",
    """
    SELECT o_orderkey, CASE WHEN v >= 1e9 THEN printf('$%.2fB', v / 1e9) WHEN v >= 1e6 THEN printf('$%.1fM', v / 1e6) ELSE printf('$%.1fK', v / 1e3) END AS shown,
           round(CASE WHEN v >= 1e9 THEN round(v / 1e9, 2) * 1000 WHEN v >= 1e6 THEN round(v / 1e6, 1) ELSE round(v / 1e3, 1) / 1000 END, 6) AS mln
    FROM (SELECT o_orderkey, (o_orderkey % 97 + 1) * power(10, 4 + o_orderkey % 5) AS v FROM orders)
    """,
)
def f13_market_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("o_orderkey") % 97 + 1) * F.pow(F.lit(10.0), 4 + F.col("o_orderkey") % 5)
    shown = numbers.mcap_fmt(v)
    return table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("shown"), F.round(numbers.mcap_to_mln(shown), 6).alias("mln"))
