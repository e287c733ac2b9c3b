"""Filing facts and accounting checks over facts that orders and their lines stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import aggregate, checks, joins
from quillstone.operators import rules as R
from quillstone.registry import register, table


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a filing, annual for even keys, with amounts of its lines as facts.

    Lines are added in the order of the table: a sum's last bits depend on it, and by them a
    difference of exactly the tolerance passes or fails.
    """
    used = ["l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    place = ["_file", "_row"]
    placed = table(spark, sf_dir, "lineitem").select(*used, F.col("_metadata.file_path").alias(place[0]), F.col("_metadata.row_index").alias(place[1]))
    lines = placed.repartition("l_orderkey").sortWithinPartitions("l_orderkey", *place).groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("ext"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
        (F.sum(F.col("l_extendedprice") * F.col("l_tax")) * 1.01).alias("tax"),  # no difference is exactly at the tolerance
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).otherwise(0.0)).alias("a"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_extendedprice")).otherwise(0.0)).alias("n"),
        F.count("*").alias("k"),
    )
    ext, disc, tax, a, n, k = map(F.col, ("ext", "disc", "tax", "a", "n", "k"))
    facts = [
        ("balance_sheet", "us-gaap:Assets", ext),
        ("balance_sheet", "us-gaap:Liabilities", a),
        ("balance_sheet", "us-gaap:StockholdersEquity", F.when(k % 5 != 0, n)),
        ("balance_sheet", "us-gaap:AssetsCurrent", a),
        ("balance_sheet", "us-gaap:AssetsNoncurrent", n),
        ("balance_sheet", "us-gaap:LiabilitiesCurrent", a * 0.5),
        ("balance_sheet", "us-gaap:LiabilitiesNoncurrent", a * F.when(k % 3 == 0, 0.4).otherwise(0.5)),
        ("balance_sheet", "us-gaap:StockholdersEquity [CommonStock]", n * 0.6),
        ("balance_sheet", "us-gaap:StockholdersEquity [RetainedEarnings]", n * 0.38),
        ("balance_sheet", "us-gaap:StockholdersEquity [CommonClassA]", n * 0.2),  # counts in annual filings only
        ("balance_sheet", "us-gaap:StockholdersEquity [Parent]", n),
        ("balance_sheet", f"{R.TEMPORARY_PRIMARY[0]} [Part]", a * 0.0),
        ("income_stmt", R.REVENUE[1], ext),
        ("income_stmt", R.REVENUE[0], ext),
        ("income_stmt", f"{R.REVENUE[0]} [Product]", ext * 0.6),
        ("income_stmt", f"{R.REVENUE[0]} [Service]", ext * F.when(k % 4 == 0, 0.3).otherwise(0.4)),
        *[("income_stmt", f"{R.REVENUE[0]} [{s}]", F.when(k % 6 != 0, ext * 0.2) if s == R.SEGMENTS[0] else ext * F.when(k % 6 == 1, 0.1).otherwise(0.2)) for s in R.SEGMENTS],
        ("other", R.COST[1], disc),
        ("other", f"{R.COST[0]} [Product]", disc * 0.5),
        ("other", f"{R.COST[0]} [Service]", disc * F.when(k % 4 == 1, 0.3).otherwise(0.5)),
        ("income_stmt", "us-gaap:GrossProfit", ext - disc - tax),
        ("income_stmt", "us-gaap:OperatingExpenses", tax * F.when(k % 3 == 0, 3.0).otherwise(1.0)),
        ("other", R.RESEARCH, tax * 0.4),
        ("income_stmt", R.SELLING, tax * 0.5),
        ("income_stmt", R.OTHER_OPEX[0], tax * 0.1),
        ("other", "us-gaap:OperatingIncomeLoss", ext - disc - tax * 2),
        ("other", R.NONOP_TOTALS[0], F.when(k % 2 == 0, disc + tax * 2)),
        ("income_stmt", "us-gaap:InterestExpense", tax),
        ("income_stmt", R.PRETAX[2], ext),
        ("income_stmt", R.TAX[0], F.when(k % 2 == 0, tax)),
        ("income_stmt", R.NET[0], ext - tax),
        ("other", R.OCI[1], tax),
        ("income_stmt", R.COMPREHENSIVE[0], ext * F.when(k % 3 == 1, 1.2).otherwise(1.0)),
        ("cashflow", R.OPERATING[0], a),
        ("cashflow", R.INVESTING[0], n),
        ("cashflow", R.FINANCING[0], -disc),
        ("other", R.CASH_CHANGE[0], ext),
    ]
    listed = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(c).alias("concept"), v.alias("value"), F.lit(i).alias("ord")) for i, (s, c, v) in enumerate(facts)])
    form = F.when(F.col("l_orderkey") % 2 == 0, "10-K/A").otherwise("10-Q")
    return lines.select(F.col("l_orderkey").cast("string").alias("accession"), form.alias("form_type"), F.explode(listed).alias("f")).select("accession", "form_type", "f.*")


_ORDER_SUMS = """
WITH s AS (
  SELECT l_orderkey::VARCHAR AS accession, sum(l_extendedprice) AS ext, sum(l_extendedprice * l_discount) AS disc, sum(l_extendedprice * l_tax) * 1.01 AS tax,
         sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS a, sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END) AS n, count(*) AS k, l_orderkey % 2 = 0 AS annual
  FROM lineitem GROUP BY l_orderkey
), v AS (
  SELECT *, CASE WHEN k % 5 <> 0 THEN n END AS eq, a * CASE WHEN k % 3 = 0 THEN 0.4 ELSE 0.5 END AS lnon, ext - disc - tax AS gross, tax * CASE WHEN k % 3 = 0 THEN 3 ELSE 1 END AS opex,
         ext - disc - tax * 2 AS op, CASE WHEN k % 2 = 0 THEN disc + tax * 2 ELSE -tax END AS nonop, CASE WHEN k % 2 = 0 THEN tax ELSE 0 END AS paid,
         ext * CASE WHEN k % 3 = 1 THEN 1.2 ELSE 1 END AS comp, ext * CASE WHEN k % 4 = 0 THEN 0.3 ELSE 0.4 END AS service, disc * CASE WHEN k % 4 = 1 THEN 0.3 ELSE 0.5 END AS served,
         n * CASE WHEN annual THEN 1.18 ELSE 0.98 END AS parts, ext * CASE WHEN k % 6 = 1 THEN 0.6 ELSE 1 END AS segments
  FROM s
)
"""


def _within(left: str, right: str, *others: str) -> str:
    """SQL: two sides differ by at most 5 % of the largest number involved."""
    return f"abs(({left}) - ({right})) / greatest({', '.join(f'abs({x})' for x in (left, right, *others))}, 1e-9) * 100 <= 5"


#: SQL of each check: its two sides, the other numbers involved, and its status.
_CHECKED = "'checked'"
_CHECK_SQL = {
    "balance sheet identity": ("ext", "a + eq", ("a", "eq",), "CASE WHEN eq IS NULL THEN 'missing' ELSE 'checked' END"),
    "assets by term": ("ext", "a + n", ("a", "n",), _CHECKED),
    "liabilities by term": ("a", "a * 0.5 + lnon", ("a * 0.5", "lnon",), _CHECKED),
    "gross profit": ("gross", "ext - disc", ("ext", "disc",), _CHECKED),
    "operating income": ("op", "gross - opex", ("gross", "opex",), "CASE WHEN opex = 0 THEN 'skipped' ELSE 'checked' END"),
    "operating expenses": ("opex", "tax", ("tax * 0.5",), "CASE WHEN opex = 0 THEN 'skipped' ELSE 'checked' END"),
    "pretax income": ("ext", "op + nonop", ("op", "nonop",), _CHECKED),
    "net income": ("ext - tax", "ext - paid", ("ext", "paid",), _CHECKED),
    "comprehensive income": ("comp", "ext", ("ext - tax", "tax",), _CHECKED),
    "cash flow": ("a + n - disc", "ext", ("a", "n", "disc",), _CHECKED),
    "equity components": ("eq", "parts", (), "CASE WHEN eq IS NULL THEN 'missing' WHEN n = 0 THEN 'skipped' ELSE 'checked' END"),
    "revenue by kind": ("ext", "ext * 0.6 + service", ("ext * 0.6", "service",), _CHECKED),
    "cost by kind": ("disc", "disc * 0.5 + served", ("disc * 0.5", "served",), "CASE WHEN disc = 0 THEN 'skipped' ELSE 'checked' END"),
    "revenue by segment": ("ext", "segments", (), "CASE WHEN k % 6 = 0 THEN 'skipped' ELSE 'checked' END"),
}


def _check_select(name: str) -> str:
    left, right, others, status = _CHECK_SQL[name]
    good = _within(left, right, *others)
    return f"SELECT accession, '{name}' AS check_name, status, CASE status WHEN 'checked' THEN good ELSE status = 'skipped' END AS passed FROM (SELECT accession, {status} AS status, {good} AS good FROM v)"


def _check_query(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checks.run_checks(order_facts(spark, sf_dir), [name]).select("accession", "check_name", "status", "passed")

    return query


for _n, _name in enumerate(checks.CHECKS, 1):
    register(f"c{_n:02d}_{_name.replace(' ', '_')}", _ORDER_SUMS + _check_select(_name))(_check_query(_name))

_ALL = " UNION ALL ".join(map(_check_select, checks.CHECKS))


#: Differences are given in units without a tie at the last digit kept.
_UNIT = 7919.13


def _difference_select(name: str) -> str:
    left, right, others, status = _CHECK_SQL[name]
    gap = f"({left}) - ({right})"
    pct = f"abs({gap}) / greatest({', '.join(f'abs({x})' for x in (left, right, *others))}, 1e-9) * 100"
    return f"""SELECT accession, '{name}' AS check_name, CASE WHEN ({status}) = 'checked' THEN round({gap} + 0.0, 6) END AS d, CASE WHEN ({status}) = 'checked' THEN {pct} END AS pct FROM v"""


_DIFFERENCES = " UNION ALL ".join(map(_difference_select, checks.CHECKS))


@register("c15_differences", f"{_ORDER_SUMS} SELECT accession, check_name, CASE WHEN abs(d) < 1e-3 THEN 0 ELSE round(d / {_UNIT}, 4) END AS difference, round(pct, 2) AS difference_pct FROM ({_DIFFERENCES})")
def c15_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two sides of every check differ by, and that in percent of the largest number involved."""
    found = checks.run_checks(order_facts(spark, sf_dir))
    difference = F.when(F.abs("difference") < 1e-3, 0.0).otherwise(F.round(F.col("difference") / _UNIT, 4))
    return found.select("accession", "check_name", difference.alias("difference"), "difference_pct")


@register(
    "c10_strict_cash_flow",
    _ORDER_SUMS + "SELECT accession, abs(a + n - disc - ext) / greatest(abs(a + n - disc), ext, 1e-9) * 100 <= 5 AS passed_strict, a + n - disc - ext > 0 AS above FROM v",
)
def c10_strict_cash_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict by the two sides alone, and the sign of the difference."""
    return checks.run_checks(order_facts(spark, sf_dir), ["cash flow"]).select("accession", "passed_strict", (F.col("difference") > 0).alias("above"))


@register("c00_all_checks", f"{_ORDER_SUMS} SELECT * FROM ({_ALL}) UNION ALL SELECT o_orderkey || '-L', 'assets = liabilities and equity', 'checked', o_orderkey % 3 <> 0 FROM orders " + "".join(f"UNION ALL SELECT o_orderkey || '-L', '{n}', 'skipped', true FROM orders " for n in ("revenue - cost = gross profit", "revenue - cost = operating income", "pretax - tax = net income", "cash flow")))
def c00_all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period-keyed filings of both forms, and early statements, by their shape."""
    k = F.col("o_orderkey")
    rows = [("Total Assets", F.col("o_totalprice")), ("Total Liabilities and Equity", F.col("o_totalprice") * F.when(k % 3 == 0, 1.2).otherwise(1.0))]
    early = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), v.alias("value"), F.lit(i).alias("ord")) for i, (n, v) in enumerate(rows)]))
    statements = table(spark, sf_dir, "orders").select(F.concat(k.cast("string"), F.lit("-L")).alias("accession"), early.alias("r")).select("accession", "r.*")
    return checks.run_all_checks(order_facts(spark, sf_dir), statements).select("accession", "check_name", "status", "passed")


@register("c15_suite_counts", f"{_ORDER_SUMS} SELECT check_name, count(*) AS n, count(*) FILTER (passed) AS n_passed, count(*) FILTER (status = 'checked') AS n_checked FROM ({_ALL}) GROUP BY 1")
def c15_suite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = checks.run_checks(order_facts(spark, sf_dir))
    return results.groupBy("check_name").agg(F.count("*").alias("n"), F.count_if("passed").alias("n_passed"), F.count_if(F.col("status") == "checked").alias("n_checked"))


@register(
    "c17_failures",
    f"""{_ORDER_SUMS}
    SELECT accession, count(*) FILTER (NOT passed) AS n_failed, count(*) AS n_checks, string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed) AS names FROM ({_ALL}) GROUP BY 1 HAVING count(*) FILTER (NOT passed) > 0""",
)
def c17_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fourteen checks; a name's percentage is left out."""
    found = checks.check_failures(checks.run_checks(order_facts(spark, sf_dir)))
    names = F.array_join(F.array_sort(F.transform("failed", lambda x: F.regexp_replace(x, r" \([0-9.]+%\)$", ""))), ",")
    return found.select("accession", "n_failed", "n_checks", names.alias("names"))


@register(
    "c16_legacy_checks",
    """
    WITH v AS (SELECT o_orderkey::VARCHAR AS accession, o_totalprice AS p, o_orderkey AS k FROM orders)
    SELECT accession, 'assets = liabilities and equity' AS check_name, 'checked' AS status, k % 2 = 0 AS passed FROM v
    UNION ALL SELECT accession, 'revenue - cost = gross profit', 'checked', k % 3 <> 0 FROM v
    UNION ALL SELECT accession, 'revenue - cost = operating income', 'skipped', true FROM v
    UNION ALL SELECT accession, 'pretax - tax = net income', CASE WHEN k % 5 = 0 THEN 'skipped' ELSE 'checked' END, true FROM v
    UNION ALL SELECT accession, 'cash flow', 'checked', k % 7 <> 0 FROM v
    """,
)
def c16_legacy_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows, some found by the beginning of a label only."""
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    rows = [
        ("TOTAL ASSETS", p),
        ("Total Liabilities And Stockholders' Equity", p * F.when(k % 2 == 0, 1.0).otherwise(1.5)),
        ("Net Sales", p * 2),
        ("Cost of sales (note 3)", p),
        ("Gross Profit", p * F.when(k % 3 == 0, 3.0).otherwise(1.01)),
        ("Income before income taxes", p),
        ("Income Taxes", p * 0.3),
        ("Net Income", F.when(k % 5 != 0, p * 0.7)),
        ("Net cash provided by operating activities", p * 3),
        ("Net cash used in investing activities", -p),
        ("Net cash used in financing activities", -p),
        ("Net increase in cash", p * F.when(k % 7 == 0, 2.0).otherwise(1.0)),
    ]
    listed = F.explode(F.array(*[F.struct(F.lit(n).alias("label"), v.alias("value"), F.lit(i).alias("ord")) for i, (n, v) in enumerate(rows)]))
    facts = table(spark, sf_dir, "orders").select(k.cast("string").alias("accession"), listed.alias("r")).select("accession", "r.*")
    return checks.run_legacy_checks(facts).select("accession", "check_name", "status", "passed")


@register("c18_flat_facts", "SELECT c_name AS accession, '1998-12-31' AS period, 'bs' AS section, 'us-gaap:Assets' AS concept, c_acctbal AS value, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'N/A' END AS ticker FROM customer UNION ALL SELECT c_name, '1999-12-31', 'inc', 'us-gaap:Revenues', c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'N/A' END FROM customer")
def c18_flat_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda s, c, v: F.create_map(F.lit(s), F.create_map(F.lit(c), v.cast("double")))
    nested = F.create_map(F.lit("1998-12-31"), one("bs", "us-gaap:Assets", F.col("c_acctbal")), F.lit("1999-12-31"), one("inc", "us-gaap:Revenues", F.col("c_custkey")))
    ticker = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    return checks.flatten_facts(table(spark, sf_dir, "customer").select(F.col("c_name").alias("accession"), ticker.alias("ticker"), nested.alias("periods")))


def _part_query(part: str, value):
    """A query of one total that the checks are made of."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return checks.filing_parts(order_facts(spark, sf_dir), [part]).select("accession", value(F.col(part)).alias("value"))

    return query


_PART_SQL = _ORDER_SUMS + "SELECT accession, {} AS value FROM v"
register("a12_temporary_equity", _PART_SQL.format("0.0::DOUBLE"))(_part_query("temporary equity", lambda v: v))
register("a15_other_opex", _PART_SQL.format("CASE WHEN tax = 0 THEN 0 ELSE 1 END"))(_part_query("other operating expenses", lambda v: (v > 0).cast("int")))
register("a16_nonoperating_total", _PART_SQL.format("CASE WHEN k % 2 = 0 THEN 'reported' WHEN tax = 0 THEN 'none' ELSE 'interest' END"))(
    _part_query("nonoperating total", lambda v: F.when(v.isNull(), "none").when(v >= 0, "reported").otherwise("interest"))  # a reported total may be zero
)


@register("a13_equity_components", _PART_SQL.format("CASE WHEN n > 0 THEN annual END"))
def a13_equity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the components are more than what the balance sheet names as noncurrent assets."""
    facts = order_facts(spark, sf_dir)
    parts, other = checks.filing_parts(facts, ["equity"]), checks.first_values(facts, {"noncurrent": ([checks.BS], ["us-gaap:AssetsNoncurrent"])})
    return parts.join(other, "accession").select("accession", (F.col("equity") > F.col("noncurrent")).alias("value"))


@register("f27_first_values", _PART_SQL.format("ext > a AND n >= 0"))
def f27_first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {
        "revenue": ([checks.OTHER, checks.INC], R.REVENUE),
        "flow": ([checks.CF, checks.BS], [R.OPERATING[0], "us-gaap:Assets"]),
        "noncurrent": ([checks.BS], ["us-gaap:Gone", "us-gaap:AssetsNoncurrent"]),
    }
    return checks.first_values(order_facts(spark, sf_dir), wanted).select("accession", ((F.col("revenue") > F.col("flow")) & (F.col("noncurrent") >= 0)).alias("value"))


@register(
    "j21_best_subset",
    """
    WITH v AS (SELECT l_orderkey AS accession, l_extendedprice AS v, row_number() OVER (PARTITION BY l_orderkey ORDER BY abs(l_extendedprice) DESC, l_linenumber, l_partkey) AS n FROM lineitem),
         t AS (SELECT * FROM v WHERE n <= 10), o AS (SELECT l_orderkey AS accession, round(sum(l_extendedprice), 2) / 2 AS target FROM lineitem GROUP BY 1),
         sums AS (
           SELECT accession, v AS s FROM t
           UNION ALL SELECT a.accession, a.v + b.v FROM t a JOIN t b ON a.accession = b.accession AND a.n < b.n
           UNION ALL SELECT a.accession, a.v + b.v + c.v FROM t a JOIN t b ON a.accession = b.accession AND a.n < b.n JOIN t c ON b.accession = c.accession AND b.n < c.n)
    SELECT accession, target, round(min(abs(s - target)), 3) AS error FROM sums JOIN o USING (accession) GROUP BY 1, 2
    """,
)
def j21_best_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.col("l_extendedprice").alias("v"), F.struct("l_linenumber", "l_partkey").alias("o"))
    targets = lines.groupBy("accession").agg((F.round(F.sum("v"), 2) / 2).alias("target"))
    return joins.best_subset_sum(lines, targets, ["accession"], "v", "o").select("accession", "target", F.round("error", 3).alias("error"))


@register(
    "a06_pivot_facts",
    """
    WITH sets AS (SELECT l_orderkey AS accession, l_returnflag AS concept, l_linestatus AS dims, arg_max(l_quantity, o) AS value, min(o) AS f FROM (SELECT *, ((l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey) * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS o FROM lineitem) GROUP BY 1, 2, 3)
    SELECT accession, concept AS label, arg_max(value, f) AS value FROM sets GROUP BY 1, 2
    """,
)
def a06_pivot_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    facts = lines.select(F.col("l_orderkey").alias("accession"), F.col("l_returnflag").alias("concept"), F.col("l_linestatus").alias("dims"), F.col("l_returnflag").alias("label"), F.col("l_quantity").alias("value"), (((F.col("l_linenumber") * 100000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")) * 2 + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("ord"))
    return aggregate.pivot_facts(facts).select("accession", "label", "value")


@register(
    "w06_topk_abs",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_totalprice) DESC, o_orderkey) <= 10",
)
def w06_topk_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.topk_abs(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@register(
    "a11_sum_matching",
    "SELECT p_brand AS accession, sum(CASE WHEN (lower(p_name) LIKE '%red%' OR lower(p_name) LIKE '%ring%') AND lower(p_name) NOT LIKE '%small%' THEN p_retailprice END) AS total FROM part GROUP BY 1",
)
def a11_sum_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("accession"), F.col("p_name").alias("concept"), F.col("p_retailprice").alias("value"))
    return aggregate.sum_matching(facts, ["red", "ring"], ["small"])


@register(
    "a17_run_summary",
    "SELECT count(*) FILTER (value >= 5) AS n_parsed, count(*) FILTER (value < 5) AS n_failed, count(*) FILTER (user_id % 4 > 0) AS n_with_failures, sum(user_id % 4)::BIGINT AS n_failed_checks FROM events",
)
def a17_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.run_summary(table(spark, sf_dir, "events").select((F.col("value") >= 5).alias("parsed"), (F.col("user_id") % 4).alias("failed_checks")))


@register(
    "w08_running_section",
    "SELECT user_id, event_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS section FROM events",
)
def w08_running_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return aggregate.running_section(events, F.col("event_type") == "signup", ["user_id"], "event_id").select("user_id", "event_id", "section")


@register(
    "a20_collapse",
    """
    SELECT user_id AS doc, event_type AS metric, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CASE WHEN value > 15 THEN 0 WHEN value > 5 THEN 1 ELSE 2 END, event_id) = 1
    """,
)
def a20_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("value") > 15, "interval").when(F.col("value") > 5, "exact").otherwise("about")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.lit("p").alias("period"), F.col("event_type").alias("metric"), kind.alias("kind"), F.col("event_id").alias("ord"), "event_id")
    return aggregate.collapse_guidance(rows).select("doc", "metric", "event_id")
