"""Aggregations, pivots and order-dependent choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.operators.joins import per_filing


def or_unknown(c: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Unknown"))


def sector_location_weights(holdings: DataFrame) -> DataFrame:
    """Weights by fund, sector and location; blanks are Unknown, null weights 0, rows without a fund go."""
    rows = holdings.where(F.trim(F.coalesce("etf_ticker", F.lit(""))) != "")
    return rows.groupBy("etf_ticker", or_unknown("sector").alias("sector"), or_unknown("location").alias("location")).agg(F.sum(F.coalesce("weight", F.lit(0))).alias("weight"))


def high_water(df: DataFrame, keys: Sequence[str], date_col: str = "date") -> DataFrame:
    """The last date of each key, and the day after."""
    last = F.max(F.col(date_col)).cast("date")
    return df.groupBy(*keys).agg(last.alias("last_date")).withColumn("next_start", F.date_add("last_date", 1))


def loaded_quarters(index: DataFrame, start_year: int | None = None) -> DataFrame:
    rows = index if start_year is None else index.where(F.col("year") >= start_year)
    return rows.select("year", "quarter").distinct().orderBy("year", "quarter")


def integrity_counts(errors: DataFrame, warnings: DataFrame) -> DataFrame:
    """Errors and warnings of each accession."""
    both = errors.select("accession", F.lit(1).alias("e"), F.lit(0).alias("w")).unionByName(warnings.select("accession", F.lit(0).alias("e"), F.lit(1).alias("w")))
    return both.groupBy("accession").agg(F.sum("e").alias("n_errors"), F.sum("w").alias("n_warnings"))


def pivot_facts(facts: DataFrame, by: Sequence[str] = ("accession",)) -> DataFrame:
    """One value for each label: the last of each concept and dimension set, then, of sets with one label, that of the set seen last.

    `facts` has concept, dims, label, value and ord.
    """
    sets = facts.groupBy(*by, "concept", "dims").agg(F.max_by("value", "ord").alias("value"), F.max_by("label", "ord").alias("label"), F.min("ord").alias("first_ord"))
    return sets.groupBy(*by, "label").agg(F.max_by("value", "first_ord").alias("value"), F.min("first_ord").alias("ord"))


def pivot_facts_wide(facts: DataFrame, by: Sequence[str] = ("accession",)) -> DataFrame:
    """For each label a map from period to the last value, the newest period first."""
    last = facts.groupBy(*by, "label", "period").agg(F.max_by("value", "ord").alias("value"))
    return last.groupBy(*by, "label").agg(F.map_from_entries(F.reverse(F.array_sort(F.collect_list(F.struct("period", "value"))))).alias("values"))


def pivot_series(df: DataFrame, series: Sequence[str], date_col: str = "date", key: str = "series_id", value: str = "value", order: str | None = None) -> DataFrame:
    """One row for each date, one column for each series: the first value in order (the smallest without one)."""
    def of(s: str) -> Column:
        mine = F.when(F.col(key) == s, F.col(value))
        return F.min_by(mine, F.when(F.col(key) == s, F.col(order))) if order else F.min(mine)

    return df.groupBy(date_col).agg(*[of(s).alias(s) for s in series])


def collect_dei(facts: DataFrame) -> DataFrame:
    """Distinct values of each document concept, in order; check marks are true and false, error texts go."""
    mark = F.when(F.col("value").isin("☒", "☑", "✓"), "true").when(F.col("value") == "☐", "false").otherwise(F.col("value"))
    rows = facts.where(F.col("concept").startswith("dei:")).withColumn("v", mark).where(F.col("v").isNotNull() & ~F.col("v").rlike(r"(?i)^\(ix.*error.*\)$"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "v")))
    return rows.groupBy("accession", "concept").agg(F.array_distinct(F.transform(listed, lambda x: x["v"])).alias("values"))


def sum_matching(facts: DataFrame, contains: Sequence[str], excludes: Sequence[str] = (), name: str = "total", by: Sequence[str] = ("accession",)) -> DataFrame:
    """Sum over undimensioned facts whose concept holds one of the words and none of the excluded ones; null without such facts."""
    k = F.lower(F.element_at(F.split("concept", ":"), -1))
    fits = F.lit(False)
    for word in contains:
        fits = fits | k.contains(word.lower())
    for word in excludes:
        fits = fits & ~k.contains(word.lower())
    return facts.groupBy(*by).agg(F.sum(F.when(fits & ~F.col("concept").contains("["), F.col("value"))).alias(name))


def sum_dimensioned(facts: DataFrame, base: str, name: str = "total", by: Sequence[str] = ("accession",)) -> DataFrame:
    """Sum over the dimensioned facts of a concept."""
    return facts.groupBy(*by).agg(F.sum(F.when(F.col("concept").startswith(f"{base} ["), F.col("value"))).alias(name))


def run_summary(results: DataFrame) -> DataFrame:
    """Filings parsed and failed, and filings and checks that failed."""
    return results.agg(F.count_if(F.col("parsed")).alias("n_parsed"), F.count_if(~F.col("parsed")).alias("n_failed"), F.count_if(F.col("failed_checks") > 0).alias("n_with_failures"), F.coalesce(F.sum("failed_checks"), F.lit(0)).alias("n_failed_checks"))


def modal_period(facts: DataFrame, by: Sequence[str] = ("accession",)) -> DataFrame:
    """The most frequent period, the first seen on ties."""
    counts = facts.groupBy(*by, "period").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))
    return counts.groupBy(*by).agg(F.max_by("period", F.struct("n", -F.col("first_ord"))).alias("period"))


def collapse_guidance(df: DataFrame, by: Sequence[str] = ("doc", "period", "metric")) -> DataFrame:
    """The most precise entry of each key: an interval before an exact value before others, then the first.

    `kind` and `ord` are those of extract_guidance (its type_value and start).
    """
    rank = F.when(F.col("kind") == "interval", 0).when(F.col("kind") == "exact", 1).otherwise(2)
    first = Window.partitionBy(*by).orderBy(rank, "ord")
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def is_empty_statement(facts: DataFrame, by: Sequence[str] = ("accession", "period")) -> DataFrame:
    """Whether a statement has neither assets nor equity, or fewer than three numbers."""
    number = F.col("value").isNotNull()
    key = F.max(F.when(number & F.col("concept").isin("us-gaap:Assets", "us-gaap:StockholdersEquity"), 1))
    return facts.groupBy(*by).agg((key.isNull() | (F.count_if(number) < 3)).alias("is_empty"))


def load_counts(df: DataFrame, key: str = "survey") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n_rows"))


def topk_abs(df: DataFrame, by: Sequence[str], value: str, ord_col: str, k: int = 10) -> DataFrame:
    """The k rows of largest absolute value in each group, the first on ties, with their rank."""
    top = Window.partitionBy(*by).orderBy(F.abs(F.col(value)).desc(), ord_col)
    return df.where(F.col(value).isNotNull()).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)


def sections(headings: DataFrame, by: Sequence[str] = ("doc",)) -> DataFrame:
    """Sections of a text from its headings (start, stop, item, text): from a heading's end to the next one's start.

    Of headings of one item the last is kept; blank sections go.
    """
    order = Window.partitionBy(*by).orderBy("start")
    nxt = F.coalesce(F.lead("start").over(order), F.length("text") + 1)
    body = F.trim(F.substring("text", F.col("stop"), F.greatest(F.col("_next") - F.col("stop"), F.lit(0))))
    rows = headings.withColumn("_next", nxt).withColumn("section", body).where("section <> ''")
    last = Window.partitionBy(*by, "item").orderBy(F.desc("start"))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*by, "item", "start", "section")


def indent_parent(rows: DataFrame, by: Sequence[str] = ("doc", "table")) -> DataFrame:
    """Each table row's nearest earlier header with a smaller indent, as `parent` (null at the top).

    Rows have ord, indent, label and is_header. A table's headers seen so far are kept per
    indent in one array, so a table is read once.
    """
    seen = F.collect_list(F.when(F.col("is_header"), F.struct("ord", "indent", "label"))).over(Window.partitionBy(*by).orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    smaller = F.filter("_seen", lambda h: h["indent"] < F.col("indent"))
    return rows.withColumn("_seen", seen).withColumn("parent", F.try_element_at(smaller, F.lit(-1))["label"]).drop("_seen")


def rank_periods(facts: DataFrame, doc_end: DataFrame) -> DataFrame:
    """(accession, period, rank): periods from the document's end on come first, nearest first, then earlier ones, latest first.

    Without a document end the order of appearance counts.
    """
    first = facts.where(F.col("period").isNotNull()).groupBy("accession", "period").agg(F.min("ord").alias("first_ord")).join(per_filing(doc_end), "accession", "left")
    gap = F.datediff(F.col("period").try_cast("date"), F.col("doc_end"))
    order = Window.partitionBy("accession").orderBy(F.when(gap.isNull(), 0).when(gap >= 0, 0).otherwise(1), F.when(gap.isNotNull(), F.abs(gap)), "first_ord")
    return first.withColumn("rank", F.row_number().over(order)).select("accession", "period", "rank")


def choose_period(ranked: DataFrame, empties: DataFrame) -> DataFrame:
    """The first candidate whose statement is not empty, else the first."""
    rows = ranked.join(per_filing(empties), ["accession", "period"], "left")
    return rows.groupBy("accession").agg(F.min_by("period", F.struct(F.coalesce("is_empty", F.lit(True)), "rank")).alias("period"))


def first_table(tables: DataFrame) -> DataFrame:
    """The first table of each statement kind in each document."""
    first = Window.partitionBy("doc", "kind").orderBy("ord")
    return tables.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def running_section(df: DataFrame, is_header: Column, by: Sequence[str], order: str) -> DataFrame:
    """Rows with the number of headers up to them as `section`."""
    return df.withColumn("section", F.sum(is_header.cast("int")).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def context_lines(lines: DataFrame, n: int = 5, by: Sequence[str] = ("doc",)) -> DataFrame:
    """Each line with the non-blank ones of the n lines before it, as `context`."""
    before = F.collect_list("line").over(Window.partitionBy(*by).orderBy("line_no").rowsBetween(-n, -1))
    return lines.withColumn("context", F.filter(before, lambda x: F.trim(x) != ""))


def fallback_period(matches: DataFrame) -> DataFrame:
    """The period at each document's last match."""
    return matches.where(F.col("period").isNotNull()).groupBy("doc").agg(F.max_by("period", "start").alias("fallback"))
