"""Statements in early plain-text filings: tables, their date columns, and the value of the filing's period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.functions.numbers import parse_amounts
from quillstone.functions.text import row_label
from quillstone.operators.aggregate import context_lines, first_table, indent_parent
from quillstone.operators.filing_text import legacy_header

MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December)"
DAY, YEAR = rf"{MONTH}\s+\d{{1,2}}", r"\b(?:19|20)\d{2}\b"
MARKS = "</?(?:S|C|CAPTION)>"


def table_kind(context: Column) -> Column:
    c = F.lower(F.array_join(context, " "))
    return (
        F.when(c.contains("balance sheet"), "balance_sheet")
        .when(c.rlike("statements? of operations|statements of income"), "income_statement")
        .when(c.contains("cash flow"), "cash_flow_statement")
        .otherwise("other")
    )


def table_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc, ord, kind, line_no, line): the lines of all tables, ord counting them; the kind comes from the five lines before a table."""
    lines = context_lines(df.select("doc", F.posexplode(F.split(text, r"\r?\n", -1)).alias("line_no", "line")))
    here = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    opens, closes = F.col("line").contains("<TABLE"), F.col("line").contains("</TABLE>")
    rows = lines.withColumn("ord", F.sum(opens.cast("int")).over(here)).withColumn("_closed", F.sum(closes.cast("int")).over(Window.partitionBy("doc", "ord").orderBy("line_no")))
    kind = F.first(F.when(opens, table_kind(F.col("context"))), ignorenulls=True).over(Window.partitionBy("doc", "ord"))
    return rows.withColumn("kind", kind).where((F.col("ord") > 0) & (F.col("_closed") == 0) & ~opens).select("doc", "ord", "kind", "line_no", F.regexp_replace("line", MARKS, "").alias("line"))


def date_columns(lines: Column) -> Column:
    """Struct of dates (ISO texts, one for each column that counts) and skip (lines up to the last one used).

    Dates stand on one line, or their years on one of the next four; if there are more years than
    days, each day has several. Where three and six months are shown, the first half of the columns counts.
    """
    head = F.slice(lines, 1, 10)
    days = F.transform(head, lambda x: F.regexp_extract_all(x, F.lit(f"(?i)({DAY})"), F.lit(1)))
    at = F.coalesce(F.array_min(F.filter(F.transform(days, lambda d, i: F.when(F.size(d) > 0, i)), lambda i: i.isNotNull())), F.lit(-1))
    mine = F.get(days, at)
    years = F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(f"({YEAR})"), F.lit(1)))
    same = F.size(F.get(years, at)) >= F.size(mine)
    later = F.array_min(F.filter(F.transform(F.slice(years, at + 2, F.lit(4)), lambda y, i: F.when(F.size(y) >= F.size(mine), i)), lambda i: i.isNotNull()))
    line = F.when(same, at).otherwise(at + 1 + later)
    ys = F.get(years, line)
    each = F.greatest(F.floor(F.size(ys) / F.size(mine)).cast("int"), F.lit(1))
    pairs = F.transform(F.slice(ys, F.lit(1), F.size(mine) * each), lambda y, i: F.concat(F.get(mine, F.floor(i / each).cast("int")), F.lit(", "), y))
    iso = F.transform(pairs, lambda p: F.date_format(F.try_to_timestamp(F.initcap(F.regexp_replace(p, r"\s+", " ")), F.lit("MMMM d, yyyy")), "yyyy-MM-dd"))
    near = F.array_join(F.slice(lines, F.greatest(at - 1, F.lit(1)), F.lit(7)), " ")
    halves = near.rlike(r"(?i)three\s+months\s+ended") & near.rlike(r"(?i)six\s+months\s+ended") & (F.size(iso) >= 2)
    kept = F.slice(iso, F.lit(1), F.when(halves, F.floor(F.size(iso) / 2).cast("int")).otherwise(F.size(iso)))
    none = F.struct(F.array().cast("array<string>").alias("dates"), F.lit(0).alias("skip"))
    return F.when((at >= 0) & line.isNotNull(), F.struct(kept.alias("dates"), (line + 1).cast("int").alias("skip"))).otherwise(none)


def legacy_statements(df: DataFrame, text: str = "text", period: str = "period") -> DataFrame:
    """(doc, kind, ord, label, value, values) of the first table of each statement kind.

    A row's label carries its parent, the nearest earlier line without numbers and a smaller
    indent. Its value is that of the filing's period; rows of tables without dates have all
    their values and no value.
    """
    lines = table_lines(df, text).where("kind <> 'other'")
    tables = first_table(lines.groupBy("doc", "kind", "ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("lines")))
    rows = tables.withColumn("_d", date_columns(F.col("lines"))).join(df.select("doc", F.col(period).alias("_period")), "doc")
    each = rows.select("doc", "kind", F.col("ord").alias("table"), "_d", "_period", F.posexplode("lines").alias("ord", "line")).where(F.col("ord") >= F.col("_d.skip"))
    values = parse_amounts(F.col("line"))
    each = each.where(F.col("line").rlike("[A-Za-z]")).withColumns({"values": values, "indent": F.length("line") - F.length(F.ltrim("line")), "label": row_label(F.col("line"))})
    parents = indent_parent(each.withColumn("is_header", F.size("values") == 0), ("doc", "table"))
    label = F.when(F.col("parent").isNotNull(), F.concat("label", F.lit(" ["), "parent", F.lit("]"))).otherwise(F.col("label"))
    place = F.array_position("_d.dates", F.col("_period")).cast("int")
    value = F.when(place > 0, F.get("values", place - 1))
    return parents.where((F.size("values") > 0) & (F.col("label") != "")).select("doc", "kind", "ord", label.alias("label"), value.alias("value"), "values")


def legacy_filings(df: DataFrame, content: str = "content") -> DataFrame:
    """Header fields and the statements of the first document block, as an array; one row for each filing (doc, content)."""
    head = legacy_header(df, content)
    body = df.select("doc", F.regexp_extract(content, r"(?is)<TEXT>(.*?)</TEXT>", 1).alias("text")).join(head.select("doc", "period"), "doc")
    rows = legacy_statements(body).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("kind", "ord", "label", "value"))).alias("statements"))
    return head.join(rows, "doc", "left")
