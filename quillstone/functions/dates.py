"""Dates and periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The date formats in the order in which they are tried.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "d-MMM-yyyy", "M-d-yyyy", "yyyy")
QUARTER_ENDS = {"Q1": "03-31", "Q2": "06-30", "Q3": "09-30", "Q4": "12-31", "FY": "12-31"}


def bls_period_date(year: Column, period: Column) -> Column:
    """The first day of a period code: Mnn, Qn, Sn; the year's first day for M13, A00 and unknown codes.

    Month numbers that a quarter or half gives beyond December are null.
    """
    kind, number = F.substring(period, 1, 1), F.substring(period, 2, 8).try_cast("int")
    month = (
        F.when((kind == "M") & number.between(1, 12), number)
        .when((kind == "Q") & number.isNotNull(), (number - 1) * 3 + 1)
        .when((kind == "S") & number.isNotNull(), (number - 1) * 6 + 1)
        .otherwise(1)
    )
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lit("01")).try_cast("date")


def sdmx_period_date(c: Column, iso_weeks: bool = False) -> Column:
    """The first day of YYYY, YYYYQn, YYYY-Qn, YYYYMnn, YYYY-MM, YYYY-Wnn or an ISO date; null for others.

    A week gives the year's first day, or the Monday of the ISO week if asked for.
    """
    t = F.upper(F.trim(c))
    year = F.regexp_extract(t, r"^(\d{4})", 1)

    def day(month: Column) -> Column:
        return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lit("01")).try_cast("date")

    def part(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(t, pattern, 1), F.lit(""))

    quarter, month, week = part(r"^\d{4}-?Q([1-4])$"), part(r"^\d{4}(?:M|-)(\d{2})$"), part(r"^\d{4}-?W(\d{2})$")
    first = F.concat(year, F.lit("-01-04")).try_cast("date")  # always in the first ISO week
    monday = F.date_add(F.date_trunc("week", first).cast("date"), (week.try_cast("int") - 1) * 7)
    return F.coalesce(
        F.when(quarter.isNotNull(), day((quarter.try_cast("int") - 1) * 3 + 1)),
        F.when(month.isNotNull(), day(month)),
        F.when(week.isNotNull(), monday if iso_weeks else day(F.lit(1))),
        F.when(t.rlike(r"^\d{4}$"), day(F.lit(1))),
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.substring(t, 1, 10).try_cast("date")),
    )


def parse_date_multi(c: Column) -> Column:
    """The date by the first of the fixed formats that fits; null if none does."""
    t = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in DATE_FORMATS])


def legacy_period(c: Column) -> Column:
    """YYYYMMDD or 'Month d, yyyy' as an ISO date; others as they are."""
    t = F.trim(c)
    iso = F.coalesce(F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd"))), F.try_to_timestamp(t, F.lit("MMMM d, yyyy")))
    return F.coalesce(F.date_format(iso, "yyyy-MM-dd"), c)


def period_key(instant: Column, end: Column) -> Column:
    """The end of the month of an instant, else of an end date; what follows the date (a time) is kept."""
    t = F.coalesce(instant, end)
    return F.concat(F.last_day(F.substring(t, 1, 10).try_cast("date")).cast("string"), F.substring(t, 11, 100))


def previous_quarter(d: Column) -> Column:
    """(year, quarter) of the quarter before a date's."""
    before = F.add_months(F.trunc(d, "quarter"), -1)
    return F.struct(F.year(before).alias("year"), F.concat(F.lit("QTR"), F.quarter(before).cast("string")).alias("quarter"))


def to_epoch_ms(c: Column) -> Column:
    """Milliseconds since 1970 of an ISO-like text (UTC unless it names an offset); null if malformed."""
    return F.unix_millis(F.try_to_timestamp(c))


def quarters(spark: SparkSession, start_year: int, today: str) -> DataFrame:
    """(year, quarter, first_day) of every calendar quarter from a year to the quarter of `today`."""
    days = F.sequence(F.make_date(F.lit(start_year), F.lit(1), F.lit(1)), F.trunc(F.lit(today).cast("date"), "quarter"), F.expr("interval 3 month"))
    rows = spark.range(1).select(F.explode(F.when(F.lit(start_year) <= F.year(F.lit(today).cast("date")), days)).alias("first_day"))
    return rows.select(F.year("first_day").alias("year"), F.concat(F.lit("QTR"), F.quarter("first_day").cast("string")).alias("quarter"), "first_day")


def document_period_end(facts: DataFrame) -> DataFrame:
    """(accession, doc_end) from the facts dei:DocumentPeriodEndDate, else fiscal year and period focus."""
    def of(concept: str) -> Column:
        return F.min_by(F.when(F.col("concept") == concept, F.trim("value")), F.when(F.col("concept") == concept, F.col("ord")))

    picked = facts.where(F.col("concept").startswith("dei:Document")).groupBy("accession").agg(
        of("dei:DocumentPeriodEndDate").alias("d"), of("dei:DocumentFiscalYearFocus").alias("y"), of("dei:DocumentFiscalPeriodFocus").alias("p")
    )
    ends = F.create_map(*[F.lit(x) for pair in QUARTER_ENDS.items() for x in pair])
    by_focus = F.concat(F.lpad(F.col("y").try_cast("int").cast("string"), 4, "0"), F.lit("-"), F.try_element_at(ends, F.upper("p")))
    return picked.select("accession", F.coalesce(F.substring("d", 1, 10).try_cast("date"), by_focus.try_cast("date")).alias("doc_end"))
