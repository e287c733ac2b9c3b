"""Identifiers, paths, names and countries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country codes in the order in which they are tried.
COUNTRY_CODES = (
    ("US", "United States"),
    ("USA", "United States"),
    ("AUS", "Australia"),
    ("CAN", "Canada"),
    ("CHN", "China"),
    ("DEU", "Germany"),
    ("FRA", "France"),
    ("GBR", "United Kingdom"),
    ("ITA", "Italy"),
    ("JPN", "Japan"),
    ("MEX", "Mexico"),
    ("BRA", "Brazil"),
    ("IND", "India"),
    ("KOR", "South Korea"),
    ("RUS", "Russia"),
    ("ZAF", "South Africa"),
)


def norm_cik(c: Column) -> Column:
    """A company number as ten digits; null if it is no number."""
    return F.lpad(c.try_cast("bigint").cast("string"), 10, "0")


def accession_of(c: Column) -> Column:
    """The accession code of a file name or path: its last part without .txt or .xbrl."""
    return F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.(txt|xbrl)$", "")


def archive_path(c: Column) -> Column:
    """edgar/data/<number>/<digits>/<accession>.txt of an accession code; null if it is malformed."""
    code = accession_of(c)
    number = F.regexp_extract(code, r"^(\d{10})-\d{2}-\d{6}$", 1)
    path = F.concat(F.lit("edgar/data/"), number.try_cast("bigint").cast("string"), F.lit("/"), F.translate(code, "-", ""), F.lit("/"), code, F.lit(".txt"))
    return F.when(number != "", path)


def three_part_path(c: Column) -> Column:
    """edgar/data/<number>/<accession>.txt with the digits of the accession as a folder between; others as they are."""
    number, code = F.regexp_extract(c, r"^edgar/data/(\d+)/(\d{10}-\d{2}-\d{6})\.txt$", 1), F.regexp_extract(c, r"^edgar/data/(\d+)/(\d{10}-\d{2}-\d{6})\.txt$", 2)
    return F.when(number != "", F.concat(F.lit("edgar/data/"), number, F.lit("/"), F.translate(code, "-", ""), F.lit("/"), code, F.lit(".txt"))).otherwise(c)


def slug(c: Column) -> Column:
    """A form type as part of a path."""
    return F.translate(c, "/\\", "__")


def safe_key(c: Column) -> Column:
    """A key as a file name: other characters than letters, digits, dot, dash and underscore become underscores."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")


def quarter_path(c: Column) -> Column:
    """(year, quarter, form) of a folder <year>/QTR<n>/<form>; null for other layouts."""
    pattern = r"(?:^|/)(\d{4})/(QTR[1-4])/([^/]+)/?$"
    year, quarter, form = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    return F.when(year != "", F.struct(year.cast("int").alias("year"), quarter.alias("quarter"), form.alias("form_type")))


def archive_name(year: Column, quarter: Column, form: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("_"), quarter, F.lit("_"), slug(form), F.lit(".zip"))


def is_ticker(c: Column) -> Column:
    """Two to five letters or digits that are no placeholder."""
    return F.coalesce(c.rlike("^[A-Za-z0-9]{2,5}$") & ~F.upper(c).isin("NONE", "N/A", "NA"), F.lit(False))


def series_country(c: Column, strict: bool = False) -> Column:
    """The country whose code a series id holds, United States if there is none.

    Codes are tried in their fixed order, so US wins over AUS and RUS; `strict` tries the longest first.
    """
    codes = sorted(COUNTRY_CODES, key=lambda x: -len(x[0])) if strict else COUNTRY_CODES
    case = F.lit("United States")
    for code, country in reversed(codes):
        case = F.when(F.upper(c).contains(code), F.lit(country)).otherwise(case)
    return case


def join_list(c: Column) -> Column:
    """List elements as one text."""
    return F.array_join(c, ", ")


def fact_label(concept: Column, dimensions: Column) -> Column:
    """The concept with its members in brackets: axes dropped, sorted by axis, a trailing Member cut."""
    entries = F.array_sort(F.map_entries(dimensions))
    members = F.transform(entries, lambda e: F.regexp_replace(F.element_at(F.split(e["value"], ":"), -1), "Member$", ""))
    return F.when(dimensions.isNull() | (F.size(dimensions) == 0), concept).otherwise(F.concat(concept, F.lit(" ["), F.array_join(members, ", "), F.lit("]")))


def dimension_key(dimensions: Column) -> Column:
    """A map of dimensions as one text that ignores the order of its keys; empty for none."""
    entries = F.array_sort(F.map_entries(dimensions))
    return F.coalesce(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "|"), F.lit(""))
