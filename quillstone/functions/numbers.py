"""Numbers: parsing, comparison and signs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_A_NUMBER_WORDS = ("", "-", "--", "n/a", "na", "nan", "none", "null")


def parse_num(c: Column, kind: str = "double") -> Column:
    """A number without thousands separators and percent sign; words for missing values and malformed numbers are null."""
    t = F.regexp_replace(F.trim(c), "[,%]", "")
    return F.when(~F.lower(t).isin(*NOT_A_NUMBER_WORDS), finite(t.try_cast("double")) if kind == "double" else t.try_cast(kind))


def finite(c: Column) -> Column:
    """The number, or null if it is infinite or no number."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def parse_amounts(c: Column) -> Column:
    """All accounting amounts of a text, in order: brackets mean minus, dollar signs and commas are dropped."""
    token = r"\(?\$?\s?\(?\d[\d,]*(?:\.\d+)?\)?"
    return F.transform(
        F.regexp_extract_all(c, F.lit(f"({token})"), F.lit(1)),
        lambda x: F.regexp_replace(x, r"[^\d.]", "").try_cast("double") * F.when(x.contains("("), -1.0).otherwise(1.0),
    )


def magnitude(c: Column) -> Column:
    """What a word of magnitude stands for; millions if there is none."""
    return F.when(F.lower(F.trim(c)).isin("billion", "b"), 1e9).otherwise(1e6)


def mcap_to_mln(c: Column) -> Column:
    """A market value like $1.2B in millions; without a suffix it is in millions already."""
    t = F.translate(F.trim(c), ",", "")
    number = F.nullif(F.regexp_extract(t, r"(?i)^\$?([\d.]+)\s*[KMB]?$", 1), F.lit("")).try_cast("double")
    suffix = F.upper(F.regexp_extract(t, r"(?i)^\$?[\d.]+\s*([KMB])$", 1))
    return number * F.when(suffix == "K", 0.001).when(suffix == "B", 1000.0).otherwise(1.0)


def mcap_fmt(c: Column) -> Column:
    """A market value as text with B, M or K; N/A for null."""
    return (
        F.when(c.isNull(), "N/A")
        .when(c >= 1e9, F.format_string("$%.2fB", c / 1e9))
        .when(c >= 1e6, F.format_string("$%.1fM", c / 1e6))
        .when(c >= 1e3, F.format_string("$%.1fK", c / 1e3))
        .otherwise(F.concat(F.lit("$"), F.format_number(c, 0)))
    )


def coerce_value(c: Column) -> Column:
    """A value as struct<i bigint, d double, s string>: a whole number, a number with a point, or the text; empty is null."""
    t = F.nullif(F.trim(c), F.lit(""))
    d = F.when(t.contains("."), finite(t.try_cast("double")))
    i = F.when(~t.contains("."), t.try_cast("bigint"))
    return F.when(t.isNotNull(), F.struct(i.alias("i"), d.alias("d"), F.when(i.isNull() & d.isNull(), c).alias("s")))


def cast_by_type(c: Column, kind: str) -> Column:
    """A text as str, int, float, bool or datetime (epoch seconds to UTC text); malformed and infinite values are null."""
    match kind:
        case "int":
            return finite(c.try_cast("double")).try_cast("bigint")
        case "float":
            return finite(c.try_cast("double"))
        case "bool":
            return c.try_cast("boolean")
        case "datetime":
            return F.coalesce(F.date_format(F.timestamp_seconds(c.try_cast("bigint")), "yyyy-MM-dd HH:mm:ss"), F.date_format(F.try_to_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
        case "str":
            return c.cast("string")
    raise ValueError(f"unknown type {kind}")


def json_safe(c: Column) -> Column:
    """A struct, map or array as JSON with nulls spelled out."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def approx_eq(a: Column, b: Column, pct: float = 5.0) -> Column:
    """Whether two numbers differ by at most `pct` percent of the larger."""
    return difference_of(F.abs(a - b), [a, b]) <= pct


def difference_of(difference: Column, others: Sequence[Column]) -> Column:
    """A difference in percent of the largest absolute value, nulls left out."""
    return F.abs(difference) / F.greatest(*[F.abs(x) for x in others], F.lit(1e-9)) * 100


def or_else(a: Column, b: Column) -> Column:
    """`a`, or `b` where `a` is null or zero."""
    return F.coalesce(F.nullif(a, F.lit(0.0)), b)


def signed_component(name: Column, v: Column) -> Column:
    """A nonoperating component: positive expenses and losses become negative, net totals and taxes stay."""
    k = F.lower(name)
    stays = k.contains("incometax") | k.contains("incomeexpense")
    deduction = k.contains("expense") | (k.contains("loss") & ~k.contains("gainloss"))
    return F.when(stays, v).when(deduction & (v > 0), -F.abs(v)).otherwise(v)
