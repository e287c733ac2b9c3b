"""Text of pages and filings."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where the narrative of a filing begins.
NARRATIVE = (
    r"(?iU)UNITED\s+STATES\s+SECURITIES\s+AND\s+EXCHANGE"
    r"|U\.S\.\s+SECURITIES\s+AND\s+EXCHANGE"
    r"|FORM\s+10-[KQ]|FORM\s+8-K"
    r"|TABLE\s+OF\s+CONTENTS"
    r"|PART\s+[IV]+\s"
    r"|ITEM\s+1\."
    r"|Exhibit\s+99"
)


# Character references that are decoded by expressions; the ampersand's comes last, as what it makes is no reference.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&mdash;", "\u2014"), ("&ndash;", "\u2013"), ("&amp;", "&"))


@F.pandas_udf(T.StringType())
def _unescape_all(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def unescape(c: Column) -> Column:
    """Decodes character references: the common ones by expressions, and only texts that have others in Python."""
    names = "|".join(re.escape(r[1:]) for r, _ in REFERENCES)
    other = F.when(c.rlike(f"&(?!(?:{names}))[#A-Za-z]"), c)
    plain = c
    for reference, character in REFERENCES:
        plain = F.replace(plain, F.lit(reference), F.lit(character))
    return F.coalesce(_unescape_all(other), plain)


def strip_tags(c: Column) -> Column:
    """Tags to blanks, runs of blanks to one, trimmed; no character reference is decoded."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(?U)\s+", " "))


def unescape_listed(c: Column, names: Sequence[str]) -> Column:
    """Decodes these of the common references only, and only where a semicolon closes them."""
    if unknown := set(names) - {r for r, _ in REFERENCES}:
        raise ValueError(f"unknown references: {sorted(unknown)}")
    for reference, character in REFERENCES:
        c = F.replace(c, F.lit(reference), F.lit(character)) if reference in names else c
    return c


def strip_html(c: Column, names: Sequence[str] | None = None) -> Column:
    """strip_tags() with character references decoded, all that there are or the listed ones only."""
    plain = F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(?U)\s+", " ")
    return F.trim(unescape(plain) if names is None else unescape_listed(plain, names))


def snippet(c: Column, n: int = 500) -> Column:
    """At most n characters from the beginning of the narrative, with an ellipsis if more follows."""
    start = F.greatest(F.regexp_instr(c, F.lit(NARRATIVE)), F.lit(1))
    cut = F.trim(F.substring(c, start, F.lit(n)))
    return F.coalesce(F.when(F.length(c) > start - 1 + n, F.concat(cut, F.lit("…"))).otherwise(cut), F.lit(""))


@F.pandas_udf(T.StringType())
def title_case(s: pd.Series) -> pd.Series:
    """A capital after everything that is no letter."""
    return s.map(lambda x: None if x is None else x.title())


def row_label(c: Column) -> Column:
    """A row's label: what stands before the first number, without edge punctuation, in title case."""
    before = F.regexp_extract(F.trim(c), r"(?U)^(.*?)(?:\s{2,}|\s*[$(]?\s*\d|\.{2,}|$)", 1)
    return title_case(F.regexp_replace(F.regexp_replace(before, r"^[ .:\t]+|[ .:\t]+$", ""), r"(?U)\s+", " "))
