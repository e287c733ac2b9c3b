"""Filing text: kinds, document blocks, sections, and forward guidance by patterns with context.

Everything about one document comes from its own text, so the operators work on arrays within a
row and shuffle nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from quillstone.functions.numbers import magnitude, parse_num
from quillstone.functions.text import snippet, strip_html

#: Characters at the beginning of a filing that decide its kind, and its inline flag.
KIND_CHARS, INLINE_CHARS = 200_000, 512_000

# Words and patterns of guidance.
DESCRIPTION_WORDS = ("guidance", "expects", "outlook", "preliminary", "forecast", "expectations")
CONTENT_WORDS = ("guidance", "expects", "outlook", "preliminary", "forecast", "full year", "fiscal year", "annual revenue", "quarterly revenue")
CONTENT_PATTERNS = (
    r"\$[\d,]+(?:\.\d+)?\s*(?:to|-)\s*\$[\d,]+(?:\.\d+)?\s*(?:million|m|b|billion)?",
    r"[\d.]+%\s*(?:to|-)\s*[\d.]+%",
    r"(?:full\s+year|fy)\s+20\d{2}\s+guidance",
)
FISCAL_YEAR = r"(?iU)(?:full\s+year|fy|fiscal\s+year)\s+(20\d{2})"
QUARTER = r"(?iU)q([1-4])\s*(20\d{2})|(?:first|second|third|fourth)\s+quarter\s+(20\d{2})"
CHANGES = (
    ("raised", r"\b(?:raised?|raises?|raising)\s+(?:guidance|outlook|forecast)"),
    ("lowered", r"\b(?:lowered?|lowers?|lowering|reduced?|reduces?)\s+(?:guidance|outlook|forecast)"),
    ("reiterated", r"\b(?:reiterat(?:ed|es?)|reaffirm(?:ed|s))\s+(?:guidance|outlook|forecast)"),
    ("maintained", r"\b(?:maintain(?:ed|s)|confirm(?:ed|s))\s+(?:guidance|outlook|forecast)"),
    ("narrowed", r"\b(?:narrow(?:ed|s)|tighten(?:ed|s))\s+(?:guidance|range)"),
)
HISTORICAL = r"\b(?:previously|had|earlier)\s+(?:raised?|lowered?|raises?|lowers?)\s+(?:guidance|outlook|forecast)"
RESULTS_CONTEXT = (
    r"Three\s+Months\s+Ended|Nine\s+Months\s+Ended",
    r"(?:reported|achieved|actual)\s+(?:revenue|sales|net\s+earnings|eps)",
    r"Net\s+sales\s+(?:increased|decreased|were)\s+",
    r"(?:increased|decreased)\s+to\s+\$",
    r"Diluted\s+earnings\s+per\s+share\s+\$",
    r"(?:Unaudited|Preliminary)\s*[,;]?\s*\(?\$",
)
#: Words, in small letters, one of which each match of these patterns has.
RESULTS_WORDS = ("months", "reported", "achieved", "actual", "sales", "creased", "diluted", "unaudited", "preliminary")
GUIDANCE_WORDS = ("expect", "outlook", "guidance", "anticipate", "project", "forecast")
CHANGE_WORDS = {"raised": ("rais",), "lowered": ("lower", "reduc"), "reiterated": ("reiterat", "reaffirm"), "maintained": ("maintain", "confirm"), "narrowed": ("narrow", "tighten")}
GUIDANCE_CONTEXT = (
    r"\b(?:expects?|expecting)\s+(?:net\s+sales|revenue|to\s+report|to\s+deliver)",
    r"\b(?:expects?|expecting)\s+\w+\s+to\s+",
    r"\b(?:outlook|guidance)\s+(?:for|:)",
    r"(?:Full\s+Year|Fiscal)\s+20\d{2}\s+Outlook",
    r"20\d{2}\s+Guidance\b",
    r"(?:anticipates?|projects?|forecasts?)\s+",
    r"expects?\s+(?:revenue|net\s+sales|diluted\s+eps)",
    r"guidance\s+(?:expecting|of|for|revised)",
)
REVENUE_RANGE = r"(?iU)\$\s*([\d,]+(?:\.\d+)?)\s*(?:to|-)\s*\$\s*([\d,]+(?:\.\d+)?)\s*(million|billion|m|b)?"
REVENUE_SINGLE = r"(?iU)\$\s*([\d,]+(?:\.\d+)?)\s*(million|billion|m|b)\b"
SPECIAL_METRIC, PLAIN_METRIC = ("exome_and_genome_revenue", r"(?iU)exome\s+and\s+genome\s+revenue"), ("revenue", r"(?iU)\brevenue[s]?\b")
METRIC_STOPS = (r"cash(?:\s|,|$)|cash\s+equivalents|marketable\s+securities", r"discrete\s+benefit|one-time\s+benefit|appeal\s+recovery", r"\$[\d,.]+\s+to\s+[\w\s]+\s+revenue")
EPS_RANGE = r"(?iU)(?:eps|earnings\s+per\s+share)[:\s]*(?:of\s+)?\$\s*([\d.]+)\s*(?:to|-)\$?\s*([\d.]+)"
EPS_SINGLE = r"(?iU)(?:eps|earnings\s+per\s+share)[:\s]*(?:of\s+)?\$\s*([\d.]+)\b"
INCOME_WORD = r"(?iU)(?:adjusted\s+)?(?:net\s+)?(?:income|earnings)\s+(positive|negative|profit|profitability|breakeven)"
INCOME_RANGE = r"(?iU)(?:adjusted\s+)?(?:net\s+)?(?:income|earnings)[:\s]*(?:of\s+)?\$\s*([\d,]+(?:\.\d+)?)\s*(?:to|-)\$?\s*([\d,]+(?:\.\d+)?)\s*(million|billion|m|b)?"

# Headings of items, and types of documents without text.
ITEM_HEADING = r"(?i)ITEM\s+(\d+[A-Z]?)\s*[.\-]?\s*[A-Z][A-Z0-9\s\&'\u2019\-]{0,70}(?=\s+[A-Z][a-z])"
BINARY_TYPES = ("GRAPHIC", "XML", "JSON", "ZIP", "PDF", "EXCEL")

# Gross-margin patterns.
MARGIN_BOTH = r"(?iU)GAAP\s+and\s+adjusted\s+gross\s+margin(?:\s+of)?\s+(?:approximately\s+)?([\d.]+)%\s+and\s+([\d.]+)%"
MARGIN_RANGE = r"(?iU)adjusted\s+gross\s+margin(?:\s+of)?\s+([\d.]+)%\s+(?:to|-)\s+([\d.]+)%"
MARGIN_SINGLE = r"(?iU)adjusted\s+gross\s+margin(?:\s+of)?\s+(?:approximately\s+)?([\d.]+)%(?!\s+(?:and|to)\s+[\d.]+%)"
MARGIN_LEAST = r"(?iU)adjusted\s+gross\s+margin\s+at\s+least\s+([\d.]+)%"
MARGIN_GAAP = r"(?iU)GAAP\s+gross\s+margin(?:\s+of)?\s+(?:approximately\s+)?([\d.]+)%"


#: The patterns that are looked for together, with the words that a match begins with, in small letters; none is the beginning of another.
GUIDANCE = {
    "fiscal_year": (FISCAL_YEAR, ("full", "fy", "fiscal")),
    "quarter": (QUARTER, ("q", "first", "second", "third", "fourth")),
    "revenue_range": (REVENUE_RANGE, ("$",)),
    "revenue_single": (REVENUE_SINGLE, ("$",)),
    "eps_range": (EPS_RANGE, ("eps", "earnings")),
    "eps_single": (EPS_SINGLE, ("eps", "earnings")),
    "income_word": (INCOME_WORD, ("adjusted", "net", "income", "earnings")),
    "income_range": (INCOME_RANGE, ("adjusted", "net", "income", "earnings")),
    "margin_both": (MARGIN_BOTH, ("gaap",)),
    "margin_range": (MARGIN_RANGE, ("adjusted",)),
    "margin_single": (MARGIN_SINGLE, ("adjusted",)),
    "margin_least": (MARGIN_LEAST, ("adjusted",)),
    "margin_gaap": (MARGIN_GAAP, ("gaap",)),
}
#: Of these only the places count.
PERIOD_PATTERNS = ("fiscal_year", "quarter")


def _has(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(f"(?iU){pattern}"), F.lit(False))


def _has_any(c: Column, patterns: Sequence[str]) -> Column:
    return _has(c, "|".join(f"(?:{p})" for p in patterns))


def classify_filing(df: DataFrame, content: str = "content") -> DataFrame:
    """`df` with kind: ixbrl, legacy or html, by the beginning of the text; legacy if nothing tells."""
    head = F.lower(F.substring(content, 1, KIND_CHARS))
    inline = head.contains("<ix:") | head.contains("xmlns:ix=")
    legacy = head.contains("privacy-enhanced message") | head.contains("<sec-document>") & ~head.contains("<html")
    return df.withColumn("kind", F.when(inline, "ixbrl").when(legacy, "legacy").when(head.contains("<html"), "html").otherwise("legacy"))


def is_inline_xbrl(df: DataFrame, content: str = "content") -> DataFrame:
    """`df` with is_inline: the beginning has an inline namespace and a fact tag."""
    head = F.lower(F.substring(content, 1, INLINE_CHARS))
    return df.withColumn("is_inline", F.coalesce(head.contains("xmlns:ix=") & head.rlike("<ix:(nonfraction|nonnumeric|header)"), F.lit(False)))


def document_blocks(df: DataFrame, content: str = "content") -> DataFrame:
    """One row for each closed document block: accession, doc_no, type, sequence, filename, description, text, is_xbrl."""
    parts = df.select("accession", F.posexplode(F.split(content, "(?i)<DOCUMENT>", -1)).alias("doc_no", "_part")).where("doc_no > 0")
    closed = parts.where(F.col("_part").contains("</DOCUMENT>")).withColumn("_block", F.substring_index("_part", "</DOCUMENT>", 1))

    def tag(name: str) -> Column:
        return F.regexp_replace(F.regexp_extract("_block", rf"(?is)<{name}>(.*?)(?=<[A-Z]|$)", 1), r"^\s+|\s+$", "").alias(name.lower())

    text = F.regexp_extract("_block", r"(?is)<TEXT>(.*)</TEXT>", 1)
    rows = closed.select("accession", "doc_no", *[tag(n) for n in ("TYPE", "SEQUENCE", "FILENAME", "DESCRIPTION")], text.alias("text"))
    return rows.withColumn("is_xbrl", F.col("text").contains("<XBRL>") & F.col("text").contains("</XBRL>"))


def flag_guidance(df: DataFrame, description: str = "description", text: str = "text", kind: str = "type") -> DataFrame:
    """`df` with has_guidance: a word of the description, or a word or pattern of the content; never for binary documents."""
    d, t = F.lower(F.coalesce(F.col(description), F.lit(""))), F.lower(F.coalesce(F.col(text), F.lit("")))
    found = d.rlike("|".join(DESCRIPTION_WORDS)) | t.rlike("|".join(CONTENT_WORDS)) | _has_any(t, CONTENT_PATTERNS)
    binary = F.upper(F.coalesce(F.col(kind), F.lit(""))).rlike("^(GRAPHIC|ZIP|EXCEL|PDF|XML|JSON)")
    return df.withColumn("has_guidance", found & ~binary)


@F.arrow_udf(T.MapType(T.StringType(), T.StringType()))
def item_sections(texts: pa.Array) -> pa.Array:
    """The sections of plain texts by item (item_1a …): from a heading's end to the next heading; blank ones go, of one item the last stays."""
    heading, out = re.compile(ITEM_HEADING), []
    for t in texts.to_pylist():
        found = list(heading.finditer(t or ""))
        ends = [m.start() for m in found[1:]] + [len(t or "")] * bool(found)
        bodies = [(f"item_{m.group(1).lower()}", t[m.end() : end].strip()) for m, end in zip(found, ends, strict=True)]
        out.append(list({k: body for k, body in bodies if body}.items()))
    return pa.array(out, pa.map_(pa.string(), pa.string()))


def narrative(df: DataFrame, content: str = "content") -> DataFrame:
    """Document blocks of text with plain text, a snippet, their sections and the guidance flag; blocks of facts and binary ones go."""
    blocks = document_blocks(df, content).where(~F.col("is_xbrl") & ~F.upper(F.trim("type")).isin(*BINARY_TYPES))
    rows = blocks.withColumn("text", strip_html(F.col("text")))
    return flag_guidance(rows).withColumns({"snippet": snippet(F.col("text")), "sections": item_sections(F.col("text"))})


#: Characters before and after a match that its context holds.
BEFORE, AFTER = 500, 200


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace("(?iU)", "(?i)").replace("(?U)", ""))  # Python's classes are those of Unicode anyway


def together(patterns: Sequence[tuple[str, Sequence[str]]]) -> Callable[[str], list[list[re.Match]]]:
    """A function from a text to all matches of each (pattern, words that its matches begin with).

    One pass finds where any of the words stands, and a pattern is tried there only. A pattern
    without words passes over the whole text, and so do all in texts beyond ASCII, where case
    is more than small letters.
    """
    found = [_compiled(p) for p, _ in patterns]
    begins: dict[str, list[int]] = {}
    for k, (_, words) in enumerate(patterns):
        for w in words:
            begins.setdefault(w, []).append(k)
    if any(a != b and b.startswith(a) for a in begins for b in begins):
        raise ValueError("a word is the beginning of another")
    anchor = re.compile("|".join(map(re.escape, begins))) if begins else None

    def scan(text: str) -> list[list[re.Match]]:
        if not text.isascii():
            return [list(p.finditer(text)) for p in found]
        out = [[] if words else list(p.finditer(text)) for p, (_, words) in zip(found, patterns, strict=True)]
        low, at, free = text.lower(), 0, [0] * len(found)
        while anchor and (hit := anchor.search(low, at)):
            begin = hit.start()
            at = begin + 1
            for k in begins[hit.group()]:
                if begin >= free[k] and (m := found[k].match(text, begin)):
                    out[k].append(m)
                    free[k] = m.end()
        return out

    return scan


def _as_row(t: str, m: re.Match, context: bool) -> dict:
    a, b = m.span()
    out = {"raw": m.group(), "start": a, "stop": b}
    return out | {"left": t[max(0, a - BEFORE) : a], "right": t[b : b + AFTER]} if context else out


def _row_type(context: bool) -> str:
    return f"array<struct<raw:string,start:int,stop:int{',left:string,right:string' if context else ''}>>"


@lru_cache(maxsize=16)
def _guidance_finder(patterns: tuple[tuple[str, tuple[str, ...]], ...]) -> Callable[[Column], Column]:
    """A vectorised function from texts to a struct with the matches of every pattern, by the names of GUIDANCE."""
    scan = together(patterns)
    with_context = [n not in PERIOD_PATTERNS for n in GUIDANCE]
    struct = T._parse_datatype_string(f"struct<{', '.join(f'{n}: {_row_type(c)}' for n, c in zip(GUIDANCE, with_context, strict=True))}>")
    arrow = to_arrow_type(struct)

    def run(texts: pa.Array) -> pa.Array:
        rows = [(t, scan(t)) for t in (x or "" for x in texts.to_pylist())]
        columns = [pa.array([[_as_row(t, m, c) for m in found[k]] for t, found in rows], arrow.field(k).type) for k, c in enumerate(with_context)]
        return pa.StructArray.from_arrays(columns, fields=list(arrow))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(struct)(run)


@lru_cache(maxsize=64)
def _finder(pattern: str, context: bool) -> Callable[[Column], Column]:
    """A vectorised function from texts to all matches, so that a text is passed over once."""
    found = _compiled(pattern)
    kind = to_arrow_type(T._parse_datatype_string(_row_type(context)))

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [_as_row(t, m, context) for m in found.finditer(t)] for t in texts.to_pylist()], kind)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(_row_type(context))(run)


def matches(text: Column, pattern: str, context: bool = False) -> Column:
    """All matches in order, as (raw, start, stop): positions count from 0, the stop is exclusive.

    With `context`, also the text before (left) and after it (right), so that nobody looks for a
    match's place again. Linear in the text.
    """
    return _finder(pattern, context)(text)


def regex_matches(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """One row for each match: the other columns, ord, raw, start and stop."""
    rows = df.withColumn("_m", matches(F.col(text), pattern))
    return rows.select(*[c for c in df.columns if c != text], F.posexplode("_m").alias("ord", "_x")).select("*", "_x.*").drop("_x")


def periods(text: Column) -> Column:
    """Mentions of fiscal years and quarters as (start, period), by position."""
    return _periods(matches(text, FISCAL_YEAR), matches(text, QUARTER))


def _periods(year_matches: Column, quarter_matches: Column, year_pattern: str = FISCAL_YEAR, quarter_pattern: str = QUARTER) -> Column:
    years = F.transform(year_matches, lambda m: F.struct(m["start"].alias("start"), F.concat(F.lit("FY"), F.regexp_extract(m["raw"], year_pattern, 1)).alias("period")))

    def quarter(m: Column) -> Column:
        raw = F.lower(m["raw"])
        number = F.when(F.regexp_extract(m["raw"], quarter_pattern, 1) != "", F.regexp_extract(m["raw"], quarter_pattern, 1))
        for i, word in enumerate(("first", "second", "third", "fourth"), 1):
            number = number.when(raw.startswith(word), str(i)) if i == 1 else number.when(raw.startswith(word), str(i))
        year = F.concat(F.regexp_extract(m["raw"], quarter_pattern, 2), F.regexp_extract(m["raw"], quarter_pattern, 3))
        return F.struct(m["start"].alias("start"), F.concat(F.lit("q"), number, F.lit("_"), year).alias("period"))

    return F.array_sort(F.concat(years, F.transform(quarter_matches, quarter)))


def period_mentions(df: DataFrame, text: str = "text") -> DataFrame:
    """One row for each mention of a period: the other columns, start and period."""
    rows = df.withColumn("_p", F.explode(periods(F.col(text))))
    return rows.select(*[c for c in df.columns if c != text], "_p.start", "_p.period")


def _period_at(position: Column) -> Column:
    return F.try_element_at(F.filter("_periods", lambda p: p["start"] <= position), F.lit(-1))["period"]


def _period_after(position: Column, most: int = 45) -> Column:
    first = F.try_element_at(F.filter("_periods", lambda p: p["start"] >= position), F.lit(1))
    return F.when(first["start"] - position <= most, first["period"])


def _around(m: Column, before: int, after: int) -> Column:
    """A match with the text from `before` characters before it to `after` behind it."""
    return F.concat(F.right(m["left"], F.lit(before)), m["raw"], F.left(m["right"], F.lit(after)))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is computed once and not at each place that names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _with_small_letters(text: Column, use: Callable[[Column], Column]) -> Column:
    """use() of a text and its small letters, which are null beyond ASCII, where case is more than small letters."""
    return _bound(text, lambda t: _bound(F.struct(t.alias("text"), F.when(F.length(t) == F.octet_length(t), F.lower(t)).alias("low")), use))


def _may_have(x: Column, words: Sequence[str]) -> Column:
    """Whether a pattern that needs one of the words is worth a pass over the text."""
    return reduce(Column.__or__, [x["low"].contains(w) for w in words], x["low"].isNull())


def forward_looking(m: Column) -> Column:
    """Whether a match's surroundings speak of guidance and not of results."""
    def told(x: Column, patterns: Sequence[str], words: Sequence[str]) -> Column:
        return _may_have(x, words) & _has_any(x["text"], patterns)

    return _with_small_letters(_around(m, 500, 100), lambda x: ~told(x, RESULTS_CONTEXT, RESULTS_WORDS) & told(x, GUIDANCE_CONTEXT, GUIDANCE_WORDS))


def vs_prior(m: Column) -> Column:
    """How guidance changed, by the first pattern in order; a change told of the past is maintained."""
    def change(x: Column) -> Column:
        case = F.lit(None).cast("string")
        for label, pattern in reversed(CHANGES):
            value = F.when(_has(x["text"], HISTORICAL), "maintained").otherwise(label) if label in ("raised", "lowered") else F.lit(label)
            case = F.when(_may_have(x, CHANGE_WORDS[label]) & _has(x["text"], pattern), value).otherwise(case)
        return case

    return _with_small_letters(_around(m, 200, 200), change)


def _distance(x: Column, pattern: str, word: str) -> Column:
    """Characters of a text after the last mention, which needs the word; null without one."""
    return F.when(_may_have(x, [word]), _bound(F.split(x["text"], pattern, -1), lambda gaps: F.when(F.size(gaps) > 1, F.length(F.element_at(gaps, -1)))))


def revenue_metric(m: Column) -> Column:
    """The revenue metric mentioned next before a match; null without one, or if the match goes on to another subject."""
    def nearest(d: Column) -> Column:
        special, plain = d["special"], d["plain"]
        name = F.when((special < 70) | plain.isNull() | (special <= plain), F.when(special.isNotNull(), SPECIAL_METRIC[0])).otherwise(PLAIN_METRIC[0])
        return F.coalesce(name, F.when(plain.isNotNull(), PLAIN_METRIC[0]))

    def named(x: Column) -> Column:
        return _bound(F.struct(_distance(x, SPECIAL_METRIC[1], "exome").alias("special"), _distance(x, PLAIN_METRIC[1], "revenue").alias("plain")), nearest)

    after = F.left(m["right"], F.lit(35))
    return F.when(~_bound(after, lambda t: _has_any(t, METRIC_STOPS)), _with_small_letters(F.right(m["left"], F.lit(150)), named))


ENTRY = "struct<ord:int,category:string,period:string,metric:string,type_value:string,value:double,low:double,high:double,unit:string,qualitative:string,vs_prior:string,raw:string,start:int>"


def _entry(m: Column, ord_: int, category: str, period: Column, metric: Column, kind: str, **more: Column) -> Column:
    null = F.lit(None)
    fields = {"value": null, "low": null, "high": null, "unit": null, "qualitative": null} | more
    return F.struct(
        F.lit(ord_).alias("ord"), F.lit(category).alias("category"), period.alias("period"), metric.alias("metric"), F.lit(kind).alias("type_value"),
        *[fields[n].alias(n) for n in ("value", "low", "high", "unit", "qualitative")], vs_prior(m).alias("vs_prior"), F.trim(m["raw"]).alias("raw"), m["start"].alias("start"),
    ).cast(ENTRY)


def _guided(name: str, make: Callable[[Column], Column]) -> Column:
    return F.transform(F.filter(F.col(f"_found.{name}"), forward_looking), make)


def guidance_patterns(rows: DataFrame | Iterable[tuple]) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Patterns for extract_guidance() from a table (name, pattern, words): words that a match begins with, by commas; null or empty if any text may."""
    found = [tuple(r) for r in (rows.select("name", "pattern", "words").limit(len(GUIDANCE) + 1).collect() if isinstance(rows, DataFrame) else rows)]
    if len({n for n, _, _ in found}) < len(found) or {n for n, _, _ in found} - set(GUIDANCE):
        raise ValueError(f"patterns are {', '.join(GUIDANCE)}, each once at most")
    return {n: (p, tuple(w.strip().lower() for w in (words or "").split(",") if w.strip())) for n, p, words in found}


def extract_guidance(df: DataFrame, text: str = "text", patterns: Mapping[str, tuple[str, Sequence[str]]] | None = None) -> DataFrame:
    """One row for each piece of revenue, per-share, net-income and gross-margin guidance in a document, with its columns but the text.

    A match needs forward-looking surroundings. Its period is the one mentioned right behind it
    (revenue only), else the last one before it, else the one of the document's last revenue
    range. Entries that repeat an earlier one go; a single value goes if its period and metric
    have a range; of per-share and income entries of one period and type the most precise stays.
    Texts under 50 characters have none. All patterns are looked for in one pass, see together();
    `patterns` replaces some of GUIDANCE by name (see guidance_patterns()), with the same groups.
    """
    if unknown := set(patterns or ()) - set(GUIDANCE):
        raise ValueError(f"unknown patterns: {sorted(unknown)}")
    known = {n: (p, tuple(words)) for n, (p, words) in (GUIDANCE | dict(patterns or {})).items()}
    of = {n: p for n, (p, _) in known.items()}
    rows = df.withColumn("_found", _guidance_finder(tuple(known.values()))(F.when(F.length(text) >= 50, F.col(text)).otherwise(F.lit(""))))
    rows = rows.withColumn("_periods", _periods(F.col("_found.fiscal_year"), F.col("_found.quarter"), of["fiscal_year"], of["quarter"]))

    def ranged(m: Column, pattern: str) -> tuple[Column, Column]:
        unit = magnitude(F.regexp_extract(m["raw"], pattern, 3))
        return tuple(parse_num(F.regexp_extract(m["raw"], pattern, i)) * unit / 1e6 for i in (1, 2))

    def revenue_range(m: Column) -> Column:
        low, high = ranged(m, of["revenue_range"])
        period = F.coalesce(_period_after(m["stop"]), _period_at(m["start"]))
        return _entry(m, 0, "revenue", period, revenue_metric(m), "interval", value=(low + high) / 2, low=low, high=high, unit=F.lit("million"))

    rows = rows.withColumn("_ranges", F.filter(_guided("revenue_range", revenue_range), lambda e: e["metric"].isNotNull() & e["value"].isNotNull()))
    rows = rows.withColumn("_last", _period_at(F.try_element_at("_ranges", F.lit(-1))["start"]))

    def at(m: Column) -> Column:
        return F.coalesce(_period_at(m["start"]), F.col("_last"))

    def revenue_single(m: Column) -> Column:
        value = parse_num(F.regexp_extract(m["raw"], of["revenue_single"], 1)) * magnitude(F.regexp_extract(m["raw"], of["revenue_single"], 2)) / 1e6
        return _entry(m, 1, "revenue", F.coalesce(_period_after(m["stop"]), at(m)), revenue_metric(m), "exact", value=value, unit=F.lit("million"))

    def per_share(m: Column, name: str, ord_: int) -> Column:
        pattern = of[name]
        first = parse_num(F.regexp_extract(m["raw"], pattern, 1))
        if name == "eps_single":
            return _entry(m, ord_, "earnings", at(m), F.lit("eps"), "exact", value=first)
        second = parse_num(F.regexp_extract(m["raw"], pattern, 2))
        return _entry(m, ord_, "earnings", at(m), F.lit("eps"), "interval", value=(first + second) / 2, low=first, high=second)

    def kind(m: Column) -> Column:
        return F.when(F.lower(m["raw"]).contains("adjusted"), "adjusted_net_income").otherwise("net_income")

    def income_range(m: Column) -> Column:
        low, high = ranged(m, of["income_range"])
        return _entry(m, 5, "earnings", at(m), kind(m), "interval", value=(low + high) / 2, low=low, high=high, unit=F.lit("million"))

    passes = [
        F.filter(
            _guided("revenue_single", revenue_single),
            lambda e: e["metric"].isNotNull() & ~F.exists("_ranges", lambda r: r["period"].eqNullSafe(e["period"]) & (r["metric"] == e["metric"])),
        ),
        _guided("eps_range", lambda m: per_share(m, "eps_range", 2)),
        _guided("eps_single", lambda m: per_share(m, "eps_single", 3)),
        _guided("income_word", lambda m: _entry(m, 4, "earnings", at(m), kind(m), "qualitative", qualitative=F.lower(F.regexp_extract(m["raw"], of["income_word"], 1)))),
        _guided("income_range", income_range),
    ]

    def margin(m: Column, name: str, ord_: int, kind_: str, metric: str, group: int = 1) -> Column:
        pattern = of[name]
        first = parse_num(F.regexp_extract(m["raw"], pattern, group))
        if kind_ != "interval":
            return _entry(m, ord_, "margins", at(m), F.lit(metric), kind_, value=first, unit=F.lit("percent"))
        second = parse_num(F.regexp_extract(m["raw"], pattern, 2))
        return _entry(m, ord_, "margins", at(m), F.lit(metric), kind_, value=(first + second) / 2, low=first, high=second, unit=F.lit("percent"))

    adjusted, gaap = "adjusted_gross_margin", "gaap_gross_margin"
    passes += [
        _guided("margin_both", lambda m: margin(m, "margin_both", 6, "exact", gaap)),
        _guided("margin_both", lambda m: margin(m, "margin_both", 6, "exact", adjusted, 2)),
        _guided("margin_range", lambda m: margin(m, "margin_range", 7, "interval", adjusted)),
        _guided("margin_single", lambda m: margin(m, "margin_single", 8, "exact", adjusted)),
        _guided("margin_least", lambda m: margin(m, "margin_least", 9, "min", adjusted)),
        _guided("margin_gaap", lambda m: margin(m, "margin_gaap", 10, "exact", gaap)),
    ]
    every = F.filter(F.concat(F.col("_ranges"), *passes), lambda e: e["value"].isNotNull() | e["qualitative"].isNotNull())
    rows = rows.withColumn("_all", every)

    def same(a: Column, b: Column) -> Column:
        out = F.lit(True)
        for n in ("category", "period", "metric", "value", "low", "high", "qualitative"):
            out = out & a[n].eqNullSafe(b[n])
        return out

    def rank(e: Column) -> Column:
        return F.when(e["type_value"] == "interval", 0).when(e["type_value"] == "exact", 1).otherwise(2)

    def beaten(e: Column, i: Column) -> Column:
        """An earlier equal entry, or a better one of the same earnings period and type."""
        earlier = F.slice("_all", F.lit(1), i)
        alike = F.filter("_all", lambda o: (o["category"] == "earnings") & (e["category"] == "earnings") & o["period"].eqNullSafe(e["period"]) & (o["metric"] == e["metric"]))
        return F.exists(earlier, lambda o: same(o, e)) | F.exists(alike, lambda o: rank(o) < rank(e))

    kept = F.filter("_all", lambda e, i: ~beaten(e, i))
    return rows.select(*[c for c in df.columns if c != text], F.explode(kept).alias("_g")).select("*", "_g.*").drop("_g")


HEADER_FIELDS = {
    "accession_number": "ACCESSION NUMBER",
    "form_type": "CONFORMED SUBMISSION TYPE",
    "period": "CONFORMED PERIOD OF REPORT",
    "filed_date": "FILED AS OF DATE",
    "company_name": "COMPANY CONFORMED NAME",
    "cik": "CENTRAL INDEX KEY",
    "sic": "STANDARD INDUSTRIAL CLASSIFICATION",
    "state": "STATE OF INCORPORATION",
    "fiscal_year_end": "FISCAL YEAR END",
}


def legacy_header(df: DataFrame, content: str = "content") -> DataFrame:
    """`df` without the text, with the header's fields; a missing field is null, dates are ISO."""
    from quillstone.functions.dates import legacy_period

    def field(name: str) -> Column:
        return F.nullif(F.trim(F.regexp_extract(content, rf"(?m)^\s*{name}:[ \t]*(.*)$", 1)), F.lit(""))

    out = [legacy_period(field(n)).alias(a) if a in ("period", "filed_date") else field(n).alias(a) for a, n in HEADER_FIELDS.items()]
    return df.select(*[c for c in df.columns if c != content and c not in HEADER_FIELDS], *out)


def extract_links(df: DataFrame, html: str = "html", suffix: str = "csv") -> DataFrame:
    """`df` without the page, with the first link of a kind, its ampersands decoded; null without one."""
    link = F.regexp_extract(html, rf"(?i)href=[\"']([^\"']*\.{suffix}[^\"']*)[\"']", 1)
    return df.select(*[c for c in df.columns if c != html], F.nullif(F.replace(link, F.lit("&amp;"), F.lit("&")), F.lit("")).alias("link"))


#: Patterns of the scraper's logs by kind of line, each with the names of its groups.
LOG_LINES = {
    "small_cap": (r"^(\S+)\s+ticker=(\S+)\s+exchange=([^:]+):\s*mkt_cap=(\S+)\s+\((\d+)/\d+\s+failed\)$", ("accession", "ticker", "exchange", "mkt_cap", "failed")),
    "main_cap": (r"^(\S+)\s+ticker=(\S+)\s+exchange=(.+?)\s+mkt_cap=([^:]+):\s*(\d+)/\d+\s+failed$", ("accession", "ticker", "exchange", "mkt_cap", "failed")),
    "main": (r"^(\S+)\s+ticker=(\S+)\s+exchange=([^:]+):\s*(\d+)/\d+\s+failed$", ("accession", "ticker", "exchange", "failed")),
    "error": (r"^(\S+)\s+\[([^\]]+)\]:\s*(.*)$", ("accession", "stage", "message")),
    "warning": (r"^(\S+):\s+(.+)$", ("accession", "message")),
}
SMALL_CAP_HEADER = "--- Check failures with market cap < $1B ---"


def parse_integrity_logs(lines: DataFrame) -> DataFrame:
    """(file, line_no, kind, accession, ticker, exchange, mkt_cap_mln, failed, small_cap, stage, message) of the scraper's log lines.

    `lines` has file, line_no and line. Files are told apart by check_failures, check_warnings or
    scrape_errors in their names. Failures after the section header are small caps. N/A is null;
    other lines go.
    """
    so_far = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.select("file", "line_no", F.regexp_replace("line", r"\s+$", "").alias("_l")).withColumn("_s", F.coalesce(F.max(F.col("_l").contains(SMALL_CAP_HEADER)).over(so_far), F.lit(False)))

    def fits(kind: str) -> Column:
        return F.col("_l").rlike(LOG_LINES[kind][0])

    failures = F.when(F.col("_s"), F.when(fits("small_cap"), "small_cap")).when(fits("main_cap"), "main_cap").when(fits("main"), "main")
    kind = F.when(F.col("file").contains("check_failures"), failures).when(F.col("file").contains("check_warnings") & fits("warning"), "warning").when(F.col("file").contains("scrape_errors") & fits("error"), "error")
    rows = rows.withColumn("_k", kind).where("_k is not null")

    def field(name: str) -> Column:
        options = [F.when(F.col("_k") == k, F.trim(F.regexp_extract("_l", p, names.index(name) + 1))) for k, (p, names) in LOG_LINES.items() if name in names]
        return F.nullif(F.coalesce(*options), F.lit("N/A"))

    cap, pattern = F.replace(field("mkt_cap"), F.lit(","), F.lit("")), r"(?i)^\$?([\d.]+)\s*([KMB])?$"
    unit = F.upper(F.regexp_extract(cap, pattern, 2))
    millions = F.regexp_extract(cap, pattern, 1).try_cast("double") * F.when(unit == "K", 0.001).when(unit == "B", 1000.0).otherwise(1.0)
    return rows.select(
        "file", "line_no", F.when(F.col("_k") == "main_cap", "main").otherwise(F.col("_k")).alias("kind"), field("accession").alias("accession"), field("ticker").alias("ticker"), field("exchange").alias("exchange"),
        millions.alias("mkt_cap_mln"), field("failed").cast("int").alias("failed"), (F.col("_k") == "small_cap").alias("small_cap"), field("stage").alias("stage"), field("message").alias("message"),
    )
