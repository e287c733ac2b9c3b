"""Selections over catalogs, indexes and series."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILING_FILTERS = ("year", "quarter", "form_type", "cik", "filename", "date_filed", "company_name")
SERIES_COLUMNS = ("series_id", "id", "series")


def select_filings(df: DataFrame, limit: int | None = None, **filters: object) -> DataFrame:
    """Distinct file names of the index rows that all filters fit, in order.

    Company numbers compare as numbers, company names by containment in any case, all else by
    equality. Filters that are None are skipped; no filter, or an unknown one, is an error.
    """
    if unknown := set(filters) - set(FILING_FILTERS):
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    given = {k: v for k, v in filters.items() if v is not None}
    if not given:
        raise ValueError("at least one filter is needed")
    rows = df
    for name, value in given.items():
        if name == "cik":
            rows = rows.where(F.col("cik").try_cast("bigint") == int(str(value)))
        elif name == "company_name":
            rows = rows.where(F.lower("company_name").contains(str(value).lower()))
        elif name == "date_filed":
            rows = rows.where(F.col("date_filed") == F.lit(value).cast(df.schema["date_filed"].dataType))
        else:
            rows = rows.where(F.col(name) == value)
    names = rows.select("filename").distinct().orderBy("filename")
    return names.limit(limit) if limit is not None else names


def select_filings_sql(spark: SparkSession, sql: str) -> DataFrame:
    """File names of a query over the registered views.

    A query of all columns gives distinct names in order. Any other is run as it is written: its
    own order stays, and without one the names are in order.
    """
    query = sql.rstrip().rstrip(";")
    if re.match(r"(?is)\s*select\s+\*\s", query):
        return spark.sql(query).select("filename").distinct().orderBy("filename")
    names = spark.sql(query).select("filename")
    return names if re.search(r"(?is)\border\s+by\b", query) else names.orderBy("filename")


def series_from_sql(spark: SparkSession, sql: str) -> DataFrame:
    """series_id of a query's rows: its first known column, else its first."""
    rows = spark.sql(sql.rstrip().rstrip(";"))
    known = {c.lower(): c for c in reversed(rows.columns)}
    column = next((known[c] for c in SERIES_COLUMNS if c in known), rows.columns[0])
    return rows.select(F.col(column).cast("string").alias("series_id"))


def read_series(df: DataFrame, key: object = None, start: str | None = None, end: str | None = None, key_col: str = "series_id", date_col: str = "date") -> DataFrame:
    """Rows of a key between two days, both included, by key and date; every bound may be left out."""
    if key is not None:
        df = df.where(F.col(key_col) == key)
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(start).cast(df.schema[date_col].dataType))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(end).cast(df.schema[date_col].dataType))
    return df.orderBy(key_col, date_col)


def read_cube(df: DataFrame, key: object = None, start: str | None = None, end: str | None = None, dims: Mapping[str, str] | None = None, **cols: str) -> DataFrame:
    """read_series() over rows whose map of dimensions holds every given pair."""
    for k, v in (dims or {}).items():
        df = df.where(F.try_element_at("dimensions", F.lit(k)) == v)
    return read_series(df, key, start, end, **cols)


def read_catalog(df: DataFrame, category_ids: Sequence[int] | None = None) -> DataFrame:
    """Catalog rows, of some categories if given, with timestamps as ISO text."""
    if category_ids is not None:
        df = df.where(F.col("category_id").isin(*category_ids) if category_ids else F.lit(False))
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    return df.select(*[F.date_format(c, iso).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes])


def etf_symbols(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct symbols flagged Y as funds, in order."""
    return symbols(df.where(F.upper(F.trim(F.coalesce("etf", F.lit("")))) == "Y"), limit)


def symbols(df: DataFrame, limit: int | None = None, column: str = "symbol") -> DataFrame:
    """Distinct symbols in order."""
    rows = df.select(column).distinct().orderBy(column)
    return rows.limit(limit) if limit is not None else rows


def drop_dollar_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    return df.where(~F.col(column).contains("$"))


def drop_mock(df: DataFrame, column: str = "name") -> DataFrame:
    return df.where(~F.upper(column).endswith("MOCK"))


def search_any(df: DataFrame, term: str) -> DataFrame:
    """Rows with a column whose text holds the term, in any case."""
    hits = [F.coalesce(F.lower(F.col(f"`{c}`").cast("string")).contains(term.lower()), F.lit(False)) for c in df.columns]
    return df.where(reduce(Column.__or__, hits, F.lit(False)))


def clean_holdings(df: DataFrame) -> DataFrame:
    """Holdings without repeated header rows and rows without a sector; dashes become empty."""
    dashes = [F.when(F.trim(c).isin("-", "--"), "").otherwise(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]
    sector = F.lower(F.trim(F.coalesce("sector", F.lit(""))))
    return df.where(~sector.isin("", "nan", "sector") & (F.coalesce(F.trim("name"), F.lit("")) != "Name")).select(*dashes)


def apply_schema(df: DataFrame, fields: Mapping[str, str], properties: str = "properties") -> DataFrame:
    """The declared fields of a map column with their types; missing and malformed ones are null."""
    from quillstone.functions.numbers import cast_by_type

    rest = [c for c in df.columns if c != properties and c not in fields]
    return df.select(*rest, *[cast_by_type(F.try_element_at(properties, F.lit(f)), t).alias(f) for f, t in fields.items()])


def sanitised(name: str) -> str:
    """A header as a column name: lower case, runs of other characters than letters and digits as one underscore."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower().replace("%", " pct ")).strip("_")


def canonical_columns(df: DataFrame, schema: Sequence[str], aliases: Mapping[str, str] | None = None, ticker: Column | None = None) -> DataFrame:
    """The schema's columns in order: headers are sanitised and aliased, missing ones are null, unknown ones go.

    Of headers with one canonical name the first is taken; etf_ticker falls back to `ticker`.
    """
    found: dict[str, str] = {}
    for c in df.columns:
        name = sanitised(c)
        found.setdefault((aliases or {}).get(name, name), c)
    out = []
    for c in schema:
        value = F.col(f"`{found[c]}`") if c in found else F.lit(None).cast("string")
        out.append((F.coalesce(value, ticker) if c == "etf_ticker" and ticker is not None else value).alias(c))
    return df.select(*out)


def default_required(df: DataFrame, stamp: str | None = None) -> DataFrame:
    """Missing tickers become _missing_<row>, missing names empty, missing times the run's time."""
    now = F.lit(stamp).cast("timestamp") if stamp else F.current_timestamp()
    out = []
    for c, t in df.dtypes:
        if c == "ticker":
            value = F.coalesce(F.nullif(F.trim(c), F.lit("")), F.concat(F.lit("_missing_"), F.monotonically_increasing_id().cast("string")))
        elif c == "name":
            value = F.coalesce(F.col(c), F.lit(""))
        else:
            value = F.coalesce(F.col(c), now) if c.endswith("_at") and t == "timestamp" else F.col(c)
        out.append(value.alias(c))
    return df.select(*out)


def stale_keys(requested: DataFrame, catalog: DataFrame, key: str, today: str | Column, stamp: str = "updated_at") -> DataFrame:
    """Requested keys that were not updated today, unknown ones included."""
    done = catalog.where(F.to_date(stamp) >= F.lit(today).cast("date")).select(key)
    return requested.select(key).distinct().join(done, key, "left_anti")


def is_bad_value(c: Column) -> Column:
    """Blank, an error text of the source, or no number."""
    return c.isNull() | (F.trim(c) == "") | c.rlike(r"(?i)^\(ix.*error.*\)$") | F.trim(c).try_cast("double").isNull()


def is_currency_unit(numerator: Column, denominator: Column, unit_ref: Column) -> Column:
    """One numerator of a currency and no denominator; without a definition the unit id usd."""
    defined = (F.size(numerator) == 1) & F.element_at(numerator, 1).contains("iso4217:") & (F.coalesce(F.size(denominator), F.lit(0)) < 1)
    return F.when(numerator.isNull(), F.lower(unit_ref) == "usd").otherwise(defined)


def is_share_unit(unit_ref: Column, numerator: Column) -> Column:
    """A unit id or definition that names shares or units."""
    pattern = "share|unit"
    return F.coalesce(F.lower(unit_ref).rlike(pattern), F.lit(False)) | F.coalesce(F.lower(F.array_join(numerator, " ")).rlike(pattern), F.lit(False))


def not_text_block(concept: Column) -> Column:
    return ~F.element_at(F.split(concept, ":"), -1).contains("TextBlock")


def no_symbol_filers(facts: DataFrame) -> DataFrame:
    """Accessions that flag having no trading symbol."""
    flag = F.col("concept").isin("dei:NoTradingSymbolFlag", "NoTradingSymbolFlag") & F.lower(F.trim("value")).isin("true", "1")
    return facts.where(flag).select("accession").distinct()


def status_of(ledger: DataFrame, keys: DataFrame, key: str = "survey") -> DataFrame:
    """Status rows of the requested keys, which are trimmed and upper-cased; blank ones go, unknown ones are null."""
    wanted = keys.select(F.upper(F.trim(key)).alias(key)).where(F.col(key) != "").distinct()
    return wanted.join(ledger, key, "left")


def series_in_roots(series: DataFrame, roots: Sequence[int]) -> DataFrame:
    """Catalog rows of the chosen categories."""
    chosen = series.sparkSession.createDataFrame([(r,) for r in sorted(set(roots))], "category_id long")
    return series.join(F.broadcast(chosen), "category_id", "left_semi")


def split_small_cap(failures: DataFrame, caps: DataFrame, threshold: float = 1e9) -> tuple[DataFrame, DataFrame]:
    """Failures of large or unknown companies, and those of companies under the threshold, each by market value."""
    rows = failures.join(caps, "ticker", "left")
    small = F.coalesce(F.col("market_cap") < threshold, F.lit(False))
    order = [F.desc_nulls_last("market_cap"), F.asc("accession")]
    return rows.where(~small).orderBy(*order), rows.where(small).orderBy(*order)


def exclude_etfs(filings: DataFrame, quotes: DataFrame) -> DataFrame:
    """Filings of companies whose instrument is not a fund."""
    return filings.join(quotes.where(F.upper("quote_type") == "ETF").select("ticker"), "ticker", "left_anti")
