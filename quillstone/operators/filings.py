"""Filing views: shares, adjusted facts, listings, names, statements and link tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import ids
from quillstone.functions.dates import document_period_end, period_key
from quillstone.operators.aggregate import choose_period, is_empty_statement, pivot_facts, rank_periods
from quillstone.operators.joins import exchange_for_accessions, inline_contexts, per_filing, with_units
from quillstone.operators.select import is_bad_value, is_currency_unit, is_share_unit, no_symbol_filers, not_text_block

# Share concepts, in order of preference.
OUTSTANDING = (
    "dei:EntityCommonStockSharesOutstanding",
    "us-gaap:CommonStockSharesOutstanding",
    "us-gaap:CommonStockSharesIssued",
    "us-gaap:LimitedPartnersCapitalAccountUnitsOutstanding",
    "us-gaap:PartnershipUnitsOutstanding",
)
BUYBACKS = ("us-gaap:StockRepurchasedDuringPeriodShares", "us-gaap:TreasuryStockSharesAcquired")
DILUTION = (
    "us-gaap:StockIssuedDuringPeriodSharesNewIssues",
    "us-gaap:StockIssuedDuringPeriodShares",
    "us-gaap:StockIssuedDuringPeriodSharesShareBasedCompensation",
    "us-gaap:StockIssuedDuringPeriodSharesAcquisitions",
)
NO_START = "0001-01-01"

# Where a filing's text names its ticker and its exchange.
TICKER_TAG = r"(?is)name=[\"']dei:TradingSymbol[\"'][^>]*>\s*([A-Za-z0-9]{2,5})\s*<"
EXCHANGE_TAG = r"(?is)name=[\"']dei:SecurityExchangeName[\"'][^>]*>\s*([^<]+?)\s*<"
ELEMENT = r"<(\w+):{name}[^>]*>([^<]+)</\1:{name}>"
TICKER_FILE = r"(?i)<FILENAME>([a-z]{2,5})-\d{8}"
TICKER_TITLE = r"<title>([a-zA-Z]+)-\d{8}</title>"
TICKER_DESCRIPTION = r"<DESCRIPTION>\s*([A-Z]{2,5})\s+\d{4}"


def share_aggregate(facts: DataFrame, periods: DataFrame) -> DataFrame:
    """(accession, shares_outstanding, buybacks_shares, dilution_shares) at each filing's period; one aggregation.

    `facts` has concept, value, unitRef, numerator, period_instant, period_start, period_end and
    ord; `periods` has accession and period. Outstanding shares go by the order of concepts,
    buybacks by the latest start, and dilution is the sum at the latest start; half-even rounding.
    """
    end = period_key(F.col("period_instant"), F.col("period_end"))
    rows = facts.where(is_share_unit(F.col("unitRef"), F.col("numerator")) & ~is_bad_value(F.col("value"))).join(per_filing(periods), "accession").where(F.substring(end, 1, 10) == F.substring("period", 1, 10))
    v = F.trim("value").try_cast("double")
    start = F.coalesce(F.substring("period_start", 1, 10), F.lit(NO_START))
    place = F.array_position(F.array(*map(F.lit, OUTSTANDING)), F.col("concept"))
    instant = F.col("period_instant").isNotNull() | F.col("period_start").isNull()
    bought, issued = F.col("concept").isin(*BUYBACKS), F.col("concept").isin(*DILUTION)
    by_start = F.struct(start.alias("s"), (-F.col("ord")).alias("o"))
    one = rows.groupBy("accession").agg(
        F.min_by(F.when((place > 0) & instant, v), F.when((place > 0) & instant, F.struct(place.alias("p"), F.col("ord").alias("o")))).alias("out"),
        F.max_by(F.when(bought, v), F.when(bought, by_start)).alias("buy"),
        F.collect_list(F.when(issued, F.struct(start.alias("s"), v.alias("v")))).alias("iss"),
    )
    last = F.array_max(F.transform("iss", lambda x: x["s"]))
    diluted = F.when(F.size("iss") > 0, F.aggregate(F.filter("iss", lambda x: x["s"] == last), F.lit(0.0), lambda s, x: s + x["v"]))
    return one.select("accession", *[F.bround(c).cast("bigint").alias(n) for c, n in ((F.col("out"), "shares_outstanding"), (F.col("buy"), "buybacks_shares"), (diluted, "dilution_shares"))])


def assign_statement(facts: DataFrame, presentation: DataFrame) -> DataFrame:
    """Facts with the statement that the presentation names for their concept, else one that its name suggests."""
    local = F.lower(F.element_at(F.split("concept", ":"), -1))
    guess = (
        F.when(local.rlike("cashprovided|cashequivalents.*periodincrease|paymentsto|paymentsfor|proceedsfrom"), "cash_flow")
        .when(local.rlike("revenue|expense|incomeloss|netincome|grossprofit|earningspershare|costof"), "income_statement")
        .when(local.rlike("assets|liabilit|equity|payable|receivable|inventory"), "balance_sheet")
        .otherwise("other")
    )
    named = presentation.groupBy("accession", "concept").agg(F.min("statement").alias("_statement"))
    return facts.join(named, ["accession", "concept"], "left").withColumn("statement", F.coalesce("_statement", guess)).drop("_statement")


def registrant_name(facts: DataFrame) -> DataFrame:
    """(accession, name): the first registrant name of each filing."""
    return facts.where("concept = 'dei:EntityRegistrantName' and value is not null").groupBy("accession").agg(F.min_by(F.trim("value"), "ord").alias("name"))


def adjust_filings(facts: DataFrame, contexts: DataFrame, units: DataFrame) -> DataFrame:
    """(accession, period, section, concept, value, ord) of each filing's own period: contexts inlined, currency amounts only, last values winning.

    The period is the candidate nearest to the document's end whose statement is not empty.
    """
    rows = with_units(inline_contexts(facts.where(not_text_block(F.col("concept"))), contexts), units)
    numeric = rows.where(~is_bad_value(F.col("value")) & is_currency_unit(F.col("numerator"), F.col("denominator"), F.col("unitRef")))
    numeric = numeric.withColumn("period", F.substring(period_key(F.col("period_instant"), F.col("period_end")), 1, 10)).withColumn("value", F.trim("value").try_cast("double")).where("period is not null")
    ranked = rank_periods(numeric, document_period_end(facts.select("accession", "concept", "value", "ord")))
    chosen = choose_period(ranked, is_empty_statement(numeric))
    mine = numeric.join(per_filing(chosen), ["accession", "period"])
    labelled = mine.select("accession", "period", "section", "concept", ids.dimension_key(F.col("dimensions")).alias("dims"), ids.fact_label(F.col("concept"), F.col("dimensions")).alias("label"), "value", "ord")
    return pivot_facts(labelled, ("accession", "period", "section")).select("accession", "period", "section", F.col("label").alias("concept"), "value", "ord")


def resolve_listing(filings: DataFrame, facts: DataFrame, index: DataFrame, companies: DataFrame) -> DataFrame:
    """(accession, ticker, exchange): of the filing's facts, else of tags in its text, else of its file name, title or description, else of the index; NONE without any.

    A filing that says it has no trading symbol has the ticker NONE.
    """
    def fact(concept: str) -> Column:
        mine = F.col("concept") == concept
        return F.min_by(F.when(mine, F.trim("value")), F.when(mine, F.col("ord")))

    told = facts.where(F.col("concept").isin("dei:TradingSymbol", "dei:SecurityExchangeName")).groupBy("accession").agg(fact("dei:TradingSymbol").alias("_t"), fact("dei:SecurityExchangeName").alias("_e"))
    silent = no_symbol_filers(facts).withColumn("_none", F.lit(True))
    known = exchange_for_accessions(index, companies, filings).withColumnRenamed("exchange", "_x")
    rows = filings.join(told, "accession", "left").join(silent, "accession", "left").join(known, "accession", "left")

    def found(pattern: str, group: int = 1) -> Column:
        return F.nullif(F.trim(F.regexp_extract("content", pattern, group)), F.lit(""))

    def element(name: str) -> Column:
        value = found(ELEMENT.replace("{name}", name), 2)
        return F.when(~value.contains("(ix"), value)

    options = [F.when(ids.is_ticker(c), F.upper(c)) for c in (F.col("_t"), element("TradingSymbol"), *map(found, (TICKER_TAG, TICKER_FILE, TICKER_TITLE, TICKER_DESCRIPTION)))]
    ticker = F.when(F.col("_none"), "NONE").otherwise(F.coalesce(*options, F.lit("NONE")))
    return rows.select("accession", ticker.alias("ticker"), F.coalesce("_e", element("SecurityExchangeName"), found(EXCHANGE_TAG), "_x", F.lit("NONE")).alias("exchange"))


def link_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """Calculation, label, reference and definition links, each row once, from arrays of structs of those names."""
    return {n: raw.select("accession", F.explode(n).alias("l")).select("accession", "l.*").dropDuplicates() for n in ("calculations", "labels", "references", "definitions") if n in raw.columns}
