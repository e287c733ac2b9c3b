"""Schemas and keys of the product tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Table(NamedTuple):
    """A table's columns as DDL, and its key."""

    ddl: str
    key: tuple[str, ...]

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


SERIES = "series_id string, title string, units string, frequency string, seasonal_adjustment string, observation_start string, observation_end string, last_updated string, popularity int, notes string, country string, category_id long, category_name string, created_at timestamp, updated_at timestamp"
CUBE = "date date, value double, dimensions map<string,string>, dimension_key string, updated_at timestamp"

TABLES = {
    "companies": Table("cik string, name string, ticker string, exchange string, sic string, created_at timestamp, updated_at timestamp", ("cik",)),
    "company_history": Table("cik string, name string, exchange string, snapshot_at timestamp", ()),
    "filing_index": Table("cik string, company_name string, form_type string, date_filed date, filename string, accession string, year int, quarter string", ("year", "quarter", "cik", "form_type", "date_filed", "filename")),
    "download_ledger": Table("year int, quarter string, status string, downloaded_at timestamp, failed_at timestamp, error_message string, retry_count int, last_attempt timestamp", ("year", "quarter")),
    "filing_facts": Table("accession string, period_date date, section string, concept string, value double, value_text string, ticker string", ("accession", "period_date", "section", "concept")),
    "integrity_checks": Table("accession string, ticker string, exchange string, n_failures long, n_errors long, n_warnings long", ("accession",)),
    "series": Table(SERIES, ("series_id",)),
    "categories": Table("category_id long, name string, parent_id long", ("category_id",)),
    "time_series": Table("series_id string, date date, value double, updated_at timestamp", ("series_id", "date")),
    "bls_time_series": Table("series_id string, date date, year int, period string, value double, footnotes string", ("series_id", "date", "period")),
    "sync_status": Table("survey string, status string, error string, rows long, updated_at timestamp", ("survey",)),
    "datasets": Table("code string, title string, description string, version string, keywords string, updated_at timestamp", ("code",)),
    "cube": Table(f"code string, {CUBE}", ("code", "date", "dimension_key")),
    "indicators": Table("database_id string, indicator_code string, indicator_name string, description string", ("database_id", "indicator_code")),
    "metadata": Table("key string, value string, updated_at timestamp", ("key",)),
    "etfs": Table("ticker string, name string, link string, updated_at timestamp", ("ticker",)),
    "holdings": Table("etf_ticker string, ticker string, name string, sector string, asset_class string, market_value decimal(38,18), weight decimal(8,4), location string, updated_at timestamp", ()),
    "nasdaq_listed": Table("symbol string, security_name string, market_category string, test_issue string, financial_status string, round_lot_size int, etf string, nextshares string", ("symbol",)),
    "other_listed": Table("act_symbol string, security_name string, exchange string, cqs_symbol string, etf string, round_lot_size int, test_issue string, nasdaq_symbol string", ("act_symbol", "exchange")),
    "ohlcv": Table("symbol string, date date, open double, high double, low double, close double, volume long, dividends double, stock_splits double, source string", ("symbol", "date", "source")),
    "candles": Table("t long, T_end long, s string, i string, o double, c double, h double, l double, v double, n long", ("s", "i", "t")),
    "trades": Table("coin string, side string, px double, sz double, time long, tid long", ("coin", "tid")),
}

#: Documents that come one for each symbol.
DOCUMENT_SCHEMAS = {
    "equity_info": "map<string,string>",
    "analyst_recommendations": "array<struct<period:string,strongBuy:int,buy:int,hold:int,sell:int,strongSell:int>>",
    "eps_revisions": "array<struct<period:string,upLast7days:int,upLast30days:int,downLast30days:int,downLast7Days:int>>",
    "revenue_estimates": "array<struct<period:string,avg:double,low:double,high:double,numberOfAnalysts:int,yearAgoRevenue:double,growth:double>>",
    "earnings_calendar": "array<struct<date:string,epsEstimate:double,reportedEps:double,surprisePct:double>>",
    "earnings_history": "array<struct<quarter:string,epsActual:double,epsEstimate:double,epsDifference:double,surprisePercent:double>>",
    "sec_filings": "array<struct<date:string,type:string,title:string,edgarUrl:string>>",
    "calendar": "map<string,string>",
    "analyst_price_targets": "struct<current:double,low:double,high:double,mean:double,median:double>",
    "financial_statements": "array<map<string,string>>",
}
