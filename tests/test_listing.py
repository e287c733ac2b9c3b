"""Ticker and exchange from each place of a filing's text."""

from __future__ import annotations

import pytest

from quillstone.operators import filings

SYMBOL = '<dei:TradingSymbol contextRef="c1">ABC</dei:TradingSymbol>'
PLACE = '<dei:SecurityExchangeName contextRef="c1">NYSE</dei:SecurityExchangeName>'
FILE, TITLE, DESCRIPTION = "<FILENAME>fil-20250930.htm", "<title>tit-20250930</title>", "<DESCRIPTION>DSC 2025 report"


@pytest.mark.parametrize(
    ("content", "want"),
    [
        (SYMBOL, ("ABC", "NONE")),
        (PLACE, ("NONE", "NYSE")),
        (FILE, ("FIL", "NONE")),
        (TITLE, ("TIT", "NONE")),
        (DESCRIPTION, ("DSC", "NONE")),
        (DESCRIPTION + TITLE + FILE + SYMBOL + PLACE, ("ABC", "NYSE")),
        (DESCRIPTION + TITLE + FILE, ("FIL", "NONE")),
        (DESCRIPTION + TITLE, ("TIT", "NONE")),
        ("<dei:TradingSymbol>(ix error)</dei:TradingSymbol>" + DESCRIPTION, ("DSC", "NONE")),
    ],
)
def test_listing_is_found_in_each_place(spark, content, want):
    docs = spark.createDataFrame([("a", content)], "accession string, content string")
    schemas = ("accession string, concept string, value string, ord int", "accession string, cik string", "cik string, exchange string")
    out = filings.resolve_listing(docs, *(spark.createDataFrame([], s) for s in schemas)).first()
    assert (out.ticker, out.exchange) == want
