"""The scraper's logs, a line of each form."""

from __future__ import annotations

from quillstone.operators import filing_text


def test_each_form_of_log_line(spark):
    failures = [
        "a1 ticker=ABC exchange=New York: 3/14 failed",
        "a2 ticker=N/A exchange=N/A mkt_cap=$1.5B: 1/14 failed  ",
        "a3 ticker=X exchange=Y: mkt_cap=$17.1M (2/14 failed)",
        "--- Check failures with market cap < $1B ---",
        "a4 ticker=SML exchange=Nasdaq: mkt_cap=$17.5M (2/14 failed)",
        "a5 ticker=TNY exchange=Nasdaq: mkt_cap=N/A (12/14 failed)",
        "a6 ticker=ABC exchange=NYSE: 3/14 failed",
        "noise",
    ]
    rows = [("logs/check_failures.log", i, x) for i, x in enumerate(failures)]
    rows += [("logs/check_warnings.log", 1, "a7: dei:NoTradingSymbolFlag (no ticker)"), ("logs/scrape_errors.log", 1, "a8 [parse]: bad: file"), ("logs/other.log", 1, "a9: text")]
    out = filing_text.parse_integrity_logs(spark.createDataFrame(rows, "file string, line_no int, line string").repartition(4))
    assert {tuple(r)[2:] for r in out.collect()} == {
        ("main", "a1", "ABC", "New York", None, 3, False, None, None),
        ("main", "a2", None, None, 1500.0, 1, False, None, None),
        ("small_cap", "a4", "SML", "Nasdaq", 17.5, 2, True, None, None),
        ("small_cap", "a5", "TNY", "Nasdaq", None, 12, True, None, None),
        ("warning", "a7", None, None, None, None, False, None, "dei:NoTradingSymbolFlag (no ticker)"),
        ("error", "a8", None, None, None, None, False, "parse", "bad: file"),
    }
