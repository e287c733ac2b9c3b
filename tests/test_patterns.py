"""The guidance patterns in one pass against one pass for each."""

from __future__ import annotations

import random
import re
import time

import pytest

from quillstone.operators import filing_text

PIECES = (
    "full year", "FY", "Fiscal  year", "2024", "q3", "Q4 2025", "fourthird quarter 2024", "First Quarter 2026", "$", "$1,200.5", "10", "to", "-", "million", "b", "EPS", "eps of $1.20 to $1.30",
    "incomearnings", "incomeps $2", "earnings per share: $2.1", "Adjusted net income of $10 - $12 million", "net", "income positive", "adjusted gross margin of 50% to 52%", "GAAP and adjusted gross margin of approximately 40% and 41.5%",
    "GAAP gross margin 39%", "adjusted gross margin at least 7%", "adjusted", "gaap", "internet income", "\n", " ", ", ", ".", "x", "é", "ſ", "K", "earningſ per share $3", "full",
)


def test_one_pass_finds_what_each_pattern_finds():
    scan, patterns = filing_text.together(list(filing_text.GUIDANCE.values())), [filing_text._compiled(p) for p, _ in filing_text.GUIDANCE.values()]
    r, n = random.Random(2), 0
    for _ in range(6000):
        text = "".join(r.choice(PIECES) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 14)))
        want = [[m.span() for m in p.finditer(text)] for p in patterns]
        assert [[m.span() for m in found] for found in scan(text)] == want, text
        n += sum(map(len, want))
    assert n > 5000


def test_a_pattern_without_words_and_words_that_clash():
    assert [m.group() for m in filing_text.together([(r"\d+", ())])("a1 b22")[0]] == ["1", "22"]
    with pytest.raises(ValueError):
        filing_text.together([("net", ("net",)), ("nets", ("nets",))])


def test_one_pass_takes_less_time_than_thirteen():
    text = "The company has seen demand for its products grow in most regions over the last months of the year. " * 3000
    scan, patterns = filing_text.together(list(filing_text.GUIDANCE.values())), [re.compile(filing_text._compiled(p).pattern) for p, _ in filing_text.GUIDANCE.values()]
    begin = time.perf_counter()
    scan(text)
    once = time.perf_counter() - begin
    begin = time.perf_counter()
    for p in patterns:
        list(p.finditer(text))
    assert once * 2 < time.perf_counter() - begin


def test_patterns_are_inputs(spark):
    text = "The company expects revenue to grow. For fiscal year 2025 guidance of net earnings per unit of EUR 3 is expected to hold; outlook for 2025."
    df = spark.createDataFrame([(1, text), (2, None)], "doc int, text string")
    assert filing_text.extract_guidance(df).count() == 0
    rows = spark.createDataFrame([("eps_single", r"(?i)earnings\s+per\s+unit\s+of\s+EUR\s+([\d.]+)", "earnings")], "name string, pattern string, words string")
    got = filing_text.extract_guidance(df, patterns=filing_text.guidance_patterns(rows)).first()
    assert (got.period, got.metric, got.value) == ("FY2025", "eps", 3.0)
    free = filing_text.guidance_patterns([("eps_single", r"(?i)per\s+unit\s+of\s+EUR\s+([\d.]+)", None)])
    assert filing_text.extract_guidance(df, patterns=free).first().value == 3.0
    with pytest.raises(ValueError):
        filing_text.guidance_patterns([("no_such", "x", None)])
