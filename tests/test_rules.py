"""Rules as rows, and the slots that they are compiled to."""

from __future__ import annotations

import pytest

from quillstone.operators import checks, rulesets
from quillstone.operators import rules as R

FACTS = "accession string, section string, concept string, value double, ord int"
BS, INC = "balance_sheet", "income_stmt"


def frame(spark, facts, accession="f"):
    return spark.createDataFrame([(accession, s, c, float(v), i) for i, (s, c, v) in enumerate(facts)], FACTS)


def test_a_check_is_added_by_rows(spark):
    facts = [(BS, "x:Cash", 10), (INC, "x:Stock", 7), (BS, "us-gaap:Assets", 30), (BS, "x:OtherDebtItem", 9), (BS, "x:MoreDebt", 4), (BS, "x:Debt [A]", 99), (BS, "x:DebtCurrent", 50)]
    rows = [
        ("liquid assets", "left", 0, "first", 1, BS, "us-gaap:Assets", 0, False),
        ("liquid assets", "right", 0, "first", 1, "balance_sheet, income_stmt", "x:Gone", 0, False),
        ("liquid assets", "right", 0, "first", 1, "balance_sheet, income_stmt", "x:Cash", 1, False),
        ("liquid assets", "right", 1, "first", 1, f"{BS},{INC}", "x:Stock", 0, False),
        ("liquid assets", "right", 2, "sum", 1, BS, "Debt", 0, False),
        ("liquid assets", "right", 2, "sum", 1, BS, "!Current", 1, False),
        ("liquid assets", "right", 3, "first", -1, BS, "x:Nothing", 0, True),
    ]
    added = rulesets.rule_set(checks=spark.createDataFrame(rows, rulesets.CHECK_ROWS))
    got = checks.run_checks(frame(spark, facts), ["liquid assets"], added).first()
    assert (got.status, got.passed, got.difference) == ("checked", True, 0.0)
    every = checks.run_checks(frame(spark, facts), rules=added)
    assert [r.check_name for r in every.collect()] == [*checks.CHECKS, "liquid assets"]
    alone = checks.run_checks(frame(spark, facts[:3]), ["liquid assets"], added).first()
    assert (alone.status, alone.passed) == ("skipped", True)  # no debt is found, which is not optional


def test_a_tolerance_and_a_list_are_changed_by_rows(spark):
    facts = [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:Liabilities", 60), (BS, R.EQUITY[0], 33), (INC, "x:Sales", 90), ("other", R.COST[0], 40), (INC, "us-gaap:GrossProfit", 50)]
    df, names = frame(spark, facts), ["balance sheet identity", "gross profit"]
    status = lambda rules: [(r.status, r.passed) for r in checks.run_checks(df, names, rules).collect()]
    assert status(None) == [("checked", False), ("skipped", True)]
    lists = spark.createDataFrame([("TOLERANCE_PCT:balance sheet identity", 0, "7.5"), ("REVENUE", 1, "us-gaap:Revenues"), ("REVENUE", 0, "x:Sales")], rulesets.LIST_ROWS)
    assert status(rulesets.rule_set(lists)) == [("checked", True), ("checked", True)]
    assert status(rulesets.rule_set([("TOLERANCE_PCT", 0, "8")])) == [("checked", True), ("skipped", True)]


def test_the_shipped_rules_as_rows_are_the_shipped_rules(spark):
    assert rulesets.rule_set(rulesets.list_rows(spark)) == rulesets.shipped()
    assert rulesets.rule_set([]) == rulesets.shipped()


@pytest.mark.parametrize(
    ("lists", "added"),
    [
        ([("NO_SUCH_LIST", 0, "x")], []),
        ([("REVENUE", 0, None)], []),
        ([], [("only left", "left", 0, "first", 1, BS, "x:A", 0, False)]),
        ([], [("odd", s, 0, "median", 1, BS, "x:A", 0, False) for s in ("left", "right")]),
        ([], [("odd", s, 0, "first", 1, "nowhere", "x:A", 0, False) for s in ("left", "right")]),
        ([], [("cash flow", s, 0, "first", 1, BS, "x:A", 0, False) for s in ("left", "right")]),
    ],
)
def test_rows_that_are_no_rules_are_errors(lists, added):
    with pytest.raises(ValueError):
        checks.compiled(rulesets.rule_set(lists, added))


def test_facts_that_no_rule_names_leave_the_filing_only(spark):
    unused = [(BS, f"x:Unused{i}", i) for i in range(1000)]
    used = [(BS, "us-gaap:Assets", 100), (BS, "us-gaap:Liabilities", 60), (BS, R.EQUITY[0], 40)]
    both = frame(spark, unused + used).unionByName(frame(spark, unused, "g"))
    got = {(r.accession, r.check_name): r.status for r in checks.run_checks(both).collect()}
    assert len(got) == 28 and got["f", "balance sheet identity"] == "checked" and got["g", "balance sheet identity"] == "missing"
    of = checks.compiled(checks.shipped())
    steps = " ".join(v for layer in of.needed(["check_01"]) for v in layer.values())
    row = checks.filings(both.where("accession = 'f'"), of, steps).first()
    assert len(row._m) == 3 and row._e == []


def test_one_shuffle_for_all_checks(spark):
    plan = checks.run_checks(frame(spark, [(BS, "us-gaap:Assets", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_collect_list" in plan


def test_legacy_labels_are_rules_too(spark):
    rows = spark.createDataFrame([("f", "Sum of assets", 10.0, 0), ("f", "total liabilities and equity (note)", 10.0, 1), ("f", "Unknown", 3.0, 2), ("g", "Unknown", 3.0, 2)], "accession string, label string, value double, ord int")
    status = lambda rules: sorted((r.accession, r.status) for r in checks.run_legacy_checks(rows, rules).where("check_name = 'assets = liabilities and equity'").collect())
    assert status(None) == [("f", "skipped"), ("g", "skipped")]
    assert status(rulesets.rule_set([("LEGACY_ASSETS", 0, "Sum Of Assets")])) == [("f", "checked"), ("g", "skipped")]
