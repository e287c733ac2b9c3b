"""Rules of the accounting checks as rows: concept lists, word lists, tolerances and further checks.

The shipped rules are the constants of `rules`. A table of list rows (name, ord, value) replaces
whole lists by name, and tolerances by the names TOLERANCE_PCT and TOLERANCE_PCT:<check>. A table
of check rows adds checks: each has a left and a right side, and a side is a sum of terms.

| column | meaning |
|-|-|
| check_name | the new check |
| side | left or right |
| term | number of the term within its side |
| op | first: the first value found of the concepts; sum: the undimensioned concepts whose names contain all values, and none that begins with ! |
| sign | 1 or -1 |
| sections | names in their order, joined by commas |
| value | a concept (first) or a part of a name (sum) |
| ord | order of the term's values |
| optional | whether a term that is not found counts as zero; else the check is skipped |
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, Row, SparkSession

from quillstone.operators import rules as shipped_lists

LIST_ROWS = "name string, ord int, value string"
CHECK_ROWS = "check_name string, side string, term int, op string, sign int, sections string, value string, ord int, optional boolean"
#: Rules are read on the driver, which writes expressions from them; more rows than these are an error.
MAX_ROWS = 20_000
SECTIONS = ("balance_sheet", "income_stmt", "cashflow", "other")
TOLERANCE = "TOLERANCE_PCT"


@dataclass(frozen=True)
class Term:
    op: str
    sign: int
    sections: tuple[str, ...]
    values: tuple[str, ...]
    optional: bool


@dataclass(frozen=True)
class AddedCheck:
    name: str
    left: tuple[Term, ...]
    right: tuple[Term, ...]


@dataclass(frozen=True)
class RuleSet:
    """Lists by name, tolerances and added checks; equal sets are compiled once."""

    lists: tuple[tuple[str, str | tuple[str, ...]], ...]
    tolerance_pct: float
    tolerances: tuple[tuple[str, float], ...] = ()
    added: tuple[AddedCheck, ...] = ()

    def __getattr__(self, name: str) -> str | tuple[str, ...]:
        for k, v in object.__getattribute__(self, "lists"):
            if k == name:
                return v
        raise AttributeError(name)

    def tolerance(self, check: str) -> float:
        return dict(self.tolerances).get(check, self.tolerance_pct)


@lru_cache(maxsize=1)
def shipped() -> RuleSet:
    """The rules that come with the library."""
    lists = {k: v for k, v in vars(shipped_lists).items() if k.isupper() and isinstance(v, (str, tuple))}
    return RuleSet(tuple(sorted(lists.items())), shipped_lists.TOLERANCE_PCT)


def list_rows(spark: SparkSession, rules: RuleSet | None = None) -> DataFrame:
    """The lists and tolerances of a rule set as rows, to look at or to change and hand to rule_set()."""
    rules = rules or shipped()
    rows = [(k, i, x) for k, v in rules.lists for i, x in enumerate((v,) if isinstance(v, str) else v)]
    rows += [(TOLERANCE, 0, str(rules.tolerance_pct)), *[(f"{TOLERANCE}:{c}", 0, str(t)) for c, t in rules.tolerances]]
    return spark.createDataFrame(rows, LIST_ROWS)


def _rows(table: DataFrame | Iterable[tuple] | None, columns: str) -> list[Row]:
    names = [c.split()[0] for c in columns.split(", ")]
    if table is None:
        return []
    if isinstance(table, DataFrame):
        found = table.select(*names).limit(MAX_ROWS + 1).collect()
    else:
        found = [Row(**dict(zip(names, r, strict=True))) for r in table]
    if len(found) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} rule rows")
    return found


def _term(check: str, rows: Sequence[Row]) -> Term:
    rows = sorted(rows, key=lambda r: r.ord or 0)
    first = rows[0]
    sections = tuple(s.strip() for s in (first.sections or "").split(","))
    if first.op not in ("first", "sum") or set(sections) - set(SECTIONS) or any(not r.value for r in rows) or first.sign not in (1, -1):
        raise ValueError(f"check {check!r}: a term needs an op (first, sum), a sign (1, -1), known sections and values")
    if any((r.op, r.sign, r.sections, r.optional) != (first.op, first.sign, first.sections, first.optional) for r in rows):
        raise ValueError(f"check {check!r}: the rows of a term differ in more than their values")
    return Term(first.op, first.sign, sections, tuple(r.value for r in rows), bool(first.optional))


def rule_set(lists: DataFrame | Iterable[tuple] | None = None, checks: DataFrame | Iterable[tuple] | None = None, base: RuleSet | None = None) -> RuleSet:
    """`base` (the shipped rules) with the lists and tolerances of the first table in place of its own, and the checks of the second.

    Rows as tuples in the order of LIST_ROWS and CHECK_ROWS do as well. Unknown list names, rows
    without a value, checks without both sides or with the name of another one are errors.
    """
    base = base or shipped()
    held, tolerances, tolerance = dict(base.lists), dict(base.tolerances), base.tolerance_pct
    by: dict[str, list[Row]] = {}
    for r in _rows(lists, LIST_ROWS):
        by.setdefault(r.name, []).append(r)
    for name, rows in by.items():
        values = tuple(r.value for r in sorted(rows, key=lambda r: r.ord or 0))
        if any(v is None for v in values):
            raise ValueError(f"rule {name!r} has a row without a value")
        if name == TOLERANCE:
            tolerance = float(values[0])
        elif name.startswith(f"{TOLERANCE}:"):
            tolerances[name.partition(":")[2]] = float(values[0])
        elif name not in held:
            raise ValueError(f"unknown rule {name!r}")
        else:
            held[name] = values[0] if isinstance(held[name], str) else values
    sides: dict[str, dict[str, dict[int, list[Row]]]] = {}
    for r in _rows(checks, CHECK_ROWS):
        sides.setdefault(r.check_name, {}).setdefault(r.side, {}).setdefault(r.term, []).append(r)
    added = list(base.added)
    for name, of in sides.items():
        if set(of) != {"left", "right"} or name in {c.name for c in base.added}:
            raise ValueError(f"check {name!r} needs a left and a right side, and a name of its own")
        added.append(AddedCheck(name, *[tuple(_term(name, rows) for _, rows in sorted(of[s].items())) for s in ("left", "right")]))
    return RuleSet(tuple(sorted(held.items())), tolerance, tuple(sorted(tolerances.items())), tuple(added))
