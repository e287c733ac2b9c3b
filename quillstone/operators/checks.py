"""Accounting checks of filings: rules compiled to expressions over the slots of one aggregation.

`facts` has accession, section (balance_sheet, income_stmt, cashflow, other), concept, value and
ord; a concept's last value in a section counts. A rule set (see `rulesets`) is compiled once: it
says which concepts have a slot, which patterns are matched, and how the checks follow. Facts
that no rule names are dropped within their task; what is left of a filing becomes one row by a
single shuffle on the accession, with the values by slot (a 64-bit hash of section and concept)
and a short list of the facts that patterns match, marked with the bits of those patterns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.operators.rulesets import RuleSet, Term, shipped

BS, INC, CF, OTHER = "balance_sheet", "income_stmt", "cashflow", "other"
#: The checks of period-keyed filings, in order.
CHECKS = (
    "balance sheet identity",
    "assets by term",
    "liabilities by term",
    "gross profit",
    "operating income",
    "operating expenses",
    "pretax income",
    "net income",
    "comprehensive income",
    "cash flow",
    "equity components",
    "revenue by kind",
    "cost by kind",
    "revenue by segment",
)
#: A check: the sides compared, its difference, and the other numbers that its percentage is of.
CHECK = "struct<check_name:string,passed:boolean,passed_strict:boolean,status:string,difference:double,difference_pct:double>"
#: Totals that the checks are made of, by the name of their step.
PARTS = {
    "temporary equity": "_te",
    "other operating expenses": "_more",
    "nonoperating total": "_nt",
    "equity": "_s0",
    "equity with noncontrolling interests": "_s1",
}
#: The figures of early statements; their labels are the rules LEGACY_....
LEGACY = ("assets", "liabilities_and_equity", "revenue", "cost", "gross", "operating", "pretax", "tax", "net", "cfo", "cfi", "cff", "cash_change")
#: Components among which the best sum is searched.
MOST = 10


@dataclass(frozen=True)
class Pattern:
    """A condition on a concept's name: dimensioned or not, of one of the bases, without any word of `none`, and with all words of one group of `some`.

    A word that begins with ! must not be there. With `lower` the words are looked for in the lower-cased name.
    """

    some: tuple[tuple[str, ...], ...] = ()
    none: tuple[str, ...] = ()
    dimensioned: bool | None = None
    bases: tuple[str, ...] = ()
    lower: bool = False

    def fits(self, concept: str) -> bool:
        """For a name that is known now."""
        name = concept.lower() if self.lower else concept
        has = lambda w: (w[1:] not in name) if w.startswith("!") else (w in name)
        return (
            (self.dimensioned is None or ("[" in concept) == self.dimensioned)
            and (not self.bases or " [" in concept and concept.split(" [")[0] in self.bases)
            and not any(map(has, self.none))
            and (not self.some or any(all(map(has, words)) for words in self.some))
        )

    def condition(self, concept: Column, lowered: Column | None = None) -> Column:
        """For a column; with the lower-cased column at hand, long word lists are literal arrays, which keeps the generated code small."""
        name = (F.lower(concept) if lowered is None else lowered) if self.lower else concept
        has = lambda w: ~name.contains(w[1:]) if w.startswith("!") else name.contains(w)
        out = [concept.contains("[") if self.dimensioned else ~concept.contains("[")] if self.dimensioned is not None else []
        out += [concept.contains(" [") & F.substring_index(concept, " [", 1).isin(*self.bases)] if self.bases else []
        groups = [reduce(Column.__and__, map(has, words)) for words in self.some]
        # what must be there is looked for first, as most names lack it
        if self.lower and lowered is not None and all(len(words) == 1 and words[0][0] != "!" for words in self.some):
            any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: name.contains(w))
            out += [any_of([w for (w,) in self.some])] if self.some else []
            out += [~any_of(self.none)] if self.none else []
        else:
            out += [reduce(Column.__or__, groups)] if groups else []
            out += [~reduce(Column.__or__, map(has, self.none))] if self.none else []
        return reduce(Column.__and__, out)


def _words(*words: str) -> Pattern:
    """Undimensioned, with all of the words."""
    return Pattern((words,), dimensioned=False)


def _statement(r: RuleSet) -> Pattern:
    return Pattern(tuple((w,) for w in r.STATEMENT_INCLUDES), r.STATEMENT_EXCLUDES, lower=True)


def _component(r: RuleSet) -> Pattern:
    return Pattern(tuple((w,) for w in r.STATEMENT_INCLUDES), tuple(dict.fromkeys((*r.COMPONENT_EXCLUDES, *r.STATEMENT_EXCLUDES))), False, lower=True)


EXTENSION = Pattern((("Nonoperating", "!IncomeTax", "!BeforeIncomeTaxes"), ("NonOperating", "!IncomeTax", "!BeforeIncomeTaxes")), dimensioned=False)
#: An expense or loss, but no net total and no tax.
DEDUCTED = Pattern((("expense",), ("loss", "!gainloss")), ("incometax", "incomeexpense"), lower=True)


def is_statement_concept(k: Column, rules: RuleSet | None = None) -> Column:
    """Looks like an income-statement item."""
    return _statement(rules or shipped()).condition(k)


def is_nonop_component(k: Column, rules: RuleSet | None = None) -> Column:
    """May be a part of nonoperating income: undimensioned, no subtotal, no cash flow."""
    return _component(rules or shipped()).condition(k)


def is_nonop_extension(k: Column) -> Column:
    """Is named nonoperating: undimensioned, and no tax or pretax item."""
    return EXTENSION.condition(k)


# SQL text


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(x: str, names: Sequence[str]) -> str:
    return f"{x} IN ({', '.join(map(_quoted, names))})"


def _coalesce(*xs: str) -> str:
    return f"coalesce({', '.join(xs)})" if len(xs) > 1 else xs[0]


def _plus(*xs: str) -> str:
    return f"({' + '.join(xs)})"


def _or(a: str, b: str) -> str:
    """`a`, or `b` if `a` is null or zero."""
    return f"CASE WHEN {a} IS NOT NULL AND {a} <> 0D THEN {a} ELSE {b} END"


def _null(*xs: str) -> str:
    return f"({' OR '.join(f'{x} IS NULL' for x in xs)})"


def _percent(difference: str, others: Sequence[str]) -> str:
    """difference_of() as text."""
    return f"(abs({difference}) / greatest({', '.join(f'abs({x})' for x in others)}, 1e-9D) * 100D)"


def _array(*xs: str) -> str:
    return f"array_compact(array({', '.join(xs)}))"


def _check(name: str, tolerance: str, gap: str, pct: str, status: str, strict: str) -> str:
    """A check as a struct."""
    done = f"{status} = 'checked'"
    fields = {
        "check_name": _quoted(name),
        "passed": f"if({done}, coalesce({pct} <= {tolerance}, false), {status} = 'skipped')",
        "passed_strict": f"if({done}, coalesce({strict}, false), {status} = 'skipped')",
        "status": status,
        "difference": f"if({done}, {gap}, NULL)",
        "difference_pct": f"if({done}, round({pct}, 2), NULL)",
    }
    return f"CAST(named_struct({', '.join(f'{_quoted(k)}, {v}' for k, v in fields.items())}) AS {CHECK})"


def _merged(entries: str, fields: Sequence[str]) -> str:
    """Of sorted entries (fields, ord, value, more) one for each of the fields' combinations: its last value, in the order of first appearance."""
    def edge(step: str) -> str:
        return "coalesce(" + " OR ".join(f"get({entries}, i {step} 1).{f} <> e.{f}" for f in fields) + ", true)"

    return f"array_sort(zip_with(filter({entries}, (e, i) -> {edge('+')}), filter({entries}, (e, i) -> {edge('-')}), (l, f) -> named_struct('ord', f.ord, 'last', l)))"


class Compiled:
    """A rule set's slots, patterns and steps.

    Steps are (column, SQL text), later ones may name earlier ones; checks are named check_....
    A pattern has a bit and is matched in some sections.
    """

    def __init__(self, rules: RuleSet):
        self.rules = rules
        self.patterns: list[tuple[tuple[str, ...], Pattern]] = []
        self.steps: list[tuple[str, str]] = []
        self.names = (*CHECKS, *(c.name for c in rules.added))
        if len(set(self.names)) < len(self.names):
            raise ValueError("two checks have one name")
        self._suite()

    def let(self, name: str, value: str) -> str:
        self.steps.append((name, value))
        return name

    def value(self, section: str, concept: str) -> str:
        """The concept's last value in the section."""
        return f"try_element_at(_m, xxhash64({_quoted(section)}, {_quoted(concept)}))"

    def first(self, sections: Sequence[str], concepts: Sequence[str]) -> str:
        """The first value of the concepts, section by section."""
        return _coalesce(*[self.value(s, c) for s in sections for c in concepts])

    def bit(self, sections: Sequence[str], pattern: Pattern) -> str:
        """The bit of a pattern, which is matched in these sections."""
        if (tuple(sections), pattern) not in self.patterns:
            self.patterns.append((tuple(sections), pattern))
        return f"{1 << self.patterns.index((tuple(sections), pattern))}L"

    def has(self, e: str, bit: str) -> str:
        return f"({e}.bits & {bit}) <> 0L"

    def total(self, section: str, pattern: Pattern) -> str:
        """The sum of a section's concepts that fit, computed once."""
        bit = self.bit([section], pattern)
        name = f"_sum{bit[:-1]}"
        return name if name in dict(self.steps) else self.let(name, f"aggregate(_e, 0D, (s, e) -> if({self.has('e', bit)}, s + e.value, s))")

    def near(self, a: str, b: str) -> str:
        return f"coalesce({_percent(f'({a}) - ({b})', [a, b])} <= {self.rules.tolerance_pct!r}D, false)"

    def closest(self, values: str, computed: str) -> str:
        """The first candidate that is about the computed value, else the first."""
        return f"coalesce(try_element_at(filter({values}, v -> {self.near('v', computed)}), 1), try_element_at({values}, 1))"

    def result(self, n: int, strict: str | None, left: str, right: str, others: Sequence[str], skipped: str = "false", missing: str = "false") -> None:
        """A check: skipped ones pass, ones that miss a required value fail, others pass within the tolerance of their largest number."""
        name, tolerance = self.names[n - 1], f"{self.rules.tolerance(self.names[n - 1])!r}D"
        gap, status = self.let(f"_gap{n}", f"{left} - {right}"), self.let(f"_status{n}", f"CASE WHEN {skipped} THEN 'skipped' WHEN {missing} THEN 'missing' ELSE 'checked' END")
        pct = self.let(f"_pct{n}", _percent(gap, others))
        strict = strict or f"{_percent(gap, [left, right])} <= {tolerance}"
        self.let(f"check_{n:02d}", _check(name, tolerance, gap, pct, status, strict))

    def sides(self, n: int, left: str, right: str, others: Sequence[str], skipped: str = "false", missing: str = "false") -> None:
        self.result(n, None, left, f"({right})", [left, right, *others], skipped, missing)

    # parts

    def temporary_equity(self) -> str:
        """A primary concept, else dimensioned primary, mezzanine and alternative amounts together."""
        r = self.rules
        parts = self.total(BS, Pattern(tuple((w,) for w in r.TEMPORARY_PARTS), dimensioned=True))
        listed = [f"coalesce({self.value(BS, c)}, 0D)" for c in (*r.TEMPORARY_MEZZANINE, *r.TEMPORARY_OTHER)]
        return _coalesce(*[self.value(BS, c) for c in r.TEMPORARY_PRIMARY], _plus(parts, *listed))

    def temporary_equity_elsewhere(self) -> str:
        """Alternative amounts outside the balance sheet that it does not hold itself."""
        return _plus("0D", *[f"if({self.value(BS, c)} IS NULL, coalesce({self.value(OTHER, c)}, 0D), 0D)" for c in self.rules.TEMPORARY_OTHER])

    def _parts_of(self, kind: str, *words: str) -> str:
        """The sum of undimensioned concepts of that kind, on the balance sheet and elsewhere."""
        return _plus("0D", *[self.total(s, _words(kind, *words)) for s in (BS, OTHER)])

    def noncurrent(self, total: str, current: str, kind: str, elsewhere: Pattern | None, exclusive: bool) -> str:
        """A noncurrent amount: reported; sums of names, replaced by total less current where they do not fit; derived from parts."""
        def settled(s: str) -> str:
            return f"CASE WHEN {s} <> 0D THEN CASE WHEN {total} IS NOT NULL AND {current} IS NOT NULL AND NOT {self.near(total, f'{current} + {s}')} THEN {total} - {current} ELSE {s} END END"

        cur = self._parts_of(kind, "Current", "!Noncurrent")
        words = ("Noncurrent", "!Current") if exclusive else ("Noncurrent",)
        non = self._parts_of(kind, *words)
        options = [self.value(BS, f"us-gaap:{kind}Noncurrent"), settled(self.total(BS, _words(kind, "Noncurrent")))]
        if elsewhere is not None:
            options.append(settled(self.total(OTHER, elsewhere)))
        options += [f"{total} - {current}", f"CASE WHEN {cur} > 0D THEN {total} - {cur} END", f"CASE WHEN {non} > 0D AND {total} IS NOT NULL THEN {non} END"]
        return _coalesce(*options)

    def other_opex(self) -> str:
        """Listed concepts, and undimensioned extension concepts named Opex, each once (the income statement first)."""
        listed = [f"coalesce({self.first([INC, OTHER], [c])}, 0D)" for c in self.rules.OTHER_OPEX]
        bit = self.bit([INC, OTHER], _words("Opex", "!ResearchAndDevelopmentExpense", "!SellingGeneralAndAdministrativeExpense"))
        found = self.let("_ox", f"filter(_e, e -> {self.has('e', bit)})")
        inc = self.let("_oxi", f"filter({found}, e -> e.section = '{INC}')")
        extra = f"filter({found}, e -> e.section = '{OTHER}' AND NOT exists({inc}, x -> x.concept = e.concept))"
        added = [f"aggregate({a}, 0D, (s, e) -> s + e.value)" for a in (inc, extra)]
        return _plus("0D", *listed, *added)

    def component(self, concept: str) -> str:
        """The step of a concept's value (other first), else of the sum of its dimensioned values, null if there is none."""
        r = self.rules
        listed = list(dict.fromkeys((*r.INTEREST_NET, *r.INTEREST_PARTS, *r.INVESTMENT_INCOME, *r.OTHER_NONOP, *r.EXTRA_NONOP)))
        name = f"_k{listed.index(concept)}"
        if name in dict(self.steps):
            return name
        stars = "_stars"
        if stars not in dict(self.steps):
            bit = self.bit([INC, OTHER], Pattern(bases=tuple(listed)))
            self.let(stars, f"filter(_e, e -> {self.has('e', bit)})")

        def star(section: str) -> str:
            return f"aggregate({stars}, CAST(NULL AS DOUBLE), (s, e) -> if(e.section = '{section}' AND startswith(e.concept, {_quoted(concept + ' [')}), coalesce(s, 0D) + e.value, s))"

        return self.let(name, _coalesce(self.first([OTHER, INC], [concept]), f"CASE WHEN size({stars}) > 0 THEN coalesce(nullif({star(OTHER)}, 0D), {star(INC)}) END"))

    def nonoperating_total(self) -> str:
        """A reported total, else interest, investment income, other items, extension items and extras, signed, each name once; zero is null."""
        r, comp = self.rules, self.component

        def signed(k: str) -> str:
            return f"-abs({comp(k)})" if DEDUCTED.fits(k) else comp(k)

        net = self.let("_interest", self.first([OTHER, INC], r.INTEREST_NET))
        seen = [(k, f"{net} IS NOT NULL") for k in r.INTEREST_NET]  # names, with the condition under which they were counted
        seen += [(k, f"{net} IS NULL AND {comp(k)} IS NOT NULL") for k in r.INTEREST_PARTS]
        terms = [f"coalesce({net}, {_plus('0D', *[f'coalesce({signed(k)}, 0D)' for k in r.INTEREST_PARTS])})"]
        for k in r.INVESTMENT_INCOME:
            terms.append(f"coalesce({signed(k)}, 0D)")
            seen.append((k, f"{comp(k)} IS NOT NULL"))
        terms.append(_coalesce(*[signed(k) for k in r.OTHER_NONOP], "0D"))
        for i, k in enumerate(r.OTHER_NONOP):
            earlier = [comp(x) for x in r.OTHER_NONOP[:i]]
            seen.append((k, f"{comp(k)} IS NOT NULL" + "".join(f" AND {x} IS NULL" for x in earlier)))
        named = [f"CASE WHEN {c} THEN {_quoted(k)} END" for k, c in seen if re.search("Non[oO]perating", k)]
        names = self.let("_counted", f"CAST({_array(*named)} AS ARRAY<STRING>)")
        extension = self.bit([INC, OTHER], EXTENSION)
        found = self.let("_ext", f"filter(_e, e -> {self.has('e', extension)} AND NOT array_contains({names}, e.concept))")
        outer = self.let("_exto", f"filter({found}, e -> e.section = '{OTHER}' AND {self.has('e', self.plausible())})")
        inner = f"filter({found}, e -> e.section = '{INC}' AND NOT exists({outer}, x -> x.concept = e.concept))"
        terms.append(f"aggregate(concat({outer}, {inner}), 0D, (s, e) -> s + {self.signed_entry('e')})")
        for k in r.EXTRA_NONOP:  # none of these has a name that the extension rule takes
            v = signed(k)
            terms.append(f"coalesce({v if _component(r).fits(k) else f'CASE WHEN {self.value(INC, k)} IS NOT NULL OR {self.value(OTHER, k)} IS NULL THEN {v} END'}, 0D)")
        return _coalesce(self.first([OTHER, INC], r.NONOP_TOTALS), f"nullif({_plus(*terms)}, 0D)")

    def plausible(self) -> str:
        return self.bit([INC, OTHER], _component(self.rules))

    def signed_entry(self, e: str) -> str:
        """signed_component() of an entry."""
        deducted = self.bit([INC, OTHER], DEDUCTED)
        return f"if({self.has(e, deducted)} AND {e}.value > 0D, -abs({e}.value), {e}.value)"

    def best_subset(self, target: str) -> str:
        """The sum of one to three of the largest plausible components that comes closest to the target, the first on ties."""
        mine = ", ".join(f"filter(_e, e -> e.section = '{s}' AND {self.has('e', self.plausible())})" for s in (INC, OTHER))
        signed = f"transform(concat({mine}), (e, i) -> named_struct('rank', -abs(e.value), 'i', i, 'v', {self.signed_entry('e')}))"
        self.let("_top", f"slice(array_sort({signed}), 1, {MOST})")
        picks = ", ".join(f"array({', '.join(map(str, c))})" for n in (1, 2, 3) for c in combinations(range(MOST), n))
        score = "aggregate(c, 0D, (a, p) -> a + get(_top, p).v)"
        # only combinations of the components that there are
        sums = f"transform(filter(array({picks}), c -> element_at(c, -1) < size(_top)), (c, i) -> named_struct('err', abs({score} - {target}), 'i', i, 's', {score}))"
        return f"array_min({sums}).s"

    def equity_components(self) -> tuple[str, str]:
        """Sums of dimensioned equity by concept: the parent's, then with noncontrolling interests.

        Totals go where components are known, and so do segments; of accumulated other income either
        the children or the first of the parents counts.
        """
        r = self.rules
        bit = self.bit([BS], Pattern(bases=r.EQUITY))
        item = f"named_struct('base', if(startswith(e.concept, {_quoted(r.EQUITY[1] + ' [')}), 1, 0), 'dim', trim(regexp_extract(e.concept, '\\\\[(.*)\\\\]', 1)), 'v', e.value)"
        items = self.let("_qi", f"transform(filter(_e, e -> {self.has('e', bit)}), e -> {item})")

        def by_form(x: str, *more: str) -> str:
            return f"if(_annual, {_in(x, (*r.EQUITY_COMPONENTS, *r.AOCI_CHILDREN, *more))}, {_in(x, (*r.QUARTERLY_EQUITY_COMPONENTS, *r.AOCI_CHILDREN, *more))})"

        some, children = self.let("_qp", f"exists({items}, x -> {by_form('x.dim')})"), self.let("_qc", f"exists({items}, x -> {_in('x.dim', r.AOCI_CHILDREN)})")
        first = "trim(substring_index(x.dim, ',', 1))"
        total_alone = f"NOT contains(x.dim, ',') AND {_in(first, r.EQUITY_TOTALS)}"
        unknown = f"NOT {by_form(first, 'NoncontrollingInterest', *r.EQUITY_TOTALS)}"
        parent = _in("x.dim", r.AOCI_PARENTS)
        kept = self.let("_qk", f"transform(filter({items}, x -> NOT ({some} AND ({total_alone} OR {unknown})) AND NOT ({children} AND {parent})), (x, i) -> named_struct('base', x.base, 'dim', x.dim, 'v', x.v, 'i', i))")
        only = self.let("_qf", f"array_min(transform(filter({kept}, x -> {parent}), x -> x.i))")
        once = self.let("_qo", f"filter({kept}, x -> NOT {parent} OR x.i = {only})")
        sums = [f"nullif(aggregate(filter({once}, x -> x.base = {n}), 0D, (s, x) -> s + x.v), 0D)" for n in (0, 1)]
        return self.let("_s0", sums[0]), self.let("_s1", sums[1])

    # checks

    def _suite(self) -> None:
        r, let, value, first = self.rules, self.let, self.value, self.first
        assets, equity = let("_assets", value(BS, r.ASSETS)), let("_equity", first([BS], r.EQUITY))
        te = let("_te", self.temporary_equity())
        temp = let("_temp", f"{te} + {self.temporary_equity_elsewhere()}")
        rest = f"({equity} + coalesce({te}, 0D))"
        liab = let("_liab", _coalesce(value(BS, r.LIABILITIES), f"{assets} - {rest}", f"{value(BS, r.LIABILITIES_AND_EQUITY)} - {rest}"))
        self.sides(1, assets, f"{liab} + {equity} + {temp}", [liab, equity, temp], missing=_null(assets, liab, equity))

        cur = let("_acur", value(BS, "us-gaap:AssetsCurrent"))
        non = let("_anon", self.noncurrent(assets, cur, "Assets", None, False))
        derived = let("_ader", self._parts_of("Assets", "Current", "!Noncurrent"))
        cur2 = let("_acur2", _coalesce(cur, f"CASE WHEN {derived} > 0D THEN {derived} END", f"{assets} - {non}"))
        non2 = let("_anon2", _coalesce(non, f"{assets} - {cur2}"))
        self.sides(2, assets, f"{cur2} + {non2}", [cur2, non2], f"{assets} IS NOT NULL AND {_null(cur2, non2)}", _null(assets))

        lcur0 = let("_lcur0", value(BS, "us-gaap:LiabilitiesCurrent"))
        lcur = let("_lcur", _coalesce(lcur0, f"nullif({self._parts_of('Liabilities', 'Current', '!Noncurrent')}, 0D)"))
        elsewhere = Pattern((("PayableNoncurrent",), ("Liabilities", "Noncurrent")), dimensioned=False)
        lnon = let("_lnon", self.noncurrent(liab, lcur0, "Liabilities", elsewhere, True))
        self.sides(3, liab, f"{lcur} + {lnon}", [lcur, lnon], _null(liab, lcur, lnon))

        gross = let("_gross", _or(value(INC, r.GROSS_PROFIT), value(OTHER, r.GROSS_PROFIT)))
        revenues, costs = let("_revs", _array(*[first([INC, OTHER], [c]) for c in r.REVENUE])), let("_costs", _array(*[first([OTHER, INC], [c]) for c in r.COST]))
        pairs = f"flatten(transform({revenues}, a -> transform({costs}, b -> named_struct('revenue', a, 'cost', b))))"
        pair = let("_pair", f"try_element_at(filter({pairs}, p -> {_percent(f'p.revenue - p.cost - {gross}', ['p.revenue - p.cost', gross])} <= {r.tolerance_pct!r}D), 1)")
        rev, cost = let("_rev", _coalesce(f"{pair}.revenue", f"try_element_at({revenues}, 1)")), let("_cost", _coalesce(f"{pair}.cost", f"try_element_at({costs}, 1)"))
        self.sides(4, gross, f"{rev} - {cost}", [rev, cost], _null(gross, rev, cost))

        opex = let("_opex", _or(value(INC, r.OPERATING_EXPENSES), value(OTHER, r.OPERATING_EXPENSES)))
        ops = let("_ops", _array(*[value(s, r.OPERATING_INCOME) for s in (INC, OTHER)]))
        op = let("_op", self.closest(ops, f"{gross} - {opex}"))
        self.sides(5, op, f"{gross} - {opex}", [gross, opex], _null(gross, opex, op))

        rd, sga = let("_rd", first([OTHER, INC], [r.RESEARCH])), let("_sga", first([OTHER, INC], [r.SELLING]))
        more = let("_more", self.other_opex())
        self.sides(6, opex, f"{rd} + {sga} + {more}", [rd, sga, more], _null(opex, rd, sga))

        pretax, opinc = let("_pretax", first([INC, OTHER], r.PRETAX)), let("_opinc", first([INC, OTHER], [r.OPERATING_INCOME]))
        implied = let("_implied", f"{pretax} - {opinc}")
        options = [first([OTHER, INC], r.NONOP_TOTALS[:1]), first([OTHER, INC], r.NONOP_TOTALS[1:]), let("_nt", self.nonoperating_total())]
        told = let("_told", f"array_min({_array(*[f'CASE WHEN {v} IS NOT NULL THEN named_struct({_quoted("err")}, abs({v} - {implied}), {_quoted("i")}, {i}, {_quoted("v")}, {v}) END' for i, v in enumerate(options)])})")
        subset = self.best_subset(implied)
        # combinations are searched where no reported total is exact, but for what rounding leaves
        found = let("_found", f"CASE WHEN size(_top) > 0 AND ({told} IS NULL OR {told}.err > abs({implied}) * 1e-12D) THEN {subset} END")
        # of equally close ones a reported total counts
        nonop = let("_nonop", f"coalesce(CASE WHEN {found} IS NOT NULL AND coalesce(abs({found} - {implied}) < {told}.err, {told} IS NULL OR {told}.err IS NULL) THEN {found} ELSE {told}.v END, 0D)")
        self.sides(7, pretax, f"{opinc} + {nonop}", [opinc, nonop], _null(pretax, opinc))

        tax = let("_tax", _coalesce(first([OTHER, INC], r.TAX), "0D"))
        nets = let("_nets", _array(*[value(s, c) for s in (INC, OTHER) for c in r.NET]))
        net = let("_net", self.closest(nets, f"{pretax} - {tax}"))
        self.sides(8, net, f"{pretax} - {tax}", [pretax, tax], _null(pretax, net))

        net9, oci = let("_net9", first([INC, OTHER], r.NET)), let("_oci", _coalesce(first([INC, OTHER], r.OCI), "0D"))
        comps = let("_comps", _array(*[value(s, c) for c in r.COMPREHENSIVE for s in (INC, OTHER)]))
        comp = let("_comp", self.closest(comps, f"{net9} + {oci}"))
        self.sides(9, comp, f"{net9} + {oci}", [net9, oci], _null(net9, comp))

        o, i, f = (let(n, first([CF], c)) for n, c in (("_cfo", r.OPERATING), ("_cfi", r.INVESTING), ("_cff", r.FINANCING)))
        continuing = f"{_coalesce(*[value(CF, c[0]) for c in (r.OPERATING, r.INVESTING, r.FINANCING)])} IS NULL"
        gone = _coalesce(value(CF, r.DISCONTINUED), _plus("0D", *[f"coalesce({value(CF, c)}, 0D)" for c in r.DISCONTINUED_PARTS]))
        flow = let("_flow", f"{o} + {i} + {f} + if({continuing}, {gone}, 0D)")
        change, fx = let("_change", first([OTHER, CF], r.CASH_CHANGE)), let("_fx", _coalesce(first([OTHER, CF], r.EXCHANGE_EFFECT), "0D"))
        best = let("_flowx", f"if(abs({flow} + {fx} - {change}) < abs({flow} - {change}), {flow} + {fx}, {flow})")
        self.result(10, f"{self.near(flow, change)} OR {self.near(f'{flow} + {fx}', change)}", best, change, [o, i, f, best, change], _null(o, i, f, change))

        s0, s1 = self.equity_components()
        e0, e1 = (let(n, value(BS, c)) for n, c in (("_e0", r.EQUITY[0]), ("_e1", r.EQUITY[1])))
        both = [f"named_struct('err', {_percent(f'{t} - {s}', [t, s])}, 'n', {n}, 't', {t}, 's', {s})" for n, (t, s) in enumerate(((e0, s0), (e1, s1)))]
        pick = let("_pick", f"array_min(filter(array({', '.join(both)}), x -> x.t IS NOT NULL AND x.s IS NOT NULL))")
        total, parts = let("_etot", _coalesce(f"{pick}.t", e0, e1)), let("_eparts", _coalesce(f"{pick}.s", f"nullif(coalesce({s0}, 0D) + coalesce({s1}, 0D), 0D)"))
        self.sides(11, total, parts, [], f"{total} IS NOT NULL AND {parts} IS NULL", _null(total))

        for n, concepts, order, stem in ((12, r.REVENUE, (INC, OTHER), r.REVENUE[0]), (13, r.COST, (OTHER, INC), r.COST[0])):
            whole = let(f"_t{n}", first(order, concepts))
            product, service = (let(f"_{x.lower()}{n}", _or(value(order[0], f"{stem} [{x}]"), value(order[1], f"{stem} [{x}]"))) for x in ("Product", "Service"))
            self.sides(n, whole, f"{product} + {service}", [product, service], _null(whole, product, service))

        whole = let("_t14", value(INC, r.REVENUE[0]))
        segments = let("_seg", _plus(*[value(INC, f"{r.REVENUE[0]} [{s}]") for s in r.SEGMENTS]))
        self.sides(14, whole, segments, [], _null(whole, segments))

        for n, check in enumerate(r.added, len(CHECKS) + 1):
            left, right = ([let(f"_{side}{n}_{i}", self.term(t)) for i, t in enumerate(terms)] for side, terms in (("left", check.left), ("right", check.right)))
            a, b = let(f"_lhs{n}", _plus(*left)), let(f"_rhs{n}", _plus(*right))
            self.sides(n, a, b, [*left, *right], _null(a, b))

    def term(self, t: Term) -> str:
        """A term of an added check."""
        if t.op == "first":
            found = self.first(t.sections, t.values)
        else:
            bits = self.bit(t.sections, _words(*t.values))
            found = f"aggregate(_e, CAST(NULL AS DOUBLE), (s, e) -> if({self.has('e', bits)}, coalesce(s, 0D) + e.value, s))"
        found = f"coalesce({found}, 0D)" if t.optional else found
        return f"-({found})" if t.sign < 0 else found

    # running

    def needed(self, wanted: Sequence[str]) -> list[dict[str, str]]:
        """The wanted steps and those that they need, in layers that need earlier layers only, as a plan is analysed again with each."""
        need, names = set(wanted), {name for name, _ in self.steps}
        uses = {name: names & set(re.findall(r"\b_[A-Za-z]\w*", value)) for name, value in self.steps}
        for name, _ in reversed(self.steps):
            if name in need:
                need |= uses[name]
        level: dict[str, int] = {}
        out: list[dict[str, str]] = []
        for name, value in self.steps:
            if name in need:
                level[name] = 1 + max((level[x] for x in uses[name]), default=-1)
                if level[name] == len(out):
                    out.append({})
                out[level[name]][name] = value
        return out


@lru_cache(maxsize=16)
def compiled(rules: RuleSet) -> Compiled:
    return Compiled(rules)


def filings(facts: DataFrame, of: Compiled, text: str) -> DataFrame:
    """One row for each accession: _m, the last value by slot, _e, the facts that patterns match in order of appearance, and _annual.

    `text` is what will be made of it: the concepts it names have slots, and the patterns whose
    bits it tests are matched. Other facts leave no trace but the accession, which the first half
    of the aggregation keeps within their task. Filings without a form_type are not annual.
    """
    named, tested = set(re.findall(r"xxhash64\('[^']*', ('[^']*')\)", text)), set(map(int, re.findall(r"& (\d+)L", text)))
    form = F.upper(F.trim("form_type")) if "form_type" in facts.columns else F.lit(None).cast("string")
    annual = F.coalesce(form.startswith("10-K") | form.isin(*of.rules.ANNUAL_FORMS), F.lit(False))
    # patterns are matched here, once for each fact, and not in the checks; for names that the rules know they were matched before
    concept = F.col("concept")
    known = F.expr(f"concept IN ({', '.join(sorted(named))})") if named else F.lit(False)
    bits = F.lit(0).cast("long")
    for n, (sections, pattern) in enumerate(of.patterns):
        if 1 << n in tested:
            fitting = [k for k in named if pattern.fits(k[1:-1])]
            fits = F.when(F.col("_known"), F.expr(f"concept IN ({', '.join(sorted(fitting))})") if fitting else F.lit(False)).otherwise(pattern.condition(concept, F.col("_lower")))
            bits = bits.bitwiseOR(F.when(F.col("section").isin(*sections) & fits, F.lit(1 << n).cast("long")).otherwise(F.lit(0).cast("long")))
    rows = facts.where(F.col("value").isNotNull()).select("accession", "section", "concept", "ord", "value", annual.alias("_annual"), known.alias("_known"), F.lower("concept").alias("_lower"))
    rows = rows.select("*", bits.alias("bits"))
    slot = F.when(F.col("_known"), F.struct(F.xxhash64("section", "concept").alias("key"), "ord", "value"))
    entry = F.when(F.col("bits") != 0, F.struct("section", "concept", "ord", "value", "bits"))
    one = rows.groupBy("accession").agg(F.array_sort(F.collect_list(slot)).alias("_n"), F.array_sort(F.collect_list(entry)).alias("_l"), F.max("_annual").alias("_annual"))
    slots = "map_from_entries(transform(filter(_n, (e, i) -> coalesce(get(_n, i + 1).key <> e.key, true)), e -> named_struct('key', e.key, 'value', e.value)))"
    entries = f"transform({_merged('_l', ['section', 'concept'])}, x -> x.last)"
    return one.select("accession", "_annual", F.expr(slots).alias("_m"), F.expr(entries).alias("_e"))


def _stepped(facts: DataFrame, of: Compiled, wanted: Sequence[str]) -> DataFrame:
    steps = of.needed(wanted)
    rows = filings(facts, of, " ".join(value for layer in steps for value in layer.values()))
    for layer in steps:
        rows = rows.withColumns({name: F.expr(value) for name, value in layer.items()})
    return rows


def run_checks(facts: DataFrame, names: Sequence[str] | None = None, rules: RuleSet | None = None) -> DataFrame:
    """(accession, check_name, passed, passed_strict, status, difference, difference_pct): one row for each filing and check.

    `rules` are the shipped ones, or others from rulesets.rule_set(). `names` chooses among CHECKS
    and the checks that the rules add; only what the chosen ones need is computed. `facts` may
    have a form_type: the equity components of 10-K, 20-F and 40-F filings are judged by the annual
    list, all others, and filings without a form, by the quarterly one. `passed` goes by the
    difference in percent of the largest number involved, `passed_strict` by the two sides alone.
    A filing without facts has no rows.
    """
    of = compiled(rules or shipped())
    if unknown := set(names or ()) - set(of.names):
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    wanted = [f"check_{n:02d}" for n, name in enumerate(of.names, 1) if names is None or name in names]
    rows = _stepped(facts, of, wanted)
    return rows.select("accession", F.explode(F.array(*wanted)).alias("r")).select("accession", "r.*")


def filing_parts(facts: DataFrame, parts: Sequence[str], rules: RuleSet | None = None) -> DataFrame:
    """(accession, and a column for each of the PARTS asked for): totals that the checks are made of."""
    of = compiled(rules or shipped())
    return _stepped(facts, of, [PARTS[p] for p in parts]).select("accession", *[F.col(PARTS[p]).alias(p) for p in parts])


def first_values(facts: DataFrame, wanted: dict[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """(accession, and a column for each name): the first value of its concepts, section by section."""
    of = compiled(shipped())
    values = {name: of.first(sections, concepts) for name, (sections, concepts) in wanted.items()}
    return filings(facts, of, " ".join(values.values())).select("accession", *[F.expr(v).alias(name) for name, v in values.items()])


def run_all_checks(facts: DataFrame, statements: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """The checks of every filing by its shape: period-keyed ones by run_checks(), early statements of labelled rows by run_legacy_checks()."""
    return run_checks(facts, rules=rules).unionByName(run_legacy_checks(statements))


def _legacy_text(candidates: Sequence[str]) -> str:
    exact = [f"try_element_at(_l, {_quoted(c.lower())})" for c in candidates]
    return _coalesce(*exact, *[f"try_element_at(filter(_r, r -> startswith(r.label, {_quoted(c.lower() + ' ')})), 1).value" for c in candidates])


def legacy_value(candidates: Sequence[str]) -> Column:
    """The value of the first candidate label that a legacy statement has, else of the first row whose label starts with one.

    _l maps the lower-cased labels to values, and _r has the rows in their order.
    """
    return F.expr(_legacy_text(candidates))


def run_legacy_checks(rows: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """The same result columns for statements of labelled rows (accession, label, value, ord).

    Rows whose labels no rule names are dropped within their task, as in run_checks().
    """
    r = rules or shipped()
    figures = {name: getattr(r, f"LEGACY_{name.upper()}") for name in LEGACY}
    label = F.lower("label")
    known = [c.lower() for cs in figures.values() for c in cs]
    hit = label.isin(*known)
    for c in known:
        hit = hit | label.startswith(f"{c} ")
    held = F.collect_list(F.when(hit, F.struct(label.alias("label"), "ord", "value")))
    f = rows.where("value is not null").groupBy("accession").agg(F.array_sort(held).alias("_n"))
    f = f.select("accession", F.expr(f"transform({_merged('_n', ['label'])}, x -> x.last)").alias("_r"))
    f = f.withColumn("_l", F.expr("map_from_entries(transform(_r, r -> named_struct('key', r.label, 'value', r.value)))"))
    f = f.withColumns({f"_{n}": F.expr(_legacy_text(cs)) for n, cs in figures.items()})
    sides = [  # the name, what must be there, the two sides, the other numbers
        ("assets = liabilities and equity", "_assets", "_liabilities_and_equity", []),
        ("revenue - cost = gross profit", "_gross", "_revenue - _cost", ["_revenue", "_cost"]),
        ("revenue - cost = operating income", "_operating", "_revenue - _cost", ["_revenue", "_cost"]),
        ("pretax - tax = net income", "_net", "_pretax - _tax", ["_pretax", "_tax"]),
        ("cash flow", "_cfo + _cfi + _cff", "_cash_change", ["_cfo", "_cfi", "_cff"]),
    ]
    found = []
    for name, left, right, others in sides:
        needed = sorted(set(re.findall(r"_\w+", f"{left} {right}")))
        gap, tolerance = f"({left} - ({right}))", f"{r.tolerance(name)!r}D"
        strict = f"{_percent(gap, [left, right])} <= {tolerance}"
        found.append(_check(name, tolerance, gap, _percent(gap, [left, right, *others]), f"if({_null(*needed)}, 'skipped', 'checked')", strict))
    return f.select("accession", F.explode(F.array(*map(F.expr, found))).alias("r")).select("accession", "r.*")


def check_failures(results: DataFrame) -> DataFrame:
    """Filings with failed checks: their names with percentages, and counts."""
    failed = F.when(~F.col("passed"), F.concat("check_name", F.when(F.col("difference_pct").isNotNull(), F.format_string(" (%.2f%%)", "difference_pct")).otherwise("")))
    rows = results.groupBy("accession").agg(F.array_sort(F.collect_list(failed)).alias("failed"), F.count_if(~F.col("passed")).alias("n_failed"), F.count("*").alias("n_checks"))
    return rows.where("n_failed > 0")


def flatten_facts(adj: DataFrame) -> DataFrame:
    """(accession, period, section, concept, value, ticker) from a nested map of a filing's periods, sections and concepts."""
    p = adj.select("accession", F.coalesce("ticker", F.lit("N/A")).alias("ticker"), F.explode("periods").alias("period", "sections"))
    s = p.select("accession", "ticker", "period", F.explode("sections").alias("section", "concepts"))
    return s.select("accession", "period", "section", F.explode("concepts").alias("concept", "value"), "ticker")
