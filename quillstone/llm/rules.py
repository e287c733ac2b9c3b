"""Quality rules: an ordered decision list learned by sequential covering.

Each rule is a conjunction of thresholds on statistics of a text. A rule is grown on two
thirds of the labelled rows that no earlier rule covers, pruned on the rest, and kept while it
is precise there. The list becomes one Spark CASE expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import load, text_udf, with_struct

#: Words are runs of other characters than these.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS, MARKS, UPPER = b"#*$%&|<>", b"!?|", bytes(range(ord("A"), ord("Z") + 1))
#: Labelled rows that a fit takes at most; the ones with the smallest hashes of doc_id.
MAX_LABELLED = 20_000
#: The base conditions: words that a text has at least, and the share of them in repeated windows, in percent, at most.
LEAST_WORDS, MOST_REPEATED_PCT = 50, 50

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
RATIOS = ("symbols_per_word", "dup_line_share", "repeat_share", "mean_word", "upper_share", "mark_share", "distinct_share", "twin_share")
STATS = BASE + "".join(f", {r} double" for r in RATIOS)
STAT_NAMES = [f.split()[0] for f in STATS.split(", ")]

def repeated_words(words: Sequence[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    k = len(ids)
    if k < 2_000_000:
        keys = (a[:-2] * k + a[1:-1]) * k + a[2:]
    else:  # three numbers would not fit into 64 bits
        pairs = np.unique(a[:-1] * k + a[1:], return_inverse=True)[1]
        keys = pairs[:-1] * k + a[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + n] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def count_of(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def text_statistics(text: str) -> tuple:
    """The STATS of one text; ratios of nothing are 0."""
    data = text.encode()
    words = data.split()  # bytes are split at the blanks named in the module's contract, and at no others
    n = len(words)
    if not n:
        return (0,) * 5 + (0.0,) * len(RATIOS)
    lines, dup = duplicate_lines(data)
    chars, symbols, repeated = len(text) - count_of(data, BLANKS), count_of(data, SYMBOLS), repeated_words(words)
    upper, marks = count_of(data, UPPER), count_of(data, MARKS)
    twins = sum(map(bytes.__eq__, words, words[1:]))
    return (n, chars, symbols, dup, repeated, symbols / n, dup / max(lines, 1), repeated / n, chars / n, upper / chars, marks / n, len(set(words)) / n, twins / n)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with the STATS columns; null and empty texts have zeros."""
    return with_struct(df, text_udf(STATS, lambda: text_statistics)(F.col(text)), STAT_NAMES)


class Condition(NamedTuple):
    """A statistic at or above a bound, or below it."""

    name: str
    above: bool
    bound: float

    def column(self) -> Column:
        return F.col(self.name) >= self.bound if self.above else F.col(self.name) < self.bound

    def holds(self, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
        v = x[:, names.index(self.name)]
        return v >= self.bound if self.above else v < self.bound


Rule = tuple[Condition, ...]


def covered(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: Sequence[str], most: int) -> Rule:
    """Adds the condition of the largest information gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < most and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, choice = 1e-9, None
        for j, name in enumerate(names):
            order = np.argsort(x[inside, j], kind="stable")
            v, b = x[inside, j][order], bad[inside][order]
            below_p, below_n = np.concatenate([[0], np.cumsum(b)]), np.concatenate([[0], np.cumsum(~b)])
            cuts = np.flatnonzero(v[1:] > v[:-1]) + 1
            for above in (True, False):
                p, n = (p0 - below_p[cuts], n0 - below_n[cuts]) if above else (below_p[cuts], below_n[cuts])
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                if len(gain) and gain.max() > best:
                    i = int(gain.argmax())
                    best, choice = gain[i], Condition(name, above, float((v[cuts[i]] + v[cuts[i] - 1]) / 2))
        if choice is None:
            break
        rule += (choice,)
        inside &= choice.holds(x, names)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> Rule:
    """The beginning of the rule with the largest (p - n) / (p + n) on rows that it was not grown on."""

    def worth(r: Rule) -> float:
        inside = covered(r, x, names)
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:i] for i in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)), default=())


def learn_rules(
    x: np.ndarray, bad: np.ndarray, names: Sequence[str], most_rules: int = 12, most_conditions: int = 4, precision: float = 0.9, seed: int = 7
) -> list[Rule]:
    """Rules for the bad rows, in order, by sequential covering.

    Learning stops at a rule that covers no bad row of the pruning rows, or under `precision`.
    Without rows of both kinds there are no rules.
    """
    rules: list[Rule] = []
    order = np.random.default_rng(seed).permutation(len(x))
    x, bad = x[order], bad[order]
    while len(rules) < most_rules and bad.any() and not bad.all():
        third = np.arange(len(x)) % 3 == 0
        rule = _prune(_grow(x[~third], bad[~third], names, most_conditions), x[third], bad[third], names)
        inside = covered(rule, x, names)
        p, n = (inside & third & bad).sum(), (inside & third & ~bad).sum()
        if not rule or p == 0 or p < precision * (p + n):
            break
        rules.append(rule)
        x, bad = x[~inside], bad[~inside]
    return rules


def rejecting_rule(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that holds, from 1; null if none does."""
    case = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        both = rule[0].column()
        for c in rule[1:]:
            both = both & c.column()
        case = F.when(both, F.lit(i)).otherwise(case)
    return case


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text and quality of at most `most` labelled rows, the ones with the smallest hashes of doc_id.

    Labels without a doc_id or a quality are left out; only the sample of labels, never texts, is broadcast.
    """
    labels = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
    few = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")


def labelled_statistics(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED):
    """A pandas frame of doc_id, STATS and quality of the labelled sample: `most` rows at most, one for each doc_id.

    Of several rows or labels of a doc_id the smallest statistics count. They are computed of
    sampled rows only, and summed up before any shuffle.
    """
    rows = with_statistics(labelled_sample(docs, labels, most))
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*STAT_NAMES, "quality")).alias("_s")).select("doc_id", "_s.*")
    return one.toPandas().sort_values("doc_id", ignore_index=True)


def fit_rules(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, **how) -> list[Rule]:
    """The decision list for quality 0, learned from a bounded sample of the labelled documents.

    Documents that the base conditions fail are left out, as no rule is asked about them; that is
    done with the fetched sample, so that no filter computes statistics of other documents.
    """
    frame = labelled_statistics(docs, labels, most)
    frame = frame[(frame["n_words"] >= LEAST_WORDS) & (100 * frame["n_repeat_words"] <= MOST_REPEATED_PCT * frame["n_words"])]
    names = [n for n in STAT_NAMES if n not in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return learn_rules(frame[names].to_numpy(float), frame["quality"].to_numpy() == 0, names, **how)


def apply_rules(df: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """`df` with the STATS columns, base_failed, rule_no (the rule that rejects) and kept.

    Null and empty texts have no words and fail the base conditions. Columns named like a new
    one are replaced. No shuffle.
    """
    fresh = df.drop("base_failed", "rule_no", "kept")
    judged = with_statistics(fresh, text).withColumn("base_failed", base_failed()).withColumn("rule_no", rejecting_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule_no").isNull())


def quality_rules(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, **how) -> DataFrame:
    """Learns the decision list from `labels` and applies it to all of `docs`."""
    return apply_rules(docs, fit_rules(docs, labels, most, **how))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, load(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule_no")
