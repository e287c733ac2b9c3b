"""How far the sources of a language differ from each other, and each from its language, term by term.

A group is a language and a source. Its profile p gives each term of the language an integer
share of 10^9, smoothed by one occurrence, and its divergence from a profile q is the sum of
(p - q)^2 / q, each term floored. Terms are counted within tasks and then by key; the terms of a
language become an index with one row for each term, which holds the term's counts by source.

Pairs are summed row by row, as in a sparse product after Gustavson: a group scatters its terms
through the rows of the index into a dense accumulator with a place for each peer. So no pair of
entries of the index becomes a row of data. The accumulators hold only what terms add that both
sides have; a term that one side lacks, or both, has that side's share of an absent term, and a
group's numbers of terms of each count are enough to add up those.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.common import load, written

LEAST_DOCS, UNITS, TOP = 3, 1_000_000_000, 200
#: Counted entries that a task holds before it hands them on.
HELD = 400_000
#: Entries of the index that are scattered as one block, and products that are made at once.
BLOCK, PRODUCTS = 100_000, 1_000_000

#: A-Z become small, other ASCII characters that are no letters become blanks; bytes over 127 stay.
_LETTERS = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x > 127 else 32 for x in range(256))

COUNTED = "lang string, source string, term string, n long, docs long"


def terms(data: bytes) -> list[bytes]:
    """The runs of letters and characters beyond ASCII, with A-Z lower-cased."""
    return data.translate(_LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTED from lang, source and text; one with an empty term for each group that occurs."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            n[b""], docs[b""] = 0, 0
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)), pa.array(list(n), pa.binary()).cast(pa.string())]
                + [pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )

    for b in batches:
        texts = b.column(2).cast(pa.binary())
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            found = Counter(terms(text.as_py()))
            held -= len(n)
            n.update(found)
            docs.update(found.keys())
            held += len(n)
            if held > HELD:
                yield from rows()
                counts, held = {}, 0
    yield from rows()


def count_terms(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, nulls read as ''.

    Each group has one more row with an empty term.
    """
    rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    return rows.mapInArrow(_count, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def term_index(counted: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, postings): the kept terms of each language with their (source, n), as many as it has sources.

    The row with an empty term lists all sources of the language.
    """
    found = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings"))
    return found.where((F.col("docs") >= least) | (F.col("term") == "")).select("lang", "term", "total", "postings")


@dataclass
class Lang:
    """A language's V and its sources' N, in the sources' order."""

    sources: list[str]
    number: dict[str, int]
    sums: np.ndarray
    v: int

    def shares(self, counts: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """1 + floor(UNITS * (count + 1) / (N + V)), exactly: three digits of UNITS at a time."""
        whole = self.sums[at] + self.v
        out, left = np.divmod(counts + 1, whole)
        for _ in range(3):
            digit, left = np.divmod(left * 1000, whole)
            out = out * 1000 + digit
        return out + 1

    def absent(self) -> np.ndarray:
        return self.shares(np.zeros(len(self.sums), np.int64)) if self.v else np.ones(len(self.sums), np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so squares fit."""
    return (p - q) * (p - q) // q


def _languages(index: DataFrame) -> dict[str, Lang]:
    """V and N of all groups. The result has a row for each pair of a language's groups, so the groups are few."""
    each = index.select("lang", "term", F.inline("postings")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = {r.lang: r.v for r in index.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("v")).collect()}
    by: dict[str, list[tuple[str, int]]] = {}
    for r in each.collect():
        by.setdefault(r.lang, []).append((r.source, r.n))
    out = {}
    for lang, found in by.items():
        names = sorted((s for s, _ in found))
        n = dict(found)
        out[lang] = Lang(names, {s: i for i, s in enumerate(names)}, np.array([n[s] for s in names], np.int64), kept[lang])
    return out


PAIR_SUMS = "lang string, i int, j int, value long"


def _pair_rows(lang: str, i: int | np.ndarray, j: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang, pa.string()), len(j)), pa.array(np.broadcast_to(i, len(j)), pa.int32()), pa.array(j, pa.int32()), pa.array(value, pa.int64())],
        names=["lang", "i", "j", "value"],
    )


def scatter(of: Lang, starts: np.ndarray, source: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(i, accumulator over peers) of each group in a block of the index.

    Term t's postings are those from starts[t] up to starts[t + 1]. For each term that group i
    and peer j both have, f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) is added.
    """
    zero, share = of.absent(), of.shares(counts, source)
    sizes = np.diff(starts)
    term_of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(source, kind="stable")
    cuts = np.flatnonzero(np.diff(source[order])) + 1
    for entries in np.split(order, cuts):
        i = int(source[entries[0]])
        row = np.zeros(len(zero), np.int64)
        reach = np.cumsum(sizes[term_of[entries]])
        for part in np.split(entries, np.flatnonzero(np.diff(reach // PRODUCTS)) + 1):
            n = sizes[term_of[part]]
            first = np.cumsum(n) - n
            at = np.repeat(starts[term_of[part]] - first, n) + np.arange(n.sum())  # the postings of each term of the group
            j, p, q = source[at], np.repeat(share[part], n), share[at]
            p0, q0 = zero[i], zero[j]
            np.add.at(row, j, gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0))
        yield i, row


def _overlaps(languages: dict[str, Lang]):
    """Rows of PAIR_SUMS from lang and postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, tuple[list[np.ndarray], list[np.ndarray], list[int]]] = {}
        n = 0

        def done() -> Iterator[pa.RecordBatch]:
            for lang, (sources, counts, sizes) in blocks.items():
                for i, row in scatter(languages[lang], np.cumsum([0, *sizes]), np.concatenate(sources), np.concatenate(counts)):
                    j = np.flatnonzero(row)
                    yield _pair_rows(lang, i, j, row[j])
            blocks.clear()

        for b in batches:
            for k, lang in enumerate(b.column(0).to_pylist()):
                found = b.column(1)[k].values
                held = blocks.setdefault(lang, ([], [], []))
                number = languages[lang].number
                held[0].append(np.array([number[s] for s in found.field(0).to_pylist()], np.int64))
                held[1].append(found.field(1).to_numpy(zero_copy_only=False))
                held[2].append(len(found))
                n += len(found)
                if n > BLOCK:
                    yield from done()
                    n = 0
        yield from done()

    return run


def _baselines(languages: dict[str, Lang]):
    """Rows of PAIR_SUMS from lang, source and how many terms have each count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, (lang, source) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                of = languages[lang]
                i, zero, peers = of.number[source], of.absent(), np.arange(len(of.sources))
                counts, times = (b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (2, 3))
                own = of.shares(counts, np.full(len(counts), i))
                as_p, as_q = np.zeros(len(peers), np.int64), np.zeros(len(peers), np.int64)
                for p, n in zip(own, times, strict=True):
                    as_p += n * (gap(p, zero) - gap(zero[i], zero))
                    as_q += n * (gap(zero, p) - gap(zero, zero[i]))
                yield _pair_rows(lang, i, peers, as_p)
                yield _pair_rows(lang, peers, np.full(len(peers), i), as_q)

    return run


def pair_divergences(index: DataFrame, languages: dict[str, Lang]) -> DataFrame:
    """(lang, source, item, value) for each source of a language and each other one."""
    spark = index.sparkSession
    entries = index.where("term <> ''")
    both = entries.select("lang", "postings").mapInArrow(_overlaps(languages), PAIR_SUMS)
    times = entries.select("lang", F.inline("postings")).groupBy("lang", "source", "n").count()
    # the different counts of a group, dealt to several rows; what they add is summed afterwards
    part = F.pmod(F.xxhash64("n"), F.lit(16))
    lists = times.groupBy("lang", "source", part.alias("part")).agg(F.collect_list("n").alias("counts"), F.collect_list("count").alias("times"))
    either = lists.select("lang", "source", "counts", "times").mapInArrow(_baselines(languages), PAIR_SUMS)
    sums = both.unionByName(either).groupBy("lang", "i", "j").agg(F.sum("value").alias("more"))
    rows = [(lang, k, s, int(z), of.v) for lang, of in languages.items() for k, (s, z) in enumerate(zip(of.sources, of.absent(), strict=True))]
    groups = spark.createDataFrame(rows, "lang string, i int, source string, zero long, v long")
    peers = groups.select("lang", F.col("i").alias("j"), F.col("source").alias("item"), F.col("zero").alias("q0"))
    pairs = groups.join(F.broadcast(peers), "lang").where("i <> j").join(sums, ["lang", "i", "j"], "left")
    floor = F.expr("v * ((zero - q0) * (zero - q0) div q0)")
    return pairs.select("lang", "source", "item", (floor + F.coalesce("more", F.lit(0))).alias("value"))


def term_divergences(index: DataFrame, languages: dict[str, Lang], top: int = TOP) -> DataFrame:
    """(lang, source, item, value): the terms that a group has with a greater share than its language, the first `top` of each."""
    spark = index.sparkSession
    rows = [(lang, s, int(n) + of.v, int(of.sums.sum()) + of.v) for lang, of in languages.items() for s, n in zip(of.sources, of.sums, strict=True)]
    groups = spark.createDataFrame(rows, "lang string, source string, own long, whole long")
    entries = index.where("term <> ''").select("lang", F.col("term").alias("item"), "total", F.inline("postings")).where("n > 0")
    share = "cast({n} + 1 as decimal(20, 0)) * %d div cast({by} as decimal(20, 0)) + 1" % UNITS
    both = entries.join(F.broadcast(groups), ["lang", "source"]).select("lang", "source", "item", F.expr(share.format(n="n", by="own")).alias("p"), F.expr(share.format(n="total", by="whole")).alias("q"))
    found = both.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= top).drop("_n")


def divergence_audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Parts `pair` and `term`: (lang, source, part, item, value, rank), as the contract of op12_divergence says.

    Nulls are read as ''. A group without terms takes part with all counts zero, a language
    without kept terms has pairs of value 0 and no terms, a language with one source has no
    pairs, and an empty table gives no rows. Repeated rows count as documents of their own. Other
    columns are not read. The groups' names and sums are collected: the result has a row for each
    pair of them, so there are at most as many as its root.
    """
    index = written(term_index(count_terms(df, text, lang, source), least))
    languages = _languages(index)
    parts = pair_divergences(index, languages).withColumn("part", F.lit("pair")).unionByName(term_divergences(index, languages, top).withColumn("part", F.lit("term")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return parts.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(load(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), groups AS (SELECT DISTINCT lang, source FROM docs
), found AS MATERIALIZED (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL
), v AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang
), sums AS (SELECT lang, source, coalesce(sum(n), 0) AS own FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1)) // (own + v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (total + 1)) // (whole + v) AS q
  FROM sums JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), others AS (SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
  SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM others LEFT JOIN pairs USING (lang, source, item)
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 200
"""
