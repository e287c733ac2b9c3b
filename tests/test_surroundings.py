"""Guidance: the surroundings of matches against plain patterns, and texts dealt to many tasks."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from quillstone.operators import filing_text as T
from quillstone.plans import guidance

PIECES = (
    "Three Months Ended", "nine  months ended", "Reported revenue", "achieved", "actual", "net sales", "increased to $", "Net Sales decreased ", "diluted earnings per share $", "Unaudited; ($", "preliminary $", "expects", "expecting revenue", "EXPECT net sales",
    "outlook for", "guidance:", "Fiscal 2024 Outlook", "2024 Guidance", "anticipates ", "projects", "forecast ", "raised guidance", "previously raised guidance", "lowered outlook", "reduces forecast", "reaffirmed guidance", "reiterated outlook", "maintains guidance",
    "confirmed forecast", "narrowed range", "tightens guidance", "revenue", "revenues", "exome and genome revenue", "Exome  and genome", "cash,", "one-time benefit", "$5 to all revenue", "é", "ſ", "revenueK", "reviſed", " to ", "x", ", ", ". ", "\n",
)


def _plain(left: str, raw: str, right: str) -> tuple:
    """What is to be found, by one pass of each pattern."""
    def has(text: str, *patterns: str) -> bool:
        return any(T._compiled(f"(?iU){p}").search(text) for p in patterns)

    def distance(pattern: str) -> int | None:
        before = left[-150:]
        found = list(T._compiled(pattern).finditer(before))
        return len(before) - found[-1].end() if found else None

    near, wide = left[-200:] + raw + right[:200], left[-500:] + raw + right[:100]
    prior = next((label for label, p in T.CHANGES if has(near, p)), None)
    prior = "maintained" if prior in ("raised", "lowered") and has(near, T.HISTORICAL) else prior
    special, plain = distance(T.SPECIAL_METRIC[1]), distance(T.PLAIN_METRIC[1])
    metric = T.PLAIN_METRIC[0] if plain is not None else None
    if special is not None and (special < 70 or plain is None or special <= plain):
        metric = T.SPECIAL_METRIC[0]
    return not has(wide, *T.RESULTS_CONTEXT) and has(wide, *T.GUIDANCE_CONTEXT), prior, None if has(right[:35], *T.METRIC_STOPS) else metric


def test_surroundings_are_read_as_by_each_pattern(spark):
    r = random.Random(4)
    side = lambda n: "".join(r.choice(PIECES) + r.choice(["", " ", " "]) for _ in range(r.randint(0, n)))
    rows = [(side(r.choice((3, 6, 60))), "$10 million", side(12)) for _ in range(3000)]
    df = spark.createDataFrame([(i, (left, raw, right)) for i, (left, raw, right) in enumerate(rows)], "i int, m struct<left:string,raw:string,right:string>")
    m = F.col("m")
    got = [tuple(x)[1:] for x in df.select("i", T.forward_looking(m), T.vs_prior(m), T.revenue_metric(m)).orderBy("i").collect()]
    want = [_plain(*row) for row in rows]
    assert [(row, a, b) for row, a, b in zip(rows, got, want, strict=True) if a != b] == []
    assert len(set(want)) > 15


def test_texts_of_one_small_file_are_dealt_to_tasks(spark, sf_dir):
    assert guidance._texts(spark, sf_dir, "x").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
