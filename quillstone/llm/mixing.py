"""Mixing sources to target weights: budgets for the leaves of a tree, filled by seeded epochs.

Weights go down a tree of columns (say domain, language, source). What a node cannot use goes to
its siblings first, and only then, through its parent, to the parent's siblings. A leaf's budget
is filled with whole epochs of its rows and, of the last epoch, the rows that come first in a
seeded order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import load, text_udf, use_checkpoints

#: Rows of a leaf that share one range of the seeded order, about.
RANGE_ROWS = 2000
#: A table of cuts is broadcast up to so many rows.
MAX_BROADCAST_CUTS = 100_000
_UNIT = float(1 << 53)


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; 0 for null."""
    return text_udf("n long", lambda: lambda t: (len(t.encode().split()),))(text).getField("n")


def _weights(df: DataFrame, level: str, weights: Mapping[str, float]) -> DataFrame:
    """`df` with _w: the weight given for a node's name at this level, else 1."""
    case = F.lit(1.0)
    for name, w in weights.items():
        case = F.when(F.col(level) == name, float(w)).otherwise(case)
    return df.withColumn("_w", case)


def share_out(children: DataFrame, parents: Sequence[str], level: str) -> DataFrame:
    """Adds _budget to the children (with _w, _cap and the parent's _from).

    Each gets the smaller of its capacity and a rate times its weight; the rate is such that the
    parent's budget is used up, if the capacities allow it. Children are taken in the order of
    capacity by weight: as long as all of a child's capacity is used, the rest is shared by the
    weights that remain.
    """
    full = F.when(F.col("_w") > 0, F.col("_cap") / F.col("_w"))
    order = Window.partitionBy(*parents).orderBy(F.asc_nulls_last("_full"), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*parents)
    rows = children.withColumn("_full", full)
    rows = rows.withColumn("_used", F.coalesce(F.sum("_cap").over(before), F.lit(0.0))).withColumn(
        "_left", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    # the rate if this child and all after it are limited by the rate; the first child with a smaller one than its own sets it
    rate = F.when(F.col("_left") > 1e-12, (F.col("_from") - F.col("_used")) / F.col("_left"))
    rows = rows.withColumn("_rate", F.when(F.col("_full") >= rate - 1e-9, rate))
    set_rate = F.first("_rate", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("_rate", set_rate)
    budget = F.when(F.col("_w") <= 0, 0.0).when(F.col("_rate").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.greatest(F.lit(0.0), F.col("_rate") * F.col("_w"))))
    return rows.withColumn("_budget", budget).drop("_full", "_used", "_left", "_rate")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], total: Column | float, weights: Mapping[str, Mapping[str, float]], epochs: int) -> DataFrame:
    """`leaves` (levels, _tokens) with _budget, in tokens: at most `epochs` times what a leaf has."""
    nodes = leaves.withColumn("_cap", F.col("_tokens") * float(epochs))
    above = nodes.agg(F.sum("_tokens").cast("double").alias("_all")).select((F.lit(total) if isinstance(total, float) else total).alias("_from"), F.lit(0).alias("_root"))
    parents: list[str] = ["_root"]
    for i, level in enumerate(levels):
        down = nodes.withColumn("_root", F.lit(0)).groupBy("_root", *levels[: i + 1]).agg(F.sum("_cap").alias("_cap"))
        down = _weights(down.join(above, parents), level, weights.get(level, {}))
        above = share_out(down, parents, level).select("_root", *levels[: i + 1], F.col("_budget").alias("_from"))
        parents = ["_root", *levels[: i + 1]]
    return leaves.join(above.drop("_root"), list(levels)).withColumnRenamed("_from", "_budget")


def _place(seed: int, epoch: Column, key: Column) -> Column:
    """A row's place in an epoch's order, in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, key), 11) / F.lit(_UNIT)


def mix_sources(
    df: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]] | None = None,
    share: float = 0.5,
    epochs: int = 2,
    seed: int = 17,
    text: str = "text",
    doc_id: str = "doc_id",
    count: Callable[[Column], Column] = word_count,
    place_by: Sequence[str] | None = None,
) -> DataFrame:
    """The rows chosen for the mixture, with n_tokens and epoch (from 0); a row may come once in each epoch.

    The budget is `share` of all tokens as `count` counts them (words between blanks;
    tokens.token_count() takes a vocabulary's). `weights` maps a level to the
    weights of its names, 1 where none is given. Nulls in a level are a name of their own (empty
    text). Of a partial epoch, the rows in seeded order are taken while their sum stays within
    the budget; a row's place is drawn from the columns `place_by` (doc_id and text if none are
    named), and rows that are equal in them are taken together or not at all. Rows without
    tokens take no budget and come in whenever their place does. No text is shuffled: places are
    ranged by hash, and only the range in which a leaf's budget ends is sorted.
    """
    use_checkpoints(df.sparkSession)
    names = [f"_level{i}" for i in range(len(levels))]
    given = {n: (weights or {}).get(c, {}) for n, c in zip(names, levels, strict=True)}
    key = F.xxhash64(*[F.col(f"`{c}`") for c in place_by or (doc_id, text)])
    own = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("_own")
    rows = df.select(own, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels, strict=True)], key.alias("_key"), F.col(f"`{text}`").alias("_text"))
    sizes = rows.select(*names, "_key", count(F.col("_text")).alias("_tokens")).checkpoint()
    leaves = sizes.groupBy(*names).agg(F.sum("_tokens").alias("_tokens"), F.count("*").alias("_rows"))
    budgets = leaf_budgets(leaves, names, F.col("_all") * share, given, epochs)
    # whole epochs, and what is left for the last one
    budgets = budgets.withColumn("_whole", F.when(F.col("_tokens") > 0, F.floor(F.col("_budget") / F.col("_tokens") + 1e-9)).otherwise(F.lit(0)).cast("int"))
    budgets = budgets.withColumn("_rest", F.col("_budget") - F.col("_whole") * F.col("_tokens")).withColumn("_ranges", F.ceil(F.col("_rows") / RANGE_ROWS)).checkpoint()
    small = F.broadcast if budgets.count() <= MAX_BROADCAST_CUTS else (lambda x: x)

    placed = sizes.join(small(budgets.select(*names, "_whole", "_rest", "_ranges")), names)
    placed = placed.withColumn("_at", _place(seed, F.col("_whole"), F.col("_key"))).withColumn("_range", F.floor(F.col("_at") * F.col("_ranges")))
    ranges = placed.groupBy(*names, "_range").agg(F.sum("_tokens").alias("_sum"), F.first("_rest").alias("_rest"))
    along = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_sum").over(along), F.lit(0)))
    # the range in which the sum first passes the rest; all ranges before it are taken whole
    passing = ranges.where(F.col("_before") + F.col("_sum") > F.col("_rest") + 1e-6).groupBy(*names).agg(F.min("_range").alias("_range"))
    passing = passing.join(ranges.select(*names, "_range", "_before"), [*names, "_range"])
    inside = placed.join(small(passing), [*names, "_range"]).groupBy(*names, "_at", "_before", "_rest").agg(F.sum("_tokens").alias("_sum"))
    up_to = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    over = inside.withColumn("_sum", F.sum("_sum").over(up_to) + F.col("_before")).where(F.col("_sum") > F.col("_rest") + 1e-6)
    cuts = over.groupBy(*names).agg(F.min("_at").alias("_cut"))
    cuts = budgets.join(cuts, names, "left").select(*names, "_whole", F.when(F.col("_rest") > 1e-6, F.coalesce("_cut", F.lit(1.0))).otherwise(0.0).alias("_cut")).checkpoint()

    chosen = rows.join(small(cuts), names).withColumn("_last", F.when(_place(seed, F.col("_whole"), F.col("_key")) < F.col("_cut"), 1).otherwise(0))
    times = F.col("_whole") + F.col("_last")
    # only what is chosen is counted again
    copies = chosen.where(times > 0).withColumn("_tokens", count(F.col("_text"))).withColumn("_epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    kept = [(i, c) for i, c in enumerate(df.columns) if c.lower() not in ("n_tokens", "epoch")]
    return copies.select(*[F.col(f"_own.c{i}").alias(c) for i, c in kept], F.col("_tokens").alias("n_tokens"), F.col("_epoch").alias("epoch"))


def domain_of(source: str = "source") -> Column:
    """The domain of a source name: its number by four, as the tables name no domains."""
    return F.concat(F.lit("domain"), (F.coalesce(F.regexp_extract(source, r"(\d{1,9})", 1).try_cast("long"), F.lit(0)) % 4).cast("string"))


#: The production mixture: levels, and weights of names (1 where none is given).
LEVELS = ("domain", "lang", "source")
WEIGHTS = {"domain": {"domain0": 3.0, "domain1": 2.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0}}


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """mix_sources() of a documents table by the production mixture, with the derived domain."""
    return mix_sources(docs.withColumn("domain", domain_of()), LEVELS, WEIGHTS, **how)


def op8_mixture(spark, sf_dir: str) -> DataFrame:
    return mix_documents(load(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")
