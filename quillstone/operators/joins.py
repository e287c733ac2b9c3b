"""Lookups, trees, work sets and as-of joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def exchange_for_accessions(index: DataFrame, companies: DataFrame, accessions: DataFrame) -> DataFrame:
    """(accession, exchange) of filings whose company has an exchange."""
    listed = companies.where(F.trim(F.coalesce("exchange", F.lit(""))) != "").select("cik", "exchange")
    return accessions.select("accession").distinct().join(index.select("accession", "cik"), "accession").join(listed, "cik").groupBy("accession").agg(F.min("exchange").alias("exchange"))


def company_names(index: DataFrame, accessions: DataFrame) -> DataFrame:
    """(accession, company_name) of the given filings; of several names the first in order."""
    return index.join(accessions.select("accession").distinct(), "accession", "left_semi").groupBy("accession").agg(F.min("company_name").alias("company_name"))


def filing_metadata(index: DataFrame, accessions: DataFrame) -> DataFrame:
    """One index row for each accession, whose .txt suffix is ignored: the latest filed, then the first file name."""
    wanted = accessions.select(F.regexp_replace("accession", r"\.txt$", "").alias("accession")).distinct()
    first = Window.partitionBy("accession").orderBy(F.desc_nulls_last("date_filed"), "filename")
    return index.join(wanted, "accession").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def listed_with_exchange(other: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Listings with the exchange's name, or its code where that is unknown."""
    names = exchanges.select(F.col("symbol").alias("_code"), F.col("name").alias("_name"))
    return other.join(names, other["exchange"] == F.col("_code"), "left").withColumn("exchange_name", F.coalesce("_name", "exchange")).drop("_code", "_name")


def _tree(categories: DataFrame) -> DataFrame:
    """(category_id, name, parent_id, full_path, path, depth): one row for each way from a root.

    Roots have no parent or are category 0 itself. Each row holds the piece of its way that is known
    and points to the category above the piece; a round joins every open piece with the pieces of
    that category, which doubles it, so the rounds are the logarithm of the depth. Rows that
    reach no root, by a missing parent or a cycle, do not appear; a cycle that a root reaches is an
    error that names it.
    """
    from quillstone.operators.checkpoints import use_checkpoints

    use_checkpoints(categories.sparkSession)
    rows = categories.select("category_id", "name", "parent_id")
    root = F.col("parent_id").isNull() | ((F.col("parent_id") == 0) & (F.col("category_id") == 0))
    own = F.array("category_id")
    # `loop` holds a cycle's categories: such a row only looks whether a root is above it
    pieces = rows.where(root | (F.col("category_id") != F.col("parent_id"))).select(
        "*", F.when(root, None).otherwise(F.col("parent_id")).alias("up"), root.alias("done"), F.col("name").alias("full_path"), own.alias("path"), F.when(F.lit(False), own).alias("loop")
    )
    state = pieces.checkpoint()
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        ended = state.where("done")
        left = state.where("not done")
        if left.isEmpty():
            break
        above = state.where("loop IS NULL").select(F.col("category_id").alias("_id"), F.col("up").alias("_up"), F.col("done").alias("_done"), F.col("full_path").alias("_full"), F.col("path").alias("_path"))
        met = left.join(above, F.col("up") == F.col("_id"))
        again = F.arrays_overlap("_path", "path") & F.col("loop").isNull()
        loop = F.when(again, F.array_distinct(F.concat("_path", "path"))).otherwise(F.col("loop"))
        longer = met.select(
            "category_id",
            "name",
            "parent_id",
            F.col("_up").alias("up"),
            F.col("_done").alias("done"),
            F.when(loop.isNull(), F.concat("_full", F.lit(" / "), "full_path")).alias("full_path"),
            F.when(loop.isNull(), F.concat("_path", "path")).otherwise(F.col("path")).alias("path"),
            loop.alias("loop"),
        )
        # of the rows that look for a root from one cycle, one is enough
        searching = longer.where("loop IS NOT NULL").dropDuplicates(["category_id", "up", "done"])
        state = ended.unionByName(longer.where("loop IS NULL")).unionByName(searching).checkpoint()
    cycle = state.where("done AND loop IS NOT NULL").select("loop").limit(1).collect()
    if cycle:
        raise ValueError(f"the tree has a cycle: {cycle[0].loop}")
    return state.where("done").select("category_id", "name", "parent_id", "full_path", "path", (F.size("path") - 1).alias("depth"))


def category_paths(categories: DataFrame) -> DataFrame:
    """(category_id, name, parent_id, full_path), the names from the root joined by slashes."""
    return _tree(categories).select("category_id", "name", "parent_id", "full_path")


def category_depths(categories: DataFrame) -> DataFrame:
    """(category_id, name, parent_id, path, depth), the path as an array of ids."""
    return _tree(categories).select("category_id", "name", "parent_id", "path", "depth")


def category_analysis(categories: DataFrame) -> DataFrame:
    """(category_id, name, parent_id, is_branch, child_count, parent_count); the depth of unreached categories is 0."""
    children = categories.groupBy(F.col("parent_id").alias("category_id")).agg(F.count("*").alias("child_count"))
    depths = category_depths(categories).select("category_id", "depth")
    rows = categories.select("category_id", "name", "parent_id").join(children, "category_id", "left").join(depths, "category_id", "left")
    count = F.coalesce("child_count", F.lit(0))
    return rows.select("category_id", "name", "parent_id", (count > 0).alias("is_branch"), count.alias("child_count"), F.coalesce("depth", F.lit(0)).alias("parent_count"))


def leaf_series(paths: DataFrame, analysis: DataFrame, series: DataFrame, like: str, not_like: Sequence[str] = (), min_end: str | None = None) -> DataFrame:
    """Series of leaf categories whose path fits the patterns and that reach `min_end` (compared as text), in order."""
    chosen = paths.where(F.col("full_path").like(like))
    for pattern in not_like:
        chosen = chosen.where(~F.col("full_path").like(pattern))
    leaves = analysis.where(~F.col("is_branch")).select("category_id")
    rows = series if min_end is None else series.where(F.col("observation_end").cast("string") >= min_end)
    return rows.join(chosen.select("category_id").join(leaves, "category_id"), "category_id").select("series_id").orderBy("series_id")


def per_filing(rows: DataFrame) -> DataFrame:
    """Rows that grow with the filings, never to be broadcast: a packed file of 8 MB may hold more rows than a driver does."""
    return rows.hint("merge")


def inline_contexts(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts with their context's entity, scheme suffix, period and dimensions; facts of unknown contexts stay."""
    c = contexts.select(
        "accession",
        F.col("contextRef"),
        F.substring_index("scheme", "/", -1).alias("entity_scheme"),
        F.col("identifier").alias("entity_identifier"),
        F.col("instant").alias("period_instant"),
        F.col("startDate").alias("period_start"),
        F.col("endDate").alias("period_end"),
        "dimensions",
    )
    return facts.join(per_filing(c), ["accession", "contextRef"], "left")


def with_units(facts: DataFrame, units: DataFrame) -> DataFrame:
    """Facts with the numerator and denominator of their unit."""
    return facts.join(per_filing(units.select("accession", "unitRef", "numerator", "denominator")), ["accession", "unitRef"], "left")


def with_labels(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """Facts with the first label of their concept."""
    first = labels.groupBy("accession", "concept").agg(F.min_by("label", "ord").alias("label"))
    return facts.drop("label").join(first, ["accession", "concept"], "left")


def fact_footnotes(links: DataFrame, notes: DataFrame) -> DataFrame:
    """(accession, fact_id, footnote_id, text) of every link, the text null where the note is unknown."""
    return links.join(notes, ["accession", "footnote_id"], "left").select("accession", "fact_id", "footnote_id", "text")


def pending_quarters(calendar: DataFrame, loaded: DataFrame, ledger: DataFrame) -> DataFrame:
    """Quarters that are not loaded and, if the ledger has them, may be tried again."""
    keys = ["year", "quarter"]
    rows = calendar.join(loaded.select(*keys).distinct(), keys, "left_anti").join(ledger.select(*keys, "status"), keys, "left")
    return rows.where(F.col("status").isNull() | F.col("status").isin("pending", "failed")).select(*keys).orderBy(*keys)


def tickers_to_refresh(tickers: DataFrame, updated: DataFrame) -> DataFrame:
    """Tickers that were not updated today, in order."""
    return tickers.select("ticker").distinct().join(updated.select("ticker"), "ticker", "left_anti").orderBy("ticker")


def _last_before(both: DataFrame, by: Sequence[str], order: Sequence[Column], ranges: int | None) -> DataFrame:
    """Rows of _side 1 with _last: the last _v that is not null at or before them in the order, key by key.

    With `ranges`, rows are dealt by key and order to so many ranges, so that a key with most of
    the rows is shared by many tasks: each range looks for values of its own, and takes the last
    one of the ranges before it.
    """
    keys = list(by)
    if ranges is not None:
        from quillstone.operators.checkpoints import use_checkpoints

        use_checkpoints(both.sparkSession)
        # written, as the numbers of the ranges are used twice
        both = both.repartitionByRange(ranges, *by, *order).withColumn("_range", F.spark_partition_id()).checkpoint()
        keys.append("_range")
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_last", F.last("_v", ignorenulls=True).over(upto)).where("_side = 1")
    if ranges is not None:
        # one row for each key and range: as many for a key as there are ranges at most
        numbered = both.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        ends = numbered.groupBy(*keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_end"))
        before = F.last("_end", ignorenulls=True).over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
        carried = ends.select(*keys, before.alias("_before")).where("_before is not null")
        same = [out[k].eqNullSafe(carried[k]) for k in keys]
        out = out.join(carried, same, "left").withColumn("_last", F.coalesce("_last", "_before"))
    return out


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], at: str, value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Left rows with the right side's last value at or before their position, by one window and no range join.

    Of right rows at one position the largest value counts. `ranges` deals hot keys out, see _last_before().
    """
    r = right.where(F.col(value).isNotNull()).select(*by, at, F.col(value).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(left_struct := _struct_type(left)).alias("_row"))
    rows = left.select(*by, at, F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(1).alias("_side"), F.struct(*left.columns).cast(left_struct).alias("_row"))
    out = _last_before(rows.unionByName(r), by, [F.asc_nulls_first(at), F.col("_side"), F.asc_nulls_first("_v")], ranges)
    return out.select("_row.*", F.col("_last").alias(name))


def _struct_type(df: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


def asof_forward(left: DataFrame, right: DataFrame, by: Sequence[str], start: str, at: str, value: str, tolerance: object, name: str, ranges: int | None = None) -> DataFrame:
    """Left rows with the right side's first value at or after `start`, no further than the tolerance (a number or an interval).

    Of right rows at one position the smallest value counts; without one the value is null.
    `ranges` deals hot keys out, see _last_before().
    """
    kind = _struct_type(left)
    r = right.where(F.col(value).isNotNull()).select(*by, F.col(at).alias("_at"), F.struct(F.col(at).alias("at"), F.col(value).alias("v")).alias("_v"), F.lit(0).alias("_side"), F.lit(None).cast(kind).alias("_row"))
    rows = left.select(*by, F.col(start).alias("_at"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_side"), F.struct(*left.columns).cast(kind).alias("_row"))
    out = _last_before(rows.unionByName(r), by, [F.desc_nulls_last("_at"), F.col("_side"), F.col("_v")["v"].desc_nulls_last()], ranges)
    far = F.expr(tolerance) if isinstance(tolerance, str) else F.lit(tolerance)
    return out.select("_row.*", F.when(F.col("_last.at") <= F.col("_at") + far, F.col("_last.v")).alias(name))


def first_reconciling_pair(revenues: Column, costs: Column, target: Column, pct: float = 5.0) -> Column:
    """The first (revenue, cost) of two arrays whose difference is about the target; null if there is none."""
    pairs = F.flatten(F.transform(revenues, lambda r: F.transform(costs, lambda c: F.struct(r.alias("revenue"), c.alias("cost")))))
    fits = F.filter(pairs, lambda p: F.abs(p["revenue"] - p["cost"] - target) / F.greatest(F.abs(p["revenue"] - p["cost"]), F.abs(target), F.lit(1e-9)) * 100 <= pct)
    return F.try_element_at(fits, F.lit(1))


#: Sums that are compared at once.
SUMS = 2_000_000


@lru_cache(maxsize=16)
def _subset_finder(most: int, terms: int) -> Callable[[Column, Column], Column]:
    """A vectorised function from values and a target to the best combination: its sum, error and number."""
    picks = [c for k in range(1, terms + 1) for c in combinations(range(most), k)]
    # a missing term points to a column of zeros behind the values
    places = np.array([[*c, *[most] * (terms - len(c))] for c in picks], np.int64).T
    kind = pa.struct([("s", pa.float64()), ("err", pa.float64()), ("i", pa.int32())])

    def run(values: pa.Array, targets: pa.Array) -> pa.Array:
        out: list[pa.Array] = []
        step = max(1, SUMS // len(picks))
        goals = targets.cast(pa.float64()).to_numpy(zero_copy_only=False)
        for begin in range(0, len(values), step):
            part = values.slice(begin, step)
            sizes = pc.list_value_length(part).to_numpy(zero_copy_only=False).astype(np.int64)
            held = np.full((len(part), most + 1), np.nan)
            held[:, most] = 0.0
            rows = np.repeat(np.arange(len(part)), sizes)
            held[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = part.flatten().to_numpy(zero_copy_only=False)
            sums = held[:, places[0]]
            for p in places[1:]:
                sums = sums + held[:, p]
            err = np.abs(sums - goals[begin : begin + len(part), None].astype(np.float64))
            best = np.argmin(np.where(np.isnan(err), np.inf, err), axis=1)  # the first of equal ones
            each = np.arange(len(part))
            found = err[each, best]
            columns = [pa.array(sums[each, best]), pa.array(found, mask=np.isnan(found)), pa.array(best.astype(np.int32))]
            out.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
        return pa.concat_arrays(out) if out else pa.array([], kind)

    run.__annotations__ = {"values": pa.Array, "targets": pa.Array, "return": pa.Array}
    return F.arrow_udf("struct<s:double,err:double,i:int>")(run)


def best_subset_sum(candidates: DataFrame, targets: DataFrame, by: Sequence[str], value: str, ord_col: str, most: int = 10, terms: int = 3) -> DataFrame:
    """For each group the sum of one to `terms` of its `most` largest values (absolute) that comes closest to its target.

    Groups without candidates have no row; a null target gives the largest value and no error. The
    combinations are positions, so each group holds at most `most` values; all sums of many groups
    are compared at once, in doubles, and of equally close sums the first combination wins.
    """
    top = Window.partitionBy(*by).orderBy(F.abs(F.col(value)).desc(), ord_col)
    few = candidates.where(F.col(value).isNotNull()).withColumn("_n", F.row_number().over(top)).where(F.col("_n") <= most)
    arrays = few.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_n", F.col(value).cast("double").alias("v")))).alias("_a"))
    values = F.transform("_a", lambda x: x["v"])
    scored = arrays.join(targets, list(by)).withColumn("_s", _subset_finder(most, terms)(values, F.col("target").cast("double")))
    return scored.select(*by, "target", F.col("_s.s").alias("best_sum"), F.col("_s.err").alias("error"), F.col("_s.i").alias("combination"))


def integrity_table(failures: DataFrame, warnings: DataFrame, errors: DataFrame, filings: DataFrame) -> DataFrame:
    """One row for each accession that any source names, with tickers and exchanges filled in from the filings."""
    def known(c: str) -> Column:
        return F.nullif(F.col(c), F.lit("N/A"))

    rows = failures.withColumnsRenamed({"ticker": "_t", "exchange": "_e"}).join(warnings, "accession", "full_outer").join(errors, "accession", "full_outer").join(filings, "accession", "left")
    return rows.withColumn("ticker", F.coalesce(known("_t"), known("ticker"), F.lit("N/A"))).withColumn("exchange", F.coalesce(known("_e"), known("exchange"), F.lit("N/A"))).drop("_t", "_e")


def failures_with_cap(failures: DataFrame, caps: DataFrame) -> DataFrame:
    """Failures with their market value, the largest first and unknown ones last."""
    return failures.join(caps, "ticker", "left").orderBy(F.desc_nulls_last("market_cap"), "accession")
