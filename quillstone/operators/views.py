"""Views that are stored and kept by deltas: partial aggregates by key, refreshed in the order of their sources.

A view groups a table, or an earlier view, by keys and holds counts, sums, minima and maxima. What
a load adds and removes is aggregated by key first; of the stored view only rows that those keys
may touch are joined (see maintain.split_by_keys), and the source is read again only for keys
whose minimum or maximum was removed. The rows that a view loses and gains are the delta of the
views on top of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.maintain import split_by_keys, write_version


@dataclass(frozen=True)
class View:
    """`sums`, `least` and `most` name result columns and the source's columns they are of; `rows` is the column of the count."""

    name: str
    source: str
    keys: tuple[str, ...]
    sums: Mapping[str, str] = field(default_factory=dict)
    least: Mapping[str, str] = field(default_factory=dict)
    most: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None
    rows: str = "n"

    def columns(self) -> list[str]:
        """What readers see: keys, count, sums, minima, maxima."""
        return [*self.keys, self.rows, *self.sums, *self.least, *self.most]


@dataclass(frozen=True)
class Delta:
    """Rows that a table has gained and lost; a changed row is in both."""

    inserts: DataFrame
    deletes: DataFrame


def in_order(views: Sequence[View]) -> list[View]:
    """The views, sources first; a circle is an error."""
    out: list[View] = []
    left = {v.name: v for v in views}
    if len(left) < len(views):
        raise ValueError("two views have one name")
    while left:
        ready = [v for v in left.values() if v.source not in left]
        if not ready:
            raise ValueError(f"views stand on each other: {sorted(left)}")
        out += ready
        for v in ready:
            del left[v.name]
    return out


def _not_null(alias: str) -> str:
    """The stored column with the number of values in a sum, so that a sum of none is null."""
    return f"_n_{alias}"


def _state(view: View, rows: DataFrame) -> DataFrame:
    """A view's stored rows, computed from its source's."""
    rows = rows.where(view.where) if view.where else rows
    aggregates = [F.count("*").alias(view.rows)]
    for a, c in view.sums.items():
        aggregates += [F.sum(c).alias(a), F.count(c).alias(_not_null(a))]
    aggregates += [F.min(c).alias(a) for a, c in view.least.items()] + [F.max(c).alias(a) for a, c in view.most.items()]
    return rows.groupBy(*view.keys).agg(*aggregates)


def _changes(view: View, delta: Delta) -> DataFrame:
    """By key: what counts and sums change by, and the extrema that come and go."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        return (df.where(view.where) if view.where else df).withColumn("_sign", F.lit(sign))

    both = signed(delta.inserts, 1).unionByName(signed(delta.deletes, -1), allowMissingColumns=True)
    come, go = F.col("_sign") > 0, F.col("_sign") < 0
    aggregates = [F.sum("_sign").alias("_d")]
    for a, c in view.sums.items():
        aggregates += [F.sum(F.col(c) * F.col("_sign")).alias(f"_d_{a}"), F.sum(F.when(F.col(c).isNotNull(), F.col("_sign"))).alias(f"_dn_{a}")]
    for of, extreme in ((view.least, F.min), (view.most, F.max)):
        for a, c in of.items():
            aggregates += [extreme(F.when(come, F.col(c))).alias(f"_in_{a}"), extreme(F.when(go, F.col(c))).alias(f"_out_{a}")]
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(view.keys)]
    return both.groupBy(*keys).agg(*aggregates)


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for i, k in enumerate(keys):
        out = out & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return out


def merge_delta(view: View, state: DataFrame, delta: Delta, after: DataFrame) -> DataFrame:
    """A view's stored rows after its source's delta.

    `after` is the source with the delta; it is read only for keys that lose an extremum. Keys
    are equal if both are null, and a key without rows left goes.
    """
    changes = _changes(view, delta)
    named = changes.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(view.keys)])
    untouched, maybe = split_by_keys(state, named, view.keys)
    old = maybe.withColumn("_had", F.lit(True))
    met = changes.withColumn("_has", F.lit(True)).join(old, _same(view.keys), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    new = [F.col(f"_k{i}").alias(k) for i, k in enumerate(view.keys)] + [(zero(F.col(view.rows)) + F.col("_d")).alias(view.rows)]
    for a in view.sums:
        n = zero(F.col(_not_null(a))) + zero(F.col(f"_dn_{a}"))
        total = zero(F.col(a)) + zero(F.col(f"_d_{a}"))
        new += [F.when(n > 0, total).cast(state.schema[a].dataType).alias(a), n.alias(_not_null(a))]
    lost = F.lit(False)
    for of, extreme in ((view.least, F.least), (view.most, F.greatest)):
        for a in of:
            was, came, went = F.col(a), F.col(f"_in_{a}"), F.col(f"_out_{a}")
            # the stored extremum goes, and nothing that comes is as extreme
            lost = lost | F.coalesce((extreme(was, went) == went) & (came.isNull() | (extreme(came, went) != came)), F.lit(False))
            new.append(extreme(was, came).alias(a))
    changed = met.select(*new, lost.alias("_lost")).where(F.col(view.rows) > 0)
    if view.least or view.most:
        again = changed.where("_lost").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(view.keys)])
        source = after.where(view.where) if view.where else after
        near = split_by_keys(source, again.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(view.keys)]), view.keys)[1]
        counted = _state(view, near.join(again, _same(view.keys), "left_semi").select(*source.columns))
        changed = changed.where("NOT _lost").drop("_lost").unionByName(counted)
    else:
        changed = changed.drop("_lost")
    changed = changed.select(*state.columns)
    kept = maybe.join(changes, _same(view.keys), "left_anti").select(*state.columns)
    return untouched.unionByName(kept).unionByName(changed)


def create_views(spark: SparkSession, views: Sequence[View], tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Computes and stores all views, and registers them; returns the path of each."""
    held, paths = dict(tables), {}
    for v in in_order(views):
        paths[v.name] = write_version(_state(v, held[v.source]), f"{root}/{v.name}")
        held[v.name] = _register(spark, v, paths[v.name])
    return paths


def refresh_views(spark: SparkSession, views: Sequence[View], paths: Mapping[str, str], tables: Mapping[str, DataFrame], deltas: Mapping[str, Delta], root: str) -> dict[str, str]:
    """Brings stored views up to date with the deltas of tables, sources first; returns the new paths.

    `tables` are as they are after the deltas. A view whose source has not changed stays where it
    is. New versions stand beside the old ones, which readers may still hold.
    """
    held, known, out = dict(tables), dict(deltas), dict(paths)
    for v in in_order(views):
        if v.source in known:
            state = spark.read.parquet(paths[v.name])
            out[v.name] = write_version(merge_delta(v, state, known[v.source], held[v.source]), f"{root}/{v.name}")
            # the view's own delta: what its old and new version have under the keys of the change, and a few more rows of both
            new = spark.read.parquet(out[v.name])
            touched = _changes(v, known[v.source]).select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(v.keys)])
            parts = [split_by_keys(x, touched, v.keys)[1].select(*v.columns()) for x in (new, state)]
            known[v.name] = Delta(*parts)
        held[v.name] = _register(spark, v, out[v.name])
    return out


def _register(spark: SparkSession, view: View, path: str) -> DataFrame:
    rows = spark.read.parquet(path).select(*view.columns())
    rows.createOrReplaceTempView(view.name)
    return rows
