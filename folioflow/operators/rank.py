"""Scoring, verdicts, ranking and selection. Selections are windows over partitions or a distributed top-k, never a collect."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Weights:
    """Weights of the heuristic score."""

    rule: float = 1.0
    completeness: float = 0.75
    recency: float = 1.25
    fresh_days: int = 10
    source: Mapping[str, float] = field(default_factory=dict)
    source_default: float = 0.5
    bucket: Mapping[str, float] = field(default_factory=dict)
    group: Mapping[str, float] = field(default_factory=dict)
    penalty: float = 1.5
    relevance: float = 0.03
    pick: float = 0.04


def lookup(c: Column, table: Mapping[str, float], default: float) -> Column:
    """Value of a small map of literals."""
    if not table:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))])
    return F.coalesce(F.try_element_at(m, c), F.lit(default))


def named(c: Column, table: Mapping[str, str], default: str) -> Column:
    """Name that a small map of literals gives a value."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), F.lit(default))


def recency(age: Column, fresh_days: int) -> Column:
    """0.3 if unknown; from 1 down to 0 within the fresh days (over 1 for later dates); then a small tail over a year."""
    fresh = F.greatest(F.lit(0.0), 1 - age / F.lit(float(max(fresh_days, 1))))
    return F.when(age.isNull(), 0.3).when(age <= fresh_days, fresh).otherwise(F.greatest(F.lit(0.0), 0.25 - (age - fresh_days) / F.lit(365.0)))


def heuristic(rule: Column, age: Column, has: Sequence[Column], source: Column, bucket: Column, groups: Column, penalties: Column, w: Weights) -> Column:
    """Weighted sum; ``has``: whether abstract, authors and date are there. Of the groups' weights the best counts, none below 0."""
    complete = sum((F.when(h, F.lit(v)).otherwise(0.0) for h, v in zip(has, (1.0, 0.4, 0.4))), F.lit(0.0))
    best = F.coalesce(F.array_max(F.transform(groups, lambda g: lookup(g, w.group, 0.0))), F.lit(0.0))
    return (
        rule * w.rule + complete * w.completeness + recency(age, w.fresh_days) * w.recency + lookup(source, w.source, w.source_default)
        + lookup(bucket, w.bucket, 0.0) + F.greatest(F.lit(0.0), best) - penalties * w.penalty
    )


def as_score(c: Column) -> Column:
    """Number between 0 and 100; what is no number is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))))


def as_bool(c: Column) -> Column:
    """True, false or unknown (null) of a word or number."""
    x = F.lower(F.trim(c.cast("string")))
    return F.when(x.isin("true", "yes", "y", "1", "1.0"), True).when(x.isin("false", "no", "n", "0", "0.0"), False)


def accepted(df: DataFrame, verdict: Column) -> DataFrame:
    """Rows whose verdict is true; all rows if none is. The test for any is one aggregated row, joined as a scalar."""
    any_true = df.agg(F.coalesce(F.bool_or(F.coalesce(verdict, F.lit(False))), F.lit(False)).alias("_any"))
    return df.join(F.broadcast(any_true)).where(~F.col("_any") | F.coalesce(verdict, F.lit(False))).drop("_any")


def numbered(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Adds ``place`` (1, 2, ...) over all rows in order, for any number of rows.

    Rows are range-partitioned by the order, each partition numbers its own, and the counts of the partitions before it are
    added: one small row a partition, never all rows in one task. The order must tell all rows apart.
    """
    from ..runtime import stage

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    own = stage(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id()), "numbered")
    sizes = own.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_in").alias("_least"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return own.join(F.broadcast(before), "_part").withColumn("place", F.col("_before") + F.col("_in") - F.col("_least") + 1).drop("_part", "_in", "_before", "_least")


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The n first rows over all: a limit on each partition, then a merge of n rows each."""
    return df.orderBy(*order).limit(n)


def balanced(df: DataFrame, order: Sequence[Column], bucket: str, core: str, least_core: int, limited: str, most_limited: int, target: int) -> DataFrame:
    """Balanced top-k: first ``least_core`` rows of the core bucket, then rows in rank order with at most ``most_limited`` of the limited one.

    Only each bucket's first ``target`` rows can be chosen, so windows run over a window group limit per bucket and the
    last ordering over a few rows. Adds ``place`` (1..target).
    """
    key = F.coalesce(F.col(bucket), F.lit(""))
    per = Window.partitionBy("_b").orderBy(*order)
    d = df.withColumn("_b", key).withColumn("_rn", F.row_number().over(per)).where(F.col("_rn") <= target)
    d = d.withColumn("_forced", (F.col("_b") == core) & (F.col("_rn") <= min(target, least_core)))
    d = d.where((F.col("_b") != limited) | (F.col("_rn") <= most_limited))
    d = d.orderBy(F.col("_forced").desc(), *order).limit(target)
    return d.withColumn("place", F.row_number().over(Window.orderBy(F.col("_forced").desc(), *order))).drop("_b", "_rn", "_forced")


def backfill(chosen: DataFrame, pool: DataFrame, ident: str, preferred: Column, order: Sequence[Column], target: int) -> DataFrame:
    """Chosen rows (with ``place``), filled up to ``target`` from the pool: preferred rows first, in order, none twice."""
    extra = pool.join(chosen.select(ident), ident, "left_anti").withColumn("_late", F.when(preferred, 0).otherwise(1)).orderBy("_late", *order).limit(target)
    extra = extra.withColumn("place", F.row_number().over(Window.orderBy("_late", *order)))
    have = chosen.agg(F.count("*").alias("_have"))
    extra = extra.join(F.broadcast(have)).withColumn("place", (F.col("place") + F.col("_have")).cast("int")).where(F.col("place") <= target)
    return chosen.withColumn("place", F.col("place").cast("int")).unionByName(extra.select(*chosen.columns))


def capped(df: DataFrame, group: str, group_order: Column, order: Column, per_group: int, total: int) -> DataFrame:
    """At most ``per_group`` rows of each group and ``total`` over all, groups and rows in order."""
    w = Window.partitionBy(group).orderBy(order)
    d = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_group)
    return d.orderBy(group_order, order).limit(total).drop("_rn")


def batches(df: DataFrame, by: list[str], order: Sequence[Column], size: int) -> DataFrame:
    """Adds ``batch``: 0, 1, ... for each ``size`` rows of a group in order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
