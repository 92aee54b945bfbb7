"""Merging tables that describe the same keys, and merging new records into an archive."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_rows(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Of each key the last row's columns, even where they are empty."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_r")).select(key, "_r.*")


def ordered_items(df: DataFrame, key: str, order: str, item: Column, name: str) -> DataFrame:
    """Of each key the distinct non-empty items in order of first appearance, reduced before the list is built."""
    items = df.where(F.col(key).isNotNull()).select(key, order, item.alias("_v")).where("_v <> ''").groupBy(key, "_v").agg(F.min(order).alias("_o"))
    return items.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]).alias(name))


def full_merge(frames: list[DataFrame], key: str) -> DataFrame:
    """Full outer join of tables with one row for each key; all share one hash partitioning on the key."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), frames)


def fill(target: Column, *others: Column) -> Column:
    """The first non-empty text."""
    return F.coalesce(*[F.when(c != "", c) for c in (target, *others)])


def match_any(stored: DataFrame, incoming: DataFrame, keys: list[str], stored_order: str, incoming_id: str) -> DataFrame:
    """incoming_id, stored_order of the first stored record that equals the incoming one in any non-empty key.

    One equality join for each key against the key's first stored record, not an OR: a value that a third of both tables
    share joins as one row.
    """
    found = []
    for k in keys:
        first = stored.where(f"{k} <> ''").groupBy(F.col(k).alias("_k")).agg(F.min(stored_order).alias("_o"))
        found.append(incoming.where(f"{k} <> ''").select(incoming_id, F.col(k).alias("_k")).join(first, "_k").select(incoming_id, "_o"))
    return reduce(DataFrame.unionByName, found).groupBy(incoming_id).agg(F.min("_o").alias(stored_order))


def archive_merge(stored: DataFrame, incoming: DataFrame, keys: list[str], stored_order: str, incoming_id: str, payload: list[str], keep: Mapping[str, Column]) -> DataFrame:
    """Stored records with the payload of the last incoming record that matches them, and new records.

    ``keep``: columns that matched records keep and new ones get by the given expression. ``origin``: kept, updated, new.
    Of incoming records that match nothing, those that share a key become one record, the last.
    """
    pairs = match_any(stored, incoming, keys, stored_order, incoming_id)
    newest = pairs.groupBy(stored_order).agg(F.max(incoming_id).alias(incoming_id))
    news = incoming.join(newest, incoming_id).select(stored_order, *[F.col(c).alias(f"_new_{c}") for c in payload], F.lit(True).alias("_hit"))
    old = stored.join(news, stored_order, "left")
    old = old.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in payload], *keep, F.when(F.col("_hit"), "updated").otherwise("kept").alias("origin"))
    fresh = incoming.join(pairs.select(incoming_id).distinct(), incoming_id, "left_anti")
    fresh = fresh.withColumn("_k", F.coalesce(*[F.when(F.col(k) != "", F.concat(F.lit(f"{k}:"), F.col(k))) for k in keys], F.col(incoming_id).cast("string")))
    fresh = fresh.groupBy("_k").agg(F.max_by(F.struct(*fresh.columns), incoming_id).alias("_r")).select("_r.*")
    fresh = fresh.select(*payload, *[e.alias(n) for n, e in keep.items()], F.lit("new").alias("origin"))
    return old.unionByName(fresh)
