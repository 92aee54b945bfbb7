"""Record filters. All are Columns or one window; nothing is collected."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_since, strict_date


def of_type(source: Column, kind: Column, sources: list[str], wanted: str) -> Column:
    """Rows of the named sources must be of the wanted type; others pass. A missing type is not the wanted one."""
    return ~F.coalesce(source.isin(*sources), F.lit(False)) | F.coalesce(kind == wanted, F.lit(False))


def not_before(published: Column, year: Column, threshold: str) -> Column:
    """Dated rows from the threshold on; undated ones unless their year is known and earlier. A bad threshold passes all."""
    try:
        limit = datetime.date(*(int(x) for x in threshold.split("-")))
    except (TypeError, ValueError):
        return F.lit(True)
    day = strict_date(published)
    return F.when(day.isNotNull(), day >= F.lit(limit)).otherwise((F.coalesce(year, F.lit(0)) == 0) | (year >= limit.year))


def mentions(text: Column, include: list[str], exclude: list[str]) -> Column:
    """Substring rules on lower-case text: any of ``include`` (none given: all pass) and none of ``exclude``."""
    low = F.lower(F.coalesce(text, F.lit("")))
    any_of = lambda ks: reduce(lambda a, b: a | b, [low.contains(k.lower()) for k in ks])
    ok = any_of(include) if include else F.lit(True)
    return ok & ~any_of(exclude) if exclude else ok


def within(iso: Column, days: int, as_of: datetime.date) -> Column:
    """At most so many days old; undated and later rows pass."""
    age = days_since(iso, as_of)
    return age.isNull() | (age <= days)


def on_or_after(iso: Column, threshold: str) -> Column:
    """ISO texts compared as texts; a missing date fails, a threshold that is no date passes all."""
    try:
        datetime.date.fromisoformat(threshold)
    except ValueError:
        return F.lit(True)
    return F.coalesce(iso >= threshold, F.lit(False))


def adaptive_window(df: DataFrame, age: Column, by: list[str], primary: int, fallback: int, least: int, drop_undated: bool = False) -> DataFrame:
    """Rows up to ``primary`` days old, or, in groups where these are fewer than ``least``, up to ``fallback`` days.

    Undated rows are in both windows unless dropped. The group's count is aggregated before it is joined back, so a hot
    group is no single task.
    """
    wide = max(primary, fallback)
    undated = F.lit(not drop_undated)
    d = df.withColumn("_age", age)
    inside = F.coalesce(F.col("_age") <= primary, undated)
    counts = d.groupBy(*by).agg(F.count_if(inside).alias("_n")).select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], "_n")
    same = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)])
    out = d.join(counts, same).where(F.coalesce(F.col("_age") <= wide, undated) & (inside | (F.col("_n") < least)))
    return out.drop("_age", "_n", *[f"_by{i}" for i in range(len(by))])


def in_units(day: Column, anchor: datetime.date, size: int, unit: str = "day") -> Column:
    """Whether a date lies in the last ``size`` days or weeks up to the anchor (later dates too); bad dates do not."""
    start = anchor - datetime.timedelta(days=(size - 1) * (7 if unit == "week" else 1))
    return F.coalesce(day >= F.lit(start), F.lit(False))


def top_in_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n rows per group on the map side (window group limit)."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
