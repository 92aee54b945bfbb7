"""Rendering records to text as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def entry(nth: Column, title: Column, authors: Column, source: Column, date: Column, link: Column) -> Column:
    """One record as Markdown; missing parts are named as such."""
    who = F.coalesce(F.when(F.size(authors) > 0, F.array_join(authors, ", ")), F.lit("unknown"))
    return F.concat_ws(
        "\n", F.concat(F.lit("### "), nth.cast("string"), F.lit(". "), F.coalesce(title, F.lit("untitled"))), F.concat(F.lit("- Authors: "), who),
        F.concat(F.lit("- Source: "), F.coalesce(source, F.lit("unknown"))), F.concat(F.lit("- Date: "), F.coalesce(date, F.lit("unknown"))), F.concat(F.lit("- Link: "), F.coalesce(link, F.lit("none"))),
    )


def digest(df: DataFrame, by: list[str], place: str, body: Column, target: int) -> DataFrame:
    """One text for each group: header, a line if records are fewer than the target, the entries in order.

    ``df`` holds a selection (at most a page per group); entries are gathered and sorted within the aggregate.
    """
    parts = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), body.alias("t")))).alias("x"))
    short = F.when(F.size("x") < target, F.concat(F.lit("Only "), F.size("x").cast("string"), F.lit(f" of {target} records today.")))
    text = F.concat_ws("\n\n", F.concat(F.lit("# Digest: "), *[F.coalesce(F.col(b), F.lit("")) for b in by]), short, F.array_join(F.transform("x", lambda e: e["t"]), "\n\n"))
    return parts.select(*by, F.size("x").cast("long").alias("records"), text.alias("markdown"))


#: Fixed value: what a digest without records says.
NOTHING = "No new records today."


def with_empty(digests: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Digests of all wanted groups; one without records says so."""
    head = F.concat(F.lit("# Digest: "), *[F.coalesce(F.col(b), F.lit("")) for b in by], F.lit("\n\n" + NOTHING))
    out = wanted.select(*by).distinct().join(digests, by, "left")
    return out.select(*by, F.coalesce("records", F.lit(0).cast("long")).alias("records"), F.coalesce("markdown", head).alias("markdown"))


def archive_order(issue: Column, seen: Column, place: Column) -> list[Column]:
    """Latest issue first, in it the latest seen, of these the lowest place; nulls last."""
    return [issue.desc_nulls_last(), seen.desc_nulls_last(), place.asc_nulls_last()]


def archive_document(df: DataFrame, issue: str, order: list[Column], body: Column) -> DataFrame:
    """issue, records, markdown: each issue's entries in order."""
    rows = df.groupBy(issue).agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], body.alias("t")))).alias("x"))
    return rows.select(issue, F.size("x").cast("long").alias("records"), F.concat_ws("\n", F.concat(F.lit("## "), F.col(issue).cast("string")), F.array_join(F.transform("x", lambda e: e["t"]), "\n")).alias("markdown"))


def too_short(source: Column, translated: Column, share: float = 0.22, least: int = 80, from_length: int = 240) -> Column:
    """Whether a translation lost too much: long source, short result; any empty result of a non-empty source."""
    n, m = F.length(F.coalesce(source, F.lit(""))), F.length(F.trim(F.coalesce(translated, F.lit(""))))
    return F.when((m == 0) & (n > 0), True).when(n >= from_length, m < F.greatest(F.lit(least), F.floor(n * share).cast("int"))).otherwise(False)
