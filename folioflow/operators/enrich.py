"""Judging and translating records by a backend, in bounded batches: prompts, verdict join, translations with fallback.

A backend is anything with ``answer(prompts) -> list of JSON texts``; it is sent to the tasks, called once for each batch,
and may fail: a batch that fails has no answers, the others keep theirs. ``TableBackend`` answers from stored texts, so
runs without a network are deterministic.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import notes
from ..functions.documents import json_in
from ..functions.text import blank_to_null
from ..runtime import ship
from . import rank, render


class Backend(Protocol):
    """Answers a batch of prompts; the n-th answer belongs to the n-th prompt, None if there is none."""

    def answer(self, prompts: Sequence[str]) -> list[str | None]: ...


class TableBackend:
    """Answers by the prompt's first line, from a mapping."""

    def __init__(self, answers: Mapping[str, str]):
        self.answers = dict(answers)

    def answer(self, prompts: Sequence[str]) -> list[str | None]:
        return [self.answers.get(p.split("\n", 1)[0]) for p in prompts]


def prompt(ident: Column, title: Column, source: Column, date: Column, groups: Column, abstract: Column) -> Column:
    """What a backend is told of one record, a line a field; missing fields are named as such."""
    said = lambda name, c, absent: F.concat(F.lit(f"{name}: "), F.coalesce(blank_to_null(c), F.lit(absent)))
    return F.concat_ws(
        "\n", said("paper_id", ident, ""), said("title", title, ""), said("source", source, ""), said("date", date, "unknown"), said("query_groups", F.array_join(groups, ", "), "unknown"), said("abstract", abstract, "abstract missing")
    )


def batch_prompts(df: DataFrame, place: str, text: str, size: int, head: str) -> DataFrame:
    """batch, prompt, records: the prompts of ``size`` records each, by place (1, 2, ...), under one heading."""
    parts = df.groupBy(F.floor((F.col(place) - 1) / size).cast("long").alias("batch")).agg(F.array_sort(F.collect_list(F.struct(place, text))).alias("x"))
    return parts.select("batch", F.concat_ws("\n\n", F.lit(head), F.array_join(F.transform("x", lambda e: e[text]), "\n\n")).alias("prompt"), F.size("x").cast("long").alias("records"))


def answered(df: DataFrame, ident: str, text: str, backend: Backend, size: int) -> DataFrame:
    """ident, answer (JSON text) of each row, ``size`` rows at a call; null where the backend failed or had none."""
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), size):
                part = b.iloc[k : k + size]
                try:
                    got = list(backend.answer(part[text].tolist()))
                except Exception:  # noqa: BLE001 - a batch that fails has no answers
                    got = [None] * len(part)
                yield pd.DataFrame({ident: part[ident], "answer": [json_in(a) if a else None for a in (got + [None] * len(part))[: len(part)]]})

    schema = T.StructType([df.schema[ident], T.StructField("answer", T.StringType())])
    return df.select(ident, text).mapInPandas(run, schema)


def with_verdicts(df: DataFrame, answers: DataFrame, ident: str) -> DataFrame:
    """Adds relevance, pick (0 to 100, 0 if missing), verdict (null if unknown) and why (null if empty) from answers (ident, answer).

    Several answers of one record count as the last by their text; answers without a record are left out.
    """
    one = answers.where(F.col("answer").isNotNull()).groupBy(ident).agg(F.max("answer").alias("answer"))
    field = lambda k: F.get_json_object("answer", f"$.{k}")
    out = df.join(one, ident, "left")
    return out.withColumns({"relevance": rank.as_score(field("relevance_score")), "pick": rank.as_score(field("top_pick_score")), "verdict": rank.as_bool(field("is_relevant")), "why": blank_to_null(F.trim(field("why")))}).drop("answer")


def with_translations(df: DataFrame, answers: DataFrame, ident: str) -> DataFrame:
    """Adds translated (terms settled) and note. An answer that lost too much, or none, leaves the abstract itself; without one, a summary of what is known.

    ``df``: title, abstract, source, date.
    """
    one = answers.where(F.col("answer").isNotNull()).groupBy(ident).agg(F.max("answer").alias("answer"))
    out = df.join(one, ident, "left")
    text = F.get_json_object("answer", "$.translation")
    given = F.when(~render.too_short(F.col("abstract"), text), text)
    none = F.coalesce(F.col("abstract"), F.lit("")) == ""
    out = out.withColumn("translated", F.when(none, notes.missing_summary(F.col("title"), F.col("source"), F.col("date"))).otherwise(notes.settled_terms(F.coalesce(given, F.col("abstract")))))
    said = notes.clean_note(F.get_json_object("answer", "$.note"))
    return out.withColumn("note", F.coalesce(blank_to_null(said), notes.note_from(F.col("translated"), F.col("abstract"), F.col("source"), F.col("date")))).drop("answer")
