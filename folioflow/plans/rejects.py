"""Queries on rows that fail to parse, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rejects as R
from ..runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_no, reason of each rejected record."""
    return R.rejected(R.abstract_records(table(spark, sf_dir, "abs_records"))).select("record_no", "reason")


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_no, paper, abstract of each record that loads."""
    return R.loaded(R.abstract_records(table(spark, sf_dir, "abs_records"))).select("record_no", R.strip(F.col("paper")).alias("paper"), "abstract")


def p1_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded and rejected records by kind of file and reason."""
    parsed = R.abstract_records(table(spark, sf_dir, "abs_records"))
    kind = F.lower(F.element_at(F.split("file_name", r"\."), -1))
    return parsed.groupBy(kind.alias("kind"), F.coalesce(F.get("errors", F.lit(0)), F.lit("loaded")).alias("outcome")).agg(F.count("*").alias("n"))


QUERIES = {"p1_found": p1_found, "p1_loaded": p1_loaded, "p1_summary": p1_summary}


def _field(sep: str) -> str:
    return rf'(?:"(?:[^"]|"")*"|[^"{sep}][^{sep}]*|)'


def _base() -> str:
    t, c = _field(r"\t"), _field(",")
    one = lambda sep, f: f"^({f}){sep}({f})$"
    cell = lambda i: f"case when tsv then regexp_extract(raw_text, '{one(chr(92) + 't', t)}', {i}) else regexp_extract(raw_text, '{one(',', c)}', {i}) end"
    plain = lambda x: f"case when {x} like '\"%' then replace(substr({x}, 2, length({x}) - 2), '\"\"', '\"') else {x} end"
    return rf"""
with r as (select record_no, file_name, raw_text, lower(file_name) like '%.tsv' tsv from abs_records where line_no is distinct from 1),
s as (select *, coalesce(case when tsv then regexp_matches(raw_text, '^{t}(?:\t{t})*$') else regexp_matches(raw_text, '^{c}(?:,{c})*$') end, true) quoted,
  coalesce(case when tsv then regexp_matches(raw_text, '{one(chr(92) + "t", t)}') else regexp_matches(raw_text, '{one(",", c)}') end, false) counted,
  {cell(1)} a, {cell(2)} b from r),
u as (select *, regexp_replace({plain("a")}, '^[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+|[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+$', '', 'g') paper, {plain("b")} abstract from s),
parsed as (select *, case when not quoted then 'quoting' when not counted then 'column_count'
  when not regexp_matches(paper, '^[whtcWHTC]?[0-9]{{1,6}}$') or regexp_matches(abstract, '[\x{{FFFD}}\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{{9F}}]') then 'value' end reason from u)
"""


SQL = {
    "p1_found": _base() + "select record_no, reason from parsed where reason is not null",
    "p1_loaded": _base() + "select record_no, paper, abstract from parsed where reason is null",
    "p1_summary": _base() + "select lower(split_part(file_name, '.', -1)) kind, coalesce(reason, 'loaded') outcome, count(*) n from parsed group by 1, 2",
}
