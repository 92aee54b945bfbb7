"""All core queries by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import core, rejects, sources

PARTS = (rejects, core, sources)
QUERIES = {k: v for m in PARTS for k, v in m.QUERIES.items()}
SQL = {k: v for m in PARTS for k, v in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.simple_monitor(spark, sf_dir)
