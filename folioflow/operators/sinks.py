"""Sinks: JSON lines, Markdown, candidate audits, and documents that grow by run keys without doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import key_suffix
from ..runtime import exists


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object a line, UTF-8; null fields are kept as nulls. Replaces what is there."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_markdown(df: DataFrame, path: str, text: str = "markdown", by: str | None = None) -> None:
    """Texts as files, line by line; ``by``: a folder for each value. Whole digests are single rows, so each stays in one file."""
    out = df.select(*([by] if by else []), F.col(text).alias("value"))
    (out.write.partitionBy(by) if by else out.write).mode("overwrite").text(path, lineSep="\n")


def section(title: Column, source: Column, key: Column, body: Column) -> Column:
    """A document's section for a run: heading with the run key's suffix, body, rule. Null if the key is not one of the source."""
    return F.concat(F.lit("## "), title, F.lit(" | "), key_suffix(source, key), F.lit("\n\n"), F.regexp_replace(body, r"\n+\z", ""), F.lit("\n\n---\n\n"))


SECTION = T.StructType([T.StructField("run_key", T.StringType()), T.StructField("nth", T.LongType()), T.StructField("body", T.StringType())])


class Document:
    """A document of sections, one folder for each run key: writing a key again replaces its section, so a repeated run leaves no double."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, df: DataFrame, run_key: str, nth: int, body: str = "body") -> None:
        """The section's pieces in order; ``nth`` is the run's number, by which sections stand."""
        if not run_key or "/" in run_key:
            raise ValueError("a run key names a folder")
        df.select(F.lit(nth).cast("long").alias("nth"), F.col(body).alias("body")).write.mode("overwrite").parquet(f"{self.path}/run_key={run_key}")

    def sections(self, latest_first: bool = True) -> DataFrame:
        """run_key, nth, body, newest on top (prepended) or at the end (appended); empty if nothing was written."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SECTION)
        out = self.spark.read.schema(SECTION).parquet(self.path).select(*SECTION.names)
        return out.orderBy(F.col("nth").desc() if latest_first else F.col("nth"), "run_key")
