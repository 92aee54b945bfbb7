"""Delivered-record state and archives as versioned Parquet tables: append, union, replace by pointer."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_cell


class Versions:
    """A table whose content is replaced as a whole. Readers follow a pointer that moves after the new files are complete."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        """The newest complete version, by number."""
        jvm, fs = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs.exists(root):
            return None
        done = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return max(done, default=None)

    def read(self) -> DataFrame:
        """The current content; empty if nothing was written yet."""
        v = self.current()
        return self.spark.createDataFrame([], self.schema) if v is None else self.spark.read.schema(self.schema).parquet(f"{self.path}/{v}")

    def replace(self, df: DataFrame) -> None:
        """Writes the next version; it counts once it is complete."""
        v = self.current()
        nth = 1 if v is None else int(v[1:9]) + 1
        df.select(*self.schema.names).write.parquet(f"{self.path}/v{nth:08d}-{uuid.uuid4().hex[:8]}")


IDS = T.StructType([T.StructField("source", T.StringType()), T.StructField("id", T.StringType())])


def united_ids(*frames: DataFrame) -> DataFrame:
    """source, id of all frames, cleaned, once each; null tokens and empty ids go."""
    out = None
    for f in frames:
        f = f.select("source", clean_cell(F.col("id")).alias("id")).where("id <> ''")
        out = f if out is None else out.unionByName(f)
    return out.distinct()


def ids_by_source(df: DataFrame) -> DataFrame:
    """source, ids ARRAY sorted, n: what a commit writes for each source."""
    return united_ids(df).groupBy("source").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn("n", F.size("ids").cast("long"))


def seen_records(df: DataFrame, task: Column, at: Column) -> DataFrame:
    """What a delivery leaves: scope (``all`` and the task's own), key_kind, key, paper_id, task_name, title, source, date, link, pushed_at.

    Each record stands under its id, its address and its title, where it has them, in both scopes.
    """
    keys = F.array(*[F.struct(F.lit(k).alias("key_kind"), F.col(k).alias("key")) for k in ("paper_id", "canonical_url", "normalized_title")])
    rows = df.select("paper_id", task.alias("task_name"), "title", "source", "date", "link", at.alias("pushed_at"), F.explode(F.filter(keys, lambda k: k["key"] != "")).alias("k"))
    rows = rows.withColumn("scope", F.explode(F.array(F.lit("all"), F.concat(F.lit("task:"), F.col("task_name")))))
    return rows.select("scope", "k.key_kind", "k.key", "paper_id", "task_name", "title", "source", "date", "link", "pushed_at")


def latest_seen(df: DataFrame) -> DataFrame:
    """Of each scope and key the record pushed last (of equals the highest id); the state that look-ups read."""
    rest = [c for c in df.columns if c not in ("scope", "key_kind", "key")]
    return df.groupBy("scope", "key_kind", "key").agg(F.max(F.struct("pushed_at", *[c for c in rest if c != "pushed_at"])).alias("r")).select("scope", "key_kind", "key", *[f"r.{c}" for c in rest])


def committed(state: DataFrame, payloads: DataFrame, source: str = "all") -> DataFrame:
    """The id state after a commit from payloads (source, id), of one source or all; ids are cleaned, once each."""
    return united_ids(state, payloads if source == "all" else payloads.where(F.col("source") == source))
