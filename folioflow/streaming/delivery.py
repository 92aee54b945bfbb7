"""Incremental runs: each micro-batch is deduplicated against all ids delivered before, published, then committed.

State is unbounded by design, so it is a table with one folder for each batch, not a watermarked operator. A batch is
held against the batches before it only; when it is replayed after a failure, its own folder is overwritten and the
result is the same. Publishing comes before committing, and is keyed by batch, so a failed run repeats without doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import exists


class Delivery:
    """Delivers rows once by ``ident``; the first by ``order`` within a batch wins."""

    def __init__(self, spark: SparkSession, path: str, ident: str, order: str, publish: Callable[[DataFrame, str], None] | None = None):
        self.spark, self.path, self.ident, self.order, self.publish = spark, path.rstrip("/"), ident, order, publish

    def _seen(self, schema: T.StructType, batch: int) -> DataFrame:
        own = T.StructType([schema[self.ident]])
        if not exists(self.spark, f"{self.path}/ids"):  # nothing was committed yet; any other failure to read rises
            return self.spark.createDataFrame([], own)
        seen = self.spark.read.schema(T.StructType([*own.fields, T.StructField("batch", T.LongType())])).parquet(f"{self.path}/ids")
        return seen.where(F.col("batch") < batch).select(self.ident)

    def run(self, df: DataFrame, batch: int) -> None:
        """One micro-batch."""
        once = df.where(F.col(self.ident).isNotNull()).groupBy(self.ident).agg(F.min_by(F.struct(*[c for c in df.columns if c != self.ident]), self.order).alias("_r")).select(self.ident, "_r.*")
        new = once.join(self._seen(df.schema, batch), self.ident, "left_anti")
        new.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
        written = self.spark.read.schema(new.schema).parquet(f"{self.path}/rows/batch={batch}")
        if self.publish is not None:
            self.publish(written, f"batch-{batch}")
        written.select(self.ident).write.mode("overwrite").parquet(f"{self.path}/ids/batch={batch}")

    def start(self, stream: DataFrame, checkpoint: str):
        """Processes what is available, in micro-batches, then ends."""
        return stream.writeStream.foreachBatch(self.run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def delivered(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch")
