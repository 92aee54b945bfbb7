"""Landed result pages, one JSON object a file: {"items": [...], "next": cursor or null, "status": code}, named stream-NNN.json.

Files are listed and read by Spark, on whatever storage it reaches, one row a file; the order of a stream's pages is that
of their numbers. A page ends its stream if it is empty, names no next page or one that was named before. A page with
status 429 ends all streams: neither it nor any page after it counts, in the order of streams (by name) and pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE = "items array<string>, next string, status int"


def pages(files: DataFrame) -> DataFrame:
    """stream, page, items of the pages that count. ``files``: path, value (the text). Other names and malformed pages are left out."""
    p = files.select(F.regexp_extract("path", r"([^/]*)-[0-9]+\.json\z", 1).alias("stream"), F.regexp_extract("path", r"-([0-9]+)\.json\z", 1).try_cast("int").alias("page"), F.from_json("value", PAGE).alias("j"))
    p = p.where(F.col("page").isNotNull() & (F.col("stream") != "") & (F.col("j.items").isNotNull() | (F.coalesce("j.status", F.lit(0)) == 429)))
    order = [F.col("stream"), F.col("page")]
    stop = p.where("j.status = 429").agg(F.min(F.struct("stream", "page")).alias("stop"))
    p = p.join(F.broadcast(stop)).where(F.col("stop").isNull() | (F.struct("stream", "page") < F.col("stop"))).drop("stop")
    named = F.row_number().over(Window.partitionBy("stream", "j.next").orderBy(*order)) > 1
    p = p.select("stream", "page", "j.items", F.col("j.next").alias("next"), named.alias("again"))
    last = (F.size("items") == 0) | F.coalesce(F.col("next") == "", F.lit(True)) | F.col("again")
    before = Window.partitionBy("stream").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(last).over(before), F.lit(False))
    return p.withColumn("ended", ended).where("not ended").select("stream", "page", "items")


def landed(spark: SparkSession, path: str) -> DataFrame:
    """stream, page, nth (place in the page), item (JSON text) of the folder's pages."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return pages(files).select("stream", "page", F.posexplode("items").alias("nth", "item"))
