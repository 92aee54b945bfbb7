"""Session helpers: table access, cutting lineage in the shared folder, checked broadcasts."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable on the executors, once for each application: the driver serves it as a zip."""
    sc = spark.sparkContext
    if _shipped.get("app") != sc.applicationId:
        root = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="folioflow-")) / "folioflow.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, str(p.relative_to(root.parent)))
        sc.addPyFile(str(path))
        _shipped["app"] = sc.applicationId
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Where that is unset: one of our own if all runs on this machine (tests), else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "folioflow-shared")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; errors of the storage rise."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back: lineage is cut, and lost executors lose nothing."""
    spark = ship(df.sparkSession)
    path = f"{shared_dir(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_staged() -> None:
    """Deletes every staged table of this process; also runs at exit."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is already gone
            pass


atexit.register(drop_staged)


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that are no longer in use; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its scan has fewer splits than there are cores (few row groups, much work a row); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hints a broadcast only if ``df`` really has at most ``max_rows`` rows; else the optimizer picks the join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
