"""Readers of landed files, and the union of named sources with isolation of failures."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_cell, squeeze, strip
from ..runtime import exists, stage

#: Items of a works registry, as its pages hold them.
DATE_PARTS = T.StructType([T.StructField("date-parts", T.ArrayType(T.ArrayType(T.IntegerType())))])
_TEXTS = T.ArrayType(T.StringType())
WORK = T.StructType([
    T.StructField("DOI", T.StringType()), T.StructField("title", _TEXTS), T.StructField("author", T.ArrayType(T.StructType([T.StructField("given", T.StringType()), T.StructField("family", T.StringType())]))),
    T.StructField("container-title", _TEXTS), T.StructField("short-container-title", _TEXTS), T.StructField("group-title", T.StringType()),
    *[T.StructField(n, DATE_PARTS) for n in ("published", "published-print", "published-online", "issued", "created", "posted", "deposited", "indexed")],
    T.StructField("resource", T.StructType([T.StructField("primary", T.StructType([T.StructField("URL", T.StringType())]))])), T.StructField("URL", T.StringType()), T.StructField("abstract", T.StringType()), T.StructField("type", T.StringType()),
])
#: Items of a scholarly graph.
SCHOLAR = "paperId string, title string, authors array<struct<name:string>>, abstract string, publicationDate string, year string, url string, venue string, externalIds struct<DOI:string,ArXiv:string>"


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Objects, one a line; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "\t", multiline: bool = False) -> DataFrame:
    """Headed text table: columns by the header's names, in any order; those the file lacks are empty.

    Cells are stripped, null tokens emptied, overflow cells dropped, missing cells empty. ``multiline``: quoted cells may hold line
    breaks; such a file cannot be split, so it is asked for.
    """
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False, multiLine=multiline, escape='"', mode="PERMISSIVE")
    held = {c.strip().lower(): c for c in reversed(df.columns)}
    return df.select(*[(clean_cell(F.col(f"`{held[c.lower()]}`")) if c.lower() in held else F.lit("")).alias(c) for c in columns])


def bulk_table(spark: SparkSession, stem: str, columns: list[str]) -> DataFrame:
    """The table at ``stem``.tsv, or at ``stem``.csv where the first is absent or has no row."""
    for end, sep in ((".tsv", "\t"), (".csv", ",")):
        if exists(spark, stem + end):
            df = delimited(spark, stem + end, columns, sep)
            if not df.isEmpty():
                return df
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def cached(spark: SparkSession, path: str, load: Callable[[SparkSession], DataFrame], now: float, max_age: float) -> DataFrame:
    """A table kept as Parquet versions at ``path``: the newest that is at most ``max_age`` seconds old, else loaded anew.

    If loading fails, the newest version counts, however old; without one the failure rises. Versions are named by their
    time, and one that is incomplete never counts.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    done = sorted(int(n[2:]) for n in names if n.startswith("at") and n[2:].isdigit() and exists(spark, f"{path}/{n}/_SUCCESS"))
    if done and now - done[-1] <= max_age:
        return spark.read.parquet(f"{path}/at{done[-1]}")
    try:
        load(spark).write.mode("overwrite").parquet(f"{path}/at{int(now)}")
    except Exception:
        if not done:
            raise
        return spark.read.parquet(f"{path}/at{done[-1]}")
    return spark.read.parquet(f"{path}/at{int(now)}")


def tabbed_abstracts(lines: DataFrame, value: str = "value") -> DataFrame:
    """paper, abstract of malformed comma files: number, tab, rest of the line. Lines without a tab and the header go."""
    parts = F.split(F.col(value), "\t", 2)
    text = F.regexp_replace(strip(F.get(parts, 1)), r'^"|"?,*$', "")
    paper = strip(F.regexp_replace(F.get(parts, 0), '"', ""))
    return lines.where(F.col(value).contains("\t")).select(paper.alias("paper"), strip(text).alias("abstract")).where("lower(paper) <> 'paper'")


#: Entries of a feed; attributes begin with an underscore.
ENTRY = "id string, title string, summary string, published string, updated string, author array<struct<name:string>>, link array<struct<_href:string,_rel:string,_type:string>>"


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries of landed Atom feeds, read in parallel by row tag."""
    return spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)


def united(spark: SparkSession, sources: Mapping[str, Callable[[SparkSession], DataFrame]], schema: T.StructType) -> tuple[DataFrame, dict[str, str]]:
    """All sources' rows with ``source_handler`` and ``source_nth``, and the failures by name; a failing source counts as empty.

    Each source is staged by itself, so one that fails only while it is read is isolated too. An empty mapping gives no rows.
    """
    names = (T.StructField("source_handler", T.StringType()), T.StructField("source_nth", T.IntegerType()))
    out, failed = spark.createDataFrame([], T.StructType([*schema.fields, *names])), {}
    for nth, (name, load) in enumerate(sources.items()):
        try:
            df = stage(load(spark).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), "source")
        except Exception as e:  # noqa: BLE001 - isolation is the feature
            failed[name] = str(e).splitlines()[0] if str(e) else type(e).__name__
            continue
        out = out.unionByName(df.withColumns({"source_handler": F.lit(name), "source_nth": F.lit(nth)}))
    return out, failed
