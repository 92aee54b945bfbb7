"""Mixing sources to target weights: capped water-filling and seeded sampling.

Sizes are tokens of a public tokenizer, counted once per text. Each source's epochs follow from its share of the total,
clamped at its maximum; what clamped sources cannot give is spread over the others in proportion to their shares, until
nothing is clamped anew. A record stands in the mixture once per whole epoch, and the fraction that is left takes whole
records in seeded order up to its tokens.

The seeded order is summed in two levels: token totals of hash buckets (partially aggregated, a fixed number for each
source) tell which bucket the fraction ends in, and only that bucket's records are put in order. So no source, however
large its part of the corpus, is sorted or held in one task.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import ship, small, stage, table

#: Vocabulary file of a public tokenizer, on the driver; tasks get it from there.
TOKENIZER = os.environ.get("FOLIOFLOW_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: how byte-level BPE splits text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
BUCKETS = 4096


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str | None], path: str = TOKENIZER) -> list[int]:
    """Tokens of each text; a null has none. Strings of special tokens are ordinary text."""
    enc = _encoding(path)
    return [len(enc.encode_ordinary(t)) if t else 0 for t in texts]


def with_tokens(df: DataFrame, text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """Adds ``tokens``. The vocabulary file is served to the executors by the driver."""
    ship(df.sparkSession).sparkContext.addFile(path)
    name = os.path.basename(path)

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = SparkFiles.get(name)
        for b in batches:
            yield pd.Series(count_tokens(b.tolist(), own), dtype="int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("tokens", F.pandas_udf(count, "bigint")(F.col(text)))


def water_fill(shares: dict[str, float], sizes: dict[str, int], repeats: dict[str, int], total: float | None = None) -> dict[str, float]:
    """Tokens that each source gives. ``total``: what the mixture should hold, by default what the listed sources hold.

    Negative shares count as 0. The total is lowered to what all sources with a share can give at their caps.
    """
    caps = {s: max(0, repeats[s]) * sizes.get(s, 0) for s, w in shares.items() if w > 0}
    want = min(float(sum(sizes.get(s, 0) for s in shares)) if total is None else float(total), float(sum(caps.values())))
    give = {s: 0.0 for s in shares}
    free, left = set(caps), want
    while free:
        scale = left / sum(shares[s] for s in free)
        over = {s for s in free if caps[s] <= shares[s] * scale}
        if not over:
            give |= {s: shares[s] * scale for s in free}
            break
        give |= {s: float(caps[s]) for s in over}
        left = max(0.0, left - sum(caps[s] for s in over))
        free -= over
    return give


def plan(docs: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """source, target_share, max_repeats, size, whole, rest: whole epochs and the tokens of the fractional one.

    ``docs``: source, tokens. The sources in ``targets`` are few by their nature; over 100 000 are refused. A source
    listed twice takes its last row by share and cap; one without records gives nothing.
    """
    rows = targets.where("source is not null").groupBy("source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("source", "t.*").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("too many sources in targets")
    sizes = {r.source: r.n for r in docs.select("source", "tokens").join(small(targets.select("source").distinct(), 100_000), "source", "left_semi").groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    shares, caps = {r.source: r.target_share or 0.0 for r in rows}, {r.source: r.max_repeats or 0 for r in rows}
    give = water_fill(shares, sizes, caps, total)
    out = []
    for s in shares:
        size = sizes.get(s, 0)
        whole = min(caps[s], int(give[s] / size + 1e-9)) if size else 0
        rest = 0.0 if whole >= caps[s] else max(0.0, give[s] - whole * size)
        out.append((s, float(shares[s]), int(caps[s]), int(size), int(whole), float(rest)))
    return docs.sparkSession.createDataFrame(out, "source string, target_share double, max_repeats int, size bigint, whole int, rest double")


def mixture(docs: DataFrame, planned: DataFrame, seed: int = 1, ident: str = "doc_id") -> DataFrame:
    """doc_id, source, tokens, repeats (1 or more) of the records in the mixture. ``docs``: doc_id, source, tokens.

    The fractional epoch takes records in seeded order while their tokens do not exceed it. Null ids take part (equal
    ones share a place in the order); null sources and texts of no tokens give nothing.
    """
    key = F.xxhash64(F.lit(seed), F.col(ident).cast("string"))
    d = docs.select(ident, "source", "tokens").where("tokens > 0").join(small(planned, 100_000), "source").withColumn("_key", key).withColumn("_bucket", F.pmod("_key", F.lit(BUCKETS)))
    totals = d.where("rest > 0").groupBy("source", "_bucket").agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("_before", F.coalesce(before, F.lit(0)))
    d = d.join(totals.select("source", "_bucket", "_before", (F.col("_before") + F.col("n")).alias("_after")), ["source", "_bucket"], "left")
    inside = F.col("_after") <= F.col("rest")
    border = ~inside & (F.col("_before") < F.col("rest"))
    upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("_key", ident))
    edge = d.where(border).select("*", (F.col("_before") + upto).alias("_upto")).withColumn("_extra", F.when(F.col("_upto") <= F.col("rest"), 1).otherwise(0)).drop("_upto")
    rest = d.where(~F.coalesce(border, F.lit(False))).withColumn("_extra", F.when(F.coalesce(inside, F.lit(False)), 1).otherwise(0))
    return rest.unionByName(edge).select(ident, "source", "tokens", (F.col("whole") + F.col("_extra")).alias("repeats")).where("repeats > 0")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens of all documents: texts are tokenized once, then only sizes are handled."""
    return stage(with_tokens(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "tokens"), "tokens")


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, tokens, repeats of the mixture of documents to mix_targets."""
    docs = counted(spark, sf_dir)
    return mixture(docs, plan(docs, table(spark, sf_dir, "mix_targets")))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source: target and reached share, size, epochs, records, tokens reached, whether its cap binds."""
    docs = counted(spark, sf_dir)
    planned = plan(docs, table(spark, sf_dir, "mix_targets"))
    got = mixture(docs, planned).groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached_tokens"), F.count("*").alias("records"), F.max("repeats").alias("most_repeats"))
    whole: Column = F.sum("reached_tokens").over(Window.partitionBy())
    out = planned.join(got, "source", "left").fillna(0, ["reached_tokens", "records", "most_repeats"])
    return out.select(
        "source", "target_share", "max_repeats", "size", "reached_tokens", "records", "most_repeats",
        F.when(whole > 0, F.round(F.col("reached_tokens") / whole, 6)).alias("reached_share"),
        (F.col("whole") >= F.col("max_repeats")).alias("capped"),
    )


QUERIES = {"p7_mixture": p7_mixture, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
