"""Exact and fuzzy deduplication with first-wins semantics."""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..runtime import released, ship, stage


def first_by_id(df: DataFrame, ident: str, order: str) -> DataFrame:
    """The first row of each stripped, non-empty id. One partially aggregated min_by, no window, so hot ids shrink early."""
    rows = df.withColumn("_id", strip(F.col(ident))).where("_id <> ''")
    return rows.groupBy("_id").agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def merged_provenance(df: DataFrame, key: str, order: str, lists: list[str]) -> DataFrame:
    """The first row of each key; its list columns get the union of all rows' items in order of first appearance.

    Items are reduced to one row per key and item before lists are built, so a hot key's list is as long as its distinct
    items. Null keys are dropped.
    """
    base = df.where(F.col(key).isNotNull())
    out = base.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c not in (key, *lists)]), order).alias("_r")).select(key, "_r.*")
    for name in lists:
        items = base.select(key, order, F.posexplode(name).alias("_p", "_v")).where("_v is not null").groupBy(key, "_v").agg(F.min(F.struct(order, "_p")).alias("_at"))
        items = items.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]).alias(name))
        out = out.join(items, key, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return out.select(*df.columns)


def by_first_key(df: DataFrame, by: list[str], keys: list[Column], order: str) -> DataFrame:
    """The first row of each group and key, the key being the first non-empty of ``keys``; rows without a key are kept."""
    k = F.coalesce(*[F.when(c != "", c) for c in keys])
    rows = df.withColumn("_k", k)
    once = rows.where("_k is not null").groupBy(*by, "_k").agg(F.min_by(F.struct(*df.columns), order).alias("r")).select("r.*")
    return once.unionByName(rows.where("_k is null").drop("_k"))


def greedy(df: DataFrame, order: str, keys: list[Column], extra: DataFrame | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Rows kept when each is dropped iff it shares a key with an already *kept* earlier row.

    ``keys``: Columns whose equal non-empty values make duplicates; ``extra``: further pairs (a, b) of order values;
    ``groups``: further keys (o, k), o an order value, whose rows are all duplicates of each other.
    Greedy in arrival order is the lexicographically first independent set. Each round settles, by aggregation on keys
    and not by pairs: an undecided row that is the first undecided one of all its keys, none of which a kept row holds,
    is kept; an undecided row is dropped if an earlier kept row holds one of its keys. Rounds follow chains of
    alternating keys, not group sizes: a group of copies that holds a third of all rows is settled in two. Every round
    settles the first undecided row at least, so they end.
    """
    base = stage(df.select(F.col(order).alias("_o"), *[F.when(k != "", k.cast("string")).alias(f"_k{i}") for i, k in enumerate(keys)]), "greedy")
    n = len(keys)
    flat = base.select("_o", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_k{i}").alias("k")) for i in range(n)])).alias("x")).select("_o", "x.i", "x.k").where("k is not null")
    if extra is not None:
        pair = F.concat_ws("|", F.least("a", "b").cast("string"), F.greatest("a", "b").cast("string"))
        flat = flat.unionByName(extra.select(F.explode(F.array("a", "b")).alias("_o"), F.lit(n).alias("i"), pair.alias("k")))
    if groups is not None:
        flat = flat.unionByName(groups.select(F.col("o").alias("_o"), F.lit(n + 1).alias("i"), F.col("k").cast("string").alias("k")))
    # Keys that one row alone holds settle nothing; a key of ``keys``, however long, is named by its first row.
    shared = flat.groupBy("i", "k").agg(F.min("_o").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    flat = stage(flat.join(shared, ["i", "k"]).select("_o", "i", F.when(F.col("i") < n, F.col("first").cast("string")).otherwise(F.col("k")).alias("k")), "greedy")
    kept = stage(base.join(flat.select("_o").distinct(), "_o", "left_anti").select("_o"), "greedy")
    undecided = flat
    while True:
        lead = undecided.groupBy("i", "k").agg(F.min("_o").alias("first"))
        sure = undecided.join(lead, ["i", "k"]).groupBy("_o").agg(F.min(F.col("_o") == F.col("first")).alias("all_first")).where("all_first").select("_o")
        sure = stage(sure, "greedy")
        kept = kept.unionByName(sure)
        taken = undecided.join(sure, "_o", "left_semi").groupBy("i", "k").agg(F.min("_o").alias("by"))
        gone = undecided.join(taken, ["i", "k"]).where("by < _o").select("_o").distinct()
        undecided = stage(undecided.join(sure, "_o", "left_anti").join(gone, "_o", "left_anti"), "greedy")
        if undecided.isEmpty():
            break
        released(df.sparkSession)
    return df.join(kept.select(F.col("_o").alias(order)), order, "left_semi")


def indel_similarity(a: str, b: str) -> float:
    """200 * longest common subsequence / (total length), 0 for an empty side."""
    if not a or not b:
        return 0.0
    # Bit-parallel longest common subsequence: zero bits of v count matches.
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return 200.0 * (len(a) - v.bit_count()) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_similarity(x, y) if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")


#: Rows of segments that are shuffled at a time; more texts take more passes, so the disk they need stays the same.
PASS_ROWS = 10_000_000
#: The characters that ``letters`` counts.
COUNTED = "abcdefghijklmnopqrstuvwxyz 01289"


def letters(text: Column) -> Column:
    """BIGINT: how often each of COUNTED stands in the text, modulo 4, as two bits in Gray code: an insertion or deletion changes one bit at most."""
    times = lambda c: F.pmod(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))), F.lit(4))
    gray = [F.shiftleft(F.element_at(F.array(*map(F.lit, (0, 1, 3, 2))), times(c) + 1).cast("bigint"), 2 * i) for i, c in enumerate(COUNTED)]
    return reduce(Column.bitwiseOR, gray)


def similar_texts(left: DataFrame, right: DataFrame, threshold: int = 96, once: bool = False) -> DataFrame:
    """left_text, right_text, similarity of the different texts (column text) at or above the threshold.

    Exact: with k = the most indels the threshold allows the right text of a pair (k as odd or even as the sum of their
    lengths), this text is cut into k + 1 segments. The first segment i up to whose end at most i indels fall has none, exactly i before it
    and at most k - i behind it (pigeonhole), so it stands in the other text, shifted by one of -i, -i + 2, ..., i places
    that k - i indels can still make up for. Segments meet by equality with the right text's length, so no cross join;
    counts of letters, which k indels change by k, go before pairs are kept, and edit distance, which is never above
    indels, sorts out the rest. The planner doesn't see how many segments a text has, so the join is a merge of shuffled
    rows by hint, in passes over the right texts' lengths. Empty and null texts match nothing. ``once``: both tables are
    the same; each pair of two different texts comes once, the shorter first.
    """
    spark = ship(left.sparkSession)
    cores = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    part = lambda df: stage(df.where("text <> ''").select("text").distinct().repartition(cores).select("text", F.xxhash64("text").alias("t"), F.length("text").alias("len"), letters(F.col("text")).alias("c")), "texts")
    l = part(left)
    r = l if once else part(right)
    # Lengths of partners: LCS is at most the shorter text, so 2 * short / (short + long) >= threshold / 100.
    low = lambda n: F.ceil(n * threshold / (200 - threshold)).cast("int")
    high = lambda n: F.floor(n * (200 - threshold) / threshold).cast("int")
    most = lambda b: F.floor((b + (b if once else high(b))) * (100 - threshold) / 100.0 + 1e-9).cast("int")
    cut = lambda n, k, i: F.floor(n * i / (k + 1)).cast("int")
    n, a, b, k, i = (F.col(x) for x in ("len", "a", "b", "k", "i"))

    def segments(df: DataFrame) -> DataFrame:
        """With b: length of the right text, k; segment i of the right one: at, size."""
        df = df.where("k >= 0").withColumn("i", F.explode(F.sequence(F.lit(0), k))).withColumn("at", cut(b, k, i))
        return df.withColumn("size", cut(b, k, i + 1) - F.col("at"))

    key = lambda at: F.xxhash64("b", "k", "i", F.substring("text", at + 1, F.col("size"))).alias("h")
    partners = l.select("text", "t", "c", n.alias("a"), F.explode(F.sequence(n if once else low(n), high(n))).alias("b")).withColumn("k", most(b) - F.pmod(most(b) + a + b, F.lit(2)))
    # About a quarter of (k + 1) (k + 3) places for each length of partners.
    rows = l.select(F.sum((high(n) - (n if once else low(n)) + 1) * (most(n) + 1) * (most(n) + 3) / 4)).first()[0] or 0
    passes = math.ceil(rows / PASS_ROWS)
    met = None
    for nth in range(passes):
        mine = F.pmod(b, F.lit(passes)) == nth
        rk = segments(r.select("text", "t", "c", n.alias("b")).where(mine).select("*", F.explode(F.array(most(b), most(b) - 1)).alias("k")))
        rk = rk.select(F.col("t").alias("rt"), F.col("c").alias("rc"), key(F.col("at")))
        lk = segments(partners.where(mine))
        gap, left_over = a - b, k - i
        first, last = F.greatest(-i, gap - left_over), F.least(i, gap + left_over)
        lk = lk.withColumns({"first": first, "last": last}).where("first <= last").withColumn("shift", F.explode(F.sequence("first", "last", F.lit(2)))).withColumn("p", F.col("at") + F.col("shift"))
        lk = lk.where((F.col("p") >= 0) & (F.col("p") <= a - F.col("size"))).select(F.col("t").alias("lt"), F.col("c").alias("lc"), "k", key(F.col("p")))
        near = (F.bit_count(F.col("lc").bitwiseXOR(F.col("rc"))) <= k) & (F.col("lt") != F.col("rt"))
        found = stage(lk.hint("merge").join(rk, "h").where(near).select("lt", "rt").distinct(), "met")
        met = found if met is None else met.unionByName(found)
        if passes > 1:
            del rk, lk
            released(spark)
    if met is None:
        return spark.createDataFrame([], "left_text string, right_text string, similarity double")
    met = met.join(l.select(F.col("t").alias("lt"), F.col("text").alias("left_text")), "lt").join(r.select(F.col("t").alias("rt"), F.col("text").alias("right_text")), "rt")
    near = F.expr(f"levenshtein(left_text, right_text, cast(floor((length(left_text) + length(right_text)) * {100 - threshold} / 100.0D + 1e-9D) as int)) >= 0")
    met = met.where(near)
    if once:
        met = met.where((F.length("left_text") < F.length("right_text")) | (F.col("left_text") < F.col("right_text")))
    out = stage(met.select("left_text", "right_text").withColumn("similarity", similarity("left_text", "right_text")).where(F.col("similarity") >= threshold), "similar")
    del met
    released(spark)
    return out


def fuzzy_pairs(left: DataFrame, right: DataFrame, threshold: int = 96) -> DataFrame:
    """left_id, right_id, similarity of the pairs of texts at or above the threshold, equal ones included. Both: id, text."""
    a = left.select(F.col("id").alias("left_id"), F.col("text").alias("left_text"))
    b = right.select(F.col("id").alias("right_id"), F.col("text").alias("right_text"))
    equal = a.where("left_text <> ''").join(b, F.col("left_text") == F.col("right_text")).select("left_id", "right_id", F.lit(100.0).alias("similarity"))
    return a.join(similar_texts(left, right, threshold), "left_text").join(b, "right_text").select("left_id", "right_id", "similarity").unionByName(equal)


def similar_groups(df: DataFrame, order: str, title: str, threshold: int = 96) -> DataFrame:
    """``greedy``'s groups by similar titles: each pair of similar titles is a key of all rows with either, so copies are not paired."""
    t = df.select(F.col(order).alias("o"), F.col(title).alias("text"))
    pair = F.struct(F.xxhash64("left_text", "right_text").alias("k"), F.array("left_text", "right_text").alias("both"))
    keys = similar_texts(t, t, threshold, once=True).select(pair.alias("p")).select("p.k", F.explode("p.both").alias("text"))
    return t.join(keys, "text").select("o", "k")


def known_reason(df: DataFrame, state: DataFrame, keys: list[tuple[str, str]], order: str, similar: tuple[str, str] | None = None) -> DataFrame:
    """Adds ``reason``: the first of ``keys`` (name, column) by which the row stands in ``state``; null for new rows.

    ``similar``: a last (name, column), by a similarity of 96 or more with a value in ``state``.

    State is reduced to distinct values of each key first, so a value that many stored rows share joins as one.
    """
    out = df
    for i, (_, column) in enumerate(keys):
        own = state.select(F.col(column).alias(f"_v{i}")).where(f"_v{i} <> ''").distinct().withColumn(f"_hit{i}", F.lit(True))
        out = out.join(own, F.col(column) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    reason = F.coalesce(*[F.when(F.col(f"_hit{i}"), F.lit(name)) for i, (name, _) in enumerate(keys)])
    out = out.withColumn("reason", reason).drop(*[f"_hit{i}" for i in range(len(keys))])
    if similar is None:
        return out
    name, column = similar
    out = stage(out, "known")
    fresh = out.where("reason is null").select(F.col(column).alias("text"))
    near = similar_texts(fresh, state.select(F.col(column).alias("text"))).select(F.col("left_text").alias("_v")).distinct().withColumn("_near", F.lit(True))
    out = out.join(near, F.col(column) == F.col("_v"), "left")
    return out.withColumn("reason", F.coalesce("reason", F.when(F.col("_near"), F.lit(name)))).drop("_v", "_near")


def union_in_order(frames: list[DataFrame], order: str) -> DataFrame:
    """Union by name with ``source_nth`` in front of ``order``, so arrival order is that of the list."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("source_nth", F.lit(i)) for i, f in enumerate(frames)])
