"""Long exact spans shared between records, by compaction of a sparse de Bruijn graph of token k-mers.

Tokens are runs of word characters and single other characters; runs over LONG characters count as single characters, so
equal stretches of text have equal tokens except in the first and last LONG characters. From every token starts one
k-mer: the fewest tokens that cover REACH characters. K-mers are the graph's edges. Of every WINDOW characters only the
k-mer of least hash is kept (the rightmost of equals): a shared stretch of SPAN characters holds WINDOW places in a row
whose k-mers lie whole in it, so both texts keep the same one of them (see ``SPAN``). Kept neighbours overlap.

1. One scan hashes the texts (64-bit polynomial hashes of characters by prefix sums, vectorised over many texts) and keeps
   the k-mers as above. Those that stand in two documents or more remain, by an aggregation and a join on the hash.
2. A k-mer is unbranched if all its occurrences have the same successor and predecessor at the same distance. Joined
   back, each document's maximal unbranched stretches become one row each: a compacted path named by its first k-mer,
   with source coordinates. All copies of a path are cut at the same places, so paths meet by equality.
3. The coordinates are held against the texts: each path's characters are digested anew, and what lies around it, up to
   SPAN - REACH characters a side, is compared by hashes of prefixes. A path shorter than SPAN counts only for documents
   that also share enough around it: they meet in an exact window of SPAN characters that holds the path. So documents
   meet only in groups that really share a span, and no pair is made that is no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship, stage, table

#: Least shared span in characters, the longest run of word characters that counts as one token, least characters of a
#: k-mer, and the window of places of which one k-mer is kept. A k-mer ends less than LONG characters after REACH, so
#: WINDOW + REACH + 3 * LONG <= SPAN + 2 places every window that a shared span needs whole inside it.
SPAN, LONG, REACH, WINDOW = 400, 24, 200, 128
#: Characters around a path that can matter, and the step of the first of two rounds that measure how many are shared.
AROUND, COARSE = SPAN - REACH, 14
assert WINDOW + REACH + 3 * LONG <= SPAN + 2 and WINDOW < REACH and WINDOW & (WINDOW - 1) == 0
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
#: Characters handled at once (a longer text is a block of its own), and bits of a place in a segment of it.
_BLOCK, _PLACE = 1 << 17, 22
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

KMER = T.StructType([T.StructField("doc", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kmer", T.LongType())])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


def _scramble(codes: np.ndarray) -> np.ndarray:
    """A pseudo-random 64-bit value for each code point."""
    with np.errstate(over="ignore"):
        x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
        return x


def token_starts(codes: np.ndarray, wordlike: np.ndarray) -> np.ndarray:
    """Places where tokens begin. Every character that is part of no word run is a token of its own, white space too."""
    n = len(codes)
    w = wordlike[codes]
    change = np.flatnonzero(w[1:] != w[:-1]) + 1
    begins = np.concatenate([[0], change])
    sizes = np.diff(np.append(begins, n))
    runs = (w[begins] == 1) & (sizes <= LONG)
    start = np.repeat(~runs, sizes)
    start[begins] = True
    return np.flatnonzero(start)


def _wordlike() -> np.ndarray:
    """1 for letters, digits and underscore, else 0, for every code point."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if chr(cp).isalnum() or cp == 95:
            out[cp] = 1
    return out


def kept_places(order: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Sorted places that hold the least value (the rightmost of equals) of some window of WINDOW places.

    ``order``: 64-bit values, _NONE where no k-mer starts; ``inside``: for each place whether a window may start there.
    """
    out, size = [], 1 << (_PLACE - 1)
    low = np.uint64((1 << _PLACE) - 1)
    for a in range(0, len(order), size):
        v = order[a : a + size + WINDOW - 1]
        if len(v) < WINDOW:
            break
        v = np.where(v == _NONE, _NONE, (v & ~low) | (low - np.arange(len(v), dtype=np.uint64)))
        w = 1
        while w < WINDOW:
            v = np.minimum(v[:-w], v[w:])
            w *= 2
        v = v[inside[a : a + len(v)] & (v != _NONE)]
        at = (low - (v & low)).astype(np.int64) + a
        out.append(at[np.append(True, at[1:] != at[:-1])] if len(at) else at)
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def kmers(texts: list[str], tables: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text number, start, end, hash of the k-mers kept of each text, in order. ``tables`` is kept between calls."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    if tables.get("size", 0) < n:
        size = max(2 * _BLOCK, n)
        tables |= {"size": size, "power": _powers(_MULTIPLIER, size), "inverse": _powers(_INVERSE, size)}
    if "word" not in tables:
        tables["word"] = _wordlike()
    sizes = np.array([len(t) for t in texts]) + 1
    ends = np.cumsum(sizes) - 1
    end_of = np.repeat(ends, sizes)
    starts = token_starts(codes, tables["word"])
    where = np.searchsorted(starts, starts + REACH)
    whole = where < len(starts)
    begin, finish = starts[whole], starts[where[whole]]
    whole = finish <= end_of[begin]
    begin, finish = begin[whole], finish[whole]
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_scramble(codes) * tables["power"][:n], dtype=np.uint64, out=prefix[1:])
        h = (prefix[finish] - prefix[begin]) * tables["inverse"][begin]
        h ^= (finish - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        mixed = h * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
    order = np.full(n, _NONE)
    order[begin] = mixed
    at = np.searchsorted(begin, kept_places(order, np.arange(n) + WINDOW <= end_of))
    which = np.searchsorted(ends, begin[at])
    first = (ends - sizes + 1)[which]
    return which, begin[at] - first, finish[at] - first, h[at].view(np.int64)


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables: dict = {}
    for b in batches:
        doc, uid, texts = b["doc"].to_numpy(), b["uid"].to_numpy(), b["text"].tolist()
        block, size = 0, 0
        for k in range(1, len(texts) + 1):
            size += len(texts[k - 1])
            if k == len(texts) or size + len(texts[k]) > _BLOCK:
                which, s, e, h = kmers(texts[block:k], tables)
                if len(which):
                    at = np.arange(len(which)) - np.searchsorted(which, which)
                    yield pd.DataFrame({"doc": doc[block:k][which], "uid": uid[block:k][which], "at": at.astype(np.int32), "start": s.astype(np.int32), "end": e.astype(np.int32), "kmer": h})
                block, size = k, 0


def texts_of(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """doc, uid, text of the texts that can share a span. Rows with one id and one text are one; uid tells others apart."""
    ship(docs.sparkSession)
    return docs.select(F.col(ident).cast("long").alias("doc"), F.xxhash64(text).alias("uid"), F.col(text).alias("text")).where(F.col("doc").isNotNull() & (F.length("text") >= SPAN))


def _elsewhere(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that stand in two documents or more; aggregated before anything is joined, so hot keys shrink early."""
    return df.groupBy(*keys).agg(F.min("doc").alias("_lo"), F.max("doc").alias("_hi")).where("_lo < _hi").select(*keys)


def paths(texts: DataFrame) -> DataFrame:
    """doc, uid, path, start, end: each document's compacted repeated paths with their place (characters) in it."""
    edges = stage(texts.mapInPandas(_edges, KMER), "kmers")
    kept = stage(edges.join(_elsewhere(edges, "kmer"), "kmer").distinct(), "kmers")
    w = Window.partitionBy("doc", "uid").orderBy("at")

    def beside(step: Column, side) -> Column:
        return F.when(side("at").over(w) == F.col("at") + step, F.xxhash64(side("kmer").over(w), F.abs(side("start").over(w) - F.col("start"))))

    kept = kept.withColumns({"next": beside(F.lit(1), F.lead), "prev": beside(F.lit(-1), F.lag)})
    one = lambda c: (F.count(c) == F.count("*")) & (F.min(c) == F.max(c))
    stats = kept.groupBy("kmer").agg(one("next").alias("out_one"), one("prev").alias("in_one"))
    kept = kept.join(stats, "kmer")
    # A path begins where the k-mer before is not repeated, or branches, or this one is reached in several ways.
    joined = (F.lag("at").over(w) == F.col("at") - 1) & F.lag("out_one").over(w) & F.col("in_one")
    runs = kept.withColumn("run", F.sum(F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).over(w))
    return runs.groupBy("doc", "uid", "run").agg(F.min_by("kmer", "at").alias("path"), F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


PLACE = T.StructType([T.StructField("doc", T.LongType()), T.StructField("uid", T.LongType()), T.StructField("path", T.LongType()), T.StructField("digest", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for doc, uid, text, spans in zip(b["doc"], b["uid"], b["text"], b["spans"]):
            for p in spans:
                s, e = p["start"], p["end"]
                digest = xxhash.xxh3_64_intdigest(text[s:e].encode("utf-8", "surrogatepass")) - (1 << 63)
                out.append((doc, uid, p["path"], digest, s, e - s, text[max(0, s - AROUND) : s][::-1], text[e : e + AROUND]))
        if out:
            yield pd.DataFrame(out, columns=PLACE.names)


def places(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The paths with a digest of their characters and the characters around them (``left`` reads backwards)."""
    texts = texts_of(docs, ident, text)
    spans = paths(texts).groupBy("doc", "uid").agg(F.collect_list(F.struct("path", "start", "end")).alias("spans"))
    held = texts.join(spans, ["doc", "uid"]).select("doc", "uid", "text", "spans").mapInPandas(_places, PLACE)
    return stage(held, "places")


def around(found: DataFrame) -> DataFrame:
    """Adds reach_left, reach_right: the most characters before and behind that another document shares with the path.

    Equal surroundings are one row; the longest shared prefix is found in two rounds of hashes, coarse and fine.
    """
    sides = found.select("doc", "path", "digest", F.explode(F.create_map(F.lit("left"), F.col("left"), F.lit("right"), F.col("right"))).alias("side", "near"))
    sides = stage(sides.groupBy("path", "digest", "side", "near").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")), "around")
    keys = ["path", "digest", "side", "near"]

    def shared(rows: DataFrame) -> DataFrame:
        return rows.groupBy("h").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi")).where("_lo < _hi").select("h")

    level = F.xxhash64("path", "digest", "side", "n", F.expr("substring(near, 1, n)"))
    upto = lambda levels: F.filter(levels, lambda n: n <= F.length("near"))
    steps = upto(F.sequence(F.lit(0), F.lit(AROUND), F.lit(COARSE)))
    rows = stage(sides.withColumn("n", F.explode(steps)).withColumn("h", level), "around")
    far = stage(rows.join(shared(rows), "h").groupBy(*keys).agg(F.max(F.struct("n", "h")).alias("far")), "around")
    # Whoever has the prefix that somebody else got to takes part in the finer round from there.
    rows = rows.join(far.select("far.h").distinct(), "h").withColumn("n", F.explode(upto(F.sequence(F.col("n") + 1, F.col("n") + COARSE - 1)))).withColumn("h", level)
    more = rows.join(shared(rows), "h").groupBy(*keys).agg(F.max("n").alias("more"))
    known = sides.select(*keys).join(far, keys, "left").join(more, keys, "left").select(*keys, F.coalesce(F.greatest("far.n", "more"), F.lit(0)).alias("reach"))
    out = found
    for side in ("left", "right"):
        own = known.where(F.col("side") == side).select("path", "digest", F.col("near").alias(side), F.col("reach").alias(f"reach_{side}"))
        out = out.join(own, ["path", "digest", side])
    return out


def windows(short: DataFrame) -> DataFrame:
    """Of paths under SPAN (with reaches): doc, uid, start, size, ahead, key: exact windows of SPAN characters that hold the path and stand elsewhere.

    ``ahead``: characters of the window before the path. Only windows that both reaches allow are looked at.
    """
    lack = F.lit(SPAN) - F.col("size")
    span = F.sequence(F.greatest(F.lit(0), lack - F.col("reach_right")), F.least("reach_left", lack))
    all_ = short.where(F.col("reach_left") + F.col("reach_right") >= lack).withColumn("ahead", F.explode(span))
    key = F.xxhash64("path", "ahead", F.expr("substring(left, 1, ahead)"), F.expr(f"substring(right, 1, {SPAN} - size - ahead)"))
    all_ = all_.select("doc", "uid", "start", "size", "path", "digest", "ahead", key.alias("key"))
    return all_.join(_elsewhere(all_, "digest", "key"), ["digest", "key"])


def sharing_pairs(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_a, doc_b (doc_a < doc_b) of each pair of documents that share SPAN characters or more, verbatim.

    Null ids and texts share nothing; an id that stands twice counts as one document. Texts of any length are read whole.
    Groups that hold the same documents are paired once.
    """
    found = places(docs, ident, text)
    long = found.where(F.col("size") >= SPAN).select("doc", F.col("path").alias("key"), "digest")
    short = windows(around(found.where(F.col("size") < SPAN))).select("doc", "key", "digest")
    member = stage(long.unionByName(short).distinct(), "members")
    groups = member.groupBy("key", "digest").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("y")).where("lo < hi")
    once = groups.groupBy("lo", "hi", "n", "x", "y").agg(F.min(F.struct("key", "digest")).alias("g")).select("g.key", "g.digest")
    member = member.join(once, ["key", "digest"])
    a, b = member.withColumnRenamed("doc", "doc_a"), member.withColumnRenamed("doc", "doc_b")
    return a.join(b, ["key", "digest"]).where("doc_a < doc_b").select("doc_a", "doc_b").distinct()


def shared_parts(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, shared_chars, shared_part: how much of each document stands in another, in stretches of SPAN or more.

    Linear in the corpus: only each document's own paths are merged, no pairs are made, so groups of copies cost nothing.
    Documents without a shared stretch have shared_chars 0; a null text has no shared_part.
    """
    found = around(places(docs, ident, text))
    found = stage(found.select("doc", "uid", "path", "digest", "start", "size", "left", "right", "reach_left", "reach_right"), "places")
    lack = F.lit(SPAN) - F.col("size")
    short = windows(found.where(F.col("size") < SPAN)).groupBy("doc", "uid", "start").agg(F.max("ahead").alias("most"), F.min("ahead").alias("least"))
    grown = found.join(short, ["doc", "uid", "start"], "left").join(_elsewhere(found, "path", "digest"), ["path", "digest"])
    # Beyond a window that holds the path, what one side alone shares counts only if it makes up for all that is lacking.
    before = F.when(F.col("reach_left") >= lack, F.col("reach_left")).otherwise(F.col("most"))
    behind = F.when(F.col("reach_right") >= lack, F.col("reach_right")).otherwise(lack - F.col("least"))
    held = (F.col("size") >= SPAN) | F.col("most").isNotNull()
    p = grown.where(held).select("doc", "uid", (F.col("start") - before).alias("start"), (F.col("start") + F.col("size") + behind).alias("end"))
    w = Window.partitionBy("doc", "uid").orderBy("start", "end")
    ahead = F.coalesce(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = p.withColumn("own", F.greatest(F.lit(0), F.col("end") - F.greatest("start", ahead))).groupBy("doc", "uid").agg(F.sum("own").alias("shared_chars"))
    d = docs.select(F.col(ident).cast("long").alias("doc"), F.xxhash64(text).alias("uid"), F.length(text).cast("long").alias("n_chars"))
    out = d.join(part, ["doc", "uid"], "left").withColumn("shared_chars", F.coalesce("shared_chars", F.lit(0)))
    return out.select(F.col("doc").alias("doc_id"), "n_chars", "shared_chars", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).alias("shared_part"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_a, doc_b: documents that share a span of at least 400 characters."""
    return sharing_pairs(table(spark, sf_dir, "documents"))


def p8_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the part of it that stands in another."""
    return shared_parts(table(spark, sf_dir, "documents"))


QUERIES = {"p8_found": p8_found, "p8_parts": p8_parts}
SQL = {
    "p8_found": """
with g as (select distinct doc_id, hash(substr(text, i::bigint, 400)) h from (select doc_id, text, unnest(range(1, length(text) - 398)) i from documents where length(text) >= 400))
select distinct a.doc_id doc_a, b.doc_id doc_b from g a join g b using (h) where a.doc_id < b.doc_id""",
    "p8_parts": """
with g as (select doc_id, i, hash(substr(text, i::bigint, 400)) h from (select doc_id, text, unnest(range(1, length(text) - 398)) i from documents where length(text) >= 400)),
s as (select distinct doc_id, i from g where h in (select h from g group by h having min(doc_id) < max(doc_id))),
c as (select doc_id, sum(least(400, coalesce(lead_i - i, 400))) n from (select doc_id, i, lead(i) over (partition by doc_id order by i) lead_i from s) group by 1)
select doc_id, length(text)::bigint n_chars, coalesce(c.n, 0)::bigint shared_chars, case when length(text) > 0 then round(coalesce(c.n, 0) / length(text)::double, 6) end shared_part from documents left join c using (doc_id)""",
}
