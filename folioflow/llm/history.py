"""New batches against all history: bit-difference fingerprints in rotated block tables.

A title's fingerprint is a 256-bit similarity hash of its letter trigrams. Titles that differ by a slip or two differ in
few bits, so one of the cyclic windows of 15 bits (one table for every 8th offset, 32 tables) is likely equal. New titles
look their windows up by equality, keep candidates by Hamming distance, verify the words, and are appended. The index
stores each different title once: fingerprint, windows (one place of an array for each table), words and first arrival. The
history is never fingerprinted again; of it a look-up reads windows and half of the fingerprint, and all other columns only for
candidates. Batches may be looked up one by one or several at a time; the result is the same, as every title is judged
by the titles and the vocabulary known up to its own batch.

Rows with equal canonical titles are one entry of the index, so groups of copies, however large, never meet pairwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rejects import strip
from ..runtime import shared_dir, ship, stage, table
from . import titles

BITS, WINDOW, STEP = 256, 15, 8
TABLES = BITS // STEP
#: Largest Hamming distance of candidates over all bits, and over the first half, which is looked at first; unrelated titles
#: lie near 105 (52 of the half), slips below 45 (23).
MAX_HAMMING, MAX_FIRST = 56, 36
_SLOTS = 1 << 14


def _planes() -> np.ndarray:
    """Seeded +1/-1 rows, one for each trigram slot."""
    return np.random.default_rng(20240101).integers(0, 2, (_SLOTS, BITS), dtype=np.int8) * 2 - 1


def fingerprint_bits(keys: list[str], planes: np.ndarray) -> np.ndarray:
    """One row of BITS booleans for each key; a key under three characters is padded."""
    out = np.zeros((len(keys), BITS), bool)
    for start in range(0, len(keys), 256):
        part = [k.encode().ljust(3, b"\0") for k in keys[start : start + 256]]
        lengths = np.array([len(k) - 2 for k in part])
        raw = np.frombuffer(b"".join(part), np.uint8).astype(np.uint32)
        gram = raw[:-2] * np.uint32(65599 * 65599 % 2**32) + raw[1:-1] * np.uint32(65599) + raw[2:]
        gram = (gram * np.uint32(2654435769)) >> np.uint32(18)
        ends = np.cumsum(lengths + 2)
        inside = np.ones(len(gram), bool)
        for back in (1, 2):
            at = ends[:-1] - back
            inside[at] = False
        sums = np.add.reduceat(planes[gram[inside]], np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0, dtype=np.int32)
        out[start : start + len(part)] = sums > 0
    return out


def _words64(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _windows(bits: np.ndarray) -> np.ndarray:
    """The cyclic windows as integers, one column for each table."""
    wide = np.concatenate([bits, bits[:, :WINDOW]], axis=1)
    power = 1 << np.arange(WINDOW, dtype=np.int32)
    return np.stack([wide[:, o : o + WINDOW] @ power for o in range(0, BITS, STEP)], axis=1).astype(np.int32)


TITLE = T.StructType([
    T.StructField("kid", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("cut", T.BooleanType()), T.StructField("first", T.LongType()), T.StructField("version", T.LongType()),
    *[T.StructField(f"f{i}", T.LongType()) for i in range(4)], T.StructField("blocks", T.ArrayType(T.IntegerType())),
])
VOCABULARY = T.StructType([T.StructField("word", T.StringType()), T.StructField("version", T.LongType()), T.StructField("n", T.LongType())])
IDS = T.StructType([T.StructField("id", T.StringType()), T.StructField("first", T.LongType())])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    planes = _planes()
    for b in batches:
        if len(b):
            bits = fingerprint_bits(["".join(w) for w in b["words"]], planes)
            w = _words64(bits)
            yield b.assign(**{f"f{i}": w[:, i] for i in range(4)}, blocks=list(_windows(bits)))[TITLE.names]


def readings(df: DataFrame, order: Column, version: Column) -> DataFrame:
    """arrival_no, version, id, kid, words, cut of each row; kid is null where the normalized title is empty or has no word."""
    x = titles.plain(F.when(F.trim(F.coalesce("title", F.lit(""))) != "", F.col("title")).otherwise(F.col("normalized_title")))
    x = F.when(F.coalesce("normalized_title", F.lit("")) != "", x)
    r = df.select(order.cast("long").alias("arrival_no"), version.cast("long").alias("version"), id_key(F.col("paper_id")).alias("id"), titles.words(x).alias("words"), titles.is_cut(x).alias("cut"))
    return r.withColumn("kid", F.when(F.size("words") > 0, F.xxhash64(F.array_join("words", ""))))


def entries(read: DataFrame) -> DataFrame:
    """kid, words, cut, first, version of each different title, as it stood at its first arrival (of equals the cut one)."""
    at = F.struct(F.col("arrival_no").alias("first"), "version", (~F.col("cut")).alias("whole"), "words")
    rows = read.where("kid is not null").groupBy("kid").agg(F.min(at).alias("r"))
    return rows.select("kid", "r.words", (~F.col("r.whole")).alias("cut"), "r.first", "r.version")


def candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs (kid, other) of entries that share a window and lie within MAX_HAMMING; other's entry is the earlier."""
    def spread(df: DataFrame, kid: str, half: str) -> DataFrame:
        rows = df.select(F.col("kid").alias(kid), F.col("f0").alias(f"{half}0"), F.col("f1").alias(f"{half}1"), F.posexplode("blocks").alias("tbl", "blk"))
        return rows.select(kid, f"{half}0", f"{half}1", F.shiftleft("tbl", WINDOW).bitwiseOR(F.col("blk")).alias("slot"))

    first = F.bit_count(F.col("a0").bitwiseXOR(F.col("b0"))) + F.bit_count(F.col("a1").bitwiseXOR(F.col("b1")))
    met = spread(asked, "kid", "a").join(spread(index, "other", "b"), "slot").where((F.col("kid") != F.col("other")) & (first <= MAX_FIRST))
    met = stage(met.select("kid", "other").distinct(), "met")
    own = asked.select("kid", "first", *[f"f{i}" for i in range(4)])
    other = index.select(F.col("kid").alias("other"), F.col("first").alias("other_first"), *[F.col(f"f{i}").alias(f"g{i}") for i in range(4)])
    apart = sum((F.bit_count(F.col(f"f{i}").bitwiseXOR(F.col(f"g{i}"))) for i in range(1, 4)), F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))))
    return met.join(own, "kid").join(other, "other").where((F.col("other_first") < F.col("first")) & (apart <= MAX_HAMMING)).select("kid", "other")


# ---------------------------------------------------------------- verification of words

ROMAN = frozenset("i ii iii iv v vi vii viii ix x xi xii".split())


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours, or most + 1. Only cells within ``most`` of the diagonal are filled."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[len(a) - 1 - j] == b[len(b) - 1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return len(a) + len(b)
    far = most + 1
    before, prev = [], [k if k <= most else far for k in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        cur = [far] * (len(b) + 1)
        if i <= most:
            cur[0] = i
        least = cur[0]
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            cost = prev[j - 1] + (x != y)
            if prev[j] < cost:
                cost = prev[j] + 1
            if cur[j - 1] < cost:
                cost = cur[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] < cost:
                cost = before[j - 2] + 1
            cur[j] = cost
            if cost < least:
                least = cost
        if least > most:
            return far
        before, prev = prev, cur
    return min(far, prev[-1])


def exact_token(w: str) -> bool:
    """Numbers and numerals tell works apart, so slips in them count as differences."""
    return w in ROMAN or any(c.isdigit() for c in w)


def slips(a: list[str], b: list[str], a_cut: bool, b_cut: bool, most: int = 5) -> list[tuple[str, str]] | None:
    """None if the titles differ by more than slips, else the pairs of differing words, still to be held against the vocabulary."""
    if a_cut or b_cut:
        if not a_cut or (b_cut and len("".join(a)) > len("".join(b))):
            a, b, b_cut = b, a, a_cut
        n = len("".join(a))
        if n < 20:
            return None
        kept, seen = [], 0
        for w in b:
            if seen >= n:
                break
            kept.append(w[: n - seen] if seen + len(w) > n else w)
            seen += len(w)
        b = kept
    found, total = [], 0
    for op, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            continue
        left, right = a[i:j], b[k:m]
        if "".join(left) == "".join(right):
            continue
        last = (a_cut or b_cut) and j == len(a) and m == len(b)
        if len(left) == len(right):
            for w, u in zip(left, right):
                if w == u:
                    continue
                if exact_token(w) or exact_token(u):
                    return None
                d = osa(w, u, 3)
                if d > 3 or (d > 1 and min(len(w), len(u)) < 5) or (d > 2 and min(len(w), len(u)) < 8):
                    return None
                total += d
                if not last and w + "s" != u and u + "s" != w:
                    found.append((w, u))
        else:
            if any(exact_token(w) for w in left + right) or not left or not right:
                return None
            d = osa("".join(left), "".join(right), 3)
            if d > 3:
                return None
            total += d
    return found if total <= most else None


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("w", T.StringType()), T.StructField("u", T.StringType())])))
def _slips(a: pd.Series, b: pd.Series, a_cut: pd.Series, b_cut: pd.Series) -> pd.Series:
    found = [slips(list(x), list(y), bool(p), bool(q)) for x, y, p, q in zip(a, b, a_cut, b_cut)]
    return pd.Series([None if f is None else [{"w": w, "u": u} for w, u in f] for f in found])


#: A word is established if at least this share of the titles hold it; two established words are not slips of each other.
ESTABLISHED_SHARE, ESTABLISHED_LEAST, BALANCE = 0.0008, 3, 0.02


def verified(pairs: DataFrame, asked: DataFrame, index: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (kid, other) whose titles differ by slips only, by the vocabulary known up to the version of kid.

    ``words``: word, version, n, the number of titles that brought the word in that version; the empty word counts titles.
    """
    k = asked.select("kid", "version", "words", "cut")
    o = index.select(F.col("kid").alias("other"), F.col("words").alias("other_words"), F.col("cut").alias("other_cut"))
    texts = pairs.join(k, "kid").join(o, "other")
    near = F.abs(F.length(F.array_join("words", "")) - F.length(F.array_join("other_words", ""))) <= 6
    texts = texts.where(near | F.col("cut") | F.col("other_cut"))
    judged = stage(texts.withColumn("subs", _slips("words", "other_words", "cut", "other_cut")).where("subs is not null").select("kid", "other", "version", "subs"), "slips")
    subs = judged.select("kid", "other", "version", F.explode("subs").alias("s")).select("kid", "other", "version", "s.w", "s.u")
    # How many titles held each word when the later title came: counts by version, added up over the versions up to it.
    needed = subs.select("version", F.explode(F.array("w", "u", F.lit(""))).alias("word")).distinct()
    counts = words.withColumnRenamed("version", "of").join(needed, "word").where("of <= version").groupBy("version", "word").agg(F.sum("n").alias("n"))
    for c in ("w", "u"):
        subs = subs.join(counts.select("version", F.col("word").alias(c), F.col("n").alias(f"n_{c}")), ["version", c])
    subs = subs.join(counts.where("word = ''").select("version", F.col("n").alias("titles")), "version")
    least, most = F.least("n_w", "n_u"), F.greatest("n_w", "n_u")
    differs = subs.where((least >= F.greatest(F.lit(ESTABLISHED_LEAST), F.col("titles") * ESTABLISHED_SHARE)) & (least >= BALANCE * most)).select("kid", "other").distinct()
    return judged.join(differs, ["kid", "other"], "left_anti").select("kid", "other")


def id_key(c: Column) -> Column:
    """Lower case, outer blanks and a trailing version mark aside; null where nothing follows the colon."""
    x = F.regexp_replace(F.lower(strip(c)), r"(?<=.)v[0-9]{1,3}$", "")
    return F.when((x != "") & ~x.rlike(r":\s*$"), x)


# ---------------------------------------------------------------- the stored index


class SeenIndex:
    """Titles with fingerprints and block windows, vocabulary and ids as Parquet, appended call by call in the shared folder.

    ``check`` returns the repeats among new rows against everything appended before and earlier new rows, and appends
    them. Each call writes folders of its own, which a repetition after a failure overwrites.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.calls, self.version = ship(spark), 0, 0
        self.path = path or f"{shared_dir(spark)}/folioflow/seen-{uuid.uuid4().hex}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        """What calls up to the present one appended."""
        if not self.calls:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/call={k}" for k in range(self.calls)])

    def _append(self, read: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Writes the titles and ids that are new; returns the titles written and the ids as they stood before."""
        before, ids = self._read("titles", TITLE), self._read("ids", IDS)
        fresh = entries(read).join(before.select("kid"), "kid", "left_anti") if self.calls else entries(read)
        at = f"call={self.calls}"
        columns = T.StructType(TITLE.fields[:5]).names
        fresh.select(*columns).mapInPandas(_fingerprints, TITLE).write.mode("overwrite").parquet(f"{self.path}/titles/{at}")
        written = self.spark.read.schema(TITLE).parquet(f"{self.path}/titles/{at}")
        word = F.explode(F.array_append(F.array_distinct("words"), "")).alias("word")
        written.select("version", word).groupBy("word", "version").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{self.path}/words/{at}")
        read.where("id is not null").groupBy("id").agg(F.min("arrival_no").alias("first")).write.mode("overwrite").parquet(f"{self.path}/ids/{at}")
        self.calls += 1
        return written, ids

    def append(self, rows: DataFrame) -> None:
        """Adds history: paper_id, title, normalized_title, all of it earlier than any arrival."""
        self._append(stage(readings(rows, F.lit(-1), F.lit(self.version)), "history"))
        self.version += 1

    def check(self, rows: DataFrame, batch: str | None = None) -> DataFrame:
        """arrival_no of the repeats among ``rows`` (arrival_no, paper_id, title, normalized_title), which are then part of the index.

        ``batch``: a column of whole numbers from 0 on, that of the row's batch, where the rows are several batches. Null ids, null and
        empty titles match nothing; a null arrival_no is no row; a null batch is batch 0. Equal rows repeat each other by arrival_no.
        """
        version = F.lit(self.version) + (F.coalesce(F.col(batch), F.lit(0)) if batch else F.lit(0))
        read = stage(readings(rows.where("arrival_no is not null"), F.col("arrival_no"), version), "arrivals")
        asked, before = self._append(read)
        self.version = (read.agg(F.max("version")).first()[0] or self.version) + 1
        index = self._read("titles", TITLE)
        links = verified(candidates(asked, index), asked, index, self._read("words", VOCABULARY))
        earlier = links.join(index.select(F.col("kid").alias("other"), F.col("first").alias("of")), "other").groupBy("kid").agg(F.min("of").alias("of"))
        own = read.where("kid is not null").select("kid").distinct()
        firsts = index.select("kid", "first").join(own, "kid", "left_semi").join(earlier, "kid", "left").select("kid", F.least("first", "of").alias("title_first"))
        known = before.join(read.where("id is not null").select("id").distinct(), "id", "left_semi").unionByName(read.where("id is not null").select("id", F.col("arrival_no").alias("first")))
        ids = known.groupBy("id").agg(F.min("first").alias("id_first"))
        found = read.select("arrival_no", "id", "kid").join(ids, "id", "left").join(firsts, "kid", "left")
        return stage(found.where((F.col("id_first") < F.col("arrival_no")) | (F.col("title_first") < F.col("arrival_no"))).select("arrival_no"), "repeats")


def repeats(history: DataFrame, incoming: DataFrame, batch: str | None = "batch_no") -> DataFrame:
    """arrival_no of each incoming row whose work stands in history or arrived earlier: all batches looked up at a time."""
    index = SeenIndex(history.sparkSession)
    index.append(history)
    return index.check(incoming, batch)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """arrival_no of the incoming rows whose work is known."""
    return repeats(table(spark, sf_dir, "accepted_papers"), table(spark, sf_dir, "incoming_papers"))


QUERIES = {"p3_found": p3_found}
SQL: dict[str, str] = {}
