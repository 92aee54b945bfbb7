"""Evaluation texts that leaked into training text: latent semantic retrieval, then checks on words.

Passages (windows of words) of the evaluation items and of a bounded sample of documents give a TF-IDF matrix over the
items' vocabulary, with inverse document frequencies counted over all documents. A distributed randomised SVD of it
(each task adds up its share of A'A times a seeded random matrix) gives the latent space. A passage has few words, so its
latent vector is the sum of their rows. Every passage of every document is searched by cosine in an inverted index of
the items' passages (spherical k-means; the PROBES nearest of about the square root of their number of lists). A passage
too light for an item is skipped by a bound that never drops a match. Candidates are verified on the whole text: longest
run of equal words, longest common subsequence around the passage, and the share of the item's telling words (names,
numbers, answers) found there.

The corpus is only scanned (no shuffle of texts): once for frequencies, once for each block of BLOCK_ITEMS items, the
stated query set.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship, stage, table

WORD = re.compile(r"[^\W_]+")
#: Words of a step, and steps of a passage. A run of RUN words lies whole in one passage, as its other steps hold RUN.
STEP, STEPS, RUN = 4, 4, 12
SIZE = STEP * STEPS
assert SIZE - STEP >= RUN
#: Rank of the latent space, oversampling, and the bounds of the sample it is fitted on and of a block of items.
RANK, OVERSAMPLE, FIT_DOCUMENTS, BLOCK_ITEMS = 64, 16, 1000, 20_000
#: Lists searched for each passage, least cosine of a candidate, and least weight of its passage against the lightest
#: passage of the items (squared norms).
PROBES, LEAST_COSINE, LEAST_WEIGHT = 4, 0.4, 0.2
#: A pair is a paraphrase if so much of the item stands in order and so many of its telling words are there.
PARAPHRASE_LCS, PARAPHRASE_KEYS = 0.5, 0.6


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, without case."""
    return WORD.findall((text or "").lower())


def passages(n: int) -> int:
    """How many passages n words have: one begins at every STEP words, as far as there are SIZE words or the end is not yet in one."""
    return max(1, -(-n // STEP) - STEPS + 1) if n else 0


class Batch:
    """Texts as places in a vocabulary, each filled up to whole steps; a last place stands for every other word."""

    def __init__(self, texts: list[list[str]], index: dict[str, int]):
        n = np.array([len(w) for w in texts], np.int64)
        steps = np.where(n > 0, np.maximum(-(-n // STEP), STEPS), 0)
        self.first = np.concatenate([[0], np.cumsum(steps)])  # number of the first step of each text
        ids = np.fromiter(map(index.get, chain.from_iterable(texts), repeat(len(index))), np.int32, int(n.sum()))
        self.ids = np.full(int(self.first[-1]) * STEP, len(index), np.int32)
        self.ids[np.arange(len(ids)) + np.repeat(self.first[:-1] * STEP - np.concatenate([[0], np.cumsum(n)[:-1]]), n)] = ids
        of = np.repeat(np.arange(len(texts)), steps)
        at = np.arange(len(of)) - self.first[of] if len(of) else of
        begins = at <= steps[of] - STEPS if len(of) else np.zeros(0, bool)
        self.begin, self.text, self.at = np.flatnonzero(begins), of[begins], at[begins] * STEP

    def windows(self, values: np.ndarray) -> np.ndarray:
        """Sums over each passage of a value or row for each place of the vocabulary."""
        per = values[self.ids]
        per = per.reshape(-1, STEP, *values.shape[1:]).sum(1)
        return sum((per[self.begin + k] for k in range(1, STEPS)), per[self.begin]) if len(self.begin) else per[:0]


def document_frequencies(docs: DataFrame, text: str, index: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many documents each vocabulary word stands, and the number of documents: counts over the whole corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        n, total = 0, np.zeros(len(index) + 1, np.int64)
        for b in batches:
            held = [index.get(w, -1) for t in b[text] for w in set(words(t))]
            total += np.bincount(np.array(held, np.int64) + 1, minlength=len(total))
            n += len(b)
        held = np.flatnonzero(total[1:])
        yield pd.DataFrame({"word": np.append(held, -1).astype("int32"), "n": np.append(total[1:][held], n)})

    rows = docs.select(text).mapInPandas(count, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(index), np.int64)
    for r in rows:
        if r.word >= 0:
            df[r.word] = r.n
    return df, next((r.n for r in rows if r.word == -1), 0)


def _gram(batch: Batch, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis for the TF-IDF rows A of the batch's passages. Only non-zero entries are touched."""
    out = np.zeros(basis.shape)
    y = batch.windows(np.append(idf[:, None] * basis, np.zeros((1, basis.shape[1])), axis=0))
    # Back to the words: a step takes part in up to STEPS passages, so their rows are added by step, then by word.
    steps = np.zeros((int(batch.first[-1]), basis.shape[1]))
    for k in range(STEPS):
        steps[batch.begin + k] += y
    known = np.flatnonzero(batch.ids < len(idf))
    if not len(known):
        return out
    known = known[np.argsort(batch.ids[known], kind="stable")]
    held, at = np.unique(batch.ids[known], return_index=True)
    out[held] = np.add.reduceat(steps[known // STEP], at, axis=0) * idf[held][:, None]
    return out


def latent_space(sample: DataFrame, text: str, own: Batch, index: dict[str, int], idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors (words x rank) of the passages of ``sample`` and ``own`` (the items' passages)."""
    spark = sample.sparkSession
    width = min(rank + OVERSAMPLE, len(idf))
    shared = spark.sparkContext.broadcast((index, idf))
    sample = sample.select(text)

    def gram(basis: np.ndarray) -> np.ndarray:
        """A'A times basis, added up task by task."""
        b = spark.sparkContext.broadcast(basis)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index, idf = shared.value
            total = np.zeros(b.value.shape)
            for batch in batches:
                for k in range(0, len(batch), 256):
                    total += _gram(Batch([words(t) for t in batch[text].iloc[k : k + 256]], index), idf, b.value)
            yield pd.DataFrame({"m": [total.astype(np.float32).tobytes()]})

        out = _gram(own, idf, basis)
        for r in sample.mapInPandas(part, "m binary").toLocalIterator():
            out += np.frombuffer(r.m, np.float32).reshape(out.shape)
        return out

    omega = np.random.default_rng(seed).standard_normal((len(idf), width))
    q, _ = np.linalg.qr(gram(omega))
    q, _ = np.linalg.qr(gram(q))
    values, vectors = np.linalg.eigh(q.T @ gram(q))
    keep = np.argsort(values)[::-1][:rank]
    keep = keep[values[keep] > 1e-6 * max(values.max(), 1e-12)]
    return (q @ vectors[:, keep]).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of zeros stay."""
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Lists:
    """An inverted index over unit vectors: spherical k-means with about the square root of their number of lists."""

    def __init__(self, vectors: np.ndarray, rounds: int = 6, seed: int = 3):
        n = max(1, math.isqrt(len(vectors)))
        self.centres = vectors[np.random.default_rng(seed).permutation(len(vectors))[:n]]
        for _ in range(rounds):
            near = self._nearest(vectors)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, near, vectors)
            held = np.bincount(near, minlength=n) > 0
            self.centres = np.where(held[:, None], unit(sums), self.centres).astype(np.float32)
        near = self._nearest(vectors)
        self.members = [np.flatnonzero(near == k) for k in range(n)]
        self.vectors = [vectors[m] for m in self.members]

    def _nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([(vectors[k : k + 4096] @ self.centres.T).argmax(1) for k in range(0, len(vectors), 4096)])

    def search(self, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row of x, number of the vector, cosine of the pairs at ``least`` or more in the PROBES nearest lists of each row."""
        near = x @ self.centres.T
        if near.shape[1] > PROBES:
            near = near >= np.partition(near, -PROBES, axis=1)[:, -PROBES, None]
        else:
            near = np.ones(near.shape, bool)
        found = []
        for k, (members, vectors) in enumerate(zip(self.members, self.vectors)):
            rows = np.flatnonzero(near[:, k])
            if len(rows) and len(members):
                cos = x[rows] @ vectors.T
                i, j = np.nonzero(cos >= least)
                found.append((rows[i], members[j], cos[i, j]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        return tuple(np.concatenate(c) for c in zip(*found))


def longest_run(a: list[str], b: list[str]) -> int:
    """Length of the longest run of equal words."""
    where: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        where.setdefault(w, []).append(j)
    best, prev = 0, {}
    for w in a:
        cur = {j: prev.get(j - 1, 0) + 1 for j in where.get(w, ())}
        best = max(best, max(cur.values(), default=0))
        prev = cur
    return best


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; bit-parallel, zero bits count matches."""
    masks: dict[str, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


FOUND = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("run", T.IntegerType()), T.StructField("lcs_share", T.DoubleType()), T.StructField("key_share", T.DoubleType())])


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """item_id, doc_id, cosine, run, lcs_share, key_share of every candidate pair that is verbatim or may be a paraphrase.

    run: most consecutive equal words in the whole text. lcs_share: longest common subsequence of the item and the
    document's words around the best passage, as a share of the item; key_share: share of the item's telling words (the
    rarest third by document frequency: its names, numbers and answer) that stand there. Candidates are left out that
    share too few words for RUN and for PARAPHRASE_LCS. Null ids and null or empty texts have no pairs; equal documents
    each count. Very long texts are read whole.
    """
    spark = ship(docs.sparkSession)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null and text <> ''")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("item_id is not null and text <> ''")
    out, last = None, None
    while True:  # the query set, in blocks of bounded size
        block = (asked if last is None else asked.where(F.col("item_id") > last)).orderBy("item_id").limit(BLOCK_ITEMS).collect()
        if not block:
            break
        last = block[-1].item_id
        found = _block(spark, d, [(r.item_id, words(r.text)) for r in block])
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], FOUND) if out is None else out


def _block(spark: SparkSession, d: DataFrame, block: list[tuple[int, list[str]]]) -> DataFrame:
    block = [(i, w) for i, w in block if w]
    index = {w: k for k, w in enumerate(sorted({w for _, ws in block for w in ws}))}
    if not index:
        return spark.createDataFrame([], FOUND)
    df, n = document_frequencies(d, "text", index)
    idf = np.log((n + 1) / (df + 1)) + 0.05
    own = Batch([w for _, w in block], index)
    sample = stage(d.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCUMENTS).repartition(8), "fit")
    space = latent_space(sample, "text", own, index, idf)
    space = np.append(idf[:, None] * space, np.zeros((1, space.shape[1])), axis=0).astype(np.float32)
    square = np.append(idf**2, 0.0)
    lists = Lists(unit(own.windows(space)))
    least = LEAST_WEIGHT * float(own.windows(square).min())
    keys = []
    for _, ws in block:
        ranked = sorted(dict.fromkeys(ws), key=lambda w: (df[index[w]], w))
        keys.append(set(ranked[: max(1, math.ceil(len(ranked) / 3))]))
    shared = spark.sparkContext.broadcast((block, index, square, space, lists, own.text, least, keys))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, index, square, space, lists, owner, least, keys = shared.value
        for b in batches:
            out = []
            for start in range(0, len(b), 128):
                ids, texts = b["doc_id"].iloc[start : start + 128].tolist(), [words(t) for t in b["text"].iloc[start : start + 128]]
                batch = Batch(texts, index)
                heavy = batch.windows(square) >= least
                batch.begin, batch.text, batch.at = batch.begin[heavy], batch.text[heavy], batch.at[heavy]
                x = unit(batch.windows(space))
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for c in range(0, len(x), 4096):
                    for i, j, cos in zip(*(a.tolist() for a in lists.search(x[c : c + 4096], LEAST_COSINE))):
                        pair = (int(batch.text[c + i]), int(owner[j]))
                        if cos > best.get(pair, (-1.0, 0))[0]:
                            best[pair] = (cos, int(batch.at[c + i]))
                for (k, o), (cos, s) in best.items():
                    item, ws = block[o][1], texts[k]
                    near = ws[max(0, s - len(item)) : s + SIZE + len(item)]
                    held, whole = set(near), set(ws)
                    rewritten = sum(w in held for w in item) >= PARAPHRASE_LCS * len(item)
                    if rewritten or sum(w in whole for w in item) >= RUN:
                        run, lcs = longest_run(item, ws), common_subsequence(item, near) / len(item)
                        if run >= RUN or lcs >= PARAPHRASE_LCS:
                            out.append((block[o][0], ids[k], cos, run, lcs, len(keys[o] & held) / len(keys[o])))
            yield pd.DataFrame(out, columns=FOUND.names)

    return d.mapInPandas(search, FOUND)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, doc_id: the document holds at least 12 consecutive words of the item."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).where(F.col("run") >= RUN).select("item_id", "doc_id")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item that leaked: documents that hold it verbatim, and those that paraphrase it."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    verbatim = F.col("run") >= RUN
    paraphrase = ~verbatim & (F.col("lcs_share") >= PARAPHRASE_LCS) & (F.col("key_share") >= PARAPHRASE_KEYS)
    return found.groupBy("item_id").agg(F.count_if(verbatim).alias("verbatim"), F.count_if(paraphrase).alias("paraphrased")).where("verbatim + paraphrased > 0")


QUERIES = {"p6_found": p6_found, "p6_report": p6_report}
SQL = {
    "p6_found": r"""
with w as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from eval_items),
e as (select item_id, array_to_string(w[i:i + 11], ' ') g from (select item_id, w, unnest(range(1, len(w) - 10)) i from w)),
d as (select doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' t, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from documents),
g as (select doc_id, array_to_string(w[i:i + 11], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 10)) i from d))
select distinct item_id, doc_id from e join g using (g)"""
}
