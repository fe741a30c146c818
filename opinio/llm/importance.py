"""Quality classifier by importance resampling.

Features are hashed words and pairs of adjacent words (A-Z lower-cased, whole
texts).  Two generative models give each of ``BUCKETS`` buckets a probability:
the target's from the documents that are labelled good and not toxic, the raw
one from all documents; both are smoothed by the raw model, as if ``ADDED`` of the target's features came from
it.  A document's log weight is the mean over its features of log(target / raw),
with ``NEUTRAL`` more features of ratio 1, times ``LENGTH``: the weight of a text
of that many features, so that long and short documents are compared on equal
terms, and a few words are little evidence.  (A plain sum ranks by length first; on
the test tables it rejects 62 % of the bad documents at the same share of good
ones kept, the mean 98 %, both among those that are not toxic.)  Its
key is the log weight plus a Gumbel draw made from a hash of the row, and the k
largest keys are the sample: a draw without replacement, with chances in
proportion to the weights.

k is the number of documents whose log weight reaches a threshold.  The
threshold is fitted on labelled documents the models did not see: the one with
the best mean of the shares of good documents kept and of others rejected, among
those that keep at least ``KEEP`` of the good ones.

A few toxic words do not move a mean over the whole text, so toxic text has evidence of its
own: a third model gives the share of documents labelled toxic that have a word
(by ``TOXIC_BUCKETS`` buckets; against that of all documents, smoothed as if ``TOXIC_ADDED`` more
documents were as expected), and a document's toxic evidence is the largest log
ratio of its words, at least 0.  Its threshold is fitted like the other, on good documents against toxic ones
the model did not see.  What is above it weighs ``LENGTH`` times the excess less than the
first threshold, if it does not weigh less already.

Labels are a sample of about ``LABELS`` labelled documents, taken by hash (all, if
fewer); half go into the target model, half into the threshold.  The raw model, the weights, k
and the cut cover every document.  The k-th key is found by narrowing a histogram, so no task
and not the driver ever holds more than ``BINS`` numbers.

Results for odd input: a null or blank text has weight 0 (no evidence); a
document without id has no label; a label counts as good only if all labels of
the id say so, and null labels are ignored; equal rows share their draw and stay or go
together; without good or without other labels every document is kept; without toxic labels nothing counts as toxic; an
empty table gives an empty result; other columns only enter the row hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import cut, free_name, quoted, row_hash, ship, texts_of, words_of

BUCKETS = 1 << 16
ADDED = 0.01
LENGTH = 1000.0
NEUTRAL = 50
TOXIC_BUCKETS = 1 << 18
TOXIC_ADDED = 5
LABELS = 50_000
KEEP = 0.998
BINS = 2048
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """Buckets of a text's words and adjacent pairs, repeats included."""
    return _features(_hashes(text))


def _hashes(text: str | None) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words)) + np.uint64(1)


def _words(h: np.ndarray) -> np.ndarray:
    """Buckets of the words for the toxic model."""
    return ((h * _MIX) >> np.uint64(46)).astype(np.int64) & (TOXIC_BUCKETS - 1)


def _features(h: np.ndarray) -> np.ndarray:
    if not len(h):
        return np.zeros(0, dtype=np.int64)
    pairs = (h[:-1] * _MIX ^ (h[1:] + _MIX)) * _MIX
    return (np.concatenate([h * _MIX, pairs]) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def sampled_labels(labels: DataFrame, id_col: str = "doc_id", most: int = LABELS) -> DataFrame:
    """``(id, good, toxic, fits)`` of about ``most`` labelled ids; ``fits``: for the models, else for the threshold."""
    known = labels.select(quoted(id_col).alias("id"), "quality", "toxic").filter("id IS NOT NULL AND quality IS NOT NULL")
    one = known.groupBy("id").agg(((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good"), (F.coalesce(F.max("toxic"), F.lit(0)) == 1).alias("toxic"))
    one = cut(one.withColumn("h", F.xxhash64("id")), "labels")
    share = min(1.0, most / max(1, one.count()))
    return one.filter(F.pmod(F.shiftright("h", 1), F.lit(1 << 20)) < int(share * (1 << 20))).select("id", "good", "toxic", (F.pmod("h", F.lit(2)) == 0).alias("fits"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """log(target / raw) of every bucket; ``labels`` as :func:`sampled_labels` gives them."""
    return models(docs, labels, id_col, text_col)[0]


def models(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """log(target / raw) of every bucket, and the toxic evidence of every word bucket."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        # documents, not words
        docs_raw, docs_toxic = np.zeros(TOXIC_BUCKETS, dtype=np.int64), np.zeros(TOXIC_BUCKETS, dtype=np.int64)
        for b in batches:
            for t, g, x in zip(texts_of(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist()):
                h = _hashes(t)
                found, words = _features(h), np.unique(_words(h))
                np.add.at(raw, found, 1)
                docs_raw[words] += 1
                if g:
                    np.add.at(good, found, 1)
                if x:
                    docs_toxic[words] += 1
        for kind, all_, some in ((0, raw, good), (1, docs_raw, docs_toxic)):
            at = np.flatnonzero(all_)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(all_[at]), pa.array(some[at])], names=["kind", "bucket", "raw", "some"])

    has = F.col("toxic") if "toxic" in labels.columns else F.lit(False)
    target = labels.filter("fits").select(F.col("id").alias("label_id"), "good", has.alias("toxic"))
    # the labels are a bounded sample
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    flagged = texts.join(F.broadcast(target), F.col("id") == F.col("label_id"), "left").select("text", F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False)))
    sums = flagged.mapInArrow(run, "kind int, bucket int, raw long, some long").groupBy("kind", "bucket").agg(F.sum("raw").alias("raw"), F.sum("some").alias("some"))
    # a word of no toxic document is no evidence; at most BUCKETS + TOXIC_BUCKETS rows
    got = cut(sums, "feature-counts").filter("kind = 0 OR some > 0").toArrow()
    kind, at, n, some = (got.column(i).to_numpy() for i in range(4))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[at[kind == 0]], good[at[kind == 0]] = n[kind == 0], some[kind == 0]
    p_raw = (raw + 1 / BUCKETS) / (raw.sum() + 1)
    added = ADDED * good.sum() + 1
    p_good = (good + added * p_raw) / (good.sum() + added)
    evidence, word = np.zeros(TOXIC_BUCKETS), kind == 1
    if word.any():
        # documents labelled toxic, of those in the model, against all documents
        expected = n[word] * (docs_of(texts, target.filter("toxic")) / texts.count())
        evidence[at[word]] = np.maximum(0.0, np.log((some[word] + TOXIC_ADDED) / (expected + TOXIC_ADDED)))
    return np.log(p_good) - np.log(p_raw), evidence


def docs_of(texts: DataFrame, labels: DataFrame) -> int:
    return texts.join(F.broadcast(labels.select("label_id")), F.col("id") == F.col("label_id"), "left_semi").count()


def log_weights(texts, ratios: np.ndarray, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log weight by the whole text, and the toxic evidence, of every text."""
    weights, toxic = [], []
    for t in texts:
        h = _hashes(t)
        found = _features(h)
        weights.append(LENGTH * ratios[found].sum() / (len(found) + NEUTRAL))
        toxic.append(evidence[_words(h)].max() if len(h) else 0.0)
    return np.array(weights, dtype=np.float64), np.array(toxic, dtype=np.float64)


def gumbel(tag: Column) -> Column:
    """A Gumbel draw from a row's hash."""
    u = (F.shiftrightunsigned(F.xxhash64(tag), 11) + F.lit(0.5)) / float(1 << 53)
    return -F.log(-F.log(u))


def weigh(docs: DataFrame, ratios: np.ndarray, evidence: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """``(id, draw, log_weight, clean)`` of every row; ``clean`` is the toxic evidence, negated."""
    ship(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast((ratios, evidence))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights, toxic = log_weights(texts_of(b.column(2)), *table.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(weights), pa.array(-toxic)], names=["id", "draw", "log_weight", "clean"])

    source = docs.select(quoted(id_col).alias("id"), gumbel(row_hash(docs, seed)).alias("draw"), quoted(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, draw double, log_weight double, clean double")


def threshold(weighed: DataFrame, labels: DataFrame, keep: float = KEEP, col: str = "log_weight") -> float | None:
    """The value of ``col`` from which a document counts as good; None without good or without other labels."""
    held = weighed.join(F.broadcast(labels.filter("NOT fits").select(F.col("id").alias("label_id"), "good")), F.col("id") == F.col("label_id"))
    pairs = held.groupBy("label_id", "good").agg(F.min(col)).collect()  # a bounded sample
    good = np.sort([w for _, g, w in pairs if g])
    bad = np.sort([w for _, g, w in pairs if not g])
    if not len(good) or not len(bad):
        return None
    cuts = np.unique(good[: int((1 - keep) * len(good)) + 1])
    scores = 1 - np.searchsorted(good, cuts) / len(good) + np.searchsorted(bad, cuts) / len(bad)
    best = cuts[len(cuts) - 1 - np.argmax(scores[::-1])]
    # half way to the best rejected document below
    below = bad[bad < best]
    return float((best + below[-1]) / 2) if len(below) else float(best)


def kth_largest(keys: DataFrame, col: str, k: int) -> float:
    """The k-th largest value (1 <= k <= rows), exactly: a histogram of ``BINS`` bins is narrowed until its bin holds one value."""
    low, high, above = *keys.agg(F.min(col), F.max(col)).first(), 0
    while low < high:
        inside = keys.filter((F.col(col) >= low) & (F.col(col) <= high))
        place = F.least(F.floor((F.col(col) - low) / F.lit((high - low) / BINS)), F.lit(BINS - 1)).alias("bin")
        for b, n, least, most in sorted(inside.groupBy(place).agg(F.count(F.lit(1)), F.min(col), F.max(col)).collect(), reverse=True):
            if above + n >= k:
                low, high = least, most
                break
            above += n
    return low


def sample(weighed: DataFrame, tau: float | None) -> float | None:
    """The least key that the Gumbel top-k keeps; None: every row is kept."""
    k = weighed.filter(F.col("log_weight") >= tau).count() if tau is not None else 0
    return kth_largest(weighed, "key", k) if k else None


def _classify(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, seed: int):
    marked = cut(sampled_labels(labels, "doc_id"), "label-sample")
    ratios, evidence = models(docs, marked, id_col, text_col)
    weighed = cut(weigh(docs, ratios, evidence, id_col, text_col, seed), "weights")
    tau = threshold(weighed, marked)
    limit = threshold(weighed, marked.filter("good OR toxic"), col="clean") if tau is not None else None
    if limit is not None:
        excess = F.lit(tau) + F.lit(LENGTH) * (F.col("clean") - F.lit(limit))
        weighed = weighed.withColumn("log_weight", F.when(F.col("clean") < F.lit(limit), F.least("log_weight", excess)).otherwise(F.col("log_weight")))
    weighed = weighed.select("id", "log_weight", (F.col("log_weight") + F.col("draw")).alias("key"))
    return weighed, ratios, evidence, tau, limit, sample(weighed, tau)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> tuple[DataFrame, np.ndarray, float | None]:
    """``(id, log_weight, key, kept)`` of every row, with the bucket ratios and the least key kept."""
    weighed, ratios, _, _, _, least = _classify(docs, labels, id_col, text_col, seed)
    kept = F.lit(True) if least is None else F.col("key") >= F.lit(least)
    return weighed.withColumn("kept", kept), ratios, least


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0) -> DataFrame:
    """The sampled rows with all their columns, without a shuffle of the texts: rows are weighed again where they are read."""
    _, ratios, evidence, tau, limit, least = _classify(docs, labels, id_col, text_col, seed)
    if least is None:
        return docs
    table = docs.sparkSession.sparkContext.broadcast((ratios, evidence))
    draw, whole = free_name(docs, "draw"), free_name(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_columns - 2
            weights, toxic = log_weights(texts_of(b.column(n + 1)), *table.value)
            if limit is not None:
                weights = np.where(-toxic < limit, np.minimum(weights, tau + LENGTH * (-toxic - limit)), weights)
            yield b.select(list(range(n))).filter(pa.array(weights + b.column(n).to_numpy() >= least))

    source = docs.select("*", gumbel(row_hash(docs, seed)).alias(draw), quoted(text_col).cast("string").alias(whole))
    return source.mapInArrow(run, docs.schema)


def op3(spark, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with their weights and keys."""
    read = spark.read.parquet
    kept, _, _ = classify(read(f"{sf_dir}/documents.parquet"), read(f"{sf_dir}/labels.parquet"))
    return kept.filter("kept").select(F.col("id").alias("doc_id"), "log_weight", F.col("key").alias("gumbel_key"))
