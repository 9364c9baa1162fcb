"""Quality classifier: logistic regression over hashed word n-grams, learned by follow-the-regularised-leader.

Features of a text are counts of hashed one- and two-word sequences, of the words' shapes (capitals, the last
character), and of two-word sequences that the text has had before; counts are scaled to unit length. Training takes a
bounded sample of labelled rows (``PER_LABEL`` of each label, by hash), split into groups of about ``SHARD_ROWS``;
each group runs FTRL-proximal for about ``UPDATES`` rows and the weights are averaged. A model is ``1 << BITS`` numbers, whatever the
table, and that is what tasks get. Scoring is a sparse dot product per text, without a shuffle.

Defined results: null and empty texts have no features and get the bias alone. A document labelled twice counts once
per label row. Without any label the score is 0.5. A null id is in the fold of the empty text. Repeated rows each get
their score; an empty table gives an empty result.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.frames import Scratch, word_blocks
from ordermart.llm.samples import fold, stratified

BITS = 18
PER_LABEL = 3000
SHARD_ROWS = 1024
UPDATES = 8192
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.001, 0.01
MASK = (1 << BITS) - 1
# Index of the feature that counts two-word sequences the text has had before.
AGAIN = crc32(b"<again>") & MASK


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices and counts, scaled to unit length."""
    hashes, shapes, pairs, before = [], [], [], None
    for words in word_blocks(text):
        if not words:
            continue
        h = np.fromiter(map(crc32, words), np.uint64, len(words))
        hashes.append(h & np.uint64(MASK))
        shape = [(w[-1] << 1) | w.isupper() for w in words]
        shapes.append((np.array(shape, np.uint64) * np.uint64(40503) + np.uint64(77)) & np.uint64(MASK))
        joined = h if before is None else np.concatenate((before, h))
        pairs.append((joined[:-1] * np.uint64(0x9E3779B1) + joined[1:] * np.uint64(0x85EBCA77)) >> np.uint64(11))
        before = h[-1:]
    if not hashes:
        return np.empty(0, np.int64), np.empty(0)
    pair = np.concatenate(pairs)
    again = len(pair) - len(np.unique(pair))
    index = np.concatenate([*hashes, *shapes, pair & np.uint64(MASK), np.full(again, AGAIN, np.uint64)])
    index, counts = np.unique(index.astype(np.int64), return_counts=True)
    return index, counts / np.sqrt(np.dot(counts, counts))


def _probability(z: float) -> float:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, updates: int = UPDATES, seed: int = 3) -> np.ndarray:
    """Weights after FTRL-proximal passes; the last entry is the bias, which is not regularised."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(index: np.ndarray) -> np.ndarray:
        free = index == size - 1
        own = z[index]
        shrunk = np.sign(own) * np.maximum(np.abs(own) - np.where(free, 0.0, L1), 0.0)
        return -shrunk / ((BETA + np.sqrt(n[index])) / ALPHA + np.where(free, 0.0, L2))

    # Both labels weigh the same in total, so that 0.5 stays the boundary where one is rare.
    share = {v: 0.5 * len(labels) / max(1, (labels == v).sum()) for v in (0.0, 1.0)}
    rng = np.random.default_rng(seed)
    for _ in range(-(-updates // max(1, len(rows)))):
        for k in rng.permutation(len(rows)).tolist():
            index, value = np.append(rows[k][0], size - 1), np.append(rows[k][1], 1.0)
            w = weights(index)
            slope = share[labels[k]] * (_probability(w @ value) - labels[k]) * value
            step = (np.sqrt(n[index] + slope * slope) - np.sqrt(n[index])) / ALPHA
            z[index] += slope - step * w
            n[index] += slope * slope
    return weights(np.arange(size))


def train_classifier(texts: DataFrame, scratch: Scratch) -> np.ndarray:
    """Averaged weights. texts: a bounded sample of text, label (0 or 1), key (a hash of the row)."""
    sample = scratch.write(texts, "sample")

    def learn(table: pa.Table) -> pa.Table:
        order = np.argsort(table["key"].to_numpy(), kind="stable")
        rows = [features((t.as_py() or "").encode()) for t in table["text"].take(pa.array(order))]
        w = ftrl(rows, table["label"].to_numpy()[order].astype(float))
        used = np.nonzero(w)[0]
        return pa.table({"feature": pa.array(used, pa.int64()), "weight": pa.array(w[used])})

    shards = sample.withColumn("shard", F.pmod("key", F.lit(max(1, sample.count() // SHARD_ROWS))))
    parts = shards.groupBy("shard").applyInArrow(learn, "feature long, weight double")
    groups = max(1, shards.select("shard").distinct().count())
    averaged = parts.groupBy("feature").agg(F.sum("weight").alias("weight")).toArrow()  # at most 1 << BITS rows
    w = np.zeros((1 << BITS) + 1)
    w[averaged["feature"].to_numpy()] = averaged["weight"].to_numpy() / groups
    return w


def classify(docs: DataFrame, weights: np.ndarray, text: str) -> DataFrame:
    """``docs`` without its text, with ``score``."""
    rest = [c for c in docs.columns if c not in (text, "score")]
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def each(batches):
        w = shared.value
        for batch in batches:
            scores = []
            for t in batch.column(text).cast(pa.binary()):
                index, value = features(t.as_py() or b"")
                scores.append(_probability(float(w[index] @ value) + float(w[-1])))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(scores, pa.float64())], names=[*rest, "score"])

    return docs.mapInArrow(each, T.StructType([docs.schema[c] for c in rest] + [T.StructField("score", T.DoubleType())]))


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scratch = Scratch(spark)
    held_out = fold(F.col("doc_id"), 3) == 1
    chosen = labels.where(~held_out & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"), F.xxhash64("doc_id").alias("key"))
    chosen = stratified(chosen, "label", F.col("key"), PER_LABEL, scratch)  # the sample's ids, before any text is read
    texts = docs.join(F.broadcast(scratch.write(chosen, "chosen")), "doc_id").select("text", "label", "key")
    weights = train_classifier(texts, scratch)
    scored = classify(docs.select("doc_id", held_out.alias("held_out"), "text"), weights, "text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
