"""The classifier against a plain version: dicts of features, FTRL-proximal one weight at a time, scores of whole frames."""

import math
import re
from zlib import crc32

import numpy as np
import pytest

from ordermart.llm import classifier
from ordermart.llm.frames import Scratch

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
BIAS = 1 << classifier.BITS


def plain_features(text):
    words = WORDS.findall((text or "").encode())
    size, counts, seen = 1 << classifier.BITS, {}, set()

    def add(index):
        counts[index] = counts.get(index, 0) + 1

    for word in words:
        add(crc32(word) % size)
        add((((word[-1] * 2) | word.isupper()) * 40503 + 77) % size)
    for a, b in zip(words, words[1:]):
        pair = (crc32(a) * 0x9E3779B1 + crc32(b) * 0x85EBCA77) % 2**64 >> 11
        add(pair % size)
        if pair in seen:
            add(crc32(b"<again>") % size)
        seen.add(pair)
    norm = math.sqrt(sum(n * n for n in counts.values()))
    return {i: n / norm for i, n in counts.items()}


def chance(z):
    return 1 / (1 + math.exp(-min(max(z, -35), 35)))


def plain_ftrl(rows, labels, updates, seed=3):
    alpha, beta, l1, l2 = classifier.ALPHA, classifier.BETA, classifier.L1, classifier.L2
    z, n = {}, {}

    def weight(i):
        own, free = z.get(i, 0.0), i == BIAS
        if not free and abs(own) <= l1:
            return 0.0
        shrunk = own if free else own - math.copysign(l1, own)
        return -shrunk / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + (0.0 if free else l2))

    rng = np.random.default_rng(seed)
    for _ in range(math.ceil(updates / len(rows))):
        for k in rng.permutation(len(rows)).tolist():
            row = {**rows[k], BIAS: 1.0}
            w = {i: weight(i) for i in row}
            error = chance(sum(w[i] * v for i, v in row.items())) - labels[k]
            error *= 0.5 * len(labels) / labels.count(labels[k])
            for i, v in row.items():
                slope, before = error * v, n.get(i, 0.0)
                n[i] = before + slope * slope
                z[i] = z.get(i, 0.0) + slope - (math.sqrt(n[i]) - math.sqrt(before)) / alpha * w[i]
    return {i: weight(i) for i in z}


def sample():
    rng = np.random.default_rng(7)
    common = "the river of small quiet words ran on".split()
    texts, labels = [], []
    for k in range(30):
        label = int(k % 3 == 0)
        own = ["Good", "prose", "follows."] if label else ["SPAM!!", "click", "NOW"]
        words = [str(w) for w in rng.choice(common + own, int(rng.integers(1, 14)))]
        texts.append(" ".join(words))
        labels.append(label)
    return texts + ["", "é ü é ü\té\nü", "same same same same"], labels + [1, 0, 0]


@pytest.mark.parametrize("text", [*sample()[0], None, " \n\t", "x", "A A A", "naïve 漢字 漢字 漢字 漢字", "w " * 70_000])
def test_features(text):
    index, value = classifier.features((text or "").encode())
    assert dict(zip(index.tolist(), value.tolist(), strict=True)) == pytest.approx(plain_features(text), rel=1e-12)


def test_ftrl():
    texts, labels = sample()
    rows = [classifier.features(t.encode()) for t in texts]
    got = classifier.ftrl(rows, np.array(labels, float), 500)
    expected = plain_ftrl([plain_features(t) for t in texts], labels, 500)
    assert set(np.nonzero(got)[0].tolist()) == {i for i, w in expected.items() if w}
    for i, w in expected.items():
        assert got[i] == pytest.approx(w, rel=1e-9, abs=1e-12)


def test_scores_of_a_frame(spark):
    """Training and scoring on Spark, one group of rows, against the plain weights."""
    texts, labels = sample()
    rows = [(t, y, k) for k, (t, y) in enumerate(zip(texts, labels, strict=True))]
    weights = classifier.train_classifier(spark.createDataFrame(rows[::-1], "text string, label int, key long").repartition(4), Scratch(spark))
    plain = plain_ftrl([plain_features(t) for t in texts], labels, classifier.UPDATES)
    asked = [*texts, None, "Good prose NOW", "words never seen"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in classifier.classify(docs, weights, "text").collect()}
    assert len(got) == len(asked)
    for i, text in enumerate(asked):
        z = plain[BIAS] + sum(plain.get(f, 0.0) * v for f, v in plain_features(text).items())
        assert got[i] == pytest.approx(chance(z), abs=1e-5)
