"""Language of a text by a bidirectional gated recurrent network over its bytes.

Every byte is read with its neighbours on both sides and gets a probability per language; a document's probabilities are
the mean over its bytes. The network is small (``HIDDEN`` units each way) and written in numpy: softsign takes the place
of tanh and, shifted, of the logistic function, which costs a third and learns as well. Training is backpropagation
through time with Adam on windows of a bounded sample (``PER_LANGUAGE`` documents of each language, chosen by hash),
in one task; its size does not grow with the table.

Whole texts are read in windows of ``SPAN`` bytes that run side by side in one matrix, so the work is a few array
operations per byte column. The weights (a few thousand numbers) are all that is sent to the tasks.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is everything if nothing can be
learned. With one language in training, it is always predicted. A null id is in the fold of the empty text. Repeated rows
each get their prediction; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.frames import Scratch
from ordermart.llm.samples import fold, stratified

HIDDEN = 10
SPAN = 128
LANES = 4096
PER_LANGUAGE = 800
WINDOWS_PER_DOC = 4
TRAIN_SPAN = 64
STEPS, BATCH, RATE, SEED = 500, 128, 0.02, 11
UNKNOWN = "und"
# Letters, and a few numerals that are sorted out after.
LETTER = re.compile(r"[^\W\d_]")
GATES = ("z", "r", "c")


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text or ""))


def _softsign(a: np.ndarray, free: np.ndarray) -> np.ndarray:
    np.abs(a, out=free)
    free += 1
    a /= free
    return a


def new_weights(languages: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    """Per direction and gate a table by byte and a recurrent matrix; and the output layer."""
    rng = np.random.default_rng(seed)
    w = {}
    for way in ("f", "b"):
        for gate in GATES:
            w[f"{way}{gate}_in"] = rng.normal(0, 0.5, (256, hidden)).astype(np.float32)
            w[f"{way}{gate}_re"] = (rng.normal(0, 1, (hidden, hidden)) / np.sqrt(hidden)).astype(np.float32)
        w[f"{way}_out"] = (rng.normal(0, 1, (hidden, languages)) / np.sqrt(hidden)).astype(np.float32)
    w["bias"] = np.zeros(languages, np.float32)
    return w


def states(w: dict, way: str, bytes_: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """Hidden states (time, lane, unit) of one direction. bytes_: (time, lane). trace keeps the gates for training."""
    span, lanes = bytes_.shape
    hidden = w["fz_re"].shape[0]
    out = np.empty((span, lanes, hidden), np.float32)
    h = np.zeros((lanes, hidden), np.float32)
    z, r, c, free = (np.empty_like(h) for _ in range(4))
    for t in range(span) if way == "f" else range(span - 1, -1, -1):
        x = bytes_[t]
        for gate, a in (("z", z), ("r", r)):
            np.take(w[f"{way}{gate}_in"], x, axis=0, out=a, mode="clip")
            a += np.matmul(h, w[f"{way}{gate}_re"], out=free)
            _softsign(a, free)
            a *= 0.5
            a += 0.5
        np.take(w[f"{way}c_in"], x, axis=0, out=c, mode="clip")
        rh = r * h
        c += np.matmul(rh, w[f"{way}c_re"], out=free)
        _softsign(c, free)
        if trace is not None:
            trace[t] = (x, h.copy(), z.copy(), r.copy(), c.copy(), rh)
        h += z * (c - h)
        out[t] = h
    return out


def label_positions(w: dict, bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities (time, lane, language) of every position, and both directions' states."""
    ahead, back = states(w, "f", bytes_), states(w, "b", bytes_)
    logits = ahead @ w["f_out"]
    logits += back @ w["b_out"]
    logits += w["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    return logits, ahead, back


def gradients(w: dict, bytes_: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy over all labelled positions, by backpropagation through time."""
    traces = {"f": {}, "b": {}}
    seen = {way: states(w, way, bytes_, traces[way]) for way in ("f", "b")}
    logits = seen["f"] @ w["f_out"] + seen["b"] @ w["b_out"] + w["bias"]
    p = np.exp(logits - logits.max(axis=2, keepdims=True))
    p /= p.sum(axis=2, keepdims=True)
    p[:, np.arange(len(labels)), labels] -= 1
    p *= (mask / max(mask.sum(), 1))[:, :, None]
    g = {name: np.zeros_like(a) for name, a in w.items()}
    g["bias"] = p.sum(axis=(0, 1))
    span = len(bytes_)
    for way in ("f", "b"):
        g[f"{way}_out"] = np.tensordot(seen[way], p, ((0, 1), (0, 1)))
        from_above = p @ w[f"{way}_out"].T
        dh = np.zeros_like(seen[way][0])
        for t in range(span - 1, -1, -1) if way == "f" else range(span):
            x, h, z, r, c, rh = traces[way][t]
            dh = dh + from_above[t]
            dc = dh * z * (1 - np.abs(c)) ** 2
            gate_slope = lambda a: 0.5 * (1 - np.abs(2 * a - 1)) ** 2
            dz = dh * (c - h) * gate_slope(z)
            drh = dc @ w[f"{way}c_re"].T
            dr = drh * h * gate_slope(r)
            for gate, d, into in (("z", dz, h), ("r", dr, h), ("c", dc, rh)):
                np.add.at(g[f"{way}{gate}_in"], x, d)
                g[f"{way}{gate}_re"] += into.T @ d
            dh = dh * (1 - z) + drh * r + dz @ w[f"{way}z_re"].T + dr @ w[f"{way}r_re"].T
    return g


def trained(windows: list[bytes], labels: np.ndarray, languages: int, steps: int = STEPS, seed: int = SEED) -> dict:
    """Adam over random batches; a row's language is drawn evenly, so rare languages weigh as much."""
    w = new_weights(languages, seed=seed)
    rng = np.random.default_rng(seed)
    of_label = [np.nonzero(labels == k)[0] for k in range(languages)]
    first = {name: np.zeros_like(a) for name, a in w.items()}
    second = {name: np.zeros_like(a) for name, a in w.items()}
    for step in range(1, steps + 1):
        rows = [int(rng.choice(of_label[k])) for k in rng.integers(0, languages, BATCH)]
        bytes_, mask = laid_out([windows[k] for k in rows], TRAIN_SPAN)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, grad in gradients(w, bytes_, mask, labels[rows]).items():
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.01 * (grad * grad - second[name])
            m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
            w[name] = (w[name] - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return w


def laid_out(windows: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows as columns (time, lane), short ones filled with zero bytes, and a mask of real bytes."""
    joined = np.frombuffer(b"".join(x.ljust(span, b"\0") for x in windows), np.uint8).reshape(-1, span)
    lengths = np.fromiter(map(len, windows), np.int64, len(windows))
    mask = np.arange(span)[:, None] < lengths[None, :]
    return np.ascontiguousarray(joined.T).astype(np.intp), mask.astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    weights: dict

    def pooled(self, texts: list[bytes], span: int = SPAN, lanes: int = LANES) -> np.ndarray:
        """Mean probabilities (text, language). Windows of all texts share the lanes."""
        total = np.zeros((len(texts), len(self.languages)))
        owners, windows = [], []

        def flush():
            bytes_, mask = laid_out(windows, span)
            p, _, _ = label_positions(self.weights, bytes_)
            p *= mask[:, :, None]
            np.add.at(total, np.array(owners), p.sum(axis=0, dtype=np.float64))
            owners.clear()
            windows.clear()

        for k, text in enumerate(texts):
            for start in range(0, len(text), span):
                owners.append(k)
                windows.append(text[start : start + span])
                if len(windows) == lanes:
                    flush()
        if windows:
            flush()
        return total / np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))[:, None]


def _windows(text: str, key: int) -> list[bytes]:
    """Up to a few training windows of a text, at places that a hash of the row decides."""
    data = (text or "").encode()
    if len(data) <= TRAIN_SPAN:
        return [data] if data else []
    rng = np.random.default_rng(key & 0xFFFFFFFF)
    return [data[a : a + TRAIN_SPAN] for a in rng.integers(0, len(data) - TRAIN_SPAN + 1, WINDOWS_PER_DOC).tolist()]


def train_model(labelled: DataFrame, text: str, lang: str, key: str, per_language: int = PER_LANGUAGE) -> Model:
    """Network from a bounded sample of labelled rows. Windows are cut where the rows are; one task learns from them."""
    scratch = Scratch(labelled.sparkSession)
    usable = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("key"))
    usable = usable.where("lang is not null and text rlike '\\\\p{L}'")

    def cut(batches):
        for batch in batches:
            rows = [(w, lang) for t, lang, k in zip(*[c.to_pylist() for c in batch.columns], strict=True) for w in _windows(t, k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.binary()), pa.array([x for _, x in rows], pa.string())], names=["window", "lang"]
            )

    sample = stratified(usable, "lang", F.col("key"), per_language, scratch).select("text", "lang", "key")
    windows = scratch.write(sample.mapInArrow(cut, "window binary, lang string"), "windows")

    def learn(batches):
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
        if not rows:
            return
        rows.sort(key=lambda row: (row[1], row[0]))
        languages = sorted({x for _, x in rows})
        labels = np.array([languages.index(x) for _, x in rows])
        w = trained([a for a, _ in rows], labels, len(languages)) if len(languages) > 1 else new_weights(1)
        names = sorted(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([languages], pa.list_(pa.string())), pa.array([names], pa.list_(pa.string())),
             pa.array([[w[n].ravel().tolist() for n in names]], pa.list_(pa.list_(pa.float32()))),
             pa.array([[list(w[n].shape) for n in names]], pa.list_(pa.list_(pa.int32())))],
            names=["languages", "names", "numbers", "shapes"],
        )

    made = windows.coalesce(1).mapInArrow(learn, "languages array<string>, names array<string>, numbers array<array<float>>, shapes array<array<int>>")
    row = made.head()
    if row is None:
        return Model([], {})
    shaped = zip(row["names"], row["numbers"], row["shapes"], strict=True)
    return Model(list(row["languages"]), {n: np.array(v, np.float32).reshape(s) for n, v, s in shaped})


def identify(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``."""
    rest = [c for c in docs.columns if c not in (text, "lang_pred", "score")]

    def each(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            known = [k for k, t in enumerate(texts) if has_letter(t)] if model.languages else []
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                p = model.pooled([texts[k].encode() for k in known])
                best = p.argmax(axis=1)
                for k, b in zip(known, best.tolist(), strict=True):
                    names[k] = model.languages[b]
                scores[known] = np.clip(p[np.arange(len(known)), best], 0.0, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(names, pa.string()), pa.array(scores)], names=[*rest, "lang_pred", "score"]
            )

    extra = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.mapInArrow(each, T.StructType([docs.schema[c] for c in rest] + extra))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = train_model(docs.where(~held_out), "text", "lang", "doc_id")
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, "text")
