"""Packing of tokenised documents into fixed windows by non-negative least squares over length combinations.

A document's ids are cut into whole windows and one rest. The rests of a block (about ``BLOCK_TOKENS`` ids) are packed
together:

1. the histogram of rest lengths is taken, and shallow combinations (two or three lengths) that fill a window exactly
   are enumerated;
2. repeat counts for the combinations that come closest to the histogram are solved, with no count below zero;
3. the counts are rounded down to what the block still has, and the documents are dealt to them;
4. what is left is packed greedily, longest first: each window takes rests until it is full, and the last one is cut
   there. Only the last window of a task has padding.

Each task packs the documents it reads: no shuffle, nothing global but the combinations' arithmetic, memory for one
block. A sequence id holds the partition's number and a counter, so a task that runs again gives the same result. One
source or one length may hold any share of the rows.

Defined results: null and empty texts are the end id alone. Repeated rows are packed one by one. An empty table gives
no pieces. Of the caller's columns only id and text are read.
"""

from __future__ import annotations

import base64
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 24
# Partners tried per length for combinations of three.
THIRDS = 12
STEPS = 60
# A text over this many bytes goes through the slower library, which has no limit on runs.
LONG_TEXT = 1 << 22


class Encoder:
    """Text to ids. Latin texts take the faster library with the same vocabulary, all others the reference one."""

    def __init__(self, path: str | None = None, ranks: str | None = None) -> None:
        import public_tokenizers

        self.path = path or public_tokenizers.path("byte_bpe_50k.json")
        if path is None:
            ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
        self._slow = self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def slow(self, text: str) -> np.ndarray:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def __call__(self, text: bytes) -> np.ndarray:
        # No byte from 0xCA on: no character from U+0280 on, where the libraries' character classes could differ.
        plain = len(text) <= LONG_TEXT and not (np.frombuffer(text, np.uint8) >= 0xCA).any()
        if self._fast is None or not plain:
            return self.slow(text.decode("utf-8", "replace"))
        return np.asarray(self._fast.encode_to_numpy(text.decode()), dtype=np.uint32)


def encoder(path: str | None, ranks: str | None) -> Encoder:
    """One per worker process: these functions are sent with each task, so the process keeps it, not the module."""
    kept = sys.__dict__.setdefault("_packing_encoders", {})
    if (path, ranks) not in kept:
        kept[path, ranks] = Encoder(path, ranks)
    return kept[path, ranks]


def combinations_of(counts: np.ndarray, window: int = WINDOW, thirds: int = THIRDS) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window, of lengths that occur. counts: by length, 0 to window - 1."""
    there = np.nonzero(counts)[0]
    there = there[there > 0]
    a = there[2 * there >= window]
    pairs = np.stack([a, window - a, np.zeros_like(a)], axis=1)
    pairs = pairs[(counts[window - a] > 0) & (a < window)]
    found = [pairs]
    # For three: a length and, per step, another one that is spread over those that occur.
    for k in range(thirds if len(there) else 0):
        b = there[(np.arange(len(there)) * 7 + k * len(there) // thirds + k) % len(there)]
        c = window - there - b
        good = (c > 0) & (c < window)
        good[good] = counts[c[good]] > 0
        found.append(np.stack([there[good], b[good], c[good]], axis=1))
    return np.unique(np.sort(np.concatenate(found), axis=1)[:, ::-1], axis=0)


def repeat_counts(combos: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: how often each combination comes so that their lengths meet the histogram.

    Projected gradient with momentum; the step is bounded by the largest number of combinations of one length.
    """
    target = counts.astype(np.float64)
    target[0] = 0.0
    uses = np.bincount(combos.ravel(), minlength=len(counts)).astype(np.float64)
    uses[0] = 0.0
    rate = 1.0 / max(1.0, 9.0 * uses.max())
    x = np.zeros(len(combos))
    ahead, momentum = x, 1.0
    scale = 1.0 / np.maximum(uses, 1.0)  # lengths that occur in many combinations move each one less
    for _ in range(steps):
        made = np.zeros(len(counts))
        for k in range(3):
            made += np.bincount(combos[:, k], weights=ahead, minlength=len(counts))
        gap = target - made
        gap[0] = 0.0
        step = (gap * scale)[combos].sum(axis=1) / 3.0
        after = np.maximum(0.0, ahead + max(rate, 0.5) * step)
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = np.maximum(0.0, after + (momentum - 1) / grown * (after - x))
        x, momentum = after, grown
    return x


@dataclass
class Block:
    """Rests that wait to be packed: positions by length, and their ids."""

    window: int
    next_sequence: int
    rows: list = field(default_factory=list)  # (doc_id, start, doc_tokens, ids)
    tokens: int = 0
    open_fill: int = 0  # ids in the sequence that is not full yet
    open_sequence: int = -1

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        self.rows.append((doc_id, start, doc_tokens, ids))
        self.tokens += len(ids)

    def new_sequence(self) -> int:
        self.next_sequence += 1
        return self.next_sequence - 1

    def packed(self) -> Iterator[tuple]:
        """(doc_id, start, ids, doc_tokens, sequence, offset) of all rests; the open sequence waits for the next block."""
        by_length: dict[int, list[int]] = {}
        for k, row in enumerate(self.rows):
            by_length.setdefault(len(row[3]), []).append(k)
        counts = np.zeros(self.window, np.int64)
        for length, rows in by_length.items():
            counts[length] = len(rows)
        combos = combinations_of(counts, self.window)
        if len(combos):
            repeats = np.floor(repeat_counts(combos, counts) + 1e-9).astype(np.int64)
            for k in np.argsort(-repeats, kind="stable").tolist():
                if repeats[k] <= 0:
                    break
                yield from self._dealt([n for n in combos[k].tolist() if n], int(repeats[k]), by_length)
            # Rounding leaves whole combinations behind; they are taken as long as their lengths last.
            for combo in combos.tolist():
                yield from self._dealt([n for n in combo if n], len(self.rows), by_length)
        for length in sorted(by_length, reverse=True):
            for k in by_length[length]:
                yield from self._cut(*self.rows[k])
        self.rows, self.tokens = [], 0

    def _dealt(self, lengths: list[int], times: int, by_length: dict[int, list[int]]) -> Iterator[tuple]:
        for n in set(lengths):
            times = min(times, len(by_length.get(n, ())) // lengths.count(n))
        for _ in range(times):
            sequence, offset = self.new_sequence(), 0
            for n in lengths:
                doc_id, start, doc_tokens, ids = self.rows[by_length[n].pop()]
                yield doc_id, start, ids, doc_tokens, sequence, offset
                offset += n

    def _cut(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> Iterator[tuple]:
        while len(ids):
            if not self.open_fill:
                self.open_sequence = self.new_sequence()
            part = ids[: self.window - self.open_fill]
            yield doc_id, start, part, doc_tokens, self.open_sequence, self.open_fill
            self.open_fill = (self.open_fill + len(part)) % self.window
            start, ids = start + len(part), ids[len(part) :]


def pack(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    window: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
    path: str | None = None,
    ranks: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for.

    ``path`` and ``ranks`` name the tokenizer's file and, optionally, the same vocabulary as ranks.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )

    def each(batches):
        encode = encoder(path, ranks)
        block = Block(window, TaskContext.get().partitionId() << 33)
        pieces: list[tuple] = []
        id_type = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [
                pa.array([r[0] for r in rows], id_type),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(r[2]) for r in rows], pa.int64()),
                pa.array([zlib.crc32(r[2].astype("<u4").tobytes()) for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows], pa.int64()),
                pa.array([r[5] for r in rows], pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1).cast(pa.binary())
            for doc_id, data in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = np.append(encode(data.as_py() or b""), np.uint32(END_ID))
                n = len(ids)
                cut = n - n % window
                for start in range(0, cut, window):
                    pieces.append((doc_id, start, ids[start : start + window], n, block.new_sequence(), 0))
                if cut < n:
                    block.add(doc_id, cut, n, ids[cut:].astype(np.uint32))
                if len(pieces) >= 4096:
                    yield batch_of(pieces)
                    pieces = []
                if block.tokens >= block_tokens:
                    yield batch_of(list(block.packed()))
        pieces += block.packed()
        if pieces:
            yield batch_of(pieces)

    return docs.select(id_col, text).mapInArrow(each, schema)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
