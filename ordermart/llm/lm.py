"""Language-model scores from an n-gram trie in Elias-Fano form, mapped into memory.

The model counts words, pairs and triples over all training texts and interpolates three orders by absolute discounting:
a pair or triple seen ``LEAST`` times or more keeps its count less ``DISCOUNT``, and what a context has not handed out
goes to the next shorter order, down to the smoothed word counts of the contract.

Trie, in shards of about ``SHARD_TOKENS`` training tokens, split by a hash range of the first word:

* words: 64-bit hashes in order, and exact counts. A word's id is its place.
* pairs: for each word a monotone pointer to its successors, their ids, quantised probability and back-off weight.
* triples: for each pair a pointer to its successors, given by their place among the successors of the pair's second
  word, which is a smaller number than an id. A triple frequent enough has frequent pairs, so both are there.

Pointers and ids are Elias-Fano sequences; a successor is found inside its context's range by the high bits and a short
search. Every shard is one file per level in the shared folder (``spark.checkpoint.dir``, which must be mounted on the
executors); tasks map the files and read the pages they touch. Nothing is broadcast, and no task holds more than one
block of text (``BLOCK`` tokens) or, while building, the counts of one shard.

Counting: each task counts its own blocks with numpy and sends sorted, distinct n-grams per shard as compressed blobs. A
shard with more than ``SHARD_BYTES`` of them is merged in groups before it comes together, so a shard's task gets
distinct n-grams however often they occur.

Defined results: null text is empty: one token, the end. Words are told apart by XXH64. With no training text all counts
are 0. A null id is in the fold of the empty text. Repeated rows are counted and scored one by one; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.eliasfano import Successors, map_arrays, save_arrays
from ordermart.llm.frames import Scratch, word_blocks
from ordermart.llm.samples import fold

DISCOUNT = 0.75
LEAST = 1
SHARD_TOKENS = 4_000_000
BLOCK = 750_000
# Bytes of counts that one task takes for a shard; a shard has about 80 MB unless one word is a large part of all.
SHARD_BYTES = 256 << 20
# The end of a text, as a word that no text can have.
END = b""
# Quantised: steps per factor of ten.
STEPS = 2048


def _quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.rint(-np.log10(p) * STEPS), 65535).astype(np.uint16)


def _restored(codes: np.ndarray) -> np.ndarray:
    return 10.0 ** (-codes.astype(np.float64) / STEPS)


class _Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


@dataclass
class Tokens:
    """One block of texts: local word numbers of all tokens, and where each text begins."""

    hashes: np.ndarray  # of the local words
    local: np.ndarray
    starts: np.ndarray  # one per text
    rows: list  # what came with each text

    def follows(self, distance: int) -> np.ndarray:
        """Whether a token has ``distance`` tokens before it in its text."""
        age = np.arange(len(self.local)) - np.repeat(self.starts, np.diff(np.append(self.starts, len(self.local))))
        return age >= distance


def blocks_of(texts: Iterator[tuple[bytes, object]], size: int = BLOCK) -> Iterator[Tokens]:
    """Texts as token blocks of about ``size`` tokens; a long text is a block of its own."""
    ids, parts, starts, rows, n = _Ids(), [], [], [], 0

    def block() -> Tokens:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
        return Tokens(hashes, np.concatenate(parts), np.array(starts, np.int64), list(rows))

    for text, row in texts:
        starts.append(n)
        rows.append(row)
        for words in word_blocks(text.lower()):
            parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
            n += len(words)
        parts.append(np.array([ids[END]]))
        n += 1
        if n >= size:
            yield block()
            ids, parts, starts, rows, n = _Ids(), [], [], [], 0
    if rows:
        yield block()


def _texts(batches, with_row: bool = False) -> Iterator[tuple[bytes, object]]:
    """(text, row): the last column is the text; the row is what stands before it, as Python values."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        rest = zip(*[c.to_pylist() for c in batch.columns[:-1]], strict=True) if with_row else [None] * len(texts)
        for t, row in zip(texts, rest, strict=True):
            yield t.as_py() or b"", row


def _order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order by a, then b: of one combined number where that fits."""
    if not len(a):
        return np.empty(0, np.int64)
    width = int(b.max()) + 1
    if int(a.max()) < (1 << 63) // width - 1:
        return np.argsort(a.astype(np.int64) * width + b.astype(np.int64))
    return np.lexsort((b, a))


def _new(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a pair differs from the one before it."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct pairs of keys in order (the first leads) and their summed counts."""
    if not len(counts):
        return keys, counts
    order = _order(*keys)
    a, b = (k[order] for k in keys)
    at = np.nonzero(_new(a, b))[0]
    return [a[at], b[at]], np.add.reduceat(counts[order], at)


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct pairs of non-negative keys in order and how often each comes."""
    if not len(a):
        return [a, b], np.empty(0, np.int64)
    width = int(b.max()) + 1
    if int(a.max()) >= (1 << 63) // width - 1:
        return _summed([a, b], np.ones(len(a), np.int64))
    keys, n = np.unique(a * width + b, return_counts=True)
    return [keys // width, keys % width], n.astype(np.int64)


BLOB = "shard int, salt int, size long, a binary, b binary, n binary"


def _packed(x: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers, or the steps between ascending ones, byte plane by byte plane: the high planes, nearly all zero, compress away."""
    if ascending and len(x):
        x = np.concatenate((x[:1], np.diff(x)))
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: type, count: int, ascending: bool = False) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, count * width, codec="zstd", asbytes=True), np.uint8).reshape(width, count)
    x = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ascending else x


def _blob(shard: int, salt: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple:
    """One row of entries in the order of a; ``size`` is their number."""
    return shard, salt, len(n), _packed(a, True), _packed(b), _packed(n)


def _blob_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "salt", "size", "a", "b", "n"])


def _blobs(shard: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray, salt: int) -> pa.RecordBatch | None:
    """A row per shard. shard: non-decreasing, per entry."""
    if not len(shard):
        return None
    at = np.concatenate(([0], np.nonzero(np.diff(shard))[0] + 1, [len(shard)])).tolist()
    return _blob_rows([_blob(int(shard[i]), salt, a[i:j], b[i:j], n[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)])


def _entries(table: pa.Table, kinds: tuple) -> tuple[list[np.ndarray], np.ndarray]:
    """Summed entries of all blobs of a table."""
    sizes = table["size"].to_pylist()
    read = lambda c, kind, up=False: np.concatenate([_unpacked(x.as_py(), kind, k, up) for x, k in zip(table[c], sizes, strict=True)])
    return _summed([read("a", kinds[0], True), read("b", kinds[1])], read("n", np.int64))


def _merged(blobs: DataFrame, scratch: Scratch, kinds: tuple, name: str) -> DataFrame:
    """The blobs, written once. A shard that is too much for one task is merged in groups first, as long as that helps.

    Shards follow the tokens, so this is only for words that are a large part of all: their n-grams come once per
    block and task, and shrink to the distinct ones.
    """
    blobs = scratch.write(blobs, name)
    width = sum(np.dtype(k).itemsize for k in (*kinds, np.int64))
    size = lambda df: width * (df.groupBy("shard").agg(F.sum("size").alias("size")).agg(F.max("size")).head()[0] or 0)
    most = size(blobs)
    while most > SHARD_BYTES:

        def merge(key, table):
            (a, b), n = _entries(table, kinds)
            return pa.Table.from_batches([_blob_rows([_blob(key[0].as_py(), key[1].as_py(), a, b, n)])])

        numbered = blobs.withColumn("salt", F.pmod("salt", F.lit(int(-(-2 * most // SHARD_BYTES)))))
        fewer = scratch.write(numbered.groupBy("shard", "salt").applyInArrow(merge, BLOB), name)
        scratch.drop(blobs)
        blobs, before, most = fewer, most, size(fewer)
        if most > 0.7 * before:
            break
    return blobs


@dataclass
class Trie:
    """Where the levels are, and the figures of the whole: words per shard, pairs per shard, tokens."""

    folder: str
    words: np.ndarray  # words of the shards before, and the total
    pairs: np.ndarray  # pairs of the shards before, and the total
    tokens: int

    @property
    def shards(self) -> int:
        return len(self.words) - 1

    def shard_of_hash(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int64)

    def path(self, level: str, shard: int) -> str:
        return f"{self.folder}/{shard:06d}.{level}"


class Levels:
    """The trie inside a task; a shard's level is mapped when it is first asked."""

    def __init__(self, trie: Trie) -> None:
        self.trie = trie
        self._maps, self._lists = {}, {}

    def _arrays(self, level: str, shard: int) -> dict[str, np.ndarray]:
        if (level, shard) not in self._maps:
            self._maps[level, shard] = map_arrays(self.trie.path(level, shard))
        return self._maps[level, shard]

    def _successors(self, level: str, shard: int) -> Successors:
        if (level, shard) not in self._lists:
            self._lists[level, shard] = Successors(self._arrays(level, shard), level)
        return self._lists[level, shard]

    def _by_shard(self, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(self.trie.shards + 1))
        for k in range(self.trie.shards):
            if cuts[k + 1] > cuts[k] and self.trie.words[k + 1] > self.trie.words[k]:
                yield k, order[cuts[k] : cuts[k + 1]]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of words."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for k, rows in self._by_shard(self.trie.shard_of_hash(hashes)):
            known, h = self._arrays("words", k)["hash"], hashes[rows]
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            ids[rows[hit]] = at[hit] + self.trie.words[k]
            counts[rows[hit]] = self._arrays("words", k)["count"][at[hit]]
        return ids, counts

    def pairs(self, a: np.ndarray, b: np.ndarray, numbers: tuple[str, ...] = ()) -> tuple:
        """Node ids (-1: not kept), places among the first word's successors, and node numbers by name."""
        nodes, places = np.full(len(a), -1, np.int64), np.full(len(a), -1, np.int64)
        out = {c: np.zeros(len(a), np.uint16 if c != "pair_count" else np.int64) for c in numbers}
        for k, rows in self._by_shard(np.searchsorted(self.trie.words, a, side="right") - 1):
            lists, context = self._successors("pairs", k), a[rows] - self.trie.words[k]
            found, start = lists.find(context, b[rows])
            hit = found >= 0
            rows, found = rows[hit], found[hit]
            nodes[rows] = found + self.trie.pairs[k]
            places[rows] = found - start[hit]
            for c in numbers:
                out[c][rows] = self._arrays("pairs", k)[c][found]
        return nodes, places, out

    def backoff(self, a: np.ndarray) -> np.ndarray:
        """Back-off weights of words as contexts."""
        out = np.zeros(len(a), np.uint16)
        for k, rows in self._by_shard(np.searchsorted(self.trie.words, a, side="right") - 1):
            out[rows] = self._arrays("pairs", k)["word_backoff"][a[rows] - self.trie.words[k]]
        return _restored(out)

    def triples(self, node: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability share of triples (0: not kept), and back-off weights of their pairs."""
        share, weight = np.zeros(len(node)), np.ones(len(node))
        for k, rows in self._by_shard(np.searchsorted(self.trie.pairs, node, side="right") - 1):
            arrays, context = self._arrays("triples", k), node[rows] - self.trie.pairs[k]
            weight[rows] = _restored(arrays["pair_backoff"][context])
            found, _ = self._successors("triples", k).find(context, place[rows])
            hit = found >= 0
            share[rows[hit]] = _restored(arrays["share"][found[hit]])
        return share, weight


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of non-negative numbers in order, and where each row's pair is."""
    order = _order(first, second)
    a, b = first[order], second[order]
    new = _new(a, b)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return a[new], b[new], inverse


def _looked_up(levels: Levels, block: Tokens, numbers: tuple[str, ...]) -> tuple:
    """Word ids and counts by token; and for tokens with a known word before: rows, node, place, numbers of the pair."""
    ids, counts = levels.words(block.hashes)
    ids, counts = ids[block.local], counts[block.local]
    with_pair = np.nonzero(block.follows(1))[0]
    with_pair = with_pair[(ids[with_pair] >= 0) & (ids[with_pair - 1] >= 0)]
    a, b, inverse = _distinct(ids[with_pair - 1], ids[with_pair])
    node, place, found = levels.pairs(a, b, numbers)
    return ids, counts, with_pair, node[inverse], place[inverse], {c: v[inverse] for c, v in found.items()}


def _count_words(shards: int):
    def each(batches):
        for k, block in enumerate(blocks_of(_texts(batches))):
            n = np.bincount(block.local, minlength=len(block.hashes))
            order = np.argsort(block.hashes)
            h = block.hashes[order]
            shard = ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            yield _blobs(shard, h, np.zeros(len(h), np.uint8), n[order].astype(np.int64), _salt(k))

    return each


def _salt(k: int) -> int:
    """Number of a blob: spreads the blobs of a shard over groups that are merged together."""
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() * 1009 + k) % (1 << 30)


def _count_pairs(trie: Trie):
    def each(batches):
        levels = None
        for k, block in enumerate(blocks_of(_texts(batches))):
            levels = levels or Levels(trie)
            ids = levels.words(block.hashes)[0][block.local]
            second = np.nonzero(block.follows(1))[0]
            (a, b), n = _counted(ids[second - 1], ids[second])
            shard = np.searchsorted(trie.words, a, side="right") - 1
            made = _blobs(shard, (a - trie.words[shard]).astype(np.uint32), b.astype(np.uint32), n, _salt(k)) if len(a) else None
            if made is not None:
                yield made

    return each


def _count_triples(trie: Trie):
    def each(batches):
        levels = None
        for k, block in enumerate(blocks_of(_texts(batches))):
            levels = levels or Levels(trie)
            _, _, rows, node, place, _ = _looked_up(levels, block, ())
            by_token = np.full(len(block.local), -1, np.int64)
            by_token[rows] = node
            third = np.nonzero(block.follows(2)[rows] & (node >= 0))[0]
            third = third[by_token[rows[third] - 1] >= 0]
            (a, b), n = _counted(by_token[rows[third] - 1], place[third])
            shard = np.searchsorted(trie.pairs, a, side="right") - 1
            made = _blobs(shard, (a - trie.pairs[shard]).astype(np.uint32), b.astype(np.uint32), n, _salt(k)) if len(a) else None
            if made is not None:
                yield made

    return each


def _shared_folder(scratch: Scratch) -> str:
    """The scratch folder as a path of the file system, which the executors map files from."""
    scheme, colon, path = scratch.place("trie").partition(":")
    if not colon:
        return scheme
    if scheme != "file":
        raise ValueError("the trie is mapped into memory: spark.checkpoint.dir must be a folder mounted on all executors")
    return "/" + path.lstrip("/")


def _built(blobs: DataFrame, build) -> dict[int, int]:
    """Run ``build`` (table, shard to a size) once per shard; the sizes."""
    def each(key, table):
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "size": pa.array([build(table, key[0].as_py())], pa.int64())})

    return {r["shard"]: r["size"] for r in blobs.groupBy("shard").applyInArrow(each, "shard int, size long").collect()}


def _kept(entries, total: np.ndarray) -> tuple:
    """Frequent entries of contexts, their probability shares, and what is left for the shorter order."""
    (a, b), n = entries
    keep = n >= LEAST
    a, b, n = a[keep].astype(np.int64), b[keep].astype(np.int64), n[keep]
    share = (n - DISCOUNT) / total[a]
    left = np.maximum(1.0 - np.bincount(a, weights=share, minlength=len(total)), 1e-12)
    pointers = np.concatenate(([0], np.cumsum(np.bincount(a, minlength=len(total)))))
    return pointers, b, n, share, left


def train_trie(texts: DataFrame, shard_tokens: int = SHARD_TOKENS) -> Trie:
    """Count and build all levels. texts: one string column."""
    scratch = Scratch(texts.sparkSession)
    folder = _shared_folder(scratch)
    size = texts.agg(F.sum(F.octet_length(texts.columns[0])), F.count("*")).head()
    # About six bytes to a token; only the number of shards depends on it.
    shards = max(1, -(-((size[0] or 0) // 6 + size[1]) // shard_tokens))
    none = np.zeros(shards + 1, np.int64)

    def offsets(sizes: dict[int, int]) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([sizes.get(k, 0) for k in range(shards)]))).astype(np.int64)

    trie = Trie(folder, none, none, 0)

    def build_words(table: pa.Table, shard: int) -> int:
        (h, _), n = _entries(table, (np.uint64, np.uint8))
        save_arrays(trie.path("words", shard), {"hash": h, "count": n})
        return len(h)

    counted = _merged(texts.mapInArrow(_count_words(shards), BLOB), scratch, (np.uint64, np.uint8), "words")
    sizes = _built(counted, build_words)
    tokens = 0
    if sizes:
        def total(batches):
            for batch in batches:
                sums = [int(_unpacked(x.as_py(), np.int64, k.as_py()).sum()) for x, k in zip(batch.column(0), batch.column(1), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(sums)], names=["n"])

        tokens = counted.select("n", "size").mapInArrow(total, "n long").agg(F.sum("n")).head()[0]
    scratch.drop(counted)
    trie = Trie(folder, offsets(sizes), none, tokens)

    def build_pairs(table: pa.Table | None, shard: int) -> int:
        total = map_arrays(trie.path("words", shard))["count"]
        entries = _entries(table, (np.uint32, np.uint32)) if table is not None else ([np.empty(0, np.uint32)] * 2, np.empty(0, np.int64))
        pointers, b, n, share, left = _kept(entries, total)
        arrays = Successors.encode(pointers, b, "pairs")
        arrays |= {"pair_share": _quantised(share), "pair_count": n, "word_backoff": _quantised(left)}
        save_arrays(trie.path("pairs", shard), arrays)
        return len(b)

    def build_triples(table: pa.Table | None, shard: int) -> int:
        total = map_arrays(trie.path("pairs", shard))["pair_count"]
        entries = _entries(table, (np.uint32, np.uint32)) if table is not None else ([np.empty(0, np.uint32)] * 2, np.empty(0, np.int64))
        pointers, b, _, share, left = _kept(entries, total)
        arrays = Successors.encode(pointers, b, "triples")
        arrays |= {"share": _quantised(share), "pair_backoff": _quantised(left)}
        save_arrays(trie.path("triples", shard), arrays)
        return len(b)

    def level(count, build, name: str) -> dict[int, int]:
        blobs = _merged(texts.mapInArrow(count, BLOB), scratch, (np.uint32, np.uint32), name)
        sizes = _built(blobs, build)
        scratch.drop(blobs)
        # Shards whose words have no successor get an empty level.
        for k in range(shards):
            if k not in sizes and trie.words[k + 1] > trie.words[k]:
                sizes[k] = build(None, k)
        return sizes

    trie = Trie(folder, trie.words, offsets(level(_count_pairs(trie), build_pairs, "pairs")), tokens)
    level(_count_triples(trie), build_triples, "triples")
    return trie


def score_block(levels: Levels, block: Tokens) -> tuple[np.ndarray, ...]:
    """By text: tokens, known tokens, base score, model score."""
    trie = levels.trie
    ids, counts, rows, node, place, found = _looked_up(levels, block, ("pair_share",))
    smoothed = (counts + 0.5) / (trie.tokens + 0.5 * (int(trie.words[-1]) + 1))
    p = smoothed.copy()
    # Pairs: any token whose word before is known, itself known or not.
    after = np.nonzero(block.follows(1))[0]
    after = after[ids[after - 1] >= 0]
    context, inverse = np.unique(ids[after - 1], return_inverse=True)
    p[after] *= levels.backoff(context)[inverse]
    share = np.where(node >= 0, _restored(found["pair_share"]), 0.0)
    p[rows] += share
    # Triples: the pair before must be kept.
    by_token = np.full(len(block.local), -1, np.int64)
    by_token[rows] = node
    third = np.nonzero(block.follows(2))[0]
    third = third[by_token[third - 1] >= 0]
    places = np.full(len(block.local), -1, np.int64)
    places[rows] = place
    # A place no list can have stands for words that never follow.
    a, b, inverse = _distinct(by_token[third - 1], np.where(places[third] >= 0, places[third], (1 << 32) - 2))
    share, weight = levels.triples(a, b)
    p[third] = share[inverse] + weight[inverse] * p[third]
    sums = lambda values: np.add.reduceat(values, block.starts)
    return sums(np.ones(len(ids), np.int64)), sums((counts > 0).astype(np.int64)), sums(np.log10(smoothed)), sums(np.log10(p))


def score_texts(docs: DataFrame, trie: Trie, text: str) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score (in place of columns so named)."""
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    rest = [c for c in docs.columns if c != text and c not in made]
    types = [(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")] + [(c, T.DoubleType()) for c in ("base_score", "score")]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(c, t) for c, t in types])

    def each(batches):
        levels, kinds = None, None

        def seen():
            nonlocal kinds
            for batch in batches:
                kinds = [c.type for c in batch.columns[:-1]]
                yield batch

        for block in blocks_of(_texts(seen(), True)):
            levels = levels or Levels(trie)
            n, known, base, score = score_block(levels, block)
            columns = [pa.array(c, t) for c, t in zip(zip(*block.rows, strict=True), kinds, strict=True)]
            columns += [pa.array(n), pa.array(known), pa.array(np.full(len(n), trie.tokens, np.int64)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.select(*rest, text).mapInArrow(each, schema)


def op8_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 1
    trie = train_trie(docs.where(~held_out).select("text"))
    return score_texts(docs.select("doc_id", held_out.alias("held_out"), "text"), trie, "text")
