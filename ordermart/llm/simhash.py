"""Near duplicates by 64-bit SimHash fingerprints, compared bit by bit in vertical layout.

1. A fingerprint per text: XXH64 (seed 42) of its word shingles, a bit is 1 if it is set in over half of them.
2. Distinct fingerprints only: copies never meet each other again.
3. Four bands of 16 bits. Fingerprints within 2 bits agree in at least two whole bands, so the six pairs of bands
   are six keys of 32 bits, and each link shares a key. Keys with one fingerprint are dropped after a count.
4. Bit-sliced comparison inside a key's block: plane b holds bit b of all its fingerprints. XOR with a query's bit
   gives the differing lanes; two carry-save counters and an overflow plane count them for 64 lanes at a time. Queries
   meet lanes in groups of ``GROUP``, planes that divide the block most evenly first, and a group is abandoned as soon as
   all its lanes but the queries' own have overflowed. A block gives at most one link per fingerprint: the spanning
   links of its components, never all pairs.
5. A key with more than ``BLOCK`` fingerprints takes the exact way for crowds: two values within 2 bits have a
   value within 1 bit of both. Each fingerprint goes to its 33 values within 1 bit (among the 32 free bits), and
   those that meet, 33 at most, are linked. The work grows with the crowd, not with its square.
6. Components by star rounds; each fingerprint's documents take the smallest id of their component.

Defined results: null text is empty; a text without words has fingerprint zero, linked like any other; one with fewer
words than a shingle is one shingle. Null ids lose against ids. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.components import components
from ordermart.llm.frames import Scratch, first_row, numbered, unpacked, word_blocks

SEED = 42
RADIUS = 2
BANDS = 4
BLOCK = 2048
# Queries, and lanes, that are compared together: whole words of 64 lanes.
GROUP = 512
# Pairs of bands that form a key, and the bits each key leaves free.
PAIRS = list(combinations(range(BANDS), BANDS - RADIUS))
WIDTH = 64 // BANDS
FREE = [[b for b in range(64) if b // WIDTH not in pair] for pair in PAIRS]


def _votes(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set."""
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one text. Long texts go through in blocks of words."""
    votes, n, tail = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
            for k in range(0, len(starts), 1 << 16):
                spans = zip(starts[k : k + (1 << 16)], ends[shingle - 1 + k : shingle - 1 + k + (1 << 16)].tolist(), strict=True)
                hashes = [digest(line[a:b], SEED) for a, b in spans]
                votes += _votes(hashes)
                n += len(hashes)
            tail = words[len(words) - shingle + 1 :]
        else:
            tail = words
    if not n and tail:
        votes, n = _votes([digest(b" ".join(tail), SEED)]), 1
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str, shingle: int = 3) -> DataFrame:
    """``df`` with a long column ``fingerprint`` in place of its string column ``text``."""
    rest = [c for c in df.columns if c != text]

    def each(batches):
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            prints = [fingerprint(x.as_py() or b"", shingle) for x in texts]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [column], names=[*rest, "fingerprint"])

    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField("fingerprint", T.LongType())])
    return df.mapInArrow(each, schema)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """64 rows of bit lanes, 64 fingerprints to a word; lanes past the end stay 0."""
    lanes = -(-len(prints) // 64) * 64
    bits = np.zeros((64, lanes), np.uint8)
    bits[:, : len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def plane_order(planes: np.ndarray, n: int) -> list[int]:
    """Planes by how evenly they divide the block: those that tell most lanes apart come first, those a key shares last."""
    return np.argsort(np.abs(2 * np.bitwise_count(planes).sum(axis=1, dtype=np.int64) - n), kind="stable").tolist()


def near_lanes(planes: np.ndarray, queries: np.ndarray, skip: np.ndarray, order: list[int]) -> tuple[np.ndarray, int]:
    """A bool row per query: the lanes within two bits of it, by carry-save counting; and the number of planes read.

    skip: bits of the lanes that do not count for a query. The group of lanes is left as soon as no lane is within reach
    of any query any more.
    """
    ones = np.zeros((len(queries), planes.shape[1]), np.uint64)
    twos, over = ones.copy(), skip.copy()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    read = 0
    for read, b in enumerate(order, 1):
        flip = np.where(queries >> np.uint64(b) & np.uint64(1), full, np.uint64(0))
        differs = planes[b] ^ flip[:, None]
        carry = ones & differs
        ones ^= differs
        over |= twos & (carry | ones)  # two and then one more, or two twos
        twos |= carry
        if read % 8 == 0 and (over == full).all():
            break
    return ~np.unpackbits(over.view(np.uint8), axis=1, bitorder="little").astype(bool), read


def compared(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (i, j), j < i, of all pairs within two bits among distinct fingerprints, and the number of planes read.

    Queries and lanes go in groups of ``GROUP``; each pair of groups is compared, and abandoned, by itself.
    """
    planes, n = planes_of(prints), len(prints)
    order = plane_order(planes, n)
    beyond = np.ones(planes.shape[1] * 64, np.uint8)
    beyond[:n] = 0
    left, right, read = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for q in range(0, n, GROUP):
        queries = prints[q : q + GROUP]
        for g in range(0, q + 1, GROUP):
            skip = np.repeat(beyond[None, g : g + GROUP], len(queries), axis=0)
            if g == q:  # a query's own lane and those after it, which compare with it as queries
                skip |= np.triu(np.ones_like(skip))
            bits = np.packbits(skip, axis=1, bitorder="little").view(np.uint64)
            near, planes_read = near_lanes(planes[:, g // 64 : (g + GROUP) // 64], queries, bits, order)
            read += planes_read
            i, j = np.nonzero(near)
            left.append(i + q)
            right.append(j + g)
    return np.concatenate(left), np.concatenate(right), read


def spanning_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (print, smallest print of its component) inside one block of distinct fingerprints."""
    prints = np.unique(prints)
    a, b, _ = compared(prints)
    root = np.arange(len(prints))
    while True:  # the smallest label spreads along links, and labels jump to their own label
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            break
        root = low
    hung = np.nonzero(root != np.arange(len(prints)))[0]
    return prints[hung], prints[root[hung]]


def _blocks(keys: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Cuts of sorted keys into blocks of about ``size`` rows that never part a key."""
    cuts, start = [], 0
    edges = np.append(np.nonzero(np.diff(keys))[0] + 1, len(keys))
    for edge in edges.tolist():
        if edge - start >= size:
            cuts.append((start, edge))
            start = edge
    if start < len(keys):
        cuts.append((start, len(keys)))
    return cuts


def _compared(batches):
    """Sorted (key, fingerprint) rows to links. A key's rows may run over from one batch to the next."""
    def links(keys, prints):
        for a, b in _blocks(keys, 512):
            u, v = spanning_links(prints[a:b].view(np.uint64))
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    held_keys, held = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        prints = np.concatenate([held, batch.column(1).to_numpy()])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        yield from links(keys[:cut], prints[:cut])
        held_keys, held = keys[cut:], prints[cut:]
    yield from links(held_keys, held)


def _keys(prints: DataFrame) -> DataFrame:
    """Six rows (key, fingerprint, pair) for each fingerprint."""
    fp, mask = F.col("fingerprint"), (1 << WIDTH) - 1
    band = [F.shiftrightunsigned(fp, WIDTH * b).bitwiseAND(F.lit(mask)) for b in range(BANDS)]
    keys = []
    for k, (a, b) in enumerate(PAIRS):
        value = F.shiftleft(F.lit(k).cast("long"), 2 * WIDTH) + F.shiftleft(band[a], WIDTH) + band[b]
        keys.append(F.struct(value.alias("key"), F.lit(k).alias("pair")))
    return prints.select(fp, F.explode(F.array(*keys)).alias("k")).select("k.key", "fingerprint", "k.pair")


def links_of(prints: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints within two bits of each other, directly or by a chain."""
    keyed = _keys(prints)
    crowds = scratch.write(keyed.groupBy("key").count().where("count > 1"), "keys")
    shared = keyed.join(crowds, "key")
    small = (
        shared.where(F.col("count") <= block)
        .select("key", "fingerprint")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_compared, "u long, v long")
    )
    masks = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in free]) for free in FREE])
    flips = F.explode(F.element_at(masks, F.col("pair") + 1)).alias("flip")
    crowd = (
        shared.where(F.col("count") > block)
        .select("key", "fingerprint", flips)
        .select("key", "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("near"))
        .groupBy("key", "near")
        .agg(F.collect_set("fingerprint").alias("met"), F.min("fingerprint").alias("v"))
        .where(F.size("met") > 1)
        .select(F.explode("met").alias("u"), "v")
    )
    return small.union(crowd)


def near_groups(prints: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (column ``fingerprint``) to (fingerprint, root); those without a link are not in it."""
    found = components(links_of(prints, scratch, block), scratch)
    return scratch.write(found.select(F.col("node").alias("fingerprint"), "root"), "roots")


def simhash_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, scratch: Scratch | None = None
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates (smallest id), all columns as they were."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = numbered(docs, scratch)
    texts = rows.select("rid", F.col("doc")[id_col].alias("id"), F.col("doc")[text].alias("text"))
    marked = scratch.write(with_fingerprint(texts, "text", shingle), "prints")
    classes = marked.groupBy("fingerprint").agg(F.min(first_row(F.col("id"), F.col("rid"))).alias("first"))
    roots = near_groups(marked.select("fingerprint").distinct(), scratch)
    stays = (
        classes.join(roots, "fingerprint", "left")
        .groupBy(F.coalesce("root", "fingerprint").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.rid").alias("rid"))
    )
    # Always by sort and merge: as large a share of the rows may go as may stay.
    return rows.join(stays.hint("merge"), "rid", "left_semi").select(*unpacked(rows))


def op9_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    marked = scratch.write(with_fingerprint(docs.select("doc_id", "text"), "text"), "prints")
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = near_groups(marked.select("fingerprint").distinct(), scratch)
    classes = scratch.write(classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "classes")
    lowest = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = classes.join(lowest, "root").select("fingerprint", "component_id")
    return marked.join(found, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
