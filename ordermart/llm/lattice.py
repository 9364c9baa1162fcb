"""Near duplicates among vectors: lattice hashing with the eight-dimensional lattice E8, confirmed by cosine.

1. Equal vectors are one class, told apart by SHA-256 of their components; the rest works on classes with their sizes.
2. A hash table projects the unit vector to ``BLOCKS`` random subspaces of eight dimensions, shifts and scales each, and
   decodes it to the nearest point of E8. The points together are a cell. Besides its own cell a vector probes the
   neighbours closest to it: the own cell with some of its points moved by a shortest lattice vector. ``TABLES`` tables
   with ``PROBES`` neighbours find a pair at cosine 0.9 with a chance of about 0.94, closer pairs with more.
3. Keys that one class has alone are dropped after a count. The classes of a key are compared by exact cosine, in double
   precision, and a key gives at most one link per class: a spanning forest, never all pairs.
4. Star rounds join the links to components. Inside a component every pair is then compared, so that ``n_links`` counts
   pairs that no table has found, too; it cannot miss a pair for having met it in no table or twice for two tables.
5. A key or component of more than ``BLOCK`` classes is a crowd. Its classes within half of the threshold's angle from
   the crowd's mean direction are its core: by the triangle inequality these are all linked with each other, so they are
   counted and not compared. The others, the rim, are compared with all, in a grid of cells of about ``BLOCK`` classes
   a side that are spread over tasks. Work is rim times crowd; where a crowd has no core it is the square, but spread.

No task holds more than some blocks of vectors, and the driver holds none.

Defined results: a vector that is null, zero, empty or has a null or non-finite component has no links and is its own
component. Vectors of different lengths do not link. Rows that repeat an id are vectors of their own. A null id loses
against ids; ``kept`` says that a row has its component's id. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.components import components
from ordermart.llm.frames import Scratch, first_row, whole_row
from ordermart.llm.vectors import finite_vectors, matrix_of

THRESHOLD = 0.9
TABLES = 4
BLOCKS = 3
PROBES = 7
# Lattice units to the length of a unit vector, for vectors of eight dimensions; grows with the root of the dimension.
SCALE = 1.15
# Neighbours of one block's point that take part in probes.
NEAR = 3
BLOCK = 2048
# Slack of angles, in radians, over what rounding can do.
SLACK = 1e-6


@functools.cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two ones of any signs, or halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for signs in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    out += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of an even sum: where the sum is odd, the worst rounding goes the other way."""
    near = np.rint(y)
    off = y - near
    odd = np.nonzero(near.sum(axis=1) % 2)[0]
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decoded(y: np.ndarray) -> np.ndarray:
    """Nearest points of E8: whole coordinates of an even sum, or these moved by one half."""
    whole, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


@functools.cache
def _table(dim: int, table: int) -> list[tuple]:
    """By block: projection, shift, multipliers of the hash."""
    out = []
    for block in range(BLOCKS):
        rng = np.random.default_rng([dim, table, block])
        projection = rng.normal(size=(dim, 8))
        projection = np.linalg.qr(projection)[0] if dim >= 8 else projection / np.linalg.norm(projection, axis=0)
        out.append((projection * SCALE * (dim / 8) ** 0.5, rng.uniform(0, 2, 8), rng.integers(0, 1 << 62, 8, dtype=np.int64) * 2 + 1))
    return out


def cell_keys(units: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
    """A row of keys per unit vector: its own cell's and those of the ``probes`` closest neighbours, in no order."""
    n, dim = units.shape
    keys = np.full(n, dim * 1_000_003 + table, np.int64) * np.int64(0x9E3779B97F4A7C1)
    distance, moves = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
    for projection, shift, multipliers in _table(dim, table):
        y = units @ projection + shift
        point = decoded(y)
        keys += (2 * point).astype(np.int64) @ multipliers
        further = 2 - 2 * ((y - point) @ shortest().T)
        near = np.argpartition(further, NEAR, axis=1)[:, :NEAR]
        further = np.concatenate([np.zeros((n, 1)), np.take_along_axis(further, near, 1)], axis=1)
        move = np.concatenate([np.zeros((n, 1), np.int64), ((2 * shortest()).astype(np.int64) @ multipliers)[near]], axis=1)
        distance = (distance[:, :, None] + further[:, None, :]).reshape(n, -1)
        moves = (moves[:, :, None] + move[:, None, :]).reshape(n, -1)
    # The own cell is among the first only if no move is closer; it always belongs to them, whatever the others are.
    distance[:, 0] = -1.0
    first = np.argpartition(distance, probes, axis=1)[:, : probes + 1]
    return keys[:, None] + np.take_along_axis(moves, first, 1)


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Vectors, none of them zero, at length one. Scaled by the largest component first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1)[:, None]
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _prepared(df: DataFrame) -> DataFrame:
    """(doc, id, vector) to (doc, id, vec): the components as bytes of doubles, null where a vector cannot link."""

    def each(batches):
        for batch in batches:
            column = np.full(batch.num_rows, None, object)
            for rows, matrix in finite_vectors(batch.column("vector")).values():
                matrix = matrix + 0.0  # one zero only
                for row, v in zip(rows.tolist(), matrix, strict=True):
                    column[row] = v.tobytes() if v.any() else None
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("id"), pa.array(column, pa.binary())], names=["doc", "id", "vec"])

    return df.mapInArrow(each, T.StructType([df.schema["doc"], df.schema["id"], T.StructField("vec", T.BinaryType())]))


def _by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of components: rows, and their vectors at length one."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    lengths = np.diff(ends) // 8
    out = {}
    for dim in np.unique(lengths).tolist():
        rows = np.nonzero(lengths == dim)[0]
        out[dim] = rows, units_of(matrix_of(column.take(pa.array(rows)), "<f8", dim))
    return out


def _keyed(tables: int, probes: int):
    def each(batches):
        for batch in batches:
            ids = batch.column("cid").to_numpy()
            for rows, units in _by_length(batch.column("vec")).values():
                for table in range(tables):
                    keys = cell_keys(units, table, probes)
                    made = [pa.array(keys.ravel()), pa.array(np.repeat(ids[rows], keys.shape[1]))]
                    yield pa.RecordBatch.from_arrays(made, names=["key", "cid"])

    return each


def _spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component, by number."""
    root = np.arange(n)
    while True:  # the smallest label spreads along links, and labels jump to their own label
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


class Block:
    """Classes compared together: a row may come once for each of several keys."""

    def __init__(self, table: pa.Table) -> None:
        column = table.column("vec").combine_chunks()
        self.parts = _by_length(column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks))
        self.number = {c: table.column(c).to_numpy() for c in table.column_names if c != "vec"}

    def pairs(self, threshold: float, left: np.ndarray, right: np.ndarray):
        """Linked pairs (rows i of left, rows j of right) but those of one class."""
        for rows, units in self.parts.values():
            a, b = np.nonzero(left[rows])[0], np.nonzero(right[rows])[0]
            for at in range(0, len(a), 512):
                i, j = np.nonzero(units[a[at : at + 512]] @ units[b].T >= threshold)
                i, j = rows[a[at + i]], rows[b[j]]
                other = self.number["cid"][i] != self.number["cid"][j]
                yield i[other], j[other]


def _runs(batches, key: tuple[str, ...], at_least: int):
    """Sorted batches as tables of whole runs of equal keys, several short runs in one table of about ``at_least`` rows."""
    held = []

    def split(table: pa.Table):
        values = [table.column(c).to_numpy() for c in key]
        edge = np.zeros(len(table), bool)
        for v in values:
            edge[1:] |= v[1:] != v[:-1]
        return np.nonzero(edge)[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < at_least:
            continue
        table = pa.Table.from_batches(held)
        edges, start = split(table), 0
        for edge in edges.tolist():
            if edge - start >= at_least:
                yield table.slice(start, edge - start)
                start = edge
        if start < len(table):
            last = edges[-1] if len(edges) else 0
            if last > start:
                yield table.slice(start, last - start)
                start = last
        held = table.slice(start).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _links(threshold: float, key: tuple[str, ...]):
    """Sorted rows of keys to spanning links (u, v). Pairs that share no key but meet in a table here are links as well."""

    def each(batches):
        for table in _runs(batches, key, 512):
            block = Block(table)
            ids = block.number["cid"]
            every = np.ones(len(ids), bool)
            side = block.number.get("rim")
            found = list(block.pairs(threshold, every if side is None else side == 1, every))
            if not found:
                continue
            known, place = np.unique(ids, return_inverse=True)
            root = _spanning(len(known), place[np.concatenate([i for i, _ in found])], place[np.concatenate([j for _, j in found])])
            hung = np.nonzero(root != np.arange(len(known)))[0]
            if len(hung):
                yield pa.RecordBatch.from_arrays([pa.array(known[hung]), pa.array(known[root[hung]])], names=["u", "v"])

    return each


def _counts(threshold: float, key: tuple[str, ...]):
    """Sorted rows of groups to (cid, links): how many vectors each class is linked with inside its group or cell."""

    def each(batches):
        for table in _runs(batches, key, 512):
            block = Block(table)
            ids, size, rim = block.number["cid"], block.number["n"], block.number["rim"]
            groups = [block.number[c] for c in key]
            links = np.zeros(len(ids), np.int64)
            # rim 2: compared with all of its group. rim 1 and 0: one side of a cell, with rim rows on the side 1.
            for i, j in block.pairs(threshold, rim >= 1, rim != 1):
                same = np.logical_and.reduce([g[i] == g[j] for g in groups])
                i, j = i[same], j[same]
                np.add.at(links, i, size[j])
                core = (rim[j] == 0) & (block.number["core"][j] == 1)
                np.add.at(links, j[core], size[i[core]])
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some])], names=["cid", "links"])

    return each


def _sorted(df: DataFrame, *key: str) -> DataFrame:
    return df.repartition(*key).sortWithinPartitions(*key)


def _crowd(rows: DataFrame, key: str, threshold: float, block: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows with core, cells): which classes of a crowd are in its core, and the grid that compares its rim with all.

    rows: key, cid, vec and what else is to come along.
    """
    doubles = F.col("vec")
    names = [c for c in rows.columns if c != "vec"]

    def opened(batches):  # components of unit vectors, for the mean direction
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for at, units in _by_length(batch.column(1)).values():
                order = np.argsort(keys[at], kind="stable")
                k, units = keys[at][order], units[order]
                new = np.concatenate(([0], np.nonzero(np.diff(k))[0] + 1))
                sums = np.add.reduceat(units, new, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(k[new]), pa.array(list(sums))], names=[key, "total"])

    parts = rows.select(key, doubles).mapInArrow(opened, f"{key} long, total array<double>")
    each = parts.select(key, F.posexplode("total").alias("d", "x")).groupBy(key, "d").agg(F.sum("x").alias("x"))
    mean = each.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("d", "x")))["x"].alias("mean"))
    limit = np.arccos(threshold) / 2 - SLACK

    def placed(batches):
        for batch in batches:
            core = np.zeros(batch.num_rows, np.int32)
            means = batch.column("mean").to_pylist()
            for at, units in _by_length(batch.column("vec")).values():
                pivot = np.array([(means[i] + [0.0] * units.shape[1])[: units.shape[1]] for i in at])
                fine = np.abs(pivot).max(axis=1) > 0
                cosine = np.zeros(len(at))
                cosine[fine] = (units[fine] * units_of(pivot[fine])).sum(axis=1)
                core[at] = np.arccos(np.clip(cosine, -1, 1)) <= limit
            columns = [batch.column(c) for c in names] + [batch.column("vec"), pa.array(core)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "vec", "core"])

    schema = T.StructType([*[rows.schema[c] for c in [*names, "vec"]], T.StructField("core", T.IntegerType())])
    marked = scratch.write(rows.join(mean, key).mapInArrow(placed, schema), "crowd")
    sizes = marked.groupBy(key).agg(F.count("*").alias("all_rows"), F.sum(1 - F.col("core")).alias("rim_rows")).where("rim_rows > 0")
    grid = marked.join(sizes, key).withColumns({
        "rims": F.ceil(F.col("rim_rows") / block).cast("int"), "alls": F.ceil(F.col("all_rows") / block).cast("int"),
    })
    salt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "cid"), F.col(n)).cast("int")
    rim = grid.where("core = 0").select(
        *names, "vec", "core", F.lit(1).alias("rim"), salt("rim", "rims").alias("i"), F.explode(F.sequence(F.lit(0), F.col("alls") - 1)).alias("j")
    )
    every = grid.select(
        *names, "vec", "core", F.lit(0).alias("rim"), F.explode(F.sequence(F.lit(0), F.col("rims") - 1)).alias("i"), salt("all", "alls").alias("j")
    )
    return marked, rim.unionByName(every)


def _all_links(classes: DataFrame, threshold: float, block: int, scratch: Scratch, tables: int, probes: int) -> DataFrame:
    """Links (u, v) between classes that share a cell and are at least ``threshold`` alike: a spanning forest of each key."""
    keyed = scratch.write(classes.select("cid", "vec").mapInArrow(_keyed(tables, probes), "key long, cid long"), "keyed")
    counts = scratch.write(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "keys")
    shared = scratch.write(keyed.join(counts, "key").join(classes.select("cid", "vec"), "cid"), "shared")
    scratch.drop(keyed)
    few = _sorted(shared.where(F.col("size") <= block).select("key", "cid", "vec"), "key").mapInArrow(_links(threshold, ("key",)), "u long, v long")
    many = shared.where(F.col("size") > block).select("key", "cid", "vec")
    if not counts.where(F.col("size") > block).head(1):
        return few
    marked, cells = _crowd(many, "key", threshold, block, scratch)
    core = marked.where("core = 1").select("key", "cid")
    stars = core.join(core.groupBy("key").agg(F.min("cid").alias("v")), "key").select(F.col("cid").alias("u"), "v")
    grid = _sorted(cells.select("key", "i", "j", "cid", "vec", "rim"), "key", "i", "j").mapInArrow(_links(threshold, ("key", "i", "j")), "u long, v long")
    return few.union(stars).union(grid)


def _link_counts(members: DataFrame, threshold: float, block: int, scratch: Scratch) -> DataFrame:
    """(cid, links): with how many vectors of other classes each class is linked. members: root, cid, vec, n, size."""
    made = "cid long, links long"
    columns = ["root", "cid", "n", "vec"]
    few = members.where(F.col("size") <= block).select(*columns, F.lit(2).alias("rim"), F.lit(0).alias("core"))
    found = _sorted(few, "root").mapInArrow(_counts(threshold, ("root",)), made)
    many = members.where(F.col("size") > block)
    if many.head(1):
        marked, cells = _crowd(many.select(*columns), "root", threshold, block, scratch)
        core = marked.where("core = 1").select("root", "cid", "n")
        inside = core.join(core.groupBy("root").agg(F.sum("n").alias("total")), "root").select("cid", (F.col("total") - F.col("n")).alias("links"))
        grid = _sorted(cells, "root", "i", "j").mapInArrow(_counts(threshold, ("root", "i", "j")), made)
        found = found.union(inside).union(grid)
    return found.groupBy("cid").agg(F.sum("links").alias("links"))


def near_vectors(
    df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", threshold: float = THRESHOLD,
    tables: int = TABLES, probes: int = PROBES, block: int = BLOCK, scratch: Scratch | None = None,
) -> DataFrame:
    """All rows of ``df`` as struct ``doc`` with n_links, component_id and kept."""
    scratch = scratch or Scratch(df.sparkSession)
    source = df.select(whole_row(df).alias("doc"), df[f"`{id_col}`"].alias("id"), df[f"`{vector}`"].alias("vector"))
    # Vectors that cannot link have a digest of their own, so that they do not meet in one task.
    rows = _prepared(source).withColumn("rid", F.monotonically_increasing_id())
    rows = scratch.write(rows.withColumn("digest", F.coalesce(F.sha2("vec", 256), F.concat(F.lit("row "), F.col("rid").cast("string")))), "rows")
    classes = (
        rows.where("vec IS NOT NULL").groupBy("digest")
        .agg(F.first("vec").alias("vec"), F.count("*").alias("n"), F.min(first_row(F.col("id"), F.col("rid"))).alias("first"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = scratch.write(classes, "classes")
    roots = scratch.write(components(_all_links(classes, threshold, block, scratch, tables, probes), scratch), "roots")
    about = roots.join(classes.select(F.col("cid").alias("node"), "n", "first"), "node")
    groups = scratch.write(about.groupBy("root").agg(F.count("*").alias("size"), F.min("first").alias("lowest")), "groups")
    members = roots.join(groups, "root").join(classes.withColumnRenamed("cid", "node"), "node").withColumnRenamed("node", "cid")
    members = scratch.write(members.select("root", "cid", "n", "vec", "size", F.col("lowest.id").alias("component_id")), "members")
    links = _link_counts(members, threshold, block, scratch)
    linked = members.select("cid", "component_id", F.lit(True).alias("grouped")).join(links, "cid", "left")
    of_class = classes.join(linked, "cid", "left").select(
        "digest",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("first.id")).alias("component_id"),
    )
    known = F.col("n_links").isNotNull()
    found = rows.join(of_class, "digest", "left").select(
        "doc", "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(known, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )
    return found.select("doc", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return near_vectors(vectors).select(F.col("doc.vec_id").alias("vec_id"), "n_links", "component_id", "kept")
