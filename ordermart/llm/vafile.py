"""Centroid clustering of vectors by a VA-file: cells first, full vectors only where the cells leave a choice.

1. Components become integers, floor(scale * x). One pass over all vectors gives each dimension's extremes and quantiles.
2. The approximation: each dimension is cut into ``CELLS`` cells at its quantiles, and a vector is written as its cells,
   4 bits to a dimension, beside its full form. The outer cells take the few values to the true extremes, so every bound
   below holds for all vectors; where the borders lie only decides how often it is of use.
3. A pass over the approximations sums, for each centroid, table entries with the least and the greatest squared distance
   that a cell allows, up to a term that all centroids share (one table per pair of dimensions, looked up by the byte). Centroids whose least distance is above
   the smallest greatest one are out. Where one is left, the vector is assigned and its full form is not looked at; where
   intervals overlap, just the overlapping centroids are compared with the full vector, exactly.
4. The update of centroids needs exact sums of the members. Each task adds up its own rows, and a centroid's sums are added
   over tasks: at most k rows a task are shuffled, however hot a cluster is.

All sums are integers, so no result depends on the order of tasks. What reaches the driver is bounded by k and dim: the
first centroids, cell borders by dimension, sums by centroid and dimension. Each pass is one scan without a shuffle of vectors;
cells and vectors are written once to the shared folder.

Defined results: only vectors with exactly ``dim`` components, none null or non-finite, are clustered and returned. With
fewer vectors than k there are as many centroids as vectors. A null id counts as empty text in the hash; equal hashes
(repeated ids) are ordered by the bytes of their components. Repeated rows are clustered one by one. A component beyond 2^27 in scaled units
stops the job with an error, since distances would not fit a long. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.llm.frames import Scratch, whole_row
from ordermart.llm.vectors import binary_column, finite_vectors, matrix_of

CELLS = 16
# Scaled components below this keep squared distances of 64 dimensions within a long.
LARGEST = 1 << 27
# Share of values in each of the two outer cells, which reach to the extremes.
TAIL = 0.0005
# Vectors whose bounds a task holds at a time.
CHUNK = 8192


def _integers(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of usable vectors, and their components as integers."""
    found = finite_vectors(column, dim)
    if not found:
        return np.empty(0, np.int64), np.empty((0, dim), np.int64)
    rows, matrix = found[dim]
    scaled = np.floor(matrix * scale)
    if np.abs(scaled).max(initial=0) >= LARGEST:
        raise ValueError(f"a vector component is beyond {LARGEST} units of 1/{scale}: squared distances would not fit a long")
    return rows, scaled.astype(np.int64)


def _figures(vectors: DataFrame, dim: int, scale: float) -> list[tuple]:
    """(least, greatest, inner cell borders) of each dimension over all usable vectors; none if there is no vector.

    Tasks send extremes and some quantiles of each batch; the borders are quantiles of these.
    """
    points = [0.0, TAIL, *(j / 32 for j in range(1, 32)), 1 - TAIL, 1.0]

    def each(batches):
        for batch in batches:
            _, v = _integers(batch.column(0), dim, scale)
            if len(v):
                values = np.quantile(v, points, axis=0, method="nearest").T
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(values.tolist())], names=["d", "points"])

    parts = vectors.mapInArrow(each, "d int, points array<long>")
    wanted = [TAIL, *(j / (CELLS - 2) for j in range(1, CELLS - 2)), 1 - TAIL]
    points = parts.select("d", F.explode("points").alias("x"))
    rows = points.groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.percentile_approx("x", wanted, 4096).alias("edges"))
    return [(r["low"], r["high"], r["edges"]) for r in sorted(rows.collect(), key=lambda r: r["d"])]


class Cells:
    """Cell borders of each dimension."""

    def __init__(self, figures: list[tuple]) -> None:
        self.edges = np.array([edges for _, _, edges in figures], np.int64)
        low, high = (np.array([f[i] for f in figures], np.int64)[:, None] for i in (0, 1))
        # Cell j holds the integers from first[j] to last[j]. A cell outside of the range is empty, and so its bounds are free.
        self.first = np.concatenate([low, np.clip(self.edges, low, high)], axis=1)
        self.last = np.concatenate([np.clip(self.edges - 1, low, high), high], axis=1)

    def packed(self, vectors: np.ndarray) -> np.ndarray:
        """Cells of vectors, two dimensions to a byte."""
        n, dim = vectors.shape
        cells = np.zeros((n, dim + dim % 2), np.uint8)
        for d in range(dim):
            cells[:, d] = np.searchsorted(self.edges[d], vectors[:, d], side="right")
        return cells[:, 0::2] | cells[:, 1::2] << 4

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance to each centroid, by pair of dimensions and byte.

        As seen from a middle point of the vectors, (x - c)^2 is x^2 + c^2 - 2xc. The first term is the same for all
        centroids and is left out of both bounds: what remains varies in a cell by its width times c, not times x - c.
        """
        middle = self.edges[:, CELLS // 2 - 1]
        c = (centroids - middle).T[:, None, :]
        ends = [(side - middle[:, None])[:, :, None] * c for side in (self.first, self.last)]
        least, most = c * c - 2 * np.maximum(*ends), c * c - 2 * np.minimum(*ends)
        if len(least) % 2:
            least, most = (np.concatenate([t, np.zeros_like(t[:1])]) for t in (least, most))
        byte = np.arange(256)
        return tuple(t[0::2][:, byte & 15] + t[1::2][:, byte >> 4] for t in (least, most))


class Assigner:
    """Nearest centroids of vectors given as cells; ``fetched`` counts the full vectors it had to look at."""

    def __init__(self, cells: Cells, centroids: np.ndarray) -> None:
        self.centroids, self.fetched = centroids, 0
        self.least, self.most = cells.tables(centroids)

    def assign(self, packed: np.ndarray, full) -> np.ndarray:
        """Cluster by row. full: gives the full vectors of rows."""
        out = np.empty(len(packed), np.int64)
        for at in range(0, len(packed), CHUNK):
            part = packed[at : at + CHUNK]
            low = np.zeros((len(part), len(self.centroids)), np.int64)
            high = low.copy()
            for p in range(part.shape[1]):
                low += self.least[p][part[:, p]]
                high += self.most[p][part[:, p]]
            open_ = low <= high.min(axis=1)[:, None]
            out[at : at + CHUNK] = open_.argmax(axis=1)
            unsure = np.nonzero(open_.sum(axis=1) > 1)[0]
            if len(unsure):
                self.fetched += len(unsure)
                vectors = full(unsure + at).astype(np.int64)
                exact = np.full((len(unsure), len(self.centroids)), np.iinfo(np.int64).max)
                for c, centroid in enumerate(self.centroids):
                    rows = np.nonzero(open_[unsure, c])[0]
                    exact[rows, c] = ((vectors[rows] - centroid) ** 2).sum(axis=1)
                out[at + unsure] = exact.argmin(axis=1)  # the first of equal ones
        return out


def _assigned(batch: pa.RecordBatch, assigner: Assigner, dim: int) -> np.ndarray:
    packed = matrix_of(batch.column("cells"), "u1", dim // 2 + dim % 2)
    return assigner.assign(packed, lambda rows: matrix_of(batch.column("full").take(pa.array(rows)), "<i4", dim))


def _updated(file: DataFrame, cells: Cells, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of its members' mean; one without members stays."""
    k, dim = centroids.shape

    def each(batches):
        assigner, sums, sizes = Assigner(cells, centroids), np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = _assigned(batch, assigner, dim)
            vectors = matrix_of(batch.column("full"), "<i4", dim)
            for c in np.unique(cluster):
                members = vectors[cluster == c]
                sums[c] += members.sum(axis=0, dtype=np.int64)
                sizes[c] += len(members)
        used = np.nonzero(sizes)[0]
        totals = [[*row, size] for row, size in zip(sums[used].tolist(), sizes[used].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(totals, pa.list_(pa.int64()))], names=["cluster", "totals"])

    parts = file.select("cells", "full").mapInArrow(each, "cluster int, totals array<long>")
    each_sum = parts.select("cluster", F.posexplode("totals").alias("d", "total"))
    summed = each_sum.groupBy("cluster", "d").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["cluster"], r["d"]): int(r["total"]) for r in summed}
    fresh = centroids.copy()
    for c in range(k):
        if (c, dim) in total:
            fresh[c] = [total[c, d] // total[c, dim] for d in range(dim)]
    return fresh


def _first(file: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, in order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = file.select(F.sha2(text.cast("binary"), 256).alias("hash"), "full").orderBy("hash", "full").limit(k).collect()
    return np.array([np.frombuffer(r["full"], "<i4") for r in rows], np.int64).reshape(-1, dim)


def cluster_vectors(
    df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", dim: int = 64, scale: float = 64.0,
    k: int = 16, rounds: int = 3, seed: int = 1, scratch: Scratch | None = None,
) -> DataFrame:
    """Rows of usable vectors as struct ``doc`` with cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark, scratch = df.sparkSession, scratch or Scratch(df.sparkSession)
    source = df.select(whole_row(df).alias("doc"), df[f"`{id_col}`"].alias("id"), df[f"`{vector}`"].alias("vector"))
    made = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    figures = _figures(source.select("vector"), dim, scale)
    if not figures:
        schema = T.StructType([source.schema["doc"], *T.StructType.fromDDL(made).fields])
        return spark.createDataFrame([], schema)
    cells = Cells(figures)

    def approximate(batches):
        for batch in batches:
            rows, vectors = _integers(batch.column("vector"), dim, scale)
            kept = [batch.column(c).take(pa.array(rows)) for c in ("doc", "id")]
            kept += [binary_column(cells.packed(vectors)), binary_column(vectors.astype("<i4"))]
            yield pa.RecordBatch.from_arrays(kept, names=["doc", "id", "cells", "full"])

    binary = [T.StructField(c, T.BinaryType()) for c in ("cells", "full")]
    schema = T.StructType([source.schema["doc"], source.schema["id"], *binary])
    file = scratch.write(source.mapInArrow(approximate, schema), "vectors")
    centroids = _first(file, k, seed, dim)
    for _ in range(rounds):
        centroids = _updated(file, cells, centroids)

    def measure(batches):
        assigner = Assigner(cells, centroids)
        for batch in batches:
            cluster = _assigned(batch, assigner, dim)
            distance = ((matrix_of(batch.column("full"), "<i4", dim) - centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["doc", "cluster", "distance"])

    schema = T.StructType([source.schema["doc"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    placed = scratch.write(file.select("doc", "cells", "full").mapInArrow(measure, schema), "placed")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    whole = sum(int(r["inertia"]) for r in sums)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = [(r["cluster"], int(r["inertia"]), whole, digest[r["cluster"]]) for r in sums]
    about = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select("doc", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = cluster_vectors(vectors)
    return out.select(F.col("doc.vec_id").alias("vec_id"), *out.columns[1:])


def _oracle(k: int = 16, rounds: int = 3) -> str:
    """The same in SQL: every distance of every vector in every round."""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM v)
  ORDER BY h, v LIMIT {k}
)""",
    ]
    square = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(rounds + 1):
        parts.append(f"a{r} AS (SELECT rid, vec_id, v.v, c.c, {square} AS d FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c.c) = 1)")
        if r < rounds:
            parts.append(f"""m{r + 1} AS (
  SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i
  ) GROUP BY c
)""")
            parts.append(f"c{r + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r + 1} m USING (c))")
    last = f"""SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)"""
    return "WITH " + ",\n".join(parts) + "\n" + last


ORACLE = _oracle()
