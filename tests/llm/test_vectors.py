"""Clustering by cells and lattice hashing against brute force, on vectors with every odd case."""

import hashlib
import math
from itertools import product

import numpy as np
import pytest
from conftest import vectors

from ordermart.llm import lattice, vafile
from ordermart.llm.lattice import near_vectors
from ordermart.llm.vafile import Assigner, Cells, cluster_vectors


def whole_vectors(rows, dim=64):
    return [(i, [math.floor(64 * x) for x in v]) for i, v, *_ in rows if v and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]


def brute_clusters(rows, k=16, rounds=3, dim=64):
    """(id, cluster, distance) of every usable vector, by plain integers."""
    kept = whole_vectors(rows, dim)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centroids = [v for _, v in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centroids)]
    return sorted((str(i), j, d) for i, v in kept for d, j in [nearest(v)])


def test_clusters_of_odd_vectors(spark, edge_vectors):
    out = cluster_vectors(vectors(spark, edge_vectors))
    rows = out.collect()
    assert sorted((str(r["doc"]["vec_id"]), r["cluster"], r["distance"]) for r in rows) == brute_clusters(edge_vectors)
    assert {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    for c in {r["cluster"] for r in rows}:
        assert {r["cluster_inertia"] for r in rows if r["cluster"] == c} == {sum(r["distance"] for r in rows if r["cluster"] == c)}
    assert all(r["doc"]["cluster"] == "own" for r in rows)


@pytest.mark.parametrize("count", [1, 3, 17])
def test_few_vectors_and_ties(spark, count):
    rows = [(i, [float(i // 2), -1.0, 0.015]) for i in range(count)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((str(r["doc"]["vec_id"]), r["cluster"], r["distance"]) for r in cluster_vectors(df, dim=3).collect())
    assert found == brute_clusters(rows, dim=3)


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit a long"):
        cluster_vectors(df).collect()


def test_cells_bound_the_distance_and_spare_most_full_vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(scale=200, size=(8, 64))
    points = np.floor(centres[rng.integers(0, 8, 5000)] + rng.normal(scale=12, size=(5000, 64))).astype(np.int64)
    points[0] = 10**6  # far outside of the quantiles
    inner = [vafile.TAIL, *(j / 14 for j in range(1, 14)), 1 - vafile.TAIL]
    cells = Cells([(points[:, d].min(), points[:, d].max(), np.quantile(points[:, d], inner, method="nearest")) for d in range(64)])
    centroids = np.floor(centres).astype(np.int64)
    packed = cells.packed(points)
    least, most = cells.tables(centroids)
    exact = ((points[:, None] - centroids) ** 2).sum(axis=2)
    low = sum(least[p][packed[:, p]] for p in range(32))
    high = sum(most[p][packed[:, p]] for p in range(32))
    # Both bounds leave out the vector's own squared distance from the middle point.
    own = ((points - cells.edges[:, 7]) ** 2).sum(axis=1)[:, None]
    assert (low <= exact - own).all() and (exact - own <= high).all()
    assigner = Assigner(cells, centroids)
    assert (assigner.assign(packed, lambda rows: points[rows]) == exact.argmin(axis=1)).all()
    assert 0 < assigner.fetched < 0.2 * len(points)


def test_no_python_sums_reach_the_driver_by_vector(spark, sf_dir):
    """At most k rows a task are shuffled for an update: the plan has one exchange, of sums."""
    rows = vafile.op11_centroid_clustering(spark, sf_dir).collect()
    assert len({r["vec_id"] for r in rows}) == len(rows) == 500
    assert {r["cluster"] for r in rows} <= set(range(16))


def test_decoded_points_are_the_nearest_of_the_lattice():
    short = lattice.shortest()
    assert len(np.unique(short, axis=0)) == 240 and np.allclose((short**2).sum(axis=1), 2)
    rng = np.random.default_rng(1)
    y = rng.normal(scale=3, size=(2000, 8))
    point = lattice.decoded(y)
    doubled = 2 * point
    assert (doubled == np.rint(doubled)).all()
    assert (np.ptp(doubled % 2, axis=1) == 0).all() and (point.sum(axis=1) % 2 == 0).all()
    # Nearest: no lattice point is closer than the point itself, as seen from the shortest and the next shell.
    shell = np.array([2.0 * np.eye(8)[d] * s for d, s in product(range(8), (1, -1))])
    moves = np.concatenate([short, shell])
    own = ((y - point) ** 2).sum(axis=1)
    for m in moves:
        assert (((y - point - m) ** 2).sum(axis=1) >= own - 1e-9).all()


def brute_links(rows, threshold=0.9):
    """id position to (links, smallest id reachable)."""
    units = []
    for _, v, *_ in rows:
        fine = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / np.linalg.norm(v) if fine else None)
    n = len(rows)
    linked = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((str(rows[i][0]), len(linked[i]), str(min(ids) if ids else None)))
    return sorted(out)


def found(df, **how):
    rows = near_vectors(df, **how).collect()
    assert all(r["kept"] == (r["doc"]["vec_id"] == r["component_id"]) for r in rows)
    return sorted((str(r["doc"]["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows)


def test_links_of_odd_vectors(spark, edge_vectors):
    assert found(vectors(spark, edge_vectors)) == brute_links(edge_vectors)


def groups(seed, sizes, noise):
    """Vectors around centres: groups of near copies, some of them equal."""
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        centre = rng.normal(size=64)
        out += [(centre + rng.normal(scale=noise, size=64)).tolist() for _ in range(size)]
        out += [out[-1]] * 3
    order = rng.permutation(len(out))
    return [(i, out[k]) for i, k in enumerate(order.tolist())]


@pytest.mark.parametrize("block", [8, 2048])
@pytest.mark.parametrize("noise", [0.05, 0.2, 0.32])
def test_groups_as_blocks_and_as_crowds(spark, block, noise):
    """A third of all rows in one group. With noise 0.32 pairs lie about the threshold and crowds have a rim."""
    rows = groups(7, [120, 60, 30] + [2] * 40 + [1] * 60, noise)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, wanted = found(df, block=block), brute_links(rows)
    if noise < 0.3:
        assert got == wanted
    else:
        links, all_links = (sum(r[1] for r in x) for x in (got, wanted))
        assert 0.9 * all_links <= links <= all_links
        assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, wanted, strict=True))


def test_recall_of_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    u, w = rng.normal(size=(2, 1500, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w -= (w * u).sum(axis=1)[:, None] * u
    w /= np.linalg.norm(w, axis=1)[:, None]
    both = np.concatenate([u, 0.901 * u + math.sqrt(1 - 0.901**2) * w])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    assert near_vectors(df).selectExpr("sum(n_links)").head()[0] >= 0.9 * 3000
