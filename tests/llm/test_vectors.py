"""Clustering and hard negatives against brute force on odd and on given vectors."""

import hashlib
import math

import numpy as np
import pytest

from threadlens.llm import centroids, hard_negatives, queries
from threadlens.llm.vectors import LIMIT

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, row int, anchor int, score int"


def given(spark):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]


def odd_rows(seed=1):
    """Nulls, NaN, infinities, other lengths, ties, repeated rows and ids, huge values, zeros."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(90, 64)).round(2).astype(np.float32).tolist()
    rows = [(i * 10, x, i % 4) for i, x in enumerate(v)]
    rows += [(7, v[3], 1), (7, v[3], 1), (100, v[10], 2), (100, v[10], 2), (None, v[5], 3), (None, v[6], None), (14, None, 2), (21, v[7], None), (901, [0.0] * 64, 1), (1000, [0.0] * 64, 1)]
    rows += [(902, [None] + v[0][1:], 1), (903, [math.nan] + v[0][1:], 1), (904, [math.inf] + v[0][1:], 1), (905, v[8][:63], 1), (906, v[8] + [1.0, 2.0], 1), (1100, v[9] + [3.0], 2), (907, [], 3), (1200, [1e30] + v[4][1:], 0), (908, [-1e30] + v[4][1:], 0)]
    return [(*r, "x", 1, 2, 3) for r in rows]


def whole_numbers(x):
    if x is None or any(c is None or not math.isfinite(c) for c in x):
        return None
    return [math.floor(min(max(256.0 * c, -LIMIT), LIMIT)) for c in x]


def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, p) for i, x, *_ in rows if (p := whole_numbers(x)) is not None and len(p) == 64]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    points, centres = np.array([p for _, p in kept], object), [list(p) for _, p in order[:k]]

    def near():
        d = [((points - np.array(c, object)) ** 2).sum(1) for c in centres]
        return [min((d[j][i], j) for j in range(len(centres))) for i in range(len(points))]

    for _ in range(rounds):
        found = near()
        for j in range(len(centres)):
            mine = [points[i] for i, (_, c) in enumerate(found) if c == j]
            if mine:
                centres[j] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    found = near()
    return sorted(
        ((str(i), j, d, sum(d2 for d2, j2 in found if j2 == j), sum(d2 for d2, _ in found), hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, found, strict=True)))


def clusters_of(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


def test_clusters_of_the_smallest_table(spark):
    got = queries.op11_centroids(spark, SF)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert clusters_of(got) == brute_clusters(given(spark))


@pytest.mark.parametrize("take", [slice(None), slice(0, 15), slice(90, 94), slice(90, 92)])
def test_clusters_of_odd_vectors(spark, take):
    """Also fewer vectors than centroids, equal vectors only, and clashing column names."""
    rows = odd_rows()[take]
    assert clusters_of(centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA))) == brute_clusters(rows)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, "", 1, 1, 1), (2, [1.0], 1, "", 1, 1, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert clusters_of(centroids.cluster_vectors(df)) == []
        if not rows:
            assert hard_negatives.mine_negatives(df).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_apex_bounds_hold(seed):
    """Also for points on the pivots, far away, in a plane, and for equal pivots."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-300, 300, (200, 64))
    if seed % 3 == 1:
        points[:, 5:] = 7
    if seed % 3 == 2:
        points[50:] = points[rng.integers(0, 50, 150)] + rng.integers(-1, 2, (150, 64))
    points[0] *= 1000
    points[1] = points[2] = points[3]
    simplex = centroids.Simplex(centroids.choose_pivots(points, 24))
    apexes = simplex.apexes(centroids.squared_distances(points, simplex.pivots))
    low, high = centroids.bounds(apexes, apexes)
    exact = centroids.squared_distances(points, points)
    assert (low <= exact).all() and (high >= exact).all()


def test_bounds_leave_few_centroids(spark):
    compared = [r["compared"] for r in centroids.cluster_vectors(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()]
    assert min(compared) >= 1 and np.mean(compared) < 12


def brute_negatives(rows, every=100, n=5):
    kept = [(i, lab, p) for i, x, lab, *_ in rows if lab is not None and (p := whole_numbers(x)) is not None]
    order = lambda s, k: (-s, kept[k][0] is None, kept[k][0] or 0)
    out = []
    for a, (i, lab, p) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = {k: sum(x * y for x, y in zip(p, q, strict=False)) for k, (_, _, q) in enumerate(kept) if k != a}
        for pos in sorted((k for k in scores if kept[k][1] == lab), key=lambda k: order(scores[k], k))[:n]:
            fits = [k for k in scores if kept[k][1] != lab and 80 * scores[pos] <= 100 * scores[k] <= 100 * scores[pos]]
            out += [(i, kept[pos][0], r, kept[k][0], scores[pos], scores[k]) for r, k in enumerate(sorted(fits, key=lambda k: order(scores[k], k))[:n], 1)]
    return sorted(out, key=str)


def negatives_of(df):
    return sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect()), key=str)


def test_negatives_of_the_smallest_table(spark):
    rows = [(i, x, (lab + 1) % 10 if i % 7 == 0 else lab) for i, x, lab in given(spark)]
    got = negatives_of(queries.op12_hard_negatives(spark, SF))
    assert got == brute_negatives(rows) and len(got) > 50


@pytest.mark.parametrize("sizes", [(4096, 256), (16, 2)])
def test_negatives_of_odd_vectors(spark, monkeypatch, sizes):
    """Also over many packs of rows and of anchors."""
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", sizes[0])
    monkeypatch.setattr(hard_negatives, "PACK_ANCHORS", sizes[1])
    rows = odd_rows()
    assert negatives_of(hard_negatives.mine_negatives(spark.createDataFrame(rows, SCHEMA))) == brute_negatives(rows)


@pytest.fixture
def without_broadcasts(spark):
    """Every broadcast fails: the table of a join has a page of 1 MB at least."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "2k")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


@pytest.mark.parametrize("held", [1, 128])
def test_negatives_go_by_shuffles_only(spark, monkeypatch, without_broadcasts, held):
    """No side passes through the driver, with many packs, and with anchors held by several tasks too."""
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "PACK_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "KEPT_PACKS", held)
    rows = odd_rows() + [(10_000 + i, x, lab, *rest) for i, x, lab, *rest in odd_rows(2) if i is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    got = negatives_of(hard_negatives.mine_negatives(df))
    assert got == brute_negatives(rows) and len({r[0] for r in got}) > 10


def test_the_grid_has_tasks_for_all_cores_and_bounds_what_a_task_holds():
    pack, most = hard_negatives.PACK_ANCHORS, hard_negatives.PACK_ANCHORS * hard_negatives.KEPT_PACKS
    assert hard_negatives.grid(1, 0, 6) == (1, 1)
    assert hard_negatives.grid(10**6, pack, 6) == (12, 1)
    for rows in (10**5, 10**6, 10**7, 10**8):
        for cores in (1, 6, 1000):
            tiles, groups = hard_negatives.grid(rows, rows // 100, cores)
            assert rows // 100 <= groups * most and (tiles * groups >= 2 * cores or tiles * 2 * hard_negatives.PACK_ROWS >= rows)


@pytest.mark.parametrize("seed", range(4))
def test_intervals_hold_and_are_narrow(seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-100, 100, (300, 64))
    points[0], points[1], points[2] = 0, 3, -points[3]
    points[4:60] = np.eye(56, 64, dtype=int) * 500
    turn = hard_negatives.rotation(64, 512)
    low, high = hard_negatives.intervals(hard_negatives.Codes.of(points, turn), points[:40], turn)
    exact = points @ points[:40].T
    length = np.linalg.norm(points, axis=1)
    assert (low <= exact + 1e-6).all() and (high >= exact - 1e-6).all()
    assert (high - low)[60:].mean() / 2 < 0.35 * np.outer(length[60:], length[:40]).mean()


def test_few_rows_are_scored():
    """Rows whose interval ends below the window are never multiplied."""
    rng = np.random.default_rng(3)
    points = rng.integers(-100, 100, (2000, 64))
    ids = np.arange(2000)
    turn, none = hard_negatives.rotation(64, 512), {}
    pack = hard_negatives.Pack(ids, ids, ids % 5, points, none)
    anchors = hard_negatives.Pack(ids[:20], ids[:20], ids[:20] % 5, points[:20], none)
    window = np.array([[[int(0.5 * p @ p), int(p @ p)]] for p in points[:20]])
    best = hard_negatives.Best(anchors, window, 5)
    scored = best.meet(pack, hard_negatives.Codes.of(points, turn), turn, False)
    assert scored < 0.2 * 20 * 1600
