"""Clusters over zone maps against plain rounds over all vectors, and the curve's own properties."""

import hashlib

import numpy as np
import pytest

from tidemart.llm import clusters

SCHEMA = "vec_id bigint, embedding array<float>, distance string, v string, low string, row string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA)


def plain(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def own(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[own(v)[1]].append(v)
        centroids = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, centroids)]
    found = [(i, *own(v)[::-1]) for i, v in kept]
    total = {n: sum(d for _, m, d in found if m == n) for n in range(k)}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, total[n], sum(total.values()), sha[n]) for i, n, d in found), key=repr)


def found(df, **more):
    return sorted((tuple(r) for r in clusters.clustered(df, **more).collect()), key=repr)


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 64))
    rows = [(i, (centres[i % 5] + rng.normal(size=64) * 0.05).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[3]] * 3 + [(None, rows[4][1])] * 2
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [None] + [1.0] * 63),
             (2004, [float("nan")] * 64), (2005, [float("-inf")] * 64), (2006, [0.0] * 64),
             (2007, [-0.0] * 64), (2008, [1.0] * 65)]
    df = table_of(spark, rows)
    want = plain(rows)
    for block in (1, 16, 128):
        assert found(df, block=block) == want
    assert found(df, rounds=0) == plain(rows, rounds=0)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.25] * 64)]
    assert found(table_of(spark, rows)) == plain(rows)
    assert found(table_of(spark, [])) == []
    assert found(table_of(spark, [(1, [2.0])])) == []


def test_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="larger than"):
        found(table_of(spark, [(1, [2e5] * 64)]))
    with pytest.raises(ValueError, match="63 bits"):
        clusters.clustered(table_of(spark, []), width=1024)


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (5, 2)])
def test_the_curve_visits_neighbours(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n), -1).reshape(-1, n)
    keys = clusters.hilbert(cells, bits)
    assert len({k.tobytes() for k in keys}) == len(cells)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    steps = np.abs(np.diff(cells[order], axis=0)).sum(1)
    assert (steps == 1).all()


def test_boxes_leave_out_what_cannot_be_nearest():
    rng = np.random.default_rng(2)
    left = 0
    for _ in range(300):
        low = rng.integers(-20, 20, 3)
        high = low + rng.integers(0, 6, 3)
        centroids = rng.integers(-25, 25, (6, 3))
        points = np.stack(np.meshgrid(*[np.arange(a, b + 1) for a, b in zip(low, high)]), -1).reshape(-1, 3)
        some = clusters.candidates(low, high, centroids)
        everywhere, _ = clusters.nearest(points, centroids, np.arange(6))
        assert set(everywhere) <= set(some.tolist())
        left += 6 - len(some)
    assert left > 600       # of 1800
