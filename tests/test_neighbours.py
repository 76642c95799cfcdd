import numpy as np
import pytest

from tidemill.operators import neighbours as N


def frames(spark, x, q):
    names = "abcd"[: x.shape[1]]
    kind = "id long, " + "".join(f"{n} double, " for n in names) + "y int"
    rows = lambda m: [(i, *map(float, r), i % 3) for i, r in enumerate(m)]
    return spark.createDataFrame(rows(x), kind), spark.createDataFrame(rows(q), kind), list(names)


def plain(x, q, k):
    out = []
    for i, p in enumerate(q):
        d = np.zeros(len(x))
        for f in range(x.shape[1]):
            d += (p[f] - x[:, f]) ** 2
        order = np.lexsort((np.arange(len(x)), d))[:k]
        out += [(i, rank + 1, float(t % 3), float(np.sqrt(d[t]))) for rank, t in enumerate(order)]
    return out


@pytest.mark.parametrize("blocks", [(30, 20, 10), (8, 5, 40), (10**6, 10**6, 10**6)])
def test_equal_to_all_pairs(spark, blocks):
    """Ties, a third of all rows equal, features of different widths, test rows far outside of all boxes."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 3)) * [100, 1, 5], 1)
    x[:100] = x[0]
    q = np.vstack([np.round(rng.normal(size=(40, 3)) * [100, 1, 5], 1), x[:3], [[1e6, -1e6, 0]]])
    train, test, names = frames(spark, x, q)
    got = N.nearest(train, test, names, "y", "id", 7, *blocks).orderBy("id", "rank").collect()
    assert [tuple(r) for r in got] == plain(x, q, 7)


def test_fewer_rows_than_k_and_empty_tables(spark):
    x, q = np.arange(12.0).reshape(6, 2), np.zeros((2, 2))
    train, test, names = frames(spark, x, q)
    assert [tuple(r) for r in N.nearest(train, test, names, "y", "id", 9, leaf_rows=2).orderBy("id", "rank").collect()] == plain(x, q, 9)
    assert N.nearest(train.limit(0), test, names, "y", "id", 2).count() == 0
    assert N.nearest(train, test.limit(0), names, "y", "id", 2, leaf_rows=2).count() == 0


def test_few_leaves_are_met(spark):
    """With three features a row meets a small share of 64 leaves, and one behind all boxes meets those it must."""
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(6400, 3)), rng.normal(size=(200, 3))
    leaves = N.grow(x, 6)
    at = leaves.of(x)
    assert np.bincount(at, minlength=64).max() <= 101
    boxes = (np.arange(64, dtype=np.int32), *(np.array([f(x[at == i], axis=0) for i in range(64)]) for f in (np.min, np.max)))
    home = leaves.of(q)
    reach = [float(np.sort(((x[at == h] - p) ** 2).sum(axis=1))[4]) for p, h in zip(q, home)]
    rows = spark.createDataFrame([(i, p.tolist(), int(h), r) for i, (p, h, r) in enumerate(zip(q, home, reach))], "id long, x array<double>, leaf int, reach double")
    assert N.other_leaves(rows, boxes).count() < 200 * 64 * 0.15
