import hashlib

import numpy as np
import pytest

from vanewright.llm import centroids


def slow(rows):
    """By plain integers, one vector after another."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    centres = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:40]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))
    for _ in range(5):
        at = [near(v)[1] for _, v in kept]
        for k in range(len(centres)):
            own = [v for a, (_, v) in zip(at, kept, strict=True) if a == k]
            if own:
                centres[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(str((i, k, d, sum(x[1] for x in found if x[2] == k), sum(x[1] for x in found), digest[k])) for i, d, k in found)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vec string, x string, cluster string, distance string")


def check(spark, rows):
    got = centroids.op11(table(spark, [(i, v, 0, "clash", "clash", "clash", "clash") for i, v in rows])).collect()
    assert sorted(str(tuple(r)) for r in got) == slow(rows)


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(7, 64))
    return [(k, (centre[k % 7] + rng.normal(size=64) * 0.1).astype(np.float32).tolist()) for k in range(n)]


def test_equals_plain_integers(spark):
    rows = vectors(150)
    odd = [(900, None), (901, [None] * 64), (902, [float("nan")] * 64), (903, [float("inf")] * 64), (904, [1.0] * 63), (905, []), (None, [0.5] * 64), (906, [0.0] * 64), (3, rows[3][1]), (3, rows[3][1]), (3, rows[4][1])]
    check(spark, rows + odd)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    check(spark, vectors(5) + [(50 + k, [0.25] * 64) for k in range(20)])


def test_nothing(spark):
    assert centroids.op11(table(spark, [])).count() == 0
    assert centroids.op11(table(spark, [(1, None, 0, "", "", "", "")])).count() == 0


def test_huge_components_count_as_the_bound(spark):
    v = table(spark, [(1, [3e38] * 64, 0, "", "", "", ""), (2, [-3e38] * 64, 0, "", "", "", "")])
    assert sorted(centroids.quantised(v).select("x").toPandas()["x"].map(lambda x: x[0])) == [-centroids.BOUND, centroids.BOUND]
    assert centroids.op11(v).agg({"distance": "max"}).first()[0] == 0


@pytest.mark.parametrize("value,want", [(-0.001, -1), (0.0, 0), (0.00390625, 1), (-1.0, -256)])
def test_floor(spark, value, want):
    assert centroids.quantised(table(spark, [(1, [value] * 64, 0, "", "", "", "")])).first()["x"] == [want] * 64
