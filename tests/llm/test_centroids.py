"""Clusters against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from lintlake.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, v string, cluster string, distance string, nearest string"


def table(spark, rows, kind="double"):
    schema = SCHEMA.replace("double", kind)
    return spark.createDataFrame([(i, v, 1, "v", "c", "d", "n") for i, v in rows], schema).repartition(3)


def plain(rows, k, rounds, dims, scale=1024, limit=1 << 27):
    kept = [
        (i, tuple(max(-limit, min(limit, math.floor(scale * x))) for x in v)) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))  # noqa: E731, B905
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, members in groups.items():
            middle[n] = tuple(sum(c) // len(members) for c in zip(*members))  # noqa: B905
    found = [(i, *near(v)) for i, v in kept]
    own = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(
        ((i, n, d, own[n], sum(own.values()), list(middle[n]), digest(middle[n])) for i, d, n in found), key=repr
    )


def run(df, **kw):
    return sorted((tuple(r) for r in centroids.cluster(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i % 150, (rng.standard_normal(6) * 0.2 + i % 3).tolist()) for i in range(160)]
    rows += [rows[0]] * 40 + [(500, [x / 1024 for x in (1, 2, 3, 4, 5, 6)]), (501, [-1 / 4096] * 6)]
    assert run(table(spark, rows), k=5, rounds=4, dims=6) == plain(rows, 5, 4, 6)


def test_production_size(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(64).astype(np.float32).astype(float).tolist()) for i in range(60)]
    assert run(table(spark, rows, "float")) == plain(rows, 8, 10, 64)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [0.5, 0.5]), (None, [0.25, 0.25]), (1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [1e300, -1e300]), (8, [-0.0, 1e-300]), (8, [-0.0, 1e-300]), (8, [0.3, 0.3]),
    ]
    assert run(table(spark, rows), k=3, rounds=2, dims=2) == plain(rows, 3, 2, 2)
    # Fewer vectors than centroids.
    assert run(table(spark, rows), k=9, rounds=2, dims=2) == plain(rows, 9, 2, 2)


def test_ties_and_empty_clusters(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(20)]
    assert run(table(spark, rows), k=6, rounds=3, dims=2) == plain(rows, 6, 3, 2)


def test_nothing(spark):
    out = centroids.cluster(table(spark, []))
    assert out.count() == 0 and dict(out.dtypes)["cluster"] == "int" and dict(out.dtypes)["inertia"] == "bigint"


def test_sum_beyond_a_long(spark):
    far = [(i, [1e9 * (-1) ** i] * 64) for i in range(6)]
    found = run(table(spark, far), k=1, rounds=1)
    assert found == [(*r[:4], min(r[4], centroids.LARGEST), *r[5:]) for r in plain(far, 1, 1, 64)]


def test_plan_has_no_python(spark):
    df = table(spark, [(1, [0.0] * 64)])
    plan = centroids.assigned(centroids.integer_vectors(df), [tuple(range(64))] * 8)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
