import numpy as np
import pytest

from lintlake.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, node string, vector string, least string, copies string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "n", "v", "l", "c") for i, v, k in rows], SCHEMA).repartition(3)


def plain(rows, cosine=0.98):
    n, linked = len(rows), {}
    unit = []
    for _, v, label in rows:
        x = None if v is None or any(e is None for e in v) else np.array(v, dtype=np.float64)
        ok = label is not None and x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.linalg.norm(x) if ok else None)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            same = unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
            if same and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i], links[j] = links[i] + 1, links[j] + 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    del linked
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((vec_id, links[i], component, vec_id is not None and vec_id == component))
    return sorted(out, key=repr)


def made(seed, n, dims, labels=2):
    """Vectors in groups: copies, multiples, and neighbours on both sides of the threshold."""
    rng, rows = np.random.default_rng(seed), []
    centres = rng.standard_normal((n // 6, dims))
    for i in range(n):
        c = centres[i % len(centres)]
        v = c / np.linalg.norm(c) + rng.standard_normal(dims) * rng.choice([0, 0.05, 0.12, 0.16, 0.2, 0.4]) / np.sqrt(dims)
        rows.append((i * 3 % 1009, (v * rng.choice([1.0, 1.0, 7.5])).astype(np.float32).tolist(), i % labels))
    return rows


@pytest.mark.parametrize("dims", [3, 8, 20, 64])
def test_all_links_are_found(spark, dims):
    rows = made(dims, 240, dims)
    got = sorted(map(tuple, ed.near_duplicates(table(spark, rows)).collect()), key=repr)
    assert got == plain(rows)


def test_budgets_add_up():
    for dims in (1, 7, 8, 9, 64):
        budgets = ed.block_budgets(dims, 0.98)
        assert 0.04 <= budgets.sum() < 0.0401
    q = ed.rotation(9)
    assert np.allclose(q @ q.T, np.eye(9))


def test_edge_cases(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, w, 0), (3, [9.0, 0.0, 0.0], 0), (None, w, 0), (4, v, 1), (5, v, None), (6, None, 0),
        (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0),
        (11, [1.0, float("inf"), 3.0], 0), (12, [1.0, 2.0], 0), (None, [0.0, 1.0, 0.0], 1), (None, None, None),
        (13, [2.0, 4.0, 6.0], 0),
    ]
    got = sorted(map(tuple, ed.near_duplicates(table(spark, rows)).collect()), key=repr)
    assert got == plain(rows)
    assert ed.near_duplicates(table(spark, rows).where("false")).collect() == []


@pytest.mark.parametrize("size", [1e-320, 1e-200, 1.0, 1e200, 1.7e308])
def test_components_of_any_size(spark, size):
    base = [(0, [1.0, 0.5, 0.25]), (1, [1.0, 0.5, 0.27]), (2, [0.25, 0.5, 1.0]), (3, [-1.0, -0.5, -0.25])]
    rows = [(i, [x * size for x in v], 1, "n", "v", "l", "c") for i, v in base]
    df = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    got = sorted(tuple(r)[:3] for r in ed.near_duplicates(df).collect())
    assert got == [(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 0, 3)]
