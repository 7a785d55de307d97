import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from lintlake.llm import components, simhash

from .conftest import EDGE_TEXTS, prose


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_fingerprint():
    for text in ("", "one", "One Two", "a b c", "a b c d", prose(9, 300), "Ünï Cö DÉ É x\x0by z\x1cw"):
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_gray_rank():
    codes = np.array([i ^ (i >> 1) for i in range(1000)], dtype=np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(1000))


def near_codes(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 5)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        code = rng.choice(centres)
        for _ in range(rng.randint(0, 4)):
            code ^= 1 << rng.randrange(64)
        out.add(code)
    return sorted(out)


def test_tree_search_is_exact():
    codes = np.array(near_codes(700, 1), dtype=np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    for limit in (0, 2, 5):
        query, entry = simhash.GrayTree(codes).search(codes, limit)
        want = np.argwhere(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= limit)
        assert sorted(zip(query.tolist(), entry.tolist(), strict=True)) == [tuple(p) for p in want.tolist()]


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_links_connect_what_is_near(spark, monkeypatch, block_rows):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    codes = near_codes(600, 2)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    table = spark.createDataFrame([(c,) for c in signed], "code long").repartition(4)
    found = {(r.a, r.b) for r in simhash.links(table).collect()}
    place = {c: i for i, c in enumerate(signed)}
    got = classes(len(codes), [(place[a], place[b]) for a, b in found])
    want = classes(len(codes), [(i, j) for i, j in combinations(range(len(codes)), 2) if (codes[i] ^ codes[j]).bit_count() <= 2])
    assert got == want


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)]
    pairs += [(5, 5), (2, 1), (0, 1)]
    table = spark.createDataFrame(pairs, "a long, b long")
    root = {r.node: r.root for r in components.roots(table).collect()}
    want = classes(400, pairs)
    assert all(root.get(i, i) == want[i] for i in range(400))
    assert components.roots(table.where("a < 0")).collect() == []


def test_edge_cases(edge, nothing):
    rows = simhash.near_duplicates(edge).select("doc_id", simhash.hex_code(simhash.F.col("code")).alias("f"), "component_id").collect()
    want = []
    codes = [plain_fingerprint(t) for _, t in EDGE_TEXTS]
    n = len(codes)
    root = classes(n, [(i, j) for i, j in combinations(range(n), 2) if (codes[i] ^ codes[j]).bit_count() <= 2])
    for i, (doc_id, _) in enumerate(EDGE_TEXTS):
        ids = [d for j, (d, _) in enumerate(EDGE_TEXTS) if root[j] == root[i] and d is not None]
        want.append((doc_id, f"{codes[i]:016x}", min(ids, default=None)))
    key = repr
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(nothing).collect() == []


def test_keep_one(edge, nothing, make):
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    codes = {}
    for doc_id, text in EDGE_TEXTS:
        codes.setdefault(plain_fingerprint(text), []).append((doc_id is None, doc_id or 0, text))
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == sorted((m[0], m[1]) for m in (min(c, key=lambda x: x[:2]) for c in codes.values()))
    assert simhash.keep_one(nothing).collect() == []
    same = make([(3, "a b c"), (3, "a b c"), (2, "a b c"), (2, "a b c")])
    assert [r.doc_id for r in simhash.keep_one(same).collect()] == [2]
