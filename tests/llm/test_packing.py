import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lintlake.llm import packing
from lintlake.llm.queries import tokenizer_path

from .conftest import EDGE_TEXTS, prose

ODD = [" ", "  ", "\n", "a", "é", "1", ".", "'s", "'", "\xa0", "　", "\x1c", "\t", "<|endoftext|>", "<|", "日本",
       "🙂", "\x85", "_", "\r\n", "²", "́", "\x00", "Ⅷ"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_encoder_gives_the_tokenizers_ids(tokenizer):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(5000)] + [prose(5, 3000)]
    got = packing.Encoder(tokenizer_path()).ids(texts)
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(g.tolist() == w.ids for g, w in zip(got, want, strict=True))


def check_pieces(rows, ids_of):
    """Every id in exactly one piece, sequences gapless and full but for one per partition."""
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length == len(r.ids) and r.doc_tokens >= r.start + r.length
        covered[r.doc_id].append((r.start, tuple(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    short = 0
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0, *[p[1] for p in parts[:-1]]]).tolist()
        total = sum(p[1] for p in parts)
        assert total <= parts[0][2] <= 2048
        short += total < parts[0][2]
    wanted = Counter()
    for doc_id, texts in ids_of.items():
        wanted.update((doc_id, i) for ids in texts for i in ids)
    assert Counter((d, i) for d, parts in covered.items() for _, ids in parts for i in ids) == wanted
    for doc_id, texts in ids_of.items():
        if len(texts) == 1:
            assert [i for _, ids in sorted(covered[doc_id]) for i in ids] == texts[0]
    return short


def test_pack_edge_cases(edge, tokenizer):
    rows = packing.pack(edge, tokenizer_path()).collect()
    ids_of = defaultdict(list)
    for doc_id, text in EDGE_TEXTS:
        ids_of[doc_id].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    assert check_pieces(rows, ids_of) <= edge.rdd.getNumPartitions()


def test_pack_empty(nothing):
    assert packing.pack(nothing, tokenizer_path()).collect() == []


def test_tiers_and_groups(make, tokenizer):
    texts = [(i, prose(100 + i, 15 + 37 * i % 900)) for i in range(200)]
    rows = packing.pack(make(texts).coalesce(1), tokenizer_path(), group_size=4).collect()
    ids_of = {i: [[*tokenizer.encode(t, add_special_tokens=False).ids, 1]] for i, t in texts}
    assert check_pieces(rows, ids_of) <= 1
    tiers = {r.sequence_id: r.tier for r in rows}
    assert len(set(tiers.values())) > 1
    groups = defaultdict(set)
    for r in rows:
        groups[r.step_group].add((r.sequence_id, r.tier))
    assert all(len(g) <= 4 and len({t for _, t in g}) == 1 for g in groups.values())


def test_crc_digest():
    ids = np.array([1, 2, 70000], dtype=np.int32)
    want = zlib.crc32(b"\x01\0\0\0\x02\0\0\0\x70\x11\x01\0")
    assert packing.ids_crc32([ids]).to_pylist() == [want]
