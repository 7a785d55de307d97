import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lintlake.llm import lm

from .conftest import EDGE_TEXTS, prose


def plain(docs):
    words = [(t or "").encode().lower().split() + [b""] for _, t in docs]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1 if i is not None else False for i, _ in docs]
    c = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for (i, _), ws, h in zip(docs, words, held, strict=True)
    ]


def check(rows, docs):
    key = lambda r: (repr(r[:5]), round(r[5], 6))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    for g, w in zip(got, sorted(plain(docs), key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)


def test_edge_cases(edge, nothing):
    rows = lm.score(edge).collect()
    check(rows, EDGE_TEXTS)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    assert lm.score(nothing).collect() == []


def test_small_head_and_rare_words(make, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 20)
    monkeypatch.setattr(lm, "OWN_WORDS", 8)
    monkeypatch.setattr(lm, "COUNTED_WORDS", 30)
    docs = [(i, prose(i % 7, 40)) for i in range(40)]
    check(lm.score(make(docs).repartition(3)).collect(), docs)


def test_learns_what_follows(make):
    """Two vocabularies that never mix: the state tells which one a text is in."""
    def text(seed):
        rng = np.random.default_rng(seed)
        words = [f"{'ab'[seed % 2]}{i}" for i in range(40)]
        return " ".join(words[i] for i in rng.integers(0, 40, 120))

    docs = [(i, text(i)) for i in range(700)]
    held = [r for r in lm.score(make(docs).coalesce(2)).collect() if r.held_out]
    assert len(held) > 80
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.98


def network(own=12):
    rng = np.random.default_rng(1)
    counts = np.sort(rng.integers(1, 90, own))[::-1].astype(np.int64)
    v = lm.Vocabulary([b"w%d" % i for i in range(own)], counts, int(counts.sum()), own, np.full(lm.TAIL_CLASSES, 1.5), own)
    net = lm.Network.fresh(v)
    for name in ("oc", "ow"):
        net.p[name] = rng.standard_normal(net.p[name].shape).astype(np.float32) * 0.3
    return net


def test_shares_add_up_to_one():
    net = network()
    h = np.random.default_rng(2).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(net.own + lm.TAIL_CLASSES)
    logs, _ = net.log_probs(np.repeat(h, len(every), axis=0), every)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_gradients():
    net, rng = network(), np.random.default_rng(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    tokens = rng.integers(0, net.own + lm.TAIL_CLASSES, (3, 5))
    targets = rng.integers(0, net.own + lm.TAIL_CLASSES, (3, 5))
    targets[2, 3:] = -1
    h0 = rng.standard_normal((3, lm.HIDDEN)) * 0.1

    def loss():
        h, total = h0, 0.0
        for t in range(5):
            h = net.step(net.inputs()[tokens[:, t]], h)
            real = targets[:, t] >= 0
            total -= net.log_probs(h[real], targets[real, t])[0].sum()
        return total / (targets >= 0).sum()

    grads, _ = net.train_window(tokens, targets, h0)
    for name, values in net.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), values.shape)
        kept, e = values[at], 1e-5
        values[at] = kept + e
        up = loss()
        values[at] = kept - e
        down = loss()
        values[at] = kept
        assert grads[name][at] == pytest.approx((up - down) / (2 * e), rel=1e-3, abs=1e-6), name


def test_lanes_carry_the_state(monkeypatch):
    net, rng = network(), np.random.default_rng(4)
    docs = [rng.integers(0, net.own + lm.TAIL_CLASSES, n).astype(np.int32) for n in (1, 200, 3, 70, 64, 65, 2, 1)]
    want = []
    for d in docs:
        h, total, before = np.zeros((1, lm.HIDDEN), dtype=np.float32), 0.0, net.start_token
        for token in d:
            h = net.step(net.inputs()[[before]], h)
            total += net.log_probs(h, np.array([token]))[0][0]
            before = token
        want.append(total)
    for lanes in (1, 3, 50):
        monkeypatch.setattr(lm, "LANES", lanes)
        assert lm.score_lanes(net, docs) == pytest.approx(want, rel=1e-4)
    assert len(lm.score_lanes(net, [])) == 0


def test_every_token_is_trained_on_once():
    """Documents of one run and of many: the rounds together see each token, and each end, once."""
    v = lm.Vocabulary([b"w%d" % i for i in range(12)], np.arange(12, 0, -1), 78, 12, np.full(lm.TAIL_CLASSES, 1.5), 12)
    for words in (0, 5, 63, 64, 100, 127, 200, 900):
        for place in range(12):
            docs = [(place, " ".join(f"w{i % 12}" for i in range(words)).encode())]
            seen = [lm._train_part(lm.Network.fresh(v), iter(docs), v.words, part) for part in range(lm.ROUNDS)]
            assert sum(seen) == words + 1


def test_texts_are_not_read_again_by_the_network(make, tmp_path):
    """Training and scoring go on from tokens that are handed over once."""
    path = str(tmp_path / "documents")
    documents = make([(i, prose(i, 30)) for i in range(20)])
    documents.write.parquet(path)
    scored = lm.score(documents.sparkSession.read.parquet(path))
    assert scored.inputFiles() and not any(path in f for f in scored.inputFiles())


def test_words_are_coded_as_they_are_split():
    pieces = ["a", "B", "É", "\x00", "\x1c", "\x85", "\xa0", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r"]
    rng = np.random.default_rng(5)
    texts = ["", " ", " a ", *("".join(rng.choice(pieces, n)) for n in rng.integers(1, 30, 400))]
    column = pa.array([t.encode() for t in texts])
    for some in (column, column.slice(0, 2), column.slice(9, 50)):
        words, codes, sizes = lm.coded_words(some)
        got, at = [words[i].as_py() for i in codes.tolist()], 0
        for text, n in zip(some.to_pylist(), sizes.tolist(), strict=True):
            assert got[at : at + n] == [*lm.words_of(text), b""]
            at += n
        assert at == len(got)
    odd = [b"", b"a", b"ab", b"abc", b"abcd", "日本".encode(), b"\xff\xfe\x01z"]
    assert lm._tail_classes(pa.array(odd)).tolist() == [lm.tail_class(w) for w in odd]


def test_large_states_neither_overflow_nor_vanish():
    net, rng = network(), np.random.default_rng(6)
    net.p["oc"] *= 60
    h = rng.standard_normal((300, lm.HIDDEN)).astype(np.float32)
    target = rng.integers(0, net.own + lm.TAIL_CLASSES, 300)
    logits = h.astype(float) @ net.p["oc"] + net.p["bc"]
    at = net.class_of[target]
    top = logits.max(axis=1)
    want = logits[np.arange(300), at] - top - np.log(np.exp(logits - top[:, None]).sum(axis=1))
    tail = target >= net.own
    assert net.log_probs(h, target)[0][tail] == pytest.approx(want[tail], rel=1e-4, abs=1e-3)


def test_steps_over_all_weights():
    """A few steps by the plain rule, on more weights than one strip."""
    rng, n = np.random.default_rng(8), lm._STRIP + 5
    flat, m, v = rng.standard_normal(n).astype(np.float32), np.zeros(n), np.zeros(n)
    want, adam = flat.astype(float), lm._Adam(flat)
    for t in range(1, 5):
        g = rng.standard_normal(n).astype(np.float32)
        adam.apply(flat, g)
        g = g.astype(float) / max(np.sqrt((g.astype(float) ** 2).sum()), 1)
        m, v = m + (g - m) * 0.1, v + (g * g - v) * 0.01
        want -= lm.RATE * math.sqrt(1 - 0.99**t) / (1 - 0.9**t) * m / (np.sqrt(v) + 1e-6)
    assert flat == pytest.approx(want, rel=1e-3, abs=1e-5)


def test_batches_are_gathered_and_those_of_long_texts_cut(monkeypatch):
    monkeypatch.setattr(lm, "GATHERED", 1_000)
    texts = [b"", b"ab", b"c" * 30, *[b"d" * 900] * 40, *[b"e"] * 300, b"f" * 5_000, b""]
    batch = lambda some: pa.RecordBatch.from_arrays([pa.array(some, type=pa.binary())], names=["text"])
    given = [batch(texts[:3]), batch([]), batch(texts[3:43]), *(batch([t]) for t in texts[43:])]
    got = list(lm._gathered(iter(given)))
    assert [t for b in got for t in b.column(0).to_pylist()] == texts
    assert all(b.num_rows and (b.nbytes < 3_000 or b"f" in b.column(0)[-1].as_py()) for b in got)
    assert len(got) < 60 and list(lm._gathered(iter([batch([])]))) == []
