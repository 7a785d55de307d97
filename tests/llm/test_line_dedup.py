import random
import time

import pytest

from lintlake.llm import line_dedup

from .conftest import EDGE_TEXTS, prose


def run(df, **kw):
    return line_dedup.without_repeats(df, **kw)


def check_removed(docs, got, min_words=line_dedup.MIN_WORDS):
    """Every removed run has words enough and stands, piece by piece, at earlier places.

    `docs` holds (id, text) with different ids; `got` the rows with `removed`.
    """
    texts = dict(docs)
    for row in got:
        text = texts[row.doc_id]
        if text is None:
            assert row.text is None and row.removed == []
            continue
        kept, at = [], 0
        for span in row.removed:
            assert at <= span.start < span.stop <= len(text)
            kept.append(text[at : span.start])
            at = span.stop
            gone = text[span.start : span.stop]
            assert len(gone.split()) >= min_words
            earlier = "\n".join([t for i, t in docs if t and i < row.doc_id] + [text[: span.start]])
            words = gone.split()
            # Of what goes, six words in a row were written before.
            flat = f" {' '.join(earlier.split())} "
            missing = [i for i in range(len(words)) if not any(
                f" {' '.join(words[max(0, a) : a + 6])} " in flat for a in range(i - 5, i + 1) if a >= 0 and a + 6 <= len(words))]
            assert not missing, (row.doc_id, words)
        assert row.text == "".join(kept) + text[at:]


def sentences(rng, n):
    """n random words in sentences of 14 to 18."""
    out, left = [], rng.randint(14, 18)
    for _ in range(n):
        left -= 1
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
        out.append(word + ("." if left == 0 else ""))
        left = left or rng.randint(14, 18)
    return " ".join(out)


PASSAGE = " ".join(f"passage{i % 23} word{i % 7}" + ("." if i % 8 == 7 else "") for i in range(60))


def chunks(data):
    found = line_dedup.chunks_of([data])
    return list(zip(*[c.tolist() for c in found[1:]], strict=True))


def test_chunks_cover_text_in_order():
    texts = [t.encode() for t in (prose(1, 2000), "one", "a. b", "é ü\n\n ñ. x", " lead\n\ttail \n", prose(2, 500), "x " * 999)]
    for data in texts:
        rows = chunks(data)
        assert data[: rows[0][0]].strip() == b"" and rows[-1][2] == len(data)
        assert all(a[2] == b[0] and data[a[1] : a[2]].strip() == b"" for a, b in zip(rows, rows[1:], strict=False))
        assert sum(r[3] for r in rows) == len(data.split()) and all(data[s:e] == data[s:e].strip() for s, e, *_ in rows)
        by_hash = {}
        for s, e, _, _, h, _ in rows:
            assert by_hash.setdefault(h, data[s:e]) == data[s:e]
    assert chunks(b"") == [] and chunks(b" \n \n") == [] and len(line_dedup.chunks_of([]).start) == 0


def test_a_batch_is_cut_as_its_texts_are():
    rng = random.Random(9)
    texts = [b"", b" ", b"a", *[prose(i, rng.randint(1, 400)).encode() for i in range(30)], b"", "日本 語. ü".encode(), b"tail\n"]
    found = line_dedup.chunks_of(texts)
    together = list(zip(*[c.tolist() for c in found], strict=True))
    assert together == [(i, *row) for i, t in enumerate(texts) for row in chunks(t)]


def test_long_texts_are_cut_before_words(monkeypatch):
    monkeypatch.setattr(line_dedup, "PIECE", 300)
    texts = [prose(i, 200).encode() for i in range(5)] + [b"x" * 2000, b"y" * 1000 + b" z" * 500]
    found = line_dedup.chunks_of(texts)
    for i, t in enumerate(texts):
        rows = [r for r in zip(*[c.tolist() for c in found], strict=True) if r[0] == i]
        assert rows[0][1] == 0 and rows[-1][3] == len(t) and sum(r[4] for r in rows) == len(t.split())
        assert all(a[3] == b[1] for a, b in zip(rows, rows[1:], strict=False))


def test_boundaries_find_themselves_again():
    rng = random.Random(4)
    text = sentences(rng, 3000)
    bodies = lambda t: {t.encode()[s:e] for s, e, *_ in chunks(t.encode())}
    for _ in range(20):
        at = rng.randrange(len(text))
        shifted = text[:at] + sentences(rng, rng.randint(1, 9)) + text[at:]
        assert len(bodies(text) - bodies(shifted)) <= 3


@pytest.mark.parametrize(("words", "least"), [(50, 0.85), (75, 0.9), (100, 0.95), (150, 0.95)])
def test_passages_pasted_inside_sentences(make, words, least):
    rng, docs, passages = random.Random(words), [], []
    for i in range(100):
        passage = sentences(rng, words)
        for j in (0, 1):
            around = [sentences(rng, rng.randint(60, 120)).rstrip(".") for _ in range(2)]
            docs.append((2 * i + j, f"{around[0]} {passage} {around[1]}"))
        passages.append(passage)
    got = {r.doc_id: r for r in run(make(docs), details=True).collect()}
    check_removed(docs, got.values())
    assert all(got[2 * i].removed == [] for i in range(100))
    gone = sum(len(docs[2 * i + 1][1]) - len(got[2 * i + 1].text) for i in range(100))
    assert least <= gone / sum(map(len, passages)) <= 1.02


def test_shared_passages_go_and_clean_texts_stay(make):
    docs = [(i, prose(50 + i, 150)) for i in range(6)]
    with_passage = [(i, f"{t.rstrip()}\n{PASSAGE}\n{prose(90 + i, 40)}") for i, t in docs]
    got = {r.doc_id: r for r in run(make(with_passage + [(20, prose(7, 200))]), details=True).collect()}
    assert got[0].text == with_passage[0][1] and got[20].text == prose(7, 200) and got[20].removed == []
    for i, t in docs[1:]:
        assert got[i].text == f"{t.rstrip()}\n{prose(90 + i, 40)}" and len(got[i].removed) == 1
        assert got[i].n_chars == len(got[i].text)


def test_short_repeats_stay(make):
    phrase = " ".join(sentences(random.Random(1), 15).split())
    docs = [(i, f"{sentences(random.Random(100 + i), 80).rstrip('.')} {phrase} {sentences(random.Random(200 + i), 80)}") for i in range(12)]
    got = run(make(docs), details=True).collect()
    assert all(r.removed == [] for r in got)


def test_random_documents(make):
    """Texts put together from shared pieces, some of them within one document."""
    rng = random.Random(11)
    pieces = [sentences(rng, rng.randint(5, 120)) for _ in range(25)]
    docs = []
    for i in range(80):
        parts = [rng.choice(pieces) if rng.random() < 0.6 else sentences(rng, rng.randint(3, 90)) for _ in range(rng.randint(1, 6))]
        docs.append((i * 3, rng.choice([" ", "\n", "\n\n", "  "]).join(parts)))
    got = run(make(docs).repartition(7), details=True).collect()
    check_removed(docs, got)
    # Pieces of 60 words and more are left hardly anywhere but where they came first.
    left = {p: sum(" ".join(p.split()) in " ".join(r.text.split()) for r in got) for p in pieces if len(p.split()) >= 60}
    assert sum(left.values()) <= len(left) + 2


def test_edge_cases(edge, nothing):
    result = run(edge, details=True)
    assert set(result.columns) == set(edge.columns)
    got = {}
    for r in result.collect():
        got.setdefault(r.doc_id, []).append((r.text, len(r.removed)))
    assert sum(map(len, got.values())) == len(EDGE_TEXTS)
    copy, other = prose(3, 90), prose(4, 90)
    assert sorted(got[5]) == sorted([(copy, 0), (copy, 0), (other, 0)]) and got[6][0][1] == 1 and got[6][0][0].strip() == ""
    for doc_id, text in EDGE_TEXTS:
        if doc_id != 6:
            assert (text, 0) in got[doc_id]
    assert run(edge).columns == edge.columns
    assert run(nothing).collect() == [] and run(nothing, details=True).collect() == []


def test_null_ids_come_first(make):
    text = sentences(random.Random(2), 60)
    got = run(make([(None, text), (-5, text), (3, f"new words {text}")]), details=True).collect()
    assert {r.doc_id: r.text for r in got} == {None: text, -5: "", 3: "new words "}


def test_equal_rows_cost_what_one_does(make):
    text = sentences(random.Random(3), 400)
    docs = make([(1, text)] * 400 + [(2, text), (3, "other " + text)])
    spans = line_dedup.repeats(docs)
    one = line_dedup.repeats(make([(1, text), (2, text), (3, "other " + text)]))
    assert spans.count() == one.count()
    start = time.perf_counter()
    got = run(docs, details=True).collect()
    assert time.perf_counter() - start < 60
    assert [len(r.removed) for r in got if r.doc_id == 1] == [0] * 400
    assert {r.doc_id: r.text for r in got if r.doc_id > 1} == {2: "", 3: "other "}


def test_hot_passage(make):
    docs = [(i, PASSAGE if i % 3 else prose(300 + i, 60)) for i in range(30)]
    got = run(make(docs), details=True).collect()
    check_removed(docs, got)
    assert {r.doc_id for r in got if not r.removed} == {0, 1, 3, 6, 9, 12, 15, 18, 21, 24, 27}


def test_very_long_texts_and_lines(make):
    long = "x" * 200_000
    words = sentences(random.Random(6), 30_000)
    docs = [(1, long), (2, f"{long} {words}"), (3, f"{words}\n{long}"), (4, "ab " * 50_000), (5, "a b c. " * 20_000)]
    got = run(make(docs), details=True).collect()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text == long and by_id[2].removed == []
    assert len(by_id[3].text) <= len(long) + 2_000
    assert len(by_id[4].text) + len(by_id[5].text) <= 300_000
