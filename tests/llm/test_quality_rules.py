"""Measures and verdicts against plain Python; the order never changes a verdict."""

import re

import pytest
from pyspark.sql import functions as F

from lintlake.llm import quality_rules as rules
from lintlake.llm.quality_rules import Given, Profile, Rule

from .conftest import EDGE_TEXTS, prose, row

BLANK = r"\x20\x09-\x0D"


def measures(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    again = {p + k for found in places.values() if len(found) > 1 for p in found for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
    }


def broken(text):
    m, text = measures(text), text or ""
    n, rows = max(m["n_words"], 1), max(m["n_lines"], 1)
    words = re.findall(f"[^{BLANK}]+", text)
    lines = text.split("\n")
    out = {
        "length": m["n_words"] < 50, "mean_word_length": not 3 <= m["word_chars"] / n <= 10,
        "symbols": m["n_symbols"] / n > 0.1, "duplicate_lines": m["n_dup_lines"] / rows > 0.3,
        "repeated_words": m["n_repeat_words"] * 100 > m["n_words"] * 50,
        "upper_case": sum(c.isupper() for c in text) / max(len(text), 1) > 0.3,
        "marks": sum(c in "!?" for c in text) / n > 0.5,
        "alphabetic": sum(any(c.isalpha() for c in w) for w in words) / n < 0.8,
        "bullets": sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines) / rows > 0.9,
        "ellipses": sum(x.rstrip(" \t").endswith(("...", "…")) for x in lines) / rows > 0.3,
    }
    return {name for name, bad in out.items() if bad}


TEXTS = [
    *[t for _, t in EDGE_TEXTS],
    prose(7, 300), prose(8, 300).upper(), prose(9, 80) * 4, "a b c " * 40, "a a a a", "x y x y x y", "one two three one two three",
    " ".join(f"{w}###" for w in prose(10, 120).split()), " ".join(f"{w}!!" for w in prose(11, 120).split()),
    "\n".join(f"- {prose(i, 9)}".replace("\n", " ") for i in range(20)), "\n".join(f"{prose(i, 9).strip()}..." for i in range(20)),
    "\n".join([prose(1, 8)] * 3 + [prose(i, 8) for i in range(30)]), " | ".join(prose(12, 90).split()),
    "12 34 56 " * 30 + prose(13, 40), "#" * 50_000, "a\x0bb\x0cc\rd\x85e\xa0f g", "é" * 60 + " ü", "(Hello) (world) " * 30,
    " lead and trail \n\n \t\n", "…\n" * 5 + prose(14, 60),
]


@pytest.fixture(scope="module")
def table(make):
    return make(list(enumerate(TEXTS))).repartition(4)


def test_measures(table):
    given = Given(F.col("text"))
    names = list(measures(""))
    known = Given(F.col("text"), words=F.col("words"), lines=F.col("lines"))
    plain = table.select("doc_id", *[given.of(getattr(rules, n)).alias(n) for n in names])
    layered = table.withColumns({"words": rules.words(given), "lines": rules.lines(given)}).select(
        "doc_id", *[known.of(getattr(rules, n)).alias(n) for n in names]
    )
    want = {i: measures(t) for i, t in enumerate(TEXTS)}
    for df in (plain, layered):
        assert {r.doc_id: {n: r[n] for n in names} for r in df.collect()} == want


def test_every_rule(table):
    given = Given(F.col("text"))
    found = table.select("doc_id", *[r.passes(given).alias(r.name) for r in rules.RULES]).collect()
    got = {r.doc_id: {x.name for x in rules.RULES if not r[x.name]} for r in found}
    want = {i: broken(t) for i, t in enumerate(TEXTS)}
    assert got == want
    assert {name for names in want.values() for name in names} == {r.name for r in rules.RULES}


def test_cascade(table):
    for ordered in (rules.RULES, rules.RULES[::-1]):
        first = table.select("doc_id", rules.first_broken(Given(F.col("text")), ordered).alias("first")).collect()
        assert {r.doc_id: r["first"] for r in first} == {
            i: next((x.name for x in ordered if x.name in broken(t)), None) for i, t in enumerate(TEXTS)
        }
    out = rules.cascade(table)
    assert out.columns == [*[c for c in table.columns if c != "kept"][:8], *out.columns[8:]]
    rows = {r.doc_id: r for r in out.collect()}
    assert {i: r.kept for i, r in rows.items()} == {i: not broken(t) for i, t in enumerate(TEXTS)}
    assert all((r.rejected_by in broken(TEXTS[i])) if not r.kept else r.rejected_by is None for i, r in rows.items())
    assert {r.doc_id for r in rules.keep_good(table).collect()} == {i for i, t in enumerate(TEXTS) if not broken(t)}
    assert rules.keep_good(table).columns == table.columns


def test_later_rules_are_not_evaluated(table):
    boom = Rule("boom", lambda given: F.raise_error(F.lit("evaluated")).cast("boolean"))
    never = Rule("never", lambda given: F.lit(False))
    found = table.select(rules.first_broken(Given(F.col("text")), [never, boom]).alias("first"))
    assert {r["first"] for r in found.collect()} == {"never"}
    unknown = Rule("unknown", lambda given: F.lit(None).cast("boolean"))
    found = table.select(rules.first_broken(Given(F.col("text")), [unknown, boom]).alias("first"))
    assert {r["first"] for r in found.collect()} == {"unknown"}


def test_order_by_rejection_per_cost():
    a, b, c = (Rule(n, lambda given: F.lit(True)) for n in "abc")
    # b rejects most per second; of what b lets through, c rejects more than a although a rejects more in all.
    found = Profile({"a": 1.0, "b": 0.5, "c": 1.0}, {frozenset("ab"): 50, frozenset("b"): 10, frozenset("c"): 20, frozenset(): 900})
    assert [r.name for r in rules.in_order([a, b, c], found)] == ["b", "c", "a"]
    assert [r.name for r in rules.in_order([a, b, c], Profile({"a": 3.0, "b": 2.0, "c": 1.0}, {}))] == ["c", "b", "a"]


def test_profile(table):
    found = rules.profile(table)
    assert sum(found.broken.values()) == len(TEXTS) and set(found.cost) == {r.name for r in rules.RULES}
    assert all(cost > 0 for cost in found.cost.values())
    assert sum(rules.profile(table.crossJoin(table.sparkSession.range(40)), sample_rows=100).broken.values()) <= 100


def test_nothing(nothing):
    assert rules.cascade(nothing).count() == 0


def test_no_python_in_the_plan(table):
    plan = table.select(rules.first_broken(Given(F.col("text")), rules.RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange RoundRobin" in plan


def test_rows_with_equal_ids(edge):
    assert rules.cascade(edge).count() == len(EDGE_TEXTS)
    assert row(1, None)[1] is None
