"""Repairs against an exhaustive search from the end, on random and on awkward conversations."""

import functools
import hashlib
import os
import random
import sys
import zlib

import pytest

from lintlake.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, digest string, place string, copies string, f string, s string"
EXTRA = ("x",) * 6
SF_DIR = "/root/testdata/sf0.01"
sys.setrecursionlimit(20_000)
WHITE = " \t\n\x0b\f\r"


def plain_best(rows):
    """(cost, audit) of rows (initial, must_go, truncated), by trying all from each place on."""
    onward = {"": "u", "s": "u", "u": "a", "a": "u"}
    allowed = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}

    @functools.cache
    def best(i, last, inserted):
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, ""))
        if inserted < 3:
            cost, rest = best(i, onward[last], inserted + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            cost, rest = best(i + 1, last, 0)
            ways.append((cost + 3, "D" + rest))
            if not must_go:
                cost, rest = best(i + 1, onward[last], 0)
                ways.append((cost + 2 + truncated, "R" + rest))
                if (last, initial) in allowed:
                    cost, rest = best(i + 1, initial, 0)
                    ways.append((cost + truncated, "K" + rest))
        return min(ways, default=(float("inf"), ""))

    return best(0, "", 0)


def plain(rows):
    """The result's values of rows (turn, role, text) of one conversation, in order."""
    rows = sorted(
        [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows],
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()),
    )
    seen, kinds, blank, duplicate, truncated = set(), [], 0, 0, 0
    for _, role, text in rows:
        fault = ""
        if not text.strip(WHITE):
            fault, blank = "blank", blank + 1
        elif (role, text) in seen:
            fault, duplicate = "duplicate", duplicate + 1
        elif text.rstrip(WHITE)[-1] not in ".!?":
            fault, truncated = "truncated", truncated + 1
        seen.add((role, text))
        kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))  # noqa: B905
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = plain_best(tuple(kinds))
    out, at = [], iter(rows)
    for edit in audit:
        last = out[-1][0][:1] if out else ""
        onward = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append((onward, ""))
            continue
        _, role, text = next(at)
        if edit != "D":
            out.append((role if edit == "K" else onward, text))
    sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (gaps, blank, duplicate, truncated, illegal, cost, audit, sha), out


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        text, chance = name(text), zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if chance == 1:
            text = ""
        if chance == 2:
            text = "".join(c for c in text if c not in ".!?")
        out += [(conv, turn, "user" if chance == 4 else name(role), text)] * (0 if chance == 0 else 2 if chance == 3 else 1)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(5)


def check(spark, rows, damage=False):
    df = table(spark, rows)
    after = repair.damaged(df) if damage else df
    want_rows = plain_damage(rows) if damage else rows
    want = {c: plain([r[1:] for r in want_rows if r[0] == c])[0] for c in {r[0] for r in rows}}
    got = {r[0]: tuple(r)[2:] for r in repair.audit(after, df).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(6))
def test_search(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        weights = rng.choice([(1, 5, 5, 1), (5, 1, 1, 1), (1, 1, 1, 6), (0, 1, 8, 0), (1, 1, 1, 1)])
        rows = tuple(
            (rng.choices("suax", weights)[0], rng.random() < rng.choice([0, 0.2, 0.8]), rng.random() < 0.3)
            for _ in range(rng.randint(0, 14))
        )
        search = repair.Search()
        for initial, gone, cut in rows:
            search.row(initial if initial in "sua" else "", gone, cut and not gone)
            held = {s: search.unresolved(s) for s in search.cost}
            assert sorted(held, key=held.get) == sorted(held, key=search.rank.get)
            assert len(held) < 2 or len({h[:1] for h in held.values()}) > 1 or not all(held.values())
        assert search.end() == plain_best(tuple((i, g, c and not g) for i, g, c in rows))


def test_emits_early_and_frees():
    search = repair.Search()
    for i in range(20_000):
        search.row("ua"[i % 2], i % 17 == 16, i % 5 == 0)
        nodes, stack = 0, [search.root]
        while stack:
            stack.extend(stack.pop().below)
            nodes += 1
        assert nodes <= 7 and len(search.final) >= i - 60
    assert len(search.end()[1]) >= 20_000


def test_never_agreeing():
    """Rows of an unknown role: which is deleted depends on how many follow, so nothing is final."""
    search = repair.Search()
    for _ in range(30_001):
        search.row("", False, False)
    cost, audit = search.end()
    assert (cost, audit) == (60_003, "D" + "R" * 30_000)


@pytest.mark.parametrize("damage", [False, True])
def test_random_tables(spark, damage):
    rng = random.Random(3)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 11)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn + (turn > 4), role, rng.choice(["Yes.", "No!", "Why", "Well?  \n", "", " \t", "é日.", f"{conv} {turn}."])))
    check(spark, rows, damage)


def test_edge_cases(spark):
    rows = [
        (None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, None, "system", "Be."),
        (1, None, None, None), (2, None, "user", "A."), (2, None, "user", "A."), (2, 7, "assistant", "A."),
        (3, 5, "user", "x" * 100_000 + "."), (3, 9, "assistant", "y" * 100_000), (3, -4, "system", "z."),
        (4, 1, "", "t."), (4, 2, "USER", "t."), (4, 3, "ut", "t."), (4, 4, "art", "t."),
        (5, 1, "user", ""), (5, 2, "user", "\n"), (6, 1, "assistant", "a."), (6, 1, "user", "b."), (6, 1, "user", "a."),
        (7, 1, "system", "only."), (8, 2**62, "user", "far."), (8, 2**62 + 3, "assistant", "far."),
    ] + [(9, 1, "user", "same.")] * 30 + [(9, 2, "user", "same.")] * 3
    check(spark, rows)
    check(spark, rows, damage=True)


def test_dropped_conversations_are_listed(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(c, 0, "user", "Hi.") for c in range(400)]
    df = table(spark, rows)
    found = {r.conv_id: r for r in repair.audit(repair.damaged(df), df).collect()}
    assert len(found) == 400 and gone
    empty = hashlib.sha256(b"").hexdigest()
    assert all(tuple(found[c])[1:] == (0, 0, 0, 0, 0, 0, 0, "", empty) for c in gone)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Ho."), (1, 2, "tool", "Done."), (1, 3, "user", ""), (2, 0, "user", "Well?")]
    df = table(spark, rows)
    out = repair.repaired(df, repair.edits(df)).orderBy("conv_id", "place").collect()
    want = {c: plain([r[1:] for r in rows if r[0] == c])[1] for c in (1, 2)}
    assert {c: [(r.role, r.text) for r in out if r.conv_id == c] for c in (1, 2)} == want
    assert [r.edit for r in out if r.conv_id == 2] == ["K", "I"]


def test_long_conversation_among_short_ones(spark):
    rows = [(0, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]
    rows += [(c, t, "user", "Same.") for c in range(1, 40) for t in range(3)]
    check(spark, rows, damage=True)


def test_nothing(spark):
    df = table(spark, [])
    assert repair.audit(repair.damaged(df), df).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="shared tables not present")
def test_registered_query(spark):
    from lintlake.llm.queries import all_queries

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = plain_damage(rows)
    want = {c: plain([r[1:] for r in after if r[0] == c])[0] for c in {r[0] for r in rows}}
    out = all_queries()["op13_conversations"](spark, SF_DIR)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == want
