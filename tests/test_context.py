import random

from pyspark.sql import functions as F

from lintlake.operators import calls, context, edges


def _procedural_blocks(lines, start, end):
    """Line-by-line restatement of the nesting rule, for comparison only."""
    n = len(lines)
    ind = [None if not t.strip() else len(t) - len(t.lstrip(" ")) for t in lines]
    a = max(0, min(n - 1, start - 1))
    z = max(a, max(0, min(n - 1, end - 1)))
    core = [ind[i] for i in range(a, z + 1) if ind[i] is not None]
    current = min(core) if core else 0
    out = []
    while current is not None:
        above = [i for i in range(a) if ind[i] is not None and ind[i] < current]
        below = [i for i in range(z + 1, n) if ind[i] is not None and ind[i] < current]
        top = above[-1] + 1 if above else 0
        bottom = below[0] - 1 if below else n - 1
        out.append((current, top + 1, bottom + 1, "".join(lines[top:bottom + 1])))
        outer = ([ind[above[-1]]] if above else []) + ([ind[below[0]]] if below else [])
        a, z, current = top, bottom, min(outer) if outer else None
    return out


def test_blocks_match_a_procedural_restatement(spark):
    rng = random.Random(3)
    files, bugs, expected = [], [], {}
    for k in range(120):
        lines = [
            "\n" if rng.random() < 0.15 else " " * rng.choice([0, 2, 4, 8, 9, 12]) + "x;\n"
            for _ in range(rng.randint(1, 25))
        ]
        if rng.random() < 0.3:
            lines[-1] = lines[-1].rstrip("\n") or "y"
        start = rng.randint(0, 28)
        end = start + rng.randint(-1, 3)
        files.append((f"f{k}.cpp", "".join(lines)))
        bugs.append((f"B{k}", f"f{k}.cpp", start, end))
        expected[f"B{k}"] = _procedural_blocks(lines, start, end)
    out = context.bug_blocks(
        spark.createDataFrame(bugs, "issue_key string, file_path string, start_line int, end_line int"),
        spark.createDataFrame(files, "file_path string, text string"),
    ).collect()
    assert len(out) == 120
    for row in out:
        got = [(b["indent"], b["start"], b["end"], b["code"]) for b in row["blocks"]]
        assert got == expected[row["issue_key"]], row["issue_key"]
        assert [b["level"] for b in row["blocks"]] == list(range(len(got)))


def test_block_errors(spark):
    bugs = spark.createDataFrame(
        [("A", "gone.cpp", 1), ("B", "e.cpp", 1), ("C", "f.cpp", None)],
        "issue_key string, file_path string, start_line int").withColumn("end_line", F.col("start_line"))
    sources = spark.createDataFrame([("e.cpp", ""), ("f.cpp", "x\n")], "file_path string, text string")
    got = {r["issue_key"]: r for r in context.bug_blocks(bugs, sources).collect()}
    assert got["A"]["error"] == "Source file not found: gone.cpp"
    assert got["B"]["error"] is None and got["B"]["blocks"] == []
    assert got["C"]["error"] == "missing_start_line"


def test_snippet_edges(spark):
    issues = spark.createDataFrame(
        [("a", None, 1, 1), ("b", "f", None, None), ("c", "gone", 1, 1), ("d", "f", 0, 0), ("e", "f", 3, 1),
         ("g", "f", 90, 95), ("h", "empty", 1, 2), ("i", "f", 2, None)],
        "issue_key string, file_path string, start_line int, end_line int")
    sources = spark.createDataFrame([("f", "1\r\n\t2\n3\n4"), ("empty", "")], "file_path string, text string")
    got = {r["issue_key"]: (r["code_snippet"], r["error"])
           for r in context.snippets(issues, sources, normalize_tabs=True).collect()}
    assert got == {
        "a": (None, "missing_path"), "b": (None, "missing_start_line"), "c": (None, "file_read_error"),
        "d": ("1\n", None), "e": ("3\n", None), "g": ("4", None), "h": ("", None), "i": ("    2\n", None)}
    cut = context.snippets(issues, sources, context_lines=5, max_chars=3).where("issue_key = 'i'").first()
    assert cut["code_snippet"] == "1\n\t\n/* ...TRUNCATED... */\n"


SOURCES = [
    ("core/ctl/control.cpp", '#include "control.h"\n// note\n\nint Controller::Run(int a)\n{\n    Step(a);\n    return a;\n}\n'),
    ("core/ctl/other.cpp", '#include "x.h"\nvoid go()\n{\n    c.Run(1);\n    Controller::Run(2);\n    Other::Run(3);\n    xRun(4);\n}\n'),
    ("core/ui/view.cpp", '#include "core/control.hpp"\nvoid v()\n{\n  Run ( 5 );\n}\nint Other::Run(int b)\n{\n}\n'),
    ("core/tests/t.cpp", "void t()\n{\n  Run(6);\n}\n"),
    ("far/away.cpp", "void w()\n{\n  Run(7);\n}\n"),
    ("far/away.h", "void w() {\n  Run(8);\n"),
]


def _anchored(spark):
    bugs = spark.createDataFrame([("B1", "core/ctl/control.cpp", 7, 7), ("B2", "core/ctl/control.cpp", 1, 1)],
                                 "issue_key string, file_path string, start_line int, end_line int")
    sources = spark.createDataFrame(SOURCES, "file_path string, text string")
    blocked = context.bug_blocks(bugs, sources, keep_file=True)
    return context.enclosing_function(blocked, context_window=1), sources


def test_enclosing_function(spark):
    rows = {r["issue_key"]: r for r in _anchored(spark)[0].collect()}
    anchor = rows["B1"]["anchor"]
    assert (anchor["name"], anchor["class_name"], anchor["def_line"]) == ("Run", "Controller", 4)
    assert anchor["signature"] == "int Controller::Run(int a)"
    assert anchor["bug_context"]["code"] == "    Step(a);\n    return a;\n}"
    assert anchor["def_includes"] == ['#include "control.h"', "// note", ""]
    assert rows["B2"]["anchor"] is None and rows["B2"]["error"].startswith("No function definition")


def test_call_sites_nested(spark):
    bugs, sources = _anchored(spark)
    row = calls.attach_call_sites(bugs, sources, 20, 1).where("issue_key = 'B1'").first()
    sites = row["anchors"][0]["call_sites"]
    assert [(s["file"], s["line"], s["score"]) for s in sites] == [
        ("core/ui/view.cpp", 4, 5), ("core/ctl/other.cpp", 4, 4), ("core/ctl/other.cpp", 5, 4),
        ("far/away.cpp", 3, 1)]
    assert sites[0]["context"] == "{\n  Run ( 5 );\n}" and sites[0]["includes_bug_header"]
    none = calls.attach_call_sites(bugs, sources).where("issue_key = 'B2'").first()
    assert none["anchors"] == []


def test_top_call_sites_equal_cut_of_all(spark):
    """The bucketed top N must be the head of the complete ranking, for every function."""
    rng = random.Random(11)
    folders = ["a/x", "a/y", "b/x", "c", ""]
    files = []
    for k in range(60):
        path = "/".join(p for p in (rng.choice(folders), f"d{k % 30}_{k}.cpp") if p)
        lines = [f'#include "d{rng.randint(0, 29)}_{rng.randint(0, 59)}.h"' for _ in range(2)]
        for _ in range(30):
            f = rng.choice(["hot", "hot", "hot", "~hot", "f1", "operator+"])
            lines.append(rng.choice(["  {f}(1);", "  K1::{f}(2);", "  x = K2::{f}( K1::{f}(3));", "  y.{f} (4);",
                                     "int K1::{f}(int q)"]).replace("{f}", f))
        files.append((path, "\n".join(lines) + "\n"))
    anchors = [(rng.choice(["hot", "f1", "~hot", "operator+"]), rng.choice(["K1", "K2", None]), files[i % 60][0])
               for i in range(80)]
    sources = spark.createDataFrame(files, "file_path string, text string")
    wanted = spark.createDataFrame(anchors, "name string, class_name string, def_file string")
    cols = [*calls.PROFILE, "file", "line", "score", "rank", "includes_bug_header", "same_dir"]
    top = calls.rank_call_sites(wanted, sources, 7, with_context=False).select(*cols).collect()
    whole = calls.rank_call_sites(wanted, sources, None, with_context=False).where("rank <= 7").select(*cols).collect()
    assert len(top) > 300
    assert sorted(map(tuple, top)) == sorted(map(tuple, whole))


def test_edges(spark):
    sources = spark.createDataFrame(
        [("a.cpp", '#include <x.h>\nclass A : public B<int>, private virtual N::C {\n};\nint f(int q)\n{\n  g(1); h (g(2));\n}\n')],
        "file_path string, text string")
    got = sorted(tuple(r) for r in edges.all_edges(sources).collect())
    assert got == sorted([
        ("a.cpp", "x.h", "include"), ("A", "B<int>", "inherits"), ("A", "N::C", "inherits"),
        ("f", "g", "call"), ("f", "h", "call"), ("f", "g", "call")])
    counts = {r["type"]: r["n"] for r in edges.edge_counts(sources).collect()}
    assert counts == {"include": 1, "inherits": 2, "call": 3, "symbol": 2}
    heads = [tuple(r) for r in edges.symbols(sources).orderBy("line").collect()]
    assert heads == [("a.cpp", "class", "A", 2, 3), ("a.cpp", "function", "f", 4, 7)]


def test_index_finds_the_nearest_less_indented_line(spark):
    rng = random.Random(8)
    cases = [[], [None], [None, None], [0], [4, None, 2]]
    cases += [[rng.choice([None, 0, 2, 2, 4, 8, 9]) for _ in range(rng.randint(1, 60))] for _ in range(40)]
    cases += [[rng.choice([None, 4, 5, 6, 7, 7, 7, 7, 7]) for _ in range(n)] for n in (15, 16, 17, 255, 256, 257, 700, 5000)]
    cases += [[3] + [9] * 4500 + [1]]
    rows, want = [], {}
    for i, ind in enumerate(cases):
        for q in range(12):
            at, bound = rng.randrange(max(len(ind), 1)), rng.choice([0, 1, 3, 5, 6, 9, 10])
            rows.append((i, q, ind, at, bound))
            low = [j for j, x in enumerate(ind) if x is not None and x < bound]
            want[i, q] = (max([j for j in low if j < at], default=None), min([j for j in low if j > at], default=None))
    df = spark.createDataFrame(rows, "i int, q int, ind array<int>, at int, bound int").repartition(8)
    index = df.withColumn("x", context.indent_index(F.col("ind")))
    near = [context.nearest_lower(F.col("x"), F.col("at"), F.col("bound"), up).alias(n) for n, up in (("up", True), ("down", False))]
    got = {(r.i, r.q): (r.up, r.down) for r in index.select("i", "q", *near).collect()}
    assert got == want
    depths = {r.i: r.n for r in index.select("i", F.size("x").alias("n")).distinct().collect()}
    assert depths[3] == 1 and depths[len(cases) - 1] == 4
