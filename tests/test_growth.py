"""What keeps disk and time in step with the input: texts that are read late, once, or not at all."""

from pyspark.sql import functions as F

from lintlake.functions import code
from lintlake.functions import text as tx
from lintlake.operators import call_index, calls, context
from lintlake.plans import chains

FILES = [
    ("a/x/f.cpp", '#include "sub/f.h"\nvoid K::run(int a)\n{\n    go(1);\n}\n'),
    ("a/y/g.cpp", '#include "f.h" // p/q.h\nint main(int n)\n{\n    run(2);\n    run(3);\n}'),
    ("b/h.cpp", "void other(int q)\n{\n    K::run(4); run(5);\n}\n"),
]
BUGS = "issue_key string, file_path string, start_line int, end_line int"


def _sources(spark, files=FILES):
    return spark.createDataFrame(files, "file_path string, text string")


def _blocked(spark, sources):
    bugs = spark.createDataFrame([("B1", "a/x/f.cpp", 4, 4), ("B2", "a/y/g.cpp", 4, None), ("B3", "gone", 1, 1), ("B4", "b/h.cpp", None, None)], BUGS)
    return context.bug_blocks(bugs, sources, keep_file=True)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_anchors_are_those_of_the_bugs_and_build_no_blocks(spark):
    blocked = _blocked(spark, _sources(spark))
    want = context.enclosing_function(blocked).where("anchor is not null").select("anchor.*")
    got = context.anchors(blocked)
    assert got.schema.names == want.schema.names
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2
    names = _plan(calls.profiles(got))
    assert "_headers" in names and "array_join" not in names and "array_min" not in names


def test_ranked_sites_travel_without_code(spark):
    sources = _sources(spark)
    wanted = calls.profiles(context.anchors(_blocked(spark, sources))).checkpoint()
    thin = calls._ranked_sites(wanted, sources, 20, True)
    assert "code" not in thin.columns
    full = calls.rank_for_profiles(wanted, sources, 20, 6, with_context=False)
    columns = [*calls.PROFILE, "file", "line", "code", "score", "rank"]
    attached = calls.rank_for_profiles(wanted, sources, 20, 6)
    assert sorted(map(str, attached.select(columns).collect())) == sorted(map(str, full.select(columns).collect()))
    assert {r.code for r in attached.collect()} >= {"run(2);", "K::run(4); run(5);"}


def test_a_path_with_several_texts_keeps_the_code_of_the_call(spark):
    sources = _sources(spark, [*FILES, ("a/y/g.cpp", "one line")])
    wanted = calls.profiles(context.anchors(_blocked(spark, _sources(spark)))).checkpoint()
    got = calls.rank_for_profiles(wanted, sources, 20, 6).where("name = 'run' and file = 'a/y/g.cpp' and line = 5").collect()
    assert [r.code for r in got] == ["run(3);"] * 2


def test_stems_before_every_header_suffix(spark):
    lines = ['#include "a/bc.h"', "x.h y.h/z.hpp", ".h", "no", "q.h.h", "日本/é.h"]
    got = spark.createDataFrame([(lines,)], "l array<string>").select(code.included_stems(F.col("l"), 4).alias("s")).first().s
    want = []
    for line in lines:
        for at in range(len(line)):
            if line[at : at + 2] == ".h":
                run = line[:at].rsplit("/", 1)[-1]
                want += [run[-n:] for n in range(1, min(len(run), 4) + 1)]
    assert sorted(got) == sorted(set(want))
    plan = _plan(spark.createDataFrame([(lines,)], "l array<string>").select(code.included_stems(F.col("l"), 4)))
    assert "length(lambda line" not in plan.split("substring_index")[0]


def test_bare_split(spark):
    texts = ["", "\n", "a", "a\n", "a\r\nb\rc\n\n", "a\x0bb\n", "x\x85", None, "\n\nq"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for got, want in df.select(tx.bare_split(F.col("t")), tx.bare_lines(tx.split_lines(F.col("t")))).collect():
        assert got == want


def test_a_search_of_the_index_reads_no_context(spark, tmp_path):
    sources, folder = _sources(spark), str(tmp_path / "index")
    call_index.update(sources, folder)
    wanted = calls.profiles(context.anchors(_blocked(spark, sources))).checkpoint()
    found = call_index.rank_call_sites(wanted, folder)
    columns = ["name", "file", "line", "code", "rank", "context", "includes"]
    want = calls.rank_for_profiles(wanted, sources, 20, 6).select(columns).collect()
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, want))
    read = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema" in x and "code:string" in x]
    assert read and not any("context:string" in x for x in read)
    # Two texts of one path: as a search over the sources.
    both = _sources(spark, [*FILES, FILES[1]])
    call_index.update(both, folder2 := str(tmp_path / "twice"))
    twice = call_index.rank_call_sites(wanted, folder2).select(columns)
    assert sorted(map(str, twice.collect())) == sorted(map(str, calls.rank_for_profiles(wanted, both, 20, 6).select(columns).collect()))


def test_issue_documents_are_parsed_once(spark):
    from lintlake.schemas import GATE_DOCUMENT, ISSUES_DOCUMENT, MEASURES_DOCUMENT

    text = '{"issues":[{"key":"k","component":"c","type":"BUG"}],"components":[{"key":"c","path":"p"}]}'
    parsed = [
        spark.createDataFrame([("p1", t)], "doc string, t string").select("doc", F.from_json("t", s).alias("d")).select("doc", "d.*")
        for t, s in (("{}", MEASURES_DOCUMENT), ("{}", GATE_DOCUMENT), (text, ISSUES_DOCUMENT))
    ]
    parsed = [p.drop("project").withColumnRenamed("doc", "project") for p in parsed]
    severe = chains.bi_tables(*parsed)["severe_issues"]
    assert [(r.issue_key, r.component_path) for r in severe.collect()] == [("k", "p")]
    assert "from_json" not in _plan(severe)
