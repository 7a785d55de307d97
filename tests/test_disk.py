"""What a chain leaves on disk while it runs: texts that are shuffled once, hand-over tables, rounds."""

import time

from pyspark.sql import functions as F

from lintlake.operators import call_index, calls, context, staging

FILES = [
    ("m/a/one.cpp", "int run(int a)\n  {\n    go(1);\n    run(2);\n  }\n"),
    ("m/a/two.cpp", '#include "one.h"\nint go(int a)\n  {\n    run(3);\n    go(4);\n  }\n'),
    ("m/b/three.cpp", "int K::run(int a)\n  {\n    run(5);\n    x.run(6);\n  }\n"),
]
BUGS = [(f"B{i % 7}", FILES[i % 3][0], 3 + i % 2) for i in range(20)] + [("B9", "gone.cpp", 1), ("B9", None, 1), (None, FILES[0][0], None)]


def _bugs(spark):
    sources = spark.createDataFrame(FILES, "file_path string, text string")
    bugs = spark.createDataFrame(BUGS, "issue_key string, file_path string, start_line int").withColumn("end_line", F.lit(None).cast("int"))
    return context.enclosing_function(context.bug_blocks(bugs, sources, keep_file=True)), sources


def test_rounds_give_what_one_round_gives(spark, monkeypatch):
    bugs, sources = _bugs(spark)
    whole = calls.attach_call_sites(bugs, sources, 3, 1)
    shown = lambda deep: deep.select("issue_key", "file_path", "error", F.to_json("anchors").alias("anchors"))
    want = sorted(map(str, shown(whole).collect()))
    assert len(want) == len(BUGS) and sum("call_sites\":[{" in x for x in want) == 20
    monkeypatch.setattr(calls, "ROUND_BYTES", 1)
    got = calls.attach_call_sites(bugs, sources, 3, 1, then=shown)
    assert sorted(map(str, got.collect())) == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_text_goes_once_to_the_functions_that_show_it(spark):
    rows = [("run", c, f"m/{d}", "", "m/a/one.cpp", 4, 1 + i) for i, (c, d) in enumerate((c, d) for c in "AB" for d in "xyz")]
    sites = spark.createDataFrame(
        rows, "_name string, _class_name string, _def_dir string, _stem string, file string, line int, rank int"
    ).select("*", F.lit(0).alias("_slice"), F.lit(0).alias("_seat"))
    texts = calls._site_texts(sites, spark.createDataFrame(FILES, "file_path string, text string"), 1).collect()
    assert [(t["_site"]["code"], len(t["_readers"])) for t in texts] == [("run(2);", 6)]


def test_a_bug_meets_its_file_in_one_shuffle_of_the_text(spark):
    sources = spark.createDataFrame(FILES, "file_path string, text string")
    bugs = spark.createDataFrame(BUGS, "issue_key string, file_path string, start_line int")
    features = lambda needed: needed.select("file_path", "_slice", "text")
    joined = context.with_needed_file(bugs, sources, features)
    assert sorted(map(str, joined.collect())) == sorted(map(str, context.with_file(bugs, sources).collect()))
    shuffled = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = context.with_needed_file(bugs, sources, features)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line, below in zip(plan.split("\n"), plan.split("\n")[1:]):
        if "Exchange hashpartitioning" in line:
            shuffled.append("text#" in below)
    assert sum(shuffled) == 1, plan


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles()) if f.getName().startswith("shuffle_")}


def test_shuffles_behind_a_hand_over_are_gone(spark):
    counts = lambda: spark.range(1000).groupBy(F.col("id") % 7).count()
    before = _shuffle_files(spark)
    assert staging.hand_over(counts(), "counts").where("count > 0").take(9)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(staging.TIDY, "false") == "false"


def test_an_index_keeps_no_lines_around_calls(spark, tmp_path):
    rows = [("a/x.cpp", "\n".join(f"f{i}(1);" for i in range(30))), ("a/y.cpp", "go(1);")]
    call_index.update(spark.createDataFrame(rows, "file_path string, text string"), str(tmp_path))
    filed = spark.read.parquet(f"{tmp_path}/calls/generation=1").collect()
    assert len(filed) == 31 and [r.context for r in filed if r.context is not None] == ["go(1);"]
    assert {(r.context_start, r.context_end) for r in filed if r.name == "f9"} == {(4, 16)}


def test_an_index_tells_texts_of_one_path_apart(spark, tmp_path):
    rows = [("a/x.cpp", "go(1);\n  a;\n  b;"), ("a/x.cpp", "  c;\n  d;\ngo(2);"), ("a/y.cpp", "go(3);\n  e;"), ("a/y.cpp", "go(3);\n  e;")]
    call_index.update(spark.createDataFrame(rows, "file_path string, text string"), str(tmp_path), around=1)
    wanted = spark.createDataFrame([("go", "", "", "")], "name string, class_name string, def_dir string, stem string")
    got = sorted((r.file, r.line, r.code, r.context) for r in call_index.rank_call_sites(wanted, str(tmp_path)).collect())
    assert got == [
        ("a/x.cpp", 1, "go(1);", "go(1);\n  a;"), ("a/x.cpp", 3, "go(2);", "  d;\ngo(2);"),
        ("a/y.cpp", 1, "go(3);", "go(3);\n  e;"), ("a/y.cpp", 1, "go(3);", "go(3);\n  e;"),
    ]
