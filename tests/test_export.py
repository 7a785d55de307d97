import json
import os

from pyspark.sql import functions as F

from lintlake.operators import advice as adv
from lintlake.operators import flatten, prompts
from lintlake.operators.context import bug_blocks, enclosing_function
from lintlake.operators.calls import attach_call_sites
from lintlake.plans import chains
from lintlake.sources import files, sinks
from lintlake.streaming import landing


def _read_all(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                out.append(f.read())
    return "".join(out)


def test_flatten_and_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [("k", ("m", ["a"]), 6729313891.0, True, None)],
        "issue_key string, copilot_advice struct<model:string,tags:array<string>>, priority_score double,"
        " flag boolean, gone string")
    table = flatten.export_table(df)
    assert table.columns == ["issue_key", "priority_score", "copilot_advice.code_update",
                             "copilot_advice.explanation", "copilot_advice.model", "copilot_advice.raw",
                             "copilot_advice.tags", "flag", "gone"]
    assert list(table.first()) == ["k", "6729313891.0", "", "", "m", "", '["a"]', "True", ""]
    shallow = flatten.export_table(df, max_level=0, text_columns=())
    assert shallow.first()["copilot_advice"] == '{"model":"m","tags":["a"]}'
    sinks.write_csv(table, str(tmp_path / "csv"), single_file=True)
    text = _read_all(tmp_path / "csv")
    assert text.startswith("﻿issue_key,") and '"[""a""]"' in text
    back = files.read_csv(spark, str(tmp_path / "csv"))
    assert back.first()[0] == "k"


def test_jsonl_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    sinks.write_jsonl(df, str(tmp_path / "o"))
    sinks.write_jsonl(df.limit(1), str(tmp_path / "o"), mode="append")
    rows = [json.loads(t) for t in _read_all(tmp_path / "o").splitlines()]
    assert len(rows) == 3 and {"a": 1, "b": None} in rows
    sinks.write_summary_json(df, str(tmp_path / "s"), "results")
    assert len(json.loads(_read_all(tmp_path / "s"))["results"]) == 2
    written = sinks.write_tables({"full": df, "empty": df.limit(0)}, str(tmp_path / "t"))
    assert list(written) == ["full"]
    sinks.archive(df, str(tmp_path / "arch"), "p", "issue", "20240101")
    assert spark.read.json(str(tmp_path / "arch")).where("level = 'issue'").count() == 2
    sinks.write_project_texts(df.selectExpr("'p' AS project", "b AS text").where("b is not null"), str(tmp_path / "pt"))
    assert _read_all(tmp_path / "pt" / "project=p") == "x\n"


def test_project_folders(spark, tmp_path):
    measures = {"measures": [{"metric": "coverage", "value": "81"}]}
    gate = {"projectStatus": {"status": "OK", "conditions": [{"metricKey": "bugs", "actualValue": "1", "status": "OK"}]}}
    severe = {"issues": [{"key": "I", "component": "c", "severity": "BLOCKER", "type": "BUG"}],
              "components": [{"key": "c", "name": "n"}]}
    for project, docs in {"p1": ("measures", "quality_gate", "severe_issues"), "p2": ("measures", "quality_gate", "issues")}.items():
        (tmp_path / project).mkdir()
        for name in docs:
            doc = {"measures": measures, "quality_gate": gate}.get(name, severe)
            (tmp_path / project / f"{name}.json").write_text(json.dumps(doc, indent=1))
    documents = files.read_project_documents(spark, str(tmp_path))
    assert [r["project"] for r in documents[0].collect()] == ["p1"]
    tables = chains.bi_tables(*documents)
    assert tables["severe_issues"].first()["component_name"] == "n"
    only = files.read_project_documents(spark, str(tmp_path), "p2")
    assert [r["project"] for r in only[2].collect()] == ["p2"]
    audits = chains.kpi_audits(*documents)
    assert {r["metric_key"]: r["kpi_status"] for r in audits["gate_audit"].collect()} == {"bugs": "FAIL"}
    out = chains.project_report(str(tmp_path), spark, str(tmp_path / "out"))
    assert set(out) == {"measures", "quality_gate", "severe_issues", "measures_audit", "issues_audit",
                        "issue_examples", "gate_audit", "measures_audit_text"}
    assert "- coverage: PASS (Actual 81.00" in _read_all(tmp_path / "out" / "measures_audit_text" / "project=p1")


def test_project_prompts(spark):
    df = spark.createDataFrame([("p", '{"a": [1, {"b": null}]}'), ("q", "{broken")], "project string, text string")
    got = [r["user_prompt"] for r in prompts.project_prompts(df, "{project}: {{{json}}}").collect()]
    assert got == ['p: {{"a":[1,{"b":null}]}}', "q: {{broken}"]


def test_source_tree(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.CPP").write_text("1\n2")
    (tmp_path / "a" / "n.txt").write_text("t")
    df = files.read_source_tree(spark, str(tmp_path), source_suffixes_only=True)
    assert [tuple(r) for r in df.collect()] == [("a/x.CPP", "1\n2")]


def _deep_bugs(spark, n_calls, body=""):
    calls = "".join(f"  x = 1;\n  run({i}); // {body}\n  y = {i};\n" for i in range(n_calls))
    # The trailing comment would read as a header without the final semicolon.
    calls = calls.replace(f"// {body}\n", f"/* {body} */;\n")
    sources = spark.createDataFrame(
        [("a/f.cpp", "int run(int q)\n{\n  if (q)\n    q++;\n}\n"), ("a/g.cpp", "void go()\n{\n" + calls + "}\n")],
        "file_path string, text string")
    bugs = spark.createDataFrame(
        [("B", "a/f.cpp", 4, 4, "MAJOR", "BUG", "r", "has {context_block}", "q++;")],
        "issue_key string, file_path string, start_line int, end_line int, severity string, type string,"
        " rule string, message string, code_snippet string")
    return attach_call_sites(enclosing_function(bug_blocks(bugs, sources, keep_file=True)), sources)


TEMPLATE = "{issue_key} {message}\n{code_snippet}\n{context_block}\n{call_sites_section}"


def test_callsite_prompt_budget(spark):
    bugs = _deep_bugs(spark, 25)
    limits = {}
    for budget in (24_000, 6_000, 2_500, 10):
        row = prompts.callsite_prompts(bugs, TEMPLATE, max_chars=budget).first()
        limits[budget] = row["callsite_limit"]
        assert budget == 10 or len(row["user_prompt"]) <= budget
        assert row["user_prompt"].startswith("B has {context_block}\nq++;\n// Context block (level 0, lines 4–4)\n    q++;\n")
    assert limits[24_000] == 20 and limits[10] == 3 and 3 <= limits[2_500] < limits[6_000] < 20
    full = prompts.callsite_prompts(bugs, TEMPLATE).first()["user_prompt"]
    assert "// CALLSITE #20\n// File: a/g.cpp\n" in full and "// same_dir: True" in full


def test_own_call_sites_come_first(spark):
    site = "struct<file:string,line:int,code:string>"
    rows = [
        ("own", [("own.cpp", 1, "f(1);")], None, [("f", "int f()", [("a.cpp", 9, "f(9);")])]),
        ("second", [], [("two.cpp", 2, "f(2);")], [("f", "int f()", [("a.cpp", 9, "f(9);")])]),
        ("anchor", None, [], [("f", "", []), ("f", "", [("a.cpp", 9, "f(9);")])]),
        ("none", [], None, []),
    ]
    bugs = spark.createDataFrame(
        rows, f"issue_key string, call_sites array<{site}>, callsite_blocks array<{site}>, "
        f"anchors array<struct<name:string,signature:string,call_sites:array<{site}>>>"
    ).selectExpr("*", "'MAJOR' AS severity", "'BUG' AS type", "'r' AS rule", "'m' AS message", "'f' AS file_path", "1 AS start_line",
                 "1 AS end_line", "'c' AS code_snippet", "CAST(NULL AS array<struct<level:int,indent:int,start:int,end:int,code:string>>) AS blocks")
    got = {r["issue_key"]: r["user_prompt"] for r in prompts.callsite_prompts(bugs, "{call_sites_section}").collect()}
    assert "// File: own.cpp" in got["own"] and "signature" not in got["own"] and "a.cpp" not in got["own"]
    assert "// File: two.cpp" in got["second"] and "signature" not in got["second"]
    assert "// File: a.cpp" in got["anchor"] and "// Suspected callee signature: f" in got["anchor"]
    assert got["none"] == "// No call sites were discovered for this bug.\n"
    without = prompts.callsite_prompts(bugs.drop("anchors"), "{call_sites_section}")
    assert {r["issue_key"]: r["user_prompt"] for r in without.collect()}["anchor"] == got["none"]


def test_unknown_hole_marks_rows(spark):
    df = spark.createDataFrame([("A", "BUG")], "issue_key string, type string")
    out = chains.build_prompts(df, "{no_such_hole}", "issue").first()
    assert out["user_prompt"] is None and "no_such_hole" in out["prompt_error"]


def test_advice_run(spark):
    rows = [(f"I{i}", s, f"2024-01-0{i}T00:00:00+0000") for i, s in enumerate(["MAJOR", "BLOCKER", "INFO", "BLOCKER"], 1)]
    df = spark.createDataFrame(rows, "issue_key string, severity string, creation_date string").selectExpr(
        "*", "CAST(NULL AS string) AS update_date", "'BUG' AS type", "'r' AS rule", "'m' AS message",
        "'f.cpp' AS file_path", "1 AS start_line", "1 AS end_line", "'c' AS code_snippet")
    replies = spark.createDataFrame([("I4", "m1", "why ```fix```"), ("I1", "m1", "x")], "issue_key string, model string, raw string")
    written, counters = chains.advice_run(df, "{issue_key}", replies, "issue", "m0", stop_after=3, since="2024-01-01")
    got = {r["issue_key"]: r for r in written.collect()}
    assert set(got) == {"I4", "I2", "I1"}
    assert got["I4"]["copilot_advice"]["code_update"] == "```fix```"
    assert got["I2"]["copilot_advice"]["error"] == adv.NO_REPLY
    assert tuple(counters.first()) == (4, 4, 3, 3, 1)


def test_changed_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None), ("c", "")], "k string, v string")
    published = df.where("k <> 'a'").withColumn("content_hash", sinks.row_hash(["k", "v"]))
    again = df.withColumn("v", F.when(F.col("k") == "c", F.lit(None)).otherwise(F.col("v")))
    assert [r["k"] for r in sinks.changed_rows(df, published, ["k"], ["k", "v"]).collect()] == ["a"]
    assert sorted(r["k"] for r in sinks.changed_rows(again, published, ["k"], ["k", "v"]).collect()) == ["a", "c"]


def test_stream_equals_batch(spark, tmp_path):
    page = {"issues": [{"key": "A", "component": "p:f.cpp", "start_line": 1}], "components": [{"key": "p:f.cpp", "path": "z.cpp"}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text(json.dumps(page) + "\n{bad\n\n")
    (tmp_path / "in" / "2.jsonl").write_text('{"key": "B", "path": "b.cpp"}\n')
    query = landing.append_records(landing.follow_records(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert sorted((r["issue_key"] or "", r["file_path"] or "", r["error"] or "") for r in rows) == [
        ("", "", "json_parse_error"), ("A", "z.cpp", ""), ("B", "b.cpp", "")]


def test_export_chain_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"issue_key":"A","n":{"k":1}}\nnot json\n')
    out = chains.export_csv(spark, str(tmp_path / "x.jsonl"), str(tmp_path / "c"), "issue_key string, n struct<k:int>")
    got = {r["issue_key"]: r.asDict() for r in out.collect()}
    assert got["A"]["n.k"] == "1" and got["A"]["_parse_error"] == ""
    assert got[""]["_raw_line"] == "not json" and got[""]["_line_no"] == "2"
