import json

from pyspark.sql import functions as F

from lintlake.operators import components, issues, kpi
from lintlake.operators.skew import spread_join
from lintlake.sources import jsonl

PAGE = {
    "issues": [
        {"key": "I1", "component": "p:a.cpp", "textRange": {"startLine": 3}, "rule": "r", "updateDate": "2024-01-01T00:00:00+0000"},
        {"key": "I2", "component": "p:src/b.cpp", "textRange": {"startLine": 0, "endLine": 9}, "start_line": 5},
    ],
    "components": [{"key": "p:a.cpp", "path": "old/a.cpp"}, {"key": "p:a.cpp", "path": "new/a.cpp"}, {"key": "p:b", "path": ""}],
    "paging": {"total": 2},
}
NEWER = {"issues": [{"key": "I1", "component": "p:a.cpp", "updateDate": "2024-02-01T00:00:00+0000"}]}
BARE = {"issue_key": "I3", "rule_key": "rk", "rule_message": "m", "path": "q.cpp", "start_line": "x"}
LINES = [json.dumps(PAGE), "", json.dumps(BARE), "{broken", "[1]", '{"id": 1}', json.dumps(NEWER)]


def _write(tmp_path, lines, name="in.jsonl"):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_ingest_and_dedup(spark, tmp_path):
    lines = jsonl.numbered_lines(spark, _write(tmp_path, LINES)).select("line_no", "value")
    records = issues.normalize(jsonl.landed_issues(lines))
    rows = {(r["line_no"], r["issue_key"]): r for r in records.collect()}
    assert rows[(1, "I1")]["file_path"] == "new/a.cpp"
    assert (rows[(1, "I1")]["start_line"], rows[(1, "I1")]["end_line"]) == (3, 3)
    assert rows[(1, "I2")]["file_path"] == "src/b.cpp"
    assert (rows[(1, "I2")]["start_line"], rows[(1, "I2")]["end_line"]) == (5, 9)
    assert rows[(3, "I3")]["error"] == "invalid_line_numbers" and rows[(3, "I3")]["rule"] == "rk"
    errors = {k[0]: (r["error"], r["_raw"]) for k, r in rows.items() if k[1] is None}
    assert errors == {4: ("json_parse_error", "{broken"), 5: ("unknown_jsonl_shape", "[1]"),
                      6: ("unknown_jsonl_shape", '{"id": 1}')}
    once = issues.dedup_issues(records, page=["line_no", "pos"])
    kept = {r["issue_key"]: r["line_no"] for r in once.where("issue_key is not null").collect()}
    assert kept == {"I1": 7, "I2": 1, "I3": 3}
    same = issues.dedup_issues(records, page=["line_no", "pos"], row_id=["line_no", "pos"])
    assert sorted(map(str, same.select(*once.columns).collect())) == sorted(map(str, once.collect()))
    again = issues.dedup_issues(once, page=["line_no", "pos"])
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_line_numbers_over_splits(spark, tmp_path):
    texts = [("" if i % 7 == 3 else f"row {i}") for i in range(1, 4001)]
    path = _write(tmp_path, texts)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = jsonl.numbered_lines(spark, path)
        got = {r["line_no"]: r["value"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {i + 1: t for i, t in enumerate(texts) if t}


def test_read_jsonl_variants(spark, tmp_path):
    path = _write(tmp_path, LINES)
    assert jsonl.read_jsonl(spark, path).count() == 5
    kept = jsonl.read_jsonl_keeping_errors(spark, path, "issue_key string").where("_parse_error").collect()
    assert [(r["_line_no"], r["_raw_line"]) for r in kept] == [(4, "{broken")]
    lines = jsonl.read_records(spark, path, "issue_key string", "jsonl")
    assert {r["_parse_error"] for r in lines.collect()} == {None, "json_parse_error", "not_dict"}
    array = tmp_path / "a.json"
    array.write_text('[\n{"issue_key": "A"},\n{"issue_key": "B"}\n]')
    assert sorted(r["issue_key"] for r in jsonl.read_records(spark, str(array), "issue_key string", "json").collect()) == ["A", "B"]
    (tmp_path / "o.json").write_text('{\n  "issue_key": "C",\n  "n": 1\n}')
    one = jsonl.read_records(spark, str(tmp_path / "o.json"), "issue_key string", "json").collect()
    assert [(r["issue_key"], r["_parse_error"]) for r in one] == [("C", None)]


def test_lines_with_trailing_text_are_malformed(spark):
    texts = ['{"key":"a"} x', '{"key":"a"},{"key":"b"}', '{"key":"a"}]', '{"key":"a","key":"b"}', '{"key":"a"', "{'key':1}",
             '{"issues":[{"key":"c"}]} ,']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [(r["issue_key"], r["error"]) for r in issues.normalize(jsonl.landed_issues(df)).collect()]
    bad = (None, "json_parse_error")
    assert got == [bad, bad, bad, ("b", None), bad, bad, bad]


def test_issue_shape_can_go_first(spark):
    df = spark.createDataFrame([('{"key":"own","issues":[{"key":"c"}]}',)], "value string")
    page = issues.normalize(jsonl.landed_issues(df)).collect()
    own = issues.normalize(jsonl.landed_issues(df, issue_first=True)).collect()
    assert [r["issue_key"] for r in page] == ["c"] and [r["issue_key"] for r in own] == ["own"]


def test_component_globs(spark):
    pattern = components.glob_pattern(components.DEFAULT_EXCLUDES)
    df = spark.createDataFrame([("a/obj/b",), ("obj/b",), ("x/.NETFramework,Version=v4/y",), ("a/objx/b",)], "p string")
    assert [r[0] for r in df.select(F.col("p").rlike(pattern)).collect()] == [True, False, True, False]


def test_filtered_component_does_not_claim_its_key(spark):
    rows = [(1, 0, "k", "a/obj/f", "f.c", "c"), (2, 0, "k", "a/f", "f.c", "c"), (2, 1, "k", "b/f", "f.c", "c")]
    df = spark.createDataFrame(rows, "page_no int, pos int, key string, path string, name string, language string")
    assert [tuple(r) for r in components.component_index(df).collect()] == [("k", "a/f", "f.c", "c", "a", ".c")]


def test_spread_join_slices_hot_keys(spark):
    facts = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k").withColumn(
        "k", F.when(F.col("id") % 4 > 0, F.col("k")))
    side = spark.range(40).selectExpr("concat('k', id) AS k", "id AS v").unionByName(
        spark.createDataFrame([("hot", 99)], "k string, v long"))
    for how in ("left", "inner", "left_semi"):
        plain = facts.join(side, "k", how)
        spread = spread_join(facts, side, ["k"], ["id"], how, parts=20)
        assert sorted(map(tuple, spread.select(*plain.columns).collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)


def test_period_object_and_null_safe_period(spark):
    from lintlake.schemas import GATE_DOCUMENT, MEASURES_DOCUMENT

    doc = '{"measures":[{"metric":"m","period":{"index":1,"value":"12,5"}},{"value":"3"}]}'
    df = spark.createDataFrame([("p", doc)], "project string, d string").select(
        "project", F.from_json("d", MEASURES_DOCUMENT).alias("d")).select("project", "d.*")
    assert [tuple(r) for r in kpi.measures_long(df).collect()] == [("p", "m", 12.5, None, 1)]
    assert kpi.measures_long(df, read_period_object=False).collect() == []
    gate = '{"projectStatus":{"status":"OK","period":{"mode":"days"},"conditions":[{"metricKey":"c","actualValue":"1,5"}]}}'
    df = spark.createDataFrame([("p", gate)], "project string, d string").select(
        "project", F.from_json("d", GATE_DOCUMENT).alias("d")).select("project", "d.*")
    row = kpi.quality_conditions(df).first()
    assert (row["period_mode"], row["actual_value"], row["ignored_conditions"]) == ("days", 1.5, False)


def test_missing_ratings_are_reported(spark):
    df = spark.createDataFrame([("p", "coverage", 79.0, None)], "project_key string, metric string, value double, date string")
    got = {r["metric"]: (r["status"], r["reason"]) for r in kpi.kpi_audit(df).collect()}
    assert got["coverage"] == ("FAIL", "Actual 79.00, required >= 80.00")
    assert got["reliability_rating"] == ("MISSING", "not measured") and len(got) == len(kpi.KPI_THRESHOLDS)
