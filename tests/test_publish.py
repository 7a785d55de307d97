"""State that is kept: published versions, the newest issue of a stream, counters of the writing pass."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lintlake.operators import issues
from lintlake.plans import chains
from lintlake.sources import jsonl, sinks
from lintlake.streaming import landing


def _changes(spark, folder, version):
    return sorted((tuple(r) for r in sinks.read_changes(spark, folder, version).select("change", "k", "v").collect()), key=str)


def _table(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_publish_hands_out_what_differs(spark, tmp_path):
    folder = str(tmp_path / "pub")
    assert sinks.published_version(spark, folder) == 0
    assert sinks.publish(_table(spark, [("a", "1"), ("b", None), ("c", "3"), (None, "n")]), folder, ["k"], ["v"]) == 1
    first = sinks.read_changes(spark, folder, 1)
    assert first.count() == 4 and {r.change for r in first.collect()} == {"new"}
    # One changed, one new, one gone; a null that becomes an empty text is a change; null is a key.
    second = _table(spark, [("a", "1"), ("b", ""), ("d", "4"), (None, "n")])
    assert sinks.publish(second, folder, ["k"], ["v"]) == 2
    assert _changes(spark, folder, 2) == [("changed", "b", ""), ("new", "d", "4"), ("removed", "c", None)]
    assert sinks.publish(second, folder, ["k"], ["v"]) == 3 and _changes(spark, folder, 3) == []
    # What was removed and comes back is new.
    assert sinks.publish(_table(spark, [("c", "3")]), folder, ["k"], ["v"]) == 4
    assert [(c, k) for c, k, _ in _changes(spark, folder, 4)] == [
        ("new", "c"), ("removed", "a"), ("removed", "b"), ("removed", "d"), ("removed", None)]
    assert sinks.publish(_table(spark, []), folder, ["k"], ["v"]) == 5
    assert _changes(spark, folder, 5) == [("removed", "c", None)]


def test_a_publish_that_is_lost_is_repeated(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "pub")
    sinks.publish(_table(spark, [("a", "1")]), folder, ["k"], ["v"])
    move = sinks._move

    def lost(session, source, target):
        if target and target.endswith(sinks.POINTER):
            raise OSError("lost")
        move(session, source, target)

    monkeypatch.setattr(sinks, "_move", lost)
    with pytest.raises(OSError):
        sinks.publish(_table(spark, [("a", "2")]), folder, ["k"], ["v"])
    assert sinks.published_version(spark, folder) == 1
    monkeypatch.setattr(sinks, "_move", move)
    assert sinks.publish(_table(spark, [("a", "3")]), folder, ["k"], ["v"]) == 2
    assert _changes(spark, folder, 2) == [("changed", "a", "3")]


def test_equal_keys_count_once(spark, tmp_path):
    rows = [("a", str(i)) for i in range(20)]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        folder = str(tmp_path / str(seed))
        sinks.publish(_table(spark, rows).repartition(4), folder, ["k"], ["v"])
        (found,) = _changes(spark, folder, 1)
        assert found[:2] == ("new", "a")


def test_tables_are_written_by_one_pass(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def seen(v):
        runs.add(1)
        return v

    counted = F.udf(seen, "int")
    full = spark.range(10).select(counted(F.col("id").cast("int")).alias("a"))
    out = str(tmp_path / "t")
    written = sinks.write_tables({"full": full, "empty": full.where("a > 99")}, out)
    assert written == {"full": f"{out}/full"} and runs.value == 20
    assert sorted(n for n in os.listdir(out) if not n.startswith(".")) == ["full"]
    assert spark.read.option("header", True).csv(f"{out}/full").count() == 10
    # An empty table leaves what an earlier run wrote; a full one replaces it.
    assert sinks.write_tables({"full": full.where("a > 99")}, out) == {}
    assert spark.read.option("header", True).csv(f"{out}/full").count() == 10
    sinks.write_tables({"full": full.where("a > 6")}, out)
    assert spark.read.option("header", True).csv(f"{out}/full").count() == 3


def test_run_counters_of_the_writing_pass(spark, tmp_path):
    rows = [(f"I{i}", s, f"2024-01-0{i}T00:00:00+0000") for i, s in enumerate(["MAJOR", "BLOCKER", "INFO", "BLOCKER"], 1)]
    df = spark.createDataFrame(rows, "issue_key string, severity string, creation_date string").selectExpr(
        "*", "CAST(NULL AS string) AS update_date", "'BUG' AS type", "'r' AS rule", "'m' AS message",
        "'f.cpp' AS file_path", "1 AS start_line", "1 AS end_line", "'c' AS code_snippet")
    replies = spark.createDataFrame([("I4", "m1", "why"), ("I1", "m1", "x")], "issue_key string, model string, raw string")
    for template, want in (("{issue_key}", (4, 3, 2, 2, 1)), ("{no_such_hole}", (4, 3, 0, 3, 3))):
        out = str(tmp_path / template.strip("{}"))
        choice = {"since": "2024-01-02", "stop_after": 2}
        counters = chains.write_advice_run(df, template, replies, lambda advised, out=out: sinks.write_jsonl(advised, out), **choice)
        assert tuple(counters[n] for n in ("read", "filtered", "processed", "written", "errors")) == want
        assert spark.read.json(out).count() == counters["written"]
        assert tuple(chains.advice_run(df, template, replies, **choice)[1].first()) == want


def _page(*found):
    return json.dumps({"issues": [{"key": k, "severity": s, "updateDate": u, "component": "p:x"} for k, s, u in found]})


def test_newest_issue_of_a_stream_equals_the_batch(spark, tmp_path):
    day = "2024-01-0{}T00:00:00+0000".format
    rng, source = random.Random(5), tmp_path / "in"
    source.mkdir()
    keys = [f"K{i}" for i in range(12)] + ["hot"] * 8

    def land(name, n):
        lines = []
        for _ in range(n):
            found = [(rng.choice(keys), f"S{rng.randint(0, 99)}", rng.choice([day(1), day(2), day(3), None, "bad"])) for _ in range(3)]
            lines.append(_page(*found))
        (source / name).write_text("\n".join([*lines, "{broken", lines[0]]) + "\n")

    def follow():
        lines = landing.follow_lines(spark, str(source), files_per_batch=2)
        landing.keep_newest(lines, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination(120)

    columns = ["issue_key", "severity", "update_date", "file", "pos", "error", "_raw"]

    def same():
        batch = issues.normalize(jsonl.landed_issues(jsonl.numbered_lines(spark, str(source))))
        place = ["file", "line_no", "pos"]
        want = issues.dedup_issues(batch, page=place, row_id=place).select(*columns)
        found = landing.read_newest(spark, str(tmp_path / "table")).select(*columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
        return found.count()

    for i in range(5):
        land(f"{i}.jsonl", 6)
    follow()
    n = same()
    # A restart goes on where it stopped; overlapping fetches replace older rows only.
    land("9.jsonl", 8)
    land("7.jsonl", 2)
    follow()
    assert same() == n + 2
    follow()
    assert same() == n + 2
    # A batch that is repeated replaces its own folder.
    batches = sorted(p for p in os.listdir(tmp_path / "table") if p.startswith("batch="))
    assert len(batches) == 4
    landing.compact(spark, str(tmp_path / "table"), str(tmp_path / "small"))
    small = landing.read_newest(spark, str(tmp_path / "small"))
    assert sorted(map(str, small.select(*columns).collect())) == sorted(
        map(str, landing.read_newest(spark, str(tmp_path / "table")).select(*columns).collect())
    )
