"""The kept index answers as a search over the sources does, and reads nothing else."""

import os
import random

import pytest

from lintlake.operators import call_index, calls

FILES = "file_path string, text string"


def _sources(seed, n=40):
    rng, out = random.Random(seed), {}
    for i in range(n):
        lines = [f'#include "f{rng.randint(0, 9)}.h"'] if rng.random() < 0.5 else []
        for _ in range(rng.randint(0, 15)):
            name = rng.choice(["run", "go", "hot", "hot", "~Drop", "operator+", "日本"])
            lines.append(rng.choice([f"  {name}(1);", f"A::{name}(x)", f"int A::{name}(int q)", f"B::{name}(2);", "x = 1;", f"{name} (", "if (hot(2)) go(3);"]))
        suffix = rng.choice([".cpp", ".cpp", ".h"])
        out[f"m{i % 3}/{rng.choice(['a', 'b', 'tests'])}/f{i % 10}x{i}{suffix}"] = "\n".join(lines)
    out["m1/a/empty.cpp"], out["m1/a/null.cpp"] = "", None
    return out


def _table(spark, files):
    return spark.createDataFrame(list(files.items()), FILES).repartition(3)


@pytest.fixture(scope="module")
def wanted(spark):
    rows = [(n, c, d, f"f{i % 10}") for i, (n, c, d) in enumerate(
        (n, c, d) for n in ("run", "go", "hot", "~Drop", "operator+", "日本", "nowhere") for c in ("", "A", "B") for d in ("m1/a", ""))]
    return spark.createDataFrame(rows, "name string, class_name string, def_dir string, stem string")


def _same(spark, wanted, files, folder, limit):
    columns = ["name", "class_name", "def_dir", "stem", "file", "line", "code", "score", "rank", "includes_bug_header",
               "context_start", "context_end", "context", "includes"]
    want = calls.rank_for_profiles(wanted, _table(spark, files), limit, 2).select(*columns).collect()
    got = call_index.rank_call_sites(wanted, folder, limit).select(*columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    return len(got)


def test_index_equals_a_search(spark, wanted, tmp_path):
    folder, files = str(tmp_path / "index"), _sources(1)
    assert call_index.rank_call_sites(wanted, folder, 3).count() == 0
    assert call_index.update(_table(spark, files), folder, around=2) == 1
    assert _same(spark, wanted, files, folder, 3) > 20
    # Some files change, some go, some are new, some come back.
    other = _sources(2)
    names = sorted(files)
    second = {p: (other.get(p) or "hot(9);") if i % 4 == 0 else files[p] for i, p in enumerate(names) if i % 5}
    second["new/n.cpp"] = "go(1);\n  hot(2);"
    assert call_index.update(_table(spark, second), folder, around=2) == 2
    assert _same(spark, wanted, second, folder, 3) > 20
    assert call_index.update(_table(spark, files), folder, around=2) == 3
    _same(spark, wanted, files, folder, 20)


def test_an_update_writes_what_differs(spark, wanted, tmp_path):
    folder, files = str(tmp_path / "index"), _sources(3)
    call_index.update(_table(spark, files), folder)
    call_index.update(_table(spark, files), folder)
    assert spark.read.schema(call_index.FILE).parquet(f"{folder}/files/generation=2").count() == 0
    changed = next(p for p in files if p.endswith(".cpp") and "tests" not in p)
    call_index.update(_table(spark, {**files, changed: "hot(1);"}), folder)
    assert [r.file for r in spark.read.schema(call_index.FILE).parquet(f"{folder}/files/generation=3").collect()] == [changed]
    rows = spark.read.parquet(f"{folder}/calls/generation=3").collect()
    assert [(r.file, r.name, r.line, r.context) for r in rows] == [(changed, "hot", 1, "hot(1);")]


def test_a_lost_generation_does_not_count(spark, wanted, tmp_path):
    folder, files = str(tmp_path / "index"), _sources(4)
    call_index.update(_table(spark, files), folder, around=2)
    call_index.update(_table(spark, _sources(5)), folder, around=2)
    os.remove(f"{folder}/files/generation=2/_SUCCESS")
    _same(spark, wanted, files, folder, 3)
    assert call_index.update(_table(spark, files), folder, around=2) == 2
    _same(spark, wanted, files, folder, 3)


def test_a_search_reads_the_shelves_of_its_names(spark, tmp_path):
    folder = str(tmp_path / "index")
    call_index.update(_table(spark, {f"a/f{i}.cpp": f"name{i}(1);" for i in range(200)}), folder)
    one = spark.createDataFrame([("name7", "", "", "")], "name string, class_name string, def_dir string, stem string")
    found = call_index.calls_of(spark, folder, one)
    assert [(r.file, r.line) for r in found.collect()] == [("a/f7.cpp", 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shelf" in plan and "FileScan text" not in plan
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "shelf" in x)
    assert f"(shelf#" in scan and " IN " not in scan.split("PartitionFilters")[1].split("]")[0]
    shelves = [p for p in os.listdir(f"{folder}/calls/generation=1") if p.startswith("shelf=")]
    assert len(shelves) > 32


def test_names_that_are_not_filed_are_an_error(spark, tmp_path):
    folder = str(tmp_path / "index")
    call_index.update(_table(spark, {"a.cpp": "x(1);"}), folder)
    long = spark.createDataFrame([("n" * 600, "", "", "")], "name string, class_name string, def_dir string, stem string")
    with pytest.raises(Exception, match="files shorter names"):
        call_index.rank_call_sites(long, folder).collect()
