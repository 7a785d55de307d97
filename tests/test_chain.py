"""Golden chain: landed lines and source files to exported table."""

import json

from lintlake.operators import flatten, prompts
from lintlake.plans import chains
from lintlake.sources import files, jsonl

FILES = {
    "core/ctl/control.cpp": '#include "control.h"\n\nint Controller::Run(int a)\n{\n    if (a)\n        Step(a);\n    return a;\n}\n',
    "core/ui/view.cpp": '#include "../ctl/control.h"\nvoid View::Show()\n{\n    ctl.Run(1);\n}\n',
    "core/tests/t.cpp": "void t()\n{\n    Run(2);\n}\n",
}
PAGE = {
    "issues": [
        {"key": "B1", "type": "BUG", "severity": "MAJOR", "component": "p:c1", "message": "m",
         "textRange": {"startLine": 6, "endLine": 6}, "updateDate": "2024-01-01T00:00:00+0000"},
        {"key": "B2", "type": "BUG", "component": "p:gone.cpp", "textRange": {"startLine": 1}},
        {"key": "B3", "type": "CODE_SMELL", "component": "p:c1", "textRange": {"startLine": 1}},
    ],
    "components": [{"key": "p:c1", "path": "core/ctl/control.cpp"}],
}


def test_chain(spark, tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "src" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    newer = {"issues": [{**PAGE["issues"][0], "severity": "BLOCKER", "updateDate": "2024-02-01T00:00:00+0000"}],
             "components": PAGE["components"]}
    (tmp_path / "landed.jsonl").write_text("\n".join([json.dumps(PAGE), "{bad", "{bad", json.dumps(newer)]) + "\n")

    lines = jsonl.numbered_lines(spark, str(tmp_path / "landed.jsonl"))
    sources = files.read_source_tree(spark, str(tmp_path / "src"))
    records = chains.issue_snippets(lines, sources, context_lines=0)
    rows = records.collect()
    assert len(rows) == 5 and sum(r["error"] == "json_parse_error" for r in rows) == 2
    by_key = {r["issue_key"]: r for r in rows if r["issue_key"]}
    assert (by_key["B1"]["severity"], by_key["B1"]["code_snippet"]) == ("BLOCKER", "        Step(a);\n")
    assert by_key["B2"]["error"] == "file_read_error"

    deep = chains.bug_context(records.where("type = 'BUG'"), sources)
    found = {r["issue_key"]: r for r in deep.collect()}
    assert [(b["indent"], b["start"], b["end"]) for b in found["B1"]["blocks"]] == [(8, 6, 6), (4, 5, 7), (0, 1, 8)]
    sites = found["B1"]["anchors"][0]["call_sites"]
    assert [(s["file"], s["line"], s["score"]) for s in sites] == [("core/ui/view.cpp", 4, 5)]
    assert found["B2"]["anchors"] == [] and found["B2"]["error"]

    text = prompts.callsite_prompts(deep, "{issue_key}\n{context_block}\n{call_sites_section}").where("issue_key = 'B1'").first()
    assert "// Context block (level 1, lines 5–7)\n    if (a)\n" in text["user_prompt"]
    assert "// Suspected callee signature: int Controller::Run(int a)" in text["user_prompt"]

    replies = spark.createDataFrame([("B1", "m1", "why\n```fix```")], "issue_key string, model string, raw string")
    advised, counters = chains.advice_run(
        deep, "{issue_key}{call_sites_section}", replies, "callsite", "m0", stop_after=5)
    assert tuple(counters.first()) == (2, 2, 2, 2, 1)
    table = flatten.export_table(advised, text_columns=())
    assert table.columns[0] == "issue_key" and "bug_callsite_advice.code_update" in table.columns
    assert "blocks" not in table.columns
    got = {r["issue_key"]: r for r in table.collect()}
    assert got["B1"]["bug_callsite_advice.code_update"] == "```fix```"
