import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from lintlake.functions import code, markup, values
from lintlake.functions import render as rd
from lintlake.functions import text as tx


def test_first_truthy_skips_empty_but_keeps_the_last(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", None), (None, "")],
                               "x string, y string")
    got = [r[0] for r in df.select(tx.first_truthy(F.col("x"), F.col("y"))).collect()]
    assert got == ["b", "b", "a", None, ""]


def test_split_lines_matches_line_rules(evaluate):
    texts = ["a\nb\n", "a\r\nb\rc", "", "\n\n", "x", "a\x0bb c\n", "é\n  z"]
    got = evaluate(tx.split_lines, texts)
    assert got == [t.replace("\r\n", "\n").replace("\r", "\n").splitlines(keepends=True) for t in texts]
    bare = evaluate(lambda c: tx.bare_lines(tx.split_lines(c)), texts)
    assert bare == [t.replace("\r\n", "\n").replace("\r", "\n").splitlines() for t in texts]


def test_strip_and_indents(evaluate):
    texts = ["  a\t", "　 b\xa0", "\t c", "", "   "]
    assert evaluate(tx.strip, texts) == [t.strip() for t in texts]
    assert evaluate(tx.indent_spaces, texts) == [len(t) - len(t.lstrip(" ")) for t in texts]
    assert evaluate(tx.indent_whitespace, texts) == [len(t) - len(t.lstrip()) for t in texts]


def test_paths(evaluate):
    paths = ["a/b/c.tar.gz", "c.cpp", ".hidden", "a/b.", "a/.x.H"]
    assert evaluate(tx.file_suffix, paths) == [".gz", ".cpp", "", "", ".H"]
    assert evaluate(tx.file_stem, paths) == ["c.tar", "c", ".hidden", "b.", ".x"]
    assert evaluate(tx.dir_name, paths) == ["a/b", "", "", "a", "a"]
    assert evaluate(tx.language_of, ["x.HPP", "x.c", "x.py", "x", "x.zz"]) == [
        "cpp", "c", "python", "cpp", "cpp"]


def test_numbers(evaluate):
    texts = [" 12 ", "12.5", "1_000", "", None, "abc", "+7", "-3"]
    assert evaluate(values.to_int, texts) == [12, None, 1000, None, None, None, 7, -3]
    assert evaluate(values.to_float, ["12,5", "1.0d", "1e3", ".5", "5.", "x", ""]) == [
        12.5, None, 1000.0, 0.5, 5.0, None, None]


def _effort(text):
    """State machine restatement."""
    total, num, unit = 0, "", ""

    def flush():
        factor = 1440 if unit.startswith("d") else 60 if unit.startswith("h") else 1
        return int(num) * factor if num else 0

    for ch in text.strip().lower():
        if ch.isdigit():
            if unit:
                total += flush()
                num, unit = "", ""
            num += ch
        elif ch.isalpha():
            unit += ch
        else:
            total += flush()
            num, unit = "", ""
    return (total + flush()) or None


def test_effort_property(evaluate):
    rng = random.Random(7)
    texts = ["2h 30min", "2h30min", "1d", "5 h", "15", "abc", "", "0min"]
    texts += ["".join(rng.choice("0123dhm in") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    assert evaluate(values.effort_minutes, texts) == [_effort(t) for t in texts]


def test_dates(evaluate):
    texts = ["2024-10-19T04:58:11+0000", "2024-10-19T04:58:11+02:00", "2024-10-19T04:58:11Z",
             "2024-10-19", "", None, "garbage", "2024"]
    zero = F.lit(None).cast("string")
    got = evaluate(lambda c: values.epoch_seconds(c, zero), texts)
    base = datetime(2024, 10, 19, 4, 58, 11, tzinfo=timezone.utc).timestamp()
    midnight = datetime(2024, 10, 19, tzinfo=timezone.utc).timestamp()
    assert got == [base, base - 7200, base, midnight, 0.0, 0.0, 0.0, 0.0]
    assert evaluate(values.colon_offset, texts[:4]) == [
        "2024-10-19T04:58:11+00:00", texts[1], texts[2], texts[3]]
    assert values.bound_seconds("2024-10-19") == midnight
    assert values.bound_seconds("nonsense") is None


def test_severity(evaluate):
    assert evaluate(values.severity_weight, ["BLOCKER", "critical", "odd", None]) == [5, 4, 0, 0]


def test_headers_and_names(evaluate):
    lines = ["Boolean A::B::Foo(int a)", "if(x)", "if (x)", "int *bar(x)", "int f(x);", "else g()"]
    assert evaluate(code.is_header, lines) == [True, True, False, True, False, False]
    assert evaluate(code.function_name, lines)[:4] == ["Foo", None, None, "bar"]
    assert evaluate(code.class_name, lines)[:2] == ["B", None]


def test_called_names(evaluate):
    got = evaluate(code.called_names, ["Foo() Foo(a) Foo ( a ) xFoo(a)", "p->~Foo (a)", "a + operator+(b)", "none"])
    assert got[0] == ["Foo", "xFoo"]
    assert {"~Foo", "Foo"} <= set(got[1])
    assert "operator+" in got[2]
    assert got[3] == []


def test_class_filter_parts(spark):
    df = spark.createDataFrame(
        [("A::fn(x);",), ("fn(x);",), ("::fn(x);",), ("A::fx::fn(B::fn());",), ("x = N::A ::fn(1);",)],
        "s string")
    got = df.select(code.other_class_qualifier(F.col("s"), F.lit("fn")),
                    code.qualifier_endings(F.col("s"), F.lit("fn"))).collect()
    assert [r[0] for r in got] == ["A", None, None, "fx", "A"]
    assert set(got[3][1]) == {"x", "fx", "B"}


def test_included_stems_equals_substring_test(spark):
    includes = ['#include "a/foo.h" // see b.hpp', "// nothing", "#include <x.hh>"]
    df = spark.createDataFrame([(includes,)], "i array<string>")
    stems = set(df.select(code.included_stems(F.col("i"))).first()[0])
    text = " ".join(includes)
    wanted = {text[a:b] for b in range(len(text)) for a in range(b) if "/" not in text[a:b]}
    for stem in wanted:
        assert (stem in stems) == any(stem + ".h" in line for line in includes), stem


def test_advice_parts(evaluate):
    got = evaluate(markup.advice_parts, [
        '{"explanation":"a","code_update":"b"}', '{"reasoning":"a","patch":"b"}', '{"x":1}',
        "txt\n```cpp\ncode\n```\nmore", "txt ```open", "none ", "", None])
    assert [(r["explanation"], r["code_update"]) for r in got] == [
        ("a", "b"), ("a", "b"), ('{"x":1}', ""), ("txt", "```cpp\ncode\n```"), ("txt", "```open"),
        ("none", ""), ("", ""), ("", "")]


def test_strip_fence_and_html(evaluate):
    assert evaluate(markup.strip_fence, [" ```json\n{}\n``` ", "```a", "a ```b```"]) == [
        "json\n{}", "```a", "a ```b```"]
    assert evaluate(markup.strip_html, ["<p>a &amp;lt; &eacute;</p>\n", None]) == ["a &lt; é", ""]


def test_payload_and_core(evaluate, spark):
    assert evaluate(markup.source_payload_text, [
        '{"sources":[{"code":"a"},{"line":2},{"code":"b"}]}', '{"x":1}', "\nplain\n", "{broken"]) == [
        "a\n\nb", "", "plain", "{broken"]
    df = spark.createDataFrame([("hello world", 0, 5), ("hello", 3, 9), ("a   b", 1, 3)], "l string, a int, z int")
    got = [r[0] for r in df.select(markup.core_slice(F.col("l"), F.col("a"), F.col("z"))).collect()]
    assert got == ["hello", "hello", "a   b"]


def test_reply_text(evaluate):
    assert evaluate(markup.reply_text, ['{"choices":[{"message":{"content":"hi"}}]}', "{}", "raw"]) == [
        "hi", "{}", "raw"]


def test_render_does_not_expand_values(spark):
    df = spark.createDataFrame([("{b}", "two")], "a string, b string")
    out = df.select(rd.render("{{x}} {a}-{b}", {"a": F.col("a"), "b": F.col("b")})).first()[0]
    assert out == "{x} {b}-two"


def test_messages(spark):
    row = spark.range(1).select(rd.messages(F.lit("s"), F.lit("u")).alias("m")).first()
    assert [(m["role"], m["content"]) for m in row["m"]] == [("system", "s"), ("user", "u")]


def test_json_text(spark):
    row = spark.range(1).select(
        rd.json_text(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")))).first()
    assert row[0] == '{"a":1,"b":null}'


def test_call_site_limits():
    assert rd.call_site_limits() == [20, 15, 10, 5, 3]
    assert rd.call_site_limits(2, 3) == [2]
