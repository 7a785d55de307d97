"""Dependency edges and symbols read from source text.

Each file is handled inside its own row; only counting shuffles. Computed arrays are
exploded with the outer form and filtered after it, because for the inner form the
optimizer adds a size filter that would compute the array a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.functions import code
from lintlake.functions import text as tx

INCLUDE = r"^\s*#\s*include\s*[<\"]([^>\"]+)"
CLASS_HEAD = r"^\s*(?:class|struct)\s+(\w+)"
BASES = r"^\s*(?:class|struct)\s+\w+[^:;{(]*:\s*([^:;{(][^;{(]*)"
BASE_MARKS = r"\b(?:public|protected|private|virtual)\b"


def _lines(sources: DataFrame) -> DataFrame:
    return sources.select(
        "file_path", tx.bare_lines(tx.split_lines(F.col("text"))).alias("_bare")
    )


EDGE = "array<struct<src:string,dst:string,type:string>>"


def _edge(src: Column, dst: Column, kind: str) -> Column:
    return F.struct(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"))


def _include_array() -> Column:
    """File → included name, once per include line."""
    names = F.transform("_bare", lambda t: F.regexp_extract(t, INCLUDE, 1))
    return F.transform(F.filter(names, lambda n: n != ""), lambda n: _edge(F.col("file_path"), n, "include"))


def _inherit_array() -> Column:
    """Class → base class, for class heads and bases on one line; template arguments kept."""
    heads = F.filter("_bare", lambda t: F.regexp_extract(t, BASES, 1) != "")
    bases = F.transform(
        heads,
        lambda t: F.transform(
            F.split(F.regexp_extract(t, BASES, 1), ","),
            lambda base: _edge(
                F.regexp_extract(t, CLASS_HEAD, 1), F.trim(F.regexp_replace(base, BASE_MARKS, "")), "inherits"
            ),
        ),
    )
    return F.filter(F.flatten(bases), lambda e: e["dst"] != "")


def _with_extent(items: Column, n: Column) -> Column:
    """Line-ordered structs → the same with `extent_end`, the line before the next one."""
    return F.zip_with(
        items,
        F.concat(F.slice(F.transform(items, lambda h: h["line"] - 1), 2, 1_000_000_000), F.array(n)),
        lambda h, last: F.struct(
            h["kind"].alias("kind"),
            h["spelling"].alias("spelling"),
            h["line"].alias("line"),
            last.alias("extent_end"),
        ),
    )


def _symbol_array() -> Column:
    functions = F.transform(
        code.headers(F.col("_bare")),
        lambda h: F.struct(
            F.lit("function").alias("kind"),
            h["name"].alias("spelling"),
            h["line"].alias("line"),
        ),
    )
    classes = F.filter(
        F.transform(
            "_bare",
            lambda t, i: F.struct(
                F.lit("class").alias("kind"),
                F.regexp_extract(t, CLASS_HEAD, 1).alias("spelling"),
                (i + 1).alias("line"),
            ),
        ),
        lambda c: c["spelling"] != "",
    )
    return F.array_sort(
        F.concat(functions, classes),
        lambda a, b: F.when(a["line"] != b["line"], a["line"] - b["line"])
        .when(a["kind"] < b["kind"], -1)
        .when(a["kind"] > b["kind"], 1)
        .otherwise(0),
    )


def symbols(sources: DataFrame) -> DataFrame:
    """Function and class heads: (file, kind, spelling, line, extent_end).

    The extent is textual: it ends before the next head or at the end of the file.
    """
    listed = _lines(sources).select(
        "file_path", F.size("_bare").alias("_n"), _symbol_array().alias("_s")
    )
    return listed.select(
        F.col("file_path").alias("file"), F.inline_outer(_with_extent(F.col("_s"), F.col("_n")))
    ).where("line is not null")


def _call_array() -> Column:
    """Caller → callee, for every call token below a function header up to the next one."""
    n = F.size("_bare")
    spans = F.zip_with(
        "_heads",
        F.concat(F.slice(F.transform("_heads", lambda h: h["line"] - 1), 2, 1_000_000_000), F.array(n)),
        lambda h, last: F.struct(
            h["name"].alias("src"), F.slice("_bare", h["line"] + 1, last - h["line"]).alias("body")
        ),
    )
    calls = F.transform(
        spans,
        lambda s: F.flatten(
            F.transform(
                F.filter(s["body"], lambda t: F.contains(t, F.lit("("))),
                lambda t: F.transform(plain_calls(t), lambda w: _edge(s["src"], w, "call")),
            )
        ),
    )
    # A file without headers has no callers.
    return F.when(F.size("_heads") > 0, F.flatten(calls)).otherwise(F.array())


def plain_calls(line: Column) -> Column:
    """Every word before a '(' in the line, repeats kept."""
    pieces = F.split(tx.spaced(line), r"\(")
    words = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.regexp_extract(
            F.substring_index(F.rtrim(p), " ", -1), rf"(?<!{code.WORD})({code.WORD}+)$", 1
        ),
    )
    return F.filter(words, lambda w: (w != "") & ~w.isin(*code.NOT_FUNCTIONS))


def _edge_arrays(sources: DataFrame) -> DataFrame:
    """Per file: its lines, and the arrays of its edges by type. One scan, one split."""
    headed = _lines(sources).withColumn("_heads", code.headers(F.col("_bare")))
    return headed.select(
        "_bare",
        _include_array().cast(EDGE).alias("include"),
        _call_array().cast(EDGE).alias("call"),
        _inherit_array().cast(EDGE).alias("inherits"),
    )


def all_edges(sources: DataFrame, types: Sequence[str] = ("include", "call", "inherits")) -> DataFrame:
    """Typed edges: (src, dst, type), of the types named."""
    return (
        _edge_arrays(sources).select(F.explode_outer(F.concat(*types)).alias("e"))
        .where("e is not null").select("e.*")
    )


def edge_counts(sources: DataFrame) -> DataFrame:
    """Edges per type, and the number of symbols as type 'symbol'; types without any are left out."""
    sizes = _edge_arrays(sources).select(
        *[F.size(t).alias(t) for t in ("include", "call", "inherits")], F.size(_symbol_array()).alias("symbol")
    )
    names = ("include", "call", "inherits", "symbol")
    sums = sizes.agg(*[F.sum(t).alias(t) for t in names])
    rows = F.array(*[F.struct(F.lit(t).alias("type"), F.col(t).alias("n")) for t in names])
    return sums.select(F.inline(rows)).where("n > 0")
