"""Component index."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.functions.text import name_extension, top_module
from lintlake.operators.issues import best_row
from lintlake.sources.sinks import write_csv, write_jsonl

# Folders of build products left out of the index.
DEFAULT_EXCLUDES = (
    "**/obj/**",
    "**/bin/**",
    "**/x64/**",
    "**/.vs/**",
    "**/packages/**",
    "**/.NETFramework,Version=*/**",
)


def glob_pattern(globs: Sequence[str]) -> str:
    """File globs → one regular expression; '*' also crosses '/'."""

    def one(glob: str) -> str:
        out, i = "", 0
        while i < len(glob):
            ch = glob[i]
            close = glob.find("]", i + 2) if ch == "[" else -1
            if ch == "*":
                out += ".*"
            elif ch == "?":
                out += "."
            elif close > 0:
                body = glob[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
                out += "[" + ("^" + body[1:] if body.startswith("!") else body) + "]"
                i = close
            else:
                out += re.escape(ch)
            i += 1
        return out

    return "(?s)^(?:" + "|".join(one(g) for g in globs) + ")$"


def matches_any_glob(path: Column, globs: Sequence[str]) -> Column:
    return path.rlike(glob_pattern(globs)) if globs else F.lit(False)


def component_index(
    components: DataFrame,
    include_languages: Sequence[str] | None = None,
    exclude_globs: Sequence[str] = DEFAULT_EXCLUDES,
    order: Sequence[str] = ("page_no", "pos"),
) -> DataFrame:
    """Filtered index, the first row of each key wins (a filtered row does not claim it)."""
    kept = components.where((F.col("key") != "") & (F.col("path") != ""))
    if include_languages:
        kept = kept.where(F.col("language").isin(list(include_languages)))
    if exclude_globs:
        kept = kept.where(~matches_any_glob(F.col("path"), exclude_globs))
    name = F.coalesce("name", F.lit(""))
    rows = kept.select(
        F.col("key").alias("component_key"),
        F.col("path").alias("rel_path"),
        name.alias("name"),
        "language",
        top_module(F.col("path")).alias("module"),
        name_extension(name).alias("ext"),
        *order,
    )
    return best_row(rows, ["component_key"], [F.col(c) for c in order], last=False).drop(*order)


def all_paths(index: DataFrame) -> DataFrame:
    return index.select("rel_path").where("rel_path <> ''")


def save_index(index: DataFrame, jsonl_path: str | None = None, csv_path: str | None = None) -> None:
    """The index as JSON lines, as CSV, or both."""
    if jsonl_path:
        write_jsonl(index, jsonl_path)
    if csv_path:
        write_csv(index, csv_path)


def page_counters(pages: DataFrame) -> DataFrame:
    """Landed pages (page_no, issues, paging) → pages, issues, size of the last, reported total."""
    n = F.coalesce(F.size("issues"), F.lit(0))
    return pages.agg(
        F.count("*").alias("pages"),
        F.sum(n).alias("issues_total"),
        F.max_by(n, F.col("page_no")).alias("last_page_size"),
        F.max("paging.total").alias("reported_total"),
    )
