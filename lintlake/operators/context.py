"""Source context of an issue: snippet, nested blocks, enclosing function.

A source file is one row (file_path, text). Everything that depends on the file alone is
computed once per file; the only shuffle is the equi-join of issues and files on the path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.functions import code
from lintlake.functions import text as tx
from lintlake.operators.skew import PARTS, dealt, hot_keys, repeated, spread_join

def source_lines(sources: DataFrame) -> DataFrame:
    """(file_path, text) → one row per line: (file_path, line_no, text without its end)."""
    return (
        sources.select(
            "file_path", F.posexplode_outer(tx.split_lines(F.col("text"))).alias("pos", "line")
        )
        .where("line is not null")
        .select(
            "file_path",
            (F.col("pos") + 1).alias("line_no"),
            tx.drop_line_end(F.col("line")).alias("text"),
        )
    )


def needed_sources(sources: DataFrame, issues: DataFrame) -> DataFrame:
    """Only the files some issue points at."""
    return sources.join(issues.select("file_path").distinct(), "file_path", "left_semi")


def with_file(
    issues: DataFrame, files: DataFrame, spread_by: str = "issue_key"
) -> DataFrame:
    """Issues ⟕ per-file columns on file_path, hot files dealt over slices."""
    return spread_join(issues, files, ["file_path"], [spread_by])


def with_needed_file(
    issues: DataFrame, sources: DataFrame, features: Callable[[DataFrame], DataFrame], spread_by: str = "issue_key"
) -> DataFrame:
    """`with_file` of the `features` of the needed sources, whose texts are shuffled once.

    Files meet the slices of their issues first: whether a file is needed, its features and
    the join all find the text where that shuffle has put it.
    """
    on = ["file_path", "_slice"]
    hot = F.broadcast(hot_keys(issues.groupBy("file_path").count(), ["file_path"], PARTS))
    asking = dealt(issues, hot, ["file_path"], [spread_by])
    needed = repeated(sources, hot, ["file_path"]).join(asking.select(*on).distinct(), on, "left_semi")
    return asking.join(features(needed), on, "left").drop("_slice")


# --- snippets --------------------------------------------------------------


def snippets(
    issues: DataFrame,
    sources: DataFrame,
    context_lines: int = 0,
    max_chars: int = 20_000,
    normalize_tabs: bool = False,
) -> DataFrame:
    """Issue records + code_snippet and error.

    Lines [start - context, end + context] clamped to the file, terminators kept, cut at
    `max_chars`. Issues that cannot have a snippet get an error instead: missing_path,
    missing_start_line, invalid_line_numbers, file_read_error.
    """
    needed = needed_sources(sources, issues)
    files = needed.select("file_path", tx.split_lines(F.col("text")).alias("_lines"))
    prior = F.col("error") if "error" in issues.columns else F.lit(None).cast("string")
    joined = with_file(issues, files)
    start, end = F.col("start_line"), F.coalesce("end_line", "start_line")
    n = F.size("_lines")
    low = F.greatest(F.lit(1), start - context_lines)
    high = F.greatest(low, end + context_lines)
    first = F.greatest(F.lit(1), F.least(low, n))
    last = F.greatest(first, F.least(high, n))
    body = tx.join_range(F.col("_lines"), first, last)
    if normalize_tabs:
        body = tx.expand_tabs(body)
    error = (
        F.when(prior != "invalid_line_numbers", prior)
        .when(F.coalesce("file_path", F.lit("")) == "", "missing_path")
        .when(prior.isNotNull(), prior)
        .when(start.isNull(), "missing_start_line")
        .when(F.col("_lines").isNull(), "file_read_error")
    )
    # The body has a column of its own, so that cutting it does not build it repeatedly.
    found = joined.withColumns(
        {
            "error": error,
            "_body": F.when(n > 0, body).when(n == 0, F.lit("")),
        }
    )
    return found.withColumn(
        "code_snippet",
        F.when(F.col("error").isNull(), tx.cut_with_mark(F.col("_body"), max_chars)),
    ).drop("_lines", "_body")


# --- nested blocks ---------------------------------------------------------


#: Entries of a level of the index under one entry of the next.
FAN = 16
#: Levels of the index, enough for FAN ** LEVELS lines.
LEVELS = 7
_NO_INDENT = 2_147_483_647


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indent_index(indents: Column) -> Column:
    """Indents → array of levels: the indents, the least of every FAN of them, of every FAN of those, …

    Built once per file in one pass. A search for the nearest less indented line looks at a
    few entries of each level, so it costs the logarithm of the file's length.
    """

    def least(level: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil(F.size(level) / FAN).cast("int") - 1)
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.array_min(F.slice(level, i * FAN + 1, F.lit(FAN))))

    def build(levels: list[Column]) -> Column:
        if len(levels) == LEVELS:
            return F.array(*levels)
        more = _let(least(levels[-1]), lambda level: build([*levels, level]))
        return F.when(F.size(levels[-1]) <= FAN, F.array(*levels)).otherwise(more)

    return _let(F.transform(indents, lambda x: F.coalesce(x, F.lit(_NO_INDENT))), lambda level: build([level]))


def nearest_lower(index: Column, place: Column, bound: Column, up: bool) -> Column:
    """Position of the nearest line above (below) position `place` with an indent below `bound`, or null.

    Climbs from the entries beside `place` to those beside its group and so on, until a
    group holds a lower indent, and goes down inside that group.
    """
    nowhere = F.array().cast("array<int>")

    def lower(level: Column, first: Column, last: Column) -> Column:
        """The nearest of positions first … last of a level that is lower."""
        at = F.when(first <= last, F.sequence(first, last)).otherwise(nowhere)
        found = F.filter(at, lambda i: F.get(level, i) < bound)
        return F.get(found, F.size(found) - 1) if up else F.get(found, F.lit(0))

    def state(level: Column, at: Column, found: Column) -> Column:
        return F.struct(level.cast("int").alias("level"), at.cast("int").alias("at"), found.cast("int").alias("found"))

    def climb(acc: Column, entries: Column) -> Column:
        group = F.floor(acc["at"] / FAN).cast("int")
        if up:
            found = lower(entries, group * FAN, acc["at"] - 1)
        else:
            found = lower(entries, acc["at"] + 1, F.least(group * FAN + FAN, F.size(entries)) - 1)
        onward = _let(found, lambda x: state(
            F.when(x.isNull(), acc["level"] + 1).otherwise(acc["level"]), F.when(x.isNull(), group).otherwise(acc["at"]), x
        ))
        return F.when(acc["found"].isNotNull(), acc).otherwise(onward)

    def descend(at: Column, level: Column) -> Column:
        entries = F.get(index, level)
        return lower(entries, at * FAN, F.least(at * FAN + FAN, F.size(entries)) - 1)

    def down(end: Column) -> Column:
        levels = F.when(end["level"] > 0, F.sequence(end["level"] - 1, F.lit(0))).otherwise(nowhere)
        return F.when(end["found"].isNotNull(), F.aggregate(levels, end["found"], descend))

    reached = F.aggregate(index, state(F.lit(0), place, F.lit(None)), climb)
    return F.when(place.isNotNull(), _let(reached, down))


def _levels(index: Column, first_indent: Column, top: Column, bottom: Column, n: Column, depth: Column) -> Column:
    """Levels from the core (positions top … bottom) outward: array of struct(indent, start, end).

    A level of indent c reaches to the nearest less indented line on either side; the next c
    is the smaller of those two indents. There are no more levels than distinct indents.
    """
    kept_type = "array<struct<indent:int,start:int,end:int>>"

    def state(indent: Column, above: Column, below: Column, levels: Column) -> Column:
        return F.struct(
            indent.cast("int").alias("indent"), above.cast("int").alias("above"), below.cast("int").alias("below"),
            levels.alias("levels"),
        )

    def step(acc: Column, _: Column) -> Column:
        def onward(near: Column) -> Column:
            above, below = near["above"], near["below"]
            level = F.struct(
                acc["indent"].alias("indent"),
                F.coalesce(above + 1, F.lit(0)).alias("start"),
                F.coalesce(below - 1, n - 1).alias("end"),
            )
            indents = F.get(index, F.lit(0))
            outer = F.least(F.get(indents, above), F.get(indents, below))
            return state(outer, above, below, F.concat(acc["levels"], F.array(level).cast(kept_type)))

        near = F.struct(
            nearest_lower(index, acc["above"], acc["indent"], True).alias("above"),
            nearest_lower(index, acc["below"], acc["indent"], False).alias("below"),
        )
        return F.when(acc["indent"].isNotNull(), _let(near, onward)).otherwise(acc)

    start = state(first_indent, top, bottom, F.array().cast(kept_type))
    return F.aggregate(F.sequence(F.lit(0), depth), start, step, lambda acc: acc["levels"])


def blocks(df: DataFrame, lines: str = "_lines", indents: str = "_indents", index: str = "_index") -> DataFrame:
    """Add `blocks`: the core lines' block and every enclosing one, outermost last.

    `df` has start_line, end_line, the file's lines with their ends, the leading blanks of
    each line (null for a blank line) and the file's `indent_index`. A block of indent c
    reaches up and down to the nearest less indented line; the next c is the smaller of
    those two indents. Beyond its core a bug asks the index, it does not walk the file.
    """
    lines_, ind = F.col(lines), F.col(indents)
    n = F.size(lines_)

    def clamp(c: Column) -> Column:
        return F.greatest(F.lit(0), F.least(n - 1, c - 1))

    core = df.withColumn("_cs", clamp(F.col("start_line"))).withColumn(
        "_ce", F.greatest(F.col("_cs"), clamp(F.coalesce("end_line", "start_line")))
    )
    first = F.coalesce(
        F.array_min(F.slice(ind, F.col("_cs") + 1, F.col("_ce") - F.col("_cs") + 1)), F.lit(0)
    )
    usable = (n > 0) & F.col("start_line").isNotNull()
    depth = F.size(F.array_distinct(ind))
    walked = core.withColumn("_first", first).withColumn(
        "_levels", F.when(usable, _levels(F.col(index), F.col("_first"), F.col("_cs"), F.col("_ce"), n, depth))
    )
    levels = F.col("_levels")
    nested = F.transform(
        levels,
        lambda b, i: F.struct(
            i.cast("int").alias("level"),
            b["indent"].alias("indent"),
            (b["start"] + 1).alias("start"),
            (b["end"] + 1).alias("end"),
            tx.join_range(lines_, b["start"] + 1, b["end"] + 1).alias("code"),
        ),
    )
    from lintlake.schemas import BLOCK

    empty = F.array().cast(f"array<{BLOCK}>")
    return walked.withColumn(
        "blocks",
        F.when(levels.isNotNull(), nested).when(n == 0, empty),
    ).drop("_cs", "_ce", "_first", "_levels")


def file_features(sources: DataFrame) -> DataFrame:
    """Per file: lines with ends, leading blanks per line and their index, header lines, include block."""
    own = [c for c in sources.columns if c != "text"]
    lined = sources.select(*own, tx.split_lines(F.col("text")).alias("_lines"))
    indents = F.transform("_lines", lambda t: F.when(~tx.is_blank(t), tx.indent_spaces(t)))
    bare = lined.withColumns({"_bare": tx.bare_lines(F.col("_lines")), "_indents": indents})
    return bare.select(
        *own,
        "_lines",
        "_indents",
        indent_index(F.col("_indents")).alias("_index"),
        code.headers(F.col("_bare")).alias("_headers"),
        code.include_block(F.col("_bare")).alias("_includes"),
    )


FILE_COLUMNS = ("_lines", "_indents", "_index", "_headers", "_includes", "_nested")


def bug_blocks(bugs: DataFrame, sources: DataFrame, keep_file: bool = False) -> DataFrame:
    """Bugs + blocks; a bug whose file is missing or that has no line gets an error.

    `keep_file` leaves the file columns for `enclosing_function`.
    """
    prior = F.col("error") if "error" in bugs.columns else F.lit(None).cast("string")
    joined = with_needed_file(bugs, sources, file_features)
    # Whether there are blocks: known without the blocks, for readers that need no more of them.
    nested = F.coalesce((F.size("_lines") > 0) & F.col("start_line").isNotNull(), F.lit(False))
    out = blocks(joined).withColumn("_nested", nested).withColumn(
        "error",
        F.coalesce(
            prior,
            F.when(
                F.col("_lines").isNull(),
                F.concat(F.lit("Source file not found: "), F.coalesce("file_path", F.lit(""))),
            ),
            F.when(F.col("start_line").isNull(), F.lit("missing_start_line")),
        ),
    )
    return out if keep_file else out.drop(*FILE_COLUMNS)


# --- enclosing function ----------------------------------------------------


def window_text(lines: Column, line: Column, last_line: Column, around: int, bare: bool = False) -> Column:
    """struct(start_line, end_line, code) of lines [line - around, last_line + around].

    `bare`: the lines come without their ends.
    """
    n = F.size(lines)
    first = F.greatest(F.lit(1), line - around)
    last = F.least(n, last_line + around)
    shown = F.slice(lines, first, F.greatest(F.lit(0), last - first + 1))
    shown = shown if bare else F.transform(shown, tx.drop_line_end)
    return F.struct(
        first.alias("start_line"),
        last.alias("end_line"),
        F.when(n > 0, F.array_join(shown, "\n")).otherwise(F.lit("")).alias("code"),
    )


def _headed(bugs: DataFrame, search_window: int) -> DataFrame:
    """Bugs with blocks and file columns → + `_h`, the header of the enclosing function.

    The nearest header line at most `search_window` lines above the bug and less indented
    than the bug line. The headers of a file are already listed, so this is a filter on a
    short array.
    """
    start = F.col("start_line")
    lines = F.col("_lines")
    n = F.size(lines)
    bug_line = tx.drop_line_end(F.get(lines, start - 1))
    bug_indent = F.when((start >= 1) & (start <= n), tx.indent_whitespace(bug_line))
    bottom = F.least(start, n)
    top = F.greatest(F.lit(1), bottom - search_window)
    prepared = bugs.withColumns({"_bi": bug_indent, "_bottom": bottom, "_top": top})
    header = F.try_element_at(
        F.filter(
            "_headers",
            lambda h: h["line"].between(F.col("_top"), F.col("_bottom"))
            & (F.col("_bi").isNull() | (h["indent"] < F.col("_bi"))),
        ),
        F.lit(-1),
    )
    return prepared.withColumn("_h", header)


def _anchor_fields(context_window: int) -> list[Column]:
    start = F.col("start_line")
    whole = F.try_element_at("blocks", F.lit(-1))
    return [
        F.lit("function").alias("kind"),
        F.col("_h.name").alias("name"),
        F.col("file_path").alias("def_file"),
        F.col("_h.line").alias("def_line"),
        whole["level"].alias("block_level"),
        whole["indent"].alias("block_indent"),
        F.col("_h.signature").alias("signature"),
        code.class_name(F.col("_h.signature")).alias("class_name"),
        window_text(F.col("_lines"), start, F.coalesce("end_line", "start_line"), context_window).alias("bug_context"),
        F.col("_includes").alias("def_includes"),
    ]


def _has_blocks(bugs: DataFrame) -> Column:
    return F.col("_nested") if "_nested" in bugs.columns else F.coalesce(F.size("blocks"), F.lit(0)) > 0


def anchors(bugs: DataFrame, search_window: int = 200, context_window: int = 6) -> DataFrame:
    """The anchors of `enclosing_function`, one row per bug that has one, a column per field.

    What the reader does not ask for, such as the blocks' texts, is never built.
    """
    found = _headed(bugs, search_window).where(F.col("_h").isNotNull() & _has_blocks(bugs))
    return found.select(*_anchor_fields(context_window))


def enclosing_function(
    bugs: DataFrame, search_window: int = 200, context_window: int = 6
) -> DataFrame:
    """Bugs with blocks and file columns → + `anchor`, null with an error where none is found."""
    found = _headed(bugs, search_window)
    has_blocks = _has_blocks(bugs)
    anchor = F.struct(*_anchor_fields(context_window))
    error = (
        F.when(F.coalesce("file_path", F.lit("")) == "", "Missing file_path in bug metadata.")
        .when(~has_blocks, "Missing blocks; run the block extraction first.")
        .when(
            F.col("_h").isNull(),
            "No function definition found in search window above bug line.",
        )
    )
    return found.withColumn(
        "anchor", F.when(F.col("_h").isNotNull() & has_blocks, anchor)
    ).withColumn("error", F.coalesce(error, "error")).drop("_h", "_bi", "_bottom", "_top", *FILE_COLUMNS)
