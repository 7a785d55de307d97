"""Templates and prompt sections as column expressions."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lintlake.functions.text import language_of, truncate_with_note

# Texts and limits of the call-site section.
NO_CALL_SITES = "// No call sites were discovered for this bug.\n"
SECTION_HEAD = "// Candidate call sites for this bug (each block is one callsite):\n"
DASH = "–"
MAX_CALL_SITES = 20
MIN_CALL_SITES = 3
CALL_SITE_STEP = 5
MAX_PROMPT_CHARS = 24_000
MAX_SECTION_CHARS = 4_000


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill '{name}' holes; '{{' and '}}' are literal braces.

    The template is parsed once on the driver into literals and columns, so a value that
    itself contains '{name}' stays as it is. An unknown name raises KeyError.
    """
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


ISSUE_FIELDS = (
    "issue_key",
    "severity",
    "type",
    "rule",
    "message",
    "file_path",
    "start_line",
    "end_line",
    "code_snippet",
)


def issue_values() -> dict[str, Column]:
    out = {name: _text(name) for name in ISSUE_FIELDS}
    out["creation_date"] = _text("creation_date")
    out["update_date"] = _text("update_date")
    out["code_lang"] = language_of(_text("file_path"))
    # A missing line prints as None in issue prompts.
    for name in ("start_line", "end_line"):
        out[name] = F.coalesce(F.nullif(F.col(name), F.lit(0)).cast("string"), F.lit("None"))
    return out


def bug_values() -> dict[str, Column]:
    out = {name: _text(name) for name in ISSUE_FIELDS}
    for name in ("start_line", "end_line"):
        out[name] = F.coalesce(F.nullif(F.col(name), F.lit(0)).cast("string"), F.lit(""))
    out["context_block"] = context_block(F.col("blocks"))
    return out


def context_block(blocks: Column) -> Column:
    """Second-to-last block, else the only one, under a line naming its level and range."""
    block = F.coalesce(F.try_element_at(blocks, F.lit(-2)), F.try_element_at(blocks, F.lit(-1)))
    text = F.concat(
        F.lit("// Context block (level "),
        block["level"],
        F.lit(", lines "),
        block["start"],
        F.lit(DASH),
        block["end"],
        F.lit(")\n"),
        F.coalesce(block["code"], F.lit("")),
    )
    return F.coalesce(text, F.lit(""))


def format_includes(includes: Column) -> Column:
    return F.array_join(F.filter(includes, lambda line: line != ""), "\n")


def _flag(label: str, c: Column) -> Column:
    return F.concat(
        F.lit(f"// {label}: "), F.when(c, F.lit("True")).when(~c, F.lit("False"))
    )


def _line(label: str, c: Column) -> Column:
    """'// label: value', null (so left out) for a null or empty value."""
    return F.concat(F.lit(f"// {label}: "), F.nullif(c.cast("string"), F.lit("")))


# The labels of a call site and their order.
def format_call_site(site: Column, number: Column, signature: Column) -> Column:
    """One call site as text; a line is present only if its value is."""
    includes = F.nullif(F.coalesce(format_includes(site["includes"]), F.lit("")), F.lit(""))
    snippet = F.nullif(
        F.coalesce(F.nullif(site["context"], F.lit("")), site["code"], F.lit("")), F.lit("")
    )
    bounds = F.concat(
        F.lit("// Context lines: "), site["context_start"], F.lit(DASH), site["context_end"]
    )
    return F.concat_ws(
        "\n",
        F.concat(F.lit("// CALLSITE #"), number),
        _line("File", site["file"]),
        _line("Call line", site["line"]),
        bounds,
        _line("Suspected callee signature", signature),
        _line("Call expression", site["code"]),
        _line("Heuristic score", site["score"]),
        _flag("same_dir", site["same_dir"]),
        _flag("same_top_module", site["same_top_module"]),
        _flag("includes_bug_header", site["includes_bug_header"]),
        F.when(includes.isNotNull(), F.lit("// Includes around callsite:")),
        includes,
        F.when(snippet.isNotNull(), F.lit("// Local call context:")),
        snippet,
    )


def call_site_texts(sites: Column, signature: Column) -> Column:
    return F.transform(sites, lambda s, i: format_call_site(s, i + 1, signature))


def call_sites_section(texts: Column, limit: Column) -> Column:
    """Section for the first `limit` call-site texts, with a note if there are more."""
    total = F.size(texts)
    note = F.concat(
        F.lit("\n\n// NOTE: There are "),
        total,
        F.lit(" callsites in total, but only the first "),
        limit,
        F.lit(" are shown here.\n"),
    )
    return F.when(F.coalesce(total, F.lit(0)) <= 0, F.lit(NO_CALL_SITES)).otherwise(
        F.concat(
            F.lit(SECTION_HEAD),
            F.array_join(F.slice(texts, F.lit(1), limit), "\n\n"),
            F.when(total > limit, note).otherwise(F.lit("")),
        )
    )


def call_site_limits(
    most: int = MAX_CALL_SITES, least: int = MIN_CALL_SITES, step: int = CALL_SITE_STEP
) -> list[int]:
    """20, 15, 10, 5, 3: the limits tried in turn."""
    limits = [most]
    while limits[-1] > least:
        limits.append(max(least, limits[-1] - step))
    return limits


def messages(system: Column, user: Column, extra: Column | None = None) -> Column:
    """Chat messages: array of struct(role, content)."""

    def one(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    base = F.array(one("system", system), one("user", user))
    return base if extra is None else F.concat(base, F.coalesce(extra, F.slice(base, 1, 0)))


def json_text(c: Column, compact: bool = True) -> Column:
    """Struct, array or map → JSON text, nulls kept."""
    options = {"ignoreNullFields": "false"}
    if not compact:
        options["pretty"] = "true"
    return F.to_json(c, options)


def truncated(values: Mapping[str, Column], limit: int = MAX_SECTION_CHARS) -> dict[str, Column]:
    """The values with context block and code snippet cut to `limit` characters."""
    out = dict(values)
    out["context_block"] = truncate_with_note(values["context_block"], limit, "context block")
    out["code_snippet"] = truncate_with_note(values["code_snippet"], limit, "code snippet")
    return out
