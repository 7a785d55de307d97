"""Review prompts at the three context depths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintlake.functions import render as rd


def issue_prompts(issues: DataFrame, template: str, out: str = "user_prompt") -> DataFrame:
    """Issues with snippet → prompt text."""
    return issues.withColumn(out, rd.render(template, rd.issue_values()))


def block_prompts(bugs: DataFrame, template: str, out: str = "user_prompt") -> DataFrame:
    """Bugs with blocks → prompt text."""
    return bugs.withColumn(out, rd.render(template, rd.bug_values()))


# Where a bug's own list of call sites may stand, and what a prompt shows of a site.
OWN_LISTS = ("call_sites", "callsites", "callsite_blocks")
SITE_FIELDS = {
    "file": "string", "line": "long", "code": "string", "context_start": "long", "context_end": "long", "context": "string",
    "includes": "array<string>", "includes_bug_header": "boolean", "same_dir": "boolean", "same_top_module": "boolean", "score": "long",
}


def _sites(sites: Column, kind: T.DataType) -> Column:
    """A list of call sites with all fields of SITE_FIELDS; those it does not have are null."""
    known = kind.elementType.names if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) else []
    if not known:
        return F.lit(None)
    one = lambda s: F.struct(
        *[(s[f] if f in known else F.lit(None)).cast(t).alias(f) for f, t in SITE_FIELDS.items()]
    )
    return F.when(F.size(sites) > 0, F.transform(sites, one))


def _site_list(bugs: DataFrame) -> tuple[Column, Column]:
    """(call sites, signature): the first list of the bug's own that is not empty, else those of
    the first anchor that has some. A list of the bug's own names no signature."""
    own = [_sites(F.col(c), bugs.schema[c].dataType) for c in OWN_LISTS if c in bugs.columns]
    kind = f"array<struct<{','.join(f'{f}:{t}' for f, t in SITE_FIELDS.items())}>>"
    first = F.coalesce(*own, F.lit(None).cast(kind))
    if "anchors" not in bugs.columns:
        return first, F.lit("")
    anchors = bugs.schema["anchors"].dataType.elementType
    anchor = F.get(F.filter("anchors", lambda a: F.size(a["call_sites"]) > 0), F.lit(0))
    signature = F.coalesce(F.nullif(anchor["signature"], F.lit("")), anchor["name"], F.lit(""))
    sites = F.coalesce(first, _sites(anchor["call_sites"], anchors["call_sites"].dataType))
    return sites, F.when(first.isNull() & anchor.isNotNull(), signature).otherwise(F.lit(""))


def callsite_prompts(
    bugs: DataFrame,
    template: str,
    out: str = "user_prompt",
    max_chars: int = rd.MAX_PROMPT_CHARS,
    max_callsites: int = rd.MAX_CALL_SITES,
    min_callsites: int = rd.MIN_CALL_SITES,
    step: int = rd.CALL_SITE_STEP,
) -> DataFrame:
    """Bugs with blocks and call sites → prompt text within a size budget.

    Call sites are the bug's own (`OWN_LISTS`), else those of its anchors.
    The largest call-site limit whose prompt fits is taken; if none fits, the smallest is
    used with context and code cut. The length of a prompt is the length of its fixed
    parts plus that of the section, so the candidates are measured without being rendered
    and only the chosen one is built. `callsite_limit` reports the choice.
    """
    limits = rd.call_site_limits(max_callsites, min_callsites, step)
    sites, signature = _site_list(bugs)
    prepared = (
        bugs.withColumns({"_a": sites, "_sig": signature})
        .withColumn("_texts", rd.call_site_texts(F.col("_a"), F.col("_sig")))
        .withColumn("_ctx", rd.context_block(F.col("blocks")))
    )
    values = rd.bug_values() | {"context_block": F.col("_ctx")}
    holes = sum(1 for _, name, _, _ in rd.string.Formatter().parse(template)
                if name == "call_sites_section")
    fixed = F.length(rd.render(template, values | {"call_sites_section": F.lit("")}))
    sections = F.transform(
        F.array(*[F.lit(n) for n in limits]),
        lambda n: F.struct(
            n.alias("n"), rd.call_sites_section(F.col("_texts"), n).alias("section")
        ),
    )
    fitting = F.filter(
        "_sections", lambda s: F.col("_fixed") + F.length(s["section"]) * holes <= max_chars
    )
    chosen = (
        prepared.withColumn("_fixed", fixed)
        .withColumn("_sections", sections)
        .withColumn("_fit", F.get(fitting, F.lit(0)))
        .withColumn("_pick", F.coalesce("_fit", F.try_element_at("_sections", F.lit(-1))))
    )
    section = {"call_sites_section": F.col("_pick.section")}
    prompt = F.when(F.col("_fit").isNotNull(), rd.render(template, values | section)).otherwise(
        rd.render(template, rd.truncated(values) | section)
    )
    return (
        chosen.withColumn(out, prompt)
        .withColumn("callsite_limit", F.col("_pick.n"))
        .drop("_a", "_sig", "_texts", "_ctx", "_fixed", "_sections", "_fit", "_pick")
    )


def project_prompts(documents: DataFrame, template: str, compact: bool = True) -> DataFrame:
    """(project, text of a JSON document) → prompt with {project} and {json} filled in."""
    parsed = F.try_parse_json("text")
    shown = F.to_json(parsed) if compact else F.to_json(parsed, {"pretty": "true"})
    return documents.withColumn(
        "user_prompt",
        rd.render(template, {"project": F.col("project"), "json": F.coalesce(shown, "text")}),
    )
