"""End-to-end chains: one lazy DataFrame each, from landed lines to exported tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintlake.operators import advice as adv
from lintlake.operators import calls, context, discover, flatten, issues, kpi, prompts
from lintlake.operators.staging import cut_lineage, hand_over
from lintlake.schemas import BLOCK
from lintlake.sources import files, jsonl, sinks


def issue_snippets(
    lines: DataFrame,
    sources: DataFrame,
    context_lines: int = 2,
    max_chars: int = 20_000,
    normalize_tabs: bool = False,
    dedup: bool = True,
) -> DataFrame:
    """Landed lines + source files → issue records with snippet, bad lines as error rows.

    Overlapping fetches land an issue more than once; `dedup` keeps its newest copy. The
    thin records are handed over as a checkpointed table, because the join below reads them
    twice and parsing the landed pages again would cost more.
    """
    order = [c for c in lines.columns if c != "value"]
    records = issues.normalize(jsonl.landed_issues(lines))
    if dedup:
        place = [*order, "pos"]
        known = {"file", "line_no"} <= set(order)
        records = issues.dedup_issues(records, page=place, row_id=place if known else ())
    records = cut_lineage(records)
    return context.snippets(records, sources, context_lines, max_chars, normalize_tabs)


def bug_context(
    bugs: DataFrame,
    sources: DataFrame,
    max_call_sites: int = 20,
    search_window: int = 200,
    context_window: int = 6,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Bug records → + blocks and anchors with ranked call sites, or what `then` makes of them row by row."""
    blocked = context.bug_blocks(bugs, sources, keep_file=True)
    anchored = context.enclosing_function(blocked, search_window, context_window)
    return calls.attach_call_sites(anchored, sources, max_call_sites, context_window, then)


PROMPTS = {
    "issue": prompts.issue_prompts,
    "block": prompts.block_prompts,
    "callsite": prompts.callsite_prompts,
}


def build_prompts(records: DataFrame, template: str, level: str) -> DataFrame:
    """Records + user_prompt; a template with an unknown hole marks every row instead."""
    try:
        built = PROMPTS[level](records, template)
        return built.withColumn("prompt_error", F.lit(None).cast("string"))
    except (KeyError, ValueError) as error:
        return records.withColumns(
            {
                "user_prompt": F.lit(None).cast("string"),
                "prompt_error": F.lit(str(error)),
            }
        )


def choose_issues(
    records: DataFrame,
    stop_after: int | None = None,
    since: object = None,
    until: object = None,
    date_on: str = "creation",
    primary: str = "severity",
    secondary: str | None = "time",
    recent_first: bool = True,
    ties: tuple[str, ...] = ("issue_key",),
) -> DataFrame:
    """Date window, rank, limit."""
    windowed = issues.filter_by_date(records, since, until, date_on)
    return issues.rank_issues(
        windowed,
        stop_after,
        primary=primary,
        secondary=secondary,
        recent_first=recent_first,
        date_on=date_on,
        ties=ties,
    )


def _advised(
    records: DataFrame,
    template: str,
    replies: DataFrame,
    level: str,
    model: str,
    window: Column,
    stop_after: int | None = None,
    date_on: str = "creation",
    primary: str = "severity",
    secondary: str | None = "time",
    recent_first: bool = True,
    ties: Sequence[str] = (),
    rank_before_process: bool = True,
) -> DataFrame:
    place = [c for c in ("file", "line_no", "pos") if c in records.columns]
    ties = list(ties) or place or ["issue_key"]
    chosen = records.where(window)
    if level == "issue":
        chosen = issues.with_priority(chosen)
    built = build_prompts(chosen, template, level)
    if stop_after is not None:
        ranks = issues.rank_columns(primary, secondary, recent_first, date_on) if rank_before_process else {}
        order = [*[(name, desc) for name, (_, desc) in ranks.items()], *[(t, False) for t in ties]]
        keyed = built.withColumns({name: value for name, (value, _) in ranks.items()})
        done = F.col("prompt_error").isNull()
        built = adv.until_processed(keyed, stop_after, order, done).drop(*ranks)
    return adv.attach_advice(built, replies, level, model, "prompt_error")


def advice_run(
    records: DataFrame,
    template: str,
    replies: DataFrame,
    level: str = "issue",
    model: str = "",
    since: object = None,
    until: object = None,
    **choice,
) -> tuple[DataFrame, DataFrame]:
    """(advised records, one-row counters) of one run at a context depth.

    Rows are taken until `stop_after` of them have a prompt; rows whose prompt cannot be
    built are written with their error and do not count. `ties` names ascending columns of
    the input's order; by default the landed place, where the records have it, else the
    issue key. Without `rank_before_process` that order alone decides. The rank goes by
    `primary`, `secondary`, `recent_first` and `date_on` as in `choose_issues`.
    """
    window = issues.in_window(since, until, choice.get("date_on", "creation"))
    written = _advised(records, template, replies, level, model, window, **choice)
    return written, adv.run_counters(records, window, written)


def write_advice_run(
    records: DataFrame,
    template: str,
    replies: DataFrame,
    write: Callable[[DataFrame], None],
    level: str = "issue",
    model: str = "",
    since: object = None,
    until: object = None,
    **choice,
) -> dict[str, int]:
    """`advice_run`, handed to `write`, which must write it once; the counters of that very pass."""
    window = issues.in_window(since, until, choice.get("date_on", "creation"))
    counters = adv.RunCounters()
    seen = counters.reading(records, window)
    write(counters.writing(_advised(seen, template, replies, level, model, window, **choice)))
    return counters.get()


def export_csv(
    spark: SparkSession, jsonl_path: str, csv_path: str, schema: str | None = None, **shape
) -> DataFrame:
    """JSON lines → flat CSV; unreadable lines are kept as rows of their own.

    Without a `schema` the columns are all keys that any record has.
    """
    if schema is None:
        records = jsonl.read_variants_keeping_errors(spark, jsonl_path)
        table = discover.export_table(records, **shape)
    else:
        records = jsonl.read_jsonl_keeping_errors(spark, jsonl_path, schema)
        table = flatten.export_table(records, **shape)
    sinks.write_csv(table, csv_path)
    return table


# What the chain looks at of a bug; all other keys pass through it untouched.
BUG_SCHEMA = (
    "issue_key string, file_path string, start_line int, end_line int, severity string, type string, rule string, "
    "message string, code_snippet string, error string"
)
REST = "_rest"


def landed_blocks(spark: SparkSession, path: str, sources: DataFrame, out_path: str, format: str = "auto") -> None:
    """Landed bugs (a JSON array or JSON lines) → JSON lines, each bug as it came with its `blocks`.

    An `error` is written for bugs that have one, before or now.
    """
    bugs = jsonl.read_records(spark, path, BUG_SCHEMA, format, REST)
    sinks.write_verbatim(context.bug_blocks(bugs, sources), out_path, REST, ["blocks", "error"])


def landed_advice(
    spark: SparkSession, path: str, template: str, replies: DataFrame, out_path: str, level: str = "block",
    format: str = "auto", **choice,
) -> DataFrame:
    """Landed bugs with their context → JSON lines, each as it came with its advice, without `blocks`.

    Returns the counters of the run as one row: read, filtered, processed, written, errors.
    """
    schema = f"{BUG_SCHEMA}, blocks array<{BLOCK}>, creation_date string, update_date string"
    records = jsonl.read_records(spark, path, schema, format, REST)
    gone = ["blocks", "user_prompt", "advice_status"]

    def write(advised: DataFrame) -> None:
        sinks.write_verbatim(advised, out_path, REST, [adv.ADVICE_COLUMN[level]], gone)

    counters = write_advice_run(records, template, replies, write, level, **choice)
    names = ("read", "filtered", "processed", "written", "errors")
    return spark.range(1).select(*[F.lit(counters[n]).alias(n) for n in names])


def bi_tables(measures: DataFrame, gate: DataFrame, issue_docs: DataFrame) -> dict[str, DataFrame]:
    """Project documents → the three BI tables by name.

    The issue documents are handed over, since the join below reads them three times and
    parsing what they come from would cost more.
    """
    issue_docs = hand_over(issue_docs.select("project", "issues", "components"), "issue-documents")
    # A component key is looked up in its own document: folders may share keys.
    rows = issue_docs.select(F.col("project").alias("document"), F.explode("issues").alias("i"))
    components = issue_docs.select(
        F.col("project").alias("document"), F.posexplode("components").alias("ordinal", "c")
    ).select("document", "ordinal", "c.*")
    return {
        "measures": kpi.measures_long(measures),
        "quality_gate": kpi.quality_conditions(gate),
        "severe_issues": issues.severe_table(rows.select("document", "i.*"), components, by=["document"]),
    }


def kpi_audits(measures: DataFrame, gate: DataFrame, issue_docs: DataFrame) -> dict[str, DataFrame]:
    """Project documents → measures, issue and gate audits by name."""
    # The folder names the project; an issue's own project field may differ.
    flat = issue_docs.select("project", F.explode("issues").alias("i")).select(
        "project", "i.key", "i.issue_key", "i.type", "i.severity", "i.message"
    )
    keyed = flat.withColumn("issue_key", F.coalesce("key", "issue_key"))
    return {
        "measures_audit": kpi.kpi_audit(kpi.measures_long(measures)),
        "issues_audit": kpi.issue_matrix(flat, by=["project"]),
        "issue_examples": issues.example_messages(keyed, by=["project"]),
        "gate_audit": kpi.gate_audit(kpi.quality_conditions(gate)),
    }


def project_report(root: str, spark: SparkSession, out_dir: str, project: str | None = None) -> dict:
    """Read the project folders under `root`, write BI tables and audits; name → path."""
    documents = files.read_project_documents(spark, root, project)
    audits = kpi_audits(*documents)
    written = sinks.write_tables({**bi_tables(*documents), **audits}, out_dir)
    texts = f"{out_dir.rstrip('/')}/measures_audit_text"
    sinks.write_project_texts(kpi.audit_texts(audits["measures_audit"]), texts)
    return {**written, "measures_audit_text": texts}
