"""Registered queries: every operator over the shared tables, whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lintlake.functions import markup, values
from lintlake.functions import render as rd
from lintlake.functions import text as tx
from lintlake.operators import advice as adv
from lintlake.operators import (
    call_index,
    calls,
    components,
    context,
    edges,
    flatten,
    issues,
    kpi,
    prompts,
    staging,
)
from lintlake.plans import chains, views
from lintlake.session import tune
from lintlake.sources import files, jsonl, sinks

ISSUE_TEMPLATE = (
    "Review {{one}} finding.\nKey: {issue_key} ({severity}/{type}, rule {rule})\n"
    "Message: {message}\nWhere: {file_path}:{start_line}-{end_line}, "
    "made {creation_date}, changed {update_date}\nCode ({code_lang}):\n{code_snippet}\n"
)
BLOCK_TEMPLATE = (
    "Bug {issue_key} [{severity}] {rule}: {message}\nAt {file_path} {start_line}..{end_line}\n"
    "Snippet:\n{code_snippet}\nAround it:\n{context_block}\n"
)
CALLSITE_TEMPLATE = BLOCK_TEMPLATE + "Callers:\n{call_sites_section}\n"

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; sessions are tuned on entry."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    _REGISTRY[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- issues ------------------------------------------------------------------


@query
def rank_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 open issues to look at first, with their priority score."""
    open_ = issues.with_priority(issues.open_issues(views.issues(spark, sf_dir)))
    return issues.rank_issues(open_, limit=100, ties=("seq",)).select(
        "issue_key", "project", "severity", "creation_date", "priority_score"
    )


@query
def rank_issues_oldest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time first, oldest first, on creation else update date, inside an inclusive window."""
    chosen = chains.choose_issues(
        views.issues(spark, sf_dir),
        stop_after=50,
        since="1996-02-01",
        until="1996-09-30T12:00:00Z",
        date_on="auto",
        primary="time",
        secondary="severity",
        recent_first=False,
        ties=("seq",),
    )
    return chosen.select("issue_key", "severity", "creation_date", "update_date")


@query
def filter_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything up to a date; unreadable dates count as 1970."""
    return issues.filter_by_date(
        views.issues(spark, sf_dir), until="1997-06-30", date_on="update"
    ).select("issue_key", "update_date")


@query
def search_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.search_issues(
        views.issues(spark, sf_dir),
        statuses="OPEN, CONFIRMED",
        resolved=False,
        severities="BLOCKER,critical,MAJOR",
        types="BUG,VULNERABILITY",
        component_keys="proj1,proj2,proj3",
        created_after="1996-01-01",
        created_before="1999-01-01T00:00:00Z",
    ).select("issue_key", "project", "severity", "type", "status", "creation_date")


@query
def bugs_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.bugs_only(views.issues(spark, sf_dir), statuses="OPEN").select(
        "issue_key", "type", "status"
    )


@query
def open_minimal_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open issues with a line, with the texts of their rule."""
    raw = views.issues(spark, sf_dir).selectExpr(
        "*",
        "start_line AS line",
        "CASE WHEN seq % 3 = 0 THEN NULL ELSE start_line END AS text_start",
        "CASE WHEN seq % 3 = 0 THEN NULL ELSE start_line + seq % 4 END AS text_end",
        "CASE WHEN seq % 5 = 0 THEN NULL ELSE concat('src/f', seq % 97) END AS page_path",
    )
    rules = issues.rule_texts(views.rules(spark, sf_dir))
    return issues.minimal_records(
        issues.open_issues(raw), rules, extras=True, snippet=False
    )


@query
def since_previous_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.since_previous_analysis(
        views.issues(spark, sf_dir), views.analyses(spark, sf_dir)
    ).select("issue_key", "project", "creation_date")


@query
def dedup_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pages: a third of all rows repeat one issue, every fourth is landed twice."""
    first = views.issues(spark, sf_dir).selectExpr(
        "CASE WHEN seq % 3 = 0 THEN 'ISS-0' ELSE issue_key END AS issue_key",
        "severity", "creation_date", "update_date", "1 AS page_no", "seq",
    )
    again = first.where("seq % 4 = 0").selectExpr(
        "issue_key", "'MAJOR' AS severity", "creation_date", "update_date", "2 AS page_no", "seq"
    )
    place = ["page_no", "seq"]
    return issues.dedup_issues(first.unionByName(again), page=place, row_id=place)


@query
def path_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own path, page path, component tail; and the parts of the resolved path."""
    df = views.issues(spark, sf_dir).selectExpr(
        "issue_key",
        "component",
        "CASE seq % 4 WHEN 0 THEN concat('own/', seq % 9, '/A', seq, '.HPP') WHEN 1 THEN '' END AS own",
        "CASE WHEN seq % 3 = 0 THEN concat('page', seq % 8, '.tar.gz') END AS page_path",
    )
    path = F.col("file_path")
    return df.select(
        "issue_key",
        issues.resolve_path(F.col("own"), F.col("page_path"), F.col("component")).alias("file_path"),
    ).select(
        "issue_key",
        "file_path",
        tx.base_name(path).alias("base_name"),
        tx.dir_name(path).alias("dir_name"),
        tx.top_module(path).alias("top_module"),
        tx.file_suffix(path).alias("suffix"),
        tx.file_stem(path).alias("stem"),
        tx.language_of(path).alias("language"),
    )


@query
def component_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.component_index(
        views.components(spark, sf_dir), include_languages=("cpp", "cs", "py")
    )


@query
def severe_issue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.issues(spark, sf_dir).selectExpr(
        "issue_key AS key", "rule", "severity", "component", "project",
        "cast(start_line AS string) AS line", "message", "effort", "debt",
        "creation_date AS creationDate", "update_date AS updateDate", "type",
        "CASE WHEN seq % 2 = 0 THEN 'MAIN' END AS scope",
        "CASE WHEN seq % 3 = 0 THEN NULL ELSE named_struct('startLine', cast(start_line AS string),"
        " 'endLine', concat(' ', seq % 90, ' '), 'startOffset', '1_0', 'endOffset', '12.5') END"
        " AS textRange",
    )
    return issues.severe_table(raw, views.components(spark, sf_dir))


@query
def bi_severe_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents that share component keys: a key is looked up in its own document."""
    raw = views.issues(spark, sf_dir).selectExpr(
        "issue_key AS key", "rule", "severity", "component", "project", "cast(start_line AS string) AS line",
        "message", "effort", "debt", "creation_date AS creationDate", "update_date AS updateDate", "type",
        "cast(NULL AS string) AS scope", "concat('doc', seq % 2) AS document",
        "cast(NULL AS struct<startLine:string,endLine:string,startOffset:string,endOffset:string>) AS textRange",
    )
    known = views.components(spark, sf_dir).withColumn("document", F.expr("concat('doc', ordinal % 2)"))
    return issues.severe_table(raw, known, by=["document"]).select(
        "issue_key", "component", "component_name", "component_path", "component_enabled"
    )


@query
def minimal_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open issues with the snippet of their source payload: the core of a line, or all lines."""
    raw = views.issues(spark, sf_dir).selectExpr(
        "*", "start_line AS line", "start_line AS text_start",
        "CASE WHEN seq % 2 = 0 THEN start_line ELSE start_line + 1 END AS text_end",
        "'' AS page_path", "concat(message, '\\n second ') AS payload",
    )
    snippet = issues.snippet_text(
        F.col("payload"), F.col("text_start"), F.col("text_end"),
        F.expr("cast(seq % 31 - 2 AS int)"), F.expr("cast(seq % 47 AS int)"),
    )
    return issues.minimal_records(
        issues.open_issues(raw).withColumn("code_snippet", snippet),
        issues.rule_texts(views.rules(spark, sf_dir)), extras=True,
    ).select("issue_key", "path", "start_line", "end_line", "code_snippet")


@query
def issues_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = issues.order_by_date(views.issues(spark, sf_dir), "update_date", asc=False)
    return found.select("issue_key", "update_date")


@query
def component_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = components.component_index(
        views.components(spark, sf_dir), include_languages=("cpp", "cs", "py")
    )
    return components.all_paths(index)


@query
def flow_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flows(spark, sf_dir).select(
        "issue_key", issues.has_flow(F.col("flows"), F.col("locations")).alias("has_flow")
    )


@query
def flow_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.flow_summary(_flows(spark, sf_dir))


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.issues(spark, sf_dir).selectExpr(
        "issue_key",
        "CASE seq % 4 WHEN 0 THEN array(seq) WHEN 1 THEN slice(array(seq), 1, 0) END AS flows",
        "CASE seq % 5 WHEN 0 THEN array(seq, seq) WHEN 1 THEN slice(array(seq), 1, 0) END AS locations",
    )


@query
def issue_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.example_messages(views.issues(spark, sf_dir))


# --- landed JSON ---------------------------------------------------------------


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 50 orders as JSON lines, every 50th order as a bare issue, and broken lines."""
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "*", "cast(floor(o_orderkey / 50) AS bigint) AS page_no"
    )
    issue = F.expr(
        "named_struct('key', concat('ISS-', o_orderkey), 'rule', concat('cpp:S', o_orderkey % 30),"
        " 'component', concat('proj', o_custkey % 12, ':c', o_orderkey % 20), 'project',"
        " concat('proj', o_custkey % 12), 'message', 'a \"quoted\" text', 'tags', array('t', 'u'),"
        " 'textRange', CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE named_struct('startLine',"
        " o_orderkey % 5, 'endLine', CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 + 3 END) END,"
        " 'start_line', CASE WHEN o_orderkey % 4 = 0 THEN 'x' WHEN o_orderkey % 4 = 1 THEN '7' END)"
    )
    component = F.expr(
        "named_struct('key', concat('proj', o_custkey % 12, ':c', o_orderkey % 20), 'path',"
        " CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat('p', o_orderkey, '.cpp') END)"
    )
    # At most 50 orders share a page number.
    pages = (
        orders.where("o_orderkey % 50 <> 49")
        .groupBy("page_no")
        .agg(
            F.array_sort(F.collect_list(F.struct("o_orderkey", issue.alias("i"), component.alias("c"))))
            .alias("rows")
        )
        .select(
            "page_no",
            F.to_json(
                F.struct(
                    F.transform("rows", lambda r: r["i"]).alias("issues"),
                    F.transform("rows", lambda r: r["c"]).alias("components"),
                    F.struct(F.lit(50).alias("pageSize"), (F.size("rows") * 2).alias("total")).alias(
                        "paging"
                    ),
                )
            ).alias("value"),
        )
    )
    bare = orders.where("o_orderkey % 50 = 49").select(
        "page_no",
        F.to_json(
            F.struct(
                F.concat(F.lit("ISS-"), "o_orderkey").alias("issue_key"),
                F.lit("r").alias("rule_key"),
                F.lit("m").alias("rule_message"),
                F.concat(F.lit("q/"), "o_orderkey").alias("path"),
                F.lit(3).alias("start_line"),
            )
        ).alias("value"),
    )
    odd = orders.where("o_orderkey % 100 = 0").select(
        "page_no",
        F.expr(
            "CASE o_orderkey % 300 WHEN 0 THEN concat('{\"key\": ', o_orderkey) "
            "WHEN 100 THEN concat('[', o_orderkey, ']') ELSE concat('{\"id\":', o_orderkey, '}') END"
        ).alias("value"),
    )
    return pages.unionByName(bare).unionByName(odd)


@query
def ingest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.normalize(jsonl.landed_issues(landed_lines(spark, sf_dir))).select(
        "page_no", "issue_key", "project", "component", "rule", "message",
        F.array_join("tags", ",").alias("tags"), "file_path", "start_line", "end_line",
        F.col("_raw").alias("raw_line"), "error",
    )


@query
def fetch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.page_counters(jsonl.landed_pages(landed_lines(spark, sf_dir)))


# --- KPIs --------------------------------------------------------------------------


@query
def severe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.severe_count(
        views.issues(spark, sf_dir).withColumn("severity", F.upper("severity")), "1996-06-01"
    )


@query
def project_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.project_facet(views.issues(spark, sf_dir))


@query
def issue_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.issue_matrix(
        views.issues(spark, sf_dir).select("type", F.upper("severity").alias("severity"))
    )


@query
def project_issue_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.issue_matrix(
        views.issues(spark, sf_dir).select("project", "type", F.upper("severity").alias("severity")),
        by=["project"],
    )


@query
def project_issue_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.example_messages(views.issues(spark, sf_dir), by=["project"])


@query
def kpi_audit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.audit_texts(kpi.kpi_audit(views.measures(spark, sf_dir)))


@query
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.batch_summary(
        views.issues(spark, sf_dir).withColumn("severity", F.upper("severity")),
        views.gates(spark, sf_dir),
    )


def _measure_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.schemas import MEASURES_DOCUMENT

    docs = _table(spark, sf_dir, "part").selectExpr(
        "concat('proj', p_partkey % 12) AS project", f"{views.MEASURE_DOC} AS doc"
    )
    return docs.select("project", F.from_json("doc", MEASURES_DOCUMENT).alias("d")).select(
        "project", "d.*"
    )


def _gate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lintlake.schemas import GATE_DOCUMENT

    docs = _table(spark, sf_dir, "customer").selectExpr(
        "concat('proj', c_custkey % 12) AS project", f"{views.GATE_DOC} AS doc"
    )
    return docs.select("project", F.from_json("doc", GATE_DOCUMENT).alias("d")).select(
        "project", "d.*"
    )


@query
def measures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.measures_long(_measure_documents(spark, sf_dir))


@query
def quality_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.quality_conditions(_gate_documents(spark, sf_dir))


@query
def kpi_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.kpi_audit(views.measures(spark, sf_dir))


@query
def project_kpi_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPI audit of measure documents in all their shapes."""
    return kpi.kpi_audit(kpi.measures_long(_measure_documents(spark, sf_dir)))


@query
def gate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.gate_audit(kpi.quality_conditions(_gate_documents(spark, sf_dir)))


# --- source context -------------------------------------------------------------------


@query
def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.source_lines(views.source_files(spark, sf_dir))


@query
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.snippets(
        views.located_issues(spark, sf_dir),
        views.source_files(spark, sf_dir),
        context_lines=2,
        normalize_tabs=True,
    )


@query
def include_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Include block of every file, and whether it names the header of the next-but-six file."""
    feats = context.file_features(views.source_files(spark, sf_dir))
    from lintlake.functions import code

    return feats.select(
        "file_path",
        F.size("_includes").alias("n_lines"),
        F.array_join("_includes", "\n").alias("include_text"),
        code.includes_header(
            F.col("_includes"), F.regexp_extract(tx.file_stem(F.col("file_path")), r"d\d", 0)
        ).alias("names_header"),
    )


@query
def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = context.bug_blocks(views.bugs(spark, sf_dir), views.source_files(spark, sf_dir))
    return nested.select(
        "issue_key", "file_path", "error", F.explode_outer("blocks").alias("b")
    ).select(
        "issue_key",
        "error",
        F.col("b.level").alias("level"),
        F.col("b.indent").alias("indent"),
        F.col("b.start").alias("start_no"),
        F.col("b.end").alias("end_no"),
        F.col("b.code").alias("code"),
    )


def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.bug_blocks(
        views.bugs(spark, sf_dir), views.source_files(spark, sf_dir), keep_file=True
    )


def _anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.enclosing_function(_blocked(spark, sf_dir))


@query
def enclosing_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anchored(spark, sf_dir).select(
        "issue_key",
        "error",
        F.col("anchor.name").alias("name"),
        F.col("anchor.class_name").alias("class_name"),
        F.col("anchor.def_line").alias("def_line"),
        F.col("anchor.signature").alias("signature"),
        F.col("anchor.block_level").alias("block_level"),
        F.col("anchor.block_indent").alias("block_indent"),
        F.array_join("anchor.def_includes", "\n").alias("def_includes"),
    )


@query
def bug_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anchored(spark, sf_dir).where("anchor is not null").select(
        "issue_key",
        F.col("anchor.bug_context.start_line").alias("start_no"),
        F.col("anchor.bug_context.end_line").alias("end_no"),
        F.col("anchor.bug_context.code").alias("code"),
    )


@query
def call_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best 20 call sites of every enclosing function."""
    anchors = context.anchors(_blocked(spark, sf_dir))
    return calls.rank_call_sites(anchors, views.source_files(spark, sf_dir), 20).withColumn(
        "includes", F.array_join("includes", "\n")
    )


@query
def indexed_call_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a kept index: built over older sources, brought up to date, searched without a source."""
    folder = _landing(spark, "calls")
    sources = views.source_files(spark, sf_dir)
    place = F.pmod(F.crc32("file_path"), F.lit(4))
    older = sources.where(place != 1).withColumn("text", F.when(place == 2, F.concat(F.lit("old(1);\n"), "text")).otherwise(F.col("text")))
    gone = sources.limit(1).select(F.lit("gone/file.cpp").alias("file_path"), F.lit("fn1(x);\nfn2(x);").alias("text"))
    call_index.update(older.unionByName(gone), folder)
    call_index.update(sources, folder)
    anchors = context.anchors(_blocked(spark, sf_dir))
    found = call_index.rank_call_sites(staging.hand_over(calls.profiles(anchors), "profiles"), folder)
    return found.withColumn("includes", F.array_join("includes", "\n"))


@query
def all_call_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call site, without a limit, counted per function and score."""
    anchors = context.anchors(_blocked(spark, sf_dir))
    counted = calls.count_call_sites(anchors, views.source_files(spark, sf_dir))
    return counted.groupBy("name", "class_name", "score").agg(F.sum("n").alias("n"))


@query
def dependency_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.all_edges(views.source_files(spark, sf_dir))


@query
def edge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.edge_counts(views.source_files(spark, sf_dir))


@query
def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.symbols(views.source_files(spark, sf_dir))


# --- prompts and advice -------------------------------------------------------------------


@query
def prompt_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.issues(spark, sf_dir).selectExpr(
        "*", "component AS file_path", "start_line AS end_line", "rule AS code_snippet"
    )
    return prompts.issue_prompts(found, ISSUE_TEMPLATE).select("issue_key", "user_prompt")


@query
def prompt_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = context.bug_blocks(views.bugs(spark, sf_dir), views.source_files(spark, sf_dir))
    return prompts.block_prompts(nested, BLOCK_TEMPLATE).select("issue_key", "user_prompt")


@query
def prompt_callsite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete chain: blocks, anchors, call sites, prompt within 24,000 characters."""

    def written(deep: DataFrame) -> DataFrame:
        return prompts.callsite_prompts(deep, CALLSITE_TEMPLATE).select(
            "issue_key", "error", "callsite_limit", "user_prompt"
        )

    return chains.bug_context(views.bugs(spark, sf_dir), views.source_files(spark, sf_dir), then=written)


@query
def advice_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies as JSON, with a closed fence, an open fence, or plain."""
    replies = (
        _table(spark, sf_dir, "conversations")
        .where("role = 'assistant'")
        .withColumn("form", F.expr("(conv_id + turn) % 5"))
        .withColumn("code", F.expr("concat('x = ', conv_id, ';')"))
    )
    raw = (
        F.when(F.col("form") == 0, F.to_json(F.struct(F.col("text").alias("explanation"),
                                                      F.col("code").alias("code_update"))))
        .when(F.col("form") == 1, F.to_json(F.struct(F.lit("").alias("explanation"),
                                                     F.col("text").alias("reasoning"),
                                                     F.col("code").alias("patch"))))
        .when(F.col("form") == 2, F.concat(F.lit("\n "), "text", F.lit("\n```cpp\n"), "code",
                                           F.lit("\n```\nand ```more```")))
        .when(F.col("form") == 3, F.concat("text", F.lit(" ```\n"), "code", F.lit(" \n")))
        .otherwise(F.concat(F.lit(" "), "text", F.lit("\t\n")))
    )
    return replies.select("conv_id", "turn", markup.advice_parts(raw).alias("p")).select(
        "conv_id", "turn", "p.explanation", "p.code_update"
    )


@query
def strip_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = _table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.expr(
            "CASE (conv_id + turn) % 4 WHEN 0 THEN concat('\\n```json\\n', text, '\\n``` tail') "
            "WHEN 1 THEN concat('```', text) WHEN 2 THEN concat(text, '```a```') "
            "ELSE concat('  ', text, '  ') END"
        ).alias("framed"),
    )
    return framed.select("conv_id", "turn", markup.strip_fence(F.col("framed")).alias("content"))


def _advised(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.issues(spark, sf_dir).withColumn(
        "prompt_error", F.expr("CASE WHEN seq % 29 = 0 THEN 'no hole' END")
    )
    scored = issues.with_priority(found).withColumn(
        "_sev", values.severity_weight(F.col("severity"))
    ).withColumn("_at", values.epoch_seconds(F.col("creation_date"), F.col("update_date")))
    chosen = adv.until_processed(
        scored,
        500,
        [("_sev", True), ("_at", True), ("seq", False)],
        F.col("prompt_error").isNull(),
    )
    replies = views.issues(spark, sf_dir).where("seq % 4 <> 0").selectExpr(
        "issue_key", "CASE WHEN seq % 2 = 0 THEN 'm-2' END AS model",
        "concat('Explain ', seq, ' ```\\nfix ', seq, '\\n```') AS raw",
    )
    return adv.attach_advice(chosen, replies, "issue", "m-1", "prompt_error")


@query
def advice_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 500 promptable issues (and the unpromptable ones among them) with their reply."""
    advice = F.col("copilot_advice")
    return _advised(spark, sf_dir).select(
        "issue_key", "advice_status", "priority_score",
        advice["model"].alias("model"),
        advice["explanation"].alias("explanation"),
        advice["code_update"].alias("code_update"),
        advice["error"].alias("error"),
    )


@query
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = views.issues(spark, sf_dir)
    return adv.run_counters(found, issues.in_window(since="1996-01-01"), _advised(spark, sf_dir))


def _run_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All issues, and replies; some keys have two."""
    found = views.issues(spark, sf_dir).selectExpr(
        "*", "component AS file_path", "start_line AS end_line", "rule AS code_snippet"
    )
    replies = found.where("seq % 4 <> 0").selectExpr(
        "issue_key", "'m-2' AS model", "'2024-01-02' AS run_ts", "concat('Explain ', seq, ' ```\\nfix\\n```') AS raw"
    )
    older = replies.where("crc32(issue_key) % 2 = 0").withColumns({"run_ts": F.lit("2024-01-01"), "raw": F.lit("old")})
    return found, replies.unionByName(older)


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run over all issues since 1996 that stops at 500 prompts."""
    records, replies = _run_inputs(spark, sf_dir)
    return chains.advice_run(
        records, ISSUE_TEMPLATE, replies, "issue", "m-1", since="1996-01-01", stop_after=500, ties=("seq",)
    )


@query
def advice_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    advice = F.col("copilot_advice")
    return _run(spark, sf_dir)[0].select(
        "issue_key", "advice_status", "priority_score", advice["model"].alias("model"),
        advice["explanation"].alias("explanation"), advice["error"].alias("error"),
    )


@query
def advice_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1]


@query
def advice_run_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run written as JSON lines, counted by the pass that writes it; `landed` rows are read back."""
    path = _landing(spark, "advice")
    records, replies = _run_inputs(spark, sf_dir)
    counters = chains.write_advice_run(
        records, ISSUE_TEMPLATE, replies, lambda advised: sinks.write_jsonl(advised, path), "issue", "m-1",
        since="1996-01-01", stop_after=500, ties=("seq",),
    )
    landed = jsonl.read_jsonl(spark, path).count()
    return spark.range(1).select(*[F.lit(n).alias(c) for c, n in {**counters, "landed": landed}.items()])


# --- text and export ------------------------------------------------------------------------


@query
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select(
        "page_id", markup.strip_html(F.col("html")).alias("plain")
    )


@query
def core_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.issues(spark, sf_dir).select(
        "issue_key",
        markup.core_slice(
            F.col("message"),
            F.expr("cast(seq % 31 - 2 AS int)"),
            F.expr("cast(seq % 47 AS int)"),
        ).alias("core"),
    )


@query
def scalar_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, duration and date texts of every order."""
    df = views.issues(spark, sf_dir).selectExpr(
        "*",
        "CASE seq % 7 WHEN 0 THEN concat(' ', seq, ' ') WHEN 1 THEN concat(seq, '.5') "
        "WHEN 2 THEN concat(seq, ',25') WHEN 3 THEN concat('1_', seq % 100) WHEN 4 THEN concat('-', seq) "
        "WHEN 5 THEN concat(seq, 'd') ELSE '' END AS number_text",
    )
    return df.select(
        "issue_key",
        values.to_int(F.col("number_text")).alias("as_int"),
        values.to_float(F.col("number_text")).alias("as_float"),
        values.effort_minutes(F.col("effort")).alias("minutes"),
        values.colon_offset(F.col("creation_date")).alias("iso_date"),
        values.epoch_seconds(F.col("creation_date"), F.col("update_date"), "auto").alias("epoch"),
        values.severity_weight(F.col("severity")).alias("weight"),
        values.format_stamp(values.parse_stamp(F.col("update_date"))).alias("stamp"),
    )


@query
def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("type"),
        "value",
        F.from_json("props", "struct<k:int>").alias("props"),
        F.array("user_id").alias("users"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN event_id % 3 = 0 END").alias("flag"),
    )
    return flatten.export_table(nested, text_columns=("props.note",))


@query
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are new or differ from what was published before."""
    cols = ["issue_key", "severity", "status", "effort"]
    current = views.issues(spark, sf_dir).select(*cols)
    before = views.issues(spark, sf_dir).where("seq % 3 <> 0").selectExpr(
        "issue_key", "severity", "CASE WHEN seq % 7 = 0 THEN 'REOPENED' ELSE status END AS status",
        "effort",
    )
    published = before.withColumn("content_hash", sinks.row_hash(cols))
    return sinks.changed_rows(current, published, ["issue_key"], cols)


@query
def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source payloads, chat messages and reply payloads of every turn."""
    turns = _table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "text",
        "CASE WHEN turn % 2 = 0 THEN to_json(named_struct('sources', array(named_struct('code', text), "
        "named_struct('code', 'x')))) ELSE concat('\\n', text, '\\n\\n') END AS payload",
        "CASE WHEN (conv_id + turn) % 2 = 0 THEN to_json(named_struct('choices', array(named_struct('message', "
        "named_struct('content', text))))) ELSE text END AS reply",
    )
    return turns.select(
        "conv_id", "turn",
        markup.source_payload_text(F.col("payload")).alias("source_text"),
        markup.reply_text(F.col("reply")).alias("reply_text"),
        rd.json_text(rd.messages(F.lit("sys"), F.col("text"))).alias("chat"),
    )


def _landing(spark: SparkSession, name: str) -> str:
    """A new folder where all executors can write."""
    return staging.new_folder(spark, name)


@query
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, written twice over (the second time appended), with broken lines between."""
    path = _landing(spark, "jsonl")
    events = _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    sinks.write_jsonl(events, path)
    broken = events.where("event_id % 10 = 0").selectExpr("concat('{\"event_id\": ', event_id) AS value")
    broken.write.mode("append").text(path)
    sinks.write_jsonl(events.where("event_id % 3 = 0"), path, mode="append")
    kept = jsonl.read_jsonl_keeping_errors(spark, path, "event_id long, event_type string, value double")
    return kept.select("event_id", "event_type", "value", "_parse_error", "_raw_line")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as CSV with quotes, line ends and a byte-order mark, read back."""
    path = _landing(spark, "csv")
    turns = _table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "concat('\"', role, '\", ', text, '\\n.') AS said"
    )
    sinks.write_csv(turns, path)
    return files.read_csv(spark, path).selectExpr("cast(conv_id AS bigint) AS conv_id", "cast(turn AS int) AS turn", "said")


@query
def archived_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archived runs, replayed: the newest row of every issue and its run."""
    path = _landing(spark, "archive")
    found = views.issues(spark, sf_dir)
    sinks.archive(found.select("issue_key", "severity"), path, "p", "issue", "20240101")
    again = found.where("seq % 3 = 0").selectExpr("issue_key", "concat('was ', severity) AS severity")
    sinks.archive(again, path, "p", "issue", "20240201")
    back = spark.read.schema(
        "issue_key string, severity string, project_key string, level string, run_ts string"
    ).json(path)
    rows = back.where("project_key = 'p' AND level = 'issue'").select("issue_key", "severity", "run_ts")
    return issues.best_row(rows, ["issue_key"], [F.col("run_ts")], last=True)


@query
def export_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose keys differ by row, as JSON lines with broken ones between → CSV, read back.

    `who` holds an object, a text or a number; `who.last` is a key of its own in some records.
    """
    path, out = _landing(spark, "unknown"), _landing(spark, "unknown-csv")
    views.odd_records(spark, sf_dir).write.text(path)
    chains.export_csv(spark, path, out, text_columns=("note",))
    back = files.read_csv(spark, out)
    return back.drop("_line_no").select(
        *[F.coalesce(f"`{c}`", F.lit("")).alias(c.replace(".", "_")) for c in back.columns if c != "_line_no"]
    )


@query
def read_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder with arrays, indented objects and JSON lines, every file read by what parsing it gives."""
    path = _landing(spark, "forms")
    for form in (views.array_files(spark, sf_dir), views.object_files(spark, sf_dir)):
        form.write.mode("append").partitionBy("name").text(path)
    lines = views.object_lines(spark, sf_dir).withColumn("name", F.lit("lines"))
    lines.write.mode("append").partitionBy("name").text(path)
    return jsonl.read_records(spark, f"{path}/*", "issue_key string, n long")


@query
def verbatim_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bugs through blocks and JSON lines: keys that nothing declares come out as they went in."""
    path, out = _landing(spark, "bugs"), _landing(spark, "bugs-blocks")
    views.landed_bugs(spark, sf_dir).write.text(path)
    chains.landed_blocks(spark, path, views.source_files(spark, sf_dir), out, "jsonl")
    back = jsonl.read_jsonl(spark, out)
    return _passed_through(back, F.expr("size(try_variant_get(record, '$.blocks', 'array<variant>'))").alias("n_blocks"))


def _passed_through(back: DataFrame, *more: Column) -> DataFrame:
    text = lambda p: F.expr(f"try_variant_get(record, '{p}', 'string')")
    return back.select(
        text("$.issue_key").alias("issue_key"), text("$.start_line").alias("start_line"), text("$.error").alias("error"),
        text("$.scan.by").alias("scan_by"), text("$.scan").alias("scan"),
        F.array_join(F.array_sort(F.json_object_keys(F.to_json("record", {"ignoreNullFields": "false"}))), ",").alias("keys"),
        *more,
    )


@query
def verbatim_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bugs with blocks as landed JSON lines through an advice run at block depth: the same keys, advice for blocks."""
    path, out = _landing(spark, "blocked"), _landing(spark, "advised")
    bugs = jsonl.object_lines(views.landed_bugs(spark, sf_dir), chains.BUG_SCHEMA, chains.REST)
    blocked = context.bug_blocks(bugs, views.source_files(spark, sf_dir))
    sinks.write_verbatim(blocked, path, chains.REST, ["blocks", "error"])
    replies = views.landed_bugs(spark, sf_dir).select(
        F.get_json_object("value", "$.issue_key").alias("issue_key"), F.lit("m").alias("model"),
        F.concat(F.lit("Explain "), F.get_json_object("value", "$.issue_key"), F.lit("\n```c\nx;\n```")).alias("raw"),
    ).where("issue_key not like '%7'")
    chains.landed_advice(spark, path, BLOCK_TEMPLATE, replies, out, "block", "jsonl")
    advice = lambda p: F.expr(f"try_variant_get(record, '$.bug_block_advice.{p}', 'string')").alias(p)
    return _passed_through(jsonl.read_jsonl(spark, out), *[advice(p) for p in ("model", "explanation", "code_update")])


@query
def publish_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishes of the issues: what the second hands out, with tombstones of what is gone."""
    folder, columns = _landing(spark, "published"), ["severity", "status", "effort"]
    all_issues = views.issues(spark, sf_dir)
    before = all_issues.where("seq % 3 <> 0").withColumn("status", F.expr("CASE WHEN seq % 7 = 0 THEN 'REOPENED' ELSE status END"))
    sinks.publish(before, folder, ["issue_key"], columns)
    version = sinks.publish(all_issues.where("seq % 5 <> 0"), folder, ["issue_key"], columns)
    return sinks.read_changes(spark, folder, version)


@query
def written_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BI tables and KPI audits of the project documents as CSV, an empty one left out: rows and columns read back."""
    measures, gate = _measure_documents(spark, sf_dir), _gate_documents(spark, sf_dir)
    pages = jsonl.landed_pages(landed_lines(spark, sf_dir)).withColumn("project", F.concat(F.lit("page"), "page_no"))
    documents = measures, gate, pages.where("issues is not null")
    audits = chains.kpi_audits(*documents)
    tables = chains.bi_tables(*documents) | {n: audits[n] for n in ("measures_audit", "gate_audit")}
    tables["nothing"] = tables["measures"].where("project_key is null and metric = 'none'")
    written = sinks.write_tables(tables, _landing(spark, "tables"))
    found = None
    for name, path in sorted(written.items()):
        table = files.read_csv(spark, path)
        one = table.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("name"), "n", F.lit(",".join(sorted(table.columns))).alias("columns")
        )
        found = one if found is None else found.unionByName(one)
    return found


@query
def project_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit texts written to a folder per project and read back as whole files, in project order."""
    path = _landing(spark, "texts")
    sinks.write_project_texts(kpi.audit_texts(kpi.kpi_audit(views.measures(spark, sf_dir))), path)
    back = files.read_texts(spark, f"{path}/*")
    return back.select(F.regexp_extract("file", "project=([^/]+)/", 1).alias("project"), "text").orderBy("project")


@query
def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary written as one JSON document with an envelope, read back as a document."""
    path = _landing(spark, "document")
    counts = kpi.project_facet(views.issues(spark, sf_dir))
    sinks.write_summary_json(counts, path, "results")
    kinds = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in counts.schema.fields)
    back = files.read_json_document(spark, path, f"results array<struct<{kinds}>>")
    return back.select(F.explode("results").alias("r")).select("r.*")


@query
def tolerant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with broken ones between them: the well-formed ones, whatever they hold."""
    path = _landing(spark, "tolerant")
    views.odd_records(spark, sf_dir).write.text(path)
    kept = jsonl.read_jsonl(spark, path)
    return kept.select(
        F.expr("try_variant_get(record, '$.issue_key', 'string')").alias("issue_key"),
        F.expr("try_variant_get(record, '$[0]', 'long')").alias("first"),
    )


@query
def saved_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component index saved as JSON lines and as CSV, both read back."""
    path = _landing(spark, "index")
    index = component_index(spark, sf_dir)
    components.save_index(index, f"{path}/jsonl", f"{path}/csv")
    schema = ", ".join(f"{c} {t}" for c, t in index.dtypes)
    lines = spark.read.schema(schema).json(f"{path}/jsonl").withColumn("saved_as", F.lit("jsonl"))
    table = files.read_csv(spark, f"{path}/csv", schema).withColumn("saved_as", F.lit("csv"))
    return lines.unionByName(table).fillna("")
