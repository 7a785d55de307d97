"""Issue records: normalise, filter, rank, deduplicate, flatten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lintlake.functions import markup, values
from lintlake.functions.text import first_nonzero, first_truthy, strip
from lintlake.operators.skew import spread_join
from lintlake.schemas import SEVERE_ISSUE_COLUMNS


def _csv(text: str | None) -> list[str]:
    return [part.strip() for part in (text or "").split(",") if part.strip()]


# --- one record per issue -------------------------------------------------


def best_row(df: DataFrame, key: Sequence[str], order: Sequence[Column], last: bool) -> DataFrame:
    """One row per key: the last (or first) by `order`.

    An aggregate instead of a window, so every task keeps one row per key before the
    shuffle and a key with a third of all rows costs its reducer one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if last else F.min_by
    return (
        df.groupBy(*key)
        .agg(pick(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("_row"))
        .select(*key, "_row.*")
        .select(*df.columns)
    )


def dedup_issues(
    df: DataFrame,
    key: str = "issue_key",
    page: Sequence[str] = (),
    row_id: Sequence[str] = (),
) -> DataFrame:
    """One row per issue key: newest update, then latest page; rows without a key are kept.

    `row_id` names columns that identify a landed row. With them keyless rows pass through
    the same aggregation as groups of their own; without them they take a second pass.
    """
    newest = [
        values.epoch_seconds(F.col("creation_date"), F.col("update_date"), "update"),
        *[F.col(c) for c in page],
    ]
    keyless = F.col(key).isNull()
    if row_id:
        own = {f"_own_{c}": F.when(keyless, F.col(c)) for c in row_id}
        return best_row(df.withColumns(own), [key, *own], newest, last=True).drop(*own)
    keyed = best_row(df.where(~keyless), [key], newest, last=True)
    return keyed.unionByName(df.where(keyless))


def resolve_path(own: Column, page_path: Column, component: Column) -> Column:
    """Own path, else the page's component path, else the text after the first ':'."""
    after_colon = F.when(
        F.contains(component, F.lit(":")),
        F.substr(component, F.position(F.lit(":"), component) + 1),
    )
    return F.coalesce(F.nullif(own, F.lit("")), page_path, after_colon, own)


def normalize(landed: DataFrame) -> DataFrame:
    """Landed issues → issue records without their snippet.

    Line numbers that are present but no integers set `error` to 'invalid_line_numbers'.
    """
    i = {n: F.col(f"issue.{n}") for n in (
        "key issue_key rule rule_key rule_name message rule_message severity type effort tags "
        "creationDate creation_date updateDate update_date component project path start_line "
        "end_line textRange"
    ).split()}
    zero_is_empty = lambda c: F.nullif(c, F.lit("0"))
    start = first_truthy(zero_is_empty(i["textRange"]["startLine"]), i["start_line"])
    end = first_truthy(
        zero_is_empty(i["textRange"]["endLine"]), zero_is_empty(i["end_line"]), start
    )
    others = [c for c in landed.columns if c not in ("issue", "page_path", "error")]
    bad_lines = (start.isNotNull() & values.to_int(start).isNull()) | (
        end.isNotNull() & values.to_int(end).isNull()
    )
    return landed.select(
        *others,
        first_truthy(i["key"], i["issue_key"]).alias("issue_key"),
        i["project"].alias("project"),
        i["component"].alias("component"),
        first_truthy(i["rule"], i["rule_key"]).alias("rule"),
        i["rule_name"].alias("rule_name"),
        i["type"].alias("type"),
        i["severity"].alias("severity"),
        first_truthy(i["message"], i["rule_message"]).alias("message"),
        i["effort"].alias("effort"),
        i["tags"].alias("tags"),
        resolve_path(i["path"], F.col("page_path"), i["component"]).alias("file_path"),
        values.to_int(start).cast("int").alias("start_line"),
        values.to_int(end).cast("int").alias("end_line"),
        first_truthy(i["creationDate"], i["creation_date"]).alias("creation_date"),
        first_truthy(i["updateDate"], i["update_date"]).alias("update_date"),
        F.coalesce(F.col("error"), F.when(bad_lines, "invalid_line_numbers")).alias("error"),
    )


def minimal_records(
    df: DataFrame, rules: DataFrame, extras: bool = False, snippet: bool = True
) -> DataFrame:
    """Open issues → path, range, snippet and rule texts.

    `df` has component, page_path, line, text_range (startLine, endLine), rule, message
    (+ severity, type, issue_key, code_snippet); rows without component or line are left
    out. `rules` has rule_key, rule_name, rule_description, one row per key.
    """
    start = first_nonzero(F.col("text_start"), F.col("line"))
    kept = df.where((F.col("component") != "") & (F.coalesce(start, F.lit(0)) != 0))
    joined = kept.withColumn("rule_key", F.coalesce("rule", F.lit(""))).join(rules, "rule_key", "left")
    columns = [
        F.coalesce(F.nullif("page_path", F.lit("")), "component").alias("path"),
        start.cast("int").alias("start_line"),
        F.coalesce(F.nullif("text_end", F.lit(0)), start).cast("int").alias("end_line"),
    ]
    if snippet:
        columns.append(F.col("code_snippet"))
    columns += [
        F.col("rule_key"),
        F.col("message").alias("rule_message"),
        F.coalesce("rule_name", F.lit("")).alias("rule_name"),
        F.coalesce("rule_description", F.lit("")).alias("rule_description"),
    ]
    if extras:
        columns += [F.col("severity"), F.col("type"), F.col("issue_key")]
    return joined.select(*columns)


def rule_texts(rules: DataFrame) -> DataFrame:
    """(key, name, htmlDesc, mdDesc) → (rule_key, rule_name, rule_description as plain text)."""
    return rules.select(
        F.col("key").alias("rule_key"),
        F.coalesce("name", F.lit("")).alias("rule_name"),
        markup.strip_html(
            F.coalesce(F.nullif("htmlDesc", F.lit("")), "mdDesc", F.lit(""))
        ).alias("rule_description"),
    )


def severe_table(issues: DataFrame, components: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Raw issues joined with their component's attributes, flat.

    `issues` has the raw field names (`key`, `rule`, …, `textRange` struct); `components`
    has key, name, qualifier, path, enabled and an `ordinal`: the last duplicate wins.
    `by` names columns of both, such as the document, inside which keys are looked up.
    """
    known = best_row(
        components.where(F.col("key") != "").select(
            F.col("key").alias("component"),
            F.col("name").alias("component_name"),
            F.col("qualifier").alias("component_qualifier"),
            F.col("path").alias("component_path"),
            F.col("enabled").alias("component_enabled"),
            "ordinal",
            *by,
        ),
        ["component", *by],
        [F.col("ordinal")],
        last=True,
    ).drop("ordinal")
    flat = issues.select(
        F.col("key").alias("issue_key"),
        "rule",
        "severity",
        "component",
        "project",
        values.to_int(F.col("line")).alias("line"),
        "message",
        values.effort_minutes(first_truthy(F.col("effort"), F.col("debt"))).alias("effort_min"),
        values.colon_offset(F.col("creationDate")).alias("creation_date"),
        values.colon_offset(F.col("updateDate")).alias("update_date"),
        "type",
        "scope",
        *by,
        *[
            values.to_int(F.col(f"textRange.{n}")).alias(n)
            for n in ("startLine", "endLine", "startOffset", "endOffset")
        ],
    )
    return spread_join(flat, known, ["component", *by], ["issue_key"]).select(*SEVERE_ISSUE_COLUMNS)


# --- filters ---------------------------------------------------------------


def search_issues(
    df: DataFrame,
    statuses: str | None = None,
    resolved: bool | None = None,
    severities: str | None = None,
    types: str | None = None,
    component_keys: str | None = None,
    created_after: object = None,
    created_before: object = None,
) -> DataFrame:
    """Comma-separated filters; the creation window is [created_after, created_before)."""
    if statuses:
        df = df.where(F.col("status").isin(_csv(statuses)))
    if resolved is not None:
        is_resolved = F.col("resolution").isNotNull()
        df = df.where(is_resolved if resolved else ~is_resolved)
    if severities:
        df = df.where(F.col("severity").isin(_csv(severities)))
    if types:
        df = df.where(F.col("type").isin(_csv(types)))
    if component_keys:
        keys = _csv(component_keys)
        df = df.where(F.col("component").isin(keys) | F.col("project").isin(keys))
    made = values.parse_stamp(F.col("creation_date")).cast("double")
    if created_after is not None:
        df = df.where(made >= values.bound_seconds(created_after))
    if created_before is not None:
        df = df.where(made < values.bound_seconds(created_before))
    return df


def open_issues(df: DataFrame) -> DataFrame:
    return search_issues(df, statuses="OPEN", resolved=False)


def bugs_only(df: DataFrame, **filters) -> DataFrame:
    filters["types"] = "BUG"
    return search_issues(df, **filters)


def in_window(since: object = None, until: object = None, date_on: str = "creation") -> Column:
    """Whether a row's date lies in the inclusive window; an unreadable date counts as 1970."""
    at = values.epoch_seconds(F.col("creation_date"), F.col("update_date"), date_on)
    low, high = values.bound_seconds(since), values.bound_seconds(until)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (at >= low)
    return inside if high is None else inside & (at <= high)


def filter_by_date(
    df: DataFrame, since: object = None, until: object = None, date_on: str = "creation"
) -> DataFrame:
    """Rows inside the inclusive window; an unreadable date counts as 1970."""
    return df.where(in_window(since, until, date_on))


def previous_analysis(analyses: DataFrame) -> DataFrame:
    """Second newest analysis per project: (project, previous_date). At most two rows per
    project and task reach the shuffle (rank limit below the exchange)."""
    newest = Window.partitionBy("project").orderBy(F.desc("date"))
    return (
        analyses.select("project", "date")
        .withColumn("_n", F.row_number().over(newest))
        .where("_n = 2")
        .select("project", F.col("date").alias("previous_date"))
    )


def since_previous_analysis(df: DataFrame, analyses: DataFrame) -> DataFrame:
    """Issues created on or after the project's previous analysis; all if it has none."""
    joined = df.join(previous_analysis(analyses), "project", "left")
    after = values.parse_stamp(F.col("creation_date")) >= values.parse_stamp(
        F.col("previous_date")
    )
    return joined.where(F.col("previous_date").isNull() | after).drop("previous_date")


def has_flow(flows: Column, locations: Column) -> Column:
    """Flow or location list present and not empty."""
    return (F.coalesce(F.size(flows), F.lit(0)) > 0) | (
        F.coalesce(F.size(locations), F.lit(0)) > 0
    )


def flow_summary(df: DataFrame) -> DataFrame:
    """(flows, locations) → one row: total, with_flow, without_flow."""
    flag = has_flow(F.col("flows"), F.col("locations"))
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(flag).alias("with_flow"),
        F.count_if(~flag).alias("without_flow"),
    )


# --- order -----------------------------------------------------------------


def rank_columns(
    primary: str = "severity", secondary: str | None = "time", recent_first: bool = True, date_on: str = "creation"
) -> dict[str, tuple[Column, bool]]:
    """Numeric sort columns by name, best first, and whether each one falls."""
    at = values.epoch_seconds(F.col("creation_date"), F.col("update_date"), date_on)
    keys = {"severity": (values.severity_weight(F.col("severity")), True), "time": (at, recent_first)}
    return {f"_by_{k}": keys[k] for k in (primary, secondary) if k in keys}


def rank_order(
    primary: str = "severity",
    secondary: str | None = "time",
    recent_first: bool = True,
    date_on: str = "creation",
    ties: Sequence[str] = (),
) -> list[Column]:
    """Sort columns, best first; `ties` are ascending input-order columns."""
    ranks = rank_columns(primary, secondary, recent_first, date_on).values()
    return [*[c.desc() if falls else c.asc() for c, falls in ranks], *[F.col(t).asc() for t in ties]]


def rank_issues(df: DataFrame, limit: int | None = None, **options) -> DataFrame:
    """Issues best first; with a limit only the top rows are ever gathered."""
    ranked = df.orderBy(*rank_order(**options))
    return ranked if limit is None else ranked.limit(limit)


def with_priority(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "priority_score", values.priority_score(F.col("severity"), F.col("creation_date"))
    )


def order_by_date(df: DataFrame, field: str = "creation_date", asc: bool = True) -> DataFrame:
    return df.orderBy(F.col(field).asc() if asc else F.col(field).desc())


def example_messages(
    df: DataFrame, per_type: int = 3, chars: int = 100, by: Sequence[str] = ()
) -> DataFrame:
    """Up to `per_type` messages of each type (per `by`), in issue-key order, cut to `chars`."""
    first = Window.partitionBy(*by, "type").orderBy("issue_key")
    return (
        df.select(*by, "type", "issue_key", "message")
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= per_type)
        .select(*by, "type", "n", "issue_key", F.left("message", F.lit(chars)).alias("message"))
    )


def snippet_text(payload: Column, start_line: Column, end_line: Column,
                 start_offset: Column, end_offset: Column) -> Column:
    """Source payload → snippet; a single-line issue with offsets gives the core slice."""
    text = markup.source_payload_text(payload)
    line = F.split(text, "\n")[0]
    single = (start_line == end_line) & start_offset.isNotNull() & end_offset.isNotNull()
    return F.when(single, markup.core_slice(line, start_offset, end_offset)).otherwise(strip(text))
