"""Checking SQL (DuckDB) for the registered queries.

Written from the meaning of each operator, not from its Spark plan: nested blocks by a
recursive query, call sites by a plain join of names and lines, and so on.
"""

from __future__ import annotations

from collections.abc import Sequence

from lintlake.functions import render as rd
from lintlake.functions.text import LANGUAGE_BY_SUFFIX, TRUNCATION_MARK, WHITESPACE
from lintlake.operators.kpi import KPI_THRESHOLDS
from lintlake.plans import views
from lintlake.schemas import MEASURE_COLUMNS, QUALITY_COLUMNS, SEVERE_ISSUE_COLUMNS

WS = "'" + WHITESPACE + "'"
WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
NL = "chr(10)"


def _select(table: str, columns: dict[str, str], where: str | None = None) -> str:
    cols = ", ".join(f'{e} AS "{n}"' for n, e in columns.items())
    return f"SELECT {cols} FROM {table}" + (f" WHERE {where}" if where else "")


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _epoch(c: str) -> str:
    return f"coalesce(epoch(try_strptime({c}, '%Y-%m-%dT%H:%M:%S%z')), 0)"


def _strip(c: str) -> str:
    return f"trim({c}, {WS})"


def _token(c: str) -> str:
    """Last white-space separated token."""
    return f"regexp_extract({c}, '([^{WHITESPACE}]+)$', 1)"


WEIGHT = (
    "CASE upper(severity) WHEN 'BLOCKER' THEN 5 WHEN 'CRITICAL' THEN 4 WHEN 'MAJOR' THEN 3 "
    "WHEN 'MINOR' THEN 2 WHEN 'INFO' THEN 1 ELSE 0 END"
)
ISSUES = "issues AS (" + _select("orders", views.ISSUES) + ")"
ANALYSES = "analyses AS (" + _select("events", views.ANALYSES) + ")"
RULES = "rules AS (" + _select("nation", views.RULES) + ")"
COMPONENTS = "components AS (" + _select("customer", views.COMPONENTS) + ")"
GATES = "gates AS (" + _select("nation", views.GATES) + ")"
MEASURES = "measures AS (" + _select("lineitem", views.MEASURES) + ")"

# --- issues ------------------------------------------------------------------

EFFORT = (
    "(SELECT nullif(sum(cast(n AS bigint) * CASE WHEN u LIKE 'd%' THEN 1440 WHEN u LIKE 'h%' "
    "THEN 60 ELSE 1 END), 0)::bigint FROM (SELECT unnest(regexp_extract_all(lower({e}), "
    "'(\\d+)([a-z]*)', 1)) AS n, unnest(regexp_extract_all(lower({e}), '(\\d+)([a-z]*)', 2)) AS u))"
)
COLON = "regexp_replace({c}, '([+-].{{1}}.)([^:].)$', '\\1:\\2')"


def _colon(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '[+-][^:]{{2}}[^:]{{2}}$') AND substr({c}, -3, 1) <> ':' "
        f"THEN left({c}, length({c}) - 2) || ':' || right({c}, 2) ELSE {c} END"
    )


_LANG = (
    "CASE lower(suffix) "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_BY_SUFFIX.items())
    + " ELSE 'cpp' END"
)

SQL: dict[str, str] = {}

SQL["rank_issues"] = f"""
WITH {ISSUES} SELECT issue_key, project, severity, creation_date,
  {WEIGHT} * 1e9 + {_epoch('creation_date')} AS priority_score
FROM issues WHERE status = 'OPEN' AND resolution IS NULL
ORDER BY {WEIGHT} DESC, {_epoch('creation_date')} DESC, seq LIMIT 100"""

_AUTO = (
    "coalesce(epoch(try_strptime(creation_date, '%Y-%m-%dT%H:%M:%S%z')), "
    "epoch(try_strptime(update_date, '%Y-%m-%dT%H:%M:%S%z')), 0)"
)
SQL["rank_issues_oldest_first"] = f"""
WITH {ISSUES} SELECT issue_key, severity, creation_date, update_date FROM issues
WHERE {_AUTO} BETWEEN epoch(timestamp '1996-02-01') AND epoch(timestamp '1996-09-30 12:00:00')
ORDER BY {_AUTO}, {WEIGHT} DESC, seq LIMIT 50"""

SQL["filter_by_date"] = f"""
WITH {ISSUES} SELECT issue_key, update_date FROM issues
WHERE {_epoch('update_date')} <= epoch(timestamp '1997-06-30')"""

SQL["search_issues"] = f"""
WITH {ISSUES} SELECT issue_key, project, severity, type, status, creation_date FROM issues
WHERE status IN ('OPEN', 'CONFIRMED') AND resolution IS NULL
  AND severity IN ('BLOCKER', 'critical', 'MAJOR') AND type IN ('BUG', 'VULNERABILITY')
  AND project IN ('proj1', 'proj2', 'proj3')
  AND try_strptime(creation_date, '%Y-%m-%dT%H:%M:%S%z') >= timestamptz '1996-01-01 00:00:00+00'
  AND try_strptime(creation_date, '%Y-%m-%dT%H:%M:%S%z') < timestamptz '1999-01-01 00:00:00+00'"""

SQL["bugs_only"] = f"""
WITH {ISSUES} SELECT issue_key, type, status FROM issues WHERE type = 'BUG' AND status = 'OPEN'"""

_PLAIN_RULE = (
    "trim(replace(replace(regexp_replace(CASE WHEN coalesce(\"htmlDesc\", '') <> '' THEN \"htmlDesc\" "
    "ELSE coalesce(\"mdDesc\", '') END, '<[^>]+>', '', 'g'), '&quot;', '\"'), '&amp;', '&'), "
    "chr(10) || chr(13) || ' ')"
)
SQL["open_minimal_issues"] = f"""
WITH {ISSUES}, {RULES}
SELECT CASE WHEN seq % 5 = 0 THEN component ELSE concat('src/f', seq % 97) END AS path,
  cast(start_line AS int) AS start_line,
  cast(CASE WHEN seq % 3 = 0 THEN start_line ELSE start_line + seq % 4 END AS int) AS end_line,
  rule AS rule_key, message AS rule_message, coalesce(name, '') AS rule_name,
  coalesce({_PLAIN_RULE}, '') AS rule_description, severity, type, issue_key
FROM issues LEFT JOIN rules ON rule = rules.key
WHERE status = 'OPEN' AND resolution IS NULL AND component IS NOT NULL
  AND start_line IS NOT NULL AND start_line <> 0"""

SQL["since_previous_analysis"] = f"""
WITH {ISSUES}, {ANALYSES}, previous AS (
  SELECT project, date AS previous_date FROM analyses
  QUALIFY row_number() OVER (PARTITION BY project ORDER BY date DESC) = 2)
SELECT issue_key, issues.project, creation_date FROM issues LEFT JOIN previous USING (project)
WHERE previous_date IS NULL OR try_strptime(creation_date, '%Y-%m-%dT%H:%M:%S%z')
  >= try_strptime(previous_date, '%Y-%m-%dT%H:%M:%S%z')"""

SQL["dedup_issues"] = f"""
WITH {ISSUES}, first AS (
  SELECT CASE WHEN seq % 3 = 0 THEN 'ISS-0' ELSE issue_key END AS issue_key, severity,
    creation_date, update_date, 1 AS page_no, seq FROM issues),
both_ AS (SELECT * FROM first UNION ALL
  SELECT issue_key, 'MAJOR', creation_date, update_date, 2, seq FROM first WHERE seq % 4 = 0)
SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY issue_key
  ORDER BY {_epoch('update_date')} DESC, page_no DESC, seq DESC) = 1"""

SQL["path_resolution"] = f"""
WITH {ISSUES}, own AS (SELECT issue_key, component,
  CASE seq % 4 WHEN 0 THEN concat('own/', seq % 9, '/A', seq, '.HPP') WHEN 1 THEN '' END AS own,
  CASE WHEN seq % 3 = 0 THEN concat('page', seq % 8, '.tar.gz') END AS page_path FROM issues),
located AS (SELECT issue_key, CASE WHEN own <> '' THEN own WHEN page_path IS NOT NULL THEN page_path
  WHEN strpos(component, ':') > 0 THEN substr(component, strpos(component, ':') + 1) ELSE own END
  AS file_path FROM own),
named AS (SELECT *, string_split(file_path, '/')[-1] AS base_name FROM located),
cut AS (SELECT *, regexp_extract(base_name, '^.+(\\.[^.]+)$', 1) AS suffix FROM named)
SELECT issue_key, file_path, base_name,
  CASE WHEN strpos(file_path, '/') > 0 THEN left(file_path, length(file_path) - length(base_name) - 1)
    WHEN file_path IS NOT NULL THEN '' ELSE '' END AS dir_name,
  string_split(file_path, '/')[1] AS top_module, suffix,
  left(base_name, length(base_name) - length(suffix)) AS stem, {_LANG} AS language FROM cut"""

SQL["component_index"] = f"""
WITH {COMPONENTS}, kept AS (SELECT * FROM components WHERE key <> '' AND path <> ''
  AND language IN ('cpp', 'cs', 'py') AND NOT (path LIKE '%/obj/%' OR path LIKE '%/packages/%'))
SELECT key AS component_key, path AS rel_path, coalesce(name, '') AS name, language,
  string_split(path, '/')[1] AS module,
  CASE WHEN strpos(coalesce(name, ''), '.') > 0 THEN '.' || string_split(name, '.')[-1] ELSE '' END AS ext
FROM kept QUALIFY row_number() OVER (PARTITION BY key ORDER BY page_no, pos) = 1"""

SQL["severe_issue_table"] = f"""
WITH {ISSUES}, {COMPONENTS}, known AS (SELECT * FROM components WHERE key <> ''
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY ordinal DESC) = 1),
timed AS (SELECT *, CASE WHEN coalesce(effort, '') <> '' THEN effort ELSE debt END AS e FROM issues)
SELECT issue_key, rule, severity, component, project, start_line AS line, message,
  {EFFORT.format(e='e')} AS effort_min,
  {_colon('creation_date')} AS creation_date, {_colon('update_date')} AS update_date, type,
  CASE WHEN seq % 2 = 0 THEN 'MAIN' END AS scope,
  CASE WHEN seq % 3 <> 0 THEN start_line END AS "startLine",
  CASE WHEN seq % 3 <> 0 THEN seq % 90 END AS "endLine",
  CASE WHEN seq % 3 <> 0 THEN 10 END::bigint AS "startOffset", NULL::bigint AS "endOffset",
  known.name AS component_name, known.qualifier AS component_qualifier,
  known.path AS component_path, known.enabled AS component_enabled
FROM timed LEFT JOIN known ON component = known.key"""

SQL["flow_flags"] = f"""
WITH {ISSUES} SELECT issue_key, seq % 4 = 0 OR seq % 5 = 0 AS has_flow FROM issues"""
SQL["flow_summary"] = f"""
WITH {ISSUES} SELECT count(*) AS total, count(*) FILTER (seq % 4 = 0 OR seq % 5 = 0) AS with_flow,
  count(*) FILTER (NOT (seq % 4 = 0 OR seq % 5 = 0)) AS without_flow FROM issues"""

SQL["issue_examples"] = f"""
WITH {ISSUES}, numbered AS (SELECT type, row_number() OVER (PARTITION BY type ORDER BY issue_key) AS n,
  issue_key, left(message, 100) AS message FROM issues) SELECT * FROM numbered WHERE n <= 3"""

# --- landed JSON ----------------------------------------------------------------

_LANDED = """
rows AS (SELECT *, cast(floor(o_orderkey / 50) AS bigint) AS page_no,
  concat('proj', o_custkey % 12) AS project,
  concat('proj', o_custkey % 12, ':c', o_orderkey % 20) AS component FROM orders),
on_page AS (SELECT * FROM rows WHERE o_orderkey % 50 <> 49),
paths AS (SELECT page_no, component, arg_max(concat('p', o_orderkey, '.cpp'), o_orderkey) AS path
  FROM on_page WHERE o_orderkey % 6 <> 0 GROUP BY ALL)"""
SQL["ingest_pages"] = f"""
WITH {_LANDED}, paged AS (
  SELECT page_no, concat('ISS-', o_orderkey) AS issue_key, project, component,
    concat('cpp:S', o_orderkey % 30) AS rule, 'a "quoted" text' AS message, 't,u' AS tags,
    coalesce(path, concat('c', o_orderkey % 20)) AS file_path,
    CASE o_orderkey % 4 WHEN 0 THEN 'x' WHEN 1 THEN '7' END AS own_start,
    CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN cast(o_orderkey % 5 AS string) END AS t_start,
    CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 THEN cast(o_orderkey % 5 + 3 AS string) END AS t_end
  FROM on_page LEFT JOIN paths USING (page_no, component)),
ranged AS (SELECT *, coalesce(t_start, own_start) AS s,
  coalesce(t_end, t_start, own_start) AS e FROM paged)
SELECT page_no, issue_key, project, component, rule, message, tags, file_path,
  try_cast(s AS int) AS start_line, try_cast(e AS int) AS end_line, NULL AS raw_line,
  CASE WHEN s = 'x' OR e = 'x' THEN 'invalid_line_numbers' END AS error FROM ranged
UNION ALL SELECT page_no, concat('ISS-', o_orderkey), NULL, NULL, 'r', 'm', NULL,
  concat('q/', o_orderkey), 3, 3, NULL, NULL FROM rows WHERE o_orderkey % 50 = 49
UNION ALL SELECT page_no, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE o_orderkey % 300 WHEN 0 THEN concat('{{"key": ', o_orderkey) WHEN 100 THEN
    concat('[', o_orderkey, ']') ELSE concat('{{"id":', o_orderkey, '}}') END,
  CASE o_orderkey % 300 WHEN 0 THEN 'json_parse_error' ELSE 'unknown_jsonl_shape' END
FROM rows WHERE o_orderkey % 100 = 0"""

SQL["fetch_counters"] = f"""
WITH {_LANDED}, sizes AS (SELECT page_no, count(*) AS n FROM on_page GROUP BY 1)
SELECT count(*) AS pages, sum(n)::bigint AS issues_total, arg_max(n, page_no)::int AS last_page_size,
  max(n * 2)::bigint AS reported_total FROM sizes"""

# --- KPIs -----------------------------------------------------------------------------

SQL["severe_count"] = f"""
WITH {ISSUES} SELECT project, count(*) AS severe_total FROM issues
WHERE upper(severity) IN ('BLOCKER', 'CRITICAL') AND resolution IS NULL
  AND try_strptime(creation_date, '%Y-%m-%dT%H:%M:%S%z') >= timestamptz '1996-06-01 00:00:00+00'
GROUP BY project"""
SQL["project_facet"] = f"WITH {ISSUES} SELECT project, count(*) AS n FROM issues GROUP BY project"
SQL["issue_matrix"] = f"""
WITH {ISSUES} SELECT type, sev AS severity, count(*) AS n,
  CASE WHEN type IN ('BUG', 'VULNERABILITY') AND grouping(sev) = 1 THEN
    CASE WHEN count(*) FILTER (sev IN ('BLOCKER', 'CRITICAL')) = 0 THEN 'PASS' ELSE 'FAIL' END END AS status
FROM (SELECT type, upper(severity) AS sev FROM issues) GROUP BY ROLLUP (type, sev)"""
SQL["project_issue_matrix"] = f"""
WITH {ISSUES} SELECT project, type, sev AS severity, count(*) AS n,
  CASE WHEN type IN ('BUG', 'VULNERABILITY') AND grouping(sev) = 1 THEN
    CASE WHEN count(*) FILTER (sev IN ('BLOCKER', 'CRITICAL')) = 0 THEN 'PASS' ELSE 'FAIL' END END AS status
FROM (SELECT project, type, upper(severity) AS sev FROM issues)
GROUP BY GROUPING SETS ((project, type, sev), (project, type), (project))"""
SQL["project_issue_examples"] = f"""
WITH {ISSUES} SELECT project, type, row_number() OVER (PARTITION BY project, type ORDER BY issue_key) AS n,
  issue_key, left(message, 100) AS message FROM issues QUALIFY n <= 3"""
SQL["batch_summary"] = f"""
WITH {ISSUES}, {GATES}, counts AS (SELECT project, count(*) FILTER (upper(severity) IN
  ('BLOCKER', 'CRITICAL') AND resolution IS NULL) AS total_severe FROM issues GROUP BY project)
SELECT project, gate_status IS NOT NULL AND total_severe IS NOT NULL AS ok,
  gate_status AS quality_gate_status, coalesce(total_severe, 0) AS total_severe,
  CASE WHEN gate_status IS NULL THEN 'quality gate missing'
    WHEN total_severe IS NULL THEN 'issues missing' END AS error
FROM counts FULL JOIN gates USING (project)"""

SQL["measures_long"] = """
WITH p AS (SELECT *, concat('proj', p_partkey % 12) AS project_key, p_partkey % 6 AS form FROM part)
SELECT project_key, 'coverage' AS metric, cast(concat(p_size, '.5') AS double) AS value,
  NULL::varchar AS date, NULL::bigint AS period_index FROM p WHERE form = 0
UNION ALL SELECT project_key, 'bugs', cast(p_partkey % 9 AS double), NULL, 1 FROM p WHERE form = 0
UNION ALL SELECT project_key, 'ncloc', cast(p_size AS double), '2024-01-01T00:00:00+00:00', NULL FROM p WHERE form = 1
UNION ALL SELECT project_key, 'ncloc', NULL, '2024-02-01T00:00:00+01:00', NULL FROM p WHERE form = 1
UNION ALL SELECT project_key, 'new_coverage', p_size + 0.25, NULL, 3 FROM p WHERE form = 2
UNION ALL SELECT project_key, 'new_coverage', cast(p_partkey % 50 AS double), '2024-03-01T00:00:00Z', 2 FROM p WHERE form = 2
UNION ALL SELECT project_key, 'new_coverage', NULL, NULL, NULL FROM p WHERE form = 2
UNION ALL SELECT project_key, 'new_bugs', cast(p_size AS double), NULL, 1 FROM p WHERE form = 3"""

_CONDITIONS = """
docs AS (SELECT *, concat('proj', c_custkey % 12) AS project_key,
  CASE c_custkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'ERROR' ELSE 'WARN' END AS gate_status,
  c_custkey % 4 = 0 AS ignored_conditions FROM customer),
conditions AS (
SELECT project_key, gate_status, ignored_conditions,
  CASE c_custkey % 2 WHEN 0 THEN 'OK' ELSE 'ERROR' END AS condition_status,
  'new_coverage' AS metric_key, 'LT' AS comparator, 1::bigint AS period_index,
  85.0::double AS error_threshold, c_custkey % 100 + 0.5::double AS actual_value,
  CASE WHEN c_custkey % 5 = 1 THEN 'b' END AS period_mode,
  CASE WHEN c_custkey % 5 = 1 THEN '2024-02-01' END AS period_date FROM docs
UNION ALL SELECT project_key, gate_status, ignored_conditions, 'OK',
  CASE c_custkey % 3 WHEN 0 THEN 'new_security_rating' WHEN 1 THEN 'duplicated_lines_density' ELSE 'ncloc' END,
  'GT', NULL, 1.0, cast(c_custkey % 5 AS double),
  CASE WHEN c_custkey % 5 = 0 THEN 'previous' END,
  CASE WHEN c_custkey % 5 = 0 THEN '2024-01-01T00:00:00+00:00' END FROM docs)"""
SQL["quality_conditions"] = f"WITH {_CONDITIONS} SELECT * FROM conditions"

_KPI_ROWS = ", ".join(
    f"({i}, '{m}', {_text(op) if op else 'NULL'}, {t if t is not None else 'NULL'})"
    for i, (m, op, t) in enumerate(KPI_THRESHOLDS)
)
_OK = "CASE op WHEN '>=' THEN value >= threshold WHEN '<' THEN value < threshold ELSE value = threshold END"
SQL["kpi_audit"] = f"""
WITH {MEASURES}, kpi(i, metric, op, threshold) AS (VALUES {_KPI_ROWS}),
newest AS (SELECT project_key, metric, value FROM measures WHERE value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY project_key, metric ORDER BY date DESC, value DESC) = 1),
projects AS (SELECT DISTINCT project_key FROM measures WHERE metric IN (SELECT metric FROM kpi)),
audited AS (SELECT p.project_key, kpi.metric, value, op, threshold::double AS threshold
  FROM projects p CROSS JOIN kpi LEFT JOIN newest n ON n.project_key = p.project_key AND n.metric = kpi.metric)
SELECT *, CASE WHEN value IS NULL THEN 'MISSING' WHEN op IS NULL THEN 'INFO' WHEN {_OK} THEN 'PASS' ELSE 'FAIL' END AS status,
  CASE WHEN value IS NULL THEN 'not measured' WHEN op IS NULL THEN printf('Actual %.2f', value)
  ELSE printf('Actual %.2f, required %s %.2f', value, op, threshold) END AS reason FROM audited"""

SQL["kpi_audit_texts"] = f"""
WITH audit AS ({SQL['kpi_audit']}) SELECT project_key AS project,
  string_agg('- ' || metric || ': ' || status || ' (' || reason || ')', {NL} ORDER BY metric)
  || {NL} || 'Overall: ' || CASE WHEN count(*) FILTER (status IN ('FAIL', 'MISSING')) = 0 THEN 'all KPIs are met.'
  ELSE count(*) FILTER (status IN ('FAIL', 'MISSING')) || ' KPIs are not met.' END AS text FROM audit GROUP BY project_key"""

SQL["gate_audit"] = f"""
WITH {_CONDITIONS}, ruled AS (SELECT *,
  CASE metric_key WHEN 'new_coverage' THEN '>=' WHEN 'duplicated_lines_density' THEN '<' WHEN 'new_security_rating' THEN '=' END AS op,
  CASE metric_key WHEN 'new_coverage' THEN 85.0 WHEN 'duplicated_lines_density' THEN 3.0 WHEN 'new_security_rating' THEN 1.0 END::double AS threshold,
  actual_value AS value FROM conditions),
judged AS (SELECT *, op IS NULL OR {_OK} AS kpi_ok FROM ruled)
SELECT project_key, gate_status, metric_key, condition_status, comparator, error_threshold, actual_value,
  CASE WHEN kpi_ok THEN 'PASS' ELSE 'FAIL' END AS kpi_status,
  CASE WHEN NOT kpi_ok THEN printf('Actual %.2f, required %s %.2f', value, op, threshold) END AS reason
FROM judged WHERE condition_status IN ('ERROR', 'WARN') OR NOT kpi_ok"""

# --- source context -------------------------------------------------------------------------

_PATH = views.PATH.format(d="doc_id")
_LINE = views.CODE_LINE.format(b="b", i="i")
FILES = f"""
source_files AS MATERIALIZED (SELECT {_PATH} AS file_path, array_to_string(list_transform(
  string_split(text, {NL}), lambda b, i: {_LINE}), {NL}) AS text FROM documents),
files AS MATERIALIZED (SELECT file_path, CASE WHEN text = '' THEN [] WHEN right(text, 1) = {NL}
  THEN string_split(left(text, length(text) - 1), {NL}) ELSE string_split(text, {NL}) END AS lines,
  right(text, 1) = {NL} AS ended FROM source_files),
source_lines AS MATERIALIZED (SELECT file_path, generate_subscripts(lines, 1) AS line_no,
  unnest(lines) AS text FROM files)"""
SQL["source_lines"] = f"WITH {FILES} SELECT file_path, line_no::int AS line_no, text FROM source_lines"

# Lines first..last of a file as they stand in it, ends included.
_JOINED = (
    "(array_to_string(list_slice(lines, {a}, {b}), chr(10)) || "
    "CASE WHEN {b} < len(lines) OR ended THEN chr(10) ELSE '' END)"
)
SQL["snippets"] = f"""
WITH {FILES}, located AS ({_select('(SELECT *, (SELECT count(*) FROM documents) AS n_docs FROM orders)', views.LOCATED)}),
joined AS (SELECT located.*, lines, ended, len(lines) AS n, greatest(1, start_line - 2) AS low,
  greatest(greatest(1, start_line - 2), coalesce(end_line, start_line) + 2) AS high
  FROM located LEFT JOIN files USING (file_path)),
clamped AS (SELECT *, greatest(1, least(low, n)) AS a,
  greatest(greatest(1, least(low, n)), least(high, n)) AS z FROM joined),
cut AS (SELECT *, CASE WHEN coalesce(file_path, '') = '' THEN 'missing_path'
  WHEN start_line IS NULL THEN 'missing_start_line' WHEN lines IS NULL THEN 'file_read_error' END AS error,
  CASE WHEN n = 0 THEN '' ELSE replace({_JOINED.format(a='a', b='z')}, chr(9), '    ') END AS body FROM clamped)
SELECT file_path, issue_key, start_line, end_line, error, CASE WHEN error IS NULL THEN
  CASE WHEN length(body) > 20000 THEN left(body, 20000) || {_text(TRUNCATION_MARK)} ELSE body END END AS code_snippet
FROM cut"""

_IS_CODE = (
    "(ltrim(text, " + WS + ") <> '' AND NOT (ltrim(text, " + WS + ") LIKE '//%' OR ltrim(text, "
    + WS + ") LIKE '/*%' OR starts_with(ltrim(text, " + WS + "), '#include')))"
)
INCLUDES = f"""
heads AS MATERIALIZED (SELECT file_path, line_no, text, max({_IS_CODE}::int) OVER (PARTITION BY file_path ORDER BY line_no
  ROWS UNBOUNDED PRECEDING) = 0 AS in_block FROM source_lines),
includes AS MATERIALIZED (SELECT file_path, coalesce(count(*) FILTER (in_block), 0) AS n_lines,
  coalesce(string_agg(text, {NL} ORDER BY line_no) FILTER (in_block), '') AS include_text,
  coalesce(list(text ORDER BY line_no) FILTER (in_block), []) AS include_list
  FROM heads GROUP BY file_path)"""
SQL["include_block"] = f"""
WITH {FILES}, {INCLUDES}, named AS (SELECT *, regexp_extract(regexp_extract(file_path, '([^/]+)\\.[^.]+$', 1), 'd\\d', 0) AS stem
  FROM includes)
SELECT file_path, n_lines::int AS n_lines, include_text,
  stem <> '' AND len(list_filter(include_list, lambda t: contains(t, stem || '.h'))) > 0 AS names_header
FROM named UNION ALL SELECT file_path, 0, '', false FROM files WHERE len(lines) = 0"""

_OWN = _select(
    "(SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents)", views.OWN_BUG
)
_HOT = _select("documents", views.HOT_BUG, "doc_id % 3 = 0")
BUGS = f"bugs AS MATERIALIZED ({_OWN} UNION ALL {_HOT})"

BLOCKS = f"""
indents AS MATERIALIZED (SELECT file_path, list(struct_pack(line := line_no, ind := length(text) - length(ltrim(text, ' ')))
  ORDER BY line_no) FILTER ({_strip('text')} <> '') AS ind FROM source_lines GROUP BY file_path),
placed AS MATERIALIZED (SELECT bugs.*, lines, ended, len(lines) AS n, ind, greatest(1, least(len(lines), start_line)) AS cs,
  greatest(greatest(1, least(len(lines), start_line)),
    greatest(1, least(len(lines), coalesce(end_line, start_line)))) AS ce
  FROM bugs LEFT JOIN files USING (file_path) LEFT JOIN indents USING (file_path)),
nested AS (
  WITH RECURSIVE walk(issue_key, level, indent, a, z, up, down) AS (
    SELECT issue_key, 0, indent, cs, ce,
      list_filter(ind, lambda x: x.line < cs AND x.ind < indent)[-1],
      list_filter(ind, lambda x: x.line > ce AND x.ind < indent)[1]
    FROM (SELECT *, coalesce(list_min(list_transform(list_filter(ind, lambda x: x.line BETWEEN cs AND ce),
      lambda x: x.ind)), 0) AS indent FROM placed WHERE n > 0 AND start_line IS NOT NULL)
    UNION ALL
    SELECT issue_key, level + 1, indent2, a, z,
      list_filter(ind, lambda x: x.line < a AND x.ind < indent2)[-1],
      list_filter(ind, lambda x: x.line > z AND x.ind < indent2)[1]
    FROM (SELECT w.issue_key, level, least(up.ind, down.ind) AS indent2, p.ind, coalesce(up.line + 1, 1) AS a,
      coalesce(down.line - 1, n) AS z FROM walk w JOIN placed p USING (issue_key)
      WHERE up IS NOT NULL OR down IS NOT NULL))
  SELECT issue_key, level, indent, coalesce(up.line + 1, 1) AS a, coalesce(down.line - 1, n) AS z, lines, ended
  FROM walk JOIN placed USING (issue_key)),
blocks AS MATERIALIZED (SELECT issue_key, level::int AS level, indent::int AS indent, a::int AS start_no, z::int AS end_no,
  {_JOINED.format(a='a', b='z')} AS code FROM nested),
failed AS MATERIALIZED (SELECT issue_key, CASE WHEN lines IS NULL THEN 'Source file not found: ' || coalesce(file_path, '')
  WHEN start_line IS NULL THEN 'missing_start_line' END AS error FROM placed)"""
SQL["blocks"] = f"""
WITH {FILES}, {BUGS}, {BLOCKS}
SELECT issue_key, error, level, indent, start_no, end_no, code FROM failed LEFT JOIN blocks USING (issue_key)"""

_S = _strip("text")
_BEFORE = _strip("left(s, strpos(s, '(') - 1)")
HEADERS = f"""
stripped AS MATERIALIZED (SELECT file_path, line_no, text, {_S} AS s,
  length(text) - length(ltrim(text, {WS})) AS indent FROM source_lines),
header_lines AS MATERIALIZED (SELECT *, trim(string_split({_token(_BEFORE)}, '::')[-1], '*&') AS name FROM stripped
  WHERE contains(s, '(') AND contains(s, ')') AND right(s, 1) <> ';'
  AND NOT regexp_matches(lower(s), '^(if |for |while |switch |catch |else|do )')),
headers AS MATERIALIZED (SELECT * FROM header_lines WHERE name <> '' AND name NOT IN ('if', 'for', 'while', 'switch', 'return')),
owned AS MATERIALIZED (SELECT *, string_split(left(s, strpos(s, '(') - 1), '::') AS parts FROM headers)"""
_OWNER = _token(_strip("parts[-2]"))
ANCHORS = f"""
anchored AS MATERIALIZED (
  SELECT p.issue_key, p.file_path, p.start_line, coalesce(p.end_line, p.start_line) AS last_line, p.n, p.lines,
    h.line_no AS def_line, h.name, h.s AS signature,
    CASE WHEN len(h.parts) >= 2 THEN nullif({_OWNER.replace('parts', 'h.parts')}, '') END AS class_name
  FROM placed p LEFT JOIN stripped b ON b.file_path = p.file_path AND b.line_no = p.start_line
  LEFT JOIN owned h ON h.file_path = p.file_path AND p.start_line IS NOT NULL
    AND h.line_no BETWEEN least(p.start_line, p.n) - 200 AND least(p.start_line, p.n)
    AND (b.indent IS NULL OR h.indent < b.indent)
  QUALIFY row_number() OVER (PARTITION BY p.issue_key ORDER BY h.line_no DESC NULLS LAST) = 1)"""
_DEEP = f"WITH {FILES}, {INCLUDES}, {BUGS}, {BLOCKS}, {HEADERS}, {ANCHORS}"
SQL["enclosing_function"] = f"""
{_DEEP}, outermost AS (SELECT issue_key, max(level) AS block_level, arg_max(indent, level) AS block_indent FROM blocks GROUP BY 1)
SELECT a.issue_key, CASE WHEN outermost.issue_key IS NULL THEN 'Missing blocks; run the block extraction first.'
    WHEN name IS NULL THEN 'No function definition found in search window above bug line.' END AS error,
  name, class_name, def_line::int AS def_line, signature,
  CASE WHEN name IS NOT NULL THEN block_level END AS block_level,
  CASE WHEN name IS NOT NULL THEN block_indent END AS block_indent,
  CASE WHEN name IS NOT NULL THEN include_text END AS def_includes
FROM anchored a LEFT JOIN outermost USING (issue_key) LEFT JOIN includes USING (file_path)"""
SQL["bug_context"] = f"""
{_DEEP} SELECT issue_key, greatest(1, start_line - 6)::int AS start_no, least(n, last_line + 6)::int AS end_no,
  array_to_string(list_slice(lines, greatest(1, start_line - 6), least(n, last_line + 6)), {NL}) AS code
FROM anchored WHERE name IS NOT NULL"""

_Q_LEFT = f"rtrim(left(s, strpos(s, '::' || name) - 1), {WS})"
CALLS = f"""
profiles AS MATERIALIZED (SELECT DISTINCT name, coalesce(class_name, '') AS class_name,
  regexp_replace(file_path, '/[^/]*$', '') AS def_dir, regexp_extract(file_path, '([^/]+)\\.[^.]+$', 1) AS stem
  FROM anchored WHERE name IS NOT NULL),
searched AS MATERIALIZED (SELECT file_path, line_no, text, s FROM stripped
  WHERE NOT regexp_matches(file_path, '\\.(h|hpp|hh|hxx)$')
  AND NOT regexp_matches(lower(file_path), '(^|/)(test|tests|testing|example|examples|demo|demos|tool|tools)(/|$)')),
runs AS MATERIALIZED (SELECT *, unnest(regexp_extract_all(text, '([^{WHITESPACE}(]+)[{WHITESPACE}]*\\(', 1)) AS run FROM searched),
ending AS MATERIALIZED (SELECT names.name, runs.* FROM (SELECT DISTINCT name FROM profiles) names, runs WHERE suffix(run, name)),
hits AS MATERIALIZED (SELECT DISTINCT name, file_path, line_no, text, s FROM ending
  WHERE (run = name OR regexp_matches(substr(run, length(run) - length(name), 1), '{NOT_WORD}'))
  AND NOT (contains(s, '(') AND contains(s, ')') AND right(s, 1) <> ';' AND contains(s, '::' || name))),
qualified AS MATERIALIZED (SELECT *, CASE WHEN contains(s, '::' || name) AND {_Q_LEFT} <> ''
  THEN string_split({_token(_Q_LEFT)}, '::')[-1] END AS qualifier FROM hits),
scored AS MATERIALIZED (SELECT p.*, q.file_path AS file, line_no::int AS line, s AS code,
  p.stem <> '' AND len(list_filter(include_list, lambda t: contains(t, p.stem || '.h'))) > 0 AS includes_bug_header,
  regexp_replace(q.file_path, '/[^/]*$', '') = p.def_dir AS same_dir,
  string_split(q.file_path, '/')[1] = string_split(p.def_dir, '/')[1] AS same_top_module
  FROM profiles p JOIN qualified q ON p.name = q.name JOIN includes i ON i.file_path = q.file_path
  WHERE p.class_name = '' OR qualifier IS NULL OR contains(s, p.class_name || '::' || p.name) OR qualifier = p.class_name),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY name, class_name, def_dir, stem
  ORDER BY score DESC, file, line)::int AS rank FROM (SELECT *, (1 + CASE WHEN same_dir THEN 3 WHEN same_top_module THEN 1 ELSE 0 END
  + CASE WHEN includes_bug_header THEN 3 ELSE 0 END)::int AS score FROM scored)),
sites AS MATERIALIZED (SELECT r.*, greatest(1, line - 6)::int AS context_start, least(len(lines), line + 6)::int AS context_end,
  array_to_string(list_slice(lines, greatest(1, line - 6), least(len(lines), line + 6)), {NL}) AS context,
  include_text AS includes FROM ranked r JOIN files f ON f.file_path = r.file JOIN includes i ON i.file_path = r.file
  WHERE rank <= 20)"""
SQL["call_sites"] = f"""
{_DEEP}, {CALLS} SELECT name, class_name, def_dir, stem, file, line, code, includes_bug_header, same_dir,
  same_top_module, score, rank, context_start, context_end, context, includes FROM sites"""
SQL["indexed_call_sites"] = SQL["call_sites"]
SQL["all_call_sites"] = f"""
{_DEEP}, {CALLS} SELECT name, class_name, score, count(*) AS n FROM ranked GROUP BY ALL"""

_INHERIT = (
    "regexp_extract(text, '^\\s*(?:class|struct)\\s+\\w+[^:;{(]*:\\s*([^:;{(][^;{(]*)', 1)"
)
EDGES = f"""
calls AS (SELECT s.file_path, s.line_no, s.text, last_value(h.name IGNORE NULLS) OVER (PARTITION BY s.file_path
  ORDER BY s.line_no ROWS UNBOUNDED PRECEDING) AS src, h.name AS own FROM stripped s
  LEFT JOIN headers h ON h.file_path = s.file_path AND h.line_no = s.line_no),
edges AS MATERIALIZED (
  SELECT file_path AS src, dst, 'include' AS type FROM (SELECT file_path,
    regexp_extract(text, '^\\s*#\\s*include\\s*[<"]([^>"]+)', 1) AS dst FROM source_lines) WHERE dst <> ''
  UNION ALL SELECT src, dst, 'inherits' FROM (SELECT src, trim(regexp_replace(base,
    '\\b(?:public|protected|private|virtual)\\b', '', 'g')) AS dst FROM (SELECT
    regexp_extract(text, '^\\s*(?:class|struct)\\s+(\\w+)', 1) AS src, unnest(string_split({_INHERIT}, ',')) AS base
    FROM source_lines WHERE {_INHERIT} <> '')) WHERE dst <> ''
  UNION ALL SELECT src, dst, 'call' FROM (SELECT src, unnest(regexp_extract_all(text, '({WORD}+)[{WHITESPACE}]*\\(', 1)) AS dst
    FROM calls WHERE own IS NULL AND src IS NOT NULL) WHERE dst NOT IN ('if', 'for', 'while', 'switch', 'return')),
symbols AS MATERIALIZED (SELECT file_path AS file, kind, spelling, line::int AS line, (coalesce(lead(line) OVER (PARTITION BY file_path
  ORDER BY line, kind) - 1, n))::int AS extent_end FROM (
    SELECT file_path, 'function' AS kind, name AS spelling, line_no AS line FROM headers
    UNION ALL SELECT file_path, 'class', regexp_extract(text, '^\\s*(?:class|struct)\\s+(\\w+)', 1), line_no FROM source_lines
    WHERE regexp_matches(text, '^\\s*(?:class|struct)\\s+(\\w+)')) JOIN (SELECT file_path, len(lines) AS n FROM files) USING (file_path))"""
SQL["dependency_edges"] = f"WITH {FILES}, {HEADERS}, {EDGES} SELECT src, dst, type FROM edges"
SQL["edge_counts"] = f"""
WITH {FILES}, {HEADERS}, {EDGES} SELECT type, count(*) AS n FROM (SELECT type FROM edges
  UNION ALL SELECT 'symbol' FROM symbols) GROUP BY type"""
SQL["symbols"] = f"WITH {FILES}, {HEADERS}, {EDGES} SELECT * FROM symbols"

# --- prompts and advice ----------------------------------------------------------------------

SQL["prompt_issue"] = f"""
WITH {ISSUES} SELECT issue_key, concat('Review {{one}} finding.', {NL}, 'Key: ', issue_key, ' (', severity, '/', type,
  ', rule ', rule, ')', {NL}, 'Message: ', message, {NL}, 'Where: ', component, ':',
  coalesce(nullif(start_line, 0)::varchar, 'None'), '-', coalesce(nullif(start_line, 0)::varchar, 'None'), ', made ',
  creation_date, ', changed ', update_date, {NL}, 'Code (', CASE WHEN component LIKE '%.h' THEN 'c'
  WHEN component LIKE '%.cs' THEN 'csharp' WHEN component LIKE '%.py' THEN 'python' ELSE 'cpp' END, '):', {NL}, rule, {NL})
  AS user_prompt FROM issues"""

_BLOCK_PROMPT = f"""concat('Bug ', issue_key, ' [', severity, '] ', rule, ': ', message, {NL}, 'At ', file_path, ' ',
  nullif(start_line, 0), '..', nullif(end_line, 0), {NL}, 'Snippet:', {NL}, code_snippet, {NL}, 'Around it:', {NL}, ctx, {NL})"""
CONTEXT = """
chosen AS (SELECT issue_key, '// Context block (level ' || level || ', lines ' || start_no || '–' || end_no || ')' || chr(10) || code AS ctx
  FROM blocks QUALIFY level = CASE WHEN max(level) OVER (PARTITION BY issue_key) = 0 THEN 0
    ELSE max(level) OVER (PARTITION BY issue_key) - 1 END)"""
SQL["prompt_block"] = f"""
WITH {FILES}, {BUGS}, {BLOCKS}, {CONTEXT}
SELECT issue_key, {_BLOCK_PROMPT} AS user_prompt FROM bugs LEFT JOIN chosen USING (issue_key)"""

_FLAG = "CASE WHEN {f} THEN 'True' ELSE 'False' END"
_SITE_TEXT = f"""concat_ws({NL}, '// CALLSITE #' || rank, '// File: ' || file, '// Call line: ' || line,
  '// Context lines: ' || context_start || '–' || context_end, '// Suspected callee signature: ' || signature,
  '// Call expression: ' || code, '// Heuristic score: ' || score, '// same_dir: ' || {_FLAG.format(f='same_dir')},
  '// same_top_module: ' || {_FLAG.format(f='same_top_module')}, '// includes_bug_header: ' || {_FLAG.format(f='includes_bug_header')},
  CASE WHEN inc <> '' THEN '// Includes around callsite:' END, nullif(inc, ''), '// Local call context:', context)"""


def _section(n: str) -> str:
    return (
        f"CASE WHEN total IS NULL THEN {_text(rd.NO_CALL_SITES)} ELSE {_text(rd.SECTION_HEAD)} || "
        f"array_to_string(list_slice(texts, 1, {n}), chr(10) || chr(10)) || CASE WHEN total > {n} THEN "
        f"chr(10) || chr(10) || '// NOTE: There are ' || total || ' callsites in total, but only the first ' || {n} || "
        f"' are shown here.' || chr(10) ELSE '' END END"
    )


def _cut(c: str, note: str) -> str:
    return (
        f"CASE WHEN length({c}) > 4000 THEN left({c}, 4000) || chr(10) || '// [TRUNCATED: {note}]' || chr(10) "
        f"ELSE coalesce({c}, '') END"
    )


_SITES = f"""
site_texts AS MATERIALIZED (SELECT a.issue_key, list({_SITE_TEXT} ORDER BY rank) AS texts, count(*) AS total FROM (
  SELECT *, array_to_string(list_filter(string_split(includes, {NL}), lambda x: x <> ''), {NL}) AS inc FROM sites) s
  JOIN anchored a ON a.name = s.name AND coalesce(a.class_name, '') = s.class_name
  AND regexp_replace(a.file_path, '/[^/]*$', '') = s.def_dir AND regexp_extract(a.file_path, '([^/]+)\\.[^.]+$', 1) = s.stem
  GROUP BY a.issue_key),
material AS MATERIALIZED (SELECT bugs.*, ctx, texts, total, an.name FROM bugs LEFT JOIN chosen USING (issue_key)
  LEFT JOIN site_texts USING (issue_key) LEFT JOIN anchored an USING (issue_key)),
limits(n) AS (VALUES (20), (15), (10), (5), (3)),
tried AS MATERIALIZED (SELECT issue_key, n, {_BLOCK_PROMPT} || 'Callers:' || {NL} || {_section('n')} || {NL} AS prompt
  FROM material CROSS JOIN limits),
fits AS (SELECT issue_key, max(n) AS n FROM tried WHERE length(prompt) <= 24000 GROUP BY issue_key),
cut_down AS (SELECT issue_key, {_BLOCK_PROMPT} || 'Callers:' || {NL} || {_section('3')} || {NL} AS prompt FROM
  (SELECT * REPLACE ({_cut('ctx', 'context block')} AS ctx, {_cut('code_snippet', 'code snippet')} AS code_snippet) FROM material))"""
SQL["prompt_callsite"] = f"""
{_DEEP}, {CALLS}, {CONTEXT}, {_SITES}
SELECT m.issue_key, CASE WHEN b.issue_key IS NULL THEN 'Missing blocks; run the block extraction first.'
    WHEN name IS NULL THEN 'No function definition found in search window above bug line.' END AS error,
  coalesce(fits.n, 3)::int AS callsite_limit, coalesce(tried.prompt, cut_down.prompt) AS user_prompt
FROM material m LEFT JOIN (SELECT DISTINCT issue_key FROM blocks) b USING (issue_key) LEFT JOIN fits USING (issue_key)
LEFT JOIN tried ON tried.issue_key = m.issue_key AND tried.n = fits.n LEFT JOIN cut_down ON cut_down.issue_key = m.issue_key"""

SQL["advice_parts"] = f"""
SELECT conv_id, turn, CASE (conv_id + turn) % 5 WHEN 0 THEN text WHEN 1 THEN text ELSE {_strip('text')} END AS explanation,
  CASE (conv_id + turn) % 5 WHEN 0 THEN concat('x = ', conv_id, ';') WHEN 1 THEN concat('x = ', conv_id, ';')
    WHEN 2 THEN concat('```cpp', {NL}, 'x = ', conv_id, ';', {NL}, '```')
    WHEN 3 THEN concat('```', {NL}, 'x = ', conv_id, ';') ELSE '' END AS code_update
FROM conversations WHERE role = 'assistant'"""
SQL["strip_fence"] = f"""
SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 0 THEN {_strip(f"concat('json', {NL}, text)")}
  WHEN 1 THEN {_strip("concat('```', text)")} WHEN 2 THEN {_strip("concat(text, '```a```')")} ELSE {_strip('text')} END AS content
FROM conversations"""

_ADVISED = f"""
ordered AS (SELECT *, seq % 29 <> 0 AS ok, {WEIGHT} AS w, {_epoch('creation_date')} AS made FROM issues),
running AS (SELECT *, coalesce(sum(ok::int) OVER (ORDER BY w DESC, made DESC, seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM ordered),
advised AS (SELECT *, CASE WHEN NOT ok THEN 'prompt_error' WHEN seq % 4 = 0 THEN 'model_error' ELSE 'ok' END AS advice_status
  FROM running WHERE done < 500)"""
SQL["advice_join"] = f"""
WITH {ISSUES}, {_ADVISED} SELECT issue_key, advice_status,
  CASE WHEN advice_status = 'ok' THEN w * 1e9 + made END AS priority_score,
  CASE WHEN seq % 4 <> 0 AND seq % 2 = 0 THEN 'm-2' ELSE 'm-1' END AS model,
  CASE WHEN advice_status = 'ok' THEN concat('Explain ', seq) END AS explanation,
  CASE WHEN advice_status = 'ok' THEN concat('```', {NL}, 'fix ', seq, {NL}, '```') END AS code_update,
  CASE advice_status WHEN 'prompt_error' THEN 'prompt_build_error: no hole' WHEN 'model_error' THEN 'model_call_error: no reply' END AS error
FROM advised"""
SQL["run_counters"] = f"""
WITH {ISSUES}, {_ADVISED} SELECT (SELECT count(*) FROM issues) AS read,
  (SELECT count(*) FROM issues WHERE {_epoch('creation_date')} >= epoch(timestamp '1996-01-01')) AS filtered,
  count(*) FILTER (advice_status <> 'prompt_error') AS processed, count(*) AS written, count(*) FILTER (advice_status <> 'ok') AS errors
FROM advised"""

# --- text and export ---------------------------------------------------------------------------

SQL["strip_html"] = f"""
SELECT page_id, trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'),
  '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
  chr(10) || chr(13) || ' ') AS plain FROM pages"""
SQL["core_slice"] = f"""
WITH {ISSUES}, cut AS (SELECT *, (seq % 31 - 2)::int AS a, (seq % 47)::int AS z FROM issues)
SELECT issue_key, CASE WHEN a >= 0 AND a < z AND z <= length(message) AND {_strip('substr(message, a + 1, z - a)')} <> ''
  THEN substr(message, a + 1, z - a) ELSE message END AS core FROM cut"""
SQL["scalar_values"] = f"""
WITH {ISSUES} SELECT issue_key,
  CASE seq % 7 WHEN 0 THEN seq WHEN 3 THEN cast(concat('1', seq % 100) AS bigint) WHEN 4 THEN -seq END AS as_int,
  CASE seq % 7 WHEN 0 THEN seq WHEN 1 THEN seq + 0.5 WHEN 2 THEN seq + 0.25
    WHEN 3 THEN cast(concat('1', seq % 100) AS double) WHEN 4 THEN -seq END::double AS as_float,
  {EFFORT.format(e='effort')} AS minutes, {_colon('creation_date')} AS iso_date,
  {_AUTO}::double AS epoch, ({WEIGHT})::int AS weight, update_date AS stamp FROM issues"""
SQL["flatten_events"] = """
SELECT event_type AS type, event_id::varchar AS event_id,
  CASE WHEN event_id % 6 = 0 THEN 'True' WHEN event_id % 2 = 0 THEN 'False' ELSE '' END AS flag,
  coalesce(json_extract_string(props, '$.k'), '') AS "props.k", '' AS "props.note", concat('[', user_id, ']') AS users,
  value::varchar AS value FROM events"""
SQL["changed_rows"] = f"""
WITH {ISSUES} SELECT issue_key, severity, status, effort, sha256(concat('v', issue_key, chr(31), 'v', severity, chr(31),
  'v', status, chr(31), CASE WHEN effort IS NULL THEN 'n' ELSE 'v' || effort END)) AS content_hash
FROM issues WHERE seq % 3 = 0 OR seq % 7 = 0"""


SQL["bi_severe_issues"] = f"""
WITH {ISSUES}, {COMPONENTS}, known AS (SELECT *, ordinal % 2 AS d FROM components WHERE key <> ''
  QUALIFY row_number() OVER (PARTITION BY key, ordinal % 2 ORDER BY ordinal DESC) = 1)
SELECT issue_key, component, known.name AS component_name, known.path AS component_path, known.enabled AS component_enabled
FROM issues LEFT JOIN known ON component = known.key AND seq % 2 = known.d"""

SQL["minimal_snippets"] = f"""
WITH {ISSUES}, cut AS (SELECT *, (seq % 31 - 2)::int AS a, (seq % 47)::int AS z FROM issues)
SELECT issue_key, component AS path, start_line::int AS start_line,
  (CASE WHEN seq % 2 = 0 THEN start_line ELSE start_line + 1 END)::int AS end_line,
  CASE WHEN seq % 2 <> 0 THEN {_strip(f"message || {NL} || ' second '")}
    WHEN a >= 0 AND a < z AND z <= length(message) AND {_strip('substr(message, a + 1, z - a)')} <> ''
    THEN substr(message, a + 1, z - a) ELSE message END AS code_snippet
FROM cut WHERE status = 'OPEN' AND resolution IS NULL AND component IS NOT NULL
  AND start_line IS NOT NULL AND start_line <> 0"""

SQL["issues_by_date"] = f"WITH {ISSUES} SELECT issue_key, update_date FROM issues"
SQL["component_paths"] = f"SELECT rel_path FROM ({SQL['component_index']}) WHERE rel_path <> ''"

_RUN = f"""
run AS (SELECT *, {WEIGHT} AS w, {_epoch('creation_date')} AS made FROM issues
  WHERE {_epoch('creation_date')} >= epoch(timestamp '1996-01-01') ORDER BY w DESC, made DESC, seq LIMIT 500)"""
SQL["advice_run"] = f"""
WITH {ISSUES}, {_RUN} SELECT issue_key, CASE WHEN seq % 4 = 0 THEN 'model_error' ELSE 'ok' END AS advice_status,
  CASE WHEN seq % 4 <> 0 THEN w * 1e9 + made END AS priority_score,
  CASE WHEN seq % 4 <> 0 THEN 'm-2' ELSE 'm-1' END AS model, CASE WHEN seq % 4 <> 0 THEN concat('Explain ', seq) END AS explanation,
  CASE WHEN seq % 4 = 0 THEN 'model_call_error: no reply' END AS error FROM run"""
SQL["advice_run_counters"] = f"""
WITH {ISSUES}, {_RUN} SELECT (SELECT count(*) FROM issues) AS read,
  (SELECT count(*) FROM issues WHERE {_epoch('creation_date')} >= epoch(timestamp '1996-01-01')) AS filtered,
  count(*) AS processed, count(*) AS written, count(*) FILTER (seq % 4 = 0) AS errors FROM run"""

SQL["payload_texts"] = f"""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat(text, {NL}, 'x') ELSE trim(text, chr(10) || chr(13)) END AS source_text,
  text AS reply_text, concat('[{{"role":"system","content":"sys"}},{{"role":"user","content":', to_json(text), '}}]') AS chat
FROM conversations"""
SQL["jsonl_round_trip"] = """
SELECT event_id, event_type, value, NULL::boolean AS _parse_error, NULL::varchar AS _raw_line FROM events
UNION ALL SELECT event_id, event_type, value, NULL, NULL FROM events WHERE event_id % 3 = 0
UNION ALL SELECT NULL, NULL, NULL, true, concat('{"event_id": ', event_id) FROM events WHERE event_id % 10 = 0"""
SQL["csv_round_trip"] = f"""
SELECT conv_id, turn, concat('"', role, '", ', text, {NL}, '.') AS said FROM conversations"""
SQL["archived_runs"] = f"""
WITH {ISSUES} SELECT issue_key, CASE WHEN seq % 3 = 0 THEN concat('was ', severity) ELSE severity END AS severity,
  CASE WHEN seq % 3 = 0 THEN '20240201' ELSE '20240101' END AS run_ts FROM issues"""
SQL["project_kpi_audit"] = (
    SQL["kpi_audit"].replace(MEASURES, f"measures AS ({SQL['measures_long']})")
    .replace("ORDER BY date DESC", "ORDER BY coalesce(date, '9999') DESC")
)

_ODD = "event_id % 13 <> 12"
SQL["export_unknown_keys"] = f"""
SELECT CASE WHEN {_ODD} THEN concat('E', event_id) ELSE '' END AS issue_key,
  CASE WHEN {_ODD} THEN '' ELSE 'True' END AS _parse_error, CASE WHEN {_ODD} THEN '' ELSE {views.ODD_RECORD} END AS _raw_line,
  CASE WHEN {_ODD} AND event_id % 6 = 2 THEN concat(event_id % 4, '.5') WHEN {_ODD} AND event_id % 6 = 4 THEN '2.0' ELSE '' END AS score,
  CASE WHEN {_ODD} AND event_id % 6 = 2 THEN 'True' WHEN {_ODD} AND event_id % 6 = 4 THEN 'False' ELSE '' END AS live,
  CASE WHEN {_ODD} AND event_id % 6 = 1 THEN concat('u', user_id) WHEN {_ODD} AND event_id % 6 = 2 THEN user_id::varchar ELSE '' END AS who,
  CASE WHEN {_ODD} AND event_id % 6 = 0 THEN user_id::varchar ELSE '' END AS who_id,
  CASE WHEN {_ODD} AND event_id % 6 = 0 THEN concat('["', event_type, '",1]') ELSE '' END AS who_tags,
  CASE WHEN {_ODD} AND event_id % 6 = 1 THEN concat('l', user_id) WHEN {_ODD} AND event_id % 6 = 3 THEN concat('m', user_id) ELSE '' END AS who_last,
  CASE WHEN {_ODD} AND event_id % 6 = 3 THEN (event_id % 9)::varchar ELSE '' END AS who_at_k,
  '' AS who_at_n, '' AS gone, '' AS note FROM events"""
SQL["read_records"] = """
SELECT concat('N', n_nationkey) AS issue_key, n_nationkey::bigint AS n, NULL::varchar AS _raw, NULL::varchar AS _parse_error FROM nation
UNION ALL SELECT concat('R', r_regionkey), r_regionkey, NULL, NULL FROM region
UNION ALL SELECT CASE WHEN o_orderkey % 10 <> 9 THEN concat('O', o_orderkey) END, CASE WHEN o_orderkey % 10 <> 9 THEN o_orderkey END,
  CASE o_orderkey % 20 WHEN 9 THEN concat('{"issue_key": "O', o_orderkey) WHEN 19 THEN o_orderkey::varchar END,
  CASE o_orderkey % 20 WHEN 9 THEN 'json_parse_error' WHEN 19 THEN 'not_dict' END FROM orders"""
_THROUGH = """issue_key, start_line::varchar AS start_line, error, type AS scan_by, concat('{"by":"', type, '","odd key":[1,{"x":null}]}') AS scan"""


def _keys(*more: str) -> str:
    """The keys of an object, in order; some stand only where a condition holds."""
    keys = ["'file_path'", "'issue_key'", "'message'", "'scan'", "'seen'", "'severity'", "'start_line'", *more]
    return f"array_to_string(list_sort(list_filter([{', '.join(keys)}], lambda k: k IS NOT NULL)), ',') AS keys"


_END, _ERROR = "CASE WHEN end_line IS NOT NULL THEN 'end_line' END", "CASE WHEN error IS NOT NULL THEN 'error' END"
_BLOCKED = f"{FILES}, {BUGS}, {BLOCKS}, n AS (SELECT issue_key, count(*) AS n_blocks FROM blocks GROUP BY 1)"
SQL["verbatim_blocks"] = f"""
WITH {_BLOCKED}
SELECT {_THROUGH}, {_keys(_END, _ERROR, "CASE WHEN n_blocks IS NOT NULL THEN 'blocks' END")}, n_blocks::int AS n_blocks
FROM bugs JOIN failed USING (issue_key) LEFT JOIN n USING (issue_key)"""
SQL["verbatim_advice"] = f"""
WITH {_BLOCKED}
SELECT {_THROUGH}, {_keys(_END, _ERROR, "'bug_block_advice'")}, CASE WHEN issue_key LIKE '%7' THEN '' ELSE 'm' END AS model,
  CASE WHEN issue_key NOT LIKE '%7' THEN concat('Explain ', issue_key) END AS explanation,
  CASE WHEN issue_key NOT LIKE '%7' THEN concat('```c', {NL}, 'x;', {NL}, '```') END AS code_update
FROM bugs JOIN failed USING (issue_key)"""
SQL["advice_run_written"] = f"SELECT *, written AS landed FROM ({SQL['advice_run_counters']})"
SQL["publish_changes"] = f"""
WITH {ISSUES}
SELECT issue_key, CASE WHEN seq % 5 <> 0 THEN severity END AS severity, CASE WHEN seq % 5 <> 0 THEN status END AS status,
  CASE WHEN seq % 5 <> 0 THEN effort END AS effort,
  CASE WHEN seq % 3 = 0 THEN 'new' WHEN seq % 5 = 0 THEN 'removed' ELSE 'changed' END AS change FROM issues
WHERE (seq % 3 = 0 AND seq % 5 <> 0) OR (seq % 3 <> 0 AND (seq % 5 = 0 OR seq % 7 = 0))"""


def _counted(name: str, rows: str, columns: Sequence[str]) -> str:
    return f"SELECT '{name}' AS name, count(*) AS n, '{','.join(sorted(columns))}' AS columns FROM ({rows})"


SQL["written_tables"] = " UNION ALL ".join((
    _counted("measures", SQL["measures_long"], MEASURE_COLUMNS),
    _counted("quality_gate", SQL["quality_conditions"], QUALITY_COLUMNS),
    _counted("severe_issues", "SELECT 1 FROM orders WHERE o_orderkey % 50 <> 49", SEVERE_ISSUE_COLUMNS),
    _counted("measures_audit", SQL["project_kpi_audit"], ("project_key", "metric", "value", "op", "threshold", "status", "reason")),
    _counted("gate_audit", SQL["gate_audit"], (
        "project_key", "gate_status", "metric_key", "condition_status", "comparator", "error_threshold", "actual_value",
        "kpi_status", "reason")),
))
SQL["project_texts"] = f"SELECT project, text || {NL} AS text FROM ({SQL['kpi_audit_texts']})"
SQL["json_document"] = SQL["project_facet"]
SQL["tolerant_lines"] = f"""
SELECT CASE WHEN {_ODD} THEN concat('E', event_id) END AS issue_key, CASE WHEN NOT {_ODD} THEN event_id END AS first
FROM events WHERE {_ODD} OR event_id % 2 = 1"""
SQL["saved_index"] = f"""
SELECT component_key, rel_path, name, language, module, ext, saved_as FROM ({SQL['component_index']}), (VALUES ('jsonl'), ('csv')) AS v(saved_as)"""


def all_sql() -> dict[str, str]:
    return dict(SQL)
