"""Declared input and output schemas."""

from __future__ import annotations

# One landed issue, in either naming. Line numbers are read as text so that
# unreadable ones can be reported instead of vanishing.
RAW_ISSUE_FIELDS = """
key string, issue_key string, rule string, rule_key string, rule_name string,
severity string, type string, component string, project string,
message string, rule_message string, effort string, debt string,
status string, resolution string, scope string, tags array<string>,
creationDate string, creation_date string, updateDate string, update_date string,
path string, file_path string, code_snippet string,
line string, start_line string, end_line string,
textRange struct<startLine:string,endLine:string,startOffset:string,endOffset:string>,
flows array<variant>, locations array<variant>
""".replace("\n", " ").strip()

COMPONENT_FIELDS = (
    "key:string,path:string,name:string,language:string,qualifier:string,enabled:boolean"
)

# A landed line is a page (issues, components, paging) or one issue.
LANDED_LINE = (
    "issues array<struct<"
    + ",".join(f.strip().replace(" ", ":", 1) for f in RAW_ISSUE_FIELDS.split(", "))
    + f">>, components array<struct<{COMPONENT_FIELDS}>>, "
    "paging struct<pageIndex:int,pageSize:int,total:long>, " + RAW_ISSUE_FIELDS
)

ISSUE_COLUMNS = (
    "issue_key",
    "project",
    "component",
    "rule",
    "rule_name",
    "type",
    "severity",
    "message",
    "effort",
    "tags",
    "file_path",
    "start_line",
    "end_line",
    "code_snippet",
    "creation_date",
    "update_date",
)

SEVERE_ISSUE_COLUMNS = (
    "issue_key",
    "rule",
    "severity",
    "component",
    "project",
    "line",
    "message",
    "effort_min",
    "creation_date",
    "update_date",
    "type",
    "scope",
    "startLine",
    "endLine",
    "startOffset",
    "endOffset",
    "component_name",
    "component_qualifier",
    "component_path",
    "component_enabled",
)

MEASURE_COLUMNS = ("project_key", "metric", "value", "date", "period_index")

QUALITY_COLUMNS = (
    "project_key",
    "gate_status",
    "ignored_conditions",
    "condition_status",
    "metric_key",
    "comparator",
    "period_index",
    "error_threshold",
    "actual_value",
    "period_mode",
    "period_date",
)

MEASURES_DOCUMENT = (
    "component struct<measures:array<{m}>>, measures array<{m}>".format(
        m="struct<metric:string,key:string,value:string,period:variant,periodIndex:string,"
        "history:array<struct<date:string,value:string>>,"
        "periods:array<struct<index:string,value:string,date:string>>>"
    )
)

GATE_DOCUMENT = (
    "projectStatus struct<status:string,ignoredConditions:boolean,"
    "periods:array<struct<index:string,mode:string,date:string>>,"
    "period:struct<index:string,mode:string,date:string>,"
    "conditions:array<struct<status:string,metricKey:string,comparator:string,"
    "periodIndex:string,errorThreshold:string,actualValue:string>>>"
)

ISSUES_DOCUMENT = LANDED_LINE + ", total long"

BLOCK = "struct<level:int,indent:int,start:int,end:int,code:string>"
