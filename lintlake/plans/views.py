"""Domain tables derived from the shared tables.

Each view is a list of SQL expressions that Spark and the checking SQL both understand, so
the two sides start from the same rows by construction and differ only in the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUES = {
    "seq": "o_orderkey",
    "issue_key": "concat('ISS-', o_orderkey)",
    "project": "concat('proj', o_custkey % 12)",
    "component": (
        "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE concat('proj', o_custkey % 12, ':m', "
        "o_custkey % 7, '/src/f', o_custkey % 97, CASE o_custkey % 4 WHEN 0 THEN '.cpp' "
        "WHEN 1 THEN '.h' WHEN 2 THEN '.cs' ELSE '.py' END) END"
    ),
    "rule": "concat('cpp:S', o_orderkey % 30)",
    "type": (
        "CASE o_orderkey % 3 WHEN 0 THEN 'BUG' WHEN 1 THEN 'VULNERABILITY' ELSE 'CODE_SMELL' END"
    ),
    "severity": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'BLOCKER' WHEN '2-HIGH' THEN 'critical' "
        "WHEN '3-MEDIUM' THEN 'MAJOR' WHEN '4-NOT SPECIFIED' THEN 'MINOR' ELSE 'UNKNOWN' END"
    ),
    "status": (
        "CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'CONFIRMED' ELSE 'CLOSED' END"
    ),
    "resolution": "CASE WHEN o_orderstatus = 'F' THEN 'FIXED' END",
    "message": "concat('message ', o_orderkey, ' with {issue_key} and a <tag>')",
    "effort": (
        "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN concat(o_orderkey % 3, 'h ', "
        "o_orderkey % 60, 'min') WHEN 2 THEN concat(o_orderkey % 4, 'd') "
        "WHEN 3 THEN concat(o_orderkey % 7, ' h') WHEN 4 THEN 'soon' ELSE '' END"
    ),
    "debt": "CASE WHEN o_orderkey % 4 = 0 THEN concat(o_orderkey % 50, 'min') END",
    "start_line": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 40 END",
    "creation_date": (
        "CASE WHEN o_orderkey % 101 = 0 THEN '' WHEN o_orderkey % 103 = 0 THEN 'yesterday' ELSE "
        "concat(substr(cast(o_orderdate AS string), 1, 10), 'T', "
        "lpad(cast(o_orderkey % 24 AS string), 2, '0'), ':00:00+0000') END"
    ),
    "update_date": (
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat(substr(cast(o_orderdate AS string), "
        "1, 10), 'T23:', lpad(cast(o_orderkey % 60 AS string), 2, '0'), ':00+0000') END"
    ),
}

ANALYSES = {
    # One project in 12 was never analysed.
    "project": "concat(CASE WHEN user_id % 12 = 5 THEN 'gone' ELSE 'proj' END, user_id % 12)",
    "date": (
        "concat(cast(1995 + user_id % 6 AS string), substr(cast(ts AS string), 5, 6), "
        "'T00:00:00+0000')"
    ),
}

RULES = {
    "key": "concat('cpp:S', n_nationkey)",
    "name": "CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE concat('Rule ', n_name) END",
    "htmlDesc": (
        "CASE n_nationkey % 3 WHEN 0 THEN concat('<p>Do <b>not</b> use ', n_name, "
        "' &amp; &quot;friends&quot;</p>', '\n') WHEN 1 THEN '' END"
    ),
    "mdDesc": "CASE WHEN n_nationkey % 2 = 0 THEN concat('plain ', n_name) END",
}

COMPONENTS = {
    "page_no": "cast(floor(c_custkey / 500) AS bigint)",
    "pos": "c_custkey % 500",
    "ordinal": "c_custkey",
    "key": (
        "CASE WHEN c_custkey % 61 = 0 THEN '' ELSE concat('proj', c_custkey % 12, ':m', "
        "c_custkey % 7, '/src/f', c_custkey % 97, CASE c_custkey % 4 WHEN 0 THEN '.cpp' "
        "WHEN 1 THEN '.h' WHEN 2 THEN '.cs' ELSE '.py' END) END"
    ),
    "path": (
        "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE concat('m', c_custkey % 7, CASE c_custkey % 11 "
        "WHEN 0 THEN '/obj/' WHEN 1 THEN '/packages/x/' ELSE '/src/' END, 'f', c_custkey, '.x') END"
    ),
    "name": (
        "CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN 'Makefile' ELSE "
        "concat('f', c_custkey, '.gen.', CASE c_custkey % 4 WHEN 0 THEN 'cpp' WHEN 1 THEN 'h' "
        "WHEN 2 THEN 'cs' ELSE 'py' END) END"
    ),
    "language": (
        "CASE c_custkey % 5 WHEN 0 THEN 'cpp' WHEN 1 THEN 'cs' WHEN 2 THEN 'py' WHEN 3 THEN 'c' END"
    ),
    "qualifier": "CASE WHEN c_custkey % 10 = 0 THEN 'UTS' ELSE 'FIL' END",
    "enabled": "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END",
}

GATES = {
    # One project's gate is missing.
    "project": "concat(CASE WHEN n_nationkey = 11 THEN 'gone' ELSE 'proj' END, n_nationkey)",
    "gate_status": "CASE n_nationkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'WARN' ELSE 'ERROR' END",
}

# One metric value per line item; two audited ratings are never measured.
MEASURES = {
    "project_key": "concat('proj', l_suppkey % 12)",
    "metric": (
        "CASE l_partkey % 11 WHEN 0 THEN 'coverage' WHEN 1 THEN 'new_coverage' "
        "WHEN 2 THEN 'duplicated_lines_density' WHEN 3 THEN 'new_duplicated_lines_density' "
        "WHEN 4 THEN 'security_rating' WHEN 5 THEN 'bugs' WHEN 6 THEN 'vulnerabilities' "
        "WHEN 7 THEN 'code_smells' WHEN 8 THEN 'new_code_smells' WHEN 9 THEN 'sqale_index' "
        "ELSE 'ncloc' END"
    ),
    "value": (
        "CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_partkey % 11 IN (4, 5, 6) "
        "THEN cast(l_orderkey % 3 AS double) WHEN l_partkey % 11 IN (2, 3) "
        "THEN l_quantity / 4 ELSE l_quantity * 2 END"
    ),
    "date": "concat(substr(cast(l_shipdate AS string), 1, 10), 'T00:00:00+00:00')",
}

PATH = (
    "concat('m', {d} % 7, '/', CASE WHEN {d} % 11 = 5 THEN 'Tests' ELSE concat('s', {d} % 20) END, "
    "'/d', {d}, CASE WHEN {d} % 10 = 9 THEN '.h' ELSE '.cpp' END)"
)

# One code-like line around each line of a document; blank lines stay blank.
CODE_LINE = (
    "CASE WHEN trim({b}) = '' THEN '' "
    "WHEN {i} = 1 THEN concat('#include \"d', doc_id + 7, '.h\" // ', {b}) "
    "WHEN {i} = 2 AND doc_id % 3 = 0 THEN concat('// ', {b}) "
    "WHEN {i} % 13 = 3 THEN concat('class K', doc_id % 50, ' : public B', (doc_id + {i}) % 40, "
    "', private virtual B', {i} % 7, ' {{ // ', {b}) "
    "WHEN {i} % 6 = 2 THEN concat('int C', doc_id % 5, '::fn', (doc_id + {i}) % 400, "
    "'(int a) /* ', {b}, ' */') "
    "WHEN {i} % 9 = 4 THEN concat(repeat(' ', cast(4 * (1 + (doc_id + {i} * {i}) % 3) AS int)), "
    "'C', (doc_id + {i}) % 5, '::fn', (doc_id * 7 + {i}) % 400, '(x', {i}, ', \"', {b}, '\");') "
    "ELSE concat(repeat(' ', cast(4 * (1 + (doc_id + {i} * {i}) % 3) AS int)), 'fn', "
    "(doc_id * 7 + {i}) % 400, '(x', {i}, ', \"', {b}, '\");') END"
)


def _load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _view(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str],
          where: str | None = None) -> DataFrame:
    df = _load(spark, sf_dir, table)
    df = df.where(where) if where else df
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", ISSUES)


def analyses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "events", ANALYSES)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "nation", {k: v.replace("\n", "\\n") for k, v in RULES.items()})


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", COMPONENTS)


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "nation", GATES)


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", MEASURES)


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_path, text): every document as a source file."""
    line = CODE_LINE.format(b="b", i="(i0 + 1)")
    documents = _load(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.selectExpr(
        f"{PATH.format(d='doc_id')} AS file_path",
        f"array_join(transform(split(text, '\\n'), (b, i0) -> {line}), '\\n') AS text",
    )


BUG_FIELDS = {
    "severity": (
        "CASE doc_id % 4 WHEN 0 THEN 'BLOCKER' WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'MAJOR' END"
    ),
    "type": "'BUG'",
    "rule": "concat('cpp:S', doc_id % 30)",
    "message": "concat('bug {context_block} ', doc_id)",
    "code_snippet": "concat('snippet of ', doc_id)",
}
# A bug in every document, and for every third document one more in the first document.
OWN_BUG = {
    "issue_key": "concat('BUG-', doc_id)",
    "file_path": PATH.format(d="doc_id"),
    "start_line": "cast(1 + (doc_id * 3) % n AS int)",
    "end_line": "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE cast(1 + (doc_id * 3) % n + doc_id % 3 AS int) END",
    **BUG_FIELDS,
}
HOT_BUG = {
    "issue_key": "concat('HOT-', doc_id)",
    "file_path": "CASE WHEN doc_id % 30 = 0 THEN concat('gone/d', doc_id, '.cpp') ELSE 'm0/s0/d0.cpp' END",
    "start_line": "CASE WHEN doc_id % 45 = 3 THEN NULL ELSE cast(1 + doc_id % 12 AS int) END",
    "end_line": "CASE WHEN doc_id % 45 = 3 THEN NULL ELSE cast(1 + doc_id % 12 AS int) END",
    **BUG_FIELDS,
}


def bugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _load(spark, sf_dir, "documents").selectExpr("doc_id", "size(split(text, '\\n')) AS n")
    own = docs.selectExpr(*[f"{e} AS {c}" for c, e in OWN_BUG.items()])
    hot = docs.where("doc_id % 3 = 0").selectExpr(*[f"{e} AS {c}" for c, e in HOT_BUG.items()])
    return own.unionByName(hot)


# Issues that point into the source files; a third of them at one file.
LOCATED = {
    "issue_key": "concat('ISS-', o_orderkey)",
    "file_path": (
        "CASE WHEN o_orderkey % 19 = 1 THEN '' WHEN o_orderkey % 23 = 1 THEN NULL "
        "WHEN o_orderkey % 3 = 0 THEN 'm0/s0/d0.cpp' ELSE "
        + PATH.format(d="(o_orderkey % n_docs)")
        + " END"
    ),
    "start_line": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE cast(o_orderkey % 14 AS int) END",
    "end_line": (
        "CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 4 = 0 THEN NULL "
        "ELSE cast(o_orderkey % 14 + o_orderkey % 5 - 1 AS int) END"
    ),
}


def located_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _load(spark, sf_dir, "documents").agg(F.count("*")).scalar()
    orders = _load(spark, sf_dir, "orders").withColumn("n_docs", documents)
    return orders.selectExpr(*[f"{e} AS {n}" for n, e in LOCATED.items()])


# Measure documents, one per part: value; history; value with periods; period object; nameless.
MEASURE_DOC = (
    "CASE p_partkey % 6 "
    "WHEN 0 THEN concat('{\"measures\":[{\"metric\":\"coverage\",\"value\":\"', p_size, ',5\"},"
    "{\"key\":\"bugs\",\"value\":\"', p_partkey % 9, '\",\"periodIndex\":1}]}') "
    "WHEN 1 THEN concat('{\"component\":{\"measures\":[{\"metric\":\"ncloc\",\"value\":\"7\",\"history\":["
    "{\"date\":\"2024-01-01T00:00:00+0000\",\"value\":\"', p_size, '\"},"
    "{\"date\":\"2024-02-01T00:00:00+0100\",\"value\":\"n/a\"}]}]}}') "
    "WHEN 2 THEN concat('{\"measures\":[{\"metric\":\"new_coverage\",\"value\":\"', p_size, '.25\","
    "\"period\":3,\"periods\":[{\"index\":2,\"value\":\"', p_partkey % 50, '\",\"date\":"
    "\"2024-03-01T00:00:00Z\"},{\"value\":\"\"}]}]}') "
    "WHEN 3 THEN concat('{\"measures\":[{\"metric\":\"new_bugs\",\"period\":{\"index\":1,\"value\":\"', "
    "p_size, '\"}}]}') "
    "WHEN 4 THEN concat('{\"measures\":[{\"value\":\"', p_size, '\"},{\"metric\":\"lines\"}]}') "
    "ELSE '{\"component\":{\"measures\":[]}}' END"
)

GATE_DOC = (
    "concat('{\"projectStatus\":{\"status\":\"', CASE c_custkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'ERROR' "
    "ELSE 'WARN' END, '\",', CASE c_custkey % 4 WHEN 0 THEN '\"ignoredConditions\":true,' ELSE '' END, "
    "CASE c_custkey % 5 WHEN 0 THEN '\"period\":{\"mode\":\"previous\",\"date\":\"2024-01-01T00:00:00+0000\"},' "
    "WHEN 1 THEN '\"periods\":[{\"index\":1,\"mode\":\"a\"},{\"index\":1,\"mode\":\"b\",\"date\":\"2024-02-01\"}],' "
    "ELSE '' END, '\"conditions\":[{\"status\":\"', CASE c_custkey % 2 WHEN 0 THEN 'OK' ELSE 'ERROR' END, "
    "'\",\"metricKey\":\"new_coverage\",\"comparator\":\"LT\",\"periodIndex\":1,\"errorThreshold\":\"85\","
    "\"actualValue\":\"', c_custkey % 100, ',5\"},{\"status\":\"OK\",\"metricKey\":\"', "
    "CASE c_custkey % 3 WHEN 0 THEN 'new_security_rating' WHEN 1 THEN 'duplicated_lines_density' "
    "ELSE 'ncloc' END, '\",\"comparator\":\"GT\",\"errorThreshold\":\"1\",\"actualValue\":\"', "
    "c_custkey % 5, '\"}]}}')"
)


# Records whose keys differ by row, as JSON text; every 13th is broken or no object.
ODD_RECORD = (
    "CASE WHEN event_id % 13 = 12 THEN CASE WHEN event_id % 2 = 0 THEN concat('{\"issue_key\": \"E', event_id) "
    "ELSE concat('[', event_id, ']') END ELSE concat('{\"issue_key\":\"E', event_id, '\"', CASE event_id % 6 "
    "WHEN 0 THEN concat(',\"who\":{\"id\":', user_id, ',\"tags\":[\"', event_type, '\",1]}') "
    "WHEN 1 THEN concat(',\"who\":\"u', user_id, '\",\"who.last\":\"l', user_id, '\"') "
    "WHEN 2 THEN concat(',\"who\":', user_id, ',\"score\":', event_id % 4, '.5,\"live\":true') "
    "WHEN 3 THEN concat(',\"who\":{\"last\":\"m', user_id, '\",\"at\":{\"deep\":{}, \"n\":null,\"k\":', event_id % 9, '}}') "
    "WHEN 4 THEN ',\"score\":2,\"live\":false,\"gone\":null' ELSE '' END, '}') END"
)

# Bugs with keys that no schema declares; a line number as text, a null and nested values.
LANDED_BUG = (
    "concat('{\"issue_key\":\"', issue_key, '\",\"file_path\":\"', file_path, '\",\"start_line\":', "
    "coalesce(cast(start_line AS string), 'null'), ',\"severity\":', CASE WHEN severity IS NULL THEN 'null' "
    "ELSE concat('\"', severity, '\"') END, CASE WHEN end_line IS NULL THEN '' ELSE concat(',\"end_line\":', end_line) END, "
    "',\"message\":\"', message, '\",\"scan\":{\"by\":\"', type, '\",\"odd key\":[1,{\"x\":null}]},\"seen\":null}')"
)


def odd_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): JSON lines."""
    return _load(spark, sf_dir, "events").selectExpr(f"{ODD_RECORD} AS value")


def landed_bugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): `bugs` as JSON lines."""
    return bugs(spark, sf_dir).selectExpr(f"{LANDED_BUG} AS value")


def array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value): one text a region, an array over several lines with a number among the objects."""
    item = "concat('  {\"issue_key\":\"N', n_nationkey, '\",\"n\":', n_nationkey, '}')"
    rows = _load(spark, sf_dir, "nation").selectExpr("n_regionkey", f"{item} AS item")
    return rows.groupBy("n_regionkey").agg(F.collect_list("item").alias("items")).selectExpr(
        "concat('array', n_regionkey) AS name", "concat('[\\n7,\\n', array_join(items, ',\\n'), '\\n]') AS value"
    )


def object_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, value): one text a region, an indented object."""
    return _load(spark, sf_dir, "region").selectExpr(
        "concat('object', r_regionkey) AS name",
        "concat('{\\n  \"issue_key\": \"R', r_regionkey, '\",\\n  \"n\": ', r_regionkey, '\\n}\\n') AS value",
    )


def object_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): an object a line, every tenth line broken or a number."""
    return _load(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderkey % 20 WHEN 9 THEN concat('{\"issue_key\": \"O', o_orderkey) WHEN 19 THEN cast(o_orderkey AS string) "
        "ELSE concat('{\"issue_key\":\"O', o_orderkey, '\",\"n\":', o_orderkey, '}') END AS value"
    )
