"""Nested records → flat, stable tables for BI tools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Leading columns of the export and text columns it always has.
PREFERRED_COLUMNS = (
    "issue_key",
    "project",
    "component",
    "file_path",
    "type",
    "severity",
    "rule",
    "rule_name",
    "message",
    "effort",
    "start_line",
    "end_line",
    "creation_date",
    "update_date",
    "priority_score",
)
TEXT_COLUMNS = (
    "copilot_advice.raw",
    "copilot_advice.explanation",
    "copilot_advice.code_update",
)


def _quoted(path: Sequence[str]) -> str:
    return ".".join(f"`{p}`" for p in path)


def _leaves(
    schema: T.StructType, path: tuple[str, ...], depth: int | None
) -> list[tuple[str, ...]]:
    out = []
    for field in schema.fields:
        here = (*path, field.name)
        nested = isinstance(field.dataType, T.StructType)
        if nested and (depth is None or len(path) < depth):
            out += _leaves(field.dataType, here, depth)
        else:
            out.append(here)
    return out


def flatten(df: DataFrame, max_level: int | None = None) -> DataFrame:
    """Struct fields as dotted columns, `max_level` levels deep (None: all)."""
    return df.select(
        *[F.col(_quoted(p)).alias(".".join(p)) for p in _leaves(df.schema, (), max_level)]
    )


def ensure_text_columns(df: DataFrame, names: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else df


def _cell(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        options = {"ignoreNullFields": "false"}
        return F.to_json(c, options)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return plain_number(c)
    return c.cast("string")


def plain_number(c: Column) -> Column:
    """Double without an exponent in the usual range: 6729313891.0, 0.25."""
    digits = F.rtrim(c.cast("double").try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    usual = ((F.abs(c) >= 1e-4) & (F.abs(c) < 1e16)) | (c == 0)
    return F.when(usual, plain).otherwise(c.cast("string"))


def finalize(df: DataFrame, preferred: Sequence[str] = PREFERRED_COLUMNS) -> DataFrame:
    """Nested values as JSON text, preferred columns first, the rest sorted, nulls empty."""
    first = [c for c in preferred if c in df.columns]
    order = first + sorted(c for c in df.columns if c not in first)
    fields = {f.name: f for f in df.schema.fields}
    return df.select(
        *[F.coalesce(_cell(fields[c]), F.lit("")).alias(c) for c in order]
    )


def export_table(
    df: DataFrame,
    flat: bool = True,
    max_level: int | None = None,
    preferred: Sequence[str] = PREFERRED_COLUMNS,
    text_columns: Sequence[str] = TEXT_COLUMNS,
) -> DataFrame:
    """The complete shaping of a record table for CSV."""
    shaped = flatten(df, max_level) if flat else df
    return finalize(ensure_text_columns(shaped, text_columns), preferred)
