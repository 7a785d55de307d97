"""Columns of records whose keys are not declared.

The keys come from the records themselves: `schema_of_variant_agg` merges the shapes of all
records in one distributed aggregate, and what reaches the driver is one schema text, as long
as the list of keys. Where a key holds an object in some records and something else in
others, the merged shape says only that; its objects are asked once more.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lintlake.operators.flatten import PREFERRED_COLUMNS, TEXT_COLUMNS, plain_number

Path = tuple[str, ...]


@dataclass
class Shape:
    """What a key holds: a kind of value, the keys of its objects, or both in different records."""

    kind: T.DataType | None = None
    keys: dict[str, Shape] = field(default_factory=dict)


def _type_of(schema: str) -> T.DataType:
    """The data type of a variant's schema text; quoted names are left as they are."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], schema)
    return T.StructType.fromDDL(f"v {ddl}")["v"].dataType


def _shape(kind: T.DataType) -> Shape:
    if isinstance(kind, T.StructType):
        return Shape(None, {f.name: _shape(f.dataType) for f in kind.fields})
    return Shape(kind)


def at(record: Column, path: Path) -> Column:
    """The value at a path of keys, as a variant."""
    for key in path:
        if '"' not in key:
            record = F.try_variant_get(record, f'$["{key}"]', "variant")
        elif "'" not in key:
            record = F.try_variant_get(record, f"$['{key}']", "variant")
        else:
            record = F.try_element_at(F.try_variant_get(record, "$", "map<string,variant>"), F.lit(key))
    return record


def _walk(shape: Shape, path: Path = ()) -> list[tuple[Path, Shape]]:
    out = [(path, shape)]
    for key, below in shape.keys.items():
        out += _walk(below, (*path, key))
    return out


def shape_of(records: DataFrame, record: str = "record") -> Shape:
    """The merged shape of a variant column; rows without an object have no part in it."""
    value = F.col(f"`{record}`")

    def merged(of: Column) -> Column:
        return F.schema_of_variant_agg(F.when(F.startswith(F.schema_of_variant(of), F.lit("OBJECT<")), of))

    row = records.agg(merged(value).alias("s")).first()
    whole = _shape(_type_of(row["s"])) if row["s"] and row["s"] != "VOID" else Shape()
    asked: set[Path] = set()
    while True:
        open_paths = [p for p, s in _walk(whole) if isinstance(s.kind, T.VariantType) and p not in asked]
        if not open_paths:
            return whole
        found = records.agg(*[merged(at(value, p)).alias(f"p{i}") for i, p in enumerate(open_paths)]).first()
        for i, path in enumerate(open_paths):
            asked.add(path)
            if found[i] and found[i].startswith("OBJECT<"):
                shape = whole
                for key in path:
                    shape = shape.keys[key]
                shape.keys = _shape(_type_of(found[i])).keys


def columns_of(shape: Shape, max_level: int | None = None) -> dict[str, list[tuple[Path, Shape, bool]]]:
    """Dotted name → the paths that give it, with whether objects there stay whole.

    Objects are opened `max_level` levels deep (None: all).
    """
    out: dict[str, list[tuple[Path, Shape, bool]]] = {}

    def add(shape: Shape, path: Path) -> None:
        whole = max_level is not None and len(path) > max_level
        if path and (shape.kind is not None or (whole and shape.keys)):
            out.setdefault(".".join(path), []).append((path, shape, whole))
        if not whole:
            for key, below in shape.keys.items():
                add(below, (*path, key))

    add(shape, ())
    return out


def cell(value: Column, kind: T.DataType | None, objects: bool) -> Column:
    """A value as the text of a cell: lists (and `objects`, if they stay whole) as JSON text."""
    text = F.try_variant_get(value, "$", "string")
    number = plain_number(F.try_variant_get(value, "$", "double"))
    json = F.to_json(value, {"ignoreNullFields": "false"})
    logical = F.when(text == "true", F.lit("True")).otherwise(F.lit("False"))
    if isinstance(kind, (T.StringType, T.LongType)):
        return text
    if isinstance(kind, T.BooleanType):
        return F.when(text.isNotNull(), logical)
    if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision > 18:
        return text
    if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
        return number
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("string")
    if isinstance(kind, T.ArrayType):
        return json
    # Kinds differ from record to record.
    own = F.schema_of_variant(value)
    return (
        F.when(own.isin("STRING", "BIGINT"), text)
        .when(own == "BOOLEAN", logical)
        .when(own == "VOID", F.lit(None).cast("string"))
        .when(F.startswith(own, F.lit("OBJECT<")), json if objects else F.lit(None).cast("string"))
        .when(F.startswith(own, F.lit("ARRAY<")), json)
        .otherwise(number)
    )


def export_table(
    df: DataFrame,
    record: str = "record",
    flat: bool = True,
    max_level: int | None = None,
    preferred: Sequence[str] = PREFERRED_COLUMNS,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    shape: Shape | None = None,
) -> DataFrame:
    """Records (variants) and the other columns of `df` → one flat table of texts for CSV.

    Columns are the keys found, `preferred` first and the rest sorted, nulls empty. A name
    that is both a dotted path and a key of its own is one column.
    """
    shape = shape or shape_of(df, record)
    value = F.col(f"`{record}`")
    cells: dict[str, Column] = {c: F.col(f"`{c}`").cast("string") for c in df.columns if c != record}
    for c, kind in df.dtypes:
        if kind == "boolean":
            cells[c] = F.when(F.col(f"`{c}`"), F.lit("True")).when(~F.col(f"`{c}`"), F.lit("False"))
    for name, sources in columns_of(shape, max_level if flat else 0).items():
        found = [cell(at(value, path), below.kind, whole) for path, below, whole in sources]
        cells[name] = F.coalesce(*found, *([cells[name]] if name in cells else []))
    for name in text_columns:
        cells.setdefault(name, F.lit(None).cast("string"))
    first = [c for c in preferred if c in cells]
    order = first + sorted(c for c in cells if c not in first)
    return df.select(*[F.coalesce(cells[c], F.lit("")).alias(c) for c in order])
