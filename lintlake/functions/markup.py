"""HTML payloads and model replies as text."""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lintlake.functions.text import strip

FENCE = "```"


def drop_tags(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")


# Entities looked up before the whole table, because most texts hold no others.
COMMON_ENTITIES = {
    "&amp;": "&",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "\xa0",
}
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Names that count without a semicolon, and so also as the beginning of a longer word.
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_UNKNOWN = "\ufffd"


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def _code_point(n: Column) -> Column:
    """The character of a number; what HTML forbids is left out or replaced."""
    low = {i: html.unescape(f"&#{i};") for i in range(160)}
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    last = n % 65_536
    return (
        F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), _UNKNOWN)
        .when(n < 160, F.try_element_at(_literal_map(low), n.cast("int")))
        .when(n.between(0xFDD0, 0xFDEF) | (last >= 0xFFFE), "")
        .otherwise(plain)
    )


def _reference(r: Column) -> Column:
    """One character reference as text; what is none stays as it is."""
    name = F.substr(r, F.lit(2))
    digits = F.regexp_replace(r, "^&#0*|;$", "")
    hexed = F.regexp_replace(r, "^&#[xX]0*|;$", "")
    # Longer numbers lie beyond all characters.
    number = F.when(F.length(digits) <= 9, F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")).cast("bigint"))
    hex_number = F.when(F.length(hexed) <= 8, F.conv(F.coalesce(F.nullif(hexed, F.lit("")), F.lit("0")), 16, 10).cast("bigint"))
    table = _literal_map(dict(html5))
    start = F.regexp_extract(name, "^(" + "|".join(_OPEN_NAMES) + ")", 1)
    rest = F.substr(name, F.length(start) + 1)
    common = F.when(F.lit(False), r)
    for entity, char in COMMON_ENTITIES.items():
        common = common.when(r == entity, F.lit(char))
    return (
        common.when(r.rlike("^&#[xX]"), _code_point(hex_number))
        .when(r.rlike("^&#"), _code_point(number))
        .otherwise(
            F.coalesce(
                F.try_element_at(table, name),
                F.when(start != "", F.concat(F.try_element_at(table, start), rest)),
                r,
            )
        )
    )


def unescape(c: Column) -> Column:
    """Character references by the public HTML table and by code point, in the JVM."""
    found = F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0))
    between = F.split(c, _REFERENCE, -1)
    decoded = F.array_append(F.transform(found, _reference), F.lit(""))
    joined = F.array_join(F.zip_with(between, decoded, lambda gap, text: F.concat(gap, text)), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def strip_html(c: Column) -> Column:
    """Drop tags, decode character references, trim line ends and blanks."""
    return F.btrim(unescape(drop_tags(c)), F.lit("\n\r "))


def core_slice(line: Column, start_offset: Column, end_offset: Column) -> Column:
    """Characters [start, end) of one line; the whole line if the range is bad or blank."""
    core = F.substr(line, start_offset + 1, end_offset - start_offset)
    good = (start_offset >= 0) & (start_offset < end_offset) & (end_offset <= F.length(line))
    return F.when(good & (strip(core) != ""), core).otherwise(line)


def source_payload_text(c: Column) -> Column:
    """{"sources":[{"code":…}]} → the code lines; any other payload is returned trimmed."""
    parsed = F.from_json(c, "struct<sources:array<struct<code:string>>>")
    codes = F.transform(parsed.getField("sources"), lambda s: F.coalesce(s["code"], F.lit("")))
    is_json = F.try_parse_json(c).isNotNull() & F.ltrim(c).rlike(r"^[\[{]")
    return F.when(
        is_json, F.rtrim(F.coalesce(F.array_join(codes, "\n"), F.lit("")), F.lit("\n\r"))
    ).otherwise(F.btrim(c, F.lit("\n\r")))


def _json_text(v: Column, *names: str) -> Column:
    """First non-empty top-level value among `names`, as text."""
    values = [F.nullif(F.try_variant_get(v, f"$.{n}", "string"), F.lit("")) for n in names]
    return F.coalesce(*values, F.lit(""))


def advice_parts(raw: Column) -> Column:
    """Reply text → struct(explanation, code_update, raw).

    A JSON reply is read by key; otherwise the first fenced block is the code (fences kept)
    and the text before it the explanation.
    """
    text = F.coalesce(raw, F.lit(""))
    v = F.try_parse_json(text)
    explanation = _json_text(v, "explanation", "reasoning")
    update = _json_text(v, "code_update", "patch", "code")
    from_json = v.isNotNull() & ((explanation != "") | (update != ""))
    start = F.locate(FENCE, text)
    tail = F.substr(text, start + 3)
    close = F.locate(FENCE, tail)
    fenced = F.when(close > 0, F.substr(text, start, close + 5)).otherwise(F.substr(text, start))
    return F.struct(
        F.when(from_json, explanation)
        .when(start == 0, strip(text))
        .otherwise(strip(F.left(text, start - 1)))
        .alias("explanation"),
        F.when(from_json, update)
        .when(start == 0, F.lit(""))
        .otherwise(strip(fenced))
        .alias("code_update"),
        text.alias("raw"),
    )


def strip_fence(c: Column) -> Column:
    """Content of a surrounding code fence, language tag included; else the stripped text."""
    t = strip(c)
    parts = F.split(t, FENCE)
    return F.when(
        F.startswith(t, F.lit(FENCE)) & (F.size(parts) >= 3), strip(F.get(parts, F.lit(1)))
    ).otherwise(t)


def reply_text(payload: Column) -> Column:
    """choices[0].message.content of a response payload, else the payload itself."""
    v = F.try_parse_json(payload)
    return F.coalesce(F.try_variant_get(v, "$.choices[0].message.content", "string"), payload)
