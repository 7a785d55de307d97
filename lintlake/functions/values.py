"""Numbers, durations, dates and severities."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from lintlake.functions.text import first_truthy, strip

# Severity → rank weight; anything else weighs 0.
SEVERITY_WEIGHT = {"BLOCKER": 5, "CRITICAL": 4, "MAJOR": 3, "MINOR": 2, "INFO": 1}
SEVERITY_SCALE = 1_000_000_000

_DIGITS = r"\d+(?:_\d+)*"
_INTEGER = rf"^[+-]?{_DIGITS}$"
_DECIMAL = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)
_STAMP = (
    r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
)


def to_int(c: Column) -> Column:
    """Integer text → bigint; anything else (also '12.5') → null."""
    t = strip(c)
    return F.when(t.rlike(_INTEGER), F.replace(t, F.lit("_"), F.lit("")).try_cast("bigint"))


def to_float(c: Column) -> Column:
    """Decimal text, comma or point → double; anything else → null."""
    t = F.replace(strip(c), F.lit(","), F.lit("."))
    return F.when(t.rlike(_DECIMAL), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def effort_minutes(c: Column) -> Column:
    """'2h 30min' → 150. A day is 24 h, an unknown or missing unit is minutes, 0 is null."""
    t = F.lower(strip(c))
    pattern = F.lit(r"(\d+)([a-z]*)")
    minutes = F.zip_with(
        F.regexp_extract_all(t, pattern, F.lit(1)),
        F.regexp_extract_all(t, pattern, F.lit(2)),
        lambda n, u: n.try_cast("bigint")
        * F.when(u.startswith("d"), 1440).when(u.startswith("h"), 60).otherwise(1),
    )
    total = F.aggregate(minutes, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.nullif(total, F.lit(0).cast("bigint"))


def colon_offset(c: Column) -> Column:
    """…+0000 → …+00:00; everything else unchanged."""
    needs = (
        (F.length(c) >= 5)
        & F.substring(c, -5, 1).isin("+", "-")
        & (F.substring(c, -3, 1) != ":")
    )
    return F.when(
        needs, F.concat(F.left(c, F.length(c) - 2), F.lit(":"), F.right(c, F.lit(2)))
    ).otherwise(c)


def parse_stamp(c: Column) -> Column:
    """ISO date or date-time text → timestamp; bad text → null.

    Text without an offset is read in the session zone, which `session.tune` sets to UTC.
    The pattern keeps out texts that only the cast accepts, such as a bare year.
    """
    return F.when(c.rlike(_STAMP), c.try_cast("timestamp"))


def format_stamp(ts: Column) -> Column:
    """Timestamp → yyyy-MM-dd'T'HH:mm:ss+0000 (session zone UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssZ")


def epoch_seconds(creation: Column, update: Column, date_on: str = "creation") -> Column:
    """Seconds since 1970 of the chosen date, 0 where it is missing or unreadable."""
    made, changed = parse_stamp(creation), parse_stamp(update)
    chosen = {"creation": made, "update": changed}.get(date_on, F.coalesce(made, changed))
    return F.coalesce(chosen.cast("double"), F.lit(0.0))


def bound_seconds(value: object) -> float | None:
    """Normalise a window bound on the driver: datetime, 'yyyy-MM-dd' or ISO text."""
    if value is None:
        return None
    if isinstance(value, str):
        text = value.strip()
        try:
            value = datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
        except ValueError:
            return None
    if not isinstance(value, datetime):
        return None
    return (value if value.tzinfo else value.replace(tzinfo=timezone.utc)).timestamp()


def severity_weight(c: Column) -> Column:
    weights = F.create_map(*[F.lit(x) for pair in SEVERITY_WEIGHT.items() for x in pair])
    return F.coalesce(F.try_element_at(weights, F.upper(c)), F.lit(0))


def priority_score(severity: Column, creation: Column) -> Column:
    return severity_weight(severity) * F.lit(float(SEVERITY_SCALE)) + epoch_seconds(
        creation, F.lit(None).cast("string"), "creation"
    )


__all__ = [
    "SEVERITY_WEIGHT",
    "bound_seconds",
    "colon_offset",
    "effort_minutes",
    "epoch_seconds",
    "first_truthy",
    "format_stamp",
    "parse_stamp",
    "priority_score",
    "severity_weight",
    "to_float",
    "to_int",
]
