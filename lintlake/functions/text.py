"""String helpers: truthiness, trimming, line splitting, paths, truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space when text is stripped,
# and the characters that end a line.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = "\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# File suffix → language label.
LANGUAGE_BY_SUFFIX = {
    ".cpp": "cpp",
    ".cxx": "cpp",
    ".cc": "cpp",
    ".c": "c",
    ".hpp": "cpp",
    ".hxx": "cpp",
    ".hh": "cpp",
    ".h": "c",
    ".cs": "csharp",
    ".java": "java",
    ".py": "python",
}

# Fixed value: the mark at the end of a text that was cut.
TRUNCATION_MARK = "\n/* ...TRUNCATED... */\n"


def first_truthy(*cols: Column) -> Column:
    """First non-null, non-empty string; the last operand is returned as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])


def first_nonzero(*cols: Column) -> Column:
    """First non-null, non-zero number; the last operand is returned as it is."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols[:-1]], cols[-1])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.rlike(rf"^[{WHITESPACE}]*+\z")


def universal_newlines(c: Column) -> Column:
    """Carriage returns, alone or before a line feed, become line feeds."""
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def _unusual_ends(c: Column) -> Column:
    """The text has a line end other than the line feed and carriage returns."""
    unusual = F.lit(False)
    for end in LINE_ENDS[1:]:
        unusual = unusual | F.contains(c, F.lit(end))
    return unusual


def split_lines(c: Column) -> Column:
    """Whole text → array of lines that keep their terminator.

    Texts whose only line end is the line feed, nearly all, take a plain split.
    """
    text = universal_newlines(c)
    parts = F.split(text, "\n")
    ended = F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.concat(p, F.lit("\n"))
    )
    rest = F.substring_index(text, "\n", -1)
    plain = F.when(rest == "", ended).otherwise(F.array_append(ended, rest))
    careful = F.regexp_extract_all(
        text, F.lit(f"[^{LINE_ENDS}]*[{LINE_ENDS}]|[^{LINE_ENDS}]+"), F.lit(0)
    )
    return F.when(_unusual_ends(c), careful).otherwise(plain)


def drop_line_end(c: Column) -> Column:
    """One line without its terminator (at most one is present)."""
    return F.when(F.right(c, F.lit(1)).isin(*LINE_ENDS), F.left(c, F.length(c) - 1)).otherwise(c)


def bare_lines(lines: Column) -> Column:
    return F.transform(lines, drop_line_end)


def bare_split(c: Column) -> Column:
    """`bare_lines` of `split_lines`; the usual text needs no line end put on and taken off."""
    parts = F.split(universal_newlines(c), "\n")
    plain = F.when(F.get(parts, F.size(parts) - 1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.when(_unusual_ends(c), bare_lines(split_lines(c))).otherwise(plain)


def join_range(lines: Column, start: Column, end: Column, sep: str = "") -> Column:
    """Join 1-based inclusive [start, end] of an array; empty text if the range is empty."""
    return F.when(
        (start >= 1) & (end >= start), F.array_join(F.slice(lines, start, end - start + 1), sep)
    ).otherwise(F.lit(""))


def indent_spaces(c: Column) -> Column:
    """Number of leading blanks; tabs do not count."""
    return F.length(c) - F.length(F.ltrim(c, F.lit(" ")))


def indent_whitespace(c: Column) -> Column:
    """Number of leading white-space characters of any kind."""
    return F.length(c) - F.length(lstrip(c))


def spaced(c: Column) -> Column:
    """Every white-space character as a blank."""
    return F.translate(c, WHITESPACE, " " * len(WHITESPACE))


def last_token(c: Column) -> Column:
    """Text after the last white space."""
    return F.substring_index(spaced(c), " ", -1)


def expand_tabs(c: Column) -> Column:
    return F.replace(c, F.lit("\t"), F.lit("    "))


def cut_with_mark(c: Column, max_chars: int, mark: str = TRUNCATION_MARK) -> Column:
    return F.when(
        F.length(c) > max_chars, F.concat(F.left(c, F.lit(max_chars)), F.lit(mark))
    ).otherwise(c)


def truncate_with_note(c: Column, max_chars: int, note: str) -> Column:
    return F.coalesce(cut_with_mark(c, max_chars, f"\n// [TRUNCATED: {note}]\n"), F.lit(""))


# --- paths; the separator is always '/' ---------------------------------


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Text before the last '/', empty if there is none."""
    folder = F.left(path, F.length(path) - F.length(base_name(path)) - 1)
    return F.when(F.contains(path, F.lit("/")), F.rtrim(folder, F.lit("/"))).otherwise(F.lit(""))


def file_suffix(path: Column) -> Column:
    """Last suffix with its dot; hidden names and trailing dots have none."""
    return F.regexp_extract(base_name(path), r"(?s)^.+(\.[^.]+)$", 1)


def file_stem(path: Column) -> Column:
    name = base_name(path)
    return F.left(name, F.length(name) - F.length(file_suffix(path)))


def top_module(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def name_extension(name: Column) -> Column:
    """'.' plus the text after the last dot, empty if there is no dot."""
    return F.when(
        F.contains(name, F.lit(".")), F.concat(F.lit("."), F.substring_index(name, ".", -1))
    ).otherwise(F.lit(""))


def language_of(path: Column, default: str = "cpp") -> Column:
    suffix = F.lower(file_suffix(path))
    out = None
    for key, label in LANGUAGE_BY_SUFFIX.items():
        out = (F if out is None else out).when(suffix == key, F.lit(label))
    return out.otherwise(F.lit(default))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)
