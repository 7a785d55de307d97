"""C-like source text: headers, names, call tokens, include lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lintlake.functions import text as tx

# Line starts that are control flow, names that are no function,
# header suffixes, folders left out of the call search.
CONTROL_FLOW_STARTS = ("if ", "for ", "while ", "switch ", "catch ", "else", "do ")
NOT_FUNCTIONS = ("if", "for", "while", "switch", "return")
HEADER_SUFFIXES = (".h", ".hpp", ".hh", ".hxx")
SOURCE_SUFFIXES = (".cpp", ".cc", ".c", ".h", ".hpp")
EXCLUDED_FOLDERS = (
    "test",
    "tests",
    "testing",
    "example",
    "examples",
    "demo",
    "demos",
    "tool",
    "tools",
)

WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
NOT_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


# No limit: larger than any text.
MAX_ARRAY = 2_000_000_000


def _has_parens(c: Column) -> Column:
    return F.contains(c, F.lit("(")) & F.contains(c, F.lit(")"))


def is_control_flow(stripped: Column) -> Column:
    return F.lower(stripped).rlike("^(?:" + "|".join(CONTROL_FLOW_STARTS) + ")")


def is_header(stripped: Column) -> Column:
    """The line looks like a function definition header."""
    return (
        _has_parens(stripped)
        & ~F.endswith(stripped, F.lit(";"))
        & ~is_control_flow(stripped)
    )


def function_name(stripped: Column) -> Column:
    """Name before the first '(' without scope and pointer marks, else null."""
    before = tx.strip(F.substring_index(stripped, "(", 1))
    name = F.btrim(F.substring_index(tx.last_token(before), "::", -1), F.lit("*&"))
    return F.when(
        F.contains(stripped, F.lit("(")) & (name != "") & ~name.isin(*NOT_FUNCTIONS), name
    )


def class_name(signature: Column) -> Column:
    """Owner of the function: last token of the second-last '::' part, else null."""
    parts = F.split(F.substring_index(signature, "(", 1), "::")
    owner = tx.last_token(tx.strip(F.get(parts, F.size(parts) - 2)))
    return F.when((F.size(parts) >= 2) & (owner != ""), owner)


def headers(lines: Column) -> Column:
    """Bare lines → array of struct(line, indent, name, signature), in line order.

    Each pass over the array narrows it and keeps what it computed in a field, since an
    expression repeated inside a lambda is evaluated repeatedly.
    """
    bracketed = F.filter(
        F.transform(lines, lambda t, i: F.struct((i + 1).alias("line"), t.alias("text"))),
        lambda c: _has_parens(c["text"]),
    )
    stripped = F.transform(
        bracketed,
        lambda c: F.struct(
            c["line"].alias("line"),
            tx.indent_whitespace(c["text"]).alias("indent"),
            tx.strip(c["text"]).alias("signature"),
        ),
    )
    heads = F.filter(stripped, lambda c: is_header(c["signature"]))
    named = F.transform(
        heads,
        lambda h: F.struct(
            h["line"].alias("line"),
            h["indent"].alias("indent"),
            function_name(h["signature"]).alias("name"),
            h["signature"].alias("signature"),
        ),
    )
    return F.filter(named, lambda h: h["name"].isNotNull())


def include_block(lines: Column) -> Column:
    """Leading run of blank, comment and include lines."""
    head = rf"^[{tx.WHITESPACE}]*+(?://|/\*|#include|\z)"
    first_code = F.array_position(F.transform(lines, lambda t: ~t.rlike(head)), True)
    return F.when(first_code == 0, lines).otherwise(
        F.slice(lines, F.lit(1), (first_code - 1).cast("int"))
    )


def includes_header(includes: Column, stem: Column) -> Column:
    """Any include line names '<stem>.h' (which covers .hpp, .hh and .hxx except '.hh')."""
    return (stem != "") & F.exists(
        includes, lambda line: F.contains(line, F.concat(stem, F.lit(".h")))
    )


def included_stems(includes: Column, longest: Column | int = MAX_ARRAY) -> Column:
    """Every text that `includes_header` would accept as a stem for these lines.

    That is, each non-empty ending of the slash-free run before any '.h'. It turns the
    substring test into an equality, so it can be a join key. Endings over `longest`
    characters, the length of the longest stem looked for, are left out.
    """
    runs = F.flatten(
        F.transform(
            F.filter(includes, lambda line: F.contains(line, F.lit(".h"))),
            # What stands before the k-th '.h', found by its bytes and not place by place.
            lambda line: F.transform(
                F.sequence(F.lit(1), F.size(F.split(line, r"\.h")) - 1),
                lambda k: F.substring_index(F.call_function("substring_index", line, F.lit(".h"), k), "/", -1),
            ),
        )
    )
    endings = F.transform(
        F.filter(runs, lambda run: run != ""),
        lambda run: F.transform(
            F.sequence(F.lit(1), F.least(F.length(run), F.lit(longest))),
            lambda n: F.right(run, n),
        ),
    )
    return F.array_distinct(F.flatten(endings))


def called_names(line: Column, longest: Column | int = MAX_ARRAY) -> Column:
    """Distinct texts `f` with `f\\s*\\(` in the line and no word character before `f`.

    Endings of the run before '(' that start at a word boundary or at a symbol, so names
    such as '~Foo' and 'operator+' are found as well as plain ones. With `longest`, the
    length of the longest name looked for, a very long run (minified or encoded text)
    costs no more than a name: only its last `longest` characters can match, and one more
    is kept to see what stands before them.
    """
    pieces = F.split(tx.spaced(line), r"\(")
    runs = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.substring_index(F.rtrim(p), " ", -1),
    )
    local = F.transform(
        runs, lambda r: F.right(F.substring_index(r, "::", -1), F.lit(longest + 1))
    )
    # A plain word, by far the usual run, has itself as its only ending.
    endings = F.transform(
        F.filter(local, lambda r: r != ""),
        lambda r: F.when(r.rlike(rf"^{WORD}+$"), F.array(r)).otherwise(
            F.transform(
                F.filter(
                    F.sequence(F.lit(1), F.length(r)),
                    lambda i: (i == 1) | F.substr(r, i - 1, F.lit(1)).rlike(NOT_WORD),
                ),
                lambda i: F.substr(r, i),
            )
        ),
    )
    return F.array_distinct(F.flatten(endings))


def defines(stripped: Column, name: Column) -> Column:
    """The line looks like a definition of `name` in some class."""
    return (
        _has_parens(stripped)
        & ~F.endswith(stripped, F.lit(";"))
        & F.contains(stripped, F.concat(F.lit("::"), name))
    )


def other_class_qualifier(stripped: Column, name: Column) -> Column:
    """Class named before the first '::name', null where no class is named."""
    marker = F.concat(F.lit("::"), name)
    left = tx.rstrip(F.left(stripped, F.position(marker, stripped) - 1))
    qualifier = F.substring_index(tx.last_token(left), "::", -1)
    return F.when(F.contains(stripped, marker) & (left != ""), qualifier)


def qualifier_endings(stripped: Column, name: Column) -> Column:
    """Every class text `c` for which 'c::name' occurs in the line."""
    marker = F.concat(F.lit("::"), name)
    pieces = F.split(F.replace(stripped, marker, F.lit("\0")), "\0")
    runs = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda piece, i: F.substring_index(
            F.substring_index(
                tx.last_token(F.concat(F.when(i > 0, name).otherwise(F.lit("")), piece)), "(", -1
            ),
            "::",
            -1,
        ),
    )
    endings = F.transform(
        F.filter(runs, lambda run: run != ""),
        lambda run: F.transform(
            F.sequence(F.lit(1), F.length(run)), lambda n: F.right(run, n)
        ),
    )
    return F.flatten(endings)


def is_searched_file(path: Column) -> Column:
    """No header file and no excluded folder in the path."""
    return ~tx.file_suffix(path).isin(*HEADER_SUFFIXES) & ~F.arrays_overlap(
        F.split(F.lower(path), "/"), F.array(*[F.lit(x) for x in EXCLUDED_FOLDERS])
    )


def is_source_file(path: Column) -> Column:
    return F.lower(tx.file_suffix(path)).isin(*SOURCE_SUFFIXES)


def call_site_score(same_dir: Column, same_top: Column, has_header: Column) -> Column:
    return (
        F.lit(1)
        + F.when(same_dir, 3).when(same_top, 1).otherwise(0)
        + F.when(has_header, 3).otherwise(0)
    )
