"""Quality rules as a short-circuit cascade, in SQL functions only.

Method
    A rule is a condition on the text that a document must meet. On a sample the cost of
    each rule is measured (its own job over the sample, less the cost of reading it) and
    which rules every sampled document breaks. The rules are then put in order: next comes
    the one that rejects most of what is left per unit of cost. The verdict is one nested
    CASE over the rules in that order, so a document meets no rule after the first that it
    breaks. The order decides the speed, never the verdict.

Scale
    A projection: no shuffle, no Python. Every measure is linear in the text but for two
    sorts of its words. The sample is at most `sample_rows` rows (a documented bound); the
    driver sees one number a rule and at most one row per sampled document.

Edge cases
    A null text has no words, as an empty one; both break the rule on length. Rows with
    equal ids are rows of their own. An empty table gives an empty result, with the rules in
    the order given. Columns named `kept` or `rejected_by` are replaced, others stay.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import handed_over

SAMPLE_ROWS = 1000
SAMPLE_SEED = 11
#: Least cost of a rule in seconds; smaller times are noise.
LEAST_COST = 0.005

#: What separates words, as characters and as a class of a pattern.
BLANKS = " \t\n\x0b\f\r"
BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"

class Given:
    """A text, with those of its measures that are columns already; the others are expressions of it.

    Measures are named as the functions below; a rule asks for them by `of`.
    """

    def __init__(self, text: Column, **known: Column) -> None:
        self.text = F.coalesce(text, F.lit(""))
        self.known = known

    def of(self, measure: Callable[[Given], Column]) -> Column:
        return self.known[measure.__name__] if measure.__name__ in self.known else measure(self)


Measure = Callable[[Given], Column]


class Rule(NamedTuple):
    name: str
    passes: Measure


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _only(text: Column, characters: str) -> Column:
    """How many of the characters (as a class of a pattern) the text has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]++", ""))


def words(given: Given) -> Column:
    return F.filter(F.split(given.text, f"[{BLANK}]+"), lambda w: w != "")


def n_words(given: Given) -> Column:
    if "words" in given.known:
        return F.size(given.of(words)).cast("long")
    trimmed = F.btrim(given.text, F.lit(BLANKS))
    return F.length(F.regexp_replace(trimmed, f"[^{BLANK}]++[{BLANK}]*+", "x")).cast("long")


def word_chars(given: Given) -> Column:
    if "words" in given.known:
        return F.length(F.array_join(given.of(words), "")).cast("long")
    return F.length(F.regexp_replace(given.text, f"[{BLANK}]++", "")).cast("long")


def n_symbols(given: Given) -> Column:
    return _only(given.text, SYMBOLS).cast("long")


def lines(given: Given) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(given.text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))


def n_lines(given: Given) -> Column:
    return F.size(given.of(lines)).cast("long")


def n_dup_lines(given: Given) -> Column:
    """Lines equal to an earlier one."""
    return _let(given.of(lines), lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def _met_again(ordered: Column, field: str) -> Column:
    """Of structs sorted by `field`, those whose field a neighbour shares."""

    def shared(x: Column, i: Column) -> Column:
        before, after = F.get(ordered, i - 1)[field], F.get(ordered, i + 1)[field]
        return F.coalesce(x[field] == before, F.lit(False)) | F.coalesce(x[field] == after, F.lit(False))

    return F.filter(ordered, shared)


def n_repeat_words(given: Given) -> Column:
    """Words that lie in a three-word window found twice or more.

    Windows are sorted by their hash; those that share one are sorted again by their words,
    so the count is exact.
    """

    def count(found: Column) -> Column:
        starts = F.slice(found, F.lit(1), F.greatest(F.size(found) - 2, F.lit(0)))
        hashed = F.transform(
            starts, lambda w, i: F.struct(F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("i"))
        )
        spelt = lambda x: F.struct(
            F.concat_ws(" ", F.get(found, x["i"]), F.get(found, x["i"] + 1), F.get(found, x["i"] + 2)).alias("t"), x["i"].alias("i")
        )
        maybe = _let(F.sort_array(hashed), lambda s: F.sort_array(F.transform(_met_again(s, "h"), spelt)))
        covered = lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)
        return _let(maybe, lambda s: F.size(F.array_distinct(F.flatten(F.transform(_met_again(s, "t"), covered)))))

    return _let(given.of(words), count).cast("long")


def _per(of: Column, whole: Column) -> Column:
    return of.cast("double") / F.greatest(whole, F.lit(1))


def _mean_word_length(given: Given) -> Column:
    return _let(_per(given.of(word_chars), given.of(n_words)), lambda mean: (mean >= 3) & (mean <= 10))


def _upper_case(given: Given) -> Column:
    return _per(_only(given.text, r"\p{Lu}"), F.length(given.text)) <= 0.3


def _marks(given: Given) -> Column:
    return _per(_only(given.text, "!?"), given.of(n_words)) <= 0.5


def _alphabetic(given: Given) -> Column:
    letters = F.regexp_replace(given.text, rf"[^\p{{L}}{BLANK}]++", "")
    return _per(n_words(Given(letters)), given.of(n_words)) >= 0.8


def _line_share(pattern: str, most: float) -> Measure:
    return lambda given: _per(F.regexp_count(given.text, F.lit(pattern)), given.of(n_lines)) <= most


#: Thresholds as published for web corpora; none is fitted to the tables at hand.
RULES: tuple[Rule, ...] = (
    Rule("length", lambda given: given.of(n_words) >= 50),
    Rule("mean_word_length", _mean_word_length),
    Rule("symbols", lambda given: _per(given.of(n_symbols), given.of(n_words)) <= 0.1),
    Rule("duplicate_lines", lambda given: _per(given.of(n_dup_lines), given.of(n_lines)) <= 0.3),
    Rule("repeated_words", lambda given: given.of(n_repeat_words) * 100 <= given.of(n_words) * 50),
    Rule("upper_case", _upper_case),
    Rule("marks", _marks),
    Rule("alphabetic", _alphabetic),
    Rule("bullets", _line_share(r"(?md)^[ \t]*+[-*•]", 0.9)),
    Rule("ellipses", _line_share(r"(?md)(?:\.\.\.|…)[ \t]*+$", 0.3)),
)


class Profile(NamedTuple):
    """What a sample says: seconds of each rule, and how many documents break which rules."""

    cost: dict[str, float]
    broken: dict[frozenset[str], int]


def profile(
    documents: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Profile:
    """Cost and selectivity of every rule on a sample of at most `sample_rows` rows."""
    share = min(1.0, 1.1 * sample_rows / max(documents.count(), 1))
    some = documents.select(F.col(text).alias("text")).sample(share, SAMPLE_SEED).limit(sample_rows)
    sample = handed_over(some, "rule-sample")
    body = Given(F.col("text"))

    def seconds(of: Column) -> float:
        spent = []
        for _ in range(2):
            start = time.perf_counter()
            sample.agg(F.count_if(of)).collect()
            spent.append(time.perf_counter() - start)
        return min(spent)

    reading = seconds(F.length(body.text) >= 0)
    cost = {r.name: max(seconds(r.passes(body)) - reading, LEAST_COST) for r in rules}
    breaks = sample.select(*[(~F.coalesce(r.passes(body), F.lit(False))).alias(r.name) for r in rules])
    broken: dict[frozenset[str], int] = {}
    for row in breaks.groupBy(*[r.name for r in rules]).count().collect():
        broken[frozenset(r.name for r in rules if row[r.name])] = row["count"]
    return Profile(cost, broken)


def in_order(rules: Sequence[Rule], found: Profile) -> list[Rule]:
    """The rules by documents rejected, of those that earlier rules let through, per cost."""
    left, rest, out = dict(found.broken), list(rules), []
    while rest:
        rejects = {r.name: sum(n for broken, n in left.items() if r.name in broken) for r in rest}
        best = max(rest, key=lambda r: (rejects[r.name] / found.cost[r.name], -found.cost[r.name]))
        out.append(best)
        rest.remove(best)
        left = {broken: n for broken, n in left.items() if best.name not in broken}
    return out


def first_broken(given: Given, rules: Sequence[Rule]) -> Column:
    """Name of the first rule that the text breaks, null if it meets all; later rules are not evaluated."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(F.coalesce(rule.passes(given), F.lit(False)), out).otherwise(F.lit(rule.name))
    return out


def cascade(
    documents: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """`documents` with `kept`, and `rejected_by`: the first rule broken in the order chosen."""
    ordered = in_order(rules, profile(documents, rules, text, sample_rows))
    judged = documents.withColumn("rejected_by", first_broken(Given(F.col(text)), ordered))
    return judged.withColumn("kept", F.col("rejected_by").isNull())


def keep_good(
    documents: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The documents that meet all rules, with their columns as they are."""
    ordered = in_order(rules, profile(documents, rules, text, sample_rows))
    return documents.where(first_broken(Given(F.col(text)), ordered).isNull())
