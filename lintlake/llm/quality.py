"""Quality classifier: a sparse ensemble of rules over text statistics.

Method
    Statistics of a text are Spark columns. On labelled rows small regression trees are
    fitted one after the other to the remaining error; every path from a root to a node is
    a conjunction of threshold conditions, a rule. A lasso logistic regression over all
    rules gives most of them weight zero; the others are compiled into one Spark column
    expression, so scoring is a projection inside the JVM.

Scale
    Statistics of all documents are computed once and written to the shared folder; labels
    are joined to the statistics, not to the texts. Training looks at no more than
    `max_train` labelled rows (default 20,000, a documented bound on the classifier's
    sample: the rows with the smallest hash of their id). Scoring needs no shuffle.

Edge cases
    A null text is empty and is scored like any text. A null id counts as held out and is
    never trained on. Labels that are null are not used; of repeated labels each counts.
    Without usable labels of both kinds the score is the share of label 1, 0.5 without any.
    An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import handed_over

MAX_TRAIN = 20_000
THRESHOLD = 0.3
FOLDS = 5


def _share(of: Column, whole: Column) -> Column:
    return of / F.greatest(whole, F.lit(1))


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """The input as struct `_row`, and one double per name of STATISTICS."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    body = documents.select(row, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    left = lambda pattern: F.length(F.regexp_replace("_text", pattern, ""))
    parts = body.select(
        "_row",
        F.length("_text").alias("_chars"),
        F.filter(F.split("_text", r"\s+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda w: w != "").alias("_lines"),
        left(r"[^\p{Lu}]+").alias("_upper"),
        left(r"[^\p{Nd}]+").alias("_digits"),
        left(r"[\p{L}\p{Nd}\s.,]+").alias("_symbols"),
        left(r"[^.]+").alias("_stops"),
    )
    words, lines = F.size("_words"), F.size("_lines")
    return parts.select(
        "_row",
        F.log1p(F.col("_chars").cast("double")).alias("log_chars"),
        F.log1p(words.cast("double")).alias("log_words"),
        _share(F.col("_chars"), words).alias("chars_per_word"),
        _share(words, lines).alias("words_per_line"),
        _share(F.size(F.array_distinct("_words")), words).alias("distinct_words"),
        _share(F.size(F.array_distinct("_lines")), lines).alias("distinct_lines"),
        _share(F.col("_upper"), F.col("_chars")).alias("upper"),
        _share(F.col("_digits"), F.col("_chars")).alias("digits"),
        _share(F.col("_symbols"), F.col("_chars")).alias("symbols"),
        _share(F.col("_stops"), words).alias("stops_per_word"),
    )


STATISTICS = (
    "log_chars", "log_words", "chars_per_word", "words_per_line", "distinct_words",
    "distinct_lines", "upper", "digits", "symbols", "stops_per_word",
)

#: A condition: (statistic, threshold, above). A rule holds where all of its conditions do.
Condition = tuple[int, float, bool]
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleModel:
    bias: float
    weights: tuple[float, ...]
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """The score as an expression over the columns of STATISTICS."""
        total = F.lit(self.bias)
        for weight, rule in zip(self.weights, self.rules, strict=True):
            holds = F.lit(True)
            for at, threshold, above in rule:
                value = F.col(STATISTICS[at])
                holds = holds & (value > threshold if above else value <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for at, threshold, above in rule:
        out &= x[:, at] > threshold if above else x[:, at] <= threshold
    return out


def _split(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], least: int) -> tuple[int, float] | None:
    """The threshold with the largest fall of squared error, if there is one."""
    best, found = 1e-9, None
    total, n = target.sum(), len(target)
    for at, own in enumerate(cuts):
        if not len(own):
            continue
        place = np.searchsorted(own, x[:, at], side="left")
        counts = np.bincount(place, minlength=len(own) + 1)[:-1].cumsum()
        sums = np.bincount(place, weights=target, minlength=len(own) + 1)[:-1].cumsum()
        fair = (counts >= least) & (n - counts >= least)
        if not fair.any():
            continue
        below, above = np.maximum(counts, 1), np.maximum(n - counts, 1)
        gain = np.where(fair, sums**2 / below + (total - sums) ** 2 / above - total**2 / n, -1.0)
        if gain.max() > best:
            best, found = gain.max(), (at, float(own[gain.argmax()]))
    return found


def grow_rules(
    x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, least: int = 10
) -> list[Rule]:
    """Paths of boosted trees, without repeats, in the order they were found."""
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0.01, 0.99, 64))) for i in range(x.shape[1])]
    score = np.full(len(y), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rest = y - 1 / (1 + np.exp(-score))
        nodes: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(y)))]
        for level in range(depth + 1):
            after = []
            for rule, rows in nodes:
                cut = _split(x[rows], rest[rows], cuts, least) if level < depth else None
                if cut is None:
                    p = 1 / (1 + np.exp(-score[rows]))
                    score[rows] += rate * rest[rows].sum() / max((p * (1 - p)).sum(), 1e-3)
                    continue
                above = x[rows, cut[0]] > cut[1]
                for side in (False, True):
                    path = (*rule, (cut[0], cut[1], side))
                    rules[path] = None
                    after.append((path, rows[above == side]))
            nodes = after
    return list(rules)


def fit_lasso(
    holds: np.ndarray, y: np.ndarray, penalty: float = 0.002, rounds: int = 400
) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps."""
    a = np.hstack([np.ones((len(y), 1)), holds.astype(np.float64)])
    v = np.ones(a.shape[1])
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 4 * len(y) / (np.linalg.norm(a @ v) ** 2 * 1.05)
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        gradient = a.T @ (1 / (1 + np.exp(-(a @ z))) - y) / len(y)
        new = z - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + (before - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if not len(y):
        return RuleModel(0.0, (), ())
    if y.min() == y.max():
        return RuleModel(20.0 if y[0] else -20.0, (), ())
    rules = grow_rules(x, y)
    holds = np.zeros((len(y), len(rules)), dtype=bool)
    for i, rule in enumerate(rules):
        holds[:, i] = _holds(x, rule)
    bias, weights = fit_lasso(holds, y)
    used = [i for i, w in enumerate(weights) if w]
    return RuleModel(bias, tuple(float(weights[i]) for i in used), tuple(rules[i] for i in used))


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from: remainder 0 of the id's CRC-32 (null ids too)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % FOLDS == 0


def train(
    statistics: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
    doc_id: str = "doc_id", label: str = "quality",
) -> RuleModel:
    """Fit on a bounded sample of the labelled rows of `statistics` (`doc_id`, STATISTICS)."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("_label")).where(
        F.col("_label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    labelled = statistics.select("doc_id", *STATISTICS).join(known, "doc_id").withColumn("_place", F.xxhash64("doc_id"))
    # Hashes are even over the longs, so the smallest `max_train` lie below this place but for
    # a chance too small to matter; tasks send the driver hardly more than those.
    part = min(1.0, (1.05 * max_train + 1000) / max(labelled.count(), 1))
    below = labelled if part == 1.0 else labelled.where(F.col("_place") < int(part * 2.0**64) - (1 << 63))
    sample = (
        below.orderBy("_place", "doc_id", "_label", *STATISTICS).limit(max_train)
        .select(*STATISTICS, "_label").toPandas().to_numpy(dtype=np.float64).reshape(-1, len(STATISTICS) + 1)
    )
    return fit_rules(sample[:, :-1], (sample[:, -1] > 0).astype(np.float64))


def _stated(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, STATISTICS) of all documents, written once."""
    found = with_statistics(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    return handed_over(found.select(F.col("_row.doc_id").alias("doc_id"), *STATISTICS), "statistics")


def score(
    documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per document."""
    stated = _stated(documents, doc_id, text)
    model = train(stated, labels, max_train)
    return stated.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The documents that score at least `threshold`, with their columns as they are."""
    model = train(_stated(documents, doc_id, text), labels, max_train)
    return with_statistics(documents, text).where(model.column() >= threshold).select("_row.*")
