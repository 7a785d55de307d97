"""Mixing sources to target weights by iterative proportional fitting.

Method
    Documents fall into cells of source, language and topic. The tokens of each cell are
    counted, and a probability per cell is raked: starting from the share to keep, one
    marginal after the other is scaled to its target share of the kept tokens, no
    probability rising above 1, for a fixed number of rounds. Where the corpus holds enough
    of every category the expected tokens of the sample have the target marginals; a
    category that is too rare is kept whole and the others stay in proportion. The draw is a
    hash of the id, not a random number, so a repeated task draws the same.
    A topic here is the kind of content: text with figures, tables, or prose.

Scale
    A cell's category is a target's name or `other`, so the cell table is no larger than
    the product of the three target lists, whatever the data; that bound is what lets it
    pass through the driver. Cells are summed with partial aggregation, so a hot source is
    one row per task. Sampling is a projection and a filter.

Edge cases
    Nulls and names without a target are `other`; without a target for `other` they share
    what the targets leave of 1, or, where nothing is left, keep their share of the corpus
    and the named targets are scaled down by it. Targets of categories without tokens are
    dropped and the rest is scaled up; where no category with tokens has a target, all keep
    their shares of the corpus, so that axis does not change the uniform rate. Documents without
    tokens in a cell without tokens are kept. A null id draws as an empty id; equal ids
    draw alike. A null text is empty. An empty table gives an empty result. Other columns
    are kept and may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
ROUNDS = 30
#: Share of all tokens to keep.
KEEP = 0.7
AXES = ("source", "lang", "topic")
#: Production targets of the registered query and the pipeline: shares of tokens.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)},
    "lang": {"en": 0.55, "fr": 0.16, "de": 0.16, "es": 0.13},
    "topic": {"prose": 0.83, "figures": 0.15, "table": 0.02},
}


def topic_of(text: Column) -> Column:
    body = F.coalesce(text, F.lit(""))
    return F.when(body.contains(" | "), "table").when(body.rlike("[0-9]{3}"), "figures").otherwise("prose")


def tokens_of(text: Column) -> Column:
    words = F.split(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


@dataclass(frozen=True)
class Mix:
    """Raked probabilities of the cells that have tokens."""

    chances: dict[tuple[str, str, str], float]

    def probability(self) -> Column:
        """Chance of a document, from columns source_class, lang_class, topic_class."""
        if not self.chances:
            return F.lit(1.0)
        pairs = []
        for cell, chance in sorted(self.chances.items()):
            pairs += [F.lit("\x1f".join(cell)), F.lit(chance)]
        cell = F.concat_ws("\x1f", *[f"{a}_class" for a in AXES])
        return F.coalesce(F.try_element_at(F.create_map(*pairs), cell), F.lit(1.0))


def with_classes(
    documents: DataFrame, targets: Mapping[str, Mapping[str, float]],
    text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """The rows as struct `_row`, their classes and tokens."""
    classed = lambda column, axis: F.when(column.isin(*targets[axis]), column).otherwise(OTHER)
    return documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"),
        classed(F.col(source), "source").alias("source_class"),
        classed(F.col(lang), "lang").alias("lang_class"),
        classed(topic_of(F.col(text)), "topic").alias("topic_class"),
        tokens_of(F.col(text)).alias("tokens"),
    )


def rake(
    cells: Mapping[tuple[str, str, str], float], targets: Mapping[str, Mapping[str, float]],
    keep: float = KEEP, rounds: int = ROUNDS,
) -> dict[tuple[str, str, str], float]:
    """Probabilities of the cells with tokens; each round fits source, language and topic in turn."""
    keys = sorted(k for k, n in cells.items() if n > 0)
    if not keys:
        return {}
    tokens = np.array([cells[k] for k in keys], dtype=np.float64)
    chances = np.full(len(keys), keep)
    fits = []
    for at, axis in enumerate(AXES):
        names = sorted({k[at] for k in keys})
        shares = dict(targets[axis])
        shares.setdefault(OTHER, max(0.0, 1.0 - sum(shares.values())))
        share = np.array([shares[n] for n in names])
        if share.sum() <= 0:
            raise ValueError(f"no category of {axis} that has tokens has a target")
        fits.append((np.array([names.index(k[at]) for k in keys]), share / share.sum() * keep * tokens.sum()))
    for _ in range(rounds):
        for member, wanted in fits:
            mass = np.bincount(member, weights=chances * tokens, minlength=len(wanted))
            factor = np.divide(wanted, mass, out=np.zeros_like(wanted), where=mass > 0)
            chances = np.minimum(chances * factor[member], 1.0)
    return dict(zip(keys, chances.tolist(), strict=True))


def for_corpus(
    cells: Mapping[tuple[str, str, str], float], targets: Mapping[str, Mapping[str, float]]
) -> dict[str, dict[str, float]]:
    """The targets, with corpus shares where they leave nothing for what the corpus holds."""
    total = sum(cells.values())
    out = {axis: dict(targets[axis]) for axis in AXES}
    for at, axis in enumerate(AXES):
        held: dict[str, float] = {}
        for cell, n in cells.items():
            if n > 0:
                held[cell[at]] = held.get(cell[at], 0.0) + n / total
        shares = out[axis]
        named = sum(shares.values())
        if OTHER not in shares and OTHER in held and named > 1 - 1e-9:
            # Only names with tokens count, or `other` would take the shares of absent ones.
            present = sum(s for n, s in shares.items() if n in held) or 1.0
            shares = {n: s / present * (1 - held[OTHER]) for n, s in shares.items() if n in held} | {OTHER: held[OTHER]}
        if held and sum(shares.get(n, max(0.0, 1.0 - named) if n == OTHER else 0.0) for n in held) <= 0:
            shares = held
        out[axis] = shares
    return out


def fit(classed: DataFrame, targets: Mapping[str, Mapping[str, float]], keep: float, rounds: int) -> Mix:
    names = [f"{a}_class" for a in AXES]
    rows = classed.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect()
    cells = {tuple(r[n] for n in names): r["tokens"] for r in rows}
    return Mix(rake(cells, for_corpus(cells, targets), keep, rounds))


def draw_of(doc_id: Column) -> Column:
    """A number from 0 to below 1 that belongs to the id."""
    text = F.concat(F.lit("mix|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def drawn(
    documents: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, keep: float = KEEP, rounds: int = ROUNDS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """Every row as `_row`, with classes, tokens, probability and kept."""
    classed = with_classes(documents, targets, text, source, lang)
    mix = fit(classed, targets, keep, rounds)
    chance = classed.withColumn("probability", mix.probability())
    return chance.withColumn("kept", draw_of(F.col(f"_row.`{doc_id}`")) < F.col("probability"))


def sample(
    documents: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, keep: float = KEEP, rounds: int = ROUNDS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """The documents that are drawn, with their columns as they are."""
    return drawn(documents, targets, keep, rounds, doc_id, text, source, lang).where("kept").select("_row.*")
