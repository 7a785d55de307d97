"""Embedding near-duplicates by a subspace pigeonhole join.

Method
    Unit vectors with cosine c or more lie within squared distance 2 - 2c. Vectors are
    turned by a fixed random rotation and split into blocks of `BLOCK_DIMS` dimensions.
    Two vectors within the distance must, in at least one block, be within the share of
    the squared distance that is proportional to the block's dimensions. So each block is
    range-joined on its own: the first `GRID_DIMS` coordinates of a block are laid on a
    grid whose cells are twice the block's radius wide, a vector lies in one cell and looks
    into the at most two cells per coordinate its radius reaches, and a pair passes if its
    distance within the block keeps the budget. The union of the blocks' candidates is
    verified exactly, in double precision, on the vectors as they were.

Scale
    Equal vectors of a label are one node with a count, so a group of copies costs one row.
    Every join is an equi-join that adaptive execution splits where a key is hot. The
    distance within a block is checked inside the join. Links exist only between different
    vectors that are similar; they are counted with partial aggregation.

Edge cases
    Vectors that are null, empty or zero or hold null or non-finite components, and rows
    without a label, link with nothing: no links, own component, kept. Vectors of different
    length do not link. Rows with equal ids are rows of their own, a row's links are counted
    over all other rows; a null id takes part in links, and a component is named by its
    smallest id that is not null. An empty table gives an empty result. Other columns may
    have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm import components
from lintlake.llm.shared import arrow_map, handed_over

COSINE = 0.98
BLOCK_DIMS = 8
GRID_DIMS = 3
SEED = 20_240_229
#: Added to budgets for what single precision takes from block coordinates.
SLACK = 1e-6
_COORDINATES = [f"x{i}" for i in range(BLOCK_DIMS)]


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_budgets(dims: int, cosine: float) -> np.ndarray:
    """Squared-distance budget of each block; they add up to the whole."""
    sizes = [min(BLOCK_DIMS, dims - at) for at in range(0, dims, BLOCK_DIMS)]
    return (2 - 2 * cosine) * np.array(sizes) / dims + SLACK


def _cells(at: np.ndarray) -> np.ndarray:
    """One long per row of integer cell coordinates."""
    out = np.zeros(len(at), dtype=np.int64)
    for column in at.T:
        out = (out << 21) | (column.astype(np.int64) & ((1 << 21) - 1))
    return out


def block_rows(nodes: DataFrame, cosine: float, probes: bool) -> DataFrame:
    """(label, dims, block, cell, node, coordinates): a node's own cells or those it looks into."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "dims", "block", "cell", "node", "budget", *_COORDINATES]
        for batch in batches:
            labels, vectors = batch.column(1), batch.column(2).to_pylist()
            node = batch.column(0).to_numpy()
            lengths = np.array([len(v) for v in vectors], dtype=np.int64)
            for dims in np.unique(lengths):
                rows = np.flatnonzero(lengths == dims)
                x = np.array([vectors[i] for i in rows], dtype=np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(int(dims))
                for block, budget in enumerate(block_budgets(int(dims), cosine)):
                    part = x[:, block * BLOCK_DIMS : (block + 1) * BLOCK_DIMS]
                    part = np.pad(part, ((0, 0), (0, BLOCK_DIMS - part.shape[1]))).astype(np.float32)
                    radius = float(np.sqrt(budget)) * (1 + 1e-6)
                    grid = part[:, :GRID_DIMS].astype(np.float64)
                    if probes:
                        low = np.floor((grid - radius) / (2 * radius))
                        high = np.floor((grid + radius) / (2 * radius))
                        sides = [np.where(np.array(s), high, low) for s in itertools.product((False, True), repeat=GRID_DIMS)]
                        cells = np.stack([_cells(s) for s in sides], axis=1)
                    else:
                        cells = _cells(np.floor(grid / (2 * radius)))[:, None]
                    own = np.sort(cells, axis=1)
                    fresh = np.ones(own.shape, dtype=bool)
                    fresh[:, 1:] = own[:, 1:] != own[:, :-1]
                    row, at = np.nonzero(fresh)
                    n = len(row)
                    columns = [
                        labels.take(pa.array(rows[row])), pa.array(np.full(n, dims, dtype=np.int32)),
                        pa.array(np.full(n, block, dtype=np.int32)), pa.array(own[row, at]),
                        pa.array(node[rows[row]]), pa.array(np.full(n, budget, dtype=np.float32)),
                        *[pa.array(part[row, i]) for i in range(BLOCK_DIMS)],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = nodes.schema["label"].dataType.simpleString()
    floats = ", ".join(f"{c} float" for c in ["budget", *_COORDINATES])
    return arrow_map(
        nodes.select("node", "label", "vector"), work,
        f"label {kind}, dims int, block int, cell long, node long, {floats}",
    )


def candidates(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b), a < b: pairs that keep the budget of at least one block."""
    home, probe = block_rows(nodes, cosine, False).alias("h"), block_rows(nodes, cosine, True).alias("p")
    keys = ["label", "dims", "block", "cell"]
    square = None
    for c in _COORDINATES:
        difference = F.col(f"h.{c}") - F.col(f"p.{c}")
        square = difference * difference if square is None else square + difference * difference
    near = (F.col("h.node") < F.col("p.node")) & (square <= F.col("h.budget"))
    same = [F.col(f"h.{k}") == F.col(f"p.{k}") for k in keys]
    joined = home.join(probe, [*same, near])
    return joined.select(F.col("h.node").alias("a"), F.col("p.node").alias("b")).distinct()


def _dot(x: Column, y: Column) -> Column:
    products = F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def _scaled(vector: Column) -> Column:
    """The vector as doubles, times the power of two that brings its largest component near 1.

    Exact, and keeps squares of very small or large components from running out of range.
    The power is applied in two halves, since the whole may itself be out of range.
    """
    doubles = vector.cast("array<double>")
    largest = F.array_max(F.transform(doubles, F.abs))
    power = -F.floor(F.log2(largest))
    half = F.floor(power / 2)
    halves = F.struct(F.pow(F.lit(2.0), half).alias("a"), F.pow(F.lit(2.0), power - half).alias("b"))
    return F.transform(F.array(halves), lambda h: F.transform(doubles, lambda x: x * h["a"] * h["b"]))[0]


def links(nodes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b): candidates whose cosine is `cosine` or more."""
    scaled = nodes.select("node", _scaled(F.col("vector")).alias("vector"))
    vectors = scaled.select("node", "vector", F.sqrt(_dot(F.col("vector"), F.col("vector"))).alias("norm"))
    pairs = (
        candidates(nodes, cosine)
        .join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"), F.col("norm").alias("na")), "a")
        .join(vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"), F.col("norm").alias("nb")), "b")
    )
    likeness = _dot(F.col("va"), F.col("vb")) / (F.col("na") * F.col("nb"))
    return pairs.where(likeness >= cosine).select("a", "b")


def usable(vector: Column, label: Column) -> Column:
    """Rows that can link at all."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(vector, lambda x: x != 0)
    return label.isNotNull() & vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & ~F.coalesce(zero, F.lit(True))


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector."""
    rows = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    good = usable(F.col("vector"), F.col("label"))
    nodes = handed_over(
        rows.where(good).groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    found = handed_over(links(nodes, cosine), "vector-links")
    both = found.unionByName(found.selectExpr("b AS a", "a AS b"))
    counted = (
        both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("n"))
    )
    tops = components.roots(found)
    rooted = (
        nodes.join(tops, "node", "left").withColumn("root", F.coalesce("root", "node"))
        .join(counted.withColumnRenamed("a", "node"), "node", "left")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    told = rooted.join(named, "root").select(
        F.col("label").alias("n_label"), F.col("vector").alias("n_vector"), "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    # Rows that cannot link meet nothing: their key is null.
    keyed = rows.withColumn("key", F.when(good, F.col("vector")))
    joined = keyed.join(told, (F.col("label") == F.col("n_label")) & (F.col("key") == F.col("n_vector")), "left")
    component = F.when(F.col("n_vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
