"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Method
    A text's fingerprint has a bit set where over half of its shingles' hashes have it.
    Equal fingerprints are one entry. Entries are sorted by Gray rank (the place of a code
    in the reflected Gray sequence), where neighbours share most bits, and cut into blocks
    of about `BLOCK_ROWS`. Bits that all entries of a block share form its masked pattern.
    The patterns are the upper nodes of the index: a fingerprint is sent to a block only if
    it differs from the block's pattern in at most `max_bits` bits. Inside a block a tree
    is built the same way: the bits shared by a group of consecutive nodes are factored
    into their parent, a node keeps only the bits its parent lacks, and a search adds up
    differences on the way down and drops whole groups when the sum exceeds `max_bits`.

Scale
    Every pair is met once, in the block of higher number, and differences over the bits of
    a pattern never exceed those of the codes, so the search is exact. A fingerprint is
    sent to about C(p, 2) of 2^p blocks. A task holds one block and what is sent to it; a
    group of copies is one entry, and near copies leave a block as a spanning forest, not
    as pairs. Only block bounds and patterns (at most `MAX_BLOCKS`) reach the driver.

Edge cases
    A null text is empty; texts without words have fingerprint zero and are linked like any
    other. Fewer words than a shingle: the whole sequence is the shingle. Rows with equal
    ids are separate rows of the result. A null id takes part in links; the component id is
    the smallest id that is not null (null where a component has none). An empty table
    gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm import components
from lintlake.llm.shared import arrow_map, handed_over, text_digest

SEED = 42
BLOCK_ROWS = 1024
MAX_BLOCKS = 16_384
FANOUT = 8
#: Queries searched at once; bounds the memory of a search.
SEARCH_ROWS = 2048
#: Shingles whose bits are counted at once.
COUNT_ROWS = 65_536


def shingle_digests(text: bytes, words: int) -> bytes:
    """XXH64 digests of all shingles, one after the other (A-Z are lower-cased)."""
    found = text.lower().split()
    if len(found) <= words:
        return xxhash.xxh64_digest(b" ".join(found), SEED) if found else b""
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1).tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops[words - 1 :], strict=False)])


def fingerprint(text: bytes, words: int = 3) -> int:
    digests = np.frombuffer(shingle_digests(text, words), dtype=np.uint8).reshape(-1, 8)
    if not len(digests):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(digests), COUNT_ROWS):
        counts += np.unpackbits(digests[at : at + COUNT_ROWS], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(digests)).tobytes(), "big")


def fingerprints(
    documents: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, digest, code): one row per document; `code` is the fingerprint as a long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            codes = np.array(codes, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes)], names=["doc_id", "digest", "code"]
            )

    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        text_digest(F.col(text)).alias("digest"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    return arrow_map(source, work, "doc_id long, digest long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayTree:
    """Tree over codes (or masked patterns) in Gray order.

    Level 0 holds the entries, the last level the upper nodes. A node is the mask of bits
    shared by its group, and their values; `own` is the mask without the parent's bits.
    """

    def __init__(self, values: np.ndarray, masks: np.ndarray | None = None) -> None:
        masks = np.full(len(values), ~np.uint64(0)) if masks is None else masks
        self.levels = [(values & masks, masks)]
        while len(values) > FANOUT:
            starts = np.arange(0, len(values), FANOUT)
            first = np.repeat(values[starts], np.diff(np.append(starts, len(values))))
            shared = np.bitwise_and.reduceat(masks, starts) & ~np.bitwise_or.reduceat(values ^ first, starts)
            values, masks = values[starts] & shared, shared
            self.levels.append((values, masks))
        self.own = []
        for level, (_, level_masks) in enumerate(self.levels):
            if level + 1 < len(self.levels):
                parent = self.levels[level + 1][1][np.arange(len(level_masks)) // FANOUT]
                level_masks = level_masks & ~parent
            self.own.append(level_masks)

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, entry) index pairs that differ in at most `limit` of the entry's bits."""
        top = len(self.levels) - 1
        nodes_at_top = len(self.levels[top][0])
        query = np.repeat(np.arange(len(queries)), nodes_at_top)
        node = np.tile(np.arange(nodes_at_top), len(queries))
        sums = np.zeros(len(query), dtype=np.int64)
        for level in range(top, -1, -1):
            values, own = self.levels[level][0], self.own[level]
            if level < top:
                query, sums = np.repeat(query, FANOUT), np.repeat(sums, FANOUT)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                inside = node < len(values)
                query, sums, node = query[inside], sums[inside], node[inside]
            sums = sums + np.bitwise_count((queries[query] ^ values[node]) & own[node])
            near = sums <= limit
            query, sums, node = query[near], sums[near], node[near]
        return query, node


def _bounds(entries: DataFrame, n: int) -> np.ndarray:
    """Gray ranks at which blocks begin (without the first), as signed order-keeping longs."""
    blocks = min(MAX_BLOCKS, math.ceil(n / BLOCK_ROWS))
    if blocks < 2:
        return np.array([], dtype=np.int64)
    parts = [i / blocks for i in range(1, blocks)]
    found = entries.agg(F.percentile_approx("rank", parts, 10 * blocks)).first()[0]
    return np.unique(np.array(found, dtype=np.int64))


def _signed_rank(codes: np.ndarray) -> np.ndarray:
    return (gray_rank(codes.view(np.uint64)) ^ np.uint64(1 << 63)).view(np.int64)


def _forest(n: int, a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> None:
    """Union-find with path halving."""
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)


def links(codes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) links that connect exactly the codes that `max_bits` differences connect.

    `codes` holds distinct longs in column `code`. The result is a spanning forest of each
    block's links, so it has at most one row per code and block.
    """

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(_signed_rank(code))], names=["code", "rank"])

    n = codes.count()
    entries = arrow_map(codes.select("code"), ranked, "code long, rank long")
    bounds = _bounds(entries, n)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy()
            block = np.searchsorted(bounds, _signed_rank(code), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(block)], names=["code", "block"])

    patterns = (
        arrow_map(codes.select("code"), placed, "code long, block long")
        .groupBy("block")
        .agg(F.bit_and("code").alias("all"), F.bit_or("code").alias("any"))
        .orderBy("block")
        .collect()
    )
    numbers = np.array([p["block"] for p in patterns], dtype=np.int64)
    value = np.array([p["all"] for p in patterns], dtype=np.int64).view(np.uint64)
    mask = ~(value ^ np.array([p["any"] for p in patterns], dtype=np.int64).view(np.uint64))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = GrayTree(value, mask)
        for batch in batches:
            code = batch.column(0).to_numpy()
            home = np.searchsorted(bounds, _signed_rank(code), side="right")
            for at in range(0, len(code), SEARCH_ROWS):
                some, own = code[at : at + SEARCH_ROWS], home[at : at + SEARCH_ROWS]
                query, node = upper.search(some.view(np.uint64), max_bits)
                block = numbers[node]
                keep = block >= own[query]
                query, block = query[keep], block[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block), pa.array(some[query]), pa.array(block == own[query])],
                    names=["block", "code", "home"],
                )

    def searched(block: pd.DataFrame) -> pd.DataFrame:
        code = block["code"].to_numpy().view(np.uint64)
        code = code[np.argsort(gray_rank(code), kind="stable")]
        at_home = np.isin(code, block["code"].to_numpy()[block["home"].to_numpy()].view(np.uint64))
        inside = np.flatnonzero(at_home)
        tree = GrayTree(code[inside])
        parent = np.arange(len(code))
        for at in range(0, len(code), SEARCH_ROWS):
            query, entry = tree.search(code[at : at + SEARCH_ROWS], max_bits)
            query, entry = query + at, inside[entry]
            other = query != entry
            _forest(len(code), query[other], entry[other], parent)
        root = parent
        while not np.array_equal(root, root[root]):
            root = root[root]
        moved = np.flatnonzero(root != np.arange(len(code)))
        return pd.DataFrame({"a": code[moved].view(np.int64), "b": code[root[moved]].view(np.int64)})

    return (
        arrow_map(codes.select("code"), sent, "block long, code long, home boolean")
        .groupBy("block")
        .applyInPandas(searched, "a long, b long")
    )


def near_duplicates(
    documents: DataFrame, words: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, digest, code, root, component_id): one row per document; `root` is the
    smallest code of the component."""
    found = handed_over(fingerprints(documents, words, doc_id, text), "fingerprints")
    entries = handed_over(found.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    tops = components.roots(links(entries, max_bits)).withColumnRenamed("node", "code")
    rooted = entries.join(tops, "code", "left").withColumn("root", F.coalesce("root", "code"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("code", "root", "component_id")
    return found.join(classes, "code").select("doc_id", "digest", "code", "root", "component_id")


def hex_code(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(code)), 16, "0")


def keep_one(
    documents: DataFrame, words: int = 3, max_bits: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents, one of each group: the smallest id (null last), of equal ids the
    smallest text digest, of equal rows one."""
    return one_of_each(documents, near_duplicates(documents, words, max_bits, doc_id, text), doc_id, text)


def one_of_each(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each root of `found` (doc_id, digest, root)."""
    kept = (
        found.groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("one"))
        .select(F.col("one.doc_id").alias("_kept_id"), F.col("one.digest").alias("_kept_digest"))
        .distinct()
    )
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"),
        F.col(doc_id).cast("long").alias("_id"),
        text_digest(F.col(text)).alias("_digest"),
    )
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_digest"]).select("_row.*")
