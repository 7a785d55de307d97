"""One-permutation MinHash fingerprints.

Method
    The shingles of a text (five words) are hashed once. The hash's upper bits choose one of
    `bins` bins, its lower bits compete for the bin's minimum. Empty bins take the value of
    a bin found by a fixed sequence of hashes of (bin, attempt) that stops at the first bin
    that had shingles of its own (optimal densification). Of each bin the lowest `bits` bits
    are kept and packed; likeness corrects the share of equal bins for chance agreement,
    (m - 2^-bits) / (1 - 2^-bits), not below zero.

Scale
    Fingerprints need no shuffle. `with_next` pairs every document with the one after it
    by id: one range exchange sorts the table, a task walks its sorted run holding two
    documents, and only the first and the last document of each run go on to a small join
    of neighbouring runs.

Edge cases
    A null text is empty. A text without words has a fingerprint of its own (all zero bins)
    and likeness 1 to another such text. Fewer words than a shingle: the whole sequence is
    the shingle. Rows with equal ids follow each other by text digest; null ids come first.
    A single document is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map, handed_over, text_digest

BINS = 512
BITS = 4
WORDS = 5
#: Entries of a task's memory of word hashes; it is emptied when full.
KNOWN_WORDS = 300_000
#: Attempts looked at together when an empty bin is filled.
ATTEMPTS = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    """Fingerprints of texts; equal texts have equal fingerprints in every task."""

    def __init__(self, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> None:
        if bins & (bins - 1) or bins * bits % 8 or 8 % bits:
            raise ValueError("bins must be a power of two, and bins of `bits` bits must fill bytes")
        self.bins, self.bits, self.words = bins, bits, words
        self.known: dict[str, int] = {}

    def shingles(self, text: str) -> np.ndarray:
        """One 64-bit hash per shingle, repeats included."""
        found = text.split()
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(found).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        size = min(self.words, len(hashes))
        if not size:
            return hashes
        n = len(hashes) - size + 1
        out = np.full(n, np.uint64(size))
        for i in range(size):
            out = (out ^ hashes[i : i + n]) * _ODD
            out = (out << np.uint64(23)) | (out >> np.uint64(41))
        return _mix(out)

    def values(self, text: str) -> np.ndarray:
        hashes = self.shingles(text)
        if not len(hashes):
            return np.zeros(self.bins, dtype=np.uint64)
        shift = np.uint64(64 - (self.bins - 1).bit_length())
        chosen = (hashes >> shift).astype(np.int64)
        value = hashes & ((np.uint64(1) << shift) - np.uint64(1))
        empty_mark = ~np.uint64(0)
        least = np.full(self.bins, empty_mark)
        np.minimum.at(least, chosen, value)
        filled = least != empty_mark
        empty = np.flatnonzero(~filled)
        own = np.flatnonzero(filled)
        if len(own) == 1:
            least[empty] = least[own[0]]
            return least
        source, attempt = least.copy(), 0
        while len(empty):
            tries = np.arange(attempt, attempt + ATTEMPTS, dtype=np.uint64)
            at = _mix(empty.astype(np.uint64)[:, None] * _ODD + tries[None, :]) >> shift
            hit = filled[at.astype(np.int64)]
            found = hit.any(axis=1)
            first = hit.argmax(axis=1)
            least[empty[found]] = source[at[found, first[found]].astype(np.int64)]
            empty, attempt = empty[~found], attempt + ATTEMPTS
        return least

    def fingerprint(self, text: str) -> bytes:
        low = (self.values(text) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        packed = np.zeros(self.bins * self.bits // 8, dtype=np.uint8)
        per_byte = 8 // self.bits
        for i in range(per_byte):
            packed |= low[i::per_byte] << np.uint8(8 - self.bits * (i + 1))
        return packed.tobytes()

    def likeness(self, one: bytes, other: bytes) -> float:
        """Estimated share of common shingles, corrected for bins that agree by chance."""
        differ = np.frombuffer(one, dtype=np.uint8) ^ np.frombuffer(other, dtype=np.uint8)
        part = (1 << self.bits) - 1
        unequal = sum(int(np.count_nonzero(differ >> s & part)) for s in range(0, 8, self.bits))
        chance = 2.0**-self.bits
        return max(0.0, ((self.bins - unequal) / self.bins - chance) / (1 - chance))


def fingerprints(
    documents: DataFrame, bins: int = BINS, bits: int = BITS, words: int = WORDS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint): packed bins as binary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bins, bits, words)
        for batch in batches:
            found = [sketcher.fingerprint(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, type=pa.binary())], names=["doc_id", "fingerprint"]
            )

    source = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return arrow_map(source, work, "doc_id long, fingerprint binary")


#: What a task tells of a pair of neighbours: columns besides those of `describe`.
_OPEN = "part long, role int, text string"

Describe = Callable[[list[tuple[int | None, str]], list[str]], list[pa.Array]]


def with_next(
    documents: DataFrame, describe: Callable[[], Describe], columns: str,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Describe every document together with the text of the next one by id.

    `describe()` is called once in a task and gives a function from documents and the
    texts of their next documents to the values of `columns` (DDL; the id comes first).
    """
    names = [c.split()[0] for c in columns.split(", ")]

    def pack(values: list[pa.Array], n: int, parts: list[int], role: int, texts: list[str | None]) -> pa.RecordBatch:
        arrays = [*values, pa.array(parts, type=pa.int64()), pa.array([role] * n, type=pa.int32()),
                  pa.array(texts, type=pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "part", "role", "text"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Role 0: described. Roles 1 and 2: the run's first and last document, open."""
        part, work, held, kinds = TaskContext.get().partitionId(), describe(), None, None

        def bare(one: tuple[int | None, str], role: int) -> pa.RecordBatch:
            empty = [pa.array([one[0]], type=pa.int64()), *[pa.nulls(1, k) for k in kinds[1:]]]
            return pack(empty, 1, [part], role, [one[1]])

        for batch in batches:
            docs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            if not docs:
                continue
            first = held is None
            docs = docs if first else [held, *docs]
            kinds = kinds or [a.type for a in work([], [])]
            if first:
                yield bare(docs[0], 1)
            if len(docs) > 1:
                values = work(docs[:-1], [t for _, t in docs[1:]])
                n = len(docs) - 1
                yield pack(values, n, [part] * n, 0, [None] * n)
            held = docs[-1]
        if held is not None:
            yield bare(held, 2)

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = describe()
        for batch in batches:
            docs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays(work(docs, batch.column(2).to_pylist()), names=names)

    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    runs = source.repartitionByRange("doc_id", text_digest(F.col("text"))).sortWithinPartitions(
        "doc_id", text_digest(F.col("text"))
    )
    found = handed_over(arrow_map(runs, walk, f"{columns}, {_OPEN}"), "neighbours")
    # One row per run: its number, and the number of the run that follows it.
    parts = sorted(r["part"] for r in found.where("role = 1").select("part").collect())
    follow = dict(zip(parts, parts[1:] + parts[:1], strict=True))
    spark = documents.sparkSession
    order = spark.createDataFrame(list(follow.items()), "part long, next_part long")
    heads = found.where("role = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    ends = (
        found.where("role = 2").select(names[0], "text", "part").join(order, "part").join(heads, "next_part")
        .select(names[0], "text", "next_text")
    )
    return found.where("role = 0").select(*names).unionByName(arrow_map(ends, closed, columns))


EDITED = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def describe_edited() -> Describe:
    """Fingerprints of documents and of their edited texts, and likenesses."""
    sketcher = Sketcher()
    last: dict[str, bytes] = {}

    def sketch(text: str) -> bytes:
        # The next document of one row is the document of the next row.
        return last.pop(text) if text in last else sketcher.fingerprint(text)

    def work(docs: list[tuple[int | None, str]], following: list[str]) -> list[pa.Array]:
        rows = []
        for (doc_id, text), after in zip(docs, following, strict=True):
            own = sketch(text)
            last.clear()
            last[after] = next_print = sketcher.fingerprint(after)
            changed = edited_text(text, after)
            edited = sketcher.fingerprint(changed)
            rows.append(
                (doc_id, len(text), hashlib.sha256(changed.encode()).digest(), own, edited,
                 sketcher.likeness(own, edited), sketcher.likeness(own, next_print))
            )
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
        return [pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)]

    return work
