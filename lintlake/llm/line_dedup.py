"""Line dedup with content-defined chunks.

Method
    A text is a sequence of lines: physical lines, inside them sentences, and inside these
    stretches that end behind a word which a hash of its last bytes chooses. Each line is
    hashed, and a rolling hash over the hashes of the last two lines ends a chunk where it
    is divisible by `DIVISOR`. So a boundary depends on the content before it alone and finds
    itself again behind an insertion, also where a passage begins and ends in the middle of a
    sentence. A physical line of `long_words` words or more also begins and ends a chunk.
    A smaller chunk joins the one before it. Chunks of at least two lines and `SEED_WORDS`
    words, and long lines, are looked for in all documents. A chunk that is equal byte for byte to an earlier one (smallest id, then
    position) is a seed. It is extended over whole words to both sides for as long as the two
    texts agree; chunks behind one another and their extensions make a run. Runs of `min_words` words or more go, with the white space behind them.
    Whatever goes is equal to text at an earlier place, so its first occurrence stays.

Scale
    Only chunk hashes are grouped, with partial aggregation, so a chunk in a third of all
    documents is combined before the shuffle. Copies meet their first occurrence by hash; a
    side is extended only where the chunk beside the copy is not the one beside the first,
    and for `REACH` bytes at most. Texts meet their spans
    by id, once for the bytes and once for the result. Lists are bounded by one document; equal rows are
    one document. Nothing is collected.

Edge cases
    A null text stays null. A null id is smaller than any other. Rows with equal id and
    equal text count as one document and have the same result; rows with equal ids and
    different texts are ordered by text digest. An empty table gives an empty result.
    Other columns are kept and may have any name; `n_chars`, if there, is brought up to
    date by `without_repeats`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map, done_with, handed_over, text_digest

#: A word ends a line with a chance of one in so many, a line ends a chunk likewise.
WORD_DIVISOR = 3
DIVISOR = 2
MAX_LINES = 64
SEED_WORDS = 8
MIN_WORDS = 20
LONG_WORDS = 40
#: Bytes beside a seed in which the texts may agree; what follows an equal chunk is a seed itself.
REACH = 192

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[33, 46, 63]] = True
#: Odd factors of the hashes over a word's last bytes, over lines and over bytes.
_FACTORS = np.random.default_rng(7).integers(1 << 62, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_FACTORS[7])
#: Bytes worked on at once, about a hundred bytes of memory each; longer texts are cut.
PIECE = 1 << 20
_WORD = re.compile(rb"[\t-\r ][^\t-\r ]")
#: Between the texts of a batch: keeps a word's hash from looking into the text before.
_GAP = b"\n" * 8


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _FACTORS[5]
    return (h ^ (h >> np.uint64(29))) * _FACTORS[6]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Chunks(NamedTuple):
    """Chunks of a batch of texts, in order. Places are bytes of their text."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    #: Where the next chunk begins, or the text ends.
    after: np.ndarray
    words: np.ndarray
    hash: np.ndarray
    #: Looked for: two lines and words enough, or a long line.
    worth: np.ndarray


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, offset, piece) in groups of about PIECE bytes; a longer text is cut before a word."""
    group, held = [], 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t)
            if end - at > PIECE:
                word = _WORD.search(t, at + PIECE)
                end = word.end() - 1 if word else end
            group.append((i, at, t[at:end]))
            held, at = held + end - at, end
            if held >= PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def chunks_of(texts: list[bytes], seed_words: int = SEED_WORDS, long_words: int = LONG_WORDS) -> Chunks:
    """The chunks of all texts; works on PIECE bytes at a time, so memory does not grow with a text."""
    parts = []
    for group in _pieces(texts):
        found = _chunks_of([piece for _, _, piece in group], seed_words, long_words)
        own = np.array([i for i, _, _ in group], dtype=np.int64)[found.text]
        offset = np.array([at for _, at, _ in group], dtype=np.int64)[found.text]
        parts.append(found._replace(
            text=own, start=found.start + offset, stop=found.stop + offset, after=found.after + offset
        ))
    if not parts:
        return _chunks_of([], seed_words, long_words)
    return Chunks(*(np.concatenate(columns) for columns in zip(*parts, strict=True)))


def _chunks_of(texts: list[bytes], seed_words: int, long_words: int) -> Chunks:
    """All texts at once: every step is one pass over the bytes, words or lines of the batch."""
    data = _GAP + b"".join(t + _GAP for t in texts)
    a = np.frombuffer(data, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = len(_GAP) + np.concatenate(([0], np.cumsum(sizes + len(_GAP))[:-1])).astype(np.int64) if len(texts) else sizes
    blank = _BLANK[a]
    place = np.flatnonzero(~blank)
    if not len(place):
        none = np.zeros(0, dtype=np.int64)
        return Chunks(none, none, none, none, none, none.astype(np.uint64), none.astype(bool))
    # Words, by their first byte and the byte behind the last.
    word_start = place[blank[place - 1]]
    word_stop = place[blank[place + 1]] + 1
    mixed = np.zeros(len(word_stop), dtype=np.uint64)
    for back in range(6):
        mixed += a[word_stop - 1 - back].astype(np.uint64) * _FACTORS[back]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[0]
    chosen = (mixed >> np.uint64(40)) % np.uint64(WORD_DIVISOR) == 0
    newlines = np.concatenate(([0], np.cumsum(a == 10)))
    behind = np.append(word_start[1:], len(a) - 1)
    physical = newlines[behind] > newlines[word_stop]
    last = np.flatnonzero(chosen | _STOP[a[word_stop - 1]] | physical)
    first = np.concatenate(([0], last[:-1] + 1))
    start, stop = word_start[first], word_stop[last]
    physical = physical[last]
    text = np.searchsorted(begins, start, side="right") - 1
    final = np.append(text[1:] != text[:-1], True)
    # Edges: the line before and the last line of a long physical line.
    ends_line = np.flatnonzero(physical)
    begins_line = np.concatenate(([0], ends_line[:-1] + 1))
    long = last[ends_line] - first[begins_line] + 1 >= long_words
    edge = np.zeros(len(start) + 1, dtype=bool)
    edge[ends_line[long]] = True
    edge[begins_line[long] - 1] = True  # before the first line: the spare last place
    edge = edge[:-1] | final
    # Hash of any stretch: difference of prefix sums, shifted to the origin.
    room = 1 << max(16, int(len(a)).bit_length())
    up, down = _powers(room)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(a.astype(np.uint64) * up[: len(a)], dtype=np.uint64)))
    stretch = lambda s, e: _mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
    hashes = stretch(start, stop)
    prior = np.concatenate((np.zeros(1, dtype=np.uint64), hashes[:-1]))
    prior[1:][edge[:-1]] = 0
    rolled = _mixed(prior * _FACTORS[1] + hashes)
    ends = (rolled >> np.uint64(33)) % np.uint64(DIVISOR) == 0
    # No end behind an end, so a chunk has two lines unless it is cut off by an edge.
    ends &= ~np.concatenate(([False], ends[:-1] & ~edge[:-1]))
    ends |= edge
    line = np.arange(len(start))
    since = line - np.maximum.accumulate(np.where(np.append(True, ends[:-1]), line, 0))
    ends |= since % MAX_LINES == MAX_LINES - 1
    to = np.flatnonzero(ends)
    at = np.concatenate(([0], to[:-1] + 1))
    # What is too small to be looked for belongs to the chunk before it, if no edge is between.
    big = last[to] - first[at] + 1 >= np.where(to > at, seed_words, long_words)
    heads = np.flatnonzero(big | np.append(True, edge[to[:-1]]))
    to, at = np.append(to[heads[1:] - 1], to[-1]), at[heads]
    words = last[to] - first[at] + 1
    own, c_start, c_stop = text[at], start[at], stop[to]
    follows = np.append(own[1:] == own[:-1], False)
    after = np.where(follows, np.append(c_start[1:], 0), begins[own] + sizes[own])
    worth = words >= np.where(to > at, seed_words, long_words)
    here = begins[own]
    return Chunks(own, c_start - here, c_stop - here, after - here, words, stretch(c_start, c_stop), worth)


_CHUNK = (
    "doc_id long, digest long, start int, stop int, after int, words int, hash long, prior int, next int, "
    "from_byte int, to_byte int"
)


def _table_of(ids: pa.Array, digests: pa.Array, texts: list[bytes], seed_words: int, long_words: int) -> pa.RecordBatch:
    """Rows of _CHUNK for a batch: the chunks that are looked for, places in code points and in bytes.

    Of the hashes beside a chunk 32 bits, enough to tell whether two neighbours differ: 0
    where the text begins or ends, null for a neighbour too small to be looked for.
    """
    found = chunks_of(texts, seed_words, long_words)
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    points = np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)))
    base = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)[found.text]
    point = lambda x: (points[base + x] - points[base]).astype(np.int32)
    same = found.text[1:] == found.text[:-1] if len(found.text) else np.zeros(0, dtype=bool)
    short = (found.hash >> np.uint64(32)).astype(np.uint32).view(np.int32)
    n = len(found.text)
    before, behind = np.append(False, same)[:n], np.append(same, False)[:n]
    start, stop = point(found.start), point(found.stop)
    keep = found.worth
    beside = lambda by, there: (np.where(there, np.roll(short, by), 0), ~there | np.roll(keep, by))

    def column(values: np.ndarray, given: np.ndarray | None = None) -> pa.Array:
        return pa.array(values[keep], mask=None if given is None else ~given[keep])

    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(found.text[keep])), digests.take(pa.array(found.text[keep])), column(start), column(stop),
            column(point(found.after)), column(found.words.astype(np.int32)), column(found.hash.view(np.int64)),
            column(*beside(1, before)), column(*beside(-1, behind)),
            column(found.start.astype(np.int32)), column(found.stop.astype(np.int32)),
        ],
        names=[c.split()[0] for c in _CHUNK.split(", ")],
    )


def chunk_table(
    documents: DataFrame, seed_words: int = SEED_WORDS, long_words: int = LONG_WORDS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per chunk that is looked for, with what stands beside it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _table_of(batch.column(0), batch.column(1), batch.column(2).to_pylist(), seed_words, long_words)

    source = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_digest(F.col(text)).alias("digest"),
        F.coalesce(text, F.lit("")).cast("binary").alias("text"),
    )
    return arrow_map(source, work, _CHUNK)


#: What identifies a document; a null id has a flag, so that joins and groupings share their shuffle.
KEY = ("known", "id0", "digest")


def _key(doc_id: str = "doc_id") -> list[Column]:
    return [F.col(doc_id).isNotNull().alias("known"), F.coalesce(F.col(doc_id), F.lit(0).cast("long")).alias("id0")]


def _met(chunks: DataFrame) -> DataFrame:
    """(KEY, start, stop, after, words, hash, left, right): chunks whose hash occurs elsewhere.

    `left` and `right` ask for the text beside: of a copy where the chunk beside it is not
    the one beside the first occurrence, of a first occurrence where a copy asks.
    """
    # Only hashes are grouped over all chunks. Handed over, so that adaptive execution can
    # split the hash of a hot chunk in the joins.
    often = handed_over(chunks.groupBy("hash").count().where("count > 1").select("hash"), "repeated-hashes")
    met = handed_over(chunks.join(often, "hash"), "repeated-chunks")
    done_with(chunks, often)
    place = F.struct(*KEY, "start")
    grouped = met.groupBy("hash").agg(
        F.min(F.struct(*KEY, "start", "prior", "next")).alias("f"), F.max(place).alias("last")
    )
    first_place = F.struct(*[F.col(f"f.{c}") for c in (*KEY, "start")])
    first = handed_over(grouped.where(first_place != F.col("last")).drop("last"), "first-places")
    differs = lambda side: ~F.coalesce(F.col(side) == F.col(f"f.{side}"), F.lit(False))
    flagged = met.join(first, "hash").select(
        *met.columns, (place == first_place).alias("is_first"), differs("prior").alias("left"), differs("next").alias("right")
    )
    flagged = handed_over(flagged.drop("prior", "next"), "flagged-chunks")
    done_with(met, first)
    copies = flagged.where("not is_first").drop("is_first")
    asked = copies.groupBy("hash").agg(F.bool_or("left").alias("left"), F.bool_or("right").alias("right"))
    asked = handed_over(asked, "asked-sides")
    firsts = flagged.where("is_first").drop("is_first", "left", "right").join(asked, "hash")
    both = handed_over(copies.unionByName(firsts), "wanted-chunks")
    done_with(flagged, asked)
    return both


def _spans(met: DataFrame) -> DataFrame:
    """(KEY, spans): of every document the chunks of `_met`; rows that repeat a document list them once."""
    columns = ["start", "stop", "after", "words", "hash", "left", "right", "from_byte", "to_byte"]
    return met.groupBy(*KEY).agg(F.collect_set(F.struct(*columns)).alias("spans"))


_RUN = "known boolean, id0 long, digest long, start int, stop int, words int"


#: Marks where a document begins or ends, in what is read beside a chunk.
_END = "\0"


def _read(beside: bytes | None) -> str | None:
    """Characters cut off at the far end are left out."""
    return None if beside is None else beside.decode(errors="ignore")


def _agree(mine: str, other: str) -> int:
    """Length of the common beginning of two texts, cut back to whole words."""
    ended = mine.endswith(_END), other.endswith(_END)
    mine, other = mine.removesuffix(_END), other.removesuffix(_END)
    low, high = 0, min(len(mine), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if mine[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    whole = [t[low].isspace() if low < len(t) else end for t, end in zip((mine, other), ended, strict=True)]
    if low and not all(whole):
        while low and not mine[low - 1].isspace():
            low -= 1
    return low


def _extended(copies: DataFrame) -> DataFrame:
    """Copies with what stands beside them and beside their first occurrence → spans with extensions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _RUN.split(", ")]
        for batch in batches:
            rows = []
            for known, id0, digest, start, stop, after, words, left, right, f_left, f_right in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                left, right, f_left, f_right = map(_read, (left, right, f_left, f_right))
                if left is not None and f_left is not None:
                    own = left[::-1]
                    piece = own[: _agree(own, f_left[::-1])].rstrip()
                    words += len(piece.split())
                    start -= len(piece)
                if right is not None and f_right is not None:
                    piece = right[: _agree(right, f_right)].rstrip()
                    if piece:
                        rest = right.removesuffix(_END)[len(piece) :]
                        words += len(piece.split())
                        after = stop + len(piece) + len(rest) - len(rest.lstrip())
                rows.append((known, id0, digest, start, after, words))
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return arrow_map(copies, work, _RUN)


def repeats(
    documents: DataFrame, seed_words: int = SEED_WORDS, long_words: int = LONG_WORDS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(KEY, start, stop, words): spans that repeat earlier text, extended, in no order; they may overlap."""
    keyed = chunk_table(documents, seed_words, long_words, doc_id, text).select("*", *_key()).drop("doc_id")
    met = _met(handed_over(keyed, "chunks"))
    spans = _spans(met)
    # Bytes: a place in a text of characters is found by counting from its beginning.
    part = lambda a, z: f"substring(_bytes, {a} + 1, {z} - {a})"
    begins, ends = f"s.from_byte <= {REACH}", f"s.to_byte + {REACH} >= octet_length(_bytes)"
    left = f"concat(CASE WHEN {begins} THEN X'00' ELSE X'' END, {part(f'greatest(s.from_byte - {REACH}, 0)', 's.from_byte')})"
    right = f"concat({part('s.to_byte', f'(s.to_byte + {REACH})')}, CASE WHEN {ends} THEN X'00' ELSE X'' END)"
    texts = documents.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    texts = texts.select(*_key("_id"), text_digest(F.col("_text")).alias("digest"), F.col("_text").cast("binary").alias("_bytes"))
    own = [*KEY, "start", "stop", "after", "words"]
    bodies = (
        texts.join(spans, list(KEY))
        .select(*KEY, "_bytes", F.explode("spans").alias("s"))
        .select(
            *KEY, "s.start", "s.stop", "s.after", "s.words", "s.hash", F.expr(part("s.from_byte", "s.to_byte")).alias("body"),
            F.when(F.col("s.left"), F.expr(left)).alias("left"), F.when(F.col("s.right"), F.expr(right)).alias("right"),
        )
    )
    bodies = handed_over(bodies, "bodies")
    done_with(met)
    grouped = bodies.groupBy("hash", "body").agg(
        F.min(F.struct(*KEY, "start", "left", "right")).alias("f"), F.count("*").alias("copies")
    )
    first = handed_over(grouped.where("copies > 1").drop("copies"), "first-chunks")
    is_first = F.struct(*KEY, "start") == F.struct(*[F.col(f"f.{c}") for c in (*KEY, "start")])
    copies = bodies.join(first, ["hash", "body"]).where(~is_first)
    copies = copies.select(*own, "left", "right", F.col("f.left").alias("f_left"), F.col("f.right").alias("f_right"))
    found = handed_over(_extended(copies), "repeats")
    done_with(bodies, first)
    return found


def _runs(spans: DataFrame, min_words: int) -> DataFrame:
    """(KEY, removed): of every document the runs of `min_words` words, in order, apart from one another."""
    listed = spans.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("start", "stop", "words"))).alias("all"))
    merged = F.expr(
        "aggregate(all, cast(array() as array<struct<start:int,stop:int,words:int>>), (runs, s) -> "
        "CASE WHEN size(runs) > 0 AND s.start <= element_at(runs, -1).stop "
        "THEN concat(slice(runs, 1, size(runs) - 1), array(named_struct('start', element_at(runs, -1).start, "
        "'stop', greatest(s.stop, element_at(runs, -1).stop), 'words', element_at(runs, -1).words + s.words))) "
        "ELSE concat(runs, array(s)) END)"
    )
    kept = F.filter(merged, lambda r: r["words"] >= min_words)
    spans_only = F.transform(kept, lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop")))
    return listed.select(*KEY, spans_only.alias("_removed")).where("size(_removed) > 0")


def without_repeats(
    documents: DataFrame, min_words: int = MIN_WORDS, seed_words: int = SEED_WORDS, long_words: int = LONG_WORDS,
    doc_id: str = "doc_id", text: str = "text", details: bool = False,
) -> DataFrame:
    """The documents with repeated runs taken out of their texts.

    With `details` a column `removed` (array of start and stop, code points of the text as
    it was, in order) is added; a column of that name is replaced.
    """
    drops = _runs(repeats(documents, seed_words, long_words, doc_id, text), min_words)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    rows = documents.select(row, F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    rows = rows.select("_row", "_text", *_key("_id"), text_digest(F.col("_text")).alias("digest"))
    joined = rows.join(drops, list(KEY), "left")
    # What stays: between the end of one removed run and the start of the next.
    kept = F.expr(
        "array_join(zip_with(array_insert(transform(_removed, r -> r.stop), 1, 0), "
        "array_append(transform(_removed, r -> r.start), length(_text)), "
        "(a, b) -> substring(_text, a + 1, b - a)), '')"
    )
    changed = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(kept)
    made = joined.select("_row", changed.alias("_new"), "_removed")
    columns = []
    for c in documents.columns:
        if c == text:
            columns.append(F.col("_new").alias(c))
        elif c == "n_chars":
            now = F.length("_new").cast(documents.schema[c].dataType)
            columns.append(F.when(F.col("_removed").isNull(), F.col("_row.n_chars")).otherwise(now).alias(c))
        elif not (details and c == "removed"):
            columns.append(F.col(f"_row.`{c}`").alias(c))
    if details:
        spans = F.array().cast("array<struct<start:int,stop:int>>")
        columns.append(F.coalesce(F.col("_removed"), spans).alias("removed"))
    return made.select(*columns)
