"""Hierarchical multi-length packing of documents into token sequences.

Method
    A document's ids (its text's ids, then one end id) are cut into full windows of the
    longest size; what is left is routed to the tier of the smallest context size that
    holds it. Tiers are packed from the longest to the shortest. A window starts with a
    document of its own tier, and its gap is filled with whole documents of shorter tiers,
    longest first; the last gap is closed by cutting one short document, whose rest goes
    back to the tier it then fits. So a window ends full. What cannot fill a window is
    carried to the next round of documents, and at the end of the partition it is laid
    out in the longest windows, the rest of that in shorter ones. Only the very last
    window of a partition is padded.
    The full windows of a tier are dealt to step groups of `group_size` by falling
    attention cost in alternating direction, so the groups of a tier cost about the same.

Scale
    Packing needs no shuffle: each partition packs the documents it reads, and what is held
    in memory is one round of documents (`ROUND_TOKENS`) plus less than one longest window
    for each tier. A repeated task reads the same rows in the same order and so makes the
    same sequences.

Edge cases
    A null text is an empty text: its only id is the end id. A null id stays null. Equal
    rows are packed as separate documents. An empty table gives an empty result. Other
    columns of the input are not looked at and may have any name.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map

TIERS = (256, 512, 1024, 2048)
END_ID = 1
ROUND_TOKENS = 2_000_000
GROUP_SIZE = 16
#: Entries of a task's memory of word ids; it is emptied when full.
KNOWN_WORDS = 200_000

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "offset long, tier int, step_group long"
)

# A blank between two characters that are no white space always starts a new word of the
# tokenizer's splitting pattern, so the two sides are tokenized independently of each other.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# The splitting pattern of the vocabulary, as published with it.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes stand
    for themselves, the others, in order, for the letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Known(dict):
    """Values by key, made where they are missing; emptied when full."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make = make

    def __missing__(self, key: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[key] = value = self.make(key)
        return value


class Encoder:
    """Exact ids of whole texts; what repeats between the blanks is looked up.

    What is new is merged with the file's own vocabulary by the fastest library at hand;
    special strings are left to the tokenizer itself. Requires a byte-level vocabulary in
    which the n-th merge makes the id 256 + n, which is checked.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        if any(model["vocab"][m.replace(" ", "")] != 256 + i for i, m in enumerate(merges)):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        byte = {letter: b for b, letter in byte_letters().items()}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        self.merge = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.inner = _Known(lambda part: self._part(" " + part))

    def _part(self, part: str) -> bytes:
        if any(s in part for s in self.special):
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        else:
            ids = self.merge(part)
        return struct.pack(f"<{len(ids)}i", *ids)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out, known = [], self.inner.__getitem__
        for text in texts:
            odd = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
            if odd or _OTHER_SPACE.search(text):
                first, *rest = _CUT.split(text)
            else:
                first, *rest = text.split(" ")
            out.append(np.frombuffer(self._part(first) + b"".join(map(known, rest)), dtype="<i4"))
        return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process."""
    return Encoder(path)


class Packer:
    """Packs a stream of documents; `pieces` collects (doc, start, length, sequence, offset)."""

    def __init__(self, tiers: tuple[int, ...], first_sequence: int, group_size: int) -> None:
        self.tiers, self.group_size = tuple(sorted(tiers)), group_size
        self.pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}
        self.sequence = self.first_sequence = first_sequence
        self.group = first_sequence
        self.pieces: list[tuple[int, int, int, int, int]] = []
        self.sequences: list[tuple[int, int, float]] = []  # id, tier, cost

    def route(self, doc: int, start: int, length: int) -> None:
        """Full longest windows at once, the rest to its tier."""
        longest = self.tiers[-1]
        while length >= longest:
            self._close([(doc, start, longest)], longest)
            start, length = start + longest, length - longest
        if length:
            self.pools[self._tier(length)].append((doc, start, length))

    def _tier(self, length: int) -> int:
        return next(t for t in self.tiers if t >= length)

    def _close(self, window: list[tuple[int, int, int]], tier: int) -> None:
        offset, cost = 0, 0.0
        for doc, start, length in window:
            self.pieces.append((doc, start, length, self.sequence, offset))
            offset += length
            cost += float(length) ** 2
        self.sequences.append((self.sequence, tier, cost))
        self.sequence += 1

    def _fill(self, gap: int, up_to: int) -> tuple[int, int, int] | None:
        """A whole piece of a shorter tier that fits, else one cut to the gap."""
        for tier in reversed(self.tiers):
            if tier <= gap and self.pools[tier]:
                return self.pools[tier].pop()
        for tier in self.tiers:
            if tier <= up_to and self.pools[tier]:
                doc, start, length = self.pools[tier].pop()
                if length > gap:
                    self.route(doc, start + gap, length - gap)
                    length = gap
                return doc, start, length
        return None

    def pack(self) -> None:
        """Close every window that can be filled; the others wait in their pools."""
        waiting: list[tuple[int, int, int]] = []
        for tier in reversed(self.tiers):
            while self.pools[tier]:
                window = [self.pools[tier].pop()]
                gap = tier - window[0][2]
                while gap:
                    piece = self._fill(gap, tier)
                    if piece is None:
                        break
                    window.append(piece)
                    gap -= piece[2]
                if gap:
                    waiting += window
                else:
                    self._close(window, tier)
        for piece in waiting:
            self.route(*piece)

    def finish(self) -> None:
        """Lay out what still waits: longest windows, then shorter ones, one padded at last."""
        left = [p for t in reversed(self.tiers) for p in self.pools[t]]
        total = sum(p[2] for p in left)
        sizes = []
        for tier in reversed(self.tiers):
            n, total = divmod(total, tier)
            sizes += [tier] * n
        sizes += [total] if total else []
        left.reverse()
        for size in sizes:
            window, gap = [], size
            while gap:
                doc, start, length = left.pop()
                if length > gap:
                    left.append((doc, start + gap, length - gap))
                    length = gap
                window.append((doc, start, length))
                gap -= length
            self._close(window, size if size in self.tiers else self.tiers[-1])
        self.pools = {t: [] for t in self.tiers}

    def take_groups(self) -> dict[int, tuple[int, int]]:
        """sequence → (tier, step group) for the windows closed since the last call."""
        out = {}
        for tier in self.tiers:
            closed = sorted((s for s in self.sequences if s[1] == tier), key=lambda s: (-s[2], s[0]))
            n = -(-len(closed) // self.group_size)
            for i, (sequence, _, _) in enumerate(closed):
                turn, at = divmod(i, n)
                out[sequence] = (tier, self.group + (at if turn % 2 == 0 else n - 1 - at))
            self.group += n
        self.sequences = []
        return out


def _rounds(
    batches: Iterator[pa.RecordBatch], encode: Callable[[list[str]], list[np.ndarray]], end_id: int
) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    held, tokens = [], 0
    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for doc_id, ids in zip(doc_ids, encode(texts), strict=True):
            held.append((doc_id, np.append(ids, np.int32(end_id))))
            tokens += len(ids) + 1
        if tokens >= ROUND_TOKENS:
            yield held
            held, tokens = [], 0
    yield held


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    group_size: int = GROUP_SIZE,
    doc_id: str | Column = "doc_id",
    text: str | Column = "text",
    finish: Callable[[list[np.ndarray]], pa.Array] | None = None,
    finished: str = "ids array<int>",
) -> DataFrame:
    """One row per piece of a document in a sequence: PIECES and the piece's ids.

    `finish` turns the ids of pieces into another column, named and typed by `finished`,
    inside the same task (a digest, for example); by default the ids are returned.
    """
    finish = finish or (lambda ids: pa.array(ids, type=pa.list_(pa.int32())))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        packer = Packer(tiers, TaskContext.get().partitionId() << 40, group_size)
        docs: dict[int, tuple[int | None, np.ndarray]] = {}
        number = 0

        def out() -> Iterator[pa.RecordBatch]:
            groups, pieces = packer.take_groups(), packer.pieces
            packer.pieces = []
            for at in range(0, len(pieces), 4096):
                some = pieces[at : at + 4096]
                cols = np.array([(p[1], p[2], len(docs[p[0]][1]), p[3], p[4], *groups[p[3]]) for p in some])
                names = ("start", "length", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
                arrays = [pa.array([docs[p[0]][0] for p in some], type=pa.int64())]
                arrays += [
                    pa.array(cols[:, i], type=pa.int32() if n == "tier" else pa.int64()) for i, n in enumerate(names)
                ]
                arrays.append(finish([docs[p[0]][1][p[1] : p[1] + p[2]] for p in some]))
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names, finished.split()[0]])
            held = {p[0] for pool in packer.pools.values() for p in pool}
            for n in [n for n in docs if n not in held]:
                del docs[n]

        for held in _rounds(batches, encoder.ids, end_id):
            for one in held:
                docs[number] = one
                packer.route(number, 0, len(one[1]))
                number += 1
            packer.pack()
            yield from out()
        packer.finish()
        yield from out()

    source = documents.select(
        (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long").alias("doc_id"),
        (F.col(text) if isinstance(text, str) else text).alias("text"),
    )
    return arrow_map(source, work, f"{PIECES}, {finished}")


def ids_crc32(ids: list[np.ndarray]) -> pa.Array:
    """Digest of a piece: CRC-32 of its ids as little-endian unsigned 32-bit numbers."""
    return pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], type=pa.int64())
