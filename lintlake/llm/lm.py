"""Language-model scores of whole documents by a gated recurrent network.

Method
    Words are counted over all training documents. The most frequent words (with the end of
    a text) are the network's own vocabulary, in classes of about equal size by falling
    frequency; all other words fall into tail classes by a hash of their ending. A gated
    recurrent unit (numpy, single precision) predicts the next class by a softmax over
    classes, and the word by a second softmax inside its class. Inside a tail class a
    word's share is its corpus count plus one half over the class's sum of these, with one
    half for words never seen: so a text's probability is complete for every word.
    Training is truncated backpropagation: runs of windows with the state carried from one
    window to the next and gradients cut between them. In every round each partition starts
    from the same weights, trains on its part of every training document's runs, and the
    weights are averaged by tokens. Scoring carries the state through the whole document.

Scale
    Counts are partly summed in tasks before they are shuffled; what is gathered grows with
    the corpus and stays in a table in the shared folder. The driver sees the head of the
    vocabulary (`HEAD_WORDS`, a proven bound) and averaged weights. Words outside the head
    meet their counts in an equi-join, one row per document and word. Texts are split twice,
    to be counted and to be handed over as 16-bit tokens; training and scoring read these. Every token of every
    training document is trained on once: `RUN_STRIDE` equals `ROUNDS`, and a run's number
    and the document's id decide its round. Training grows with the corpus and has no cap. A task holds `ROUND_TOKENS`
    tokens of documents at once or one document.

Edge cases
    A null text is empty: only its end is scored. A null id is an empty id. Equal rows have
    equal scores. Without training documents every word is unknown. An empty table gives an
    empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map, handed_over

HEAD_WORDS = 131_072
OWN_WORDS = 2_048
OWN_CLASSES = 64
TAIL_CLASSES = 64
HIDDEN = 32
WINDOW = 32
RUN_WINDOWS = 2
RUN_STRIDE = 3
ROUNDS = 3
BATCH = 96
RATE = 0.007
ROUND_TOKENS = 1_500_000
LANES = 256
COUNTED_WORDS = 200_000
GATHERED = 4_000_000
FOLDS = 5
END = b""
_LN10 = math.log(10.0)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII blanks, A-Z in lower case."""
    return text.lower().split()


def id_hash(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))


def held_out(doc_id: Column) -> Column:
    return id_hash(doc_id) % FOLDS == 1


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAIL_CLASSES


def _tail_classes(words: pa.Array) -> np.ndarray:
    endings = pc.binary_slice(words, -3).dictionary_encode()
    classes = np.array([tail_class(e) for e in endings.dictionary.to_pylist()], dtype=np.int64)
    return classes[endings.indices.to_numpy()]


def _source(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold `GATHERED` bytes, so that what is done once for
    each is done seldom, and those of long texts cut to about that; none is empty."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * GATHERED // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            size += held[-1].nbytes
            if size >= GATHERED:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def coded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What `words_of` gives for each text and then its end, the empty word: (different
    words, place among these of every word of all texts in order, words per text)."""
    said = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    # The end is put first, so it is there and its place is 0.
    flat = pa.concat_arrays([pa.array([""]), said.flatten()]).dictionary_encode()
    codes = flat.indices.to_numpy()[1:].astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), said.value_lengths().to_numpy())
    # A blank before the first word or after the last one gives an empty piece.
    real = codes > 0
    sizes = np.bincount(owner[real], minlength=len(texts)) + 1
    inner = np.ones(sizes.sum(), dtype=bool)
    inner[sizes.cumsum() - 1] = False
    out = np.zeros(len(inner), dtype=np.int64)
    out[inner] = codes[real]
    return flat.dictionary.view(pa.binary()), out, sizes


def _summed(counts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("c", "sum")])
    return found.select(["word", "c_sum"]).rename_columns(["word", "c"])


def word_counts(source: DataFrame) -> DataFrame:
    """(word, c): counts over all texts of `source`; the end of a text is the empty word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in _gathered(batches):
            words, codes, _ = coded_words(batch.column(0))
            held.append(pa.table({"word": words, "c": np.bincount(codes, minlength=len(words))}))
            if sum(t.num_rows for t in held) >= 2 * COUNTED_WORDS:
                held = [_summed(held)]
                if held[0].num_rows >= COUNTED_WORDS:
                    yield from held.pop().to_batches()
        if held:
            yield from _summed(held).to_batches()

    return arrow_map(source.select("text"), work, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """The head of the counts and the sums that make probabilities complete."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    tail_sums: np.ndarray
    #: How many of the head's first words are the network's own.
    own: int

    @property
    def class_of_own(self) -> np.ndarray:
        """Class of each own word: equal shares of the square roots of counts."""
        mass = np.sqrt(self.counts[: self.own].astype(np.float64))
        return np.minimum((mass.cumsum() - mass / 2) / max(mass.sum(), 1e-9) * OWN_CLASSES, OWN_CLASSES - 1).astype(int)


def _head(counts: DataFrame) -> list:
    """The most frequent words, at most HEAD_WORDS, in falling order.

    A histogram of counts (a sixteenth of an octave wide, so about a thousand bins at any
    size) tells from which bin on all words fit; only those words come to the driver.
    """
    size = F.floor(F.log2("c") * 16)
    bins = sorted(counts.groupBy(size.alias("bin")).count().collect(), key=lambda r: -r["bin"])
    taken, lowest = 0, None
    for row in bins:
        taken += row["count"]
        if taken > HEAD_WORDS:
            break
        lowest = row["bin"]
    if lowest is None:
        return []
    return sorted(counts.where(size >= lowest).collect(), key=lambda r: (-r["c"], bytes(r["word"])))


def vocabulary(counts: DataFrame) -> Vocabulary:
    head = _head(counts)
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = [bytes(r["word"]) for r in head]
    own = head[: min(OWN_WORDS, len(head))]
    # Tail classes: all words after the own ones in the order of the head.
    ending = F.substring("word", -3, 3)
    after = F.lit(True)
    if own:
        last = own[-1]
        after = (F.col("c") < last["c"]) | ((F.col("c") == last["c"]) & (F.col("word") > F.lit(bytes(last["word"]))))
    sums = np.full(TAIL_CLASSES, 0.5)
    for row in (
        counts.where(after).groupBy((F.crc32(ending) % TAIL_CLASSES).alias("t")).agg(F.sum(F.col("c") + 0.5).alias("s"))
    ).collect():
        sums[row["t"]] += row["s"]
    return Vocabulary(words, np.array([r["c"] for r in head], dtype=np.int64), total, distinct, sums, len(own))


class Network:
    """The recurrent model; `p` maps names to float32 arrays."""

    SHAPES = ("embed", "wx", "b", "u", "oc", "bc", "ow", "bw")

    def __init__(self, own_class: np.ndarray, p: dict[str, np.ndarray]) -> None:
        self.p, self.own = p, len(own_class)
        self.starts = np.searchsorted(own_class, np.arange(OWN_CLASSES + 1))
        self.class_of = np.concatenate([own_class, OWN_CLASSES + np.arange(TAIL_CLASSES)]).astype(np.int16)
        self.start_token = self.own + TAIL_CLASSES

    @classmethod
    def fresh(cls, vocabulary: Vocabulary) -> Network:
        """Weights that give the corpus's own frequencies whatever the state."""
        rng, own = np.random.default_rng(7), vocabulary.own
        own_class = vocabulary.class_of_own
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        mass = np.bincount(own_class, weights=vocabulary.counts[:own] + 0.5, minlength=OWN_CLASSES)
        mass = np.concatenate([mass, vocabulary.tail_sums])
        p = {
            "embed": small(own + TAIL_CLASSES + 1, HIDDEN) * 3,
            "wx": small(HIDDEN, 3 * HIDDEN),
            "b": np.concatenate([np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32),
            "u": small(HIDDEN, 3 * HIDDEN),
            "oc": np.zeros((HIDDEN, OWN_CLASSES + TAIL_CLASSES), dtype=np.float32),
            # A class without words gets no share.
            "bc": np.where(mass > 0, np.log(np.maximum(mass, 1e-3) / mass.sum()), -1e4).astype(np.float32),
            "ow": np.zeros((own, HIDDEN), dtype=np.float32),
            "bw": np.log(vocabulary.counts[:own] + 0.5).astype(np.float32),
        }
        return cls(own_class, p)

    def step(self, x: np.ndarray, h: np.ndarray) -> np.ndarray:
        k = HIDDEN
        hu = h @ self.p["u"]
        gates = x[:, : 2 * k] - hu[:, : 2 * k]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        n = gates[:, k:] * hu[:, 2 * k :]
        n += x[:, 2 * k :]
        np.tanh(n, out=n)
        new = h - n
        new *= gates[:, :k]
        new += n
        return new

    def inputs(self) -> np.ndarray:
        """The input part of the gates for every token; of keep and reset, with the sign turned."""
        x = self.p["embed"] @ self.p["wx"] + self.p["b"]
        x[:, : 2 * HIDDEN] *= -1
        return x

    def log_probs(
        self, h: np.ndarray, target: np.ndarray, grads: dict | None = None, scale: float = 1.0, rows: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Natural log of class and inner word share of each target; with `grads`, the gradient
        of minus their sum times `scale` by the states; the weights' gradients, which the
        caller has set to zero, are filled in.

        `rows` are the states that the targets belong to; without it, all in order."""
        at = self.class_of[target]
        # Sorted by class: the own words come first, and each class is one slice.
        order = np.argsort(at, kind="stable")
        at, word = at[order], target[order]
        place = order if rows is None else rows[order]
        some = h.take(place, axis=0)
        sorted_out = np.empty(len(order), dtype=np.float64)
        by_h = None if grads is None else np.empty_like(some)
        self._classes(some, at, sorted_out, by_h, grads, scale)
        edges = np.searchsorted(at, np.arange(OWN_CLASSES + 1))
        if edges[-1]:
            self._inner(some, word[: edges[-1]], at[: edges[-1]], edges.tolist(), sorted_out, by_h, grads, scale)
        out, dh = np.empty_like(sorted_out), None
        out[order] = sorted_out
        if grads is not None:
            dh = np.zeros_like(h)
            dh[place] = by_h
        return out, dh

    def _classes(self, h, at, out, dh, grads, scale) -> None:
        """Set `out` to the shares of classes, and with `grads` `dh` and their gradients."""
        oc, bias = self.p["oc"], self.p["bc"] - self.p["bc"].max()
        # Without a risk of overflow the largest term of each row need not be taken off.
        reach = max(h.max(initial=0), -h.min(initial=0)) * math.sqrt(len(oc) * float((oc * oc).sum(axis=0).max()))
        safe = reach <= _SAFE
        weight = np.exp(bias) if safe else np.ones_like(bias)
        rows, room = np.arange(_ROWS), np.empty((_ROWS, len(bias)), dtype=h.dtype)
        weighted = np.ascontiguousarray((oc * weight).T)
        d_oc, d_bc = np.zeros_like(oc), np.zeros_like(bias)
        for lo in range(0, len(h), _ROWS):
            some, mine = h[lo : lo + _ROWS], at[lo : lo + _ROWS]
            n = len(some)
            shares = np.matmul(some, oc, out=room[:n])
            if not safe:
                shares += bias
                shares -= shares.max(axis=1, keepdims=True)
            out[lo : lo + n] = shares[rows[:n], mine]
            np.exp(shares, out=shares)
            sums = shares @ weight
            out[lo : lo + n] -= np.log(sums)
            if grads is not None:
                shares[rows[:n], mine] -= sums / weight[mine]
                part = scale / sums
                back = np.matmul(shares, weighted, out=dh[lo : lo + n])
                back *= part[:, None]
                d_oc += (some * part[:, None]).T @ shares
                d_bc += part @ shares
        if safe:
            out += bias[at]
        if grads is not None:
            np.multiply(d_oc, weight, out=grads["oc"])
            np.multiply(d_bc, weight, out=grads["bc"])

    def _inner(self, h, word, at, edges, out, dh, grads, scale) -> None:
        """Add the shares inside classes to `out`, and with `grads` the gradients to `dh` and them.

        All pairs of a target and a word of its class lie in one array, class by class.
        """
        ow, bw, starts = self.p["ow"], self.p["bw"], self.starts.tolist()
        width = np.diff(self.starts)[at]
        ends = width.cumsum()
        first = ends - width
        pairs = np.empty(ends[-1], dtype=h.dtype)
        blocks, lo = [], 0
        for c in range(OWN_CLASSES):
            a, b, i, j = edges[c], edges[c + 1], starts[c], starts[c + 1]
            if a < b:
                hi = lo + (b - a) * (j - i)
                block = pairs[lo:hi].reshape(b - a, j - i)
                np.matmul(h[a:b], ow[i:j].T, out=block)
                block += bw[i:j]
                blocks.append((a, b, i, j, block))
                lo = hi
        mine = first + word - self.starts[at]
        pairs -= np.maximum.reduceat(pairs, first).repeat(width)
        out[: len(word)] += pairs[mine]
        np.exp(pairs, out=pairs)
        sums = np.add.reduceat(pairs, first)
        out[: len(word)] -= np.log(sums)
        if grads is None:
            return
        pairs *= (scale / sums).repeat(width)
        pairs[mine] -= scale
        by_h, ones = np.empty((len(word), HIDDEN), dtype=h.dtype), np.ones(len(word), dtype=h.dtype)
        d_ow, d_bw = grads["ow"], grads["bw"]
        for a, b, i, j, block in blocks:
            np.matmul(block, ow[i:j], out=by_h[a:b])
            np.matmul(block.T, h[a:b], out=d_ow[i:j])
            np.matmul(ones[a:b], block, out=d_bw[i:j])
        dh[: len(word)] += by_h

    def train_window(
        self, tokens: np.ndarray, targets: np.ndarray, h: np.ndarray, grads: dict | None = None
    ) -> tuple[dict, np.ndarray]:
        """Gradients of one window (lanes x steps; target -1 is padding), and the next state.

        States and gates go step by step, then feature by feature, then lane by lane; the
        gates by the rows new, keep, reset, state's part of new. Each step is one pass over
        small arrays that stay in a core's cache, and so is each step back.
        """
        p, k = self.p, HIDDEN
        if grads is None:
            grads = {name: np.empty_like(v) for name, v in p.items()}
        for g in grads.values():
            g.fill(0)
        lanes, steps = tokens.shape
        kind, given = p["u"].dtype, tokens.T.ravel()
        # The bias is one more weight, of an input that is always one.
        from_x = np.roll(np.concatenate([p["wx"], p["b"][None]]).T, k, axis=0)
        to_x, from_h = np.ascontiguousarray(from_x[:, :k]), np.ascontiguousarray(p["u"].T)
        from_x[k:] *= -1
        from_h[: 2 * k] *= -1
        x = np.ones((steps, lanes, k + 1), dtype=kind)
        x[:, :, :k] = p["embed"].take(given, axis=0).reshape(steps, lanes, k)

        state = np.empty((steps + 1, k, lanes), dtype=kind)
        state[0] = h.T
        gates, some = np.empty((steps, 4 * k, lanes), dtype=kind), np.empty((k, lanes), dtype=kind)
        part = np.empty((2 * k, lanes), dtype=kind)
        for put, now, new, gate in zip(x, state, state[1:], gates, strict=False):
            n, both, r, hun = gate[:k], gate[k : 3 * k], gate[2 * k : 3 * k], gate[3 * k :]
            np.matmul(from_x, put.T, out=gate[: 3 * k])
            np.matmul(from_h[: 2 * k], now, out=part)
            np.matmul(from_h[2 * k :], now, out=hun)
            both += part
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)
            np.multiply(r, hun, out=some)
            n += some
            np.tanh(n, out=n)
            np.subtract(now, n, out=new)
            new *= gate[k : 2 * k]
            new += n

        told = targets.T.ravel()
        real = np.flatnonzero(told >= 0)
        by_lane = np.ascontiguousarray(state.transpose(0, 2, 1))
        _, dhs = self.log_probs(by_lane[1:].reshape(-1, k), told[real], grads, 1 / max(len(real), 1), real)
        dhs = np.ascontiguousarray(dhs.reshape(steps, lanes, k).transpose(0, 2, 1))

        dx, d = np.empty((steps, lanes, k), dtype=kind), np.empty((4 * k, lanes), dtype=kind)
        dn, dz, dr, dhun = (d[i * k : (i + 1) * k] for i in range(4))
        by_x, by_h = np.zeros_like(from_x), np.zeros_like(from_h)
        rest, back = np.empty_like(some), np.empty_like(some)
        for t in range(steps - 1, -1, -1):
            now, gate, dh = state[t], gates[t], dhs[t]
            n, z, r, hun = gate[:k], gate[k : 2 * k], gate[2 * k : 3 * k], gate[3 * k :]
            # By n: dh (1 - z) (1 - n n); by z: dh (before - n) z (1 - z).
            np.subtract(1, z, out=rest)
            rest *= dh
            np.multiply(n, n, out=some)
            np.subtract(1, some, out=some)
            np.multiply(rest, some, out=dn)
            np.subtract(now, n, out=dz)
            dz *= z
            dz *= rest
            # By the state's part: dn r; by r: dn hun r (1 - r).
            np.multiply(dn, r, out=dhun)
            np.subtract(1, r, out=dr)
            dr *= hun
            dr *= dhun
            np.matmul(d[: 3 * k].T, to_x, out=dx[t])
            by_x += d[: 3 * k] @ x[t]
            by_h += d[k:] @ by_lane[t]
            if t:
                dh *= z
                dh += np.matmul(p["u"], d[k:], out=back)
                dhs[t - 1] += dh
        by_x = np.roll(by_x.T, -k, axis=1)
        grads["wx"] += by_x[:k]
        grads["b"] += by_x[k]
        grads["u"] += by_h.T
        # One flat sum by place is many times faster than one by rows, and pairs of numbers
        # (complex ones, to numpy) take half the places.
        pair = np.result_type(kind, np.complex64)
        places = (given[:, None] * (k // 2) + np.arange(k // 2)).ravel()
        np.add.at(grads["embed"].reshape(-1).view(pair), places, dx.reshape(-1).view(pair))
        return grads, np.ascontiguousarray(state[steps].T)


#: States whose words are scored at once.
_CELLS = 32_768
#: Rows whose class shares are held at once: products of this size stay in a core's cache.
_ROWS = 240
#: Weights changed at once, for the same reason.
_STRIP = 16_384
#: Exponents up to this size neither overflow nor vanish in single precision.
_SAFE = 70.0


class _Adam:
    """Steps over all weights as one vector."""

    def __init__(self, flat: np.ndarray) -> None:
        self.m, self.v = np.zeros_like(flat), np.zeros_like(flat)
        self.t = 0

    def apply(self, flat: np.ndarray, grads: np.ndarray) -> None:
        self.t += 1
        norm = math.sqrt(float(grads @ grads))
        clip = min(1.0, 1.0 / max(norm, 1e-9))
        rate = np.float32(RATE * math.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t))
        for at in range(0, len(flat), _STRIP):
            m, v = self.m[at : at + _STRIP], self.v[at : at + _STRIP]
            # A tenth of the gradient, and a hundredth of its square.
            some = grads[at : at + _STRIP] * np.float32(clip * 0.1)
            m *= np.float32(0.9)
            m += some
            some *= some
            v *= np.float32(0.99)
            v += some
            np.sqrt(v, out=some)
            some += np.float32(1e-6)
            np.divide(m, some, out=some)
            some *= rate
            flat[at : at + _STRIP] -= some


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in Network.SHAPES])


def _views(flat: np.ndarray, shapes: dict[str, tuple[int, ...]]) -> dict[str, np.ndarray]:
    """The weights by name, as parts of one vector."""
    out, at = {}, 0
    for k in Network.SHAPES:
        n = math.prod(shapes[k])
        out[k], at = flat[at : at + n].reshape(shapes[k]), at + n
    return out


def _train_part(network: Network, docs: Iterator[tuple[int, bytes]], own_words: list[bytes], part: int) -> int:
    """Train on the runs of this round of texts; tokens seen."""
    places, own = dict(zip(own_words, range(len(own_words)), strict=True)), len(own_words)
    token = lambda w: places[w] if w in places else own + tail_class(w)
    return _train_tokens(network, ((h, np.array([token(w) for w in [*words_of(t), END]])) for h, t in docs), part)


def _train_tokens(network: Network, docs: Iterator[tuple[int, np.ndarray]], part: int) -> int:
    """Train on the runs of this round of documents given as tokens; tokens seen."""
    shapes = {k: network.p[k].shape for k in Network.SHAPES}
    flat = _flat(network.p)
    network.p, slopes = _views(flat, shapes), np.zeros_like(flat)
    grads, adam, seen = _views(slopes, shapes), _Adam(flat), 0
    run = WINDOW * RUN_WINDOWS
    tokens = np.empty((BATCH, run), dtype=np.int64)
    targets = np.empty((BATCH, run), dtype=np.int64)
    lengths = np.zeros(BATCH, dtype=np.int64)
    held = 0

    def learn() -> None:
        nonlocal seen, held
        # The longest runs first, so that those with nothing left can be left out.
        order = np.argsort(-lengths[:held], kind="stable")
        before, after = tokens[order], targets[order]
        h = np.zeros((held, HIDDEN), dtype=np.float32)
        for at in range(0, run, WINDOW):
            n = int((lengths[:held] > at).sum())
            if n:
                window = after[:n, at : at + WINDOW]
                _, h = network.train_window(before[:n, at : at + WINDOW], window, h[:n], grads)
                adam.apply(flat, slopes)
                seen += int((window >= 0).sum())
        held = 0

    for place, ids in docs:
        first = (place + part * (RUN_STRIDE // ROUNDS)) % RUN_STRIDE
        for at in range(first * run, len(ids), run * RUN_STRIDE):
            some = ids[at : at + run]
            n = len(some)
            tokens[held, 0] = ids[at - 1] if at else network.start_token
            tokens[held, 1:n], targets[held, :n] = some[:-1], some
            tokens[held, n:], targets[held, n:] = network.start_token, -1
            lengths[held] = n
            held += 1
            if held == BATCH:
                learn()
    if held:
        learn()
    return seen


#: Weights travel in slices of this many numbers, so averaging is a grouping of slices.
_SLICE = 8_192


def train(training: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after ROUNDS rounds of local training and averaging; `training` has id_hash, ids."""
    fresh = Network.fresh(vocabulary)
    own_class, flat = vocabulary.class_of_own, _flat(fresh.p)
    shapes = {k: fresh.p[k].shape for k in Network.SHAPES}
    context = training.sparkSession.sparkContext

    for part in range(ROUNDS):
        sent = context.broadcast(flat)

        def work(batches: Iterator[pa.RecordBatch], part: int = part, sent=sent) -> Iterator[pa.RecordBatch]:
            network = Network(own_class, _views(sent.value, shapes))
            docs = (row for b in batches for row in zip(b.column(0).to_pylist(), _tokens(b.column(1)), strict=True))
            seen = _train_tokens(network, docs, part)
            if seen:
                values = _flat(network.p)
                for at in range(0, len(values), _SLICE):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([at // _SLICE]), pa.array([float(seen)]),
                         pa.array([values[at : at + _SLICE].astype("<f4").tobytes()])],
                        names=["slice", "seen", "weights"],
                    )

        def average(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            share = rows["seen"].to_numpy() / rows["seen"].sum()
            mean = sum(s * np.frombuffer(w, dtype="<f4").astype(np.float64) for s, w in zip(share, rows["weights"], strict=True))
            return pd.DataFrame({"slice": [key[0]], "weights": [mean.astype("<f4").tobytes()]})

        local = arrow_map(training.select("id_hash", "ids"), work, "slice long, seen double, weights binary")
        means = local.groupBy("slice").applyInPandas(average, "slice long, weights binary").orderBy("slice").collect()
        if means:
            flat = np.concatenate([np.frombuffer(m["weights"], dtype="<f4") for m in means])
    return _views(flat, shapes)


def score_lanes(network: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log of class and inner shares of each document, the state carried to its end.

    Documents are laid one after the other on lanes; a lane's state starts anew with each.
    """
    sums = np.zeros(len(docs))
    if not docs:
        return sums
    lengths = np.array([len(d) for d in docs])
    lanes = min(LANES, len(docs))
    load, on = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
    for i in np.argsort(-lengths, kind="stable"):
        lane = int(load.argmin())
        on[lane].append(i)
        load[lane] += lengths[i]
    # Step by step, then lane by lane in order of falling load: the lanes in use come first.
    order = np.argsort(-load, kind="stable")
    steps = int(load.max())
    active = lanes - np.searchsorted(load[order][::-1], np.arange(steps), side="right")
    offset = np.concatenate([[0], active.cumsum()])
    target = np.empty(offset[-1], dtype=np.int64)
    before, owner = np.empty_like(target), np.empty_like(target)
    begins: dict[int, list[int]] = {}
    for row, lane in enumerate(order):
        at = 0
        for i in on[lane]:
            cells = offset[at : at + lengths[i]] + row
            target[cells], owner[cells] = docs[i], i
            before[cells[0]], before[cells[1:]] = network.start_token, docs[i][:-1]
            begins.setdefault(at, []).append(row)
            at += lengths[i]
    inputs, h = network.inputs(), np.zeros((lanes, HIDDEN), dtype=np.float32)
    cells, first = offset.tolist(), 0
    states: list[np.ndarray] = []
    for t in range(steps):
        lo, hi = cells[t], cells[t + 1]
        h = h[: hi - lo]
        if t in begins:
            h = h.copy()
            h[begins[t]] = 0
        h = network.step(inputs.take(before[lo:hi], axis=0), h)
        states.append(h)
        if hi - first >= _CELLS or t == steps - 1:
            logs, _ = network.log_probs(np.concatenate(states), target[first:hi])
            sums += np.bincount(owner[first:hi], weights=logs, minlength=len(docs))
            first, states = hi, []
    return sums


_TOKENS = (
    "key long, doc_id long, held boolean, id_hash long, n_tokens long, n_known long, base double, model double, "
    "ids binary, words array<binary>, times array<long>"
)
_DOCUMENT = ("key", "doc_id", "held", "n_tokens", "n_known", "base", "model")


def _tokens(ids: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(i, dtype="<u2") for i in ids.to_pylist()]


def tokenised(source: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row per document: its tokens as 16-bit numbers, what the head of the vocabulary
    tells of its scores, and its words outside the head with how often each occurs."""
    sent = source.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        head = pa.array(known.words, type=pa.binary())
        own, key = known.own, TaskContext.get().partitionId() << 40
        head_tail = _tail_classes(head)
        tail_log, log_count = np.log10(known.tail_sums), np.log10(known.counts + 0.5)
        # By place in the head; the last entry stands for words outside, whose place is -1.
        token_of = np.append(np.where(np.arange(len(head)) < own, np.arange(len(head)), own + head_tail), 0)
        base_of = np.append(log_count, 0.0)
        model_of = np.append(np.where(np.arange(len(head)) < own, 0.0, log_count - tail_log[head_tail]), 0.0)
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        for batch in _gathered(batches):
            n = batch.num_rows
            words, codes, sizes = coded_words(batch.column("text"))
            at = pc.fill_null(pc.index_in(words, value_set=head), -1).to_numpy().astype(np.int64)
            outside = np.flatnonzero(at < 0)
            tails = _tail_classes(words.take(pa.array(outside)))
            token, model = token_of[at], model_of[at]
            token[outside], model[outside] = own + tails, -tail_log[tails]
            ends = sizes.cumsum()
            sums = [np.add.reduceat(v[codes], ends - sizes) for v in ((at >= 0).astype(np.int64), base_of[at], model)]
            ids = token.astype("<u2")[codes]
            # One row per document and word outside the head, in the order of the documents.
            rare = np.flatnonzero(at[codes] < 0)
            pairs = np.repeat(np.arange(n), sizes)[rare] * len(words) + codes[rare]
            pairs, times = np.unique(pairs, return_counts=True)
            bounds = pa.array(np.searchsorted(pairs, np.arange(n + 1) * len(words)), type=pa.int32())
            starts = pa.py_buffer(np.append(0, ends * 2).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key + np.arange(n)), *(batch.column(c) for c in ("doc_id", "held", "id_hash")),
                 pa.array(sizes), *map(pa.array, sums),
                 pa.Array.from_buffers(pa.binary(), n, [None, starts, pa.py_buffer(ids)]),
                 pa.ListArray.from_arrays(bounds, words.take(pa.array(pairs % len(words)))),
                 pa.ListArray.from_arrays(bounds, pa.array(times))],
                names=names,
            )
            key += n

    doc_id = F.col("doc_id")
    ready = source.select(doc_id.cast("long"), held_out(doc_id).alias("held"), id_hash(doc_id).alias("id_hash"), "text")
    return arrow_map(ready, work, _TOKENS)


def _modelled(tokens: DataFrame, vocabulary: Vocabulary, weights: dict[str, np.ndarray]) -> DataFrame:
    """The documents' own columns, with the network's part added to `model`."""
    sent = tokens.sparkSession.sparkContext.broadcast((vocabulary.class_of_own, weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(*sent.value)
        held: list[pa.RecordBatch] = []
        docs: list[np.ndarray] = []
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            logs, at = score_lanes(network, docs) / _LN10, 0
            for batch in held:
                model = batch.column("model").to_numpy() + logs[at : at + batch.num_rows]
                at += batch.num_rows
                yield batch.set_column(batch.schema.get_field_index("model"), "model", pa.array(model))

        for batch in batches:
            held.append(batch.select(list(_DOCUMENT)))
            docs += _tokens(batch.column("ids"))
            count += sum(map(len, docs[-batch.num_rows :]))
            if count >= ROUND_TOKENS:
                yield from out()
                held, docs, count = [], [], 0
        yield from out()

    kept = tokens.select(*_DOCUMENT, "ids")
    return arrow_map(kept, work, ", ".join(f for f in _TOKENS.split(", ") if f.split()[0] in _DOCUMENT))


def score(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    source = _source(documents, doc_id, text)
    counts = handed_over(word_counts(source.where(~held_out(F.col("doc_id")))), "word-counts")
    known = vocabulary(counts)
    # Nearly every value is another one, so dictionaries of them would be given up anyway.
    tokens = handed_over(tokenised(source, known), "tokens", **{"parquet.enable.dictionary": "false"})
    own = _modelled(tokens, known, train(tokens.where(~F.col("held")), known))
    # Counts of words in the head are known to the tasks; an absent count is zero.
    rare = tokens.select("key", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times")).join(counts, "word", "left")
    rare = rare.groupBy("key").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
    )
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    whole = math.log10(known.total + 0.5 * (known.distinct + 1))
    return own.join(rare, "key", "left").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare_log - F.col("n_tokens") * whole).alias("base_score"), (F.col("model") + rare_log).alias("score"),
    )
