"""Language-model scoring with a causal self-attention model over subword ids.

Words are counted over all learning documents (the base score).  The model
reads the subword ids of the words, in overlapping windows: a block of STEP
positions is scored together, each position attending, under a causal mask, to
itself, to what precedes it in the block and to the whole block before; so
every id is scored once and has at least STEP ids of context (or all there
are).  One attention layer with learned distances, the rows of the own and the
preceding id beside it, a rectifier and a softmax over classes of ids; an id's
share of its class is its count over all learning documents.

The model is trained in numpy: learners (tasks) each take gradient steps over
their share of the documents, some runs of RUN consecutive blocks at a time in
random order, and after every pass Spark averages their weights, sixteen at a
time.  The last pass goes over every learning document;
those before it, which bring the weights near where learners may part, over
``share`` of them, at least ``least_words`` words.  Word and subword counts,
and the neighbours that classes are made of, cover all.

Texts are read once: what training and scoring need of them (symbols, sums of
counts) is written.  Reading looks frequent words (at most HOT_WORDS, each at
most HOT_BYTES long) up in a broadcast table; every other word is joined with
the counts, so a word that is frequent only in documents scored does not gather
in one task more than adaptive execution lets it.

Defined results: null texts are empty; an empty text is its end alone; null
ids are never held out and keep their rows, as repeated rows do; an empty
table gives an empty result.  Texts over SEGMENT bytes are read in segments
cut at white space, each beginning with the ids before it as context; words
over LONG bytes are cut there for their subwords, and counted whole.  The end
stands for itself in counts and in the model.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, drop_written, written

#: Positions scored together, which is also the least context; widths.
STEP = 16
WIDTH = 16
#: Input symbols: padding, end, then ids by count; the last stands for the rest.
SYMBOLS = 4096
PAD, END = 0, 1
#: Classes of the softmax: the end, the most frequent ids, clusters of others.
HEAD, CLUSTERS = 64, 47
CLASSES = 1 + HEAD + CLUSTERS
#: Training: passes, blocks of a gradient step, rate, words of a learner.
PASSES, BATCH, RATE, LEARNER_WORDS = 3, 48, 0.3, 1_000_000
#: Consecutive blocks that a gradient step takes together.
RUN = 8
SHARE, LEAST_WORDS = 1 / 128, 1_000_000
#: Words of the broadcast table and their length; of a word's pieces; of a segment.
HOT_WORDS, HOT_BYTES, LONG, SEGMENT = 1 << 18, 32, 64, 1 << 20
#: Words whose pieces are remembered; blocks scored together; bytes of texts
#: counted together and read together (a text at least).
FLUSH, BLOCKS, COUNTED, READ = 1 << 17, 64, 1 << 23, 1 << 22
#: The key under which ends are counted; no word holds a space.
END_WORD = b" "
SPACE = re.compile(rb"[\x20\x09-\x0D]")
MASKED = -1e4


def words_of(text: str | None) -> list[bytes]:
    """Words of the ASCII-lower-cased text (bytes.split splits at x20, x09-x0D)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def segments(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, by segments; one empty segment if there are none."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while len(data) - at > SEGMENT:
        cut = SPACE.search(data, at + SEGMENT)
        if cut is None:
            break
        yield data[at:cut.start()].split()
        at = cut.end()
    yield data[at:].split()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as :func:`words_of` has them, and where each
    text's begin (one more)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, starts = lists.values.cast(pa.binary()), lists.offsets.to_numpy().astype(np.int64)
    real = np.diff(np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)) > 0 if len(words) else np.zeros(0, bool)
    if not real.all():  # white space at a text's ends leaves empty ones
        words, starts = words.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[starts]
    return words, starts


class Pieces:
    """Subword ids of words, by the byte-level merges of a rank table; what it
    remembers is bounded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.encoder, self.joined, self.known = None, None, {}

    def __getstate__(self) -> tuple:
        return self.ranks, self.pattern

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def __call__(self, word: bytes) -> list[int]:
        out = self.known.get(word)
        if out is None:
            if self.encoder is None:
                self.encoder = tiktoken.Encoding("pieces", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
            spaced = b" " + word
            parts = [spaced] if len(spaced) <= LONG else [spaced[at:at + LONG] for at in range(0, len(spaced), LONG)]
            out = list(chain.from_iterable(map(self.encoder._encode_single_piece, parts)))
            if len(self.known) >= FLUSH:
                self.known = {}
            if len(word) <= LONG:
                self.known[word] = out
        return out

    def flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words that are not cut, and where each word's begin: its
        first id alone holds a space."""
        if self.joined is None:
            # Of words joined by spaces: each with the space before it.
            self.joined = tiktoken.Encoding("words", pat_str=" [^ ]+", mergeable_ranks=self.ranks, special_tokens={})
            self.first = np.zeros(max(self.ranks.values()) + 1, bool)
            self.first[[i for piece, i in self.ranks.items() if piece.startswith(b" ")]] = True
        text = b" ".join([b"", *words]).decode("utf-8", "surrogatepass")
        ids = np.array(self.joined.encode_ordinary(text), dtype=np.int32)
        return ids, np.flatnonzero(self.first[ids])


def flat_pieces(words: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """All subword ids of the words, and where each word's begin (one more)."""
    long = [i for i, w in enumerate(words) if len(w) >= LONG]
    ids, starts = pieces.flat([w for w in words if len(w) < LONG] if long else words)
    if not long:
        return ids, np.append(starts, len(ids))
    # Those that are cut go in at their places.
    cut = [pieces(words[i]) for i in long]
    before = np.append(starts, len(ids))[np.array(long) - np.arange(len(long))]
    sizes = np.insert(np.diff(starts, append=len(ids)), np.array(long) - np.arange(len(long)), [len(c) for c in cut])
    ids = np.insert(ids, np.repeat(before, [len(c) for c in cut]), list(chain.from_iterable(cut)))
    return ids.astype(np.int32), np.concatenate([[0], np.cumsum(sizes)])


class Layout:
    """Symbols of many segments as rows of blocks: one block of context
    (padding, or the symbols before the segment), then the segment's inputs
    (the end as the text's beginning, then its symbols) and, at each input, the
    symbol that follows (PAD: none)."""

    def __init__(self, symbols: list[np.ndarray], first: list[bool], last: list[bool]):
        sizes = [len(i) + bool(z) for i, z in zip(symbols, last, strict=True)]  # targets
        blocks = np.array([1 + -(-n // STEP) for n in sizes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(blocks)])[:-1]
        n = int(blocks.sum()) * STEP
        self.inputs, self.targets = np.full(n, PAD, "<u2"), np.full(n, PAD, "<u2")
        begin = np.array([PAD] * STEP + [END], "<u2")
        before = begin
        for at, own, is_first, is_last in zip((self.starts * STEP).tolist(), symbols, first, last, strict=True):
            line = np.concatenate([begin if is_first else before, own])
            body = at + STEP + len(own) + bool(is_last)
            self.inputs[at:body] = line[:body - at]
            self.targets[at + STEP:at + STEP + len(own)] = own
            if is_last:
                self.targets[body - 1] = END
            before = line[-STEP - 1:]

    def runs(self, of_symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The blocks as runs of RUN, each behind the block before it, and the
        classes at their targets (-1: none); an empty run more at the end."""
        n = -(-len(self.inputs) // (STEP * RUN)) + 1
        x, y = np.full((n * RUN + 1) * STEP, PAD, "<u2"), np.full(n * RUN * STEP, -1, np.int32)
        x[STEP:STEP + len(self.inputs)] = self.inputs
        y[:len(self.targets)] = np.where(self.targets == PAD, -1, of_symbol[self.targets])
        pairs = np.lib.stride_tricks.as_strided(x, (n, (RUN + 1) * STEP), (RUN * STEP * x.itemsize, x.itemsize))
        return pairs, y.reshape(n, -1)

    @classmethod
    def of(cls, rows: list[list[bytes]]) -> Layout:
        """Of the ``symbols`` of rows that :func:`read` wrote."""
        return cls([np.frombuffer(part, "<u2") for row in rows for part in row],
                   [i == 0 for row in rows for i in range(len(row))],
                   [i == len(row) - 1 for row in rows for i in range(len(row))])


class Alphabet:
    """Symbols and classes of subword ids, from their counts over the corpus
    and the neighbours they have in it."""

    def __init__(self, counts: np.ndarray, ends: int):
        self.order = np.lexsort((np.arange(len(counts)), -counts))
        # One more place for the id -2 (end) and -1 (padding), at the end of the arrays.
        self.symbol = np.full(len(counts) + 2, SYMBOLS - 1, "<u2")
        room = min(len(counts), SYMBOLS - 3)
        self.symbol[self.order[:room]] = np.arange(2, 2 + room)
        self.symbol[-1], self.symbol[-2] = PAD, END
        # How often an id stands, the end and padding last; its log.
        self.n = np.concatenate([counts, [ends, 0]]) + 0.5
        self.n[-1] = 0
        self.logs = np.log(np.maximum(self.n, 0.5))
        self.classes(np.zeros((SYMBOLS, 2 * (HEAD + 2)), np.float32))

    def neighbours(self, layout: Layout) -> np.ndarray:
        """How often each symbol follows and precedes each of the head."""
        x = layout.inputs.astype(np.int64)
        a, b = x[:-1], np.minimum(x[1:], HEAD + 1)
        wide = HEAD + 2
        after = np.bincount(a * 2 * wide + b, minlength=SYMBOLS * 2 * wide)
        before = np.bincount(x[1:] * 2 * wide + wide + np.minimum(x[:-1], HEAD + 1), minlength=SYMBOLS * 2 * wide)
        return (after + before).reshape(SYMBOLS, 2 * wide).astype(np.float32)

    def classes(self, near: np.ndarray) -> None:
        """Class of every id, and the log of its share of the class."""
        of_symbol = np.full(SYMBOLS, CLASSES - 1, np.int32)
        of_symbol[END], of_symbol[2:2 + HEAD] = 0, np.arange(1, 1 + HEAD)
        rest = np.arange(2 + HEAD, SYMBOLS - 1)
        rest = rest[near[rest].sum(axis=1) > 0]
        if len(rest) > CLUSTERS:
            x = np.sqrt(near[rest] / near[rest].sum(axis=1, keepdims=True))
            weight = np.log1p(near[rest].sum(axis=1))
            centre = x[:CLUSTERS - 1].copy()
            for _ in range(12):
                own = np.argmax(x @ centre.T / np.maximum(np.linalg.norm(centre, axis=1), 1e-9), axis=1)
                for c in np.unique(own):
                    centre[c] = np.average(x[own == c], axis=0, weights=weight[own == c])
            of_symbol[rest] = 1 + HEAD + own
        self.of_symbol, self.target = of_symbol, of_symbol[self.symbol]
        total = np.bincount(self.target[:-1], weights=self.n[:-1], minlength=CLASSES)
        self.log_total = np.log(np.maximum(total, 0.5))
        self.share = self.logs - self.log_total[self.target]
        self.share[-1] = 0.0


#: Columns of a symbol's row: query, key, value, own, previous.
Q, K, V, OWN, PREVIOUS = (slice(i * WIDTH, (i + 1) * WIDTH) for i in range(5))


class Weights:
    """One row a symbol, the distances, and the class layer, with the sums of
    squared gradients that set the step of each."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = (rng.standard_normal((SYMBOLS, 5 * WIDTH)) * 0.1).astype(np.float32)
        self.distance = np.zeros(2 * STEP, np.float32)
        self.layer = (rng.standard_normal((WIDTH, CLASSES)) * 0.1).astype(np.float32)
        self.bias = np.zeros(CLASSES, np.float32)
        self.squares = [np.full(x.shape, 1e-3, np.float32) for x in self.arrays()]
        # The last place of queries and keys masks padding.
        self.rows[:, Q.stop - 1], self.rows[:, K.stop - 1] = 1.0, 0.0
        self.rows[PAD, K.stop - 1] = MASKED

    def arrays(self) -> list[np.ndarray]:
        return [self.rows, self.distance, self.layer, self.bias]

    def packed(self) -> bytes:
        return b"".join(x.astype("<f4").tobytes() for x in [*self.arrays(), *self.squares])

    @classmethod
    def unpacked(cls, data: bytes) -> Weights:
        out, flat = cls(), np.frombuffer(data, "<f4")
        at = 0
        for x in [*out.arrays(), *out.squares]:
            x[...] = flat[at:at + x.size].reshape(x.shape)
            at += x.size
        return out

    def mask(self) -> np.ndarray:
        """What is added to the scores of a block: its distances; the future is masked."""
        return np.where(APART >= 0, self.distance[np.clip(APART, 0, None)], np.float32(MASKED)).astype(np.float32)


SCALE = np.float32(WIDTH**-0.5)
ONES = np.ones(max(CLASSES, BLOCKS * STEP), np.float32)
#: How far a place of a block stands behind each of its pair of blocks; where
#: that is not negative (flat), and how far there.
APART = np.arange(STEP)[:, None] + STEP - np.arange(2 * STEP)[None, :]
SEEN = np.flatnonzero(APART >= 0)
BACK = APART.ravel()[SEEN]
DISTANCE = np.where(APART >= 0, APART, 2 * STEP)


def summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows (a multiple of STEP).  In order
    of id, STEP rows at a time are summed by a small product; the few ids that
    then have several sums get the rest added, columns in pairs (as complex
    numbers), since reduceat's time goes by ids and columns."""
    order = np.argsort(ids, kind="stable")
    some = ids[order]
    new = np.ones(len(ids), bool)
    np.not_equal(some[1:], some[:-1], out=new[1:])
    new[::STEP] = True
    start, place = np.flatnonzero(new), np.cumsum(new).reshape(-1, STEP)
    place += np.arange(0, len(ids), STEP)[:, None] - place[:, :1]
    which = np.zeros((len(place), STEP, STEP), np.float32)
    which.reshape(-1)[place * STEP + np.arange(STEP)] = 1
    sums = np.matmul(which, rows.take(order, axis=0).reshape(len(place), STEP, -1)).reshape(rows.shape)
    place, some = place.reshape(-1)[start], some[start]
    new = np.ones(len(some), bool)
    np.not_equal(some[1:], some[:-1], out=new[1:])
    first, rest = np.flatnonzero(new), np.flatnonzero(~new)
    out = sums.take(place[first], axis=0)
    if len(rest):
        of = np.cumsum(new)[rest] - 1
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        out[of[cut]] += np.add.reduceat(sums.take(place[rest], axis=0).view(np.complex64), cut, axis=0).view(np.float32)
    return some[first], out


def attended(q: np.ndarray, k: np.ndarray, mask: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Unscaled attention of queries to keys, into ``out``."""
    np.matmul(q, k.swapaxes(-1, -2), out=out)
    out += mask
    if out.max() > 60.0:
        np.minimum(out, 60.0, out=out)
    return np.exp(out, out=out)


def weighed(h: np.ndarray, layer: np.ndarray, factor: np.ndarray, places: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unscaled weights of the classes, their factors apart, into ``out``;
    returns the exponents at some (flat) places and the sums with factors.  A
    row's largest exponent is taken off only where sums would leave the range."""
    np.matmul(h, layer, out=out)
    if out.max() <= 80.0:
        told = out.reshape(-1).take(places)
        total = np.exp(out, out=out) @ factor
        if total.min() > 1e-30:
            return told, total
        np.matmul(h, layer, out=out)
    out -= out.max(axis=1, keepdims=True)
    told = out.reshape(-1).take(places)
    return told, np.exp(out, out=out) @ factor


class Learner:
    """Gradient steps of some runs of consecutive blocks each, over buffers
    that are made once.  A run's rows are read once, after those of the block
    before it; attention's pairs of blocks are views of them.  What lies by
    query and key (weights, their gradients) keeps STEP places between blocks:
    so the queries that see a block's keys, its own and the next block's, are
    a view as well.  While it steps, ``w`` holds its queries scaled."""

    def __init__(self, w: Weights, runs: int, length: int):
        self.w, self.runs, self.length = w, runs, length
        self.scale(SCALE)
        view, n = np.lib.stride_tricks.as_strided, runs * length * STEP
        # A block more: the last run's last keys are seen by nothing behind it.
        room = np.zeros((runs * (length + 1) + 1, STEP, 5 * WIDTH), np.float32)
        self.near = room[:-1].reshape(runs, (length + 1) * STEP, 5 * WIDTH)
        self.steps = np.zeros_like(self.near)
        line, row, one = self.near.strides
        pairs = lambda part, count, first: view(room[first, :, part], (runs, count, 2 * STEP, WIDTH), (line, STEP * row, row, one))
        self.q, self.k, self.v = pairs(Q, length, 1)[:, :, :STEP], pairs(K, length, 0), pairs(V, length, 0)
        self.q_seeing, self.by_block = pairs(Q, length + 1, 0), self.steps.reshape(runs, length + 1, STEP, 5 * WIDTH)
        # Zeros before and after each run's own.
        dz = np.zeros((runs, length + 2, STEP, WIDTH), np.float32)
        line, block, row, one = dz.strides
        self.dz, self.dz_seeing = dz[:, 1:-1], view(dz, (runs, length + 1, 2 * STEP, WIDTH), (line, block, row, one))
        by_pair = np.zeros((2, runs, length + 2, STEP * 2 * STEP + STEP), np.float32)
        line, block, one = by_pair.strides[1:]
        self.a, self.ds = (view(x[:, 1:], (runs, length, STEP, 2 * STEP), (line, block, 2 * STEP * one, one)) for x in by_pair)
        self.a_seen, self.ds_seen = (view(x[:, :, STEP:], (runs, length + 1, STEP, 2 * STEP), (line, block, one, 2 * STEP * one)) for x in by_pair)
        self.z, self.h, self.seen = np.empty((3, runs, length, STEP, WIDTH), np.float32)
        self.p, self.begin = np.empty((n, CLASSES), np.float32), np.arange(n) * CLASSES
        self.mask = np.full(2 * STEP + 1, MASKED, np.float32)
        # The distances, the layer and the bias in one piece, and so their squares.
        self.small = np.concatenate([x.ravel() for x in w.arrays()[1:]])
        self.squares = np.concatenate([x.ravel() for x in w.squares[1:]])
        self.d_small = np.zeros_like(self.small)
        cuts = np.cumsum([2 * STEP, WIDTH * CLASSES])
        parts = lambda x: [y.reshape(z.shape) for y, z in zip(np.split(x, cuts), w.arrays()[1:], strict=True)]
        (w.distance, w.layer, w.bias), self.d_parts = parts(self.small), parts(self.d_small)
        w.squares[1:] = parts(self.squares)
        self.last = None

    def scale(self, by: float) -> None:
        self.w.rows[:, Q.start:Q.stop - 1] *= by

    def done(self) -> Weights:
        self.scale(1 / SCALE)
        return self.w

    def loss(self) -> float:
        """The mean loss of the last step, before it."""
        if self.last is None:
            return 0.0
        told, right, total = self.last
        return float(-np.log(np.maximum((right / total)[told], 1e-30)).mean())

    def __call__(self, x: np.ndarray, y: np.ndarray, rate: float = RATE) -> None:
        """One step on all runs' symbols ``x`` (the block before them first)
        and classes ``y`` (-1: none)."""
        w, z, a, ds, h, dz, near, steps = self.w, self.z, self.a, self.ds, self.h, self.dz, self.near, self.steps
        x, y = x.ravel(), y.ravel()
        told = y >= 0
        n = np.count_nonzero(told)
        if not n:
            return
        np.take(w.rows, x, axis=0, out=near.reshape(-1, 5 * WIDTH), mode="clip")
        self.mask[:-1] = w.distance
        # The weights stay unscaled; what they give and get is scaled.
        part_a = 1 / np.maximum(np.matmul(attended(self.q, self.k, self.mask[DISTANCE], a), ONES[:2 * STEP, None]), 1e-30)
        np.matmul(a, self.v, out=z)
        z *= part_a
        flat_h = h.reshape(self.runs, -1, WIDTH)
        np.add(z.reshape(flat_h.shape), near[:, STEP:, OWN], out=flat_h)
        flat_h += near[:, STEP - 1:-1, PREVIOUS]
        np.maximum(h, 0, out=h)
        # The bias is a factor of a class; it goes into the small arrays.
        p, factor, places = self.p, np.exp(w.bias), self.begin + np.maximum(y, 0)
        right, total = weighed(h.reshape(-1, WIDTH), w.layer, factor, places, p)
        right, times = np.exp(right), factor.take(y, mode="wrap")
        self.last = told, right * times, total
        # From here a class's share, less the one that stands there, is p * factor * part.
        p.reshape(-1)[places] = right - total / times
        part = told * np.float32(1 / n) / total
        by_place = part.reshape(self.runs, self.length, STEP, 1)
        np.matmul(p, (w.layer * factor).T, out=self.seen.reshape(-1, WIDTH))
        own = steps[:, STEP:, OWN]
        np.multiply(self.seen, by_place, out=self.seen)
        self.seen *= h > 0
        own[...] = self.seen.reshape(own.shape)
        steps[:, STEP - 1:-1, PREVIOUS] = own
        np.multiply(self.seen, part_a, out=dz)
        h *= by_place
        d_distance, d_layer, d_bias = self.d_parts
        # In pieces: a product of few rows and columns over many places is slow.
        np.matmul(h.reshape(self.runs, -1, WIDTH).swapaxes(1, 2), p.reshape(self.runs, -1, CLASSES)).sum(axis=0, out=d_layer)
        d_layer *= factor
        np.multiply(part @ p, factor, out=d_bias)
        np.matmul(dz, self.v.swapaxes(2, 3), out=ds)
        np.multiply(dz, z, out=z)
        ds -= (z.reshape(-1, WIDTH) @ ONES[:WIDTH]).reshape(by_place.shape)
        ds *= a
        np.matmul(ds, self.k, out=self.by_block[:, 1:, :, Q])
        np.matmul(self.ds_seen, self.q_seeing, out=self.by_block[..., K])
        np.matmul(self.a_seen, self.dz_seeing, out=self.by_block[..., V])
        d_distance[:] = np.bincount(BACK, weights=ds.sum(axis=(0, 1)).ravel()[SEEN], minlength=2 * STEP)
        ids, d_rows = summed(x, steps.reshape(-1, 5 * WIDTH))
        d_rows[:, Q] *= SCALE
        d_rows[:, Q.stop - 1] = d_rows[:, K.stop - 1] = 0
        squares = w.squares[0].take(ids, axis=0)
        squares += d_rows * d_rows
        w.squares[0][ids] = squares
        d_rows *= rate
        d_rows /= np.sqrt(squares, out=squares)
        d_rows[:, Q] *= SCALE
        w.rows[ids] = np.subtract(w.rows.take(ids, axis=0), d_rows, out=d_rows)
        self.squares += self.d_small * self.d_small
        self.small -= rate * self.d_small / np.sqrt(self.squares)


def gradient_step(w: Weights, inputs: np.ndarray, targets: np.ndarray, blocks: np.ndarray, rate: float = RATE) -> float:
    """One step on single blocks (rows of ``inputs`` symbols, ``targets``
    classes, -1 for none); returns the mean loss."""
    step = Learner(w, len(blocks), 1)
    step(np.concatenate([inputs[blocks - 1], inputs[blocks]], axis=1), targets[blocks], rate)
    step.done()
    return step.loss()


class Scorer:
    """Log shares of the classes at every place of a layout, block by block,
    over buffers that are made once."""

    def __init__(self, w: Weights):
        self.rows, self.mask, self.layer, self.bias = w.rows.copy(), w.mask(), w.layer, w.bias
        self.rows[:, Q] *= SCALE
        self.rows[:, Q.stop - 1] = 1.0
        self.factor = np.exp(w.bias)
        self.near = np.empty(((BLOCKS + 1) * STEP, 5 * WIDTH), np.float32)
        self.s = np.empty((BLOCKS, STEP, 2 * STEP), np.float32)
        self.a = np.empty((BLOCKS, STEP, WIDTH), np.float32)
        self.p = np.empty((BLOCKS * STEP, CLASSES), np.float32)

    def __call__(self, symbols: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """``symbols`` and ``classes`` by place; the first block is context."""
        out = np.zeros(len(symbols), np.float64)
        begin, strided = np.arange(BLOCKS * STEP) * CLASSES, np.lib.stride_tricks.as_strided
        row, step = self.near.strides[1], self.near.strides[0]
        keys, values = (strided(self.near[:, part], (BLOCKS, 2 * STEP, WIDTH), (STEP * step, step, row)) for part in (K, V))
        for at in range(STEP, len(symbols), BLOCKS * STEP):
            n = min(BLOCKS * STEP, len(symbols) - at) // STEP
            near = np.take(self.rows, symbols[at - STEP:at + n * STEP], axis=0, out=self.near[:(n + 1) * STEP], mode="clip")
            s = attended(near[STEP:, Q].reshape(n, STEP, WIDTH), keys[:n], self.mask, self.s[:n])
            h = np.matmul(s, values[:n], out=self.a[:n]).reshape(-1, WIDTH)
            h /= np.maximum(s.reshape(-1, 2 * STEP) @ ONES[:2 * STEP, None], 1e-30)
            h += near[STEP:, OWN]
            h += near[STEP - 1:-1, PREVIOUS]
            np.maximum(h, 0, out=h)
            own = classes[at:at + n * STEP]
            told, total = weighed(h, self.layer, self.factor, begin[:n * STEP] + own, self.p[:n * STEP])
            out[at:at + n * STEP] = told + self.bias.take(own) - np.log(total)
        return out


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, c`` over all rows, written; ends are counted as END_WORD.  Each
    task counts COUNTED bytes of texts at a time and passes sums on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, COUNTED):
                seen = pc.value_counts(split_words(part.column(0))[0])
                yield pa.RecordBatch.from_arrays([seen.field(0), seen.field(1)], names=["word", "c"])
                yield pa.RecordBatch.from_arrays([pa.array([END_WORD]), pa.array([part.num_rows])], names=["word", "c"])

    partial = docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "word binary, c long")
    return written(partial.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")


class Counts:
    """The corpus counts: ``table(word, c)``, all tokens, distinct tokens, and
    the most frequent words: at most HOT_WORDS, all that reach ``enough``."""

    def __init__(self, table: DataFrame):
        self.table = table
        total = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = int(total["n"]), int(total["v"])
        ends = table.where(F.col("word") == F.lit(END_WORD)).first()
        self.ends = int(ends["c"]) if ends else 0
        # Counts by sixteenths of their octave: at most some thousand rows.
        short = table.where((F.octet_length("word") <= HOT_BYTES) & (F.col("word") != F.lit(END_WORD)))
        octave = F.floor(F.log2("c") * 16).cast("int").alias("octave")
        sizes = short.groupBy(octave).agg(F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("octave")).collect()
        self.enough, room = None, HOT_WORDS
        for row in sizes:
            room -= row["n"]
            if room < 0:
                break
            self.enough = row["least"]
        self.hot = [] if self.enough is None else [(bytes(r["word"]), int(r["c"])) for r in short.where(F.col("c") >= self.enough).toLocalIterator()]
        # Words that are looked up often lie together in memory.
        self.hot.sort(key=lambda pair: -pair[1])

    def log_share(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def count_pieces(words: DataFrame, pieces: Pieces) -> np.ndarray:
    """How often each subword id occurs in all counted words."""
    n = len(pieces.ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n, dtype=np.int64)
        for batch in batches:
            flat, starts = flat_pieces(batch.column(0).to_pylist(), pieces)
            seen += np.bincount(flat, weights=np.repeat(batch.column(1).to_numpy(), np.diff(starts)), minlength=n).astype(np.int64)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some], pa.int64())], names=["id", "n"])

    counts = np.zeros(n)
    for row in words.where(F.col("word") != F.lit(END_WORD)).mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def learned(sample: DataFrame, work, learners: int) -> tuple[int, list[np.ndarray]]:
    """What ``work(texts)`` of every partition of ``sample`` gives, a weight
    and float32 arrays in one piece, as weighted mean: sixteen at a time, so
    no task and not the driver holds more than sixteen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column(0).to_pylist()]
        weight, data = work(texts)
        yield pa.RecordBatch.from_arrays([pa.array([weight], pa.float64()), pa.array([data], pa.binary())], names=["weight", "data"])

    return averaged(sample.mapInArrow(run, "weight double, data binary"), learners)


def near(rows: DataFrame, alphabet: Alphabet) -> np.ndarray:
    """How often symbols stand beside those of the head (see
    :meth:`Alphabet.neighbours`), a document's mean over all ``symbols``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros((SYMBOLS, 2 * (HEAD + 2))), 0
        for batch in batches:
            for part in symbol_slices(batch):
                seen += alphabet.neighbours(Layout.of(part.column(0).to_pylist()))
                n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([(seen / n).astype("<f4").tobytes()], pa.binary())], names=["weight", "data"])

    return averaged(rows.mapInArrow(run, "weight double, data binary"), rows.rdd.getNumPartitions())[1].reshape(SYMBOLS, -1)


def averaged(parts: DataFrame, learners: int) -> tuple[int, np.ndarray]:
    """The weighted mean of the ``weight, data`` of so many tasks."""

    def mean(rows: pa.Table) -> pa.Table:
        weight = rows.column("weight").to_numpy()
        share = weight / max(weight.sum(), 1e-30)
        data = sum((np.frombuffer(d.as_py(), "<f4").astype(np.float64) * s for d, s in zip(rows.column("data"), share, strict=True) if s > 0), np.zeros(len(rows.column("data")[0].as_py()) // 4))
        return pa.table({"at": [rows.column("at")[0].as_py() // 16], "weight": [weight.sum()], "data": pa.array([data.astype("<f4").tobytes()], pa.binary())})

    now = parts.withColumn("at", F.spark_partition_id().cast("long"))
    while True:
        now = now.groupBy(F.floor(F.col("at") / 16).alias("of")).applyInArrow(mean, "at long, weight double, data binary")
        if learners <= 16:
            break
        now, learners = written(now, "lm-means"), -(-learners // 16)
    row = now.first()
    return row["weight"], np.frombuffer(row["data"], "<f4")


class Model:
    """What scoring needs: the pieces, the alphabet and the weights."""

    def __init__(self, pieces: Pieces, alphabet: Alphabet, weights: Weights):
        self.pieces, self.alphabet, self.weights = pieces, alphabet, weights


def untrained(counts: Counts, ranks: dict[bytes, int], pattern: str) -> Model:
    """A model with the symbols of the counted words and weights to begin with."""
    pieces = Pieces(ranks, pattern)
    return Model(pieces, Alphabet(count_pieces(counts.table, pieces), counts.ends), Weights())


class Reader:
    """What a table of frequent words says of texts."""

    def __init__(self, hot: pa.Array, flat: np.ndarray, starts: np.ndarray, word_logs: np.ndarray, shares: np.ndarray, pieces: Pieces, symbol: np.ndarray, logs: np.ndarray):
        self.hot, self.flat, self.starts, self.word_logs, self.shares, self.pieces, self.symbol, self.logs = hot, flat, starts, word_logs, shares, pieces, symbol, logs

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray | pa.Array, ...]:
        """By text: its tokens, how many of them are frequent words, the sums
        of those words' log shares and of all ids' logs, the other words, and
        the symbols by segment; the end is counted as a token alone."""
        flat, starts = self.flat, self.starts
        n = len(texts)
        words, first = split_words(texts)
        count = np.diff(first)
        # Words of each segment; only texts over SEGMENT bytes have several.
        long = np.flatnonzero(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False) > SEGMENT).tolist()
        sizes, by_text, done = [], np.ones(n, dtype=np.int64), 0
        for i in long:
            cut = [len(part) for part in segments(texts[i].as_py())]
            sizes += [count[done:i], cut]
            by_text[i], done = len(cut), i + 1
        sizes = np.concatenate([*sizes, count[done:]]).astype(np.int64)
        at = pc.index_in(words, value_set=self.hot).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        hit, document = at >= 0, np.repeat(np.arange(n), count)
        miss, place = np.flatnonzero(~hit), at[hit]
        known = np.bincount(document[hit], minlength=n)
        base = np.bincount(document[hit], weights=self.shares[place], minlength=n)
        more = words.take(pa.array(miss))
        rare = pa.ListArray.from_arrays(np.searchsorted(document[miss], np.arange(n + 1)).astype(np.int32), more)
        # Subword ids of all words in order: hot ones from the table, others behind it.
        own, own_starts = flat_pieces(more.to_pylist(), self.pieces)
        begin, length = starts[at], np.diff(starts, append=0)[at]
        begin[miss], length[miss] = own_starts[:-1] + len(flat), np.diff(own_starts)
        told = np.bincount(document[hit], weights=self.word_logs[place], minlength=n) + np.bincount(np.repeat(document[miss], length[miss]), weights=self.logs[own], minlength=n)
        stop = np.cumsum(length)
        whole = np.concatenate([flat, self.symbol[own]])[np.repeat(begin - (stop - length), length) + np.arange(int(stop[-1]) if len(stop) else 0)]
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(sizes)])] * whole.itemsize
        parts = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(whole)])
        symbols = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(by_text)]).astype(np.int32), parts)
        return count + 1, known, base, told, rare, symbols


def read(docs: DataFrame, counts: Counts, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as training and scoring need it, written: its tokens and the
    base score of the hot ones, the ``rare`` others, the ``symbols`` of its
    subword ids by segment, and the sum of the ``logs`` of their counts."""
    hot = [w for w, _ in counts.hot]
    alphabet = model.alphabet
    flat, starts = flat_pieces(hot, model.pieces)
    sums = np.concatenate([[0.0], np.cumsum(alphabet.logs[flat])])
    shares = counts.log_share(np.array([c for _, c in counts.hot], dtype=float))
    given = docs.sparkSession.sparkContext.broadcast((pa.array(hot, pa.binary()), alphabet.symbol[flat], starts, np.diff(sums[starts]), shares, model.pieces, alphabet.symbol, alphabet.logs))
    end_share, end_log = float(counts.log_share(np.array([counts.ends]))[0]), float(alphabet.logs[-2])
    ends = counts.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(*given.value)
        for batch in batches:
            for part in byte_slices(batch, READ):
                tokens, known, base, told, rare, symbols = read(part.column(0))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(tokens), pa.array(known + int(ends > 0)), pa.array(base + end_share), pa.array(told + end_log), rare, symbols],
                                                 names=[*part.schema.names[1:], "n_tokens", "n_known", "base_score", "logs", "rare", "symbols"])

    narrow = docs.select(docs[text_col].cast("string").alias("text"), docs[id_col].alias("doc_id"), held_out.alias("held_out"), F.monotonically_increasing_id().alias("row"))
    kind = dict(narrow.dtypes)["doc_id"]
    return written(narrow.mapInArrow(run, f"doc_id {kind}, held_out boolean, row long, n_tokens long, n_known long, base_score double, logs double, rare array<binary>, symbols array<binary>"), "lm-read")


def learn(rows: DataFrame, counts: Counts, model: Model, share: float = SHARE, least_words: int = LEAST_WORDS, passes: int = PASSES) -> Model:
    """``model`` trained on all ``rows`` of :func:`read`: the last pass takes
    every one, those before it the ones a hash of id and symbols draws."""
    alphabet, weights = model.alphabet, model.weights
    words = max(1, counts.tokens - counts.ends)
    if rows.isEmpty():
        return model

    def dealt(share: float) -> tuple[DataFrame, int]:
        learners = max(1, round(share * words / LEARNER_WORDS))
        drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "symbols"), F.lit(1 << 30)) < int(share * (1 << 30))
        return rows.where(drawn).select("symbols").repartition(learners), learners

    alphabet.classes(near(rows.select("symbols"), alphabet))
    of_symbol = alphabet.of_symbol
    for turn in range(passes):
        now = weights.packed()

        def work(part: list[list[bytes]], now: bytes = now, turn: int = turn) -> tuple[float, bytes]:
            layout, step = Layout.of(part), Learner(Weights.unpacked(now), BATCH // RUN, RUN)
            x, y = layout.runs(of_symbol)
            some = np.random.default_rng(turn).permutation(np.flatnonzero((y >= 0).any(axis=1)))
            # The last step is filled up with the empty run behind all.
            some = np.concatenate([some, np.full(-len(some) % step.runs, len(y) - 1)])
            for at in range(0, len(some), step.runs):
                step(x[some[at:at + step.runs]], y[some[at:at + step.runs]])
            return float((y >= 0).sum()), step.done().packed()

        some, learners = dealt(1.0 if turn == passes - 1 else min(1.0, max(share, least_words / words)))
        weight, mean = learned(some, work, learners)
        if weight:  # nothing drawn leaves the weights as they are
            weights = Weights.unpacked(mean.astype("<f4").tobytes())
    return Model(model.pieces, alphabet, weights)


def train(docs: DataFrame, counts: Counts, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
          share: float = SHARE, least_words: int = LEAST_WORDS, passes: int = PASSES) -> Model:
    """The model of all ``docs`` (see :func:`learn`)."""
    model = untrained(counts, ranks, pattern)
    rows = read(docs, counts, model, F.lit(False), id_col, text_col)
    out = learn(rows, counts, model, share, least_words, passes)
    drop_written(rows)
    return out


def score_rows(rows: DataFrame, counts: Counts, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` for every row of :func:`read`; both scores are log10 probabilities."""
    given = rows.sparkSession.sparkContext.broadcast((model.weights, model.alphabet.of_symbol, model.alphabet.log_total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, of_symbol, log_total = given.value
        scorer = Scorer(weights)
        for batch in batches:
            for part in symbol_slices(batch):
                layout = Layout.of(part.column(0).to_pylist())
                classes = of_symbol[layout.targets]
                told = scorer(layout.inputs, classes) - log_total[classes]
                told[layout.targets == PAD] = 0.0
                by_segment = np.add.reduceat(told, layout.starts * STEP)
                owner = np.repeat(np.arange(part.num_rows), np.diff(part.column(0).offsets.to_numpy()))
                total = np.bincount(owner, weights=by_segment, minlength=part.num_rows) + part.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(total / np.log(10))], names=[*part.schema.names[2:], "score"])

    carried = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score"]
    kinds = dict(rows.dtypes)
    scored = rows.select("symbols", "logs", *carried).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in carried) + ", score double")
    # The words that are not hot: their counts come by a join, and go back as sums.
    apart = rows.select("row", F.explode("rare").alias("word")).join(counts.table, "word", "left")
    c = F.coalesce("c", F.lit(0))
    logs = F.log10((c + 0.5) / F.lit(counts.tokens + 0.5 * (counts.distinct + 1)))
    sums = apart.groupBy("row").agg(F.sum(logs).alias("more"), F.sum((c > 0).cast("long")).alias("seen"))
    whole = scored.join(sums, "row", "left")
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
                        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")


def symbol_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about SEGMENT bytes of symbols (its first column), a row at least."""
    sizes = np.cumsum([sum(map(len, row)) for row in batch.column(0).to_pylist()])
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        n = max(1, int(np.searchsorted(sizes, before + SEGMENT, side="right")) - at)
        yield batch.slice(at, n)
        at += n


def score(docs: DataFrame, counts: Counts, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`score_rows` of all ``docs``."""
    return score_rows(read(docs, counts, model, held_out, id_col, text_col), counts, model)
