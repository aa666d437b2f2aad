"""Suffix-array dedup: remove every byte covered by a string of ``length``
bytes that also starts earlier in the corpus.

Suffixes are sorted by the difference-cover algorithm: the triples at two of
every three positions are sorted and named, the names are sorted the same way
(recursion), the remaining suffixes are merged in, and adjacent suffixes are
compared over ``length`` bytes.  The work is distributed by content.  Each
window of ``length`` bytes has an anchor, the gram of least hash inside it;
equal windows have equal anchors at the same place, so only texts around equal
anchors need be sorted together:

0. Of documents with equal texts only the first is looked at: every window of
   the others starts earlier in it.
1. Anchors whose gram occurs once in the corpus are dropped, with all windows
   they stand for: none of these occurs again.
2. The text around an anchor that covers all its windows is its context.  Equal
   contexts are one (the earliest occurrence stays, the windows of all others
   are removed), so thousands of copies reach the sort as one text.
3. Contexts that differ but share an anchor are sorted by the difference-cover
   algorithm, together with as many other anchors' as fit a bounded piece of
   work.  An anchor with more than ``GROUP`` different contexts is dealt by more
   than its gram: windows are told apart by their place around the anchor, in
   ever smaller cells, and the bytes that all windows of a cell cover (their
   core) are the anchor of what is sorted together.

Tables between the steps are narrow; texts are shuffled only where contexts
differ, and for the documents that lose bytes.  What is broadcast are bitmaps
of a few bits a value, which only spare work (a wrong hit adds rows that the
exact steps then settle), and eight bytes for each copy of a whole document.

Defined results: a null text counts as empty; texts shorter than ``length``
keep every byte; documents are ordered by id, null ids last; rows that share
an id count as one document, so a repeated row is not earlier than its twin;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, written
from .vectors import joined, sorted_groups

#: Bytes of an anchor's gram.
GRAM = 32
#: Most contexts of one anchor, and bytes of text, that are sorted at once.
GROUP = 2048
PIECE_BYTES = 1 << 16
#: Bytes of documents that a task takes in hand at once.
SLICE_BYTES = 1 << 22
#: Words of 64 bits in a bitmap, at least and at most; in between, a word for
#: four values at most.
LEAST_WORDS, MOST_WORDS = 1 << 14, 1 << 22
#: Positions hashed at once, to bound memory on long texts.
CHUNK = 1 << 16
LAST_ID = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(raw: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of every gram, by prefix sums modulo 2^64."""
    n = len(raw)
    sums = np.zeros(n + 1, np.uint64)
    terms = sums[1:]
    np.add(raw, np.uint64(1), out=terms)
    terms *= down[:n]
    np.cumsum(terms, out=terms)
    h = sums[GRAM:] - sums[:-GRAM]
    h *= up[GRAM - 1:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    n, of = len(a), 1
    while 2 * of <= width:
        a = np.minimum(a[:-of], a[of:])
        of *= 2
    return np.minimum(a[:n - width + 1], a[width - of:])


class Anchors:
    """Anchors of texts: ``(gram hash, gram start, first and last window start)``
    arrays; the windows of a text are dealt among its anchors without a gap."""

    def __init__(self, length: int):
        self.length = length
        self.up = powers(BASE, CHUNK + length)
        self.down = powers(pow(BASE, -1, 1 << 64), CHUNK + length)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.of_all([text])[1:]

    def of_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same of several texts at once, behind the place of the text."""
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)[:len(ends)]
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        windows = len(raw) - self.length + 1
        firsts, places, hashes = [], [], []
        low = np.uint64((1 << 24) - 1)
        for at in range(0, max(0, windows), CHUNK):
            h = gram_hashes(raw[at:at + CHUNK + self.length - 1], self.up, self.down)
            # Least 40 bits of hash, then leftmost: the place rides in the low bits.
            key = h & ~low
            key |= np.arange(len(h), dtype=np.uint64)
            least = sliding_min(key, self.length - GRAM + 1) & low
            first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
            place = least[first].astype(np.int64)
            firsts.append(first + at)
            places.append(place + at)
            hashes.append(h[place])
        if not places:
            return (np.zeros(0, np.int64),) * 5
        first, place, h = np.concatenate(firsts), np.concatenate(places), np.concatenate(hashes)
        new = np.concatenate([[True], place[1:] != place[:-1]])  # false where a chunk goes on
        first, place, h = first[new], place[new], h[new]
        # Windows end with their text: cut there, and drop those over its end.
        cuts = np.concatenate([begins, np.maximum(ends - self.length + 1, begins)])
        starts = np.union1d(first, cuts[cuts < windows])
        last = np.concatenate([starts[1:], [windows]]) - 1
        run, owner = np.searchsorted(first, starts, side="right") - 1, np.searchsorted(ends, starts, side="right")
        whole = starts + self.length <= ends[owner]
        owner, run, starts, last = owner[whole], run[whole], starts[whole], last[whole]
        begin = begins[owner]
        return owner, h[run].view(np.int64), place[run] - begin, starts - begin, last - begin


def words_for(values: int) -> int:
    """Words of a bitmap over so many values, a power of two: 16 bits a value or more."""
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << max(0, values // 4).bit_length()))


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    v = values.view(np.uint64)
    return (bitmap[v % np.uint64(len(bitmap))] >> ((v >> np.uint64(40)) & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(values: DataFrame, name: str, n: int) -> np.ndarray:
    """Bitmap over the long column ``name`` of about ``n`` rows."""
    words = words_for(n)
    word = F.pmod(F.col(name), F.lit(words)).cast("int")  # a power of two divides 2^64: the sign does not matter
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(name, 40).bitwiseAND(63).cast("int"))
    rows = values.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    for batch in rows.to_batches():
        out[batch["word"].to_numpy()] = batch["bits"].to_numpy().view(np.uint64)
    return out


def place_hash(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """One long per place (document, start)."""
    h = (doc.astype(np.int64).view(np.uint64) * np.uint64(BASE) + start.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the intervals, in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]]) if len(starts) else np.zeros(0, bool)
    cut = np.flatnonzero(new)
    return starts[cut], np.concatenate([ends[cut[1:] - 1], ends[-1:]])


# ---- the difference-cover algorithm -------------------------------------

def ranked(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each key (at most ``most``) among the distinct ones, and the
    order of the keys, in 32 bits."""
    n = len(keys)
    if most * (n + 1) + n < 1 << 64:  # the place rides behind the key: sorting values is faster
        some = keys * np.uint64(n + 1)
        some += np.arange(n, dtype=np.uint64)
        some.sort()
        whole = some // np.uint64(n + 1)
        order = (some - whole * np.uint64(n + 1)).astype(np.int32)
        some = whole
        del whole
    else:
        order = np.argsort(keys).astype(np.int32)
        some = keys[order]
    new = np.zeros(n, dtype=np.int32)
    new[1:] = some[1:] != some[:-1]
    del some
    out = np.empty(n, dtype=np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out, order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of fewer than 2^31 whole numbers >= 1 and < 2^31 by the
    difference cover {1, 2} mod 3.  What is held over a recursion has 32 bits."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int32)
    s = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.int32)
    one, two = (np.arange(a, b, 3, dtype=np.int32) for a, b in ((1, n + (n % 3 == 1)), (2, n)))
    sample = np.concatenate([one, two])
    del one, two
    top = int(s.max()) + 1
    wide = lambda at: s[at].astype(np.uint64)
    pairs = lambda at: wide(at) * np.uint64(top) + wide(at + 1)
    # Sort the sampled triples and name them by rank.
    if top**3 < 1 << 64:
        names, order = ranked(pairs(sample) * np.uint64(top) + wide(sample + 2), top**3 - 1)
    else:
        names, order = ranked(ranked(pairs(sample), top**2 - 1)[0].astype(np.uint64) * np.uint64(top) + wide(sample + 2), len(sample) * top)
    if len(names) and names[order[-1]] + 1 < len(names):
        # Names repeat: sort the string of names; its suffixes are the sample's.
        names += 1
        del order
        order = suffix_array(names)
    del names
    # The sample in order, and the rank of each of it.
    sample = sample[order]
    del order
    rank = np.zeros(n + 3, dtype=np.int32)
    rank[sample] = np.arange(1, len(sample) + 1, dtype=np.int32)
    # Merge: a remaining suffix is its first symbol and a ranked suffix, and so
    # are the sampled ones at one of three; each kind is in order already, but
    # for the first symbol of the remaining ones.
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    sample, one_in = sample[sample < n], one[one < n]
    zero = one - 1
    first = s[zero]
    zero = zero[np.argsort(first.astype(np.uint16) if top <= 1 << 16 else first, kind="stable")]
    del first, one
    # It comes after its own like, and after the sampled ones that are less.
    big = np.uint64(n + 3)
    key_one = lambda at: wide(at) * big + rank[at + 1].astype(np.uint64)
    at = np.searchsorted(key_one(one_in), key_one(zero)).astype(np.int32)
    del one_in
    if top**2 * (n + 3) < 1 << 64:
        key_two = lambda at: pairs(at) * big + rank[at + 2].astype(np.uint64)
        at += np.searchsorted(key_two(two), key_two(zero)).astype(np.int32)
    else:
        both = ranked(np.concatenate([pairs(zero), pairs(two)]), top**2 - 1)[0].astype(np.uint64)
        key_two = both[len(zero):] * big + rank[two + 2].astype(np.uint64)
        at += np.searchsorted(key_two, both[:len(zero)] * big + rank[zero + 2].astype(np.uint64)).astype(np.int32)
        del both
    del key_two, two
    at += np.arange(len(zero), dtype=np.int32)
    out = np.empty(n, dtype=np.int32)
    taken = np.zeros(n, dtype=bool)
    taken[at] = True
    out[at] = zero
    out[~taken] = sample
    return out


def repeated_windows(contexts: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, offset) of every window that equals one starting earlier, the
    contexts being texts at ``starts`` of ``docs``."""
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    text = np.frombuffer(b"\0".join(contexts) + b"\0", dtype=np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = text.astype(np.int32) + 2
    symbols[begins + sizes] = 1  # between contexts
    whole = np.repeat(sizes >= length, sizes + 1)
    ends = np.repeat(begins + sizes, sizes + 1)
    whole &= np.arange(len(text)) + length <= ends
    del ends
    order = suffix_array(symbols)
    order = order[whole[order]]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(order), dtype=bool)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    for a in range(1, len(order), 8192):
        rows = windows[order[a - 1:a + 8192]]
        same[a:a + len(rows) - 1] = (rows[1:] == rows[:-1]).all(axis=1)
    # Only windows that stand twice or more need their places.
    twin = same.copy()
    twin[:-1] |= same[1:]
    order, same = order[twin], same[twin]
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.searchsorted(begins, order, side="right") - 1
    offset = order - begins[owner]
    group = np.cumsum(~same) - 1
    doc, start = docs[owner], starts[owner] + offset
    by = np.lexsort((start, doc, group))
    lead = by[np.searchsorted(group[by], np.arange(group[-1] + 1))]
    later = (doc != doc[lead][group]) | (start != start[lead][group])
    return owner[later], offset[later]


# ---- the distributed steps ----------------------------------------------

def batch_of(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES of text (their second column), a row at least."""
    return (part for batch in batches for part in byte_slices(batch, SLICE_BYTES, column=1))


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """(order of the document, version of its text, UTF-8 bytes); the version is Spark's xxhash64."""
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
        ver = xxhash.xxh64_intdigest(raw, 42)
        yield LAST_ID if doc is None else doc, ver - (ver >> 63 << 64), raw


def whole_copies(docs: DataFrame, length: int) -> DataFrame:
    """``doc, ver, size`` of the documents whose whole text stands in an earlier
    document, where a window fits in."""
    raw = docs["text"].cast("binary")
    keyed = docs.select(doc_key(docs["doc_id"]).alias("doc"), F.xxhash64("text").alias("ver"), F.md5(raw).alias("digest"), F.octet_length("text").cast("long").alias("size")).where(F.col("size") >= length)
    least = keyed.groupBy("digest").agg(F.min("doc").alias("lead"), F.count("*").alias("n")).where("n > 1")
    return written(keyed.join(least, "digest").where("doc > lead").select("doc", "ver", "size").distinct(), "suffix-copies")


def places_of(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``p``: one long per place, see :func:`place_hash`."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of("p", place_hash(batch.column(0).to_numpy(), batch.column(1).to_numpy()))

    return rows.select(first, second).mapInArrow(hashed, "p long")


class Reader:
    """Reads slices of documents for the steps: their texts and anchors, without
    the copies of whole documents (``copies`` has their places, sorted)."""

    def __init__(self, copies: np.ndarray, length: int):
        self.copies, self.anchors = copies, Anchors(length)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Order, version and bytes of the documents."""
        rows = list(texts_of(batch))
        doc, ver = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1))
        if len(self.copies):
            p = place_hash(doc, ver)
            fresh = self.copies[np.minimum(np.searchsorted(self.copies, p), len(self.copies) - 1)] != p
            rows, doc, ver = [r for r, own in zip(rows, fresh.tolist(), strict=True) if own], doc[fresh], ver[fresh]
        return doc, ver, [r[2] for r in rows]


def repeated_grams(docs: DataFrame, copies, length: int) -> DataFrame:
    """``h``: the grams of anchors that occur twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(copies.value, length)
        for batch in slices(batches):
            h, n = np.unique(reader.anchors.of_all(reader.read(batch)[2])[1], return_counts=True)
            yield batch_of("h n", h, n.astype(np.int64))

    seen = docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return written(seen.where("n > 1").select("h"), "suffix-grams")


def first_in_order(doc: np.ndarray, start: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by keys and place, and (in it) whether a row is later
    than the first of its keys."""
    order = np.lexsort((start, doc, *keys[::-1]))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    lead = np.flatnonzero(new)
    group = np.repeat(lead, np.diff(np.concatenate([lead, [len(order)]])))
    doc, start = doc[order], start[order]
    return order, (doc != doc[group]) | (start != start[group])


def context_occurrences(docs: DataFrame, copies, grams, length: int) -> DataFrame:
    """``h, c, doc, ver, start, windows, gone``: the contexts (digest ``c``) of
    repeated anchors, the earliest of each in a slice; the others' windows as
    merged intervals with ``gone`` set (these have a ``c`` of their own, which
    deals them evenly)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(copies.value, length)
        names = "h c doc ver start windows gone"
        digest = xxhash.xxh64_intdigest
        for batch in slices(batches):
            doc, ver, raws = reader.read(batch)
            owner, h, place, first, last = reader.anchors.of_all(raws)
            some = in_bitmap(grams.value, h)
            owner, h, place, first, last = (x[some] for x in (owner, h, place, first, last))
            if not len(h):
                continue
            c = np.array([digest(raws[k][a:b], p) for k, a, b, p in zip(owner.tolist(), first.tolist(), (last + length).tolist(), (place - first).tolist(), strict=True)], dtype=np.uint64).view(np.int64)
            doc, ver, start, windows = doc[owner], ver[owner], first, last - first + 1
            order, gone = first_in_order(doc, start, h, c)
            h, c, doc, ver, start, windows = (x[order] for x in (h, c, doc, ver, start, windows))
            yield batch_of(names, *(x[~gone] for x in (h, c, doc, ver, start, windows)), np.zeros((~gone).sum(), dtype=bool))
            d, v, a, w = (x[gone] for x in (doc, ver, start, windows))
            by = np.lexsort((a, v, d))
            d, v, a, w = d[by], v[by], a[by], w[by]
            if len(d):
                # Windows [a, a + w) that follow one another are one run.
                new = np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (a[1:] > a[:-1] + w[:-1])])
                cut = np.flatnonzero(new)
                stop = np.concatenate([cut[1:], [len(d)]]) - 1
                yield batch_of(names, place_hash(d[cut], a[cut]), v[cut], d[cut], v[cut], a[cut], a[stop] + w[stop] - a[cut], np.ones(len(cut), dtype=bool))

    return docs.mapInArrow(run, "h long, c long, doc long, ver long, start long, windows long, gone boolean")


#: A text to be sorted with the others of its ``h``: ``at`` is the place of its
#: first window among those around the anchor (0: the gram ends the window).
CONTEXT = "h long, doc long, ver long, start long, context binary, at long"


def contested_contexts(docs: DataFrame, copies, contests, places, length: int) -> DataFrame:
    """The contexts (see CONTEXT) of the contested anchors at the given places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(copies.value, length)
        for batch in slices(batches):
            doc, ver, raws = reader.read(batch)
            owner, h, place, first, last = reader.anchors.of_all(raws)
            some = in_bitmap(contests.value, h)
            owner, h, place, first, last = (x[some] for x in (owner, h, place, first, last))
            some = in_bitmap(places.value, place_hash(doc[owner], first))
            owner, h, place, first, last = (x[some] for x in (owner, h, place, first, last))
            texts = [raws[k][a:b] for k, a, b in zip(owner.tolist(), first.tolist(), (last + length).tolist(), strict=True)]
            yield batch_of("h doc ver start context at", h, doc[owner], ver[owner], first, pa.array(texts, pa.binary()), length - GRAM - (place - first))

    return docs.mapInArrow(run, CONTEXT)


def cells(text: bytes, at: int, width: int, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """The windows of a context by cells of ``width`` places around the anchor:
    (cell, first window, behind the last one, core).  Equal windows of one
    anchor are in the same cell and have the same core: the bytes that all
    windows of a cell cover."""
    for cell in range(at // width, (at + len(text) - length) // width + 1):
        low = cell * width - at
        yield cell, max(0, low), min(low + width, len(text) - length + 1), text[low + width - 1:low + length]


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by the first column, in batches that end with a group."""
    held: list[pa.RecordBatch] = []
    for batch in (b for b in batches if b.num_rows):
        keys = batch.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield joined([*held, batch.slice(0, cut)])
            held = []
        elif held and held[-1].column(0)[-1] != batch.column(0)[0]:
            yield joined(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield joined(held)


def likely(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The contexts that may share a window with another of their anchor, cut to
    the half of their windows that may: a core stands there twice."""
    width = (length - GRAM + 2) // 2
    for group in whole_groups(batches):
        h, texts = group.column(0).to_pylist(), group.column(4).to_pylist()
        halves = [[(hash((key, cell, core)), a, b) for cell, a, b, core in cells(text, at, width, length)]
                  for key, text, at in zip(h, texts, group.column(5).to_pylist(), strict=True)]
        seen = Counter(core for own in halves for core, _, _ in own)
        kept = [[(a, b) for core, a, b in own if seen[core] > 1] for own in halves]
        some = np.array([bool(own) for own in kept])
        spans = [(own[0][0], own[-1][1]) for own in kept if own]
        cut = pa.array([text[a:b + length - 1] for text, (a, b) in zip((t for t, own in zip(texts, kept, strict=True) if own), spans, strict=True)], pa.binary())
        h, doc, ver, start = (group.column(k).to_numpy()[some] for k in range(4))
        yield batch_of("h doc ver start context", h, doc, ver, start + np.array([a for a, _ in spans], dtype=np.int64), cut)


def sorted_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``doc, ver, start, windows`` by pieces of whole anchors' contexts: a
    piece is at most PIECE_BYTES, or one anchor's."""

    def matches(piece: pa.RecordBatch) -> pa.RecordBatch:
        doc, ver, start = (piece.column(k).to_numpy() for k in (1, 2, 3))
        owner, offset = repeated_windows(piece.column(4).to_pylist(), doc, start, length)
        by = np.lexsort((offset, owner))
        owner, offset = owner[by], offset[by]
        cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])) if len(owner) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([cut, [len(owner)]]))
        return batch_of("doc ver start windows", doc[owner[cut]], ver[owner[cut]], start[owner[cut]] + offset[cut], size.astype(np.int64))

    held: list[pa.RecordBatch] = []
    size = 0
    for group in sorted_groups(batches, 1):
        more = group.column(4).nbytes
        if held and size + more > PIECE_BYTES:
            yield matches(pa.concat_batches(held))
            held, size = [], 0
        held.append(group)
        size += more
    if held:
        yield matches(pa.concat_batches(held))


def sorted_matches(contexts: DataFrame, length: int) -> DataFrame:
    """``doc, ver, start, windows``: windows that equal an earlier one, by the
    difference-cover algorithm over the contexts of whole anchors."""
    # By a hash of ``h``: Spark drops a repartition that a join below has made
    # already, and then reads that join's partitions in any order and by parts.
    dealt = contexts.repartition(F.xxhash64("h")).sortWithinPartitions("h")
    return dealt.mapInArrow(lambda batches: sorted_pieces(likely(batches, length), length), "doc long, ver long, start long, windows long")


def finer(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """The contexts (see CONTEXT) by cells of ``width`` places, with the core in
    their ``h``; ``c, windows, gone`` as in :func:`context_occurrences`, by batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            rows = [(digest(core, (h + cell) % (1 << 64)), doc, ver, start + a, text[a:b + length - 1], at + a)
                    for h, doc, ver, start, text, at in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True)
                    for cell, a, b, core in cells(text, at, width, length)]
            if not rows:
                continue
            h = np.array([r[0] for r in rows], dtype=np.uint64).view(np.int64)
            c = np.array([digest(r[4], r[5]) for r in rows], dtype=np.uint64).view(np.int64)
            doc, ver, start, at = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2, 3, 5))
            windows = np.array([len(r[4]) for r in rows], dtype=np.int64) - length + 1
            order, gone = first_in_order(doc, start, h, c)
            twin = np.zeros(len(order), dtype=bool)  # a repeated row
            twin[1:] = np.all([x[order][1:] == x[order][:-1] for x in (h, c, doc, ver, start)], axis=0)
            text = [None if out else rows[k][4] for k, out in zip(order.tolist(), gone.tolist(), strict=True)]
            h, c, doc, ver, start, at, windows = (x[order] for x in (h, c, doc, ver, start, at, windows))
            h, c = np.where(gone, place_hash(doc, start), h), np.where(gone, ver, c)
            out = batch_of("h doc ver start context at c windows gone", h, doc, ver, start, pa.array(text, pa.binary()), at, c, windows, gone)
            yield out.filter(pa.array(~twin))

    return contexts.mapInArrow(run, CONTEXT + ", c long, windows long, gone boolean")


def hot_matches(contexts: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """For anchors with too many contexts to sort at once: contexts of finer
    anchors to sort instead, and windows that equal an earlier one as ``doc,
    ver, start, windows``.  A cell of one place has nothing left to sort: its
    core is the window."""
    names, found, cold = [x.split()[0] for x in CONTEXT.split(", ")], [], []
    width = length - GRAM + 1
    while contexts is not None:
        width = (width + 1) // 2
        place = F.dense_rank().over(Window.partitionBy("h", "c").orderBy("doc", "start"))
        rows = written(finer(contexts, width, length).withColumn("gone", F.col("gone") | (place > 1)), "suffix-finer")
        found.append(rows.where("gone").select("doc", "ver", "start", "windows"))
        leads = rows.where("NOT gone")
        counts = leads.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
        counts = written(counts.select("h", "n"), "suffix-contests")
        hot = counts.where(F.col("n") > GROUP).select("h")  # few: each has so many contexts
        leads = leads.join(counts, "h", "left_semi")
        if width == 1 or hot.isEmpty():
            contexts = None
        else:
            contexts = leads.join(F.broadcast(hot), "h", "left_semi").select(names)
            leads = leads.join(F.broadcast(hot), "h", "left_anti")
        cold.append(leads.select(names))
    return functools.reduce(DataFrame.unionByName, cold), found


def doc_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def removed_spans(docs: DataFrame, length: int) -> DataFrame:
    """``doc, ver, spans``: per document (and text) the bytes to remove."""
    spark = docs.sparkSession
    whole = whole_copies(docs, length)
    copies = spark.sparkContext.broadcast(np.unique(places_of(whole, "doc", "ver").toArrow()["p"].to_numpy()))
    grams = repeated_grams(docs, copies, length)
    grams = spark.sparkContext.broadcast(bitmap_of(grams, "h", grams.count()))
    found = context_occurrences(docs, copies, grams, length)
    # At most one row of a slice for each context: a group is bounded by the slices.
    place = F.dense_rank().over(Window.partitionBy("h", "c").orderBy("doc", "start"))
    rows = written(found.withColumn("gone", F.col("gone") | (place > 1)).drop("c"), "suffix-contexts")
    leads = rows.where("NOT gone").select("h", "doc", "start")
    contests = written(leads.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "suffix-contests")
    n, total, most = contests.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    places = places_of(leads.join(contests, "h", "left_semi"), "doc", "start")
    places = spark.sparkContext.broadcast(bitmap_of(places, "p", total))
    contexts = contested_contexts(docs, copies, spark.sparkContext.broadcast(bitmap_of(contests, "h", n)), places, length)
    removed = [rows.where("gone").select("doc", "ver", "start", "windows"),
               whole.select("doc", "ver", F.lit(0).cast("long").alias("start"), (F.col("size") - length + 1).alias("windows"))]
    if most > GROUP:
        contexts = written(contexts, "suffix-texts")
        hot = F.broadcast(contests.where(F.col("n") > GROUP).select("h"))  # few: each has so many contexts
        cold, settled = hot_matches(contexts.join(hot, "h", "left_semi"), length)
        contexts = contexts.join(hot, "h", "left_anti").unionByName(cold)
        removed += settled
    removed = functools.reduce(DataFrame.unionByName, [*removed, sorted_matches(contexts, length)])
    span = F.struct("start", (F.col("start") + F.col("windows") + length - 1).alias("end"))
    return written(removed.groupBy("doc", "ver").agg(F.collect_set(span).alias("spans")), "suffix-spans")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept binary, n_bytes, spans``: the remaining bytes of every row
    and the maximal runs removed from it."""
    spark = docs.sparkSession
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    spans = removed_spans(narrow, length)
    bitmap = spark.sparkContext.broadcast(bitmap_of(places_of(spans, "doc", "ver"), "p", spans.count()))

    def dealt(batches: Iterator[pa.RecordBatch], touched: bool) -> Iterator[tuple[pa.Array, list]]:
        """Ids and (order, version, bytes) of the documents that lose bytes, or of the others."""
        for batch in slices(batches):
            rows = list(texts_of(batch))
            doc, ver = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1))
            hit = in_bitmap(bitmap.value, place_hash(doc, ver)) == touched
            yield batch.column(0).filter(pa.array(hit)), [r for r, own in zip(rows, hit.tolist(), strict=True) if own]

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in dealt(batches, True):
            yield batch_of("doc_id doc ver raw", ids, *(pa.array([x[k] for x in own], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in dealt(batches, False):
            yield batch_of("doc_id kept n_bytes spans", ids, pa.array([x[2] for x in own], pa.binary()), pa.array([len(x[2]) for x in own], pa.int64()),
                           pa.array([[]] * len(own), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, sizes, runs = [], [], []
            for raw, own in zip(batch.column(1), batch.column(2), strict=True):
                raw = raw.as_py()
                if own.is_valid and len(own.values):
                    a, b = merged(own.values.field(0).to_numpy(), own.values.field(1).to_numpy())
                    edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(raw)]
                    kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
                    runs.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                else:
                    kept.append(raw)
                    runs.append([])
                sizes.append(len(raw))
            yield batch_of("doc_id kept n_bytes spans", batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()),
                           pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))

    out = "doc_id long, kept binary, n_bytes long, spans array<struct<start:bigint,end:bigint>>"
    cuts = narrow.mapInArrow(touched, "doc_id long, doc long, ver long, raw binary").join(spans, ["doc", "ver"], "left").select("doc_id", "raw", "spans")
    return cuts.mapInArrow(cut, out).unionByName(narrow.mapInArrow(whole, out))
