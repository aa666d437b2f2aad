"""Byte-level BPE encoding and decoding.

The text is split by the tokenizer's pattern, in Spark's expressions.  A word's
merges join the leftmost pair of lowest rank until none is left; tasks do it
for one word at a time, and each word's ids depend on nothing but the word.

Words are encoded once per distinct word where that pays: all documents' words
are counted, the most frequent ones (at most ``max_words`` of at most
``MAX_HOT_BYTES`` bytes, so the table's size has a proven bound) are merged
once, by tasks, and broadcast; any other word is merged where it stands, once
per slice of documents.  The bound decides where a word is encoded, never
whether or how.  Words over ``LONG_BYTES`` bytes, for which shifting a list of
pieces would cost quadratically, follow the same merge rule with a heap.

Decoding concatenates the pieces' bytes.  A null text counts as empty: no ids,
the digests of nothing.  Repeated rows each get their own result; an empty
table gives an empty result; columns other than the id and the text are
ignored.  The vocabulary's path is a parameter; nothing is trained.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, written

#: Most words, and most bytes of each, in the broadcast table.
MAX_HOT_WORDS = 1 << 20
MAX_HOT_BYTES = 32
#: Longest word that is merged in a list.
LONG_BYTES = 128
#: Words looked up at once (a document's at least), to bound a worker's memory.
SLICE = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece from a tiktoken file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, f.read().splitlines()))}


def words_of(text: Column, pattern: str) -> Column:
    """The pattern's matches; ``(?U)`` gives Java the Unicode white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merge rule with a heap of pairs over a linked list."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # a piece is word[start:end[start]]
    before = list(range(-1, n - 1))
    alive = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = end[i]
        r = ranks.get(word[i:end[j]]) if j < n else None
        return None if r is None else (r, i, end[j])

    heap = [x for x in map(pair, range(n)) if x]
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop or ranks[word[i:stop]] != r:
            continue
        j = end[i]
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        for k in (before[i], i):
            if k >= 0 and (x := pair(k)):
                heapq.heappush(heap, x)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: its own if it is a piece, else by the merge rule."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_BYTES:
        return merge_long(word, ranks)
    none, get = 1 << 62, ranks.get
    pieces = [word[i:i + 1] for i in range(len(word))]
    joined = [get(word[i:i + 2], none) for i in range(len(word) - 1)]  # rank of each piece with the next
    while joined:
        least = min(joined)
        if least == none:
            break
        i = joined.index(least)
        pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
        del joined[i]
        if i:
            joined[i - 1] = get(pieces[i - 1] + pieces[i], none)
        if i < len(joined):
            joined[i] = get(pieces[i] + pieces[i + 1], none)
    return [ranks[p] for p in pieces]


def hot_words(words: DataFrame, ranks, max_words: int) -> pa.Table:
    """``w, ids`` of the words that stand most often in all documents: those
    counted at least c times, for the smallest c >= 2 that lets at most
    ``max_words`` in.  ``ranks`` is a broadcast table; ids are of its width."""
    counts = written(words.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
                     .where((F.col("n") > 1) & (F.octet_length("w") <= MAX_HOT_BYTES)), "bpe-words")
    by_count = counts.groupBy("n").agg(F.count("*").alias("k"))  # at most sqrt(2 x all words) rows
    at_least = F.sum("k").over(Window.orderBy(F.col("n").desc()))
    least = by_count.withColumn("k", at_least).where(F.col("k") <= max_words).agg(F.min("n")).first()[0]
    hot = counts.where(F.col("n") >= least) if least else counts.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kind = ranks.value, width(ranks.value)
        for batch in batches:
            ids = [np.array(merge_word(w.encode(), table), dtype=kind).tobytes() for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["w", "ids"])

    out = hot.select("w").mapInArrow(run, "w string, ids binary").toArrow()
    drop_written(counts)
    return out


def width(ranks: dict[bytes, int]) -> str:
    """The numbers that ids travel as."""
    return "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"


def word_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about SLICE words (lists in the second column), a row at least."""
    sizes = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        n = max(1, int(np.searchsorted(sizes, before + SLICE, side="right")) - at)
        yield batch.slice(at, n)
        at += n


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           max_words: int = MAX_HOT_WORDS, then: tuple | None = None) -> DataFrame:
    """``doc_id, ids array<int>`` for every row.  ``then`` (see ``decoding``
    and ``digesting``) is what follows in the same Python worker."""
    sc = docs.sparkSession.sparkContext
    vocabulary = sc.broadcast(ranks)
    words = docs.select(docs[id_col].cast("long").alias("doc_id"), words_of(docs[text_col], pattern).alias("words"))
    table = hot_words(words, vocabulary, max_words)
    hot, ids = (table[c].combine_chunks() for c in ("w", "ids"))
    kind = np.dtype(width(ranks))
    flat = np.frombuffer(b"".join(ids.to_pylist()), kind)
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False) // kind.itemsize)]).astype(np.int64)
    shared = sc.broadcast((hot.cast(pa.string()), flat, ends))  # at most max_words x (MAX_HOT_BYTES bytes and as many ids)
    del table, hot, ids

    def place_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, flat, ends = shared.value
        ranks = vocabulary.value
        for batch in (part for whole in batches for part in word_slices(whole)):
            lists = batch.column(1)
            words = lists.flatten().dictionary_encode()
            # The slice's distinct words among the hot ones: the smaller side is the one hashed.
            found = pc.index_in(hot, value_set=words.dictionary)
            own = found.drop_null().to_numpy()
            start, size = np.full(len(words.dictionary), -1), np.zeros(len(words.dictionary), np.int64)
            place = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            start[own], size[own] = ends[place], ends[place + 1] - ends[place]
            # The others stand behind them, each once a slice.
            missing = np.flatnonzero(start < 0)
            merged = [merge_word(w.encode(), ranks) for w in words.dictionary.take(pa.array(missing)).to_pylist()]
            size[missing] = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged))
            start[missing] = len(flat) + np.cumsum(size[missing]) - size[missing]
            all_flat = np.concatenate([flat, np.fromiter(chain.from_iterable(merged), dtype=flat.dtype)])
            code = words.indices.to_numpy()
            stop = np.concatenate([[0], np.cumsum(size[code])])
            index = np.repeat(start[code] - stop[:-1], size[code])
            index += np.arange(len(index))
            bounds = stop[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])]
            values = pa.array(all_flat[index].astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)], names=["doc_id", "ids"])

    if then is None:
        return words.mapInArrow(place_ids, "doc_id long, ids array<int>")
    follow, schema = then
    return words.mapInArrow(lambda batches: follow(place_ids(batches)), schema)


def decoding(ranks: dict[bytes, int]) -> tuple:
    """Step from ``doc_id, ids`` to ``doc_id, ids, bytes``: the pieces' bytes, joined."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces.__getitem__
        for batch in batches:
            out = [b"".join(map(of, ids.values.to_numpy(zero_copy_only=False).tolist())) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])

    return run, "doc_id long, ids array<int>, bytes binary"


def digesting(ranks: dict[bytes, int]) -> tuple:
    """Step from ``doc_id, ids`` to ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``: ids as little-endian unsigned 32-bit integers, and the
    bytes they decode to."""
    decode_batches, _ = decoding(ranks)
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decode_batches(batches):
            ids = [digest(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.list_value_length(batch.column(1)).cast(pa.int64()), pa.array(ids, pa.string()),
                                              pa.array([digest(x.as_buffer()) for x in batch.column(2)], pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, ids, bytes`` from ``doc_id, ids``."""
    return encoded.select("doc_id", "ids").mapInArrow(*decoding(ranks))
