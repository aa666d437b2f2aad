"""Language identification by error-correcting output codes.

Every language has a binary codeword; one binary n-gram classifier per bit
predicts the bits; the loss-weighted distance to the codewords picks the
language and tells how clear the choice is.

Training counts hashed letter n-grams of every labelled document, per
language, in Spark; the classifiers follow from those counts (a table of
languages x features is all the driver gets, and a task holds).  There may be
at most ``MAX_LANGS`` languages, which bounds both; with more, as in a
free-form column, training raises ValueError before it counts anything.
Each language weighs the same whatever its share of the rows.

Defined results: a text that is null or has no letters is ``und`` with score
0 and is rejected; a text none of whose letters was ever learned (so none of
its n-grams was) falls to the nearest codeword, is flagged ambiguous and is
not ``learned``; n-grams that were never learned weigh nothing; repeated rows each get their own
result; with nothing to learn from every document is ``und``.  Texts are read
whole, in pieces of bounded size.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import byte_slices

#: Hashed features (a power of two).
FEATURES = 1 << 15
#: Most languages: 64 MB of counts in a task, some 8 million rows on the driver.
MAX_LANGS = 256
#: Longest n-gram, in letters and word boundaries.
MAX_N = 3
#: Up to so many languages every two-class split gets a bit; beyond, random splits.
EXHAUSTIVE = 6
RANDOM_BITS = 31
#: Additive smoothing of the per-language feature shares, in counts per feature.
SMOOTH = 0.5
#: Code points folded at once, to bound memory on long texts.
CHUNK = 1 << 18
#: Runner-up within this share of the winner's probability: ambiguous.
AMBIGUOUS = 0.8


@cache
def letter_table() -> np.ndarray:
    """Lower-cased code point per code point, 32 (a boundary) where it is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def feature_counts(text: str | None) -> np.ndarray | None:
    """Counts of the text's hashed n-grams; None if it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.zeros(FEATURES)
    some = False
    for at in range(0, len(points), CHUNK):
        c = letter_table()[points[at:at + CHUNK]]
        letters = c != 32
        if not letters.any():
            continue
        some = True
        c = np.concatenate([[32], c[letters | np.concatenate([[True], letters[:-1]])], [32]]).astype(np.uint32)
        h = np.zeros(len(c), dtype=np.uint32)
        for n in range(1, MAX_N + 1):
            h = h[: len(c) - n + 1] * np.uint32(0x9E3779B1) + c[n - 1:] * np.uint32(0x85EBCA6B) + np.uint32(n)
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            total += np.bincount((mixed >> np.uint32(7)) & np.uint32(FEATURES - 1), minlength=FEATURES)
            if len(c) - n < 1:
                break
    return total if some else None


def add_letters(text: str | None, into: np.ndarray) -> None:
    """Mark the text's folded letters in a mask over all code points."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for at in range(0, len(points), CHUNK):
        into[letter_table()[points[at:at + CHUNK]]] = True
    into[32] = False


def any_learned(text: str | None, learned: np.ndarray) -> bool:
    """Whether the text has a letter of the mask."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return any(learned[letter_table()[points[at:at + CHUNK]]].any() for at in range(0, len(points), CHUNK))


def codewords(k: int) -> np.ndarray:
    """k codewords of -1/+1.  Few classes: the exhaustive code (every split
    once).  More: seeded random splits, redrawn until all rows differ."""
    if k <= EXHAUSTIVE:
        bits = range(1, max(2, 1 << (k - 1)))
        return np.array([[1 if i == 0 else (-1 if s >> (i - 1) & 1 else 1) for s in bits] for i in range(k)])
    rng = np.random.default_rng(k)
    n = max(RANDOM_BITS, 4 * int(np.ceil(np.log2(k))) + 7)
    while True:
        code = np.where(rng.permuted(np.tile(np.arange(k) % 2, (n, 1)), axis=1).T == 1, 1, -1)
        if len(np.unique(code, axis=0)) == k:
            return code


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits: log-odds of bit +1
    scale: np.ndarray  # per bit: turns the mean log-odds into a margin
    trust: np.ndarray  # per bit: weight of its loss
    letters: np.ndarray | None = None  # mask over code points: learned letters (hashes collide, these do not)


def fit(langs: list[str], counts: np.ndarray) -> Model:
    """Binary classifiers from per-language feature counts."""
    if not langs:
        return Model([], *(np.zeros((0, 0)) for _ in range(4)))
    share = (counts + SMOOTH) / (counts + SMOOTH).sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    plus, minus = (code > 0).astype(float), (code < 0).astype(float)
    p = (share.T @ plus) / np.maximum(plus.sum(axis=0), 1)
    m = (share.T @ minus) / np.maximum(minus.sum(axis=0), 1)
    weights = np.where(minus.sum(axis=0) > 0, np.log(np.maximum(p, 1e-300)) - np.log(np.maximum(m, 1e-300)), 0.0)
    weights[counts.sum(axis=0) == 0] = 0.0  # never learned: no evidence for any language
    expected = share @ weights * code  # margin each language's own text has on each bit
    spread = np.abs(expected).mean(axis=0)
    scale = np.where(spread > 1e-9, 1.0 / np.maximum(spread, 1e-9), 0.0)
    trust = np.clip(expected.min(axis=0) * scale, 0.05, 1.0)
    return Model(langs, code, weights.astype(np.float32), scale, trust)


def decode(model: Model, features: np.ndarray) -> tuple[str, float, bool]:
    """(language, probability, ambiguous) by loss-weighted decoding."""
    margin = features @ model.weights / features.sum() * model.scale
    loss = (np.logaddexp(0.0, -3.0 * model.code * margin) * model.trust).sum(axis=1)
    p = np.exp(loss.min() - loss)
    order = np.argsort(loss, kind="stable")
    best = int(order[0])
    second = float(p[order[1]]) if len(order) > 1 else 0.0
    known = float(features[model.weights.any(axis=1)].sum()) if len(order) > 1 else 1.0
    return model.langs[best], float(p[best] / p.sum()), second > AMBIGUOUS or known == 0.0


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Count n-grams of every row with a language, one partial sum per task
    and language, and fit the classifiers.  Rows from FEATURES on are the
    letters that occurred."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        letters = np.zeros(0x110000, dtype=bool)
        for batch in batches:
            for t, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = t.as_py()
                c = feature_counts(text)
                if c is not None:
                    sums[lang] = sums[lang] + c if lang in sums else c
                    add_letters(text, letters)
        for lang, c in sums.items():
            f = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f), pa.string()), pa.array(f, pa.int32()), pa.array(c[f].astype(np.int64))], names=["lang", "f", "n"])
        f = np.flatnonzero(letters)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(f), pa.string()), pa.array(f + FEATURES, pa.int32()), pa.array(np.ones(len(f), np.int64))], names=["lang", "f", "n"])

    labelled = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang")).where("lang IS NOT NULL")
    if labelled.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages in {lang_col}")
    sums = labelled.mapInArrow(count, "lang string, f int, n long").groupBy("lang", "f").agg(F.sum("n").alias("n")).toPandas()
    letters = np.zeros(0x110000, dtype=bool)
    letters[sums["f"][sums["f"] >= FEATURES].to_numpy(int) - FEATURES] = True
    sums = sums[sums["f"] < FEATURES]
    langs = sorted(sums["lang"].unique().tolist())
    counts = np.zeros((len(langs), FEATURES))
    counts[sums["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), sums["f"].to_numpy(int)] = sums["n"]
    model = fit(langs, counts)
    model.letters = letters
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] = (),
            with_text: bool = False) -> DataFrame:
    """``[text], doc_id, <keep>, lang_pred, score, ambiguous, learned`` for
    every row; ``keep`` are columns of ``docs`` to carry along, under names of
    their own; the text itself comes back with ``with_text``, sent once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x bits and features x bits
    narrow = docs.select(docs[text_col].alias("text"), docs[id_col].alias("doc_id"), *keep)
    first = 0 if with_text else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (part for whole in batches for part in byte_slices(whole)):
            out = []
            for t in batch.column(0):
                text = t.as_py()
                c = feature_counts(text) if m.langs else None
                if c is None:
                    out.append(("und", 0.0, False, False))
                    continue
                best, p, unclear = decode(m, c)
                learned = any_learned(text, m.letters)
                out.append((best, p, unclear or not learned, learned))
            lang, score, flag, learned = map(list, zip(*out, strict=True)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[first:], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(flag, pa.bool_()), pa.array(learned, pa.bool_())],
                names=[*batch.schema.names[first:], "lang_pred", "score", "ambiguous", "learned"])

    schema = StructType(narrow.schema.fields[first:]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean").add("learned", "boolean")
    return narrow.mapInArrow(run, schema)
