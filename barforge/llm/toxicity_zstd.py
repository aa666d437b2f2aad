"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A window of text that the toxic dictionary shortens more than the ordinary one
speaks for toxicity; a document is as toxic as its strongest windows are.

Labels mark whole documents, of which only a few passages are toxic, so most
of what zstandard learns from toxic documents is ordinary text.  The toxic
dictionary keeps those segments of it that a share of toxic documents holds
some times the share of ordinary ones, before the content of the ordinary
dictionary; that ratio is one of ``RATIOS``, the one with the least log loss
when half of the drawn documents (by a hash of the id) learn and the other
half is scored.  The ordinary dictionary is padded to the same length.  Windows
then differ in length by the toxic segments alone.  Every window follows a
fixed prefix that both dictionaries hold, so that even one match shows in the
compressed length.

Thresholds are calibrated by a logistic curve over a document's strongest
windows.  The labelled documents for all this are a sample of at most about
``sample_docs`` of each class, drawn by a hash of the id; an id with several
rows counts once, by its least text.  Up to ``MAX_WINDOWS``
windows of each, spread over its text, train the dictionaries; the curve is
fitted over all their windows, as they are scored; in the curve each counts for as many documents of
its class as it stands for, so the table's share of toxic documents is learned
whatever is drawn.  Scoring reads every window of every text.

Defined results: null, empty and blank texts have no window and get the base
score of such texts; without labelled rows of both classes every score is 0;
repeated rows each get their own result; an empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bytes of a window, and the step from one to the next.
WINDOW = 128
STEP = 112
#: Bytes of the trained dictionaries.
TOXIC_BYTES = 16_384
ORDINARY_BYTES = 4096
PREFIX = 128
#: Length of the pieces that are compared, and how many times the share of
#: ordinary documents that hold a kept one the share of toxic documents is (to
#: choose from).  A ratio of shares asks no more of a rare piece than of a
#: common one.
PIECE = 5
RATIOS = (2.0, 3.0, 5.0, 8.0, 13.0)
#: Labelled documents of each class that train and calibrate, and windows of
#: each that train the dictionaries.
SAMPLE_DOCS = 3000
MAX_WINDOWS = 256
#: Strongest windows that make a document's features.
TOP = 3
#: Raw literals and matches from six bytes: a length tells what was matched.
PARAMETERS = {"window_log": 15, "hash_log": 15, "chain_log": 12, "search_log": 1, "min_match": 6, "target_length": 1,
              "strategy": zstandard.STRATEGY_FAST, "write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}


def windows_of(text: str | None) -> list[bytes]:
    """Overlapping windows of the whole lower-cased text, white space folded."""
    raw = b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())
    return [raw[i:i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STEP), STEP)] if raw else []


class Compressor:
    """Compressed lengths of windows under a dictionary's content."""

    def __init__(self, content: bytes):
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=parameters)
        self.context = zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)
        self.prefix = content[-PREFIX:]

    def lengths(self, windows: list[bytes]) -> np.ndarray:
        compress, prefix = self.context.compress, self.prefix
        return np.fromiter((len(compress(prefix + w)) for w in windows), np.float64, len(windows))


@dataclass
class Model:
    toxic: bytes  # dictionaries
    ordinary: bytes
    weights: np.ndarray  # of 1, the TOP differences, log(1 + windows)


def pieces(window: bytes) -> set[bytes]:
    return {window[i:i + PIECE] for i in range(len(window) - PIECE + 1)}


def distinctive(a: int, n: int, b: int, m: int, ratio: float) -> bool:
    """Whether share a/n of toxic documents is ``ratio`` times share b/m of
    ordinary ones, half a document added to either count."""
    return a > 0 and (a + 0.5) / (n + 1) >= ratio * (b + 0.5) / (m + 1)


def toxic_segments(dictionary: bytes, toxic: list[list[bytes]], ordinary: list[list[bytes]], ratio: float) -> list[bytes]:
    """Runs of the dictionary whose pieces are distinctive of toxic documents."""
    candidates = pieces(dictionary)

    def held(docs: list[list[bytes]]) -> Counter:
        n: Counter = Counter()
        for ws in docs:
            n.update(set().union(*map(pieces, ws)) & candidates)
        return n

    a, b = held(toxic), held(ordinary)
    kept = {p for p in candidates if distinctive(a[p], len(toxic), b[p], len(ordinary), ratio)}
    runs: list[bytes] = []
    start = None
    for i in range(len(dictionary) - PIECE + 2):
        inside = i <= len(dictionary) - PIECE and dictionary[i:i + PIECE] in kept
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            runs.append(dictionary[start:i - 1 + PIECE])
            start = None
    return [r for r in dict.fromkeys(runs) if not any(r != x and r in x for x in runs)]


def features(differences: np.ndarray) -> np.ndarray:
    top = np.sort(differences)[::-1][:TOP]
    return np.concatenate([[1.0], top, np.zeros(TOP - len(top)), [np.log1p(len(differences))]])


def logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Newton steps for the calibration curve; each sample stands for ``rows``."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (rows * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)) * rows.sum()
        step = np.linalg.solve(hessian, x.T @ (rows * (y - p)) - ridge * rows.sum() * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train_dictionary(size: int, windows: list[bytes]) -> bytes:
    """Zstandard's trainer; where the samples are too few for it, their text."""
    try:
        return zstandard.train_dictionary(size, windows).as_bytes()
    except zstandard.ZstdError:
        return b"".join(windows)[:size]


def dictionaries(docs: list[tuple[list[bytes], int]], ratios: tuple[float, ...]) -> list[Model]:
    """From (windows, label) of documents, a model for each ratio, not yet
    calibrated; none without documents of both classes."""
    toxic, ordinary = ([ws for ws, y in docs if y == label] for label in (1, 0))
    if not toxic or not ordinary:
        return []
    content = train_dictionary(ORDINARY_BYTES, [w for ws in ordinary for w in ws]).rjust(PREFIX, b"\0")
    trained = train_dictionary(TOXIC_BYTES, [w for ws in toxic for w in ws])
    kept = [b"".join(toxic_segments(trained, toxic, ordinary, r)) for r in ratios]
    return [Model(k + content, bytes(len(k)) + content, np.zeros(TOP + 2)) for k in kept]


def sampled_windows(labelled: DataFrame) -> list[tuple[list[bytes], int, int]]:
    """(up to MAX_WINDOWS windows, label, half) of the drawn documents (doc_id,
    text, label, half) that train the dictionaries."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                ws = windows_of(t.as_py())
                out.append(ws[::-(-len(ws) // MAX_WINDOWS) or 1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.binary())), *batch.columns[2:]], names=["doc_id", "ws", "label", "half"])

    rows = labelled.select("doc_id", "text", "label", "half").mapInArrow(cut, "doc_id long, ws array<binary>, label int, half int").toArrow().to_pylist()
    rows.sort(key=lambda r: r["doc_id"])  # the same model on every run
    return [([bytes(w) for w in r["ws"]], r["label"], r["half"]) for r in rows if r["ws"]]


def sampled_features(labelled: DataFrame, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the drawn documents that have any window: features over all their
    windows (document, model, feature), labels and halves."""
    width = TOP + 2

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [(Compressor(m.toxic), Compressor(m.ordinary)) for m in models]
        for batch in batches:
            out = []
            for t in batch.column(1):
                ws = windows_of(t.as_py())
                out.append(np.concatenate([features(plain.lengths(ws) - heavy.lengths(ws)) for heavy, plain in pairs]).tolist() if ws else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64())), *batch.columns[2:]], names=["doc_id", "x", "label", "half"])

    rows = labelled.select("doc_id", "text", "label", "half").mapInArrow(measure, "doc_id long, x array<double>, label int, half int").toArrow().to_pylist()
    rows = sorted((r["doc_id"], r["x"], r["label"], r["half"]) for r in rows if r["x"])
    x = np.array([r[1] for r in rows]).reshape(len(rows), len(models), width)
    return x, np.array([r[2] for r in rows], dtype=int), np.array([r[3] for r in rows], dtype=int)


def log_loss(x: np.ndarray, y: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> float:
    z = np.where(y == 1, 1, -1) * np.clip(x @ weights, -30, 30)
    return float((rows * np.log1p(np.exp(-z))).sum() / rows.sum())


def choose_ratio(drawn: DataFrame, docs: list[tuple[list[bytes], int, int]], stands_for: np.ndarray) -> float:
    """The ratio whose model, learned on one half of the drawn documents, has
    the least log loss on the other; the middle one where either half lacks a
    class."""
    default = RATIOS[len(RATIOS) // 2]
    models = dictionaries([(ws, y) for ws, y, half in docs if half == 0], RATIOS)
    if not models or {y for _, y, half in docs if half == 1} != {0, 1}:
        return default
    x, y, half = sampled_features(drawn, models)
    rows, learn = stands_for[y], half == 0
    losses = []
    for k in range(len(RATIOS)):
        weights = logistic(x[learn, k], y[learn].astype(float), rows[learn])
        losses.append(log_loss(x[~learn, k], y[~learn], rows[~learn], weights))
    return RATIOS[int(np.argmin(losses))]


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fit on rows of ``labels`` for which ``may_learn`` (a condition on doc_id) holds."""
    label = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")).where(may_learn & F.col("label").isin(0, 1))
    label = label.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in label.groupBy("label").agg(F.count("*").alias("n")).collect()}
    stands_for = np.array([max(1.0, counts.get(y, 0) / sample_docs) for y in (0, 1)])
    share = F.when(F.col("label") == 1, F.lit(float(1 / stands_for[1]))).otherwise(F.lit(float(1 / stands_for[0])))
    # About 2 x sample_docs ids whatever the input: a table of bounded size.
    drawn = label.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).join(F.broadcast(drawn), "doc_id")
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("doc_id")), F.lit(2)).cast("int").alias("half")
    # One row an id, whatever the table repeats; read three times below.
    rows = written(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("*", half), "toxicity-sample")
    sample = sampled_windows(rows)
    if {y for _, y, _ in sample} != {0, 1}:
        return None
    (model,) = dictionaries([(ws, y) for ws, y, _ in sample], (choose_ratio(rows, sample, stands_for),))
    x, y, _ = sampled_features(rows, [model])
    model.weights = logistic(x[:, 0], y.astype(float), stands_for[y])
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, windows, difference``: the probability of label 1, the
    number of windows and the strongest window's difference in bytes."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = (Compressor(model.toxic), Compressor(model.ordinary)) if model else None
        for batch in batches:
            out = []
            for t in batch.column(1):
                ws = windows_of(t.as_py())
                d = pair[1].lengths(ws) - pair[0].lengths(ws) if pair else np.zeros(len(ws))
                p = 1 / (1 + np.exp(-np.clip(features(d) @ model.weights, -30, 30))) if model else 0.0
                out.append((float(p), len(ws), float(d.max()) if len(d) else None))
            p, n, top = map(list, zip(*out, strict=True)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(n, pa.int64()), pa.array(top, pa.float64())],
                                             names=["doc_id", "score", "windows", "difference"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, score double, windows long, difference double")
