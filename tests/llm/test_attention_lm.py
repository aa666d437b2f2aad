"""The attention model against plain arithmetic, its base columns against counting."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import documents, empty, prose, ugly  # noqa: F401
from pyspark.sql import functions as F

from barforge.llm import attention_lm as lm
from barforge.llm import byte_bpe, queries

RANKS = byte_bpe.load_ranks(queries.RANK_FILE)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def base_columns(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    words = [[*lm.words_of(t), b" "] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, words, strict=True) if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for (i, _), ws in zip(rows, words, strict=True)]


def plain_score(model, text):
    """The model's log10 probability, one position after the other, in double."""
    w, a = model.weights, model.alphabet
    rows, out, carry = w.rows.astype(float), 0.0, None
    parts = list(lm.segments(text))
    for k, words in enumerate(parts):
        own = [i for word in words for i in model.pieces(word)]
        inputs = ([-1] * lm.STEP + [-2] if carry is None else carry) + own
        follow = own + ([-2] if k + 1 == len(parts) else [])
        for at, y in enumerate(follow):
            place, begin = at + lm.STEP, at // lm.STEP * lm.STEP
            ids = np.array(inputs[begin:place + 1])
            x = rows[a.symbol[ids]]
            real = ids != -1
            q = x[-1, lm.Q][:-1]
            s = x[:, lm.K][:, :-1] @ q / math.sqrt(lm.WIDTH) + w.distance[np.arange(len(ids))[::-1]]
            e = np.exp(s) * real
            z = (e / e.sum()) @ x[:, lm.V] + x[-1, lm.OWN] + rows[a.symbol[inputs[place - 1]]][lm.PREVIOUS]
            p = np.maximum(z, 0) @ w.layer + w.bias
            c = a.target[y]
            out += p[c] - np.log(np.exp(p).sum()) + a.share[y]
        carry = inputs[-lm.STEP - 1:]
    return out / math.log(10)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT", 400)
    monkeypatch.setattr(lm, "HOT_WORDS", 12)  # most words come by the join
    monkeypatch.setattr(lm, "FLUSH", 50)


def run_query(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return queries.op11_attention_lm(spark, str(tmp_path)).collect()


def test_base_columns_equal_counting(spark, ugly, tmp_path, small):  # noqa: F811
    df = ugly.unionByName(documents(spark, [prose(i, 30 + i) for i in range(20)], ids=list(range(100, 120))))
    got = run_query(spark, df, tmp_path)
    assert got[0].asDict().keys() == {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3], round(r[5], 6))
    want = sorted(base_columns(rows_of(df)), key=key)
    for r, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
        assert r[:5] == w[:5] and r[5] == pytest.approx(w[5], rel=1e-9) and r[6] < 0


def test_score_equals_plain_attention(spark, small):
    docs = documents(spark, [prose(i, 20 + 7 * i) for i in range(12)] + [None, "", "a", "x" * 300, "ÄÖ ß 漢字 \U0001f600"])
    counts = lm.Counts(lm.count_words(docs))
    model = lm.train(docs, counts, RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r.score for r in lm.score(docs, counts, model, F.lit(False)).collect()}
    for i, text in rows_of(docs):
        assert got[i] == pytest.approx(plain_score(model, text), rel=1e-4)
    assert len(list(lm.segments(rows_of(docs)[11][1]))) > 1


def test_classes_and_shares_are_a_distribution(spark, small):
    docs = documents(spark, [prose(i) for i in range(10)])
    counts = lm.Counts(lm.count_words(docs))
    a = lm.train(docs, counts, RANKS, public_tokenizers.PATTERN).alphabet
    total = np.bincount(a.target[:-1], weights=np.exp(a.share[:-1]), minlength=lm.CLASSES)
    assert np.allclose(total[np.unique(a.target[:-1])], 1)


def test_gradients_are_right(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.integers(1, 40, (4, lm.STEP))
    x[0] = lm.PAD
    y = rng.integers(-1, lm.CLASSES, (4, lm.STEP))
    blocks = np.arange(1, 4)

    def loss(change=None, at=None, eps=0.0):
        w = lm.Weights(seed=1)
        w.distance[:] = 0.1
        w.rows *= 4
        w.rows[:, lm.Q.stop - 1], w.rows[:, lm.K.stop - 1] = 1.0, 0.0
        w.rows[lm.PAD, lm.K.stop - 1] = lm.MASKED
        if change is not None:
            w.arrays()[change][at] += eps
        for s in w.squares:
            s[...] = 1e12  # steps of gradient / 1e6 * rate
        before = [v.astype(np.float64) for v in w.arrays()]
        value = lm.gradient_step(w, x, y, blocks, rate=1e6)
        return value, [b - v for b, v in zip(before, w.arrays(), strict=True)]

    _, grads = loss()
    for change, grad in enumerate(grads):
        flat = np.argsort(-np.abs(grad).ravel())[:6]
        for at in (np.unravel_index(f, grad.shape) for f in flat):
            numeric = (loss(change, at, 0.02)[0] - loss(change, at, -0.02)[0]) / 0.04
            assert numeric == pytest.approx(grad[at], rel=0.15, abs=2e-3)


def test_training_learns(spark):
    docs = documents(spark, [prose(i, 200) for i in range(40)])
    counts = lm.Counts(lm.count_words(docs))
    mean = lambda passes: lm.score(docs, counts, lm.train(docs, counts, RANKS, public_tokenizers.PATTERN, passes=passes), F.lit(False)).agg(F.avg("score")).first()[0]
    assert mean(2) > mean(0) * 0.9


def test_means_of_many_learners(spark):
    """More than sixteen learners are averaged in two steps."""
    sample = spark.range(40).select(F.col("id").cast("string")).repartition(40, "id")
    weight, data = lm.learned(sample, lambda texts: (float(len(texts)), np.array([sum(map(int, texts)) / max(1, len(texts)), 1.0], "<f4").tobytes()), 40)
    assert weight == 40 and data.tolist() == pytest.approx([19.5, 1.0])


def test_nothing_to_score(spark, empty, tmp_path):  # noqa: F811
    assert run_query(spark, empty, tmp_path) == []


def test_every_learning_document_trains(spark):
    """Whatever a document holds, wherever it stands, moves its symbols' rows
    and counts among the neighbours that classes are made of."""
    docs = documents(spark, [prose(i, 40) for i in range(30)] + [f"zebra{i} quartz{i * 37} jumbo{i}xy" for i in range(30)])
    counts = lm.Counts(lm.count_words(docs))
    model = lm.train(docs, counts, RANKS, public_tokenizers.PATTERN, share=1 / 1000, least_words=1)
    ids = {i for _, text in rows_of(docs) for w in lm.words_of(text) for i in model.pieces(w)}
    seen = model.weights.squares[0][np.unique(model.alphabet.symbol[sorted(ids)])]
    assert len(ids) > 100 and (seen != np.float32(1e-3)).any(axis=1).all()
    assert (model.alphabet.target[sorted(ids)] < lm.CLASSES - 1).all()


def test_runs_step_like_single_blocks():
    """A step on runs, whose rows are read once, changes the weights as one on
    each of their blocks beside the block before it does."""
    rng = np.random.default_rng(5)
    x = np.minimum(rng.zipf(1.3, (3 * 8 + 1, lm.STEP)), 90).astype("<u2")
    x[11, 4:] = lm.PAD
    y = rng.integers(-1, lm.CLASSES, (3 * 8, lm.STEP))
    one, other = lm.Weights(seed=2), lm.Weights(seed=2)
    for w in (one, other):
        w.distance[:], w.bias[:] = np.linspace(0.5, -0.5, 2 * lm.STEP), np.linspace(-1, 1, lm.CLASSES)
        w.rows *= 4
        w.rows[:, lm.Q.stop - 1], w.rows[:, lm.K.stop - 1] = 1.0, 0.0
        w.rows[lm.PAD, lm.K.stop - 1] = lm.MASKED
    step = lm.Learner(one, 3, 8)
    for _ in range(2):
        step(np.stack([x[at:at + 9].ravel() for at in (0, 8, 16)]), y.reshape(3, -1))
        loss = lm.gradient_step(other, x, np.concatenate([y[:1], y]), np.arange(1, 25))
        assert step.loss() == pytest.approx(loss, rel=1e-5)
    for a, b in zip([*step.done().arrays(), *one.squares], [*other.arrays(), *other.squares], strict=True):
        assert np.allclose(a, b, rtol=1e-3, atol=1e-4)
    assert not np.array_equal(one.rows, lm.Weights(seed=2).rows)


def test_runs_hold_every_target():
    rng = np.random.default_rng(1)
    layout = lm.Layout.of([[rng.integers(2, 90, n).astype("<u2").tobytes()] for n in (0, 1, 15, 16, 17, 200, 900)])
    x, y = layout.runs(np.arange(lm.SYMBOLS, dtype=np.int32))
    assert np.array_equal(y[y >= 0], layout.targets[layout.targets != lm.PAD]) and (y[-1] < 0).all()
    assert np.array_equal(x[:, lm.STEP:].ravel()[:len(layout.inputs)], layout.inputs)
    assert np.array_equal(x[1:, :lm.STEP], x[:-1, -lm.STEP:])
    assert [a.size for a in lm.Layout.of([]).runs(np.arange(lm.SYMBOLS))[:1]] == [(lm.RUN + 1) * lm.STEP]


def test_sums_of_rows():
    rng = np.random.default_rng(2)
    for ids in (np.minimum(rng.zipf(1.2, 864), 4000), np.arange(64), np.zeros(48, int), np.repeat([3, 9], [17, 15])):
        rows, want = rng.standard_normal((len(ids), 80)).astype(np.float32), np.zeros((4001, 80))
        np.add.at(want, ids, rows)
        some, sums = lm.summed(ids.astype("<u2"), rows)
        assert np.array_equal(some, np.unique(ids)) and np.allclose(sums, want[some], atol=1e-4)


def test_joined_words_have_the_ids_of_single_ones():
    pieces = lm.Pieces(RANKS, public_tokenizers.PATTERN)
    parts = ["a", "ing", "é", "漢", "\U0001f600", "\x00", "7", ".", "'s", "\xa0", "\u2003", "\x85"]
    rng = np.random.default_rng(4)
    for _ in range(60):
        words = ["".join(parts[i] for i in rng.integers(0, len(parts), rng.choice([1, 2, 5, 20, 31, 63, 64, 65, 300]))).encode() for _ in range(rng.integers(0, 9))]
        ids, starts = lm.flat_pieces(words, pieces)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [pieces(w) for w in words]


def test_neighbours_of_all_parts(spark):
    docs = documents(spark, [prose(i, 30) for i in range(40)]).repartition(3)
    counts = lm.Counts(lm.count_words(docs))
    model = lm.untrained(counts, RANKS, public_tokenizers.PATTERN)
    rows = lm.read(docs, counts, model, F.lit(False)).select("symbols")
    want = model.alphabet.neighbours(lm.Layout.of([r.symbols for r in rows.collect()])) / 40
    got = lm.near(rows, model.alphabet)
    assert np.allclose(got[2:], want[2:], atol=1e-5) and got.sum() > 0


def test_large_weights_stay_finite():
    rng = np.random.default_rng(6)
    x, y = rng.integers(1, 40, (9, lm.STEP)).astype("<u2"), rng.integers(0, lm.CLASSES, (8, lm.STEP))
    w = lm.Weights(seed=1)
    w.rows[2:] *= 300
    w.layer *= 300
    assert np.isfinite(lm.Scorer(w)(x.ravel(), np.concatenate([y[:1], y]).ravel())).all()
    step = lm.Learner(w, 1, 8)
    step(x.reshape(1, -1), y.reshape(1, -1))
    assert np.isfinite(step.loss()) and all(np.isfinite(a).all() for a in step.done().arrays())


def test_words_of_columns():
    import pyarrow as pa

    texts = [None, "", " ", "One two\tTWO\n", "\x0b\x0ca\x1cb\x85c ÄÖ\u2003x  ", "x" * 50, "\U0001f600 \x00 é"]
    for column in (pa.array(texts), pa.array(["pad", *texts])[1:], pa.array([], pa.string()), pa.array([None], pa.string())):
        words, starts = lm.split_words(column)
        assert [words[int(a):int(b)].to_pylist() if b > a else [] for a, b in zip(starts[:-1], starts[1:], strict=True)] == [lm.words_of(t) for t in column.to_pylist()]


def test_counts_of_parts(spark, monkeypatch):
    monkeypatch.setattr(lm, "COUNTED", 60)
    texts = [prose(i, 30) for i in range(20)] + [None, "", "  A b\tB "]
    want = Counter(w for t in texts for w in [*lm.words_of(t), lm.END_WORD])
    assert {bytes(r.word): r.c for r in lm.count_words(documents(spark, texts)).collect()} == want
