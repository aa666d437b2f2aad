"""Toxicity by compression distance: held-out accuracy and defined results."""

import random

import numpy as np
from llm_fixtures import documents, empty, prose, ugly  # noqa: F401
from pyspark.sql import functions as F

from barforge.llm import toxicity_zstd
from barforge.llm.common import held_out

INSULTS = ["worthless", "pathetic", "disgusting", "clowns"]


def corpus(n=900):
    rng = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        words = prose(i, rng.randint(20, 400)).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def test_held_out_accuracy(spark, ugly, empty):
    texts, y = corpus()
    df = documents(spark, texts)
    labels = spark.createDataFrame([(i + 1, 1, v) for i, v in enumerate(y)] + [(5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity_zstd.train(df, labels, ~held_out(F.col("doc_id")))
    rows = toxicity_zstd.score(df.where(held_out(df["doc_id"])), model).collect()
    right = [(r.score >= 0.5) == bool(y[r.doc_id - 1]) for r in rows]
    assert len(rows) > 100 and sum(right) / len(right) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in toxicity_zstd.score(ugly, model).collect()}
    assert odd[1].score == odd[2].score == odd[3].score and odd[1].windows == 0 and odd[5].windows > 100
    assert toxicity_zstd.score(empty, model).collect() == []
    assert toxicity_zstd.train(df, labels.where("toxic = 0"), ~held_out(F.col("doc_id"))) is None
    assert toxicity_zstd.train(empty, labels, ~held_out(F.col("doc_id"))) is None
    assert {r.score for r in toxicity_zstd.score(df.limit(5), None).collect()} == {0.0}


def test_windows_cover_the_whole_text():
    for n in (0, 1, 127, 128, 129, 240, 241, 5000):
        raw = bytes(97 + i % 26 for i in range(n)).decode()
        ws = toxicity_zstd.windows_of(raw)
        covered = np.zeros(n, dtype=int)
        for k, w in enumerate(ws):
            at = k * toxicity_zstd.STEP
            assert w == raw.encode()[at:at + toxicity_zstd.WINDOW]
            covered[at:at + len(w)] += 1
        assert covered.all()


def test_scores_keep_the_class_share_above_the_cap(spark):
    n = 1500
    df = documents(spark, [prose(i, 30) for i in range(n)])  # no evidence: the score is the base rate
    labels = spark.createDataFrame([(i + 1, int(i % 10 == 0)) for i in range(n)], "doc_id long, toxic int")
    model = toxicity_zstd.train(df, labels, F.lit(True), sample_docs=100)
    mean = toxicity_zstd.score(df, model).agg(F.avg("score")).first()[0]
    assert 0.04 < mean < 0.2


def test_rare_toxic_phrases_are_kept_at_any_sample_size():
    phrase = b"worthless"
    for n, m, held in ((10, 80, 4), (390, 2800, 4), (3000, 3000, 10)):
        toxic = [[b"the house " + phrase]] * held + [[b"the house"]] * (n - held)
        kept = b"".join(toxicity_zstd.toxic_segments(b"the house " + phrase, toxic, [[b"the house"]] * m, 5.0))
        assert phrase in kept and b"house" not in kept


def test_calibration_reads_every_window_of_long_texts(spark):
    texts, y = corpus(60)
    n = 5 * toxicity_zstd.STEP * toxicity_zstd.MAX_WINDOWS // 2
    texts[0] = "x" * n + " worthless " + "y" * n
    labels = spark.createDataFrame([(i + 1, v) for i, v in enumerate(y)], "doc_id long, toxic int")
    df = documents(spark, texts)
    model = toxicity_zstd.train(df, labels, F.lit(True))
    x, label, _ = toxicity_zstd.sampled_features(df.withColumn("label", F.when(df["doc_id"] % 4 == 1, 1).otherwise(0)).withColumn("half", F.lit(0)), [model])
    x = x[:, 0]
    scored = toxicity_zstd.score(df, model).orderBy("doc_id").collect()
    assert scored[0].windows > toxicity_zstd.MAX_WINDOWS * 4
    assert x[0][-1] == np.log1p(scored[0].windows) and x[0][1] == scored[0].difference and label.tolist() == y
    assert np.allclose(toxicity_zstd.logistic(x, label.astype(float), np.ones(len(label))), model.weights)


def test_ratio_is_chosen_without_the_held_out_rows(spark):
    texts, y = corpus(300)
    df = documents(spark, texts)
    labels = spark.createDataFrame([(i + 1, v) for i, v in enumerate(y)], "doc_id long, toxic int")
    learn = ~held_out(F.col("doc_id"))
    model = toxicity_zstd.train(df, labels, learn)
    # Labels and texts of the held-out rows change nothing of the model.
    odd = df.withColumn("text", F.when(held_out(df["doc_id"]), F.lit("worthless clowns")).otherwise(df["text"]))
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity_zstd.train(odd, flipped, learn)
    assert (again.toxic, again.ordinary) == (model.toxic, model.ordinary) and (again.weights == model.weights).all()


def test_repeated_ids_do_not_grow_the_sample(spark, monkeypatch):
    texts, y = corpus(40)
    df = documents(spark, texts + [texts[0] + " more"] * 500, ids=list(range(1, 41)) + [1] * 500)
    labels = spark.createDataFrame([(i + 1, v) for i, v in enumerate(y)], "doc_id long, toxic int")
    sizes = []
    plain = toxicity_zstd.sampled_windows
    monkeypatch.setattr(toxicity_zstd, "sampled_windows", lambda rows: sizes.append(plain(rows)) or sizes[-1])
    assert toxicity_zstd.train(df, labels, F.lit(True)) is not None
    assert len(sizes[0]) == 40


def test_score_equals_plain_arithmetic(spark):
    """Windows, compressed lengths, features and curve by a loop over one text."""
    import zstandard
    texts, y = corpus(80)
    labels = spark.createDataFrame([(i + 1, v) for i, v in enumerate(y)], "doc_id long, toxic int")
    df = documents(spark, texts)
    m = toxicity_zstd.train(df, labels, F.lit(True))
    setup = zstandard.ZstdCompressionParameters(**toxicity_zstd.PARAMETERS)

    def length(dictionary, window):
        context = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=setup)
        return len(context.compress(dictionary[-toxicity_zstd.PREFIX:] + window))

    for r in toxicity_zstd.score(df.where("doc_id <= 12"), m).collect():
        raw = " ".join(texts[r.doc_id - 1].lower().split()).encode()
        diffs, at = [], 0
        while True:
            window = raw[at:at + 128]
            diffs.append(length(m.ordinary, window) - length(m.toxic, window))
            if at + 128 >= len(raw):
                break
            at += 112
        top = sorted(diffs, reverse=True)[:3]
        z = sum(w * f for w, f in zip(m.weights, [1, *top, *[0] * (3 - len(top)), np.log(1 + len(diffs))], strict=True))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9 and r.windows == len(diffs)
