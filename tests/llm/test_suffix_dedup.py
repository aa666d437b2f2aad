"""Suffix-array dedup against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from llm_fixtures import documents, empty, prose, ugly  # noqa: F401

from barforge.llm import suffix_dedup


def test_suffix_array_equals_sorting():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 4, 5, 6, 7, 30, 31, 32, 200):
        for top in (1, 2, 4, 300):
            s = rng.integers(1, top + 1, n)
            assert suffix_dedup.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_every_window_has_one_anchor_set_by_its_content():
    rng = np.random.default_rng(1)
    anchors = suffix_dedup.Anchors(100)
    raw = rng.integers(97, 100, 700).astype(np.uint8).tobytes()
    h, place, first, last = anchors.of(raw)
    assert first[0] == 0 and last[-1] == len(raw) - 100 and (first[1:] == last[:-1] + 1).all()
    assert (first <= place).all() and (place <= first + 100 - suffix_dedup.GRAM).all() and (last <= place).all()
    h2, place2, first2, _ = anchors.of(b"x" * 37 + raw)
    assert dict(zip((place + 37).tolist(), h.tolist(), strict=True)).items() <= dict(zip(place2.tolist(), h2.tolist(), strict=True)).items()


def brute(rows, length=100):
    first = {}
    texts = sorted(((suffix_dedup.LAST_ID if i is None else i), (t or "").encode()) for i, t in rows)
    for i, raw in texts:
        for a in range(len(raw) - length + 1):
            w = raw[a:a + length]
            first[w] = min(first.get(w, (i, a)), (i, a))
    out = []
    for i, t in rows:
        raw, key = (t or "").encode(), suffix_dedup.LAST_ID if i is None else i
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if first[raw[a:a + length]] < (key, a):
                gone[a:a + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((i, kept, len(raw), sum(1 for a in range(len(raw)) if gone[a] and (a == 0 or not gone[a - 1]))))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, bytes(r.kept), r.n_bytes, len(r.spans)) for r in suffix_dedup.remove_repeats(df).collect()), key=repr)


def test_removal_equals_brute_force(spark, ugly, empty, monkeypatch):
    rng = random.Random(7)
    passage, base = prose(100, 60), prose(101, 150)
    texts = [base] * 6 + [prose(i, 40) + passage + prose(i + 50, 40) for i in range(12)]
    for _ in range(25):  # near copies
        at = rng.randrange(len(base))
        texts.append(base[:at] + "#" + base[at + 1:])
    texts += ["ab" * 300, "ab" * 90 + "c" + "ab" * 90, "é" * 120, passage[:100], passage[:99], passage[3:103], "z" * 99, prose(9, 5000) + passage]
    rng.shuffle(texts)
    df = documents(spark, texts).repartition(5)
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert result(df) == want
    monkeypatch.setattr(suffix_dedup, "GROUP", 3)  # the way for anchors with many contexts
    assert result(df) == want
    assert result(ugly) == brute([(r.doc_id, r.text) for r in ugly.collect()])
    assert result(empty) == []


def test_long_texts_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 256)
    texts = [prose(1, 300), prose(2, 100) + prose(1, 300)[150:900]]
    df = documents(spark, texts)
    assert result(df) == brute(list(enumerate(texts, 1)))


def near_copies(n):
    rng, base = random.Random(5), prose(3, 60)[:168].encode()
    return [base[:k] + bytes([rng.randrange(97, 123)]) + base[k + 1:] for k in (rng.randrange(len(base)) for _ in range(n))]


def test_sorting_takes_few_bytes_a_symbol():
    contexts = near_copies(4000)
    places = np.arange(len(contexts))
    tracemalloc.start()
    owner, _ = suffix_dedup.repeated_windows(contexts, places, places * 0, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(owner) and peak < 80 * sum(map(len, contexts))


def test_pieces_stay_under_their_bound(monkeypatch):
    """Whole anchors are sorted together up to PIECE_BYTES; only one anchor's contexts may be more."""
    sizes = []
    contexts = near_copies(30)
    rows = [(h, d, 0, 0, bytearray(c)) for h in (1, 2, 3, 4) for d, c in enumerate(contexts)]
    table = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.binary(),), strict=True)], names=["h", "doc", "ver", "start", "context"])
    two = 2 * sum(map(len, contexts))
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", two * 11 // 10)  # Arrow's offsets count, too
    monkeypatch.setattr(suffix_dedup, "repeated_windows", lambda held, *rest: (sizes.append(sum(map(len, held))), (np.zeros(0, np.int64),) * 2)[1])
    list(suffix_dedup.sorted_pieces(iter([table]), 100))
    assert sizes == [two, two]


def test_documents_are_taken_in_slices(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 100)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4, 5], "text": ["x" * 60, "é" * 20, None, "y" * 500, "z"]})
    assert [part.column(0).to_pylist() for part in suffix_dedup.slices(iter([batch]))] == [[1, 2, 3], [4], [5]]


def test_anchors_of_several_texts_are_those_of_each(monkeypatch):
    texts = [b"", prose(1, 60).encode(), b"x" * 99, b"y" * 100, prose(1, 60).encode()[40:], b"z" * 7, prose(2, 300).encode()]
    anchors = suffix_dedup.Anchors(100)
    owner, *found = anchors.of_all(texts)
    for k, text in enumerate(texts):
        for many, one in zip(found, anchors.of(text), strict=True):
            assert many[owner == k].tolist() == one.tolist()
    assert [len(x) for x in anchors.of_all([])] == [0] * 5


def test_anchors_stay_in_one_task_behind_a_join(spark, tmp_path):
    """A join below the sort, which Spark changes into a broadcast while it
    runs, must not leave the contexts of an anchor in several tasks."""
    rows = [(h, doc, 0, 0, bytearray(prose(h, 40)[:120].encode() + b"%d" % doc), 0) for doc in (1, 2, 3, 4) for h in range(100)]
    spark.createDataFrame(rows, suffix_dedup.CONTEXT).repartition(4, "doc").write.option("maxRecordsPerFile", 25).parquet(str(tmp_path / "contexts"))
    spark.range(400).selectExpr("id AS h").write.parquet(str(tmp_path / "some"))
    contexts, some = (spark.read.parquet(str(tmp_path / name)) for name in ("contexts", "some"))
    settings = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1", "spark.sql.autoBroadcastJoinThreshold": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = suffix_dedup.sorted_matches(contexts.join(some.where("h = 399"), "h", "left_anti"), 100).collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found)) == sorted((doc, 0, 0, 21) for doc in (2, 3, 4) for _ in range(100))


def test_hot_anchors_are_dealt_until_their_groups_are_small(spark, monkeypatch):
    """A line that all have is in more contexts than may be sorted at once, and
    so are its halves; no sort gets more than GROUP contexts of an anchor."""
    line, rng = prose(5, 40)[:130], random.Random(1)
    texts = [prose(i, 3) + line + prose(100 + i, 3) for i in range(30)] + [line[:60] + rng.choice("xyz") + line[60:] + prose(200 + i, 2) for i in range(20)]
    df = documents(spark, [*texts, texts[3], None], ids=[*range(50, 0, -1), 51, None])
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    monkeypatch.setattr(suffix_dedup, "GROUP", 4)
    sizes = []
    monkeypatch.setattr(suffix_dedup, "sorted_matches", lambda contexts, *rest, was=suffix_dedup.sorted_matches: (sizes.extend(r["count"] for r in contexts.groupBy("h").count().collect()), was(contexts, *rest))[1])
    assert result(df) == want
    assert sizes and max(sizes) <= 4


def test_copies_of_whole_documents_are_left_out(spark):
    text = prose(1, 60)
    df = documents(spark, [text, text, text, "short", "short", None, text + "x", text], ids=[5, 3, 9, 1, 2, 4, 6, 3])
    copies = suffix_dedup.whole_copies(df.select("doc_id", "text"), 100)
    (_, ver, raw), = suffix_dedup.texts_of(pa.RecordBatch.from_pydict({"doc_id": [5], "text": [text]}))
    assert sorted(map(tuple, copies.collect())) == [(5, ver, len(raw)), (9, ver, len(raw))]
    reader = suffix_dedup.Reader(np.sort(suffix_dedup.place_hash(np.array([5, 9]), np.array([ver, ver]))), 100)
    doc, _, raws = reader.read(pa.RecordBatch.from_pydict({"doc_id": [5, 3, 9, 5], "text": [text, text, text, text + "x"]}))
    assert doc.tolist() == [3, 5] and raws == [raw, raw + b"x"]
    assert result(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_bitmaps_grow_with_their_values(spark):
    """Few wrong hits, whatever the number of values, for ids that follow one another, too."""
    assert [suffix_dedup.words_for(n) for n in (0, 10**6, 10**12)] == [1 << 14, 1 << 18, 1 << 22]
    n = 200_000
    rows = spark.range(0, 2 * n, 2).selectExpr("id AS doc", "id % 7 AS ver")
    bitmap = suffix_dedup.bitmap_of(suffix_dedup.places_of(rows, "doc", "ver"), "p", n)
    doc = np.arange(2 * n)
    hit = suffix_dedup.in_bitmap(bitmap, suffix_dedup.place_hash(doc, doc % 7))
    assert hit[::2].all() and hit[1::2].mean() < 0.08


def test_suffix_array_of_wide_and_long_strings():
    rng = np.random.default_rng(3)
    for top in (70_000, 3_000_000, (1 << 31) - 1):  # past 16 bits, triples past 64 bits
        s = rng.choice(rng.integers(1, top + 1, 40), 400)
        s[0] = top
        assert suffix_dedup.suffix_array(s).tolist() == sorted(range(400), key=lambda i: s[i:].tolist())
