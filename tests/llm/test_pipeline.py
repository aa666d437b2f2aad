"""corpus_pipeline.run() against a brute-force version of its five stages."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
import public_tokenizers
import tiktoken
from llm_fixtures import SCHEMA, prose
from test_text_operators import RANKS, brute_fingerprint, brute_spans

import corpus_pipeline
from barforge.llm import langid_ecoc, secret_scan
from barforge.llm.common import written

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
GERMAN = "der die das und ung heit keit schön ver ge über".split()


def rows():
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    out = []
    for i in range(160):
        de = i % 3 == 0
        text = " ".join(rng.choice(GERMAN) + rng.choice(GERMAN) for _ in range(rng.randint(4, 80))) if de else prose(i, rng.randint(4, 80))
        if i % 7 == 0:
            text += f"\ntoken = \"{noise(24)}\" end"
        if i % 11 == 0:
            text += f"\nkey {noise(40)} end"
        out.append([i + 1, text, "de" if de else "en", ["hot", "hot", "b", None][i % 4]])
    out += [[300 + i, out[5][1], "en", "hot"] for i in range(30)]  # copies
    out += [[400, None, "en", "b"], [401, "", None, None], [402, "12 34 !!", "en", "b"], [403, out[6][1], None, "c"], [404, "der über", None, "c"], [3, out[2][1], "en", "b"]]
    return [(i, t, lang, s, len(t or ""), 7, 0.5, 3, ["x"], 1) for i, t, lang, s in out]


def crc(i):
    from zlib import crc32
    return crc32(str(i).encode()) % 5


def brute(docs):
    # 1: language
    counts = {}
    for d in docs:
        f = langid_ecoc.feature_counts(d[1])
        if crc(d[0]) and d[2] is not None and f is not None:
            counts[d[2]] = counts.get(d[2], 0) + f
    langs = sorted(counts)
    model = langid_ecoc.fit(langs, np.array([counts[x] for x in langs]))
    kept = []
    for d in docs:
        f = langid_ecoc.feature_counts(d[1])
        if f is not None:
            kept.append([d[0], d[1], d[2] or langid_ecoc.decode(model, f)[0], d[3]])
    # 2: SimHash
    fps = {brute_fingerprint(d[1]) for d in kept}
    root = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            root[a] = min([root[b] for b in fps if (a ^ b).bit_count() <= 2])
    least = defaultdict(list)
    for d in kept:
        least[root[brute_fingerprint(d[1])]].append(d[0])
    kept = [d for d in kept if d[0] == min(least[root[brute_fingerprint(d[1])]])]
    # 3: secrets
    steps = {True: Counter(), False: Counter()}
    for d in kept:
        spans = brute_spans(d[1])
        if spans:
            tokens = [re.search(r"[A-Za-z0-9+/_.=-]+\Z", d[1][a:b])[0] if k == 0 else d[1][a:b] for a, k, b in spans]
        else:
            tokens = re.findall("[A-Za-z0-9_]{4,}", d[1])
        for t in tokens:
            steps[bool(spans)].update(zip(t, t[1:]))
    start = {k: Counter() for k in steps}
    for k, c in steps.items():
        for (a, _), n in c.items():
            start[k][a] += n
    log = lambda k, a, b: math.log((steps[k][a, b] + 0.5) / (start[k][a] + 35))
    ratio = lambda a, b: log(True, a, b) - log(False, a, b)
    mean = {k: sum(n * ratio(*ab) for ab, n in c.items()) / sum(c.values()) for k, c in steps.items()}
    least_ratio = mean[False] + secret_scan.SPLIT * (mean[True] - mean[False])
    for d in kept:
        base = brute_spans(d[1])
        spans = base + [(m.start(), 3, m.end()) for m in re.finditer(secret_scan.TOKEN, d[1])
                        if not any(a < m.end() and m.start() < b for a, _, b in base)
                        and sum(ratio(*x) for x in zip(m[0], m[0][1:])) / (len(m[0]) - 1) >= least_ratio]
        parts, at = [], 0
        for a, _, b in sorted(spans):
            if a >= at:
                parts += [d[1][at:a], "<secret>"]
            at = max(at, b)
        d[1] = "".join(parts) + d[1][at:]
    # 4: mix
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    size = Counter()
    for d in kept:
        size[d[3]] += words(d[1])
    order = sorted(size, key=lambda s: (s is None, s or ""))
    left, budget, target = {s: 1 + i % 3 for i, s in enumerate(order)}, sum(size.values()), {}
    while left:
        level = budget / sum(left.values())
        over = [s for s in left if 3 * size[s] <= left[s] * level]
        target |= {s: 3 * size[s] for s in over} if over else {s: w * level for s, w in left.items()}
        budget -= sum(3 * size[s] for s in over)
        left = {s: w for s, w in left.items() if s not in over} if over else {}
    out = []
    key = lambda d: int(md5(str(d[0]).encode()).hexdigest()[:15], 16)
    for s in order:
        own = [d for d in kept if d[3] == s]
        full = int(target[s] // size[s])
        rest = target[s] - full * size[s]
        below, run = -1, 0
        for h in sorted({key(d) for d in own}):
            n = sum(words(d[1]) for d in own if key(d) == h)
            if rest <= 0 or run + n - rest > rest - run and run + n >= rest:
                break
            below, run = h, run + n
            if run >= rest:
                break
        out += [d for d in own for _ in range(full + (key(d) <= below))]
    # 5: encode
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    return sorted((d[0], own.encode_ordinary(d[1]), len(d[1].encode())) for d in out)


def test_run_equals_brute_force(spark, tmp_path):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.ids, r.n_bytes) for r in got) == brute([list(r) for r in rows()])


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert [len(x) for x in corpus_pipeline.STAGES] == [2] * 5
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and written(out, "t").count() == 0
