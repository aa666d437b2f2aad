"""Secret scans with character Markov models, in DataFrame functions alone.

Three base rules find assigned values, access keys and long hexadecimal runs.
Two first-order Markov models over ASCII characters, one of random strings and
one of ordinary identifiers, are trained from labelled tokens; any further
token whose log-likelihood ratio per transition passes the threshold is
reported too, whole, unless one base span covers all of it.

A pattern's matches and the texts between them (``split``) give the offsets,
in code points; a cheap test first keeps the regular expressions off the texts
that cannot match.  Nothing is shuffled but the models' counts.

Defined results: a null text counts as empty and has no spans; repeated rows
each get their own result; without labelled tokens of both kinds the method
adds no span; an empty table gives an empty result; very long texts are read
whole, their matches folded in blocks, so that time grows with their number.
Extra columns are ignored.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the report: pattern, group whose length counts, least length.
BASE_KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    # Any shorter run is a match to drop, so only runs of 16 need be looked for.
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
MARKOV = "markov"
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Documents, in expectation, whose tokens train each model.
SAMPLE_DOCS = 4096
#: Place of the threshold between the two samples' mean log-likelihood ratios.
SPLIT = 0.6
CODES = 128
#: Matches that one step of a fold appends to its list.
FOLD = 128
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


@dataclass
class Models:
    """Log-likelihood ratio (random over ordinary) of each transition, from
    character ``a`` to ``b`` at ``a * CODES + b``, and the mean that reports."""
    ratio: list[float]
    threshold: float


def may_match(kind: str, text: Column) -> Column:
    """Necessary for a match of the kind, and cheap."""
    if kind == "assign":
        return (text.contains(":") | text.contains("=")) & text.rlike(BASE_KINDS[kind][0])
    return text.contains("AKIA") if kind == "access" else text.rlike(BASE_KINDS[kind][0])


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(rows: Column, step, item: str) -> Column:
    """``at, items`` of a running offset over ``rows``: ``step(at, row)`` gives
    the next offset and an array of items (``item`` is its type).  Lists grow
    in blocks, which are joined at the end: appending to one long list would
    copy it for every row."""
    blank = F.array().cast(f"array<{item}>")

    def add(acc: Column, row: Column) -> Column:
        return once(step(acc["at"], row), lambda s: F.struct(s["at"].alias("at"), F.concat(acc["items"], s["items"]).alias("items")))

    def add_block(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["at"].alias("at"), blank.alias("items")), add)
        return once(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["items"], F.array(d["items"])).alias("items")))

    def whole(r: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(r) - 1) / FOLD).cast("int")), lambda b: F.slice(r, b * FOLD + 1, F.lit(FOLD)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{item}>>").alias("items"))
        folded = F.aggregate(blocks, start, add_block, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["items"]).alias("items")))
        return F.when(F.size(r) > 0, folded).otherwise(F.struct(F.lit(0).alias("at"), blank.alias("items")))

    return once(rows, whole)


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans of the pattern's matches whose group has ``least`` characters."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    rows = F.zip_with(F.split(text, pattern, -1), F.arrays_zip(hits.alias("hit"), values.alias("value")),
                      lambda gap, m: F.struct(F.length(gap).alias("gap"), m["hit"].alias("hit"), m["value"].alias("value")))

    def step(at: Column, row: Column) -> Column:
        begin = at + row["gap"]
        end = begin + F.length(row["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), row["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(row["value"]) >= least, F.array(span)).otherwise(F.array().cast(SPAN)).alias("items"))

    return fold(F.filter(rows, lambda r: r["hit"].isNotNull()), step, SPAN[len("array<"):-1])["items"]


def base_spans(text: Column) -> Column:
    none = F.array().cast(SPAN)
    return F.concat(*[F.when(may_match(kind, text), matches(text, pattern, i, group, least)).otherwise(none)
                      for i, (kind, (pattern, group, least)) in enumerate(BASE_KINDS.items())])


def train(tokens: DataFrame) -> Models:
    """Models from labelled tokens (``token``, ``random`` boolean): Laplace
    smoothed transition counts, summed in Spark (2 x CODES x CODES at most)."""
    chars = F.filter(F.split("token", ""), lambda c: (c != "") & (F.ascii(c) < CODES))
    steps = F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))), F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))),
                       lambda a, b: F.ascii(a) * CODES + F.ascii(b))
    sums = tokens.where("token <> '' AND random IS NOT NULL").select("random", F.explode(steps).alias("step")).where("step IS NOT NULL").groupBy("random", "step").count().collect()
    seen = {True: [0.0] * CODES**2, False: [0.0] * CODES**2}
    for r in sums:
        seen[r["random"]][r["step"]] = float(r["count"])
    totals = {k: sum(v) for k, v in seen.items()}
    if not all(totals.values()):
        return Models([0.0] * CODES**2, math.inf)
    log = {}
    for k, v in seen.items():
        rows = [sum(v[a * CODES:(a + 1) * CODES]) for a in range(CODES)]
        log[k] = [math.log((v[s] + 0.5) / (rows[s // CODES] + 0.5 * 70)) for s in range(CODES**2)]
    ratio = [a - b for a, b in zip(log[True], log[False], strict=True)]
    mean = {k: sum(n * x for n, x in zip(v, ratio, strict=True)) / totals[k] for k, v in seen.items()}
    return Models(ratio, mean[False] + SPLIT * (mean[True] - mean[False]))


def labelled_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Tokens labelled by the base rules, of about ``sample_docs`` documents
    that have matches (their values: random) and as many that have none (their
    identifiers: ordinary), drawn by a hash of the id."""
    rows = docs.select(F.xxhash64(docs[id_col].cast("string")).alias("h"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    found = may_match("assign", F.col("text")) | may_match("access", F.col("text")) | may_match("hex", F.col("text"))
    n = rows.select(found.cast("int").alias("hit")).agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"), F.count("*").alias("all")).first()
    share = lambda k: min(1.0, sample_docs / max(1, k)) * (1 << 20)
    drawn = F.pmod("h", F.lit(1 << 20))
    random = rows.where((drawn < share(n["hits"])) & found).select(F.explode(F.transform(base_spans(F.col("text")), lambda s: s["value"])).alias("token"), F.lit(True).alias("random"))
    plain = rows.where((drawn < share(n["all"] - n["hits"])) & ~found).select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]{4,}"), F.lit(0))).alias("token"), F.lit(False).alias("random"))
    return random.unionByName(plain)


def markov_spans(text: Column, base: Column, models: Models) -> Column:
    """Tokens that no base span covers whole and whose mean log-likelihood ratio
    passes.  One that a base span cuts into is judged and reported whole: its
    rest is as secret as the part a base rule knows."""
    none = F.array().cast(SPAN)
    if math.isinf(models.threshold):
        return none
    table = F.from_json(F.lit(json.dumps([round(x, 6) for x in models.ratio])), "array<double>")

    def mean_ratio(token: Column) -> Column:
        codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), F.ascii)
        walk = F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
                           lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when(acc["last"] >= 0, F.get(table, acc["last"] * CODES + c)).otherwise(0.0)).alias("sum")))
        return walk["sum"] / (F.length(token) - 1)

    free = F.filter(matches(text, TOKEN, len(BASE_KINDS)), lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
    return F.when(text.rlike(TOKEN), F.filter(free, lambda s: mean_ratio(s["value"]) >= models.threshold)).otherwise(none)


def report(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*BASE_KINDS, MARKOV)])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, base, added``: the base rules' and the models' spans of
    every row (start, kind, end, value)."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    return rows.withColumn("added", markov_spans(F.col("text"), F.col("base"), models))


def redact(docs: DataFrame, models: Models, mark: str = "<secret>", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; texts without
    a span, and nulls, stay as they are."""
    text = F.col("text")
    # The row travels in a struct, so no column of the input can clash.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("base", base_spans(text))
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", markov_spans(text, F.col("base"), models))))

    def step(at: Column, s: Column) -> Column:
        gap = F.substr(text, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        parts = F.when(s["start"] >= at, F.array(gap, F.lit(mark))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(at, s["end"]).alias("at"), parts.alias("items"))

    done = once(fold(F.col("spans"), step, "string"), lambda d: F.concat(F.array_join(d["items"], ""), F.substr(text, d["at"] + 1, F.length(text))))
    clean = F.when(F.size("spans") > 0, done).otherwise(F.col("row")[text_col])
    return rows.select(*[(clean if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
