"""License scans: an Aho-Corasick automaton finds notice phrases and identifier
tags; a shunting-yard parser evaluates the tags' and/or/with expressions.

Texts stream through ``mapInArrow`` one Arrow batch at a time; nothing is
shuffled.  A null text counts as empty: zero words, no label, score 0.  Repeated
rows each get their own result; columns of the input other than the id and the
text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrase -> label of the base scan.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Further notice phrases of the method.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
}
TAG = "spdx license identifier"
#: Families of identifier stems, and the families that ask for no source disclosure.
FAMILIES = ("mit", "apache", "agpl", "lgpl", "gpl", "bsd", "mpl", "epl", "cc-by", "cc0", "bsl", "isc", "unlicense")
PERMISSIVE = {"mit", "apache", "bsd", "bsl", "isc", "unlicense", "cc0", "cc-by"}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, n_notices long, expressions array<string>, n_invalid long, permissive boolean"
)

#: Lower-cases A-Z, keeps digits and bytes of non-ASCII characters, blanks the rest.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
_LEVEL = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """License family of an identifier such as ``GPL-3.0-or-later``."""
    low = identifier.lower()
    return next((f for f in FAMILIES if low == f or low.startswith((f + "-", f + "+"))), low)


def to_postfix(text: str) -> list[str] | None:
    """Shunting-yard: the expression in postfix order, None if malformed."""
    out: list[str] = []
    ops: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(text):
        low = token.lower()
        if low in _LEVEL:
            if operand_next:
                return None
            while ops and ops[-1] != "(" and _LEVEL[ops[-1]] >= _LEVEL[low]:
                out.append(ops.pop())
            ops.append(low)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            ops.append(token)
        elif token == ")":
            while ops and ops[-1] != "(":
                out.append(ops.pop())
            if operand_next or not ops:
                return None
            ops.pop()
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in ops:
        return None
    return out + ops[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """(families named, whether the terms can be met by permissive licences
    alone): ``or`` needs one side, ``and`` both, ``with`` lifts its left side's
    copyleft as an exception does."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token in _LEVEL:
            (b, fb), (a, fa) = stack.pop(), stack.pop()
            stack.append((a, True) if token == "with" else (a | b, fa or fb if token == "or" else fa and fb))
        else:
            f = family(token)
            stack.append(({f}, f in PERMISSIVE))
    return stack[0]


def expression_at(text: bytes, end: int) -> str:
    """The expression that follows a tag: rest of its line, to the last token
    that still continues a well-formed expression."""
    line = text[end:].split(b"\n", 1)[0].decode("utf-8", "replace").lstrip(" \t:-")
    kept: list[str] = []
    operand_next, depth = True, 0
    for m in re.finditer(r"[()]|[A-Za-z0-9.+:-]+|\S", line):
        token, low = m[0], m[0].lower()
        if low in _LEVEL and not operand_next:
            operand_next = True
        elif token == "(" and operand_next:
            depth += 1
        elif token == ")" and depth:
            depth -= 1
        elif operand_next and _TOKEN.fullmatch(token) and token not in "()":
            operand_next = False
        else:
            break
        kept.append(token)
    return " ".join(kept).rstrip(".")


def build_automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for phrase, label in [*notices.items(), *base.items()]:
        words = phrase.encode().translate(_FOLD).split()
        key = " " + b" ".join(words).decode("latin-1") + " "
        auto.add_word(key, ("base" if phrase in base else "notice", label, len(key)))
    auto.add_word(f" {TAG} ", ("tag", "", 0))
    auto.make_automaton()
    return auto


def scan(text: str | None, auto: ahocorasick.Automaton) -> tuple:
    """One text's row of ``SCHEMA`` without the id."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_FOLD).split()
    hay = " " + b" ".join(words).decode("latin-1") + " "
    base, extra, starts, tags = set(), set(), [], 0
    n_notices = 0
    for end, (kind, label, size) in auto.iter(hay):
        if kind == "base":
            base.add(label)
            starts.append(end - size + 1)
        elif kind == "notice":
            extra.add(label)
            n_notices += 1
        else:
            tags += 1
    shown, invalid, permissive = [], 0, None
    if tags:
        for m in re.finditer(rb"spdx[^0-9a-z\x80-\xff]+license[^0-9a-z\x80-\xff]+identifier(?=[^0-9a-z\x80-\xff]|$)", raw.lower()):
            expression = expression_at(raw, m.end())
            postfix = to_postfix(expression)
            if postfix is None:
                invalid += 1
                continue
            named, ok = evaluate(postfix)
            extra |= named
            shown.append(expression)
            permissive = ok if permissive is None else permissive and ok
    places = [hay.count(" ", 0, s) for s in ((min(starts), max(starts)) if starts else ())]
    n = len(starts) + n_notices + 2 * len(shown)
    first, last = places if places else (None, None)
    return (len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | extra)),
            1.0 - 0.5**n, n_notices, shown, invalid, permissive)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """``SCHEMA`` for every row of ``docs``: places of the base phrases (words
    counted from 0), labels, expressions found after identifier tags, and
    whether all of them can be met by permissive licences."""
    base, notices = base or BASE_PHRASES, notices or NOTICE_PHRASES
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                        ("n_notices", pa.int64()), ("expressions", pa.list_(pa.string())), ("n_invalid", pa.int64()), ("permissive", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build_automaton(base, notices)
        for batch in batches:
            rows = [scan(t.as_py(), auto) for t in batch.column(1)]
            columns = [batch.column(0), *map(list, zip(*rows, strict=True))] if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return narrow.mapInArrow(run, SCHEMA)
