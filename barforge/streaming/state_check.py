"""Is a checkpoint fit to restart from?

Reads what the engine itself wrote: the query's identity, its offset and
commit logs (the newest batches, which is all a restart reads), and, through
Spark's state data sources, every state store at the last committed batch.  A
damaged checkpoint is reported before a query starts on it, rather than by a
query that fails or, worse, by one that silently begins again.

A checkpoint without a single batch is new and has no problems.  State is read
in full (the stores are as large as the watermark leaves them), by Spark tasks,
one a store partition.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from barforge.streaming import storage as st

#: How many of the newest batches of each log are read.
NEWEST = 10
PROBLEMS_DDL = "part string, problem string"
# Log versions the engine writes, and the entry of a source
# that has no offset yet.
VERSIONS, NO_OFFSET = ("v1", "v2"), "-"
# A failed state read reaches Python as either, by the place it failed at.
UNREADABLE = (PySparkException, Py4JJavaError)


class DamagedCheckpoint(RuntimeError):
    """A checkpoint that must not be restarted from."""


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = [f.rsplit("/", 1)[-1] for f in st.list_files(spark, folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _texts(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Small files by name, read by Spark from whatever file system holds them."""
    if not paths:
        return {}
    rows = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("f"), "value").collect()
    found = {r.f.rsplit("/", 1)[-1]: r.value for r in rows}
    return {p.rsplit("/", 1)[-1]: found.get(p.rsplit("/", 1)[-1], "") for p in paths}


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def _log_problems(name: str, texts: dict[str, str], least_lines: int) -> list[tuple[str, str]]:
    found = []
    for batch, text in texts.items():
        lines = text.splitlines()
        if not lines or lines[0] not in VERSIONS or len(lines) < least_lines:
            found.append((name, f"batch {batch} is cut short"))
        elif not all(line == NO_OFFSET or _is_json(line) for line in lines[1:]):
            found.append((name, f"batch {batch} is not readable"))
    return found


def _state_variables(operator: Row) -> list[dict]:
    """Reader options that cover an operator's stores: one set, or one for
    each state variable of an operator that keeps named ones."""
    properties = json.loads(operator.operatorProperties or "{}")
    variables = properties.get("stateVariables")
    if not variables:
        return [{}]
    listed = json.loads(variables) if isinstance(variables, str) else variables
    return [{"stateVarName": v["stateName"]} for v in listed if not v["stateName"].startswith("$")]


def _state_problems(spark: SparkSession, checkpoint: str, committed: int) -> list[tuple[str, str]]:
    found = []
    # A session that has not run a stream yet has no coordinator for its state
    # stores; asking for its streams makes one.
    spark.streams.active
    try:
        operators = spark.read.format("state-metadata").load(checkpoint).dropDuplicates(["operatorId", "stateStoreName"]).collect()
    except UNREADABLE as e:
        return [("state", f"metadata is not readable: {_first_line(e)}")]
    for op in operators:
        for options in _state_variables(op):
            name = f"operator {op.operatorId}, {options.get('stateVarName', op.stateStoreName)}"
            reader = spark.read.format("statestore").option("operatorId", op.operatorId).option("batchId", committed)
            if not options and op.stateStoreName != "default":
                reader = reader.option("storeName", op.stateStoreName)
            try:
                reader.options(**options).load(checkpoint).write.format("noop").mode("overwrite").save()
            except UNREADABLE as e:
                found.append(("state", f"{name} is not readable: {_first_line(e)}"))
    return found


def _first_line(e: Exception) -> str:
    text = e.java_exception.getMessage() if isinstance(e, Py4JJavaError) else str(e)
    return (text or type(e).__name__).splitlines()[0][:200]


def checkpoint_problems(spark: SparkSession, checkpoint: str) -> list[tuple[str, str]]:
    """What is wrong with a checkpoint, as (part, problem); empty when sound."""
    offsets, commits = (_numbers(spark, f"{checkpoint}/{log}") for log in ("offsets", "commits"))
    if not offsets and not commits:
        return []
    found = []
    if not _is_json(_texts(spark, [f"{checkpoint}/metadata"])["metadata"] if st.exists(spark, f"{checkpoint}/metadata") else ""):
        found.append(("metadata", "the query's identity is missing or not readable"))
    if not offsets or (commits and commits[-1] not in (offsets[-1], offsets[-1] - 1)):
        found.append(("offsets", f"last planned batch {offsets[-1] if offsets else 'none'}, last committed {commits[-1] if commits else 'none'}"))
    for name, numbers, lines in (("offsets", offsets, 3), ("commits", commits, 2)):
        newest = numbers[-NEWEST:]
        if newest and newest[-1] - newest[0] + 1 != len(newest):
            found.append((name, f"batches between {newest[0]} and {newest[-1]} are missing"))
        found += _log_problems(name, _texts(spark, [f"{checkpoint}/{name}/{n}" for n in newest]), lines)
    if not commits and len(offsets) > 1:
        found.append(("commits", "no batch is committed although several were planned"))
    if not found and commits and st.exists(spark, f"{checkpoint}/state"):
        found += _state_problems(spark, checkpoint, commits[-1])
    return found


def checkpoint_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The problems as rows (none when the checkpoint is sound)."""
    return spark.createDataFrame(checkpoint_problems(spark, checkpoint), PROBLEMS_DDL)


def require_sound(spark: SparkSession, checkpoint: str) -> None:
    """Raise :class:`DamagedCheckpoint` unless a query may restart from it."""
    found = checkpoint_problems(spark, checkpoint)
    if found:
        raise DamagedCheckpoint(f"{checkpoint}: " + "; ".join(f"{part}: {problem}" for part, problem in found))
