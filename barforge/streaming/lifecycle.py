"""T6/T7 and the status document of a running pipeline.

* :func:`recover` -- stop the named query if it runs (a missing one is
  fine), check its checkpoint, start it again from there, then run the health checks
  (pipeline status, raw-layer recency, silver lag), like the reference's
  drop-connector / configure / validate sequence.
* :func:`status_from_queries` -- the pipeline status document (M8 input)
  built from live ``StreamingQuery`` handles instead of a REST call.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barforge.operators import checks
from barforge.streaming.state_check import require_sound


def stop_query(spark: SparkSession, name: str) -> bool:
    """Stop the active query called ``name``; False when none was running."""
    for q in spark.streams.active:
        if q.name == name:
            q.stop()
            return True
    return False


def query_state(q: StreamingQuery) -> str:
    if q.isActive:
        return "RUNNING"
    return "FAILED" if q.exception() is not None else "STOPPED"


def status_document(name: str, queries: list[StreamingQuery]) -> str:
    """Status of a pipeline made of ``queries``: the connector is RUNNING when
    every query is, and each query is one task."""
    states = [query_state(q) for q in queries]
    connector = "RUNNING" if states and all(s == "RUNNING" for s in states) else (
        "FAILED" if "FAILED" in states else "STOPPED")
    return json.dumps({"name": name, "connector": {"state": connector},
                       "tasks": [{"id": i, "state": s} for i, s in enumerate(states)]})


def status_from_queries(spark: SparkSession, name: str,
                        queries: list[StreamingQuery]) -> DataFrame:
    """One-row status table (``doc_id``, ``status_json``) for M8."""
    return spark.createDataFrame([(1, status_document(name, queries))],
                                 "doc_id long, status_json string")


def recover(spark: SparkSession, name: str, start: Callable[[], StreamingQuery],
            validate: Callable[[StreamingQuery], DataFrame],
            checkpoint: str | None = None) -> tuple[StreamingQuery, DataFrame]:
    """Restart the pipeline query from its checkpoint and validate it.

    With ``checkpoint`` a damaged one is refused (``DamagedCheckpoint``) before
    anything starts.

    ``start`` must build the query with the same checkpoint location (so it
    resumes where the stopped one left off); ``validate`` receives the new
    query and returns check rows (see :func:`health_checks`).
    """
    stop_query(spark, name)
    if checkpoint:
        require_sound(spark, checkpoint)
    q = start()
    return q, validate(q)


def health_checks(status: DataFrame, bronze: DataFrame, silver: DataFrame, as_of=None) -> DataFrame:
    """The reference's recovery validation: status, then freshness."""
    return checks.health_suite(status, bronze, silver, as_of)
