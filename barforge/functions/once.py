"""Evaluate expensive expressions once per row.

Catalyst substitutes a projected alias into every later use (and into
filters pushed below the projection), so an alias over ``parse_json`` is
re-parsed wherever the value is read.  ``inline(array(struct(...)))`` turns
the expressions into a Generate node: its outputs are real attributes,
computed once per row, and nothing is collapsed or pushed through it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, *columns: Column, keep: bool = True) -> DataFrame:
    """Append (or, with ``keep=False``, return only) the named ``columns``,
    each evaluated a single time per row."""
    bound = F.inline(F.array(F.struct(*columns)))
    return df.select("*", bound) if keep else df.select(bound)
