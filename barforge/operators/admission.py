"""Envelope unwrap, trade admission with quarantine, keyed
serialisation and the symbol subscription filter.

One bad message never fails the job: parsing uses ``try_parse_json`` and
every rule is a Catalyst predicate, so rejects become rows with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.functions.jsonpath import has_key, is_json_number, json_kind
from barforge.functions.once import evaluate_once
from barforge.functions.timefn import MAX_EPOCH_MS, MIN_EPOCH_MS

# Quarantine reasons in the order the rules are applied, and
# the default subscription.
REASONS = ("malformed_json", "bad_E", "bad_T", "bad_symbol")
DEFAULT_SYMBOLS = ("btcusdt",)


def unwrap_envelope(df: DataFrame, column: str = "value", out: str = "payload") -> DataFrame:
    """Parse the message; when the object has a ``data`` key, the payload
    is that member, otherwise the object itself.  Unparsable text -> NULL."""
    parsed = evaluate_once(df, F.try_parse_json(F.col(column)).alias("_msg"))
    msg = F.col("_msg")
    wrapped = has_key(msg, "data")
    unwrapped = F.when(wrapped, F.try_variant_get(msg, "$.data", "variant")).otherwise(msg)
    return evaluate_once(parsed, wrapped.alias("wrapped"), unwrapped.alias(out)).drop("_msg")


def _time_ok(p: Column, key: str) -> Column:
    ms = F.try_variant_get(p, f"$.{key}", "double")
    return is_json_number(p, key) & ms.between(float(MIN_EPOCH_MS), float(MAX_EPOCH_MS))


def classify(df: DataFrame, payload: str = "payload") -> DataFrame:
    """S2 rule: first failing reason, or NULL when the trade is admitted.

    ``E`` and ``T`` must be JSON numbers inside the representable date range
    (numeric text and flags are rejected); ``s`` must be a string.
    ``t, p, q, b, a, m`` are not checked here.
    """
    p = F.col(payload)
    is_object = F.coalesce(F.schema_of_variant(p), F.lit("")).startswith("OBJECT")
    reason = (F.when(p.isNull() | ~is_object, F.lit(REASONS[0]))
              .when(~F.coalesce(_time_ok(p, "E"), F.lit(False)), F.lit(REASONS[1]))
              .when(~F.coalesce(_time_ok(p, "T"), F.lit(False)), F.lit(REASONS[2]))
              .when(~F.coalesce(json_kind(p, "s") == "STRING", F.lit(False)), F.lit(REASONS[3])))
    return df.withColumn("reason", reason)


def admit_trades(messages: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split messages into (admitted, quarantined).

    Both outputs keep the input columns; admitted rows gain ``payload``
    (VARIANT, unwrapped) and ``wrapped``; quarantined rows gain ``reason``.
    """
    tagged = classify(unwrap_envelope(messages, column))
    admitted = tagged.filter(F.col("reason").isNull()).drop("reason")
    quarantined = tagged.filter(F.col("reason").isNotNull()).drop("payload")
    return admitted, quarantined


def to_keyed(admitted: DataFrame, payload: str = "payload") -> DataFrame:
    """S3: (key = symbol, value = payload as JSON text)."""
    p = F.col(payload)
    return admitted.select(F.variant_get(p, "$.s", "string").alias("key"),
                           F.to_json(p).alias("value"))


def filter_symbols(df: DataFrame, symbols=DEFAULT_SYMBOLS, column: str = "symbol") -> DataFrame:
    """Keep the subscribed symbols (configured lower case, matched case-blind)."""
    wanted = [s.strip().lower() for s in symbols if s.strip()]
    return df.filter(F.lower(F.col(column)).isin(wanted))


def parse_symbols(config: str | None) -> tuple[str, ...]:
    """The comma list of the subscription setting; default ``btcusdt``."""
    if not config:
        return DEFAULT_SYMBOLS
    return tuple(s.strip().lower() for s in config.split(",") if s.strip())
