"""F1-F8: case-sensitive reads from semi-structured payloads, with the
strict and safe casts the raw layer needs.

All helpers build Catalyst expressions over a VARIANT column; nothing here
runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barforge.functions.timefn import epoch_ms_to_ntz


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(key: str) -> str:
    """Path of a top-level key.  Bracket form keeps odd characters safe."""
    if key.isidentifier():
        return f"$.{key}"
    return "$['" + key.replace("'", "\\'") + "']"


def json_string(v: Column | str, key: str, strict: bool = True) -> Column:
    """``v:key::string`` -- numbers and flags come back as their text."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(_col(v), json_path(key), "string")


def json_bigint(v: Column | str, key: str, strict: bool = True) -> Column:
    """``v:key::number`` at scale 0.

    Going through ``decimal(38,0)`` rounds 1.5 to 2 (a direct bigint read
    truncates).  Strict raises on text that is not a number; permissive
    gives NULL so the row falls out of the validity filter instead.
    """
    if strict:
        return F.variant_get(_col(v), json_path(key), "decimal(38,0)").cast("bigint")
    return F.try_variant_get(_col(v), json_path(key), "decimal(38,0)").try_cast("bigint")


def json_boolean(v: Column | str, key: str, strict: bool = True) -> Column:
    """``v:key::boolean``."""
    fn = F.variant_get if strict else F.try_variant_get
    return fn(_col(v), json_path(key), "boolean")


def try_to_number(text: Column) -> Column:
    """TRY_TO_NUMBER(text) at scale 0 -- rounds fractional values, NULL on junk."""
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def try_to_decimal(text: Column, precision: int = 38, scale: int = 18) -> Column:
    """TRY_TO_DECIMAL(text, p, s) -- NULL on junk, empty text or overflow."""
    return text.try_cast(f"decimal({precision},{scale})")


def json_epoch_ms(v: Column | str, key: str) -> Column:
    """Safe epoch-milliseconds read: text of the value, then TRY_TO_NUMBER."""
    return try_to_number(json_string(v, key, strict=False))


def json_time_ntz(v: Column | str, key: str) -> Column:
    """F7 over F5: TO_TIMESTAMP_NTZ(TRY_TO_NUMBER(v:key::string), 3)."""
    return epoch_ms_to_ntz(json_epoch_ms(v, key))


def json_kind(v: Column | str, key: str) -> Column:
    """Type name of a member (``BIGINT``, ``DECIMAL(p,s)``, ``DOUBLE``,
    ``STRING``, ``BOOLEAN``, ...); NULL when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(_col(v), json_path(key), "variant"))


def is_json_number(v: Column | str, key: str) -> Column:
    """True when the member is a JSON number (not a numeric string, not a flag)."""
    kind = json_kind(v, key)
    return (kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
            | kind.startswith("DECIMAL"))


def has_key(v: Column | str, key: str) -> Column:
    """Key presence: true for ``{"k": null}``, false when the key is missing."""
    return F.try_variant_get(_col(v), json_path(key), "variant").isNotNull()
