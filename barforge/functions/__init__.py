"""Scalar expression helpers (pure Catalyst, no Python per row)."""

from barforge.functions.decimal import exact_product
from barforge.functions.jsonpath import (has_key, is_json_number, json_bigint, json_boolean,
                                         json_epoch_ms, json_kind, json_path, json_string,
                                         json_time_ntz, try_to_decimal, try_to_number)
from barforge.functions.timefn import (clamp_window, day_bucket, day_start, epoch_ms_to_ntz,
                                       epoch_ntz, minus_days, minus_minutes, minute_bucket,
                                       ntz_epoch_micros, ntz_epoch_seconds, ntz_literal,
                                       seconds_between, since, utc_now)

__all__ = [
    "exact_product", "has_key", "is_json_number", "json_bigint", "json_boolean",
    "json_epoch_ms", "json_kind", "json_path", "json_string", "json_time_ntz",
    "try_to_decimal", "try_to_number", "clamp_window", "day_bucket", "day_start",
    "epoch_ms_to_ntz", "epoch_ntz", "minus_days", "minus_minutes", "minute_bucket",
    "ntz_epoch_micros", "ntz_epoch_seconds", "ntz_literal", "seconds_between", "since",
    "utc_now",
]
