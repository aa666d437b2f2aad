"""DuckDB SQL twins of the registered plans (the correctness oracle).

Written independently of the Spark code: the fixture rules are restated in
SQL, JSON is read with DuckDB's JSON functions, and exact decimals are
computed with integer arithmetic where DuckDB would fall back to DOUBLE.
Tables ``events``, ``orders`` and ``supplier`` are the driver's views.
"""

from __future__ import annotations

from barforge.plans.catalog import (LOG_ROOT, METERING_AS_OF, METERING_WAREHOUSE, RUN_ID, SUBSCRIBED,
                                    TRADES_AS_OF)
from barforge.sources.fixtures import (BASE_MS, COMPRESSION, COPY_SHIFT_MS, OTHER_SYMBOL,
                                       SYMBOL_BY_EVENT_TYPE, TOPIC)

AS_OF = f"TIMESTAMP '{TRADES_AS_OF}'"
MIN_MS, MAX_MS = -62135596800000, 253402300799999


def _num(text: str) -> str:
    return f"TRY_CAST(TRY_CAST({text} AS DECIMAL(38,0)) AS BIGINT)"


def _ts(ms: str) -> str:
    return f"CASE WHEN ({ms}) BETWEEN {MIN_MS} AND {MAX_MS} THEN epoch_ms({ms}) END"


def _jtime(doc: str, key: str) -> str:
    return _ts(_num(f"json_extract_string({doc}, '$.{key}')"))


def _strict_int(doc: str, key: str) -> str:
    return f"CAST(round(CAST(json_extract_string({doc}, '$.{key}') AS DECIMAL(38,0))) AS BIGINT)"


_SYM = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SYMBOL_BY_EVENT_TYPE.items())
_SHIFT = " ".join(f"WHEN {k} THEN {v}" for k, v in COPY_SHIFT_MS.items())

RAW = f"""
ev AS (
  SELECT event_id AS id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms FROM events
),
cp AS (
  SELECT *, 0 AS copy FROM ev
  UNION ALL SELECT *, 1 AS copy FROM ev WHERE id % 10 = 0
  UNION ALL SELECT *, 2 AS copy FROM ev WHERE id % 50 = 0
),
st1 AS (
  SELECT id, user_id, copy,
    {BASE_MS} + (ms - {BASE_MS}) // {COMPRESSION} AS tt,
    CASE copy {_SHIFT} END AS shift,
    CASE WHEN id % 107 = 0 THEN NULL WHEN id % 109 = 0 THEN 'createTime'
         WHEN id % 113 = 0 THEN 'CREATETIME' ELSE 'CreateTime' END AS meta_key,
    CASE WHEN id % 101 = 0 THEN NULL ELSE CASE event_type {_SYM} ELSE '{OTHER_SYMBOL}' END END AS symbol,
    CAST(round(value * 100) AS BIGINT) AS cents
  FROM cp
),
st2 AS (
  SELECT *, tt + 5 + id % 20 + CASE WHEN meta_key IS NULL THEN shift ELSE 0 END AS e_ms FROM st1
),
st3 AS (
  SELECT *,
    CASE WHEN meta_key IS NOT NULL THEN e_ms + 50 + shift END AS create_ms,
    CASE WHEN id % 97 = 0 THEN 'N/A' ELSE CAST(cents // 100 AS VARCHAR) || '.'
      || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || lpad(CAST(id % 1000000 AS VARCHAR), 6, '0') END AS price_text,
    CAST(user_id % 10 + copy AS VARCHAR) || '.' || lpad(CAST(id * 7919 % 100000000 AS VARCHAR), 8, '0') AS qty_text,
    id * 3 + copy AS msg_offset
  FROM st2
),
raw AS (
  SELECT id, copy, symbol, msg_offset, coalesce(create_ms, e_ms) AS sent_ms,
    '{{"e":"trade","E":' || CAST(e_ms AS VARCHAR)
      || CASE WHEN symbol IS NULL THEN '' ELSE ',"s":"' || symbol || '"' END
      || ',"t":' || CAST(id AS VARCHAR)
      || ',"p":"' || price_text || '","q":"' || qty_text || '"'
      || ',"b":' || CAST(1000000 + id AS VARCHAR) || ',"a":' || CAST(2000000 + id AS VARCHAR)
      || ',"T":' || CASE WHEN id % 103 = 0 THEN '"bad"' ELSE CAST(tt AS VARCHAR) END
      || ',"m":' || CASE WHEN id % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS content,
    '{{' || CASE WHEN meta_key IS NULL THEN '' ELSE '"' || meta_key || '":' || CAST(create_ms AS VARCHAR) || ',' END
      || '"topic":"{TOPIC}","partition":0,"offset":' || CAST(msg_offset AS VARCHAR) || '}}' AS metadata
  FROM st3
)"""

PARSED = f"""
parsed AS (
  SELECT
    json_extract_string(content, '$.e') AS event_type,
    {_jtime('content', 'E')} AS event_time,
    json_extract_string(content, '$.s') AS symbol,
    {_strict_int('content', 't')} AS trade_id,
    TRY_CAST(json_extract_string(content, '$.p') AS DECIMAL(38,18)) AS price,
    TRY_CAST(json_extract_string(content, '$.q') AS DECIMAL(38,18)) AS quantity,
    {_strict_int('content', 'b')} AS buyer_order_id,
    {_strict_int('content', 'a')} AS seller_order_id,
    {_jtime('content', 'T')} AS trade_time,
    CAST(json_extract_string(content, '$.m') AS BOOLEAN) AS is_maker,
    coalesce({_jtime('metadata', 'CreateTime')}, {_jtime('metadata', 'createTime')},
             {_jtime('metadata', 'CREATETIME')}, {_jtime('content', 'E')},
             {_jtime('content', 'T')}) AS ingested_at,
    copy
  FROM raw
),
valid AS (
  SELECT * FROM parsed
  WHERE symbol IS NOT NULL AND trade_id IS NOT NULL AND trade_time IS NOT NULL
    AND price IS NOT NULL AND quantity IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, trade_id ORDER BY
    ingested_at DESC NULLS LAST, event_time DESC NULLS LAST, trade_time DESC NULLS LAST,
    quantity DESC NULLS LAST, price DESC NULLS LAST, event_type DESC NULLS LAST,
    buyer_order_id DESC NULLS LAST, seller_order_id DESC NULLS LAST, is_maker DESC NULLS LAST) AS rn
  FROM valid
),
silver AS (
  SELECT event_type, event_time, symbol, trade_id, price, quantity, buyer_order_id,
         seller_order_id, trade_time, is_maker, ingested_at, CAST(trade_time AS DATE) AS trade_date
  FROM ranked WHERE rn = 1
)"""

PARSED_COLS = ("event_type, event_time, symbol, trade_id, price, quantity, buyer_order_id,"
               " seller_order_id, trade_time, is_maker, ingested_at")

_E18 = "CAST(1000000000000000000 AS HUGEINT)"


def _bars(source: str) -> str:
    """Gold bars over ``source``; the mean is rounded half-up at scale 18
    with integer arithmetic (DuckDB's decimal AVG is DOUBLE)."""
    return f"""
  SELECT symbol, minute_bucket, trade_count, total_quantity, total_notional,
    CAST(CAST(avg_u // {_E18} AS VARCHAR) || '.' || lpad(CAST(avg_u % {_E18} AS VARCHAR), 18, '0')
         AS DECIMAL(38,18)) AS avg_price,
    min_price, max_price, first_trade_time, last_trade_time
  FROM (
    SELECT symbol, date_trunc('minute', trade_time) AS minute_bucket,
      count(*) AS trade_count,
      sum(quantity) AS total_quantity,
      sum(CAST(price AS DECIMAL(19,9)) * CAST(quantity AS DECIMAL(18,9))) AS total_notional,
      (2 * sum(CAST(replace(CAST(price AS VARCHAR), '.', '') AS HUGEINT)) + count(*)) // (2 * count(*)) AS avg_u,
      min(price) AS min_price, max(price) AS max_price,
      min(trade_time) AS first_trade_time, max(trade_time) AS last_trade_time
    FROM {source}
    GROUP BY symbol, date_trunc('minute', trade_time)
  ) b"""


GOLD = f"gold AS ({_bars('silver')}\n)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _check(name: str, observed: str, threshold: str, passed: str, detail: str, source: str) -> str:
    return (f"SELECT '{name}' AS check_name, CAST({observed} AS DOUBLE) AS observed,"
            f" CAST({threshold} AS DOUBLE) AS threshold, coalesce({passed}, false) AS passed,"
            f" {detail} AS detail FROM {source}")


def _dup_check(rel: str) -> str:
    return _check("silver_no_duplicates", "n", "0", "n = 0", "'keys held by several rows: ' || CAST(n AS VARCHAR)",
                  f"(SELECT count(*) AS n FROM (SELECT symbol, trade_id FROM {rel}"
                  " GROUP BY symbol, trade_id HAVING count(*) > 1) g) c")


def _null_check(rel: str) -> str:
    return _check("silver_not_nulls", "n", "0", "n = 0",
                  "'rows with a missing required field: ' || CAST(n AS VARCHAR)",
                  f"(SELECT count(*) AS n FROM {rel} WHERE symbol IS NULL OR trade_id IS NULL"
                  " OR trade_time IS NULL OR price IS NULL OR quantity IS NULL) c")


def _activity_check(min_rows: int = 10, now: str = AS_OF) -> str:
    return _check("silver_recent_activity", "n", str(min_rows), f"n >= {min_rows}",
                  "'rows in last 5 min: ' || CAST(n AS VARCHAR)",
                  f"(SELECT count(*) AS n FROM silver WHERE trade_time >= {now} - INTERVAL 5 MINUTE) c")


BRONZE_T = f"bronze_t AS (SELECT {_jtime('content', 'T')} AS t FROM raw)"


def _bronze_check(minutes: int = 5) -> str:
    return _check("bronze_recent_rows", "n", "0", "n > 0",
                  f"'rows in last {minutes} min: ' || CAST(n AS VARCHAR) || ', latest trade time '"
                  " || coalesce(strftime(latest, '%Y-%m-%d %H:%M:%S.%g'), 'none')",
                  f"(SELECT count(*) AS n, max(t) AS latest FROM bronze_t"
                  f" WHERE t >= {AS_OF} - INTERVAL {minutes} MINUTE) c")


def _lag_check() -> str:
    return _check("silver_lag", "lag", "600", "lag IS NOT NULL AND lag <= 600",
                  "'silver lag seconds: ' || coalesce(CAST(lag AS VARCHAR), 'unknown')",
                  f"(SELECT datediff('second', max(ingested_at), {AS_OF}) AS lag FROM silver) c")


STATUS = """
status_docs AS (
  SELECT s_suppkey AS doc_id,
    '{"name":"trades-sink","connector":{"state":"'
      || CASE WHEN s_suppkey % 7 = 0 THEN 'FAILED' ELSE 'RUNNING' END || '"}'
      || CASE WHEN s_suppkey % 11 = 0 THEN ''
              WHEN s_suppkey % 5 = 0 THEN ',"tasks":[]'
              WHEN s_suppkey % 3 = 0 THEN ',"tasks":[{"id":0,"state":"RUNNING"},{"id":1,"state":"PAUSED"}]'
              ELSE ',"tasks":[{"id":0,"state":"RUNNING"}]' END || '}' AS status_json
  FROM supplier
),
status_eval AS (
  SELECT doc_id, state, n_tasks, bad,
    CASE WHEN state IS DISTINCT FROM 'RUNNING'
           THEN 'pipeline reports ' || coalesce(state, 'no state')
         WHEN n_tasks = 0 THEN 'pipeline lists no task'
         WHEN len(bad) > 0 THEN 'a task reports ' || coalesce(bad[1], 'no state')
         ELSE 'pipeline and tasks up' END AS detail,
    (state IS NOT DISTINCT FROM 'RUNNING') AND n_tasks > 0 AND len(bad) = 0 AS passed
  FROM (
    SELECT doc_id,
      json_extract_string(status_json, '$.connector.state') AS state,
      coalesce(json_array_length(status_json, '$.tasks'), 0) AS n_tasks,
      coalesce(list_filter(json_extract_string(status_json, '$.tasks[*].state'),
                           lambda x: x IS DISTINCT FROM 'RUNNING'), []) AS bad
    FROM status_docs
  ) s
)"""


def _status_row(where: str = "") -> str:
    return ("SELECT 'connector_status' AS check_name, CAST(n_tasks AS DOUBLE) AS observed,"
            " CAST(1 AS DOUBLE) AS threshold, passed, detail FROM status_eval" + where)


def _suite(name: str, parts: list[str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{name}' AS suite, {i + 1} AS ord, * FROM ({p}) p{i}"
                              for i, p in enumerate(parts))
    return f"""SELECT suite, ord, check_name, observed, threshold, passed, detail,
      coalesce(bool_or(NOT passed) OVER (PARTITION BY suite ORDER BY ord
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped
    FROM ({rows}) u"""


LATEST_STATUS = " WHERE doc_id = (SELECT max(doc_id) FROM status_eval)"

ADMISSION = f"""
messages AS (
  SELECT msg_offset, sent_ms, symbol AS key,
    CASE WHEN id % 211 = 0 THEN '{{bad' WHEN id % 3 = 0 THEN '{{"data":' || content || '}}'
         ELSE content END AS message
  FROM raw
),
unwrapped AS (
  SELECT msg_offset, sent_ms, key, json_valid(message) AS ok,
    CASE WHEN json_valid(message) AND json_type(message) = 'OBJECT'
         THEN json_extract(message, '$.data') IS NOT NULL ELSE false END AS wrapped,
    CASE WHEN NOT json_valid(message) THEN NULL
         WHEN json_type(message) = 'OBJECT' AND json_extract(message, '$.data') IS NOT NULL
           THEN json_extract(message, '$.data')
         ELSE CAST(message AS JSON) END AS payload
  FROM messages
),
classified AS (
  SELECT *,
    CASE WHEN payload IS NULL OR json_type(payload) <> 'OBJECT' THEN 'malformed_json'
         WHEN NOT coalesce(json_type(payload, '$.E') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
              AND TRY_CAST(json_extract_string(payload, '$.E') AS DOUBLE) BETWEEN {MIN_MS} AND {MAX_MS}, false)
           THEN 'bad_E'
         WHEN NOT coalesce(json_type(payload, '$.T') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
              AND TRY_CAST(json_extract_string(payload, '$.T') AS DOUBLE) BETWEEN {MIN_MS} AND {MAX_MS}, false)
           THEN 'bad_T'
         WHEN NOT coalesce(json_type(payload, '$.s') = 'VARCHAR', false) THEN 'bad_symbol'
    END AS reason
  FROM unwrapped
),
admitted AS (
  SELECT msg_offset AS "offset", key, wrapped,
    json_extract_string(payload, '$.s') AS symbol,
    {_num("json_extract_string(payload, '$.E')")} AS event_ms,
    {_num("json_extract_string(payload, '$.T')")} AS trade_ms,
    payload, sent_ms
  FROM classified WHERE reason IS NULL
)"""

_SUBS = ", ".join(f"'{s}'" for s in SUBSCRIBED)

METERING = f"""
metering AS (
  SELECT 'WH_' || CAST(o_custkey % 4 AS VARCHAR) AS warehouse_name,
    CAST(o_orderdate AS TIMESTAMP) AS start_time,
    CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DECIMAL(20,2)) / 1000000 AS DECIMAL(20,6)) AS credits_used
  FROM orders
)"""

_CREDITS = _check(
    "daily_credits", "credits", "100.0", "CAST(credits AS DOUBLE) <= 100.0",
    f"'credits since day start for {METERING_WAREHOUSE}: ' || CAST(credits AS VARCHAR)",
    f"(SELECT coalesce(sum(credits_used), 0) AS credits FROM metering"
    f" WHERE warehouse_name = '{METERING_WAREHOUSE}'"
    f" AND start_time >= date_trunc('day', TIMESTAMP '{METERING_AS_OF}')) c")

_QUALITY = _suite("data_quality", [_null_check("silver"), _dup_check("silver"), _activity_check()])
_HEALTH = _suite("healthcheck", [_status_row(LATEST_STATUS), _bronze_check(), _lag_check()])
_QUALITY_100 = _suite("data_quality", [_null_check("silver"), _dup_check("silver"), _activity_check(100)])

_NOW = "(now() AT TIME ZONE 'UTC')"


def _reject(key: str, test: str, reason: str) -> str:
    text = f"json_extract_string(c3, '$.{key}')"
    return (f"SELECT msg_offset AS \"offset\", '{key}' AS field, {text} AS value, '{reason}' AS reason"
            f" FROM bad3 WHERE {text} IS NOT NULL AND TRY_CAST({text} AS {test}) IS NULL")


REJECTS = f"""
bad1 AS (SELECT *, CASE WHEN id % 89 = 0 THEN replace(content, '"t":' || CAST(id AS VARCHAR) || ',', '"t":"abc",') ELSE content END AS c1 FROM raw),
bad2 AS (SELECT *, CASE WHEN id % 83 = 0 THEN replace(c1, '"m":', '"m":"maybe","x":') ELSE c1 END AS c2 FROM bad1),
bad3 AS (SELECT *, CASE WHEN id % 79 = 0 THEN replace(c2, '"b":', '"b":"none","y":') ELSE c2 END AS c3 FROM bad2),
rejects AS ({" UNION ALL ".join(_reject(k, t, r) for k, t, r in (
    ("t", "DECIMAL(38,0)", "not a number"), ("b", "DECIMAL(38,0)", "not a number"),
    ("a", "DECIMAL(38,0)", "not a number"), ("m", "BOOLEAN", "not a flag")))})"""


def _exact_bars() -> str:
    """Products of 18-decimal factors in whole units of 10^-18: high and low
    halves in HUGEINT, the low product rounded half up."""
    return """
WITH t AS (
  SELECT event_type AS symbol, event_id AS id,
    CAST(event_id AS HUGEINT) * 1000003 AS pw, (CAST(event_id AS HUGEINT) * 123456789012345677) % 1000000000000000000 AS pf,
    CAST(event_id % 97 AS HUGEINT) AS qw, (CAST(event_id AS HUGEINT) * 987654321098765431) % 1000000000000000000 AS qf
  FROM events),
p AS (
  SELECT *, pf // 1000000000 AS ph, pf % 1000000000 AS pl, qf // 1000000000 AS qh, qf % 1000000000 AS ql FROM t),
n AS (
  SELECT symbol, id, (pw * qw) * 1000000000000000000 + pw * qf + pf * qw
    + (ph * qh + (ph * ql + pl * qh + (pl * ql) // 1000000000 + 500000000) // 1000000000) AS units
  FROM p)
SELECT symbol, count(*) AS trade_count, CAST(sum(units) AS VARCHAR) AS notional_units FROM n GROUP BY symbol"""


SILVER_SQL = f"{_with(RAW, PARSED)} SELECT * FROM silver"
GOLD_SQL = f"{_with(RAW, PARSED, GOLD)} SELECT * FROM gold"

ORACLE: dict[str, str] = {
    "admit_trades": f"{_with(RAW, ADMISSION)} SELECT \"offset\", key, wrapped, symbol, event_ms, trade_ms FROM admitted",
    "quarantined_trades": f"{_with(RAW, ADMISSION)} SELECT msg_offset AS \"offset\", key, reason FROM classified WHERE reason IS NOT NULL",
    "subscribed_trades": f"{_with(RAW, ADMISSION)} SELECT \"offset\", key, wrapped, symbol, event_ms, trade_ms FROM admitted WHERE lower(symbol) IN ({_SUBS})",
    "keyed_trades": f"{_with(RAW, ADMISSION)} SELECT json_extract_string(payload, '$.s') AS key, CAST(json_extract_string(payload, '$.t') AS BIGINT) AS trade_id, json_extract_string(payload, '$.q') AS quantity_text FROM admitted",
    "bronze_ingest": f"{_with(RAW, ADMISSION)} SELECT \"offset\", sent_ms AS create_ms, symbol, CAST(json_extract_string(payload, '$.t') AS BIGINT) AS trade_id, json_extract_string(payload, '$.q') AS quantity_text FROM admitted",
    "parse_trades": f"{_with(RAW, PARSED)} SELECT {PARSED_COLS} FROM parsed",
    "valid_trades": f"{_with(RAW, PARSED)} SELECT {PARSED_COLS} FROM valid",
    "silver_trades": SILVER_SQL,
    "gold_trades_1m": GOLD_SQL,
    "dup_key_groups": f"{_with(RAW, PARSED)} {_dup_check('silver')}",
    "dup_key_groups_valid": f"{_with(RAW, PARSED)} {_dup_check('valid')}",
    "null_rows": f"{_with(RAW, PARSED)} {_null_check('silver')}",
    "null_rows_parsed": f"{_with(RAW, PARSED)} {_null_check('parsed')}",
    "recent_activity": f"{_with(RAW, PARSED)} {_activity_check()}",
    "bronze_recency": f"{_with(RAW, BRONZE_T)} {_bronze_check()}",
    "clamped_recency": f"{_with(RAW, BRONZE_T)} {_bronze_check(1)}",
    "activity_now": f"{_with(RAW, PARSED)} {_activity_check(now=_NOW)}",
    "cast_rejects": f"{_with(RAW, REJECTS)} SELECT \"offset\", field, value, reason FROM rejects",
    "exact_bars": _exact_bars(),
    "silver_lag": f"{_with(RAW, PARSED)} {_lag_check()}",
    "layer_lag": f"""{_with(RAW, PARSED, GOLD, BRONZE_T)}
      SELECT bronze_latest, silver_latest, gold_latest,
        datediff('second', bronze_latest, {AS_OF}) AS bronze_lag_seconds,
        datediff('second', silver_latest, {AS_OF}) AS silver_lag_seconds,
        datediff('second', gold_latest, {AS_OF}) AS gold_lag_seconds
      FROM (SELECT (SELECT max(t) FROM bronze_t) AS bronze_latest,
                   (SELECT max(ingested_at) FROM silver) AS silver_latest,
                   (SELECT max(minute_bucket) FROM gold) AS gold_latest) x""",
    "daily_summary": f"""{_with(RAW, PARSED, GOLD, BRONZE_T)}
      SELECT bronze_rows, silver_rows, gold_buckets,
        'Daily summary (24h): bronze rows ' || CAST(bronze_rows AS VARCHAR) || ', silver rows '
          || CAST(silver_rows AS VARCHAR) || ', gold 1m buckets ' || CAST(gold_buckets AS VARCHAR) AS message
      FROM (SELECT
        (SELECT count(*) FROM bronze_t WHERE t >= {AS_OF} - INTERVAL 1 DAY) AS bronze_rows,
        (SELECT count(*) FROM silver WHERE trade_time >= {AS_OF} - INTERVAL 1 DAY) AS silver_rows,
        (SELECT count(*) FROM gold WHERE minute_bucket >= {AS_OF} - INTERVAL 1 DAY) AS gold_buckets) x""",
    "daily_credits": f"{_with(METERING)} {_CREDITS}",
    "pipeline_status": f"{_with(STATUS)} SELECT doc_id, 'connector_status' AS check_name, CAST(n_tasks AS DOUBLE) AS observed, CAST(1 AS DOUBLE) AS threshold, passed, detail FROM status_eval",
    "quality_suite": f"{_with(RAW, PARSED)} {_QUALITY}",
    "health_suite": f"{_with(RAW, PARSED, BRONZE_T, STATUS)} {_HEALTH}",
    "check_failures": f"""{_with(RAW, PARSED, BRONZE_T, STATUS)}
      SELECT suite, check_name AS task, '{RUN_ID}' AS run_id, detail AS error,
        '{LOG_ROOT}/' || suite || '/' || check_name || '/{RUN_ID}' AS log_link
      FROM ({_QUALITY_100} UNION ALL {_HEALTH}) r WHERE NOT passed AND NOT skipped""",
    "quality_until_failure": f"""{_with(RAW, PARSED)}
      SELECT suite, ord, check_name, CASE WHEN NOT skipped THEN observed END AS observed, threshold, CASE WHEN NOT skipped THEN passed END AS passed,
        CASE WHEN skipped THEN 'not run' ELSE detail END AS detail, skipped
      FROM ({_suite('data_quality', [_null_check('valid'), _dup_check('valid'), _activity_check()])}) s""",
    "silver_incremental": SILVER_SQL,
    "gold_incremental": GOLD_SQL,
    "backfill_gold": GOLD_SQL,
    "recover_gold": GOLD_SQL,
    "stream_bars_update": f"{_with(RAW, PARSED)} {_bars('(SELECT * FROM valid WHERE copy = 0)')}",
    # A bar is final once the watermark (ten minutes behind) passes its end.
    "stream_bars_append": f"{_with(RAW, PARSED)} SELECT * FROM ({_bars('(SELECT * FROM valid WHERE copy = 0)')}) b"
                          " WHERE minute_bucket + INTERVAL 1 MINUTE <= (SELECT max(trade_time) FROM valid) - INTERVAL 10 MINUTE",
    "registered_layers": f"""{_with(RAW, ADMISSION, PARSED.replace('FROM raw', 'FROM raw WHERE id % 211 <> 0'), GOLD)}
      SELECT 'raw' AS layer, count(*) AS n, CAST(min(trade_ms) AS BIGINT) AS low FROM admitted
      UNION ALL SELECT 'silver', count(*), CAST(epoch_ms(min(trade_time)) AS BIGINT) FROM silver
      UNION ALL SELECT 'gold', count(*), CAST(epoch_ms(min(first_trade_time)) AS BIGINT) FROM gold""",
    # Messages broken on the wire (every copy of id % 211 = 0) never reach
    # the raw layer; every other rejected message is invalid for silver too.
    "ingest_to_gold": f"{_with(RAW, PARSED.replace('FROM raw', 'FROM raw WHERE id % 211 <> 0'), GOLD)} SELECT * FROM gold",
}
ORACLE["ledger_layer_lag"] = ORACLE["layer_lag"]
ORACLE["ledger_checks"] = f"{_with(RAW, PARSED)} SELECT * FROM ({_lag_check()}) l UNION ALL SELECT * FROM ({_activity_check()}) a"
ORACLE["ingest_rejects"] = (f"{_with(RAW, ADMISSION, REJECTS)} SELECT \"offset\", field, value, reason FROM rejects"
                            " WHERE \"offset\" IN (SELECT \"offset\" FROM admitted)")
ORACLE["late_settled_bars"] = (f"{GOLD_SQL} WHERE minute_bucket + INTERVAL 1 MINUTE"
                               " <= (SELECT max(trade_time) FROM valid) - INTERVAL 10 MINUTE")
