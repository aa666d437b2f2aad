from conftest import trade
from pyspark.sql import functions as F

from barforge.operators.admission import admit_trades, filter_symbols, parse_symbols, to_keyed


def split(spark, messages):
    df = spark.createDataFrame(list(enumerate(messages)), "offset long, value string")
    a, q = admit_trades(df)
    return ({r.offset for r in a.collect()}, {r.offset: r.reason for r in q.collect()}, a)


def test_wrapped_and_bare_admit_the_same_payload(spark):
    body = trade(t=5)
    ok, bad, a = split(spark, [body, '{"data":' + body + '}'])
    assert ok == {0, 1} and not bad
    keyed = to_keyed(a).select("key", F.get_json_object("value", "$.t").alias("t")).collect()
    assert {(r.key, r.t) for r in keyed} == {("BTCUSDT", "5")}


def test_rejections_carry_their_reason_in_rule_order(spark):
    msgs = [
        "{bad",                                  # 0 malformed
        "[1,2]",                                 # 1 not an object
        trade(E=None).replace('"E"', '"x"'),     # 2 E missing
        trade(E="1704067200000"),                # 3 E as text
        trade(T="bad", E=1704067200005),         # 4 T text
        trade(s=None),                           # 5 symbol missing
        trade(s=12),                             # 6 symbol numeric
        trade(E=True),                           # 7 a flag is not a time
        trade(E=10 ** 20),                       # 8 out of range
        trade(t="abc", p="N/A"),                 # 9 t/p are not checked here
    ]
    ok, bad, _ = split(spark, msgs)
    assert ok == {9}
    assert bad == {0: "malformed_json", 1: "malformed_json", 2: "bad_E", 3: "bad_E",
                   4: "bad_T", 5: "bad_symbol", 6: "bad_symbol", 7: "bad_E", 8: "bad_E"}


def test_symbol_subscription(spark):
    df = spark.createDataFrame([("BTCUSDT",), ("ETHUSDT",), ("btcusdt",)], "symbol string")
    assert filter_symbols(df, parse_symbols(None)).count() == 2
    assert filter_symbols(df, parse_symbols("ethusdt, btcusdt")).count() == 3
