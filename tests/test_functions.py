import datetime as dt
from decimal import ROUND_HALF_UP, Context, Decimal

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barforge.functions.decimal import limb_total, negated, with_limbs
from barforge.functions import (epoch_ms_to_ntz, exact_product, json_bigint, json_string,
                                json_time_ntz, minute_bucket, ntz_epoch_micros, seconds_between,
                                try_to_decimal, try_to_number)


def one(spark, col, sql_rows="1 AS x"):
    return spark.sql(f"SELECT {sql_rows}").select(col.alias("r")).first().r


def v(text):
    return F.parse_json(F.lit(text))


def test_keys_are_case_sensitive(spark):
    doc = v('{"e":"trade","E":5,"t":7,"T":9}')
    row = spark.range(1).select(json_string(doc, "e").alias("e"), json_string(doc, "E").alias("E"),
                                json_bigint(doc, "t").alias("t"), json_bigint(doc, "T").alias("T")).first()
    assert (row.e, row.E, row.t, row.T) == ("trade", "5", 7, 9)


def test_strict_integer_cast(spark):
    assert one(spark, json_bigint(v('{"t":"12"}'), "t")) == 12
    assert one(spark, json_bigint(v('{"t":1.5}'), "t")) == 2
    assert one(spark, json_bigint(v('{"x":1}'), "t")) is None
    assert one(spark, json_bigint(v('{"t":"abc"}'), "t", strict=False)) is None
    with pytest.raises(Exception):
        spark.range(1).select(json_bigint(v('{"t":"abc"}'), "t")).collect()


def test_safe_number_and_decimal(spark):
    assert one(spark, try_to_number(F.lit("1704067200123.6"))) == 1704067200124
    assert one(spark, try_to_number(F.lit("bad"))) is None
    assert one(spark, try_to_decimal(F.lit("N/A"))) is None
    assert one(spark, try_to_decimal(F.lit(""))) is None
    assert one(spark, try_to_decimal(F.lit("1" * 21))) is None
    assert one(spark, try_to_decimal(F.lit("0." + "1" * 18 + "5"))) == Decimal("0." + "1" * 17 + "2")


def test_epoch_ms_to_ntz(spark):
    assert one(spark, epoch_ms_to_ntz(F.lit(1704067200123))) == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert one(spark, epoch_ms_to_ntz(F.lit(10 ** 17))) is None
    assert one(spark, json_time_ntz(v('{"T":"bad"}'), "T")) is None
    assert one(spark, json_time_ntz(v('{"T":"1704067200000"}'), "T")) == dt.datetime(2024, 1, 1)


def test_minute_bucket_and_boundaries(spark):
    t = F.lit("2024-01-01 10:01:00").cast("timestamp_ntz")
    assert one(spark, minute_bucket(t)) == dt.datetime(2024, 1, 1, 10, 1)
    a = F.lit("2024-01-01 00:00:00.9").cast("timestamp_ntz")
    b = F.lit("2024-01-01 00:00:01.1").cast("timestamp_ntz")
    assert one(spark, seconds_between(a, b)) == 1


def test_time_helpers_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        t = F.lit("2024-03-10 02:30:17.5").cast("timestamp_ntz")   # inside the DST gap
        assert one(spark, minute_bucket(t)) == dt.datetime(2024, 3, 10, 2, 30)
        assert one(spark, ntz_epoch_micros(t)) == 1710037817500000
        assert one(spark, epoch_ms_to_ntz(F.lit(1710037817500))) == dt.datetime(2024, 3, 10, 2, 30, 17, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _expected(p: Decimal, q: Decimal) -> Decimal:
    ctx = Context(prec=100)
    return ctx.multiply(p, q).quantize(Decimal(1).scaleb(-18), rounding=ROUND_HALF_UP, context=ctx)


decimals8 = st.decimals(min_value=0, max_value=10 ** 6, places=8, allow_nan=False)
decimals18 = st.decimals(min_value=-(10 ** 4), max_value=10 ** 4, places=18, allow_nan=False)


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(decimals8, decimals8), min_size=20, max_size=40),
       st.lists(st.tuples(decimals18, decimals18), min_size=20, max_size=40))
def test_exact_product_matches_decimal(spark, short, long):
    rows = [(str(p), str(q)) for p, q in short + long]
    df = spark.createDataFrame(rows, "p string, q string").select(
        F.col("p").cast("decimal(38,18)").alias("p"), F.col("q").cast("decimal(38,18)").alias("q"))
    got = df.select("p", "q", exact_product(F.col("p"), F.col("q")).alias("n")).collect()
    for r in got:
        assert r.n == _expected(r.p, r.q), (r.p, r.q, r.n)


def test_plain_product_would_lose_digits(spark):
    df = spark.createDataFrame([("1.12345678", "3.87654321")], "p string, q string").select(
        F.col("p").cast("decimal(38,18)").alias("p"), F.col("q").cast("decimal(38,18)").alias("q"))
    r = df.select((F.col("p") * F.col("q")).alias("plain"),
                  exact_product(F.col("p"), F.col("q")).alias("exact")).first()
    assert r.exact == _expected(Decimal("1.12345678"), Decimal("3.87654321"))
    assert r.plain != r.exact


def _limb_sums(spark, rows):
    df = spark.createDataFrame([(k, str(p), str(q)) for k, p, q in rows], "k string, p string, q string").select(
        "k", F.col("p").cast("decimal(38,18)").alias("p"), F.col("q").cast("decimal(38,18)").alias("q"))
    return {r.k: (r.n, r.minus) for r in with_limbs(df, "p", "q").groupBy("k").agg(limb_total().alias("n"), limb_total(F.lit(-1)).alias("minus")).collect()}


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.tuples(st.sampled_from("ab"), decimals8, decimals8), min_size=5, max_size=20),
       st.lists(st.tuples(st.sampled_from("bc"), decimals18, decimals18), min_size=5, max_size=20))
def test_limb_sums_equal_sums_of_rounded_products(spark, short, long):
    """Every row rounded by itself, then added: groups of the fast form, of
    the general form, and of both."""
    rows = short + long
    got = _limb_sums(spark, rows)
    for k in {r[0] for r in rows}:
        want = sum((_expected(p, q) for key, p, q in rows if key == k), Decimal(0))
        assert got[k] == (want, -want)


def test_negation_keeps_every_digit(spark):
    values = [Decimal(v) for v in ("99999999999999999999.999999999999999999", "12345678901234567890.123456789012345678", "10000000000000000",
                                   "9999999999999999.999999999999999999", "0.000000000000000001", "0")]
    values += [v.copy_negate() for v in values] + [None]
    rows = spark.createDataFrame([(v,) for v in values], "v decimal(38,18)").repartition(3).select("v", negated(F.col("v")).alias("n")).collect()
    assert len(rows) == len(values) and all(r.n == (r.v if r.v is None else r.v.copy_negate()) for r in rows)


def test_limb_sums_out_of_range_are_null(spark):
    big, tiny = "99999999999999999999.000000000000000001", "0.000000000000000001"
    rows = [("row", big, "2"), ("row", "1", "1"),              # one product does not fit
            ("sum", big, "1"), ("sum", big, "1"),              # the total does not fit
            ("fits", big, "1"), ("fits", tiny, "0.5"), ("fits", "-" + tiny, "0.4"), ("fits", "-1", "1")]
    got = _limb_sums(spark, rows)
    assert got["row"] == (None, None) and got["sum"] == (None, None)
    assert str(got["fits"][0]) == "99999999999999999998.000000000000000002"


def test_gold_compiles_to_generated_code(spark):
    """The aggregate's code stays small enough to be compiled."""
    from barforge.operators.gold import gold_trades_1m
    silver = spark.range(100).selectExpr("'A' as symbol", "id as trade_id", "cast(id as decimal(38,18)) as price",
                                         "cast(1.5 as decimal(38,18)) as quantity", "timestamp_ntz'2024-01-01 00:00:00' as trade_time")
    old = spark.conf.get("spark.sql.codegen.fallback")
    try:
        spark.conf.set("spark.sql.codegen.fallback", "false")
        assert gold_trades_1m(silver).first().trade_count == 100
    finally:
        spark.conf.set("spark.sql.codegen.fallback", old)
