"""Exact ``price * quantity`` at scale 18.

Spark types decimal(38,18) * decimal(38,18) as decimal(38,6), which drops
twelve digits.  Two pure-Catalyst forms keep them:

* fast form -- both factors fit decimal(19,9) and decimal(18,9) exactly, so
  the product is decimal(38,18) with nothing lost;
* general form -- both factors as whole part and 18-digit fraction, and the
  product counted in units of 10^-18 in whole-number decimals of 38 digits,
  which additions never round.  Fraction times fraction is the single place
  that rounds (half up), which equals rounding the exact product.

A product that does not fit decimal(38,18) is NULL; nothing raises.

Sums do not go through products of rows in the general form: ``with_limbs``
and ``limb_total`` add whole-number limbs in the hash aggregate and carry them
once a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "decimal(38,18)"


UNITS = 10 ** 18


def negated(x: Column) -> Column:
    """``-x`` of a decimal(38,18).  Spark's minus rounds to 34 digits, so values
    of more than 16 whole digits go by their text."""
    text = x.cast("string")
    by_text = F.when(x < 0, F.substr(text, F.lit(2))).otherwise(F.concat(F.lit("-"), text))
    bound = F.lit("1" + "0" * 16).cast(RESULT)
    return F.when((x < bound) & (x > -bound), -x).otherwise(by_text.cast(RESULT))


def _whole(n: int, precision: int) -> Column:
    return F.lit(str(n)).cast(f"decimal({precision},0)")


def _split(x: Column) -> tuple[Column, Column]:
    """Whole part (20 digits at most) and fraction in units of 10^-18."""
    ax = F.abs(x)
    fraction = (ax % _whole(1, 1)).cast("decimal(18,18)") * _whole(UNITS, 19)
    return F.floor(ax).cast("decimal(20,0)"), fraction.cast("decimal(18,0)")


def _from_units(n: Column) -> Column:
    """A whole number of units of 10^-18 as decimal(38,18), by its text (a
    division would round): zeros after the sign, a point before the last
    eighteen digits.  ``n`` occurs once, which keeps the generated code small."""
    padded = F.regexp_replace(n.cast("string"), "^(-?)", "$1" + "0" * 18)
    return F.regexp_replace(padded, "(.{18})$", ".$1").try_cast(RESULT)


def _general_units(price: Column, quantity: Column) -> Column:
    """The product in units of 10^-18 (general form), signed; NULL out of range."""
    pw, pf = _split(price)
    qw, qf = _split(quantity)
    whole = F.try_multiply(F.try_multiply(pw, qw), _whole(UNITS, 19))
    mixed = F.try_add(F.try_multiply(pw, qf), F.try_multiply(pf, qw))
    rounded = F.call_function("div", pf * qf + _whole(UNITS // 2, 18), _whole(UNITS, 19)).cast("decimal(19,0)")
    units = F.try_add(F.try_add(whole, mixed), rounded)
    return F.when((price < 0) != (quantity < 0), -units).otherwise(units)


def _forms(price: Column, quantity: Column) -> tuple[Column, Column]:
    """Fast form where both factors fit nine decimals (else NULL), and the
    general form's units where they do not."""
    p9, q9 = price.try_cast("decimal(19,9)"), quantity.try_cast("decimal(18,9)")
    fits = F.coalesce((p9 == price) & (q9 == quantity), F.lit(False))
    return F.when(fits, (p9 * q9).cast(RESULT)), F.when(~fits, _general_units(price, quantity))


def exact_product(price: Column, quantity: Column) -> Column:
    """``price * quantity`` rounded half up at scale 18, row by row."""
    exact, units = _forms(price, quantity)
    return F.coalesce(exact, _from_units(units))


#: Columns that ``with_limbs`` adds and ``limb_total`` sums.
LIMBS = ("_exact", "_units")


def with_limbs(df: DataFrame, price: str = "price", quantity: str = "quantity") -> DataFrame:
    """``df`` with a row's product as limbs to be summed: ``_exact`` where the
    fast form holds it, else ``_units``, a whole number of 10^-18 in which the
    single product has had its rounding.  A projection of its own, so that
    each is evaluated once however many sums read it."""
    exact, units = _forms(F.col(price), F.col(quantity))
    return df.select("*", exact.alias("_exact"), units.alias("_units"))


def limb_total(sign: Column | None = None) -> Column:
    """Aggregate: the sum of the products whose limbs ``with_limbs`` made,
    each times ``sign``.  Whole numbers are summed (units in base 10^18, so a
    group of 10^10 rows cannot overflow a limb), then carried and set to scale
    18 once a group.  NULL when a product or the total is out of range."""
    times = (lambda x: x) if sign is None else (lambda x: F.when(sign < 0, -x).otherwise(x))
    base = _whole(UNITS, 19)
    low = (F.col("_units") % base).cast("decimal(18,0)")
    high = ((F.col("_units") - F.col("_units") % base) / base).cast("decimal(20,0)")
    product = F.col("_exact")
    exact = F.try_sum(product if sign is None else F.when(sign < 0, negated(product)).otherwise(product))
    known = F.count("_exact") + F.count("_units") == F.count(F.lit(1))
    whole = F.try_multiply(F.try_sum(times(high)).try_cast("decimal(38,0)"), base)
    units = F.try_add(whole, F.try_sum(times(low)).cast("decimal(38,0)"))
    # A sum of exact products in units: its text without the point.
    exact_units = F.replace(exact.cast("string"), F.lit("."), F.lit("")).try_cast("decimal(38,0)")
    both = F.when(F.count("_exact") == 0, units).otherwise(F.try_add(units, exact_units))
    return F.when(known, F.when(F.count("_units") == 0, exact).otherwise(_from_units(both)))
