"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Rounded half up to a whole number, NULL as 0."""
    return F.coalesce(value.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def exact(value: Column, kind: str) -> Column:
    """``value`` as the decimal ``kind``; an error where digits would be lost or don't fit."""
    narrow = value.try_cast(kind)
    fits = value.isNull() | F.coalesce(narrow == value, F.lit(False))
    return F.when(fits, narrow).otherwise(F.raise_error(F.concat(F.lit(f"not a {kind}: "), value.cast("string"))).cast(kind))


def exact_price(price: Column, rate: Column) -> Column:
    """Price times rate with all digits, ``decimal(38,16)``: four digits of a price and twelve of a rate below 10 million."""
    return exact(price, "decimal(18,4)") * exact(rate, "decimal(19,12)")


def exact_total(price: Column, quantity: Column) -> Column:
    """A ``decimal(38,16)`` price times a quantity with all digits, ``decimal(38,20)``; more than 17 whole digits are an error.

    Spark cuts the scale of a product whose types need more than 38 digits, so the whole and the broken
    part of the price are multiplied on their own.
    """
    price, quantity = price.cast("decimal(38,16)"), exact(quantity, "decimal(17,4)")
    part = price % F.lit(1).cast("decimal(1,0)")
    units = exact(price - part, "decimal(20,0)") * quantity
    return exact(units, "decimal(37,20)") + (part * quantity).cast("decimal(37,20)")


def factor_or_one(factor: Column) -> Column:
    return F.coalesce(factor.cast("double"), F.lit(1.0))


def to_unit(value: Column, factor: Column, mode: str = "divide") -> Column:
    """Value in the part's own unit: stock is divided by the factor, prices are multiplied.

    A missing factor counts as 1. The result is a double that is not rounded, so it does not
    depend on an engine's rules for decimal quotients.
    """
    if mode == "divide":
        return value.cast("double") / factor_or_one(factor)
    if mode == "multiply":
        return value.cast("double") * factor_or_one(factor)
    raise ValueError("mode is 'divide' or 'multiply'")


def not_below_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def differs(a: Column, b: Column) -> Column:
    """1 if both are known and differ, else 0."""
    return F.when(a != b, 1).otherwise(0)
