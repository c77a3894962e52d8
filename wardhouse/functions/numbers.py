"""Amounts, quantities and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardhouse.functions.text import as_column

MONEY = "decimal(18,2)"
RATE = "decimal(5,2)"


def parse_money(
    c: Column | str,
    symbols: Sequence[str] = ("VND",),
    strip: str = ", ",
    dot_thousands: bool = False,
) -> Column:
    """Text such as ` 80,000 vnd` as DECIMAL(18,2).

    `dot_thousands=True` also drops a dot before exactly three digits (`200.000` is then 200000, not 200).
    """
    text = F.upper(F.trim(as_column(c).cast("string")))
    for symbol in symbols:
        text = F.replace(text, F.lit(symbol.upper()), F.lit(""))
    if strip:
        text = F.translate(text, strip, "")
    if dot_thousands:
        text = F.regexp_replace(text, r"\.(?=\d{3}(\D|$))", "")
    return text.try_cast(MONEY)


def parse_int(c: Column | str, commas: bool = True) -> Column:
    """Text as INT, cut at the decimal point (`12.7` is 12); with `commas`, trims and drops commas first."""
    text = as_column(c).cast("string")
    text = F.translate(F.trim(text), ",", "") if commas else F.trim(text)
    cut = F.when(text.rlike(r"^[+-]?\d*\.\d*$"), text.try_cast("decimal(38,18)").try_cast("int"))
    return F.coalesce(text.try_cast("int"), cut)


def percent_value(c: Column | str) -> Column:
    """A percentage 0..100 as DOUBLE; values up to 1 count as shares. NULL outside the range."""
    value = F.translate(F.trim(as_column(c).cast("string")), "% ", "").try_cast("double")
    percent = F.when(value <= 1, value * 100).otherwise(value)
    return F.when(percent.between(0, 100), percent)


def parse_rate(c: Column | str) -> Column:
    """`percent_value` as DECIMAL(5,2)."""
    return percent_value(c).try_cast(RATE)


def rate_label(rate: Column | str) -> Column:
    """The label for an unrounded percentage: 28.9 is still 28 %."""
    rate = as_column(rate)
    return F.when(rate == 0, F.lit("Tự chi trả")).otherwise(
        F.concat(F.lit("BHYT "), rate.cast("int").cast("string"), F.lit("%"))
    )


def recover_quantity(quantity: Column | str, price: Column | str, total: Column | str) -> Column:
    """The quantity if positive, else total / price rounded and at least 1, else 1."""
    quantity, price, total = as_column(quantity), as_column(price), as_column(total)
    implied = F.greatest(F.round(total / price, 0).try_cast("int"), F.lit(1))
    return F.when(quantity > 0, quantity).when((total > 0) & (price > 0), implied).otherwise(F.lit(1))


def recover_price(quantity: Column | str, price: Column | str, total: Column | str) -> Column:
    """The price if positive, else total / (recovered) quantity, else 0."""
    quantity, price, total = as_column(quantity), as_column(price), as_column(total)
    return (
        F.when(price > 0, price)
        .when((total > 0) & (quantity > 0), (total / quantity).try_cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY))
    )


def line_amount(quantity: Column | str, price: Column | str) -> Column:
    return (as_column(quantity) * as_column(price)).try_cast(MONEY)


def split_payment(amount: Column | str, rate: Column | str, balanced: bool = False) -> tuple[Column, Column]:
    """(insurance share, patient share). Each is rounded by itself, so both may round up by half a cent;
    `balanced=True` makes the patient share the exact remainder."""
    amount = as_column(amount)
    covered = amount * as_column(rate) / 100
    insurance = covered.try_cast(MONEY)
    patient = (amount - insurance) if balanced else (amount - covered)
    return insurance, patient.try_cast(MONEY)


def human_number(c: Column | str, decimals: int = 0, compact: bool = True) -> Column:
    """`1.50B`, `2.25M`, or digits in groups of three; `compact=False` always groups."""
    value = as_column(c).cast("double")
    grouped = F.format_number(value, decimals)
    if not compact:
        return grouped

    def scaled(unit: float, suffix: str) -> Column:
        return F.concat(F.replace(F.format_number(value / unit, 2), F.lit(","), F.lit("")), F.lit(suffix))

    return F.when(value >= 1e9, scaled(1e9, "B")).when(value >= 1e6, scaled(1e6, "M")).otherwise(grouped)
