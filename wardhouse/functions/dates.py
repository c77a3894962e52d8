"""Dates, ages and waiting times."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardhouse.functions.numbers import parse_int
from wardhouse.functions.text import as_column

# The accepted date patterns, in order of preference.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "yyyy/MM/dd", "dd-MM-yyyy", "yyyy.MM.dd")

# Age bands (upper ages, labels, label for an unknown year).
AGE_EDGES = (17, 35, 55)
AGE_LABELS = ("0-17", "18-35", "36-55", "56+")
AGE_UNKNOWN = "Không xác định"

_DIGITS, _MARKS = "0123456789", "-/."
_PARTS = ("yyyy", "MM", "dd")


def _digit_shape(c: Column) -> Column:
    """Every digit as 9, so that one comparison tells the layout of a time text."""
    return F.translate(c, _DIGITS, "9" * 10)


def _leading(c: Column) -> Column:
    """A text up to its first inner blank or `T`, where a time of day may follow the date."""
    return F.substring_index(F.translate(F.trim(c), "T", " "), " ", 1)


def parse_date(
    c: Column | str,
    formats: Sequence[str] = DATE_FORMATS,
    fallbacks: Sequence[Column | str] = (),
    strict: bool = False,
) -> Column:
    """The date that the first fitting pattern gives, else the day of the first usable fall-back time.

    Day and month may have one digit, and what follows the date (a time of day) is ignored; `strict` wants the pattern
    in full and nothing else. Years have four digits. Patterns of year, month and day are brought to ISO order and
    cast once. That avoids one failed (exception-raising) parse per pattern and row; others go through `try_to_date`.
    """
    c = as_column(c)
    text = c if strict else _leading(c)
    marks = F.translate(text, _DIGITS, "")
    dashed = F.translate(text, "/.", "--")
    pieces = (
        F.substring_index(dashed, "-", 1),
        F.substring_index(F.substring_index(dashed, "-", 2), "-", -1),
        F.substring_index(dashed, "-", -1),
    )
    layouts: dict[tuple, list[str]] = {}
    compact, others = [], []
    for fmt in formats:
        order = tuple(sorted(range(3), key=lambda k: fmt.find(_PARTS[k])))
        between = re.sub("[yMd]", "", fmt)
        if any(fmt.count(part) != 1 for part in _PARTS) or between not in ("", "--", "//", ".."):
            others.append(F.try_to_date(c, fmt))
        elif between:
            layouts.setdefault(order, []).append(between)
        else:
            places = [fmt.index(part) + 1 for part in _PARTS]
            whole = [F.substring(text, at, len(part)) for at, part in zip(places, _PARTS)]
            compact.append(((marks == "") & (F.length(text) == 8), F.concat_ws("-", *whole)))
    iso = F
    for order, between in layouts.items():
        year, month, day = (pieces[order.index(k)] for k in range(3))
        # The cast takes one or two digits for month and day, and no more.
        fits = marks.isin(*between) & (F.length(year) == 4)
        if strict:
            fits = fits & (F.length(text) == 10) & (F.length(month) == 2)
        iso = iso.when(fits, dashed if order == (0, 1, 2) else F.concat_ws("-", year, month, day))
    for fits, value in compact:
        iso = iso.when(fits, value)
    parsed = [iso.try_cast("date")] if layouts or compact else []
    late = [as_column(f).try_cast("timestamp").cast("date") for f in fallbacks]
    return F.coalesce(*parsed, *others, *late)


def _exact_timestamp(c: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss`, else NULL; what follows, such as parts of a second, is ignored."""
    c = F.left(c.cast("string"), F.lit(19))
    return F.when(_digit_shape(c) == "9999-99-99 99:99:99", c.try_cast("timestamp"))


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, not below 0; 0 when either time is unusable."""
    seconds = F.unix_seconds(_exact_timestamp(as_column(end))) - F.unix_seconds(_exact_timestamp(as_column(start)))
    # Dates far apart must not overflow INT; `least` would skip a NULL, so the default comes first.
    minutes = F.least(F.coalesce(seconds, F.lit(0)) / 60, F.lit(float(2**31 - 1)))
    return F.greatest(minutes, F.lit(0.0)).cast("int")


def current_day(as_of: dt.date | str | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def birth_year(year: Column | str, born: Column | str, as_of: dt.date | str | None = None) -> Column:
    """The given year, else the year of the birth date; NULL outside 1900..today."""
    found = F.coalesce(parse_int(year, commas=False), F.year(parse_date(born)))
    return F.when(found.between(F.lit(1900), F.year(current_day(as_of))), found)


def bucketize(
    value: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    null_label: str,
) -> Column:
    """The label of the first edge that the value does not exceed; the last label beyond all edges."""
    value = as_column(value)
    band = F.when(value.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        band = band.when(value <= edge, F.lit(label))
    return band.otherwise(F.lit(labels[-1]))


def age_band(year: Column | str, as_of: dt.date | str | None = None) -> Column:
    return bucketize(F.year(current_day(as_of)) - as_column(year), AGE_EDGES, AGE_LABELS, AGE_UNKNOWN)


def date_key(c: Column | str) -> Column:
    """20260131 for 2026-01-31."""
    c = as_column(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def date_from_key(c: Column | str) -> Column:
    return parse_date(as_column(c).cast("string"), formats=("yyyyMMdd",))
