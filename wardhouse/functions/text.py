"""Codes, names, categories and statuses."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_code(c: Column | str) -> Column:
    return F.upper(F.trim(as_column(c)))


def clean_name(c: Column | str) -> Column:
    """One blank between words, each word capitalised."""
    return F.initcap(F.lower(F.trim(F.regexp_replace(as_column(c), r"\s+", " "))))


def clean_status(c: Column | str, missing: str = "UNKNOWN") -> Column:
    return clean_code(F.coalesce(as_column(c), F.lit(missing)))


def is_blank(c: Column | str) -> Column:
    """True for NULL and for text of blanks only; never NULL."""
    return F.coalesce(F.trim(as_column(c)) == "", F.lit(True))


def standardize(
    c: Column | str,
    labels: Mapping[str, Iterable[str]],
    default: Column | str | None = None,
) -> Column:
    """The label whose variants hold the lower-cased, trimmed value.

    Without a match the result is `default` (a constant or a column), or the value in `clean_name` form.
    The labels become one literal map, so the plan stays small however many variants there are.
    """
    c = as_column(c)
    pairs = {variant: label for label, variants in labels.items() for variant in variants}
    # JSON carries the map in one constant, which Spark turns into a literal map while planning.
    lookup = F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")
    if default is None:
        default = clean_name(c)
    elif isinstance(default, str):
        default = F.lit(default)
    return F.coalesce(F.try_element_at(lookup, F.lower(F.trim(c))), default)
