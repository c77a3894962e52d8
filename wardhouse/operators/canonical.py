"""Stable column names over unstable sources."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def normalize_name(name: str) -> str:
    """Lower case, ASCII letters and digits only."""
    return re.sub("[^a-z0-9]", "", name.lower())


def canonicalize(
    df: DataFrame,
    alias_map: Mapping[str, Iterable[str]],
    keep_raw: bool = True,
    cast: str | None = "string",
) -> DataFrame:
    """One select with a column per canonical name.

    A canonical name is filled from the source column that has its name, else from the first alias found;
    names are compared by `normalize_name`, and of two equal ones the later column counts. Names without a
    source become NULL. `keep_raw` keeps the other source columns in front.
    """
    by_name = {normalize_name(c): c for c in df.columns}
    wanted = []
    for canonical, aliases in alias_map.items():
        names = [normalize_name(n) for n in (canonical, *aliases)]
        source = next((by_name[n] for n in names if n in by_name), None)
        value = "NULL" if source is None else _quoted(source)
        target = cast if cast or source else "string"
        wanted.append(f"{f'CAST({value} AS {target})' if target else value} AS {_quoted(canonical)}")
    replaced = {c.lower() for c in alias_map}
    kept = [_quoted(c) for c in df.columns if c.lower() not in replaced] if keep_raw else []
    return df.selectExpr(*kept, *wanted)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
