"""Validity verdicts, quarantine, and repair of references."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardhouse.functions.text import is_blank
from wardhouse.operators.keys import latest_by
from wardhouse.operators.skew import skew_safe_left_join

REASON = "error_reason"


@dataclass(frozen=True)
class Rule:
    """A row passes when `ok` is true; NULL counts as failing."""

    reason: str
    ok: Column


def present(reason: str, column: str) -> Rule:
    """For a cleaned (trimmed) code: neither NULL nor empty."""
    return Rule(reason, F.col(column) != "")


def verdict(rules: Sequence[Rule]) -> Column:
    """The reason of the first failing rule, NULL for a valid row.

    The partition id (never negative) keeps Spark from moving a later filter on the verdict below the cleansing.
    It would compute every cleansing expression a second time there, in methods too long for the JIT compiler.
    """
    reason = F.coalesce(*[F.when(r.ok, F.lit(None)).otherwise(F.lit(r.reason)) for r in rules])
    return F.when(F.spark_partition_id() >= 0, reason)


def with_verdict(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.select("*", verdict(rules).alias(REASON))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASON).isNull()).drop(REASON)


def refused(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASON).isNotNull())


def classify(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Both come from one verdict column, so each row is in exactly one of them."""
    judged = with_verdict(df, rules)
    return accepted(judged), refused(judged)


def fill_from_parent(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    cols: Sequence[str],
    parent_order: Sequence[Column],
    parent_cols: dict[str, str] | None = None,
) -> DataFrame:
    """Blank or NULL `cols` of the child take the value of the latest parent row with the same key.

    `parent_cols` names the parent column where it differs. The parent is cut to one row per key first, so
    the child keeps its row count; a key that many child rows share is salted (see `skew`).
    """
    parent_cols = parent_cols or {}
    renamed = {c: f"_parent_{c}" for c in cols}
    one = latest_by(parent, [key], parent_order).select(
        key, *[F.col(parent_cols.get(c, c)).alias(renamed[c]) for c in cols]
    )
    types = dict(child.dtypes)
    joined = skew_safe_left_join(child, one, key)
    filled = []
    for c in child.columns:
        if c not in renamed:
            filled.append(F.col(c))
            continue
        own = F.when(~is_blank(c), F.col(c)) if types[c] == "string" else F.col(c)
        filled.append(F.coalesce(own, F.col(renamed[c])).alias(c))
    return joined.select(*filled)
