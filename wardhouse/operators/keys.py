"""Latest row per key, and surrogate keys that do not depend on the partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Codes fall into 16**4 = 65,536 buckets by the head of their MD5. Hashing keeps the buckets even whatever the
# codes look like, and the fixed number bounds the table of bucket offsets.
BUCKET_DIGITS = 4
# Sparse keys: bucket number times 2**36 plus the place inside the bucket; below 2**52 in all.
PLACE_BITS = 36


def latest_by(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark filters `row_number() = 1` in every map task before the shuffle, so a key with very many copies
    sends one row per task. Give enough order columns to leave no ties.
    """
    window = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def bucket_of(code: str) -> Column:
    return F.substring(F.md5(F.col(code)), 1, BUCKET_DIGITS)


def assign_keys(
    df: DataFrame,
    code_col: str,
    key_col: str,
    existing: DataFrame | None = None,
    dense: bool = True,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Adds `key_col` in front. Codes must be unique and not NULL.

    Keys follow the order (bucket, code), so they are the same for any partitioning or file layout.

    - dense: 1..n without holes. A count per bucket gives the bucket offsets; the running sum is over at most
      65,536 rows. Made for dimensions.
    - not dense: bucket number and place in the bucket, like the built-in increasing id but with a bucket
      that depends on the code alone. Needs no counts, so the input is read once. Made for facts.

    With `existing` (a frame with both columns, made in the same way) known codes keep their key and new codes get
    unused ones. `codes` is the set of codes in `df` where it can be had at less cost; it is what gets counted.
    """
    codes = df if codes is None else codes
    bucket = bucket_of(code_col)
    plain = [F.col(c) for c in df.columns]
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(code_col))
    if existing is None:
        rows = df.select("*", bucket.alias("_bucket"))
        if not dense:
            return rows.select(_sparse_key(place).alias(key_col), *plain)
        counts = codes.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        offsets = _running_offsets(counts)
        return (
            rows.select("*", place.alias("_place"))
            .join(F.broadcast(offsets), "_bucket")
            .select((F.col("_offset") + F.col("_place")).alias(key_col), *plain)
        )

    known = existing.select(code_col, F.col(key_col).cast("long").alias("_known"))
    rows = df.join(known, code_col, "left").select(*plain, "_known", bucket.alias("_bucket"))
    place = F.row_number().over(Window.partitionBy("_bucket", F.col("_known").isNull()).orderBy(code_col))
    rows = rows.select("*", place.alias("_place"))
    if dense:
        new = codes.join(known, code_col, "left_anti")
        counts = new.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
        # The keys in use come first in the running sum, under a name that sorts before every bucket.
        used = known.agg(F.lit("").alias("_bucket"), F.coalesce(F.max("_known"), F.lit(0)).alias("_n"))
        offsets = _running_offsets(used.unionByName(counts))
        fresh = F.col("_offset") + F.col("_place")
    else:
        last = F.max(F.col("_known")) % (1 << PLACE_BITS)
        offsets = known.groupBy(bucket.alias("_bucket")).agg(last.alias("_offset"))
        fresh = _sparse_key(F.col("_place")) + F.coalesce("_offset", F.lit(0))
    return rows.join(F.broadcast(offsets), "_bucket", "left").select(
        F.coalesce("_known", fresh).alias(key_col), *plain
    )


def _sparse_key(place: Column) -> Column:
    return F.conv("_bucket", 16, 10).cast("long") * (1 << PLACE_BITS) + place


def _running_offsets(counts: DataFrame) -> DataFrame:
    """The keys used before each bucket. One row per bucket, so the global window is small by design."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
