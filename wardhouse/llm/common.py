"""Helpers shared by the operators: text normal forms, folds, written intermediate tables, Arrow mapping."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardhouse.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# So many keys may be called hot and be broadcast (`join_counted`).
HOT_KEYS = 1000

# ASCII other than letters and digits separates words; A-Z are lowered.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def portions(texts: list[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts in turn, whole, in lists that end once they hold `most` bytes: what is made of a batch is more than it."""
    at = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield texts[at : k + 1]
            at, held = k + 1, 0
    if at < len(texts):
        yield texts[at:]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lowered and nothing else. `lower` does exactly that to texts without other letters, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)).cast("int")


def text_bytes(df: DataFrame, text_col: str) -> Column:
    return F.coalesce(df[text_col].cast("string"), F.lit("")).cast("binary")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    return f"{scratch_dir(spark)}/llm/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Writes `df` to the shared scratch folder and reads it back: no step before it runs again, even if executors
    are lost, and values made from row order are fixed."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.parquet(folder, compression="zstd")
    return spark.read.schema(df.schema).parquet(folder)


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], size: str, rows: int) -> DataFrame:
    """Inner join with `right`, which has one row per key and in column `size` the number of the key's rows in `left`.

    Keys with a share of 1 / HOT_KEYS or more of all `rows` are at most HOT_KEYS many, so they are met by broadcast; the
    other keys go through the shuffle, and none of them is more than that share of it.
    """
    hot = F.col(size) * HOT_KEYS >= rows
    met = left.join(F.broadcast(right.where(hot)), keys, "left")
    rare = met.where(F.col(size).isNull()).select(*left.columns).join(right.where(~hot), keys)
    return met.where(F.col(size).isNotNull()).unionByName(rare)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def arrow_flow(df: DataFrame, flow: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """`flow` turns a task's batches into columns by name, as often as it likes."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in flow(b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    def as_array(values, kind: pa.DataType) -> pa.Array:
        if isinstance(values, pa.Array):
            return values if values.type == kind else values.cast(kind)
        return pa.array(values, kind)

    return df.mapInArrow(run, fields)


def arrow_map(df: DataFrame, per_task: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """`per_task()` makes a task's function (with its caches); that function turns a batch into columns by name."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        step = per_task()
        for batch in batches:
            yield step(batch)

    return arrow_flow(df, flow, schema)


def carried(df: DataFrame, id_col: str, carry: bool) -> tuple[Column, T.StructField]:
    """What a mapped row keeps of its origin: its id as column `id`, or all its columns as the struct `id`."""
    column = F.struct(*[df[c] for c in df.columns]) if carry else df[id_col]
    return column.alias("id"), T.StructField("id", df.select(column.alias("id")).schema["id"].dataType)
