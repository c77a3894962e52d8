"""Exact duplicates by deterministic block naming, in DataFrame functions only.

A normalised text is cut into blocks of fixed size. All distinct blocks are sorted and get integer names; then adjacent
names of a text are paired, distinct pairs are sorted and named again, and so on until each text has one name. Equal
names mean equal texts, without any chance of a collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.llm.common import ascii_lower, cut, free_name, join_counted

BLOCK_BYTES = 1024
# Names are ranks within a hash bucket, with the bucket above them, so that no sort needs all rows in one task.
BUCKETS = 1 << 16


def normal(df: DataFrame, text_col: str) -> Column:
    return ascii_lower(F.coalesce(df[text_col].cast("string"), F.lit("")))


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    bucketed = distinct.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys))
    return bucketed.select(*distinct.columns, (F.shiftleft("bucket", 40) + rank).alias("name"))


def _block(i: Column) -> Column:
    return F.substring(F.col("bytes"), i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES))


def _hash(block: Column, mask: int) -> Column:
    return F.xxhash64(block).bitwiseAND(F.lit(mask))


def _positions() -> Column:
    return F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("bytes") / BLOCK_BYTES).cast("int") - 1, F.lit(0)))


def _block_names(texts: DataFrame, mask: int) -> DataFrame:
    """One row per distinct block: its hash, its bytes if another block has the same hash (else null), its name.

    Copies of a block are merged before the shuffle. The set of a hash holds different blocks only, nearly always one.
    """
    blocks = texts.select("bytes", F.explode(_positions()).alias("i")).select(_block(F.col("i")).alias("block"))
    sets = blocks.groupBy(_hash(F.col("block"), mask).alias("hash")).agg(F.collect_set("block").alias("set"))
    alone = F.array(F.lit(None).cast("binary"))
    rows = sets.select("hash", F.explode(F.when(F.size("set") == 1, alone).otherwise(F.col("set"))).alias("block"))
    return _named(rows, "hash", "block")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_mask: int = -1) -> DataFrame:
    """One row per row of `df`: its id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when identical after lowering A-Z; null counts as the empty text, which is equal to itself only. The
    row with the largest id stays; of rows that repeat this id exactly one stays. A null id is smaller than any other;
    a group with null ids only keeps one of them, with a null `keep_id`. Other columns are ignored; no rows give no rows.
    `hash_mask` narrows the hash that blocks are shuffled by (a test forces collisions with it); results do not change.
    """
    texts = df.select(
        F.monotonically_increasing_id().alias("row"), df[id_col].alias("id"), normal(df, text_col).alias("text")
    ).withColumn("bytes", F.col("text").cast("binary"))
    names = cut(_block_names(texts.select("bytes"), hash_mask))
    collided = not names.where("block is not null").isEmpty()

    # The hash finds a block's name unless different blocks share it; only then the bytes are compared as well. Names grow with
    # the texts, while Spark sizes them by a share of a compressed file, several times too low: they are never broadcast.
    columns = [F.transform(_positions(), lambda i: _hash(_block(i), hash_mask)).alias("hashes")]
    if collided:
        columns.append(F.transform(_positions(), _block).alias("blocks"))
    rows = cut(texts.select("row", "id", F.sha2("bytes", 256).alias("sha"), *columns))
    size = F.size("hashes").alias("n")
    if collided:
        parts = rows.select("row", size, F.posexplode(F.arrays_zip("hashes", "blocks")).alias("i", "part"))
        parts = parts.select("row", "n", "i", F.col("part.hashes").alias("hash"), F.col("part.blocks").alias("own"))
        named = parts.join(names.hint("merge"), "hash").where("block is null or block = own")
    else:
        named = rows.select("row", size, F.posexplode("hashes").alias("i", "hash")).join(names.hint("merge"), "hash")
    level, current = 0, cut(named.select("row", "n", "i", "name"))

    done = []
    while True:
        done.append(current.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        rest = current.where("n > 1")
        if rest.isEmpty():
            break
        pairs = rest.groupBy("row", F.expr("(n + 1) div 2").cast("int").alias("n"), F.expr("i div 2").cast("int").alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pair_names = _named(pairs.select("a", "b").distinct(), "a", "b")
        current = cut(pairs.join(pair_names.hint("merge"), ["a", "b"]).select("row", "n", "i", "name"))
        level += 1

    identity = done[0]
    for other in done[1:]:
        identity = identity.unionByName(other)
    members = cut(rows.select("row", "id", "sha").join(identity.hint("merge"), "row"))
    groups = members.groupBy("level", "name").agg(
        F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    return join_counted(members, groups, ["level", "name"], "group_size", members.count()).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    return take(docs, kept.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha")),
                F.sha2(normal(docs, text_col), 256), id_col, text_col)


def take(docs: DataFrame, chosen: DataFrame, digest: Column, id_col: str, text_col: str) -> DataFrame:
    """One row of `docs` for each (id, sha) of `chosen`; `digest` computes a row's sha."""
    key, sha, rank = free_name(docs, "_key"), free_name(docs, "_sha"), free_name(docs, "_rank")
    as_key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    keyed = docs.withColumns({key: as_key(docs[id_col]), sha: digest})
    right = chosen.select(as_key(F.col("id")).alias(key), F.col("sha").alias(sha))
    order = Window.partitionBy(key, sha).orderBy(text_col)
    found = keyed.join(right, [key, sha], "left_semi").withColumn(rank, F.row_number().over(order))
    return found.where(F.col(rank) == 1).select(*docs.columns)
