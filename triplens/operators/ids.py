"""Surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplens.session import cut, stored

# monotonically_increasing_id keeps the partition in the bits above these.
_ROW_BITS = 33


def dense_ids(rows: DataFrame, key: str, id_column: str) -> DataFrame:
    """Number rows 0, 1, 2, … in the order of ``key``, which must be unique.

    Range partitions are sorted in parallel and stored; each row then gets its partition's
    start plus its place in the partition. Only the table of starts, one row per partition,
    ever meets in one task.
    """
    placed = cut(
        rows.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    row = F.col("_place") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return placed.join(F.broadcast(starts), "_part").select(
        *rows.columns, (F.col("_start") + row).alias(id_column)
    )


def hashed_ids(rows: DataFrame, key: str, id_column: str, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Number rows by a hash of ``key``, which must be unique: (numbered, exceptions).

    Whoever knows the key knows the id, so tables are encoded without a join. Of keys with one hash
    the smallest keeps it; the others get a hash of their own, tried until it is free, and are
    listed in ``exceptions`` (key, id): at 64 bits a handful among 10**10 keys.
    """
    numbered = stored(rows.withColumn(id_column, hashed(key, bits)).withColumn("_tries", F.lit(0)), "ids")
    tries = 0
    while True:
        # Only the ids are moved to find those that keys share; the keys of these few are looked at then.
        shared = numbered.groupBy(id_column).agg(F.count(F.lit(1)).alias("_n"))
        shared = cut(shared.where("_n > 1").select(id_column))
        if shared.isEmpty():
            exceptions = numbered.where("_tries > 0").select(key, id_column)
            return numbered.drop("_tries"), exceptions
        # Who has an id keeps it before those that come later.
        order = F.struct("_tries", key)
        shared = cut(numbered.join(shared, id_column).groupBy(id_column).agg(F.min(order).alias("_first")))
        tries += 1
        marked = numbered.join(shared, id_column, "left")
        moves = F.coalesce(order != F.col("_first"), F.lit(False))
        numbered = stored(marked.select(
            *rows.columns,
            F.when(moves, hashed(key, bits, tries)).otherwise(F.col(id_column)).alias(id_column),
            F.when(moves, tries).otherwise(F.col("_tries")).alias("_tries"),
        ), "ids")


def hashed(key: str, bits: int = 64, attempt: int = 0) -> Column:
    """The id of a key that is no exception."""
    value = F.xxhash64(key, F.lit(attempt)) if attempt else F.xxhash64(key)
    return value if bits == 64 else F.shiftrightunsigned(value, 64 - bits)
