"""Inner joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplens.session import cut

# A key is hot when it holds more than this share of the rows or more rows than a task should
# read. So at most 200 keys and one per ROWS_PER_TASK rows are hot.
HOT_SHARE = 0.005
ROWS_PER_TASK = 50_000_000
# Sub-keys of a hot key at least; more when its rows need more tasks.
SALTS = 32


def salts_of(count: Column, total: Column, share: float = HOT_SHARE) -> Column:
    """Sub-keys for a key with ``count`` of ``total`` rows; null if it is not hot."""
    hot = (count > F.lit(share) * total) | (count > ROWS_PER_TASK)
    return F.when(hot, F.greatest(F.lit(SALTS), F.ceil(count / ROWS_PER_TASK)).cast("int"))


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Hot keys of ``df`` with the number of their sub-keys (_salts).

    The count combines on the map side, so a hot key costs its task one row per input
    partition; the total is summed from the same shuffled counts. The bound on the result is
    arithmetic, which makes it safe to broadcast. The few keys found are stored, so using them
    on both sides of a join does not count again.
    """
    counts = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_n"))
    salted = counts.withColumn("_salts", salts_of(F.col("_n"), total.scalar(), share))
    return cut(salted.where("_salts IS NOT NULL").select(*keys, "_salts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner equi join of ``big`` and ``small`` on ``keys``.

    Rows of ``big`` under a hot key are spread over its sub-keys by a hash of the whole
    row (stable under task retries); only the matching rows of ``small`` are repeated. All
    other rows join under salt 0. ``hot`` may be passed when the counts are already known.
    """
    hot = hot_keys(big, keys) if hot is None else hot
    marks = F.broadcast(hot.select(*keys, "_salts"))
    row_hash = F.xxhash64(*[F.col(name) for name in big.columns])
    spread = big.join(marks, keys, "left").withColumn(
        "_salt", F.coalesce(F.pmod(row_hash, F.col("_salts")), F.lit(0)).cast("int")
    ).drop("_salts")
    repeated = small.join(marks, keys, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
        ),
    ).drop("_salts")
    return spread.join(repeated, [*keys, "_salt"]).drop("_salt")
