"""Exact duplicates by a persistent digest index.

The index is a table bucketed and sorted by digest. A new batch is reduced to one row per
digest, anti-joined with the index by sort-merge (the index side needs no shuffle), and what
remains is appended. Only DataFrame functions run here.

Defined results: a null text counts as empty; empty texts are equal to each other; of rows with
equal text and equal (or null) id exactly one stays; an empty table gives no rows; other
columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import WHITE, located, shared_path, stored, table, text_or_empty


class DigestIndex:
    """A catalog table (digest, keep_id, batch), bucketed and sorted by digest.

    ``path`` keeps its files outside the warehouse; the table then is a name for them. A new index takes
    ``buckets`` (the session's shuffle partitions if left out), one that exists keeps those it was made with.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, path: str | None = None):
        self.spark, self.name, self.path = spark, name, path
        self.buckets = self._made_with() or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _made_with(self) -> int | None:
        if not self.spark.catalog.tableExists(self.name):
            return None
        described = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Num Buckets'").first()
        return int(described["data_type"])

    def append(self, rows: DataFrame) -> None:
        """Add rows; each bucket is written by one task, so a batch adds a file per bucket."""
        writer = (
            rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").write
            .format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest")
        )
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.name):
            schema = "digest binary, keep_id bigint, batch string"
            self.append(self.spark.createDataFrame([], schema))
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Drop the name; files under ``path`` stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key: Column | None = None) -> DataFrame:
    """(doc_id, digest, key): SHA-256 of each whole text with every run of white space as one space."""
    plain = F.regexp_replace(text_or_empty(text_column), WHITE, " ")
    key = F.lit(None).cast("string") if key is None else key
    return docs.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(plain, 256)).alias("digest"), key.alias("key"))


def deduplicate(
    docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text",
    batch: str | None = None, key: Column | None = None,
) -> DataFrame:
    """Decide every row of ``docs`` against the index and the batch itself, then extend the index.

    Returns (doc_id, digest, key, keep_id, group_size, kept). ``keep_id`` is the id of the row that
    stays: that of another batch if the index knows the text, else the smallest of the batch. A batch
    with a name can be run again, for instance after its driver was lost: what an earlier run of it added to the
    index counts as its own, so the same rows are kept, and nothing is added twice.
    ``group_size`` counts the batch's rows of the text. The texts are read once; all joins are
    on 32-byte digests, and the counts combine on the map side, so a large group of copies costs
    each task one row.
    """
    batch = batch or uuid.uuid4().hex
    rows = digests(docs, id_column, text_column, key).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "digests")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "row"))
    groups = rows.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups.select("digest", "first.doc_id", "first.row", "group_size"), "groups")
    known = index.rows()
    fresh = groups.repartition(index.buckets, "digest").join(
        known.hint("merge").select("digest"), "digest", "left_anti"
    )
    fresh = fresh.select("digest", F.col("doc_id").alias("keep_id"), F.lit(batch).alias("batch"))
    index.append(stored(fresh, "fresh"))
    decided = groups.repartition(index.buckets, "digest").join(index.rows().hint("merge"), "digest")
    decided = stored(
        decided.select(
            "digest", "keep_id", "group_size",
            F.when(F.col("batch") == batch, F.col("row")).alias("kept_row"),
        ),
        "decided",
    )
    # Both sides are plain scans, so that a digest held by many rows is split at run time.
    return rows.join(decided, "digest").select(
        "doc_id", "digest", "key", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
    )


def keep_first(
    docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None
) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns, whatever their names.

    Rows are told apart by their place in the files, so of a row that is repeated one stays.
    """
    rows = located(docs)
    decided = deduplicate(rows.texts(id_column, text_column), index, batch=batch, key=F.col("key"))
    return rows.without(stored(decided.where("NOT kept").select("key"), "gone"))


def fresh_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """A new, empty index whose files lie in the shared folder."""
    name = f"llm_digests_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, buckets, shared_path(spark, "digest-index"))


def in_batches(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` as two batches of ``index``, the smaller ids first: what deduplicate gives, group_size over both.

    The second batch meets what the first has put into the index. Rows without id are in the second,
    so of equal texts the row with the smallest id stays.
    """
    middle = docs.agg(F.percentile_approx(id_column, 0.5)).first()[0]
    early = F.coalesce(F.col(id_column) <= F.lit(middle), F.lit(False))
    first, second = (deduplicate(docs.where(part), index, id_column, text_column) for part in (early, ~early))
    decided = stored(first.unionByName(second).drop("group_size"), "batches")
    sizes = stored(decided.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")), "sizes")
    return decided.join(sizes, "digest")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` as the first two batches of an index."""
    index = fresh_index(spark)
    decided = in_batches(table(spark, sf_dir, "documents"), index)
    index.forget()
    return decided.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
