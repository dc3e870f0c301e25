"""Named tables, external Parquet, sinks, and the daily merge."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def register_parquet(
    spark: SparkSession, name: str, path: str, schema: StructType | None = None
) -> DataFrame:
    """A catalog table over Parquet files that stay where they are."""
    if not spark.catalog.tableExists(name):
        options = {"schema": schema} if schema is not None else {}
        spark.catalog.createTable(name, path, "parquet", **options)
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """Scan Parquet files.

    ``spread`` is for work that is heavy per row, such as cutting up texts. A table of less than
    one split that is a single row group can't be cut by the scan, and is dealt out to all cores;
    anything larger is left to the scan's own splits, so no large table is ever moved for this.
    """
    scan = spark.read.parquet(path)
    if not spread:
        return scan
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    small = int(str(size)) < split
    return scan.repartition(spark.sparkContext.defaultParallelism) if small else scan


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write Parquet in as many files as there are tasks."""
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


# Text keeps its spaces and quotes, and NULL is told from the empty string.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _escaped(column: Column) -> Column:
    """Text without line breaks; no escaped text is the mark for NULL."""
    plain = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    plain = F.replace(plain, F.lit("\n"), F.lit("\\n"))
    return F.replace(plain, F.lit("\r"), F.lit("\\r"))


def _unescaped(column: Column) -> Column:
    """Undo :func:`_escaped`: text is cut at doubled backslashes, which are single ones again."""
    parts = F.transform(
        F.split(column, r"\\\\"),
        lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.when(column.isNotNull(), F.array_join(parts, "\\"))


def _texts(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields if isinstance(field.dataType, StringType)]


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV with a header, in as many files as there are tasks.

    Line breaks and backslashes in texts are written as \\n, \\r and a doubled backslash, so a row is
    a line and files split.
    """
    lines = df.withColumns({name: _escaped(F.col(name)) for name in _texts(df.schema)})
    lines.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read what :func:`write_csv` wrote."""
    lines = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    return lines.withColumns({name: _unescaped(F.col(name)) for name in _texts(schema)})


def write_word_index(
    words: DataFrame, path: str, id_column: str = "post_id", word_column: str = "word"
) -> None:
    """Store (word or word_id, id, location) so that a query reads little of it.

    Ranges of (word, id) split a frequent word over many files, while the row-group
    statistics still let ``word IN (...)`` skip all other files.
    """
    ordered = words.repartitionByRange(word_column, id_column).sortWithinPartitions(
        word_column, id_column, "location"
    )
    ordered.write.mode("overwrite").parquet(path)


def write_entity_index(mentions: DataFrame, path: str, id_column: str = "post_id") -> None:
    """Store (id, entity_id) by ranges of (entity_id, id), so that a question reads its entities only."""
    ordered = mentions.repartitionByRange("entity_id", id_column).sortWithinPartitions("entity_id", id_column)
    ordered.write.mode("overwrite").parquet(path)


def snapshot(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Replace ``target`` by a copy of the table ``source``."""
    drop_table(spark, target)
    spark.table(source).write.format("parquet").saveAsTable(target)
    return spark.table(target)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession) -> list[str]:
    """Names of all tables and views of the current database."""
    return [table.name for table in spark.catalog.listTables()]


def merged(base: DataFrame, daily: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept."""
    return base.unionByName(daily)


def append_daily(daily: DataFrame, table: str) -> None:
    """Add a day's rows to the stored table, columns by name; nothing already there is rewritten."""
    _in_order_of(daily, table).write.mode("append").insertInto(table)


def _in_order_of(rows: DataFrame, table: str) -> DataFrame:
    """``insertInto`` goes by position, so columns are put in the table's order first."""
    names = rows.sparkSession.table(table).columns
    if set(names) != set(rows.columns):
        raise ValueError(f"columns {rows.columns} are not those of {table}: {names}")
    return rows.select(*names)


def replace_days(daily: DataFrame, path: str, day: str = "post_date") -> None:
    """Write the days in ``daily``, replacing exactly those days: a rerun changes nothing.

    Rows are dealt out by day, and a large day is split by its size at run time.
    """
    (
        daily.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def location_of(spark: SparkSession, name: str) -> str:
    """Folder of a table's files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


# Parts a table's first folder from the batch that its present one holds.
_MERGE_MARK = "--merge-"


def merge_daily(spark: SparkSession, base: str, daily: str, copy: str, batch: str | None = None) -> DataFrame:
    """The snapshot-and-overwrite merge: copy ``base``, then replace it by copy and daily.

    The new rows are written beside the table, which is then switched to them in one step, so a
    reader or a failure sees ``base`` before the merge or after it, never half. The folder carries the
    name of the ``batch`` (letters, digits, _ and -): a rerun with that name starts over if the table was not
    switched, and changes nothing if it was. ``copy`` keeps the rows from before. The folder left
    behind is emptied. A partitioned table takes :func:`replace_days` instead.
    """
    batch = batch or uuid.uuid4().hex
    if not re.fullmatch(r"[\w-]+", batch):
        raise ValueError("a batch name has letters, digits, _ and - only")
    before = location_of(spark, base)
    if before.endswith(_MERGE_MARK + batch):
        return spark.table(base)
    if any(column.isPartition for column in spark.catalog.listColumns(base)):
        raise ValueError(f"{base} is partitioned")
    snapshot(spark, base, copy)
    both = _in_order_of(merged(spark.table(copy), spark.table(daily)), base)
    beside = before.split(_MERGE_MARK)[0] + _MERGE_MARK + batch
    both.write.mode("overwrite").parquet(beside)
    _switch(spark, base, beside)
    _empty(spark, before, both.schema)
    return spark.table(base)


def _switch(spark: SparkSession, name: str, path: str) -> None:
    """One change in the catalog."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _empty(spark: SparkSession, path: str, schema: StructType) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
