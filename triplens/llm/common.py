"""What the operators of this package share."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.session import shared_dir

#: Characters that separate words, as a regular expression class and as Python bytes.
WHITE = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


#: Rows of an Arrow batch. With texts of some kB, more of them make batches of tens of megabytes, which
#: the JVM and each Python worker hold several times over.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Set the rows of an Arrow batch for the session, unless its owner has set them."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    This cuts the lineage in a way that survives lost executors. The shuffle files of the
    finished step are let go, so that a chain of steps needs the disk of its largest step.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    del df
    for _ in range(2):  # what the first round finds unreachable, the cleaner gives up after the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)
    frame = spark.read.parquet(path)
    frame.stored_path = path
    return frame


def discard(frame: DataFrame) -> None:
    """Delete the files of a stored frame that nothing will read again."""
    path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame.stored_path)
    path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Located:
    """Rows of a Parquet scan, each with the ``key`` of its place in the files; ``columns`` are the rows' own, by name."""

    def __init__(self, frame: DataFrame, columns: dict[str, Column]):
        self.frame, self.columns = frame, columns
        self.key = F.concat_ws(":", "_metadata.row_index", "_metadata.file_path")

    def texts(self, id_column: str, text_column: str) -> DataFrame:
        """(doc_id, text, key) of each row."""
        return self.frame.select(
            self.columns[id_column].alias("doc_id"), self.columns[text_column].alias("text"), self.key.alias("key")
        )

    def without(self, gone: DataFrame) -> DataFrame:
        """The rows, with their own columns only, whose key is not in ``gone`` (key)."""
        row = F.struct(*[column.alias(f"c{i}") for i, column in enumerate(self.columns.values())])
        kept = self.frame.select(self.key.alias("key"), row.alias("row")).join(gone.select("key"), "key", "left_anti")
        return kept.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(self.columns)])


def located(docs: DataFrame) -> Located:
    """``docs`` with a key for each row that does not depend on what the row holds.

    The place in its file tells a row of a Parquet scan apart; anything else is stored as Parquet first.
    """
    try:
        if "_metadata" not in docs.columns and docs.select("_metadata.file_path", "_metadata.row_index").schema:
            return Located(docs, {name: docs[name] for name in docs.columns})
    except AnalysisException:
        pass  # not a scan of Parquet files
    frame = stored(docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), "located")
    return Located(frame, {name: frame[f"c{i}"] for i, name in enumerate(docs.columns)})
