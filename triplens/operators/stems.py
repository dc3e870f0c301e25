"""A stored dictionary of stems, so that words are stemmed once and texts not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.functions.stem import stem
from triplens.operators.joins import salted_join
from triplens.session import cut, shared_dir

# Words with a wanted stem, counted, are broadcast up to this many.
BROADCAST_WORDS = 200_000


class StemDictionary:
    """(word, stem) of every word met so far, stored as Parquet under ``path``.

    New words are found by an anti-join and only they are stemmed, each once in the dictionary's
    life. Without ``path`` it is a new one in the shared folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_dir(spark).rstrip('/')}/stems-{uuid.uuid4().hex}"
        spark.createDataFrame([], "word string, stem string").write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """All words known; read anew, as ``extend`` adds files."""
        return self.spark.read.schema("word string, stem string").parquet(self.path)

    def extend(self, words: DataFrame) -> DataFrame:
        """Add the words of ``words`` (column word, repeated or not) that are new; all rows."""
        new = words.select("word").where("word IS NOT NULL").distinct().join(self.rows().select("word"), "word", "left_anti")
        new.select("word", stem(F.col("word")).alias("stem")).write.mode("append").parquet(self.path)
        return self.rows()

    def stemmed(self, tokens: DataFrame) -> DataFrame:
        """``tokens`` (word and more) with every word replaced by its stem; frequent words are spread over salts."""
        found = salted_join(tokens, self.extend(tokens), ["word"])
        return found.withColumn("word", F.col("stem")).select(*tokens.columns).where("word <> ''")

    def asked(self, tokens: DataFrame, stems: list[str]) -> DataFrame:
        """Only the rows whose word has one of the ``stems``, under that stem."""
        wanted = cut(self.extend(tokens).where(F.col("stem").isin(stems)))
        if wanted.count() > BROADCAST_WORDS:
            found = salted_join(tokens, wanted, ["word"])
        else:
            found = tokens.join(F.broadcast(wanted), "word")
        return found.withColumn("word", F.col("stem")).select(*tokens.columns)
