"""Queries that write tables and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplens import schemas
from triplens.operators import index as word_index
from triplens.plans import posts
from triplens.registry import text as text_queries
from triplens.registry import trends as trend_queries
from triplens.registry.common import fresh_path, table
from triplens.session import cut
from triplens.sources import tables


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("month", "o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", day.alias("post_date")
    )


def _split_by_last_day(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    last = orders.agg(F.max("post_date")).scalar()
    return orders.where(F.col("post_date") < last), orders.where(F.col("post_date") == last)


def _as_text(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("post_date").cast("string").alias("post_date")
    )


def merge_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real tables in a schema of their own: snapshot and overwrite, then the day appended once more.

    The daily table has its columns in another order. The rows are stored before the schema goes.
    """
    base, daily = _split_by_last_day(_orders(spark, sf_dir))
    schema = f"merge_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    try:
        base.write.saveAsTable(f"{schema}.base")
        daily.select(*reversed(daily.columns)).write.saveAsTable(f"{schema}.daily")
        tables.merge_daily(spark, f"{schema}.base", f"{schema}.daily", f"{schema}.copy")
        tables.append_daily(spark.table(f"{schema}.daily"), f"{schema}.base")
        return cut(_as_text(spark.table(f"{schema}.base")))
    finally:
        spark.sql(f"DROP DATABASE {schema} CASCADE")


def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders again out of the base and the last day."""
    base, daily = _split_by_last_day(_orders(spark, sf_dir))
    return _as_text(tables.merged(base, daily))


def append_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and daily written by day; the last day is then written again, which changes nothing."""
    base, daily = _split_by_last_day(_orders(spark, sf_dir))
    path = fresh_path(spark, "orders")
    tables.replace_days(base, path)
    tables.replace_days(daily, path)
    tables.replace_days(daily, path)
    return _as_text(spark.read.parquet(path))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "documents")
    documents = table(spark, sf_dir, "documents")
    tables.write_parquet(documents, path, partition_by=["lang"])
    name = path.rsplit("/", 1)[1].replace("-", "_")
    read = tables.register_parquet(spark, name, path, documents.schema)
    # The name goes, the files and the frame that reads them stay.
    tables.drop_table(spark, name)
    return read


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "photos")
    tables.write_csv(trend_queries._located(spark, sf_dir), path)
    read = tables.read_csv(spark, path, schemas.PHOTO_LOCATIONS)
    return read.withColumn("post_date", F.col("post_date").cast("string"))


def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, quotes, backslashes, the mark for NULL, and NULL itself."""
    path = fresh_path(spark, "texts")
    odd = (
        F.when(F.col("doc_id") % 7 == 0, F.lit("\\N"))
        .when(F.col("doc_id") % 7 == 1, F.concat(F.col("text"), F.lit('\r\n"x, \\n" \\\\ \\\n')))
        .when(F.col("doc_id") % 7 == 2, F.lit(""))
        .when(F.col("doc_id") % 7 != 3, F.col("text"))
    )
    tables.write_csv(table(spark, sf_dir, "documents").select("doc_id", odd.alias("text")), path)
    return tables.read_csv(spark, path, StructType.fromDDL("doc_id long, text string"))


def stored_word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranking over a stored index: only the query's words are read."""
    path = fresh_path(spark, "index")
    documents = table(spark, sf_dir, "documents", spread=True)
    words = word_index.tokenize(documents, "doc_id", "text", stem=False)
    tables.write_word_index(words, path, "doc_id")
    ranked = posts.rank_posts(
        spark.read.schema(words.schema).parquet(path), text_queries.TOKENS, 10,
        url_prefix=text_queries.URL_PREFIX, id_column="doc_id",
    )
    return ranked.select("doc_id", "url", F.round("ranking", 6).alias("ranking"))


QUERIES = {
    "merge_daily": merge_daily,
    "split_orders": split_orders,
    "append_daily": append_daily,
    "csv_texts": csv_texts,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "stored_word_index": stored_word_index,
}

_ORDERS = """
SELECT o_orderkey, o_custkey, o_totalprice,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS post_date FROM orders"""

ORACLES = {
    "merge_daily": f"""{_ORDERS} UNION ALL SELECT * FROM ({_ORDERS})
WHERE post_date = (SELECT max(post_date) FROM ({_ORDERS}))""",
    "split_orders": _ORDERS,
    "csv_texts": r"""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '\N' WHEN 2 THEN '' WHEN 3 THEN NULL
  WHEN 1 THEN text || chr(13) || chr(10) || '"x, \n" \\ \' || chr(10) ELSE text END AS text FROM documents""",
    "append_daily": _ORDERS,
    "parquet_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_roundtrip": trend_queries.ORACLES["photos_by_date"],
    "stored_word_index": text_queries.ORACLES["rank_documents"],
}
