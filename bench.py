"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder (default /root/testdata/sf0.1), BENCH_CPUS the cores.
``naive_self_join`` is the k-way positional self-join that ``rank_documents`` avoids;
``naive_frequent`` and ``rank_frequent`` compare the two for words that fill some documents.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.operators.scoring import rank, rescale_scores
from triplens.plans.posts import rank_texts
from triplens.registry import QUERIES, text
from triplens.session import build_session
from triplens.sources.tables import read_parquet

HEADLINE = (
    "rank_documents rank_documents_indexed tokenize_positions word_location noun_phrases "
    "match_entities match_title stemmed_vocabulary page_links page_text bfs_forest link_graph "
    "pagerank_top search_pages hot_topics country_trends clean_retweets photo_locations hot_spots "
    "hot_spots_nearby daily_counts landed_posts"
).split()


FREQUENT = ["de", "la", "que"]
COMPARISONS = ("naive_self_join", "naive_frequent", "rank_frequent")


def naive(tokens: list[str]):
    """Every combination of positions, joined and grouped as the scores are defined."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        words = text._tokens(spark, sf_dir)
        joined = None
        for at, token in enumerate(tokens):
            side = words.where(F.col("word") == token).select("doc_id", F.col("location").alias(f"l{at}"))
            joined = side if joined is None else joined.join(side, "doc_id")
        total = " + ".join(f"l{at}" for at in range(len(tokens)))
        gaps = " + ".join(f"abs(l{at} - l{at + 1})" for at in range(len(tokens) - 1))
        scores = joined.groupBy("doc_id").agg(
            F.min(F.expr(total)).alias("location_score"),
            F.min(F.expr(gaps)).cast("double").alias("dist_score"),
            F.count(F.lit(1)).cast("double").alias("tokens_count"),
        )
        return rank(rescale_scores(scores), "doc_id", k=10).select("doc_id", "ranking")

    return query


def rank_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet", spread=True)
    return rank_texts(docs, FREQUENT, 10, id_column="doc_id", stem=False).select("doc_id", "ranking")


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    """Seconds to compute every row of a query, the plan's construction included."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, *COMPARISONS]
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
    }
    spark = build_session("triplens-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    queries = {
        **QUERIES, "naive_self_join": naive(text.TOKENS), "naive_frequent": naive(FREQUENT),
        "rank_frequent": rank_frequent,
    }
    # Runs that are not counted: start the threads, load and compile the classes.
    for name in ("rank_documents", "naive_self_join", "daily_counts"):
        timed(queries[name], spark, sf_dir)
    seconds = {name: round(timed(queries[name], spark, sf_dir), 3) for name in names}
    total = round(sum(value for name, value in seconds.items() if name not in COMPARISONS), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
