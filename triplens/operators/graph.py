"""Links between pages: extraction, breadth-first discovery, link graph, page rank."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from triplens.functions.text import hrefs, image_links, image_name, text_links
from triplens.operators.ids import dense_ids
from triplens.operators.joins import hot_keys, salted_join, salts_of
from triplens.session import cut, discard, stored

# Ranks are sums of doubles whose order Spark does not fix; order by this many places.
RANK_PLACES = 9


def extract_links(pages: DataFrame, host: str, prefix: str = "/wiki/") -> DataFrame:
    """Distinct text links of every page: (page_id, from_url, to_url). Map-only."""
    links = text_links(hrefs(F.col("html")), prefix, host)
    return pages.select(
        "page_id", F.col("url").alias("from_url"), F.explode(links).alias("to_url")
    )


def extract_images(pages: DataFrame, host: str, prefix: str = "/wiki/") -> DataFrame:
    """Distinct image file pages linked from anywhere: (name, url)."""
    links = image_links(hrefs(F.col("html")), prefix, host)
    urls = pages.select(F.explode(links).alias("url")).distinct()
    return urls.select(image_name(F.col("url"), f"{host}{prefix}File:").alias("name"), "url")


# Sources of a frontier up to this number are named to the scan as constants.
FEW_SOURCES = 1000


class LinkLayout:
    """Links (src, dst) in a table bucketed by source, whose sources with a large share lie under salts.

    Links are shuffled once, when the table is written. ``from_sources`` joins with the table where it
    lies: the sources asked for are dealt to its buckets, and a few of them are named to the scan,
    which skips what the statistics of its sorted files rule out. Use it in a ``with`` block: the
    table is dropped at the end.
    """

    def __init__(self, links: DataFrame, buckets: int | None = None):
        spark = links.sparkSession
        self.name = f"links_{uuid.uuid4().hex}"
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.hot = hot_keys(links, ["src"])
        salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("_salts")), F.lit(0)).cast("int")
        salted = links.select("src", "dst").join(F.broadcast(self.hot), "src", "left").select("src", salt.alias("salt"), "dst")
        (
            salted.repartition(buckets, "src", "salt").write.bucketBy(buckets, "src", "salt").sortBy("src", "salt")
            .format("parquet").saveAsTable(self.name)
        )
        self.rows = spark.table(self.name)

    def from_sources(self, sources: DataFrame, count: int) -> DataFrame:
        """The links (src, dst) of ``sources`` (node, unique), which are ``count`` rows."""
        salts = F.coalesce(F.sequence(F.lit(0), F.col("_salts") - 1), F.array(F.lit(0)))
        asked = sources.select(F.col("node").alias("src")).join(F.broadcast(self.hot), "src", "left").select(
            "src", F.explode(salts).alias("salt")
        )
        rows = self.rows
        if count <= FEW_SOURCES:
            rows = rows.where(F.col("src").isin([row["node"] for row in sources.select("node").collect()]))
        return rows.join(asked.hint("merge"), ["src", "salt"]).select("src", "dst")

    def __enter__(self) -> LinkLayout:
        return self

    def __exit__(self, *_) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def bfs(links: DataFrame, seeds: DataFrame, depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """Discover nodes level by level from ``seeds`` (column node) along ``links`` (src, dst).

    Returns ``visited`` (node, level) and the forest of discoveries (src, dst, level): each
    node hangs below the lowest src of the level that finds it first. The links are laid out by
    source once; every level then moves its frontier to them, not them to the frontier,
    combines the finds of a node on the map side before the visited ones are taken out, and is
    stored, so neither a popular target nor a long loop piles up work. ``links`` is read twice and
    should be a stored table.
    """
    if depth < 1:
        raise ValueError("depth is at least 1")
    visited = cut(seeds.select("node").where("node IS NOT NULL").distinct().withColumn("level", F.lit(0)))
    frontier, count = visited, visited.count()
    levels = []
    with LinkLayout(links) as layout:
        for level in range(1, depth + 1):
            found = (
                layout.from_sources(frontier, count)
                .groupBy("dst")
                .agg(F.min("src").alias("src"))
                .join(visited.select(F.col("node").alias("dst")), "dst", "left_anti")
                .select("src", "dst", F.lit(level).alias("level"))
            )
            found = cut(found)
            levels.append(found)
            frontier, count = found.select(F.col("dst").alias("node"), "level"), found.count()
            visited = visited.unionByName(frontier)
            if not count:
                break
    forest = levels[0]
    for found in levels[1:]:
        forest = forest.unionByName(found)
    return visited, forest


def link_graph(urls: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``vertices`` (id, url) and ``edges`` (src, dst, relationship) of links between ``urls``.

    ``links`` has (from_url, to_url) and is read once for the frequent urls of either end and
    once for the joins; links from or to an unknown url are dropped.
    """
    vertices = dense_ids(urls.select("url").distinct(), "url", "id")
    sources = vertices.select(F.col("url").alias("from_url"), F.col("id").alias("src"))
    targets = vertices.select(F.col("url").alias("to_url"), F.col("id").alias("dst"))
    encoded = links.select("from_url", "to_url")
    frequent = {end: hot_keys(encoded, [end]) for end in encoded.columns}
    for end, ids in (("from_url", sources), ("to_url", targets)):
        encoded = salted_join(encoded, ids, [end], frequent[end])
    return vertices, encoded.select("src", "dst", F.lit("contains").alias("relationship"))


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = 0.15,
    tol: float = 0.01,
    max_iter: int | None = None,
    normalize: bool = False,
) -> DataFrame:
    """Add ``pagerank`` to ``vertices``: reset + (1 - reset) * sum of rank / out-degree.

    All ranks start at ``reset``; the loop ends when no rank moves by ``tol`` or more. A caller
    that sets ``max_iter`` gets an error, not ranks cut short, if more rounds are needed. The edges are computed once and
    laid out once, sorted, the few vertices with a large share of the edges spread over salts, and each round
    then moves one row per vertex (and salt) plus the map-side sums per target. A round's ranks are
    written by one job, which also observes how far they moved, and the round's before deleted; one scalar per
    round reaches the driver.
    """
    edges = stored(edges.select("src", "dst"), "links")
    degrees = cut(edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree")))
    total = degrees.agg(F.sum("degree").alias("n"))
    salts = salts_of(F.col("degree"), total.scalar())
    state = stored(
        vertices.select("id").join(degrees.withColumn("salts", salts), "id", "left").select(
            "id", "degree", "salts", F.lit(float(reset)).alias("rank")
        ),
        "ranks",
    )
    hot = F.broadcast(cut(state.where("salts IS NOT NULL").select(F.col("id").alias("src"), "salts")))
    salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")), F.lit(0)).cast("int")
    laid_out = (
        edges.select("src", "dst")
        .join(hot, "src", "left")
        .select("src", salt.alias("salt"), "dst")
        .repartition("src", "salt")
        .sortWithinPartitions("src", "salt")
        .persist()
    )
    salts = F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.lit(0)))
    try:
        for done in itertools.count(1):
            sent = state.where(F.col("degree").isNotNull()).select(
                F.col("id").alias("src"),
                (F.col("rank") / F.col("degree")).alias("share"),
                F.explode(salts).alias("salt"),
            )
            received = (
                laid_out.join(sent, ["src", "salt"])
                .groupBy(F.col("dst").alias("id"))
                .agg(F.sum("share").alias("incoming"))
            )
            rank = F.lit(reset) + F.lit(1.0 - reset) * F.coalesce("incoming", F.lit(0.0))
            seen = Observation()
            before, state = state, stored(
                state.join(received, "id", "left")
                .select("id", "degree", "salts", rank.alias("rank"), F.abs(rank - F.col("rank")).alias("moved"))
                .observe(seen, F.max("moved").alias("moved"))
                .drop("moved"),
                "ranks",
            )
            moved = seen.get.get("moved")
            discard(before)
            if moved is None or moved < tol:
                break
            if done == max_iter:
                raise RuntimeError(f"ranks still move by {moved} after {max_iter} rounds")
    finally:
        laid_out.unpersist()
        discard(edges)
    ranks = state.select("id", F.col("rank").alias("pagerank"))
    if normalize:
        whole = ranks.agg(F.sum("pagerank") / F.count(F.lit(1))).scalar()
        ranks = ranks.select("id", (F.col("pagerank") / whole).alias("pagerank"))
    return vertices.join(ranks, "id")


def by_rank(ranks: DataFrame) -> DataFrame:
    """Highest page rank first."""
    return ranks.orderBy(F.desc(F.round("pagerank", RANK_PLACES)), "id")


def top_pages(ranks: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` pages of highest rank: (uid, url, pagerank)."""
    return by_rank(ranks).limit(k).select(F.col("id").alias("uid"), "url", "pagerank")
