"""Answering a question from web pages found by their links."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplens.functions.text import (
    ENGLISH_STOP_WORDS,
    PAGE_TOKEN_LIMIT,
    nearest_token_distance,
    visible_text,
)
from triplens.operators import graph
from triplens.operators.edits import closest
from triplens.operators.index import tokenize
from triplens.operators.scoring import PAGE_WEIGHTS, Weights, rank, rescale_scores, score
from triplens.session import cut


def crawl(
    pages: DataFrame, seeds: Sequence[str], host: str, prefix: str = "/wiki/", depth: int = 2
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Follow links from the seed urls over stored pages.

    Returns the found ``urls`` (url, level), the ``links`` that found them (from_url, to_url) and
    the ``images`` (name, url) on the pages that were read. A page that is not stored is found
    but leads nowhere.

    Each level looks for links only in the pages of the urls found last. Few urls are sent to the
    scan of the pages, so that no html is moved; many are joined by shuffle. A page is read once,
    on the level after the one that found it.
    """
    if depth < 1:
        raise ValueError("depth is at least 1")
    spark = pages.sparkSession
    urls = cut(spark.createDataFrame([(seed,) for seed in seeds], "url string").distinct().withColumn("level", F.lit(0)))
    frontier, links = urls, None
    for level in range(1, depth + 1):
        found = (
            graph.extract_links(_pages_of(pages, frontier), host, prefix)
            .groupBy("to_url")
            .agg(F.min("from_url").alias("from_url"))
            .join(urls.select(F.col("url").alias("to_url")), "to_url", "left_anti")
        )
        found = cut(found.select("from_url", "to_url"))
        links = found if links is None else links.unionByName(found)
        frontier = found.select(F.col("to_url").alias("url"), F.lit(level).alias("level"))
        urls = urls.unionByName(frontier)
        if found.isEmpty():
            break
    images = graph.extract_images(_pages_of(pages, urls.where(F.col("level") < depth)), host, prefix)
    return urls, links, images


# Urls up to this number are broadcast, after a count; at some hundred bytes each they are few MB.
FEW_URLS = 50_000


def _pages_of(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """The stored pages of ``urls``."""
    wanted = urls.select("url")
    few = wanted.limit(FEW_URLS + 1).count() <= FEW_URLS
    return pages.join(F.broadcast(wanted) if few else wanted, "url", "left_semi")


def match_image(images: DataFrame, tokens: Sequence[str], k: int | None = 5) -> DataFrame:
    """Images by the byte edit distance of their name to the closest query token; few are compared in full."""
    if k is not None:
        return closest(images, "name", tokens, k, "levenshtein_dist", "url")
    ordered = images.withColumn(
        "levenshtein_dist", nearest_token_distance(F.col("name"), tokens)
    ).orderBy("levenshtein_dist", "url")
    return ordered if k is None else ordered.limit(k)


def closest_image(images: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """The url of the best matching image (one row)."""
    return match_image(images, tokens, 1).select("url")


def page_words(
    pages: DataFrame,
    chosen: DataFrame,
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    stem: bool = True,
    text: Column | None = None,
) -> DataFrame:
    """Tokens (word, uid, location) of the chosen pages (uid, url); a missing page is skipped.

    Pages are joined before any html is looked at. ``chosen`` normally comes from
    :func:`triplens.operators.graph.top_pages`, whose limit lets Spark see that it is small
    enough to broadcast; a large one is joined by shuffle.
    """
    # A url stored more than once is read once: with its smallest page.
    read = pages.join(chosen.select("uid", "url"), "url").groupBy("uid", "url").agg(
        F.min_by("html", "page_id").alias("html")
    )
    text = visible_text(F.col("html")) if text is None else text
    return tokenize(read, "uid", text, stops, PAGE_TOKEN_LIMIT, stem)


def rank_pages(
    words: DataFrame,
    chosen: DataFrame,
    tokens: Sequence[str],
    k: int | None = 5,
    weights: Weights = PAGE_WEIGHTS,
) -> DataFrame:
    """Chosen pages by weighted word scores, with their url."""
    scores = rescale_scores(cut(score(words, tokens, "uid", strict=True)))
    with_url = scores.join(chosen.select("uid", "url"), "uid")
    return rank(with_url, "uid", weights, k)


def search_pages(
    pages: DataFrame,
    urls: DataFrame,
    links: DataFrame,
    tokens: Sequence[str],
    k: int | None = 5,
    candidates: int = 200,
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    stem: bool = True,
    weights: Weights = PAGE_WEIGHTS,
    reset: float = 0.15,
    tol: float = 0.01,
    max_iter: int | None = None,
) -> DataFrame:
    """Rank the crawled urls by links, keep the best ``candidates``, rank those by words."""
    vertices, edges = graph.link_graph(urls, links)
    ranks = graph.pagerank(vertices, cut(edges), reset, tol, max_iter)
    chosen = cut(graph.top_pages(ranks, candidates))
    return rank_pages(page_words(pages, chosen, stops, stem), chosen, tokens, k, weights)


def answer(posts: DataFrame, search: Callable[[], DataFrame], threshold: float) -> DataFrame:
    """Ranked posts if the best reaches ``threshold``, else what ``search`` finds in pages.

    Both need ``url`` and ``ranking``; the result adds ``origin``. The posts are stored and their
    best ranking read; ``search`` is called, and pages are looked at, only if it is too low.
    """
    posts = cut(posts.select("url", "ranking"))
    best = posts.agg(F.max("ranking")).first()[0]
    if best is not None and best >= threshold:
        return posts.select(F.lit("posts").alias("origin"), "url", "ranking")
    return search().select(F.lit("pages").alias("origin"), "url", "ranking")
