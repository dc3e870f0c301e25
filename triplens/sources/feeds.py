"""Landed feeds: JSON or table rows as an external service delivered them, made into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens import schemas
from triplens.functions.text import parse_query_string
from triplens.session import cut


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """Landed JSON lines with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def posts(feed: DataFrame, subreddits: Sequence[str], url_prefix: str) -> DataFrame:
    """Posts out of a feed (:data:`triplens.schemas.POST_FEED`), one row per id.

    A post listed more than once keeps its last listing, the subreddits taken in the given
    order. The choice is an aggregation, so copies combine before they are shuffled.
    """
    order = F.array_position(F.array(*[F.lit(name) for name in subreddits]), F.col("subreddit"))
    listed = feed.where(F.col("subreddit").isin(list(subreddits)))
    post = F.struct(
        "title",
        F.concat_ws(" ", "title", F.coalesce("selftext", F.lit(""))).alias("text"),
        "score",
        F.col("num_comments").alias("comments_num"),
        F.concat(F.lit(url_prefix), F.col("subreddit"), F.lit("/"), F.col("id")).alias("url"),
    )
    return (
        listed.groupBy(F.col("id").alias("post_id"))
        .agg(F.max_by(post, F.struct(order, "feed_order")).alias("post"))
        .select("post_id", "post.*")
    )


def statuses(pages: DataFrame, keyword: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All tweets of landed search pages (:data:`triplens.schemas.STATUS_PAGE`).

    ``keyword`` is looked for in any case; ``keep`` names columns of the page to hand on.
    """
    tweets = pages.select(*keep, F.inline("statuses"))
    # Not a pattern: a keyword may hold % and _.
    return tweets if keyword is None else tweets.where(F.lower("text").contains(F.lower(F.lit(keyword))))


def next_page(query: Column) -> Column:
    """Parameters of the next search page, from its query string, as a map."""
    return parse_query_string(query)


def follow_pages(pages: DataFrame, first: DataFrame, most: int) -> DataFrame:
    """Landed search pages in the order a client that follows their links reads them.

    ``pages`` has (page, next, and more): a page's own key and that of the page it names as the next
    one. ``first`` has (chain, page), the page each search starts with. Returns (chain, place, and the
    columns of ``pages``): the first page at place 0 and up to ``most`` further ones. A chain ends where the
    next page is null or was not landed, and before a page that it already holds. A page landed twice
    counts once, with its largest ``next``, and then the largest of its other columns.

    Pointer jumping: after k rounds every page knows the page 2**k further on, and each chain holds its
    first 2**k pages, so the rounds are the logarithm of ``most``. Only keys take part; the
    pages themselves are joined at the end.
    """
    rest = [name for name in pages.columns if name not in ("page", "next")]
    landed = pages.where("page IS NOT NULL")
    jump = cut(landed.groupBy("page").agg(F.max("next").alias("to")))
    # A link to a page that was not landed leads nowhere.
    jump = cut(jump.join(jump.select(F.col("page").alias("to")), "to", "left_semi").select("page", "to"))
    held = landed.select("page").distinct()
    reached = cut(first.join(held, "page", "left_semi").select("chain", "page").distinct().withColumn("place", F.lit(0).cast("long")))
    step = 1
    while step <= most:
        onward = reached.join(jump, "page").select("chain", F.col("to").alias("page"), (F.col("place") + step).alias("place"))
        # A page met again on a circle keeps its first place.
        reached = cut(reached.unionByName(onward).groupBy("chain", "page").agg(F.min("place").alias("place")))
        step *= 2
        if step <= most:
            jump = cut(jump.join(jump.select(F.col("page").alias("to"), F.col("to").alias("further")), "to").select("page", F.col("further").alias("to")))
    one = landed.groupBy("page").agg(F.max(F.struct("next", *rest)).alias("_landed"))
    wanted = reached.where(F.col("place") <= most)
    return wanted.join(one, "page").select("chain", "place", "page", "_landed.*")


def photos_of(pages: DataFrame, column: str = "value") -> DataFrame:
    """Photos (id, tags) in landed JSON replies of a photo search."""
    parsed = F.from_json(F.col(column), schemas.PHOTO_PAGE)
    # The other columns of a page (such as its date) stay with its photos.
    rest = [name for name in pages.columns if name != column]
    return pages.select(*rest, F.explode(parsed["photos"]["photo"]).alias("_photo")).select(
        *rest, "_photo.id", "_photo.tags"
    )


def address_label(reply: Column) -> Column:
    """"Locality, area, country" from a landed geocoding reply; empty when it found nothing."""
    parsed = F.from_json(reply, schemas.GEOCODE_REPLY)
    components = F.get(parsed["results"], F.lit(0))["address_components"]

    def names(component: Column) -> Column:
        # A component of several kinds is named once per kind.
        kinds = ("locality", "administrative_area_level_1", "country")
        held = F.array(*[
            F.when(F.array_contains(component["types"], kind), component["long_name"])
            for kind in kinds
        ])
        return F.filter(held, lambda name: name.isNotNull() & (name != ""))

    return F.coalesce(F.array_join(F.flatten(F.transform(components, names)), ", "), F.lit(""))
