"""Country trends, hot topics, photo locations and hot spots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplens.functions.stem import stem as stem_word
from triplens.functions.text import strip_retweet_header, tweet_body, tweet_links
from triplens.operators.geojoin import nearby_names, nearest
from triplens.session import cut


def country_trend_pairs(trends: DataFrame, world: str, countries: Sequence[str]) -> DataFrame:
    """Trends of a country that also trend world-wide: (country, woeid, name, url), distinct.

    Listings are made distinct before the join, so a trend listed everywhere is joined once
    per country.
    """
    listed = trends.select("place", "woeid", "name", "url").distinct()
    everywhere = listed.where(F.col("place") == world).select("name", "url")
    return (
        listed.where(F.col("place").isin(list(countries)))
        .join(everywhere, ["name", "url"], "left_semi")
        .select(F.col("place").alias("country"), "woeid", "name", "url")
    )


def country_trends(trends: DataFrame, world: str, countries: Sequence[str]) -> DataFrame:
    """:func:`country_trend_pairs` as two parallel lists per country, empty if nothing is common.

    Meant for feeds, where a place lists some dozens of trends; use the pairs for more.
    """
    listed = trends.where(F.col("place").isin(list(countries))).select(F.col("place").alias("country"), "woeid").distinct()
    pairs = country_trend_pairs(trends, world, countries).withColumn("pair", F.struct("name", "url"))
    # collect_list skips nulls, so a country without a pair gets an empty list.
    return (
        listed.join(pairs.select("country", "woeid", "pair"), ["country", "woeid"], "left")
        .groupBy("country", "woeid")
        .agg(F.array_sort(F.collect_list("pair")).alias("_pairs"))
        .select(
            "country", "woeid",
            F.col("_pairs.name").alias("tag"), F.col("_pairs.url").alias("url"),
        )
    )


def clean_retweets(statuses: DataFrame) -> DataFrame:
    """Retweets as (count, title, text, urls, location); other tweets are left out.

    The retweet header goes, the author's name is the title, and the text ends at the first
    link.
    """
    screen_name = F.col("retweeted_status.user.screen_name")
    return (
        statuses.where(F.col("retweeted_status").isNotNull())
        .withColumn("_cleaned", strip_retweet_header(F.col("text")))
        .select(
            F.col("retweet_count").cast("long").alias("count"),
            screen_name.alias("title"),
            tweet_body(F.col("_cleaned"), screen_name).alias("text"),
            tweet_links(F.col("_cleaned")).alias("urls"),
            F.col("user.location").alias("location"),
        )
    )


def hot_topics(retweets: DataFrame) -> DataFrame:
    """Retweets summed up by text, highest count first.

    The other columns come from the row with the smallest (title, location, urls). Each
    sighting of a retweet counts.
    """
    first = F.min(F.struct("title", "location", "urls"))
    return (
        retweets.groupBy("text")
        .agg(F.sum("count").alias("count"), first.alias("_first"))
        .select("count", "_first.title", "text", "_first.location", "_first.urls")
        .orderBy(F.desc("count"), "text")
    )


def top_related_tags(tags: DataFrame, k: int = 5, stem: bool = True) -> DataFrame:
    """The ``k`` most frequent tags (column name), counted by stem: (tag, count)."""
    # Counting the spellings first leaves one row per spelling to stem.
    spelled = tags.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    tag = stem_word(F.col("name")) if stem else F.col("name")
    return (
        spelled.groupBy(tag.alias("tag"))
        .agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), "tag")
        .limit(k)
    )


def tag_list(top: DataFrame) -> DataFrame:
    """The tags of :func:`top_related_tags` as one comma separated string (one row)."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("down"), "tag")))
    return top.agg(F.array_join(ordered["tag"], ",").alias("tags"))


def photo_locations(
    photos: DataFrame,
    geo: DataFrame,
    top_tags: DataFrame | None = None,
    as_of: Column | date | None = None,
) -> DataFrame:
    """Photos carrying a top tag, with their coordinates: (id, latitude, longitude, post_date).

    Photos without a known location are dropped. ``as_of`` is a date or a column of
    ``photos``; today when left out.
    """
    if top_tags is not None:
        # A top-k list, so a small array; no row of photos moves for it.
        wanted = top_tags.agg(F.collect_set("tag").alias("tags")).scalar()
        photos = photos.where(F.arrays_overlap("tags", wanted))
    day = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return photos.select("id", day.alias("post_date")).join(
        geo.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()), "id"
    ).select("id", "latitude", "longitude", "post_date")


def place_label(locality: Column, admin1: Column, country: Column) -> Column:
    """"Locality, area, country" without the empty parts."""
    parts = [F.nullif(part, F.lit("")) for part in (locality, admin1, country)]
    return F.concat_ws(", ", *parts)


def _with_position(spots: DataFrame) -> DataFrame:
    return spots.withColumn("lat", F.expr("try_cast(latitude AS double)")).withColumn(
        "lng", F.expr("try_cast(longitude AS double)")
    )


def hot_spots_level1(photos: DataFrame, gazetteer: DataFrame, radius_km: float) -> DataFrame:
    """Photos per exact coordinate with the label of the nearest gazetteer entry.

    Photos are counted, once, before anything is looked up, so the geographic join sees each
    coordinate once. Coordinates with nothing around get an empty label.
    """
    counted = photos.groupBy("latitude", "longitude").agg(
        F.count("id").alias("count"), F.min("post_date").alias("post_date")
    )
    spots = cut(_with_position(counted))
    labels = gazetteer.select(
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lng"),
        place_label(F.col("locality"), F.col("admin1"), F.col("country")).alias("level_1"),
    )
    named = nearest(spots, labels, radius_km, ["latitude", "longitude"], "level_1")
    return named.select(
        "count", "post_date", "latitude", "longitude",
        F.coalesce("level_1", F.lit("")).alias("level_1"),
    ).orderBy(F.desc("count"), "latitude", "longitude")


def nearby_places(spots: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """Distinct names of places around each spot: (latitude, longitude, name)."""
    around = places.select(
        F.substring_index("name", ",", 1).alias("name"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lng"),
    )
    coordinates = _with_position(spots.select("latitude", "longitude").distinct())
    return nearby_names(coordinates, around, radius_km, ["latitude", "longitude"])


def hot_spots_level2(spots: DataFrame, places: DataFrame, radius_km: float) -> DataFrame:
    """Add ``level2_locations``: the names of :func:`nearby_places` in one string.

    The string holds every distinct name within the radius; take the rows of
    :func:`nearby_places` where that is too many for one cell.
    """
    spots = cut(spots)
    names = (
        nearby_places(spots, places, radius_km)
        .groupBy("latitude", "longitude")
        .agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("level2_locations"))
    )
    return spots.join(names, ["latitude", "longitude"], "left").select(
        "count", "post_date", "latitude", "longitude", "level_1",
        F.coalesce("level2_locations", F.lit("")).alias("level2_locations"),
    ).orderBy(F.desc("count"), "latitude", "longitude")


def daily_post_counts(photos: DataFrame) -> DataFrame:
    """Photos per day, oldest day first."""
    return photos.groupBy("post_date").agg(F.count("id").alias("count")).orderBy("post_date")


def photos_by_date(photos: DataFrame) -> DataFrame:
    """All photos, newest day first."""
    return photos.orderBy(F.desc("post_date"), "id")
