"""Queries over feeds: country trends, topics, tags, photos, hot spots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens import schemas
from triplens.functions.dates import date_key, weekday_label
from triplens.plans import trends
from triplens.registry.common import SQL_SPACE, quoted, table
from triplens.registry.stems import stems_cte
from triplens.sources import feeds

WORLD = "view"
COUNTRIES = ["click", "error", "purchase", "signup"]
SUBREDDITS = [f"src{i}" for i in range(20)]
FEED_PREFIX = "https://posts.example/r/"
LABEL_RADIUS_KM = 150.0
NEARBY_RADIUS_KM = 400.0


def _trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event lists a trend: its type is the place, its properties the trend's name."""
    events = table(spark, sf_dir, "events")
    # What the last place lists is listed nowhere else.
    name = F.when(F.col("event_type") == COUNTRIES[-1], F.concat(F.lit("only "), "props")).otherwise(F.col("props"))
    woeid = F.array_position(F.array(*[F.lit(name) for name in [WORLD, *COUNTRIES]]), F.col("event_type"))
    return events.select(
        F.col("event_type").alias("place"),
        woeid.cast("long").alias("woeid"),
        name.alias("name"),
        F.concat(F.lit("https://trends.example/"), F.dayofmonth("ts").cast("string")).alias("url"),
    )


def country_trend_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.country_trend_pairs(_trends(spark, sf_dir), WORLD, COUNTRIES)


def country_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = trends.country_trends(_trends(spark, sf_dir), WORLD, COUNTRIES)
    return lists.select(
        "country", "woeid",
        F.array_join("tag", " ").alias("tag"), F.array_join("url", " ").alias("url"),
    )


def _tweet_text() -> Column:
    """The turns of a conversation as retweets of every form the cleaning knows."""
    header = F.concat(F.lit("RT @"), F.col("role"), F.lit(": "))
    link = F.concat(F.lit("https://t.example/"), F.col("conv_id").cast("string"))
    return (
        F.when(F.col("turn") == 0, F.concat(header, link, F.lit(" "), F.col("text")))
        .when(F.col("turn") == 1, F.concat(header, F.col("text")))
        .when(F.col("turn") == 2, F.concat(F.lit("RT @other: "), header, F.col("text"), F.lit(" "), link, F.lit(" "), link, F.lit("/2")))
        .when(F.col("turn") == 3, F.concat(F.col("text"), F.lit(" "), link))
        .otherwise(F.concat(header, F.col("text"), F.lit(" "), link))
    )


def _status_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as landed JSON search pages; answers carry no retweeted status."""
    said = table(spark, sf_dir, "conversations")
    original = F.when(
        F.col("role") == "user",
        F.struct(F.struct(F.concat_ws("_", "role", F.col("turn").cast("string")).alias("screen_name")).alias("user")),
    )
    status = F.struct(
        _tweet_text().alias("text"),
        (F.col("conv_id") + F.col("turn")).alias("retweet_count"),
        F.struct(F.concat(F.lit("city "), F.col("turn").cast("string")).alias("location")).alias("user"),
        original.alias("retweeted_status"),
    )
    page = F.to_json(F.struct(
        F.array(status).alias("statuses"),
        F.struct(
            F.concat(F.lit("?max_id=0&max_id="), F.col("conv_id").cast("string"), F.lit("&q=travel")).alias("next_results")
        ).alias("search_metadata"),
    ))
    return said.select(F.from_json(page, schemas.STATUS_PAGE).alias("page")).select("page.*")


def clean_retweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.clean_retweets(feeds.statuses(_status_pages(spark, sf_dir)))


def landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets per keyword search, and the parameters of the next page."""
    following = feeds.next_page(F.col("search_metadata.next_results"))
    pages = _status_pages(spark, sf_dir).withColumn("next", following)
    pages = pages.withColumns({"max_id": F.col("next")["max_id"], "q": F.col("next")["q"]})
    return (
        feeds.statuses(pages, "La", keep=["max_id", "q"])
        .groupBy("max_id", "q")
        .agg(F.count(F.lit(1)).alias("tweets"), F.sum("retweet_count").alias("retweets"))
    )


def feed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tweets of the searches' first pages and up to five pages that follow, in order.

    A turn is a landed page. The pages of some conversations lead round in a circle, others name
    a page that was not landed; every third search starts in the middle.
    """
    said = table(spark, sf_dir, "conversations")

    def key(conv: Column, turn: Column) -> Column:
        return F.concat_ws("-", F.lit("page"), conv.cast("string"), turn.cast("string"))

    conv, turn = F.col("conv_id"), F.col("turn")
    following = F.when((conv % 4 == 1) & (turn == 3), 1).when((conv % 4 == 2) & (turn == 2), 99).otherwise(turn + 1)
    query = F.concat(F.lit("?q=travel&max_id="), key(conv, following))
    pages = said.select(
        conv.alias("conv_id"), key(conv, turn).alias("page"), feeds.next_page(query)["max_id"].alias("next"),
        F.array(F.struct(_tweet_text().alias("text"), turn.alias("retweet_count"))).alias("statuses"),
    ).repartition(7, "page")
    first = said.where(turn == F.when(conv % 3 == 0, 2).otherwise(0)).select(conv.alias("chain"), key(conv, turn).alias("page"))
    chain = feeds.follow_pages(pages, first, 5)
    return feeds.statuses(chain, keep=["chain", "place"]).select("chain", "place", "text", "retweet_count")


def hot_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    retweets = table(spark, sf_dir, "documents").select(
        F.col("n_chars").alias("count"), F.col("source").alias("title"), "text",
        F.col("lang").alias("location"), F.lit("").alias("urls"),
    )
    return trends.hot_topics(retweets)


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("name"))


def related_tags_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.top_related_tags(_tags(spark, sf_dir), 5, stem=False)


def related_tag_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.tag_list(trends.top_related_tags(_tags(spark, sf_dir), 5, stem=False))


def related_tags_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("name"))
    return trends.top_related_tags(words, 5)


def landed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a post feed: copies of a text share an id."""
    feed = table(spark, sf_dir, "documents").select(
        F.col("source").alias("subreddit"),
        F.col("doc_id").alias("feed_order"),
        F.md5("text").alias("id"),
        F.concat_ws(" ", F.lit("On"), "lang").alias("title"),
        F.col("text").alias("selftext"),
        F.col("n_chars").alias("score"),
        F.col("doc_id").alias("num_comments"),
    )
    return feeds.posts(feed, SUBREDDITS, FEED_PREFIX)


def _coordinate(number: Column, scale: int, low: int) -> Column:
    """A coordinate as text, from a key."""
    return F.concat(
        ((number * 7) % scale + low).cast("string"), F.lit("."),
        F.lpad(((number * 13) % 100).cast("string"), 2, "0"),
    )


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a photo was taken; lookups of 'error' events failed."""
    events = table(spark, sf_dir, "events")
    known = F.col("event_type") != "error"
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(known, _coordinate(F.col("user_id"), 120, -60)).alias("latitude"),
        F.when(known, _coordinate(F.col("user_id") * 3, 340, -170)).alias("longitude"),
    )


def _photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed photo search replies."""
    photo = F.struct(
        F.col("event_id").cast("string").alias("id"), F.array("event_type", "props").alias("tags")
    )
    reply = F.to_json(F.struct(F.struct(F.array(photo).alias("photo")).alias("photos")))
    replies = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), reply.alias("value"))
    return feeds.photos_of(replies)


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.photo_locations(_photos(spark, sf_dir), _geo(spark, sf_dir), as_of=F.col("day"))


def photo_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("name"))
    top = trends.top_related_tags(kinds, 3, stem=False)
    located = trends.photo_locations(
        _photos(spark, sf_dir), _geo(spark, sf_dir), top, as_of=F.col("day")
    )
    return located.select(
        "id", "latitude", "longitude",
        weekday_label(F.col("post_date")).alias("label"), date_key(F.col("post_date")).alias("day_key"),
    )


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = trends.daily_post_counts(_located(spark, sf_dir))
    return counts.withColumn("post_date", F.col("post_date").cast("string"))


def photos_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    photos = trends.photos_by_date(_located(spark, sf_dir))
    return photos.withColumn("post_date", F.col("post_date").cast("string"))


def _gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as gazetteer entries; some localities are nameless."""
    entries = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return entries.select(
        ((F.col("c_custkey") * 11 % 1200) / 10.0 - 60.0).alias("latitude"),
        ((F.col("c_custkey") * 17 % 3600) / 10.0 - 180.0).alias("longitude"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name")).alias("locality"),
        F.col("n_name").alias("admin1"),
        F.col("r_name").alias("country"),
    )


def _spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.hot_spots_level1(
        _located(spark, sf_dir), _gazetteer(spark, sf_dir), LABEL_RADIUS_KM
    )


def hot_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = _spots(spark, sf_dir)
    return spots.withColumn("post_date", F.col("post_date").cast("string"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places, up to some hundred kilometres from a user's; the first part of a name is shared by several."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Place "), F.col("s_nationkey").cast("string"), F.lit(", "), F.col("s_name")).alias("name"),
        (key * 7 % 120 - 60 + (key * 37 % 50) / 10.0 - 2.5).alias("latitude"),
        (key * 21 % 340 - 170 + (key * 101 % 60) / 10.0 - 3.0).alias("longitude"),
    )


def nearby_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.nearby_places(_located(spark, sf_dir), _places(spark, sf_dir), NEARBY_RADIUS_KM)


def hot_spots_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = trends.hot_spots_level2(_spots(spark, sf_dir), _places(spark, sf_dir), NEARBY_RADIUS_KM)
    return both.withColumn("post_date", F.col("post_date").cast("string"))


def geocode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels out of geocoding replies, built from the gazetteer; every locality gets one."""
    def component(name: str, kind: str) -> Column:
        return F.struct(F.col(name).alias("long_name"), F.array(F.lit(kind), F.lit("political")).alias("types"))

    parts = F.array(
        F.struct(F.lit("12").alias("long_name"), F.array(F.lit("street_number")).alias("types")),
        component("locality", "locality"),
        component("admin1", "administrative_area_level_1"),
        component("country", "country"),
    )
    results = F.when(
        F.col("country") != "ASIA", F.array(F.struct(parts.alias("address_components")))
    ).otherwise(F.array())
    reply = F.to_json(F.struct(results.alias("results")))
    return _gazetteer(spark, sf_dir).select(
        "latitude", "longitude", feeds.address_label(reply).alias("label")
    )


QUERIES = {
    "country_trend_pairs": country_trend_pairs,
    "country_trends": country_trends,
    "clean_retweets": clean_retweets,
    "landed_feed": landed_feed,
    "feed_chain": feed_chain,
    "hot_topics": hot_topics,
    "related_tags_top": related_tags_top,
    "related_tag_list": related_tag_list,
    "related_tags_stemmed": related_tags_stemmed,
    "landed_posts": landed_posts,
    "photo_locations": photo_locations,
    "daily_counts": daily_counts,
    "photos_by_date": photos_by_date,
    "hot_spots": hot_spots,
    "nearby_places": nearby_places,
    "hot_spots_nearby": hot_spots_nearby,
    "geocode_labels": geocode_labels,
}

_PLACES_IN_ORDER = ", ".join(f"'{name}'" for name in [WORLD, *COUNTRIES])
_PAIRS = f"""
listed AS (
  SELECT DISTINCT event_type AS place, list_position([{_PLACES_IN_ORDER}], event_type) AS woeid,
         CASE WHEN event_type = '{COUNTRIES[-1]}' THEN 'only ' || props ELSE props END AS name,
         'https://trends.example/' || CAST(day(ts) AS VARCHAR) AS url FROM events),
pairs AS (
  SELECT place AS country, CAST(woeid AS BIGINT) AS woeid, name, url FROM listed
  WHERE place IN ({quoted(COUNTRIES)})
    AND (name, url) IN (SELECT (name, url) FROM listed WHERE place = '{WORLD}'))"""

_LINK = "'https://t.example/' || CAST(conv_id AS VARCHAR)"
_HEADER = "'RT @' || role || ': '"
_TWEETS = f"""
tweets AS (
  SELECT conv_id, turn, role, conv_id + turn AS retweet_count,
         CASE turn WHEN 0 THEN {_HEADER} || {_LINK} || ' ' || text
                   WHEN 1 THEN {_HEADER} || text
                   WHEN 2 THEN 'RT @other: ' || {_HEADER} || text || ' ' || {_LINK} || ' ' || {_LINK} || '/2'
                   WHEN 3 THEN text || ' ' || {_LINK}
                   ELSE {_HEADER} || text || ' ' || {_LINK} END AS text
  FROM conversations)"""

_TAGS = "tags AS (SELECT unnest(string_split(p_name, ' ')) AS name FROM part)"
_TOP_TAGS = f"""{_TAGS},
top AS (SELECT name AS tag, count(*) AS count FROM tags GROUP BY name ORDER BY count DESC, tag LIMIT 5)"""


def _sql_coordinate(number: str, scale: int, low: int) -> str:
    return (
        f"CAST(({number} * 7) % {scale} + {low} AS VARCHAR) || '.' || "
        f"lpad(CAST(({number} * 13) % 100 AS VARCHAR), 2, '0')"
    )


_LOCATED = f"""
located AS (
  SELECT CAST(event_id AS VARCHAR) AS id, {_sql_coordinate('user_id', 120, -60)} AS latitude,
         {_sql_coordinate('(user_id * 3)', 340, -170)} AS longitude,
         CAST(ts AS DATE) AS post_date, event_type, props
  FROM events WHERE event_type <> 'error')"""
_GAZETTEER = """
gazetteer AS (
  SELECT (c_custkey * 11 % 1200) / 10.0 - 60.0 AS lat, (c_custkey * 17 % 3600) / 10.0 - 180.0 AS lng,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS locality,
         n_name AS admin1, r_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
labels AS (
  SELECT lat, lng, concat_ws(', ', nullif(locality, ''), nullif(admin1, ''), nullif(country, '')) AS label
  FROM gazetteer)"""


def _sql_distance(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))))"
    )


_GROUPED = """
grouped AS (
  SELECT latitude, longitude, CAST(latitude AS DOUBLE) AS la, CAST(longitude AS DOUBLE) AS lo,
         count(id) AS count, min(post_date) AS post_date FROM located GROUP BY latitude, longitude)"""
_SPOTS = f"""{_LOCATED}, {_GAZETTEER}, {_GROUPED},
measured AS (
  SELECT latitude, longitude, label, {_sql_distance('la', 'lo', 'lat', 'lng')} AS d
  FROM grouped, labels),
nearest AS (
  SELECT latitude, longitude, label FROM measured WHERE d <= {LABEL_RADIUS_KM}
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude ORDER BY d, label) = 1),
spots AS (
  SELECT count, post_date, latitude, longitude, coalesce(label, '') AS level_1
  FROM grouped LEFT JOIN nearest USING (latitude, longitude))"""
_NEARBY = f"""
places AS (
  SELECT 'Place ' || CAST(s_nationkey AS VARCHAR) AS name,
         s_suppkey * 7 % 120 - 60 + (s_suppkey * 37 % 50) / 10.0 - 2.5 AS lat,
         s_suppkey * 21 % 340 - 170 + (s_suppkey * 101 % 60) / 10.0 - 3.0 AS lng
  FROM supplier),
near AS (
  SELECT DISTINCT latitude, longitude, name FROM grouped, places
  WHERE {_sql_distance('la', 'lo', 'lat', 'lng')} <= {NEARBY_RADIUS_KM})"""

ORACLES = {
    "country_trend_pairs": f"WITH {_PAIRS} SELECT country, woeid, name, url FROM pairs",
    "country_trends": f"""WITH {_PAIRS}
SELECT place AS country, CAST(l.woeid AS BIGINT) AS woeid, coalesce(string_agg(p.name, ' ' ORDER BY p.name, p.url), '') AS tag,
       coalesce(string_agg(p.url, ' ' ORDER BY p.name, p.url), '') AS url
FROM (SELECT DISTINCT place, woeid FROM listed WHERE place IN ({quoted(COUNTRIES)})) l
LEFT JOIN pairs p ON p.country = l.place AND p.woeid = l.woeid GROUP BY place, l.woeid""",
    "clean_retweets": rf"""WITH {_TWEETS},
cleaned AS (
  SELECT *, coalesce(string_split_regex(text, 'RT[\x09-\x0d ]@[\w\W]+:[\x09-\x0d ]')[2], text) AS body
  FROM tweets WHERE role = 'user')
SELECT retweet_count AS count, role || '_' || CAST(turn AS VARCHAR) AS title,
       CASE WHEN strpos(body, 'https://') = 0 THEN body
            WHEN strpos(body, 'https://') = 1 THEN role || '_' || CAST(turn AS VARCHAR)
            ELSE substr(body, 1, strpos(body, 'https://') - 1) END AS text,
       array_to_string(list_filter(string_split_regex(body, '[{SQL_SPACE}]+'),
                                   lambda w: starts_with(w, 'https://')), ',  ') AS urls,
       'city ' || CAST(turn AS VARCHAR) AS location
FROM cleaned""",
    "landed_feed": f"""WITH {_TWEETS}
SELECT CAST(conv_id AS VARCHAR) AS max_id, 'travel' AS q, count(*) AS tweets,
       CAST(sum(retweet_count) AS BIGINT) AS retweets
FROM tweets WHERE text ILIKE '%la%' GROUP BY conv_id""",
    "feed_chain": f"""WITH RECURSIVE {_TWEETS},
pages AS (
  SELECT conv_id, turn, text,
         CASE WHEN conv_id % 4 = 1 AND turn = 3 THEN 1 WHEN conv_id % 4 = 2 AND turn = 2 THEN 99 ELSE turn + 1 END AS next
  FROM tweets),
chain AS (
  SELECT conv_id, turn, next, text, CAST(0 AS BIGINT) AS place, [turn] AS seen FROM pages
  WHERE turn = CASE WHEN conv_id % 3 = 0 THEN 2 ELSE 0 END
  UNION ALL
  SELECT p.conv_id, p.turn, p.next, p.text, c.place + 1, list_append(c.seen, p.turn)
  FROM chain c JOIN pages p ON p.conv_id = c.conv_id AND p.turn = c.next
  WHERE c.place < 5 AND NOT list_contains(c.seen, p.turn))
SELECT conv_id AS chain, place, text, turn AS retweet_count FROM chain""",
    "hot_topics": """
SELECT CAST(sum(n_chars) AS BIGINT) AS count, min((source, lang))[1] AS title, text,
       min((source, lang))[2] AS location, '' AS urls
FROM documents GROUP BY text ORDER BY count DESC, text""",
    "related_tags_top": f"WITH {_TOP_TAGS} SELECT tag, count FROM top",
    "related_tags_stemmed": f"""WITH
names AS (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents),
{stems_cte('SELECT word FROM names', 'stems')}
SELECT stem AS tag, count(*) AS count FROM names JOIN stems USING (word)
GROUP BY stem ORDER BY count DESC, tag LIMIT 5""",
    "related_tag_list": f"""WITH {_TOP_TAGS}
SELECT string_agg(tag, ',' ORDER BY count DESC, tag) AS tags FROM top""",
    "landed_posts": f"""
SELECT md5(text) AS post_id, 'On ' || lang AS title, 'On ' || lang || ' ' || text AS text,
       n_chars AS score, doc_id AS comments_num,
       '{FEED_PREFIX}' || source || '/' || md5(text) AS url
FROM documents WHERE source IN ({quoted(SUBREDDITS)})
QUALIFY row_number() OVER (
  PARTITION BY md5(text) ORDER BY list_position([{quoted(SUBREDDITS)}], source) DESC, doc_id DESC) = 1""",
    "photo_locations": f"""WITH {_LOCATED},
top AS (SELECT event_type AS tag FROM events GROUP BY event_type ORDER BY count(*) DESC, tag LIMIT 3)
SELECT id, latitude, longitude, strftime(post_date, '%Y-%m-%d (%A)') AS label,
       CAST(year(post_date) AS VARCHAR) || '_' || CAST(month(post_date) AS VARCHAR) || '_'
         || CAST(day(post_date) AS VARCHAR) AS day_key
FROM located WHERE event_type IN (SELECT tag FROM top) OR props IN (SELECT tag FROM top)""",
    "daily_counts": f"""WITH {_LOCATED}
SELECT CAST(post_date AS VARCHAR) AS post_date, count(id) AS count FROM located
GROUP BY post_date ORDER BY post_date""",
    "photos_by_date": f"""WITH {_LOCATED}
SELECT id, latitude, longitude, CAST(post_date AS VARCHAR) AS post_date FROM located
ORDER BY post_date DESC, id""",
    "hot_spots": f"""WITH {_SPOTS}
SELECT count, CAST(post_date AS VARCHAR) AS post_date, latitude, longitude, level_1 FROM spots
ORDER BY count DESC, latitude, longitude""",
    "nearby_places": f"WITH {_LOCATED}, {_GROUPED}, {_NEARBY} SELECT latitude, longitude, name FROM near",
    "hot_spots_nearby": f"""WITH {_SPOTS}, {_NEARBY},
joined AS (
  SELECT latitude, longitude, string_agg(name, ', ' ORDER BY name) AS names FROM near
  GROUP BY latitude, longitude)
SELECT count, CAST(post_date AS VARCHAR) AS post_date, latitude, longitude, level_1,
       coalesce(names, '') AS level2_locations
FROM spots LEFT JOIN joined USING (latitude, longitude)
ORDER BY count DESC, latitude, longitude""",
    "geocode_labels": f"""WITH {_GAZETTEER}
SELECT lat AS latitude, lng AS longitude,
       CASE WHEN country = 'ASIA' THEN ''
            ELSE concat_ws(', ', nullif(locality, ''), nullif(admin1, ''), nullif(country, '')) END AS label
FROM gazetteer""",
}
