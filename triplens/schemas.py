"""Explicit schemas of every table the library reads or writes."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


STRING, LONG, DOUBLE, DATE = StringType(), LongType(), DoubleType(), DateType()

# Posts and the positional index over them.
POSTS = _table(post_id=STRING, title=STRING, text=STRING, score=LONG, comments_num=LONG, url=STRING)
ENTITY_LIST = _table(entity=STRING, entity_id=LONG)
ENTITY_LOCATION = _table(post_id=STRING, entity_id=LONG)
WORD_LIST = _table(word=STRING, word_id=LONG)
WORD_MAP = _table(word=STRING, post_id=STRING, location=LONG)
WORD_LOCATION = _table(word_id=LONG, post_id=STRING, location=LONG)

# Web pages and their graph.
PAGES = _table(page_id=LONG, url=STRING, html=STRING)
PAGE_WORDS = _table(word=STRING, uid=LONG, location=LONG)
VERTICES = _table(id=LONG, url=STRING)
EDGES = _table(src=LONG, dst=LONG, relationship=STRING)
IMAGES = _table(name=STRING, url=STRING)

# Trend and photo feeds.
TRENDS = _table(place=STRING, woeid=LONG, name=STRING, url=STRING)
RELATED_TAGS = _table(name=STRING)
PHOTO_GEO = _table(id=STRING, latitude=STRING, longitude=STRING)
PHOTO_LOCATIONS = _table(id=STRING, latitude=STRING, longitude=STRING, post_date=DATE)
GAZETTEER = _table(latitude=DOUBLE, longitude=DOUBLE, locality=STRING, admin1=STRING, country=STRING)
PLACES = _table(name=STRING, latitude=DOUBLE, longitude=DOUBLE)
TWEETS = _table(count=LONG, title=STRING, text=STRING, urls=STRING, location=STRING)
HOT_SPOTS = _table(
    count=LONG, post_date=DATE, latitude=STRING, longitude=STRING,
    level_1=STRING, level2_locations=STRING,
)
COUNTRY_TRENDS = _table(
    country=STRING, woeid=LONG, tag=ArrayType(STRING), url=ArrayType(STRING),
)

# Landed JSON documents of the feeds.
POST_FEED = _table(
    subreddit=STRING, feed_order=LONG, id=STRING, title=STRING, selftext=STRING,
    score=LONG, num_comments=LONG,
)
STATUS = StructType([
    StructField("text", STRING),
    StructField("retweet_count", LONG),
    StructField("user", StructType([StructField("location", STRING)])),
    StructField(
        "retweeted_status",
        StructType([StructField("user", StructType([StructField("screen_name", STRING)]))]),
    ),
])
STATUS_PAGE = StructType([
    StructField("statuses", ArrayType(STATUS)),
    StructField("search_metadata", StructType([StructField("next_results", STRING)])),
])
PHOTO_PAGE = StructType([
    StructField("photos", StructType([
        StructField("photo", ArrayType(StructType([
            StructField("id", STRING),
            StructField("tags", ArrayType(STRING)),
        ]))),
    ])),
])
GEOCODE_REPLY = StructType([
    StructField("results", ArrayType(StructType([
        StructField("address_components", ArrayType(StructType([
            StructField("long_name", STRING),
            StructField("types", ArrayType(STRING)),
        ]))),
    ]))),
])
