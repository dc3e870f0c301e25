import json
from datetime import date

from pyspark.sql import functions as F

from triplens import schemas
from triplens.functions.dates import date_key, dated_path, weekday_label
from triplens.plans import trends
from triplens.sources import feeds


def test_country_trends(spark):
    rows = [
        ("World", 1, "#sun", "u1"), ("World", 1, "#sea", "u2"), ("World", 1, "#sea", "u2"),
        ("US", 2, "#sun", "other"), ("US", 2, "#sea", "u2"), ("US", 2, "#sea", "u2"), ("India", 3, "#ice", "u3"),
    ]
    landed = spark.createDataFrame(rows, schemas.TRENDS)
    lists = trends.country_trends(landed, "World", ["US", "India"]).collect()
    assert sorted(tuple(row) for row in lists) == [("India", 3, [], []), ("US", 2, ["#sea"], ["u2"])]


def status(text, count=1, name="ann", location="Rome"):
    return {
        "text": text, "retweet_count": count, "user": {"location": location},
        "retweeted_status": {"user": {"screen_name": name}},
    }


def cleaned(spark, tmp_path, *statuses):
    path = tmp_path / "page.json"
    page = {"statuses": list(statuses), "search_metadata": {"next_results": "?max_id=5&q=travel"}}
    path.write_text(json.dumps(page), encoding="utf-8")
    pages = feeds.read_json(spark, str(path), schemas.STATUS_PAGE)
    assert pages.select(feeds.next_page(F.col("search_metadata.next_results"))).first()[0]["max_id"] == "5"
    return trends.clean_retweets(feeds.statuses(pages))


def test_clean_retweets(spark, tmp_path):
    plain = status("no retweet")
    del plain["retweeted_status"]
    rows = cleaned(
        spark, tmp_path, plain,
        status("RT @bob: sunny beach"),
        status("RT @bob: look https://t.example/1 and https://t.example/2"),
        status("RT @bob: https://t.example/1 first"),
        status("RT @bob: RT @eve: both\nlines"),
        status("header is missing"),
        status("RT @bob: see: https://t.example/9"),
    ).collect()
    assert sorted((row["text"], row["urls"]) for row in rows) == sorted([
        ("sunny beach", ""),
        ("look ", "https://t.example/1,  https://t.example/2"),
        ("ann", "https://t.example/1"),
        ("both\nlines", ""),
        ("header is missing", ""),
        # The header runs to the last colon before a space.
        ("ann", "https://t.example/9"),
    ])
    assert {(row["count"], row["title"], row["location"]) for row in rows} == {(1, "ann", "Rome")}


def test_keyword_search(spark):
    pages = spark.createDataFrame([([status("Travel far"), status("stay")], {"next_results": None})], schemas.STATUS_PAGE)
    assert [row["text"] for row in feeds.statuses(pages, "travel").collect()] == ["Travel far"]


def test_hot_topics(spark):
    rows = [(3, "b", "t1", "u", "x"), (4, "a", "t1", "v", "y"), (9, "c", "t2", "", "z"), (3, "b", "t1", "u", "x")]
    topics = trends.hot_topics(spark.createDataFrame(rows, schemas.TWEETS)).collect()
    assert [tuple(row) for row in topics] == [(10, "a", "t1", "y", "v"), (9, "c", "t2", "z", "")]


def test_related_tags(spark):
    names = ["travel", "traveling", "travels", "hiking", "hike", "sea", "sun", "sky", "zoo", "ape"]
    tags = spark.createDataFrame([(name,) for name in names], schemas.RELATED_TAGS)
    top = trends.top_related_tags(tags)
    assert [tuple(row) for row in top.collect()] == [("travel", 3), ("hike", 2), ("ape", 1), ("sea", 1), ("sky", 1)]
    assert trends.tag_list(top).first()["tags"] == "travel,hike,ape,sea,sky"


def located(spark):
    photos = spark.createDataFrame(
        [("1", ["sea"]), ("2", ["sea", "sun"]), ("3", ["sun"]), ("4", ["car"]), ("5", ["sun"])], "id string, tags array<string>")
    geo = spark.createDataFrame(
        [("1", "1.0", "2.0"), ("2", "1.0", "2.0"), ("3", "1.00", "2.0"), ("4", "9", "9"), ("5", None, None)], schemas.PHOTO_GEO)
    top = spark.createDataFrame([("sea",), ("sun",)], "tag string")
    return trends.photo_locations(photos, geo, top, date(2016, 3, 18))


def test_photo_locations(spark):
    rows = sorted(tuple(row) for row in located(spark).collect())
    day = date(2016, 3, 18)
    assert rows == [("1", "1.0", "2.0", day), ("2", "1.0", "2.0", day), ("3", "1.00", "2.0", day)]
    assert located(spark).schema.fieldNames() == schemas.PHOTO_LOCATIONS.fieldNames()


def test_hot_spots(spark):
    gazetteer = spark.createDataFrame(
        [(1.01, 2.0, "", "Area", "Land"), (1.5, 2.0, "Town", "Area", "Land")], schemas.GAZETTEER)
    places = spark.createDataFrame(
        [("Beach, east", 1.0, 2.01), ("Beach, west", 1.0, 1.99), ("Pier", 1.02, 2.0), ("Far", 5.0, 5.0)], schemas.PLACES)
    level1 = trends.hot_spots_level1(located(spark), gazetteer, 20.0)
    spots = trends.hot_spots_level2(level1, places, 10.0)
    assert spots.columns == schemas.HOT_SPOTS.fieldNames()
    day = date(2016, 3, 18)
    assert [tuple(row) for row in spots.collect()] == [
        (2, day, "1.0", "2.0", "Area, Land", "Beach, Pier"), (1, day, "1.00", "2.0", "Area, Land", "Beach, Pier")]
    nothing = trends.hot_spots_level2(trends.hot_spots_level1(located(spark), gazetteer, 0.5), places, 0.1)
    assert {(row["level_1"], row["level2_locations"]) for row in nothing.collect()} == {("", "")}


def test_daily(spark):
    photos = located(spark)
    assert [tuple(row) for row in trends.daily_post_counts(photos).collect()] == [(date(2016, 3, 18), 3)]
    assert [row["id"] for row in trends.photos_by_date(photos).collect()] == ["1", "2", "3"]


def test_address_label(spark):
    def reply(*components):
        return json.dumps({"results": [{"address_components": [
            {"long_name": name, "types": types} for name, types in components]}]})

    rows = [
        (reply(("7", ["street_number"]), ("Rome", ["locality", "political"]), ("Lazio", ["administrative_area_level_1"]), ("Italy", ["country"])),),
        (reply(("", ["locality"]), ("Italy", ["country"])),),
        (reply(("Monaco", ["locality", "country"])),),
        (json.dumps({"results": []}),),
    ]
    labels = spark.createDataFrame(rows, "reply string").select(feeds.address_label(F.col("reply"))).collect()
    assert [row[0] for row in labels] == ["Rome, Lazio, Italy", "Italy", "Monaco, Monaco", ""]


def test_posts_keep_the_last_listing(spark):
    feed = spark.createDataFrame(
        [("travel", 1, "p1", "T", "body", 5, 2), ("backpacking", 9, "p1", "B", "old", 4, 1), ("travel", 2, "p2", "U", None, 1, 0)],
        schemas.POST_FEED)
    rows = {row["post_id"]: row for row in feeds.posts(feed, ["backpacking", "travel"], "r/").collect()}
    assert rows["p1"]["text"] == "T body" and rows["p1"]["url"] == "r/travel/p1"
    assert rows["p2"]["text"] == "U "
    assert set(rows["p1"].asDict()) == set(schemas.POSTS.fieldNames())


def test_dates(spark):
    day = date(2016, 3, 8)
    assert dated_path("/data/hot_spots", day) == "/data/hot_spots_2016_3_8"
    row = spark.range(1).select(weekday_label(F.lit(day)), date_key(F.lit(day))).first()
    assert tuple(row) == ("2016-03-08 (Tuesday)", "2016_3_8")
