from datetime import date

import pytest

from triplens import schemas
from triplens.operators.index import tokenize
from triplens.session import shared_dir
from triplens.sources import tables


def photos(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.PHOTO_LOCATIONS)


DAY1, DAY2 = date(2016, 3, 17), date(2016, 3, 18)
OLD = ("1", "1.0", "2.0", DAY1)
NEW = ("2", " 1.5", 'a "quoted", value', DAY2)


def test_register_parquet(spark, tmp_path):
    path = str(tmp_path / "photos")
    tables.write_parquet(photos(spark, OLD, NEW), path)
    assert tables.register_parquet(spark, "photo_days", path, schemas.PHOTO_LOCATIONS).count() == 2
    assert tables.register_parquet(spark, "photo_days", path).count() == 2
    assert "photo_days" in tables.list_tables(spark)
    tables.drop_table(spark, "photo_days")
    assert "photo_days" not in tables.list_tables(spark)
    assert spark.read.parquet(path).count() == 2


def test_csv_keeps_values(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [OLD, NEW, ("3", "", None, DAY1)]
    tables.write_csv(photos(spark, *rows), path)
    assert sorted(tuple(row) for row in tables.read_csv(spark, path, schemas.PHOTO_LOCATIONS).collect()) == rows


def test_merge_daily_keeps_duplicates(spark):
    photos(spark, OLD, NEW).write.saveAsTable("all_photos")
    photos(spark, NEW).createOrReplaceTempView("daily_photos")
    merged = tables.merge_daily(spark, "all_photos", "daily_photos", "all_photos_copy")
    assert sorted(tuple(row) for row in merged.collect()) == [OLD, NEW, NEW]
    assert spark.table("all_photos_copy").count() == 2
    # Once more: counts add up.
    assert tables.merge_daily(spark, "all_photos", "daily_photos", "all_photos_copy").count() == 4
    tables.append_daily(photos(spark, OLD), "all_photos")
    assert spark.table("all_photos").count() == 5
    tables.drop_table(spark, "all_photos")
    tables.drop_table(spark, "all_photos_copy")


def test_replace_days_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "days")
    tables.replace_days(photos(spark, OLD, NEW), path)
    tables.replace_days(photos(spark, NEW, NEW), path)
    tables.replace_days(photos(spark, NEW, NEW), path)
    rows = spark.read.parquet(path).select("id", "latitude", "longitude", "post_date").collect()
    assert sorted(tuple(row) for row in rows) == [OLD, NEW, NEW]


def test_stored_index_prunes_by_word(spark, tmp_path):
    path = str(tmp_path / "index")
    docs = spark.createDataFrame([("p1", "blue sea"), ("p2", "sea")], "post_id string, text string")
    tables.write_word_index(tokenize(docs, "post_id", "text"), path)
    read = spark.read.parquet(path).where("word IN ('sea', 'sun')")
    assert read.count() == 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(word, [sea,sun])]" in plan


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
