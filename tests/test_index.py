from pyspark.sql import functions as F

from triplens.operators import joins
from triplens.operators.ids import dense_ids, hashed, hashed_ids
from triplens.operators.index import (
    _most_frequent,
    build_entity_index,
    build_word_index,
    noun_phrases,
    noun_phrases_of_rows,
    tag_rows,
    tag_tokens,
    tokenize,
)
from triplens.operators.joins import hot_keys, salted_join


def test_dense_ids_follow_the_key(spark):
    words = spark.range(0, 5000, 1, 7).select(F.format_string("%05d", F.col("id") * 7919 % 5000).alias("k"))
    rows = dense_ids(words, "k", "n").orderBy("k").collect()
    assert [row["n"] for row in rows] == list(range(5000))


def test_hashed_ids_with_collisions(spark):
    """With hashes of 6 bits, 40 keys share many; ids are unique, and only the exceptions differ from the hash."""
    words = spark.range(40).select(F.concat(F.lit("w"), "id").alias("k"))
    numbered, exceptions = hashed_ids(words, "k", "n", bits=6)
    ids = {row["k"]: row["n"] for row in numbered.collect()}
    assert len(ids) == len(set(ids.values())) == 40
    plain = {row["k"]: row["n"] for row in words.withColumn("n", hashed("k", 6)).collect()}
    assert {row["k"]: row["n"] for row in exceptions.collect()} == {k: n for k, n in ids.items() if plain[k] != n} != {}
    for value in set(plain.values()):
        assert ids[min(k for k in plain if plain[k] == value)] == value
    assert hashed_ids(words, "k", "n")[1].isEmpty()


def test_word_index(spark):
    docs = spark.createDataFrame([("p1", "blue sea blue"), ("p2", "sea")], "post_id string, text string")
    words, located = build_word_index(tokenize(docs, "post_id", "text"), ids="dense")
    assert {row["word"]: row["word_id"] for row in words.collect()} == {"blue": 0, "sea": 1}
    assert sorted(tuple(row) for row in located.collect()) == [
        (0, "p1", 0), (0, "p1", 2), (1, "p1", 1), (1, "p2", 0)]
    assert words.columns == ["word", "word_id"] and located.columns == ["word_id", "post_id", "location"]


def test_hot_word_survives_the_salting(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("w"), "id")).alias("word"),
        F.col("id").alias("post_id"), F.lit(0).cast("long").alias("location"),
    )
    assert [row[0] for row in hot_keys(rows, ["word"]).collect()] == ["hot"]
    words, located = build_word_index(rows, ids="dense")
    assert words.count() == 1001
    back = located.join(words, "word_id")
    assert back.where("word = 'hot'").count() == 2000
    assert back.count() == 3000
    assert rows.exceptAll(back.select(rows.columns)).isEmpty()


def test_salted_join_equals_join(spark):
    big = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(60).select((F.col("id") % 55).alias("k"), (F.col("id") * 10).alias("v"))
    joined, plain = salted_join(big, small, ["k"]), big.join(small, "k")
    assert joined.columns == plain.columns
    assert joined.count() == plain.count()
    assert joined.exceptAll(plain).isEmpty()


def test_entity_index_keeps_duplicates(spark):
    named = spark.createDataFrame([("p1", "b"), ("p1", "b"), ("p2", "a")], "post_id string, entity string")
    entities, located = build_entity_index(named, ids="dense")
    assert sorted(tuple(row) for row in entities.collect()) == [("a", 0), ("b", 1)]
    assert sorted(tuple(row) for row in located.collect()) == [("p1", 1), ("p1", 1), ("p2", 0)]


TAGGED = {
    1: [("San", "NN"), ("Juan", "NN")],
    2: [("Beach", "NN"), ("bars", "NNS"), ("Bars", "NNS")],
    3: [("city", "NN"), ("is", "VB"), ("city", "NN")],
    4: [("go", "VB")],
}
PHRASES = {1: ["san juan"], 2: ["beach", "bars bars"], 3: ["city", "city"]}


def collected(df):
    found = {}
    for row in df.collect():
        found.setdefault(row[0], []).append(row["entity"])
    return found


def test_noun_phrases(spark):
    df = spark.createDataFrame(list(TAGGED.items()), "id int, tagged array<struct<token string, tag string>>")
    assert collected(noun_phrases(df, "id", "tagged")) == PHRASES
    legacy = {key: names[:-1] for key, names in PHRASES.items() if len(names) > 1}
    assert collected(noun_phrases(df, "id", "tagged", legacy_drop_last=True)) == legacy


def test_noun_phrases_of_rows(spark):
    rows = [(key, at, *pair) for key, pairs in TAGGED.items() for at, pair in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, pos int, token string, tag string").repartition(3)
    found = collected(noun_phrases_of_rows(df, "id", "pos"))
    assert {key: sorted(names) for key, names in found.items()} == {
        key: sorted(names) for key, names in PHRASES.items()}
    legacy = {key: names[:-1] for key, names in PHRASES.items() if len(names) > 1}
    assert collected(noun_phrases_of_rows(df, "id", "pos", legacy_drop_last=True)) == legacy


def test_tag_tokens(spark):
    df = spark.createDataFrame([(1, "The Old town, near it!")], "id int, text string")
    tagged = df.select(tag_tokens("text", {"the": "DT", "near": "IN", "It": "PRP"})).first()[0]
    assert [tuple(item) for item in tagged] == [
        ("the", "DT"), ("old", "NN"), ("town", "NN"), (",", ","), ("near", "IN"), ("it", "PRP"), ("!", "!")]


def test_salts_follow_the_counts(spark, monkeypatch):
    """One key at half of the rows and many at 0.4 %: each gets sub-keys by its own count."""
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 15)
    big = spark.range(5000).select(F.when(F.col("id") < 2500, 0).otherwise(F.col("id") % 125 + 1).alias("k"), "id")
    found = {row["k"]: row["_salts"] for row in hot_keys(big, ["k"]).collect()}
    assert found[0] == 167 and len(found) == 126 and found[1] == 32
    small = spark.range(130).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined, plain = salted_join(big, small, ["k"]), big.join(small, "k")
    assert joined.count() == plain.count() == 5000 and joined.exceptAll(plain).isEmpty()


def test_phrases_over_batches(spark):
    """Phrases longer than a batch, null ids and words; the sorted tokens stream by, nothing is gathered or sorted again."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        tags = [(f"W{at}", "NN" if at < 40 else "VB" if at < 60 else "NNS") for at in range(90)]
        tagged = {1: tags, 2: [("a", "NN"), (None, "NN"), ("b", None), ("c", "NN")], None: [("d", "NN"), ("e", "NN")]}
        rows = [(key, at, *pair) for key, pairs in tagged.items() for at, pair in enumerate(pairs)]
        df = spark.createDataFrame(rows, "id int, pos int, token string, tag string").repartition(3)
        long = [" ".join(f"w{at}" for at in range(40)), " ".join(f"w{at}" for at in range(60, 90))]
        found = noun_phrases_of_rows(df, "id", "pos")
        assert collected(found) == {1: long, 2: ["a", "c"], None: ["d e"]}
        assert collected(noun_phrases_of_rows(df, "id", "pos", legacy_drop_last=True)) == {1: long[:1], 2: ["a"]}
        plan = found._jdf.queryExecution().toString()
        assert "Window" not in plan and "collect_list" not in plan
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tags_of_rows_are_found_without_sorting_them(spark):
    """The smallest of a word's tags counts; of a lexicon with a row for each occurrence the repeated rows go by hash."""
    text = spark.createDataFrame([(1, "Sea sea old")], "id long, text string")
    lexicon = spark.createDataFrame([("sea", "ZZ"), ("Sea", "NNS"), ("sea", "NNS"), ("old", None)] * 50, "token string, tag string")
    rows = tag_rows(text, "id", "text", lexicon)
    assert [tuple(row) for row in rows.orderBy("location").collect()] == [
        (1, 0, "sea", "NNS"), (1, 1, "sea", "NNS"), (1, 2, "old", "NN")]
    counts = spark.createDataFrame([(f"w{n}", 1 << n) for n in range(12)] + [("x", 1), ("y", 1)], "token string, _n long")
    assert sorted(row["token"] for row in _most_frequent(counts, 11).collect()) == sorted(f"w{n}" for n in range(1, 12))
    assert _most_frequent(counts, 14).count() == 14 and _most_frequent(counts, 0).count() == 0


def test_hashed_ids_are_stored_by_column(spark):
    """The ids are read without the keys to find shared ones, and a look-up of a few keys skips the rest."""
    words = spark.range(1000).select(F.concat(F.lit("w"), "id").alias("k"))
    numbered, exceptions = hashed_ids(words, "k", "n")
    assert numbered.inputFiles() and exceptions.isEmpty()
    assert numbered.select("n").distinct().count() == numbered.count() == 1000
