import itertools
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triplens.operators.index import build_word_index
from triplens.operators.scoring import (
    PAGE_WEIGHTS,
    leaderboard,
    occurrences,
    rank,
    rescale,
    rescale_scores,
    score,
)
from triplens.plans.pages import answer
from triplens.plans.posts import match_entities, match_title, rank_index, rank_posts, rank_texts

WORDS = ["a", "b", "c", "d", "x"]


def frame(spark, docs):
    rows = [(doc, word, at) for doc, words in docs.items() for at, word in enumerate(words) if word]
    return spark.createDataFrame(rows, "post_id int, word string, location long")


def brute_force(docs, tokens):
    """The definition: every combination of one position per token."""
    known = [token for token in tokens if any(token in words for words in docs.values())]
    scores = {}
    for doc, words in docs.items():
        places = [[at for at, word in enumerate(words) if word == token] for token in known]
        if not known or not all(places):
            continue
        combos = list(itertools.product(*places))
        gaps = [sum(abs(a - b) for a, b in zip(combo, combo[1:])) for combo in combos]
        scores[doc] = (
            min(map(sum, combos)), float(min(gaps)) if len(known) > 1 else 1.0, float(len(combos)))
    return scores


def computed(df):
    return {row["post_id"]: (row["location_score"], row["dist_score"], row["tokens_count"]) for row in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=14), min_size=20, max_size=40),
    tokens=st.lists(st.sampled_from(WORDS + ["unknown"]), min_size=1, max_size=4, unique=True),
)
def test_scores_equal_the_definition(spark, texts, tokens):
    docs = dict(enumerate(texts))
    assert computed(score(frame(spark, docs), tokens)) == brute_force(docs, tokens)


def test_unknown_tokens(spark):
    docs = {1: ["a", "b"], 2: ["a"]}
    index = frame(spark, docs)
    tokens = ["a", "nowhere", "b"]
    assert computed(score(index, tokens)) == brute_force(docs, tokens)
    assert score(index, tokens, strict=True).count() == 0
    assert occurrences(index, [], strict=False).count() == 0
    assert score(index, ["nowhere"]).count() == 0


@pytest.mark.parametrize("ids", ["dense", "hashed"])
def test_rank_index_equals_rank_posts(spark, ids):
    docs = {1: ["a", "b", "a"], 2: ["b"], 3: ["b", "c", "a"], 4: ["a", "c", "c", "b"]}
    index = frame(spark, docs)
    words, located = build_word_index(index, ids=ids)
    tokens = ["b", "nowhere", "a"]
    ranked = rank_index(words, located, tokens).collect()
    assert len(ranked) == 3 and ranked == rank_posts(index, tokens).collect()
    assert rank_index(words, located, ["nowhere"]).count() == 0
    texts = spark.createDataFrame([(doc, " ".join(words)) for doc, words in docs.items()], "post_id int, text string")
    assert rank_texts(texts, tokens, stops=[]).collect() == ranked


def test_product_of_counts_does_not_overflow(spark):
    words = [chr(97 + i % 10) for i in range(1200)]
    index = frame(spark, {1: words})
    count = score(index, [chr(97 + i) for i in range(10)]).first()["tokens_count"]
    assert count == pytest.approx(120.0**10)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_rescale(spark):
    assert value(spark, rescale(F.lit(4), F.lit(2), F.lit(9), True)) == 0.5
    assert value(spark, rescale(F.lit(4), F.lit(0), F.lit(9), True)) == 0.0
    assert value(spark, rescale(F.lit(0), F.lit(0), F.lit(9), True)) == 0.0
    assert value(spark, rescale(F.lit(3), F.lit(0), F.lit(6), False)) == 0.5
    assert value(spark, rescale(F.lit(0), F.lit(0), F.lit(0), False)) == 0.0


def test_rank_and_leaderboards(spark):
    docs = {1: ["a", "b"], 2: ["x", "a", "x", "b", "a"], 3: ["x", "x", "b", "a"], 4: ["a"]}
    rescaled = rescale_scores(score(frame(spark, docs), ["a", "b"]))
    rows = rank(rescaled, weights=PAGE_WEIGHTS).collect()
    low = {name: min(s[i] for s in brute_force(docs, ["a", "b"]).values()) for i, name in enumerate("ld")}
    expected = {
        doc: 2.0 * low["l"] / max(s[0], 1e-5) + 3.5 * low["d"] / s[1] + 4.0 * s[2] / 2.0
        for doc, s in brute_force(docs, ["a", "b"]).items()
    }
    assert {row["post_id"]: row["ranking"] for row in rows} == pytest.approx(expected)
    assert [row["ranking"] for row in rows] == sorted((row["ranking"] for row in rows), reverse=True)
    for column in ("location", "distance", "frequency"):
        best = leaderboard(rescaled, column, k=2).collect()
        assert len(best) == 2 and all(0.0 <= row[1] <= 1.0 for row in best)


def test_rank_posts_adds_urls(spark):
    docs = {1: ["a", "b"], 2: ["b", "x", "a"]}
    rows = rank_posts(frame(spark, docs), ["a", "b"], url_prefix="u/").collect()
    assert [row["url"] for row in rows] == ["u/1", "u/2"]


def test_match_title(spark):
    posts = spark.createDataFrame([(1, "cafe"), (2, "café"), (3, "trip")], "post_id int, title string")
    assert [(row["post_id"], row["levenshtein_score"]) for row in match_title(posts, "cafe").collect()] == [
        (1, 0), (2, 2), (3, 4)]
    assert match_title(posts, "cafe", 1, ascending=False).first()["post_id"] == 3


def test_match_entities(spark):
    entities = spark.createDataFrame([("rome", 0), ("hostel", 1), ("visa", 2)], "entity string, entity_id long")
    located = spark.createDataFrame(
        [("p1", 0), ("p1", 0), ("p1", 1), ("p1", 1), ("p1", 1), ("p2", 0), ("p3", 0), ("p3", 1)],
        "post_id string, entity_id long")
    both = match_entities(entities, located, ["rome", "hostel", "unknown"], url_prefix="u/").collect()
    assert [tuple(row) for row in both] == [("p1", 6.0, "u/p1"), ("p3", 1.0, "u/p3")]
    any_of = match_entities(entities, located, ["rome", "hostel"], mode="any").collect()
    assert [(row["post_id"], row["count"]) for row in any_of] == [("p1", 2.0), ("p3", 2.0), ("p2", 1.0)]
    assert match_entities(entities, located, []).count() == 0
    assert match_entities(entities, located, ["visa"]).count() == 0
    assert match_entities(entities, located, ["rome"], k=1).count() == 1


def test_answer_gate(spark):
    def ranked(*rows):
        return spark.createDataFrame(list(rows), "url string, ranking double")

    posts, found = ranked(("p", 5.0), ("q", 1.0)), ranked(("w", 3.0))
    asked = []

    def pages():
        asked.append(1)
        return found

    assert sorted(row["url"] for row in answer(posts, pages, 5.0).collect()) == ["p", "q"]
    assert not asked
    assert [row["url"] for row in answer(posts, pages, 5.1).collect()] == ["w"]
    assert [row["url"] for row in answer(posts.where("false"), pages, 0.0).collect()] == ["w"]
    assert math.isclose(answer(posts, pages, 9.0).first()["ranking"], 3.0)
