"""Answering a question from posts: by title, by named entities, by words."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.functions.text import ENGLISH_STOP_WORDS, byte_levenshtein
from triplens.operators import index as word_index
from triplens.operators.edits import closest
from triplens.operators.scoring import POST_WEIGHTS, Weights, rank, rescale_scores, score
from triplens.operators.stems import StemDictionary
from triplens.session import cut


def tokens_of(
    spark: SparkSession, question: str, stops: Iterable[str] = ENGLISH_STOP_WORDS, stem: bool = True
) -> list[str]:
    """Distinct tokens of one question (a single row comes to the driver)."""
    asked = spark.createDataFrame([(question,)], "question string")
    return word_index.question_tokens(asked, "question", stops, stem).first()["tokens"]


def match_title(
    posts: DataFrame,
    question: str,
    k: int | None = 5,
    ascending: bool = True,
    title: str = "title",
    id_column: str = "post_id",
) -> DataFrame:
    """Posts by byte edit distance between title and question, closest first.

    The closest ``k`` are found by bounds, and most titles are not compared in full. Posts without
    title come last.
    """
    if ascending and k is not None:
        return closest(posts, title, [question], k, "levenshtein_score", id_column)
    measured = posts.withColumn(
        "levenshtein_score", byte_levenshtein(F.col(title), F.lit(question))
    )
    order = F.asc_nulls_last("levenshtein_score") if ascending else F.desc_nulls_last("levenshtein_score")
    ordered = measured.orderBy(order, id_column)
    return ordered if k is None else ordered.limit(k)


def match_entities(
    entity_list: DataFrame,
    entity_location: DataFrame,
    entities: Sequence[str],
    k: int | None = 5,
    mode: str = "all",
    url_prefix: str = "",
    id_column: str = "post_id",
) -> DataFrame:
    """Posts (id, count, url) sharing entities with the question, highest count first.

    ``all`` wants every entity the dictionary knows and counts the combinations of their
    mentions; ``any`` counts the distinct shared entities. No known entity: no rows.
    """
    if mode not in ("all", "any"):
        raise ValueError("mode is 'all' or 'any'")
    # At most one row per entity asked for, since entities are unique in the dictionary. As constants
    # they let a scan of stored mentions skip all others.
    known = [row["entity_id"] for row in entity_list.where(F.col("entity").isin(list(entities))).select("entity_id").collect()]
    mentions = (
        entity_location.where(F.col("entity_id").isin(known))
        .groupBy(id_column, "entity_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_post = mentions.groupBy(id_column).agg(
        F.count(F.lit(1)).alias("shared"), F.product(F.col("n").cast("double")).alias("combinations")
    )
    if mode == "all":
        matched = per_post.where(F.col("shared") == len(known))
        count = F.col("combinations")
    else:
        matched, count = per_post, F.col("shared").cast("double")
    result = matched.select(
        id_column,
        count.alias("count"),
        F.concat(F.lit(url_prefix), F.col(id_column).cast("string")).alias("url"),
    ).orderBy(F.desc("count"), id_column)
    return result if k is None else result.limit(k)


def rank_posts(
    word_map: DataFrame,
    tokens: Sequence[str],
    k: int | None = 5,
    weights: Weights = POST_WEIGHTS,
    url_prefix: str = "",
    id_column: str = "post_id",
    strict: bool = False,
) -> DataFrame:
    """Posts by weighted word scores, with their url. ``word_map`` has (word, id, location).

    The scores, a row a document, are stored: the extremes and the ranking read them.
    """
    scores = rescale_scores(cut(score(word_map, tokens, id_column, strict)))
    return rank(scores, id_column, weights, k).withColumn(
        "url", F.concat(F.lit(url_prefix), F.col(id_column).cast("string"))
    )


def rank_index(
    word_list: DataFrame,
    word_location: DataFrame,
    tokens: Sequence[str],
    k: int | None = 5,
    weights: Weights = POST_WEIGHTS,
    url_prefix: str = "",
    id_column: str = "post_id",
) -> DataFrame:
    """:func:`rank_posts` over the stored index.

    The ids of the query's words, at most one per token, come to the driver first. The scan
    of the occurrences then filters on constants, which Parquet uses to skip what it need not
    read, and tokens the dictionary lacks are known to be ignored.
    """
    asked = word_list.where(F.col("word").isin(list(tokens))).select("word_id", "word")
    word_of = {row["word_id"]: row["word"] for row in asked.collect()}
    located = word_location.where(F.col("word_id").isin(list(word_of)))
    word = F.lit(None).cast("string")
    for word_id, name in word_of.items():
        word = F.when(F.col("word_id") == word_id, F.lit(name)).otherwise(word)
    known = [token for token in tokens if token in word_of.values()]
    word_map = located.select(word.alias("word"), id_column, "location")
    return rank_posts(word_map, known, k, weights, url_prefix, id_column, strict=True)


def words_asked(
    posts: DataFrame,
    tokens: Sequence[str],
    id_column: str = "post_id",
    text: str = "text",
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    stem: bool = True,
    dictionary: StemDictionary | None = None,
) -> DataFrame:
    """Occurrences (id, word, location) of the query's words in texts without a stored index.

    The occurrences, a small part of all, are stored and then serve the look-up of known tokens,
    the scores and their extremes. With ``stem`` the texts' words are first added to the stem
    ``dictionary`` (a new one if left out); the texts are then searched for the words that have
    an asked stem, so no text meets a Python worker.
    """
    words = word_index.tokenize(posts, id_column, text, stops, stem=False)
    if not stem:
        return cut(words.where(F.col("word").isin(list(tokens))))
    dictionary = dictionary or StemDictionary(posts.sparkSession)
    return cut(dictionary.asked(words, list(tokens)))


def rank_texts(
    posts: DataFrame,
    tokens: Sequence[str],
    k: int | None = 5,
    weights: Weights = POST_WEIGHTS,
    url_prefix: str = "",
    id_column: str = "post_id",
    text: str = "text",
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    stem: bool = True,
    dictionary: StemDictionary | None = None,
) -> DataFrame:
    """:func:`rank_posts` straight from texts."""
    asked = words_asked(posts, tokens, id_column, text, stops, stem, dictionary)
    return rank_posts(asked, tokens, k, weights, url_prefix, id_column)
