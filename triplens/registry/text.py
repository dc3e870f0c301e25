"""Queries over documents: index, word scores, title and entity matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.functions.stem import stem
from triplens.operators import index as word_index
from triplens.operators.joins import salted_join
from triplens.operators.scoring import SCORES, leaderboard, occurrences, rescale_scores, score
from triplens.plans import posts
from triplens.registry.common import (
    SQL_SPACE,
    fresh_path,
    naive_scores_cte,
    quoted,
    ranking_sql,
    rescaled_cte,
    table,
    tokens_cte,
)
from triplens.registry.stems import stems_cte
from triplens.sources.tables import read_parquet, write_entity_index, write_parquet, write_word_index

TOKENS = ["tion", "er", "st"]
# The second token occurs nowhere.
TOKENS_ONE_UNKNOWN = ["tion", "zzyzx", "er", "st"]
QUESTION = "Thheouble heenwh on reti?"
STEMMED_QUESTION, STEMMED_TOKENS = "The tions, and ers or sts?", ["tion", "er", "st"]
URL_PREFIX = "https://posts.example/travel/"
LEXICON = {
    "the": "DT", "la": "DT", "le": "DT", "les": "DT", "der": "DT", "die": "DT", "el": "DT",
    "of": "IN", "in": "IN", "on": "IN", "de": "IN", "with": "IN", "by": "IN", "for": "IN",
    "and": "CC", "et": "CC", "und": "CC", "y": "CC", "is": "VBZ", "are": "VBP", "was": "VBD",
    "to": "TO", "it": "PRP", "this": "DT", "that": "DT", "er": "NNS", "es": "NNS", "st": "NNP",
}
# Tags of the lexicon table by the length of a word; what it lacks is a noun.
LEXICON_TAGS = ["NN", "VB", "NNS", "IN", "NN", "JJ", "NNP"]
ENTITIES = ["tion", "er", "zzyzx unknown"]

DOC_TOKENS = tokens_cte("documents", "doc_id", "text", "doc_id")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return word_index.tokenize(docs, "doc_id", "text", stem=False)


def _asked(spark: SparkSession, sf_dir: str, tokens: list[str]) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return posts.words_asked(docs, tokens, "doc_id", stem=False)


def tokenize_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir)


def page_token_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_index.tokenize(
        table(spark, sf_dir, "pages", spread=True), "page_id", "html", max_len=20, stem=False
    )


def word_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_index.build_word_index(_tokens(spark, sf_dir), "doc_id", ids="dense")[0]


def word_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_index.build_word_index(_tokens(spark, sf_dir), "doc_id", ids="dense")[1]


def word_index_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence found again through the hashed ids."""
    words, located = word_index.build_word_index(_tokens(spark, sf_dir), "doc_id")
    return salted_join(located, words, ["word_id"]).select("word", "doc_id", "location")


def question_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = word_index.question_tokens(table(spark, sf_dir, "benchmark"), "text", stem=False)
    return asked.select("item_id", F.array_join("tokens", " ").alias("tokens"))


def question_tokens_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = word_index.question_tokens(table(spark, sf_dir, "benchmark"), "text")
    return asked.select("item_id", F.array_join("tokens", " ").alias("tokens"))


def stemmed_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _tokens(spark, sf_dir).select("word").distinct()
    return words.select("word", stem(F.col("word")).alias("stem"))


def contains_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = occurrences(_asked(spark, sf_dir, TOKENS_ONE_UNKNOWN), TOKENS_ONE_UNKNOWN, "doc_id")
    return rows.select("doc_id", "step", "location")


def contains_all_terms_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = occurrences(_tokens(spark, sf_dir), TOKENS, "doc_id", strict=True)
    return rows.select("doc_id").distinct()


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_asked(spark, sf_dir, TOKENS), TOKENS, "doc_id")


def score_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("doc_id", "location_score")


def score_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("doc_id", "dist_score")


def score_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("doc_id", "tokens_count")


def score_single_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_asked(spark, sf_dir, TOKENS[:1]), TOKENS[:1], "doc_id")


def score_rescaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rescaled = rescale_scores(_scores(spark, sf_dir))
    return rescaled.select("doc_id", *[F.round(name, 6).alias(name) for name in SCORES.values()])


def _leaderboard(by: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        best = leaderboard(rescale_scores(_scores(spark, sf_dir)), by, "doc_id", 5)
        return best.withColumn(SCORES[by], F.round(SCORES[by], 6))

    return query


def rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    ranked = posts.rank_texts(docs, TOKENS, 10, url_prefix=URL_PREFIX, id_column="doc_id", stem=False)
    return ranked.select("doc_id", "url", F.round("ranking", 6).alias("ranking"))


def rank_documents_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and question both stemmed, which is the default."""
    docs = table(spark, sf_dir, "documents", spread=True)
    tokens = posts.tokens_of(spark, STEMMED_QUESTION)
    ranked = posts.rank_texts(docs, tokens, 10, url_prefix=URL_PREFIX, id_column="doc_id")
    return ranked.select("doc_id", "url", F.round("ranking", 6).alias("ranking"))


def rank_documents_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking over a stored dictionary and stored occurrences, of which it reads little."""
    words, located = word_index.build_word_index(_tokens(spark, sf_dir), "doc_id")
    path = fresh_path(spark, "word-index")
    write_parquet(words, f"{path}/words")
    write_word_index(located, f"{path}/located", "doc_id", "word_id")
    ranked = posts.rank_index(
        read_parquet(spark, f"{path}/words"), read_parquet(spark, f"{path}/located"), TOKENS_ONE_UNKNOWN, 10, url_prefix=URL_PREFIX, id_column="doc_id"
    )
    return ranked.select("doc_id", "url", F.round("ranking", 6).alias("ranking"))


def match_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("post_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )
    return posts.match_title(pages, QUESTION, 5)


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return word_index.noun_phrases(docs, "doc_id", word_index.tag_tokens("text", LEXICON))


def noun_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phrases(spark, sf_dir)


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of over two letters of all documents, a tag for each by its length (over 10**5 at the bench's size)."""
    docs = table(spark, sf_dir, "documents", spread=True)
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?U)\w+"), 0)).alias("token")).distinct()
    length = F.char_length(F.lower("token"))
    tags = F.array(*[F.lit(tag) for tag in LEXICON_TAGS])
    return words.where(length > 2).select("token", F.get(tags, length % len(LEXICON_TAGS)).alias("tag"))


def _tagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    return word_index.tag_rows(docs, "doc_id", "text", _lexicon(spark, sf_dir))


def noun_phrases_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags from a table of words."""
    return word_index.noun_phrases_of_rows(_tagged_rows(spark, sf_dir), "doc_id", "location")


def noun_phrases_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags from a table of words; the last phrase of a document is dropped."""
    return word_index.noun_phrases_of_rows(_tagged_rows(spark, sf_dir), "doc_id", "location", legacy_drop_last=True)


def entity_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_index.build_entity_index(_phrases(spark, sf_dir), "doc_id", ids="dense")[0]


def entity_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_index.build_entity_index(_phrases(spark, sf_dir), "doc_id", ids="dense")[1]


def match_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, located = word_index.build_entity_index(_phrases(spark, sf_dir), "doc_id")
    return posts.match_entities(known, located, ENTITIES, 5, url_prefix=URL_PREFIX, id_column="doc_id")


def match_entities_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, located = word_index.build_entity_index(_phrases(spark, sf_dir), "doc_id")
    return posts.match_entities(
        known, located, ENTITIES, 5, mode="any", url_prefix=URL_PREFIX, id_column="doc_id"
    )


def match_entities_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two questions over one stored index: the documents that share all, or any, of their entities."""
    known, located = word_index.build_entity_index(_phrases(spark, sf_dir), "doc_id")
    path = fresh_path(spark, "entity-index")
    write_parquet(known, f"{path}/entities")
    write_entity_index(located, f"{path}/located", "doc_id")
    names, mentions = read_parquet(spark, f"{path}/entities"), read_parquet(spark, f"{path}/located")
    found = [
        posts.match_entities(names, mentions, entities, 5, mode, URL_PREFIX, "doc_id").withColumn("mode", F.lit(mode))
        for mode, entities in (("all", ENTITIES), ("any", ENTITIES))
    ]
    return found[0].unionByName(found[1])


QUERIES = {
    "tokenize_positions": tokenize_positions,
    "page_token_positions": page_token_positions,
    "word_dictionary": word_dictionary,
    "word_location": word_location,
    "word_index_hashed": word_index_hashed,
    "question_tokens": question_tokens,
    "question_tokens_stemmed": question_tokens_stemmed,
    "stemmed_vocabulary": stemmed_vocabulary,
    "contains_all_terms": contains_all_terms,
    "contains_all_terms_strict": contains_all_terms_strict,
    "score_location": score_location,
    "score_distance": score_distance,
    "score_frequency": score_frequency,
    "score_single_token": score_single_token,
    "score_rescaled": score_rescaled,
    "leaderboard_location": _leaderboard("location"),
    "leaderboard_distance": _leaderboard("distance"),
    "leaderboard_frequency": _leaderboard("frequency"),
    "rank_documents": rank_documents,
    "rank_documents_stemmed": rank_documents_stemmed,
    "rank_documents_indexed": rank_documents_indexed,
    "match_title": match_title,
    "noun_phrases": noun_phrases,
    "noun_phrases_of_rows": noun_phrases_of_rows,
    "noun_phrases_legacy": noun_phrases_legacy,
    "entity_dictionary": entity_dictionary,
    "entity_location": entity_location,
    "match_entities": match_entities,
    "match_entities_any": match_entities_any,
    "match_entities_indexed": match_entities_indexed,
}

_SCORED = f"WITH {DOC_TOKENS}, {naive_scores_cte(TOKENS, 'doc_id')}"
_RESCALED = f"{_SCORED}, {rescaled_cte()}"
_RANKED = f"""{_RESCALED}
SELECT doc_id, '{URL_PREFIX}' || CAST(doc_id AS VARCHAR) AS url, round(ranking, 6) AS ranking
FROM (SELECT doc_id, {ranking_sql(4.0, 3.5, 1.0)} AS ranking FROM rescaled)
ORDER BY ranking DESC, doc_id LIMIT 10"""

_WORDS_OF: dict[str, list[str]] = {}
for _word, _tag in LEXICON.items():
    _WORDS_OF.setdefault(_tag, []).append(_word)
_TAG_CASE = " ".join(
    f"WHEN token IN ({quoted(words)}) THEN '{tag}'" for tag, words in sorted(_WORDS_OF.items())
)
_WORD_CLASS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"


def _phrases_cte(tag_case: str) -> str:
    return rf"""
split AS (
  SELECT doc_id, regexp_extract_all(lower(text),
           '[{_WORD_CLASS}]+|[^{SQL_SPACE}{_WORD_CLASS}]') AS arr FROM documents),
placed AS (
  SELECT doc_id, unnest(arr) AS token, generate_subscripts(arr, 1) AS pos FROM split),
tagged AS (
  SELECT *, CASE WHEN length(token) = 1 AND regexp_matches(token, '[^{_WORD_CLASS}]') THEN token
                 {tag_case} ELSE 'NN' END AS tag FROM placed),
marked AS (
  SELECT *, lag(tag) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM tagged),
runs AS (
  SELECT *, sum(CASE WHEN before IS NOT NULL AND before = tag THEN 0 ELSE 1 END)
              OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked),
phrases AS MATERIALIZED (
  SELECT doc_id, run, string_agg(token, ' ' ORDER BY pos) AS entity
  FROM runs WHERE starts_with(tag, 'NN') GROUP BY doc_id, run)"""


_PHRASES = _phrases_cte(_TAG_CASE)
_TABLE_PHRASES = _phrases_cte(
    f"WHEN length(token) > 2 THEN ([{quoted(LEXICON_TAGS)}])[length(token) % {len(LEXICON_TAGS)} + 1]"
)
_ENTITY_LIST = """
entity_list AS (
  SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS entity_id
  FROM (SELECT DISTINCT entity FROM phrases))"""


def _entity_match(count: str, having: str) -> str:
    return f"""WITH {_PHRASES},
mentions AS (
  SELECT doc_id, entity, count(*) AS n FROM phrases WHERE entity IN ({quoted(ENTITIES)})
  GROUP BY doc_id, entity)
SELECT doc_id, CAST({count} AS DOUBLE) AS count, '{URL_PREFIX}' || CAST(doc_id AS VARCHAR) AS url
FROM mentions GROUP BY doc_id {having} ORDER BY count DESC, doc_id LIMIT 5"""


_ALL_KNOWN = "HAVING count(*) = (SELECT count(DISTINCT entity) FROM mentions)"


def _leader_sql(column: str) -> str:
    return f"""{_RESCALED}
SELECT doc_id, round({column}, 6) AS {column} FROM rescaled
ORDER BY rescaled.{column} DESC, doc_id LIMIT 5"""


_WORD_LIST = """
word_list AS (
  SELECT word, row_number() OVER (ORDER BY word) - 1 AS word_id FROM (SELECT DISTINCT word FROM tok))"""

ORACLES = {
    "tokenize_positions": f"WITH {DOC_TOKENS} SELECT doc_id, word, location FROM tok",
    "page_token_positions": f"""WITH {tokens_cte('pages', 'page_id', 'html', 'page_id', max_len=20)}
SELECT page_id, word, location FROM tok""",
    "word_dictionary": f"WITH {DOC_TOKENS}, {_WORD_LIST} SELECT word, word_id FROM word_list",
    "word_location": f"""WITH {DOC_TOKENS}, {_WORD_LIST}
SELECT word_id, doc_id, location FROM tok JOIN word_list USING (word)""",
    "word_index_hashed": f"WITH {DOC_TOKENS} SELECT word, doc_id, location FROM tok",
    "question_tokens": f"""WITH {tokens_cte('benchmark', 'item_id', 'text', 'item_id')},
firsts AS (SELECT item_id, word, min(location) AS location FROM tok GROUP BY item_id, word)
SELECT item_id, coalesce(string_agg(word, ' ' ORDER BY location), '') AS tokens
FROM benchmark LEFT JOIN firsts USING (item_id) GROUP BY item_id""",
    "question_tokens_stemmed": f"""WITH {tokens_cte('benchmark', 'item_id', 'text', 'item_id')},
{stems_cte('SELECT word FROM tok', 'stems')},
firsts AS (SELECT item_id, stem, min(location) AS location FROM tok JOIN stems USING (word) GROUP BY item_id, stem)
SELECT item_id, coalesce(string_agg(stem, ' ' ORDER BY location), '') AS tokens
FROM benchmark LEFT JOIN firsts USING (item_id) GROUP BY item_id""",
    "stemmed_vocabulary": f"""WITH {DOC_TOKENS}, {stems_cte('SELECT word FROM tok', 'stems')}
SELECT word, stem FROM stems""",
    "rank_documents_stemmed": f"""WITH {DOC_TOKENS}, {stems_cte('SELECT word FROM tok', 'stems')},
stok AS MATERIALIZED (SELECT doc_id, stem AS word, location FROM tok JOIN stems USING (word)),
{naive_scores_cte(STEMMED_TOKENS, 'doc_id', 'stok')}, {rescaled_cte()}
SELECT doc_id, '{URL_PREFIX}' || CAST(doc_id AS VARCHAR) AS url, round(ranking, 6) AS ranking
FROM (SELECT doc_id, {ranking_sql(4.0, 3.5, 1.0)} AS ranking FROM rescaled)
ORDER BY ranking DESC, doc_id LIMIT 10""",
    "contains_all_terms": f"""WITH {DOC_TOKENS},
hit AS (
  SELECT doc_id, CASE word WHEN 'tion' THEN 0 WHEN 'er' THEN 1 ELSE 2 END AS step, location
  FROM tok WHERE word IN ({quoted(TOKENS_ONE_UNKNOWN)}))
SELECT doc_id, step, location FROM hit
WHERE doc_id IN (SELECT doc_id FROM hit GROUP BY doc_id
                 HAVING count(DISTINCT step) = (SELECT count(DISTINCT step) FROM hit))""",
    "contains_all_terms_strict": f"""WITH {DOC_TOKENS}
SELECT DISTINCT t0.doc_id FROM tok t0, tok t1, tok t2
WHERE t0.word = '{TOKENS[0]}' AND t1.word = '{TOKENS[1]}' AND t2.word = '{TOKENS[2]}'
  AND t0.doc_id = t1.doc_id AND t1.doc_id = t2.doc_id""",
    "score_location": f"{_SCORED} SELECT doc_id, location_score FROM scores",
    "score_distance": f"{_SCORED} SELECT doc_id, dist_score FROM scores",
    "score_frequency": f"{_SCORED} SELECT doc_id, tokens_count FROM scores",
    "score_single_token": f"""WITH {DOC_TOKENS}, {naive_scores_cte(TOKENS[:1], 'doc_id')}
SELECT doc_id, location_score, dist_score, tokens_count FROM scores""",
    "score_rescaled": f"""{_RESCALED}
SELECT doc_id, round(rescaled_location_score, 6) AS rescaled_location_score,
       round(rescaled_dist_score, 6) AS rescaled_dist_score,
       round(rescaled_tokens_count, 6) AS rescaled_tokens_count FROM rescaled""",
    "leaderboard_location": _leader_sql("rescaled_location_score"),
    "leaderboard_distance": _leader_sql("rescaled_dist_score"),
    "leaderboard_frequency": _leader_sql("rescaled_tokens_count"),
    "rank_documents": _RANKED,
    "rank_documents_indexed": _RANKED,
    "match_title": f"""
SELECT post_id, title, CAST(levenshtein(title, '{QUESTION}') AS INTEGER) AS levenshtein_score
FROM (SELECT page_id AS post_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages)
ORDER BY levenshtein_score, post_id LIMIT 5""",
    "noun_phrases": f"WITH {_PHRASES} SELECT doc_id, entity FROM phrases",
    "noun_phrases_of_rows": f"WITH {_TABLE_PHRASES} SELECT doc_id, entity FROM phrases",
    "noun_phrases_legacy": f"""WITH {_TABLE_PHRASES}
SELECT doc_id, entity FROM phrases p
WHERE run < (SELECT max(run) FROM phrases q WHERE q.doc_id = p.doc_id)""",
    "entity_dictionary": f"WITH {_PHRASES}, {_ENTITY_LIST} SELECT entity, entity_id FROM entity_list",
    "entity_location": f"""WITH {_PHRASES}, {_ENTITY_LIST}
SELECT doc_id, entity_id FROM phrases JOIN entity_list USING (entity)""",
    "match_entities": _entity_match("product(n)", _ALL_KNOWN),
    "match_entities_any": _entity_match("count(*)", ""),
    "match_entities_indexed": f"""SELECT *, 'all' AS mode FROM ({_entity_match('product(n)', _ALL_KNOWN)})
UNION ALL SELECT *, 'any' AS mode FROM ({_entity_match('count(*)', '')})""",
}
