"""Positional word index and entity index over documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from triplens.functions.stem import stem_tokens
from triplens.functions.text import ENGLISH_STOP_WORDS, PUNCTUATION, clean_tokens, tagging_tokens
from triplens.operators.ids import dense_ids, hashed, hashed_ids
from triplens.operators.joins import salted_join, salts_of
from triplens.session import cut, stored


def tokenize(
    df: DataFrame,
    id_column: str,
    text: Column | str,
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    max_len: int | None = None,
    stem: bool = True,
    unicode: bool = False,
) -> DataFrame:
    """One row (id, word, location) per token. Map-only: documents are never shuffled."""
    text = F.col(text) if isinstance(text, str) else text
    tokens = clean_tokens(text, stops, max_len, unicode)
    if stem:
        tokens = stem_tokens(tokens)
    return (
        df.select(id_column, F.posexplode(tokens).alias("location", "word"))
        .where(F.col("word") != "")
        .select(id_column, "word", F.col("location").cast("long").alias("location"))
    )


def question_tokens(
    df: DataFrame,
    text: Column | str,
    stops: Iterable[str] = ENGLISH_STOP_WORDS,
    stem: bool = True,
    unicode: bool = False,
) -> DataFrame:
    """Add ``tokens``: the distinct tokens of a question in first-seen order."""
    text = F.col(text) if isinstance(text, str) else text
    tokens = clean_tokens(text, stops, None, unicode)
    if stem:
        tokens = stem_tokens(tokens)
    return df.withColumn("tokens", F.array_distinct(F.array_remove(tokens, "")))


def build_word_index(
    tokens: DataFrame, id_column: str = "post_id", ids: str = "hashed"
) -> tuple[DataFrame, DataFrame]:
    """``word_list`` (word, word_id) and ``word_location`` (word_id, id, location).

    ``hashed`` ids need no join and no shuffle of the occurrences; should words share a hash, all
    but one get another, and only the few occurrences of these are looked up. ``dense`` ids count
    up from 0 in word order; the occurrences are joined with the dictionary.
    """
    words, located = _encoded(tokens, "word", "word_id", ids)
    return words, located.select("word_id", id_column, "location")


def build_entity_index(
    entities: DataFrame, id_column: str = "post_id", ids: str = "hashed"
) -> tuple[DataFrame, DataFrame]:
    """``entity_list`` (entity, entity_id) and ``entity_location`` (id, entity_id).

    An entity named twice in a document keeps both rows. ``ids`` as in
    :func:`build_word_index`.
    """
    names, located = _encoded(entities, "entity", "entity_id", ids)
    return names, located.select(id_column, "entity_id")


def _encoded(rows: DataFrame, key: str, id_column: str, ids: str) -> tuple[DataFrame, DataFrame]:
    if ids not in ("dense", "hashed"):
        raise ValueError("ids is 'dense' or 'hashed'")
    # Dictionary and occurrences both come from what is stored here: texts are cut up once.
    rows = stored(rows, "occurrences")
    if ids == "hashed":
        dictionary, exceptions = hashed_ids(rows.select(key).distinct(), key, id_column)
        own = rows.withColumn(id_column, hashed(key))
        if exceptions.isEmpty():
            return dictionary, own
        other = exceptions.withColumnRenamed(id_column, "_other")
        own = own.join(other, key, "left").withColumn(id_column, F.coalesce("_other", id_column)).drop("_other")
        return dictionary, own
    # The counts that make the dictionary also tell which keys are frequent, so the join is
    # salted without a further pass over the rows.
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    dictionary = dense_ids(counts, key, id_column)
    total = dictionary.agg(F.sum("_n").alias("_n"))
    salted = dictionary.withColumn("_salts", salts_of(F.col("_n"), total.scalar()))
    hot = cut(salted.where("_salts IS NOT NULL").select(key, "_salts"))
    dictionary = dictionary.drop("_n")
    return dictionary, salted_join(rows, dictionary, [key], hot=hot)


def tag_tokens(
    text: Column | str, lexicon: dict[str, str], default: str = "NN"
) -> Column:
    """Lower-cased tokens of a text as an array of (token, tag), tags taken from ``lexicon``.

    Words outside the lexicon get ``default``; a punctuation mark is its own tag. The lexicon becomes
    part of the plan, so this is for some hundred words; :func:`tag_rows` takes a table of any size.
    """
    text = F.col(text) if isinstance(text, str) else text
    words_of: dict[str, list[str]] = {}
    for word, tag in lexicon.items():
        words_of.setdefault(tag, []).append(word.lower())

    longest = max((len(word) for words in words_of.values() for word in words), default=0)
    every = sorted({word for words in words_of.values() for word in words})

    def tagged(token: Column) -> Column:
        # Most tokens are longer than all words of the lexicon, or else one look-up tells that they are none of them.
        length = F.char_length(token)
        tag = F.when(length > max(longest, 1), F.lit(default)).when((length == 1) & token.rlike(PUNCTUATION), token)
        if every:
            tag = tag.when(~token.isin(every), F.lit(default))
        for name, words in sorted(words_of.items()):
            tag = tag.when(token.isin(sorted(words)), F.lit(name))
        return F.struct(token.alias("token"), tag.otherwise(F.lit(default)).alias("tag"))

    return F.transform(tagging_tokens(F.lower(text)), tagged)


# Words with their tags are broadcast up to this many (some tens of megabytes).
BROADCAST_WORDS = 500_000


def tag_rows(
    df: DataFrame, id_column: str, text: Column | str, lexicon: DataFrame, default: str = "NN"
) -> DataFrame:
    """One row (id, location, token, tag) per token, tags looked up in ``lexicon`` (token, tag).

    Tokens are lower-cased and cut as :func:`tag_tokens` does; a punctuation mark is its own tag,
    a word outside the lexicon, or without a tag there, gets ``default``; of several tags of a word the
    smallest counts. A lexicon counted to be small is broadcast. Of a larger one the most frequent tokens' tags
    are, so only the rows of rare tokens, of which none has a large share, are moved to meet theirs.
    """
    text = F.col(text) if isinstance(text, str) else text
    tokens = df.select(id_column, F.posexplode(tagging_tokens(F.lower(text))).alias("location", "token"))
    # The smallest string would be sought by sorting all rows, so repeated ones go first, by hash.
    tags = cut(lexicon.select(F.lower("token").alias("token"), F.col("tag").alias("_tag")).distinct())
    words = cut(tags.groupBy("token").agg(F.min("_tag").alias("_tag")))
    if words.count() <= BROADCAST_WORDS:
        found = tokens.join(F.broadcast(words), "token", "left")
    else:
        counts = cut(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n")))
        common = cut(_most_frequent(counts, BROADCAST_WORDS).join(words, "token", "left"))
        rare = tokens.join(F.broadcast(common.select("token")), "token", "left_anti")
        found = tokens.join(F.broadcast(common), "token").unionByName(rare.join(words, "token", "left"))
    mark = F.when((F.char_length("token") == 1) & F.col("token").rlike(PUNCTUATION), F.col("token"))
    tag = F.coalesce(mark, F.col("_tag"), F.lit(default))
    return found.select(id_column, F.col("location").cast("long").alias("location"), "token", tag.alias("tag"))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The tokens (token) of ``counts`` (token, _n) from some power of two on, at most ``most`` of them.

    If any are left out, more than ``most`` tokens are at least half as frequent as each of them, so none
    of them has a large share.
    """
    power = F.floor(F.log2("_n"))
    sizes = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, taken = 64, 0
    for row in sorted(sizes, reverse=True):
        taken += row["n"]
        if taken > most:
            break
        least = row["power"]
    return counts.where(power >= least).select("token")


def noun_phrases(
    df: DataFrame, id_column: str, tagged: Column | str, legacy_drop_last: bool = False
) -> DataFrame:
    """One row (id, entity) per noun phrase, in text order.

    A token whose tag starts with NN extends the phrase when the token directly before it has
    the very same tag, and starts a new phrase otherwise. The phrases are cut inside the row:
    every token is written behind a mark (new phrase, or space) and the text is split at the
    marks, so documents are not exploded and regrouped. ``legacy_drop_last`` leaves out the
    last phrase of each document.
    """
    tagged = F.col(tagged) if isinstance(tagged, str) else tagged
    new_phrase = "\n"
    # Marks that a caller's tokens hold are written as an escape and a letter.
    escape, escaped = "\x1a", (("\x1a", "\x1ae"), (new_phrase, "\x1an"))

    def written(item: Column, at: Column) -> Column:
        before = F.get(F.col("_tagged"), at - 1)["tag"]
        word = F.lower(item["token"])
        for plain, other in escaped:
            word = F.replace(word, F.lit(plain), F.lit(other))
        word = F.when(F.col("_plain"), item["token"]).otherwise(word)
        return (
            F.when(~item["tag"].startswith("NN"), F.lit(""))
            .when((at > 0) & (before == item["tag"]), F.concat(F.lit(" "), word))
            .otherwise(F.concat(F.lit(new_phrase), word))
        )

    line = F.array_join(F.transform("_tagged", written), "")
    # The line starts with the mark, so the first piece is always empty.
    phrases = F.array_remove(F.split(line, new_phrase), "")
    if legacy_drop_last:
        phrases = F.slice(phrases, 1, F.greatest(F.size(phrases) - 1, F.lit(0)))

    def read(phrase: Column) -> Column:
        plain = phrase
        for mark, other in reversed(escaped):
            plain = F.replace(plain, F.lit(other), F.lit(mark))
        return F.when(F.contains(phrase, F.lit(escape)), plain).otherwise(phrase)

    phrases = F.when(F.col("_plain"), phrases).otherwise(F.transform(phrases, read))
    # Whether a row's tokens have capitals or marks is asked once for the row, not for each token.
    whole = F.array_join(F.col("_tagged")["token"], "")
    plain = (F.lower(whole) == whole) & ~F.contains(whole, F.lit(escape)) & ~F.contains(whole, F.lit(new_phrase))
    return (
        df.select(id_column, tagged.alias("_tagged"))
        .withColumn("_plain", plain)
        .select(id_column, F.explode(phrases).alias("entity"))
    )


def noun_phrases_of_rows(
    tokens: DataFrame, id_column: str, order: str, legacy_drop_last: bool = False
) -> DataFrame:
    """As :func:`noun_phrases`, for a table with one tagged token (id, order, token, tag) a row.

    Documents are dealt out by id and their tokens sorted, which spills rather than gathering a document
    in memory. The sorted tokens stream by in batches; only the words of a phrase that may go on are kept.
    """

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
        """(ids, phrases) in order."""
        last, parts = None, None  # the row before the batch, and the words of the phrase it is in
        for batch in batches:
            if not len(batch):
                continue
            ids, words, tags = batch.columns
            before = last or batch.slice(0, 0)
            same_tag = _same_as_before(tags, before.column(2)) & ~tags.is_null().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~(_same_as_before(ids, before.column(0)) & same_tag))
            noun = pc.fill_null(pc.starts_with(tags, "NN"), False).to_numpy(zero_copy_only=False)
            if parts is not None:
                parts.append(words.slice(0, starts[0] if len(starts) else len(batch)))
                if len(starts):
                    yield before.column(0), _joined(pa.concat_arrays(parts), np.zeros(1, np.int64))
                    parts = None
            if len(starts):
                # The phrases that end within the batch; the last one may go on.
                whole = starts[:-1][noun[starts[:-1]]]
                inside = noun.copy()
                inside[: starts[0]] = inside[starts[-1] :] = False
                if len(whole):
                    places = (np.cumsum(inside) - inside)[whole]
                    yield ids.take(pa.array(whole)), _joined(words.filter(pa.array(inside)), places)
                if noun[starts[-1]]:
                    parts = [words.slice(starts[-1])]
            last = batch.slice(len(batch) - 1)
        if parts is not None:
            yield last.column(0), _joined(pa.concat_arrays(parts), np.zeros(1, np.int64))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last phrase, which is kept if its document has another
        for ids, names in cut_up(batches):
            if legacy_drop_last:
                if held is not None:
                    ids, names = pa.concat_arrays([held[0], ids]), pa.concat_arrays([held[1], names])
                held = ids.slice(len(ids) - 1), names.slice(len(names) - 1)
                kept = pa.array(_same_as_before(ids, ids.slice(0, 0))[1:])
                ids, names = ids.slice(0, len(ids) - 1).filter(kept), names.slice(0, len(names) - 1).filter(kept)
            yield pa.RecordBatch.from_arrays([ids, names], [id_column, "entity"])

    rows = tokens.select(F.col(id_column).alias("id"), F.col(order).alias("at"), F.lower("token").alias("word"), "tag")
    schema = StructType([StructField(id_column, tokens.schema[id_column].dataType), StructField("entity", StringType())])
    return rows.repartition("id").sortWithinPartitions("id", "at", "word").select("id", "word", "tag").mapInArrow(phrases, schema)


def _same_as_before(values: pa.Array, before: pa.Array) -> np.ndarray:
    """Whether each value equals the one before it, null like null; ``before`` has the value before the first, or none."""
    whole = pa.concat_arrays([before, values])
    left, right = whole.slice(0, len(whole) - 1), whole.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(left, right), False), pc.and_(pc.is_null(left), pc.is_null(right)))
    same = same.to_numpy(zero_copy_only=False)
    return same if len(before) else np.concatenate([[False], same])


def _joined(words: pa.Array, starts: np.ndarray) -> pa.Array:
    """Words joined by spaces, a text from each of ``starts`` up to the next; null words are left out."""
    valid = words.is_valid().to_numpy(zero_copy_only=False)
    places = np.concatenate([[0], np.cumsum(valid)])[np.append(starts, len(words))]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), words.drop_null()), " ").cast(pa.string())
