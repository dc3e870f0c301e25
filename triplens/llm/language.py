"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams of one to three letters, a word
being framed by spaces. A document's own most frequent n-grams are compared with each profile: an
n-gram is out of place by the difference of its two ranks, or by the profile's length if the
profile lacks it. The language with the smallest sum wins, ties going to the language first in
the alphabet.

Defined results: a null text, or one without any letter, is ``und`` with score 0, and so is every
text when there is nothing to learn from; rows without language or id teach nothing; repeated rows
are each predicted; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplens.llm.common import stored, table

UNKNOWN = "und"
#: N-grams of a profile, of a language as of a document.
PROFILE = 400
#: Documents of a language that its profile is learned from, in the mean; chosen by hash of the id.
LEARN_FROM = 2000
#: Profiles sent out are bounded by this many languages.
MOST_LANGUAGES = 1000
_BITS = 21  # of a code point; three fit into an integer


def _letter_table() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_tables: dict[str, np.ndarray] = {}


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with 32 for every run of other characters."""
    if "letters" not in _tables:
        _tables["letters"] = _letter_table()
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    is_letter = _tables["letters"][points]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    points = np.where(is_letter, points, 32)
    points = np.concatenate([[32], points, [32]])
    return points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]


def ngrams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three characters as integers, and their counts."""
    two = points[:-1] << _BITS | points[1:]
    three = points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:]
    # A space counts inside a longer n-gram only, and only at its ends.
    one, three = points[points != 32], three[points[1:-1] != 32]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, the most frequent first, ties by n-gram."""
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """Rank of every profiled n-gram in every language."""

    def __init__(self, ranks: dict[str, list[int]], size: int = PROFILE):
        self.languages, self.size = sorted(ranks), size
        self.grams = np.unique(np.concatenate([np.array(ranks[x], np.int64) for x in self.languages] or [np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.languages), len(self.grams)), -1, np.int64)
        for at, language in enumerate(self.languages):
            own = np.array(ranks[language], np.int64)
            self.ranks[at, np.searchsorted(self.grams, own)] = np.arange(len(own))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): one less the mean distance as a share of the largest possible."""
        points = letters(text) if text else np.zeros(0, np.int64)
        if not len(points) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(*ngrams(points), self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where(self.grams[at] == own, self.ranks[:, at], -1)
        away = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))))
        distance = away.sum(axis=1)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def held_out(id_column: str = "doc_id") -> Column:
    """True where the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))


def learn(
    labelled: DataFrame, size: int = PROFILE, learn_from: int = LEARN_FROM,
    id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
) -> Profiles:
    """Profiles of the languages in ``labelled``.

    A language with more than ``learn_from`` rows is learned from a share of them, taken by hash
    of the id, so that the mean number is ``learn_from``. Of the corpus only the profiles reach
    the driver: ``size`` n-grams for at most ``MOST_LANGUAGES`` languages.
    """
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.k for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("k")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return Profiles({}, size)
    parts = 1_000_000
    share = F.create_map(*[F.lit(x) for lang, k in sizes.items() for x in (lang, -(-parts * learn_from // k))])
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                points = letters(text.as_py())
                if len(points):
                    held.setdefault(lang, []).append(ngrams(points))
                    if len(held[lang]) == 500:
                        held[lang] = [summed(held[lang])]
        for lang, found in held.items():
            grams, counts = summed(found)
            columns = [pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "k"])

    def summed(found: list) -> tuple[np.ndarray, np.ndarray]:
        grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
        return grams, np.bincount(at, np.concatenate([k for _, k in found])).astype(np.int64)

    counts = chosen.select("lang", "text").mapInArrow(count, "lang string, gram long, k long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("k").alias("k"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("k"), "gram"))
    best = stored(counts.withColumn("place", place).where(F.col("place") <= size), "profiles").collect()
    ranks: dict[str, list[int]] = {}
    for row in sorted(best, key=lambda r: (r.lang, r.place)):
        ranks.setdefault(row.lang, []).append(row.gram)
    return Profiles(ranks, size)


def predict(docs: DataFrame, profiles: Profiles, text_column: str = "text") -> DataFrame:
    """``docs`` with two more columns, lang_pred and score (their own of these names are replaced)."""
    from pyspark.sql.functions import arrow_udf

    kind = "lang_pred string, score double"

    @arrow_udf(kind)
    def predicted(texts: pa.Array) -> pa.Array:
        found = [profiles.predict(text.as_py()) for text in texts]
        names = pa.array([x for x, _ in found], pa.string())
        return pa.StructArray.from_arrays([names, pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"])

    marked = docs.withColumn("_predicted", predicted(F.col(text_column)))
    return marked.withColumns({"lang_pred": F.col("_predicted.lang_pred"), "score": F.col("_predicted.score")}).drop("_predicted")


def identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` in a language: those with a letter that share some n-gram with a profile."""
    profiles = learn(docs.where(~held_out()))
    names = docs.columns
    kept = predict(docs.select(F.struct(*names).alias("row"), F.col("text").alias("text")), profiles)
    return kept.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select("row.*")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out()))
    found = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")
