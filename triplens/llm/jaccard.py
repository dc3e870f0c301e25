"""Similarity join of documents on the Jaccard measure of word n-grams, by vertical partitioning.

All n-grams have one global order: by hash, with the frequent ones last. The order is cut into
fragments, a document's set thereby into segments. Overlaps are counted for each pair in each
fragment on its own and summed per pair; a pair that cannot reach the threshold after the first
fragments is dropped before the others are counted. No task ever needs more than two segments.

Pairs come from prefixes: two sets over the threshold share an n-gram among the first
``n - ceil(threshold * n) + 1`` of each in the global order, and what they have in common is bounded by the
smaller rest from the first such n-gram on. Each set also has a sketch, the parities of its n-grams per bucket of
their hash: the buckets in which two sketches differ are at most the n-grams that only one of the sets has. Pairs
that either bound rules out are never formed, so sets that share much and still don't link cost no row. Documents
with the same set are one vertex. What is asked for are the classes, so a group of thousands of near copies need not be
expanded into all its pairs: by a few n-grams of their prefixes, vertices are first compared with one
leader, and only pairs whose classes still differ are compared after that, all of them. The
classes are those of the full join.

Hashes have 64 bits, for n-grams as for vertices; a false equality among n of them has
probability n**2 / 2**65.

Defined results: null and empty texts have an empty set and are linked with nothing, their class
is their own id; a text shorter than n words is one n-gram; repeated rows are in one class; a null
id takes no part in the smallest id, and a class without any id has a null id; an empty table gives
no rows; other columns are not looked at. Of a very long text, a fifth of the n-grams are
postings, and its set is cut into four segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import discard, located, stored, table
from triplens.llm.components import components
from triplens.llm.words import window_hashes, word_hashes

#: N-grams counted more often than this go to the end of the global order, at most so many of them,
#: counted in chunks of so many n-grams. All three only shape the order, which any choice leaves
#: right; the second bounds what is sent out.
FREQUENT, MOST_FREQUENT, CHUNK_GRAMS = 8, 500_000, 3_000_000
#: N-grams that two prefixes must share; fewer for sets that are smaller than this.
SHARED = 1
#: Buckets of a sketch, 64 to a long. More of them tell larger sets apart; any number leaves the result right.
SKETCH = 512
#: Fragments of the order: four ranges of hashes, the frequent n-grams behind the last. One is counted at a time.
FRAGMENTS = 4
#: Bits (as a power of two) of the filter that tells whose segments are wanted; it only saves work.
FILTER_BITS = 22
#: Members of n-grams are compared with leaders, for at most so many rounds, while more pairs are left over than this many
#: per member and one of ``MERGING`` pairs compared is a link. That looks at a few n-grams of each prefix, of which two sets must share some. It only merges
#: classes early; the last round looks at whole prefixes.
PAIRS_PER_MEMBER, LEADER_ROUNDS, LEAD_GRAMS, LEAD_SHARED, MERGING = 16, 4, 8, 2, 4


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text; A to Z are lower-cased."""
    words = text.encode().lower().split() if text else []
    return np.unique(window_hashes(word_hashes(words), min(n, max(1, len(words))))) if words else np.zeros(0, np.uint64)


def vertex_of(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


class Order:
    """The global order: by hash, then the frequent n-grams by their count."""

    def __init__(self, frequent: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.frequent = np.zeros(0, np.uint64) if frequent is None else frequent
        if len(self.frequent):
            by_hash = np.argsort(self.frequent)
            self.frequent, self.counts = self.frequent[by_hash], counts[by_hash]

    def places(self, grams: np.ndarray) -> np.ndarray:
        """Place in ``frequent`` of each n-gram, -1 if it is not in there."""
        if not len(self.frequent):
            return np.full(len(grams), -1)
        at = np.minimum(np.searchsorted(self.frequent, grams), len(self.frequent) - 1)
        return np.where(self.frequent[at] == grams, at, -1)

    def prefix(self, grams: np.ndarray, percent: int) -> np.ndarray:
        needed = (percent * len(grams) + 99) // 100
        size = len(grams) - needed + min(SHARED, needed)
        places = self.places(grams)
        if not (places[:size] >= 0).any():
            return grams[:size]
        late = np.flatnonzero(places >= 0)
        late = late[np.argsort(self.counts[places[late]], kind="stable")]
        return np.concatenate([grams[places < 0], grams[late]])[:size]


def sketch(grams: np.ndarray) -> list[int]:
    """Whether an odd number of n-grams is in each bucket, as longs. Buckets go by the low bits, the order by the high ones."""
    odd = np.bincount((grams % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    key = F.lit(None).cast("string").alias("key")
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), key)


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], list(columns))


def make_sets(texts: DataFrame, n: int, percent: int, order: Order) -> DataFrame:
    """(doc_id, key, v, n, prefix, sketch) of ``texts`` (doc_id, text, key); ``v`` is null for an empty set."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vertices, sizes, prefixes, sketches = [], [], [], []
            for text in batch.column(1):
                grams = ngram_set(text.as_py(), n)
                sizes.append(len(grams))
                vertices.append(vertex_of(grams) if len(grams) else None)
                prefixes.append(order.prefix(grams, percent).tobytes() if len(grams) else b"")
                sketches.append(sketch(grams) if len(grams) else None)
            yield _batch({"doc_id": (batch.column(0), None), "key": (batch.column(2), None), "v": (vertices, pa.int64()),
                          "n": (sizes, pa.int64()), "prefix": (prefixes, pa.binary()), "sketch": (sketches, pa.list_(pa.int64()))})

    return texts.mapInArrow(sets, "doc_id long, key string, v long, n long, prefix binary, sketch array<long>")


def _some_of(prefix: np.ndarray, count: int) -> np.ndarray:
    """Places of a few n-grams of a prefix: those of smallest hash, so prefixes that overlap have some of them in common."""
    if len(prefix) <= count:
        return np.arange(len(prefix))
    return np.argpartition(prefix.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), count)[:count]


def entries_of(vertices: DataFrame, some: int | None = None) -> DataFrame:
    """(h, v, n, c, place, before): one row per n-gram of each prefix, or of ``some`` of them, from a row per vertex.

    ``before`` is the n-gram one place before, or h itself at the first place.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = [np.frombuffer(blob, "<i8") for blob in batch.column(3).to_pylist()]
            places = [np.arange(len(p)) if some is None else _some_of(p, some) for p in prefixes]
            lengths = [len(chosen) for chosen in places]
            if sum(lengths):
                yield _batch({
                    "h": (np.concatenate([p[chosen] for p, chosen in zip(prefixes, places)]), pa.int64()),
                    **{name: (np.repeat(batch.column(at).to_numpy(), lengths), pa.int64()) for at, name in enumerate(("v", "n", "c"))},
                    "place": (np.concatenate(places), pa.int64()),
                    "before": (np.concatenate([p[np.maximum(chosen - 1, 0)] for p, chosen in zip(prefixes, places)]), pa.int64()),
                })

    return vertices.select("v", "n", "c", "prefix").mapInArrow(expand, "h long, v long, n long, c long, place long, before long")


def frequent_order(texts: DataFrame, n: int) -> Order:
    """The order with frequent n-grams last.

    A task counts the n-grams of a chunk of distinct sets and sends those that occur there twice or
    more, so what is shuffled is a small part of all n-grams, and whatever is frequent is among it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def summed():
            values, times = np.unique(np.concatenate(list(held.values())), return_counts=True)
            again = times > 1
            return _batch({"h": (values[again].view(np.int64), pa.int64()), "k": (times[again], pa.int64())})

        for batch in batches:
            for text in batch.column(0):
                grams = ngram_set(text.as_py(), n)
                if len(grams) and (v := vertex_of(grams)) not in held:
                    held[v] = grams
                    size += len(grams)
                    if size > CHUNK_GRAMS:
                        yield summed()
                        held, size = {}, 0
        if held:
            yield summed()

    times = texts.select("text").mapInArrow(count, "h long, k long").groupBy("h").agg(F.sum("k").alias("k"))
    most = times.where(F.col("k") > FREQUENT).orderBy(F.desc("k"), "h").limit(MOST_FREQUENT).toPandas()
    return Order(most["h"].to_numpy(np.int64).view(np.uint64), most["k"].to_numpy(np.int64))


def _place(v: int, doc_id: int | None) -> int:
    mask = (1 << 64) - 1
    mixed = ((v & mask) * 0x9E3779B97F4A7C15 ^ ((doc_id or 0) & mask) * 0xC2B2AE3D27D4EB4F) & mask
    return mixed >> (64 - FILTER_BITS)


def _filter(wanted: DataFrame) -> np.ndarray:
    """A bit for the place of each (v, first_id); the bits are put together by Spark."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_place(v, i) for v, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield _batch({"place": (found, pa.int64())})

    bit = F.expr("shiftleft(1L, cast(place % 64 AS int))")
    words = wanted.select("v", "first_id").mapInArrow(places, "place long").groupBy(
        F.expr("place div 64").alias("word")
    ).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def segments(texts: DataFrame, n: int, order: Order, wanted: DataFrame) -> DataFrame:
    """(v, fragment, grams, behind): the sets of ``wanted`` (v, first_id), cut where the global order
    is cut, with the number of n-grams in later fragments. A vertex has a row for every fragment.

    Texts are not moved: a filter of fixed size tells which of them are wanted. The few others that
    it lets through find no pair later.
    """
    bits = _filter(wanted)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ([], [], [], [])
            for text, doc_id in zip(batch.column(1), batch.column(0).to_pylist()):
                grams = ngram_set(text.as_py(), n)
                if not len(grams):
                    continue
                v = vertex_of(grams)
                place = _place(v, doc_id)
                if not int(bits[place >> 6]) >> (place & 63) & 1:
                    continue
                fragment = np.where(order.places(grams) >= 0, FRAGMENTS - 1, (grams >> np.uint64(62)).astype(np.int64))
                for f in range(FRAGMENTS):
                    row = v, f, grams[fragment == f].view(np.int64), int((fragment > f).sum())
                    for column, value in zip(rows, row):
                        column.append(value)
            yield _batch({"v": (rows[0], pa.int64()), "fragment": (rows[1], pa.int64()),
                          "grams": (rows[2], pa.list_(pa.int64())), "behind": (rows[3], pa.int64())})

    return texts.select("doc_id", "text").mapInArrow(cut, "v long, fragment long, grams array<long>, behind long")


def _counted(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b, common, gain): n-grams in common, counted in the one fragment of ``parts``,
    and how many more there can be in the fragments behind it."""
    a = parts.select(F.col("v").alias("a"), F.col("grams").alias("grams_a"), F.col("behind").alias("behind_a"))
    b = parts.select(F.col("v").alias("b"), F.col("grams").alias("grams_b"), F.col("behind").alias("behind_b"))
    counted = pairs.select("a", "b").join(a, "a").join(b, "b").select(
        "a", "b", F.size(F.array_intersect("grams_a", "grams_b")).alias("k"), F.least("behind_a", "behind_b").alias("gain")
    )
    # A row of the corpus that occurs twice has its segments twice; they count once.
    return counted.groupBy("a", "b").agg(F.max("k").alias("common"), F.max("gain").alias("gain"))


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` (a, b, na, nb) that reach the threshold.

    A fragment is counted at a time and stored. A pair can still gain at most the smaller
    number of n-grams behind it; one that can't reach
    ``overlap * 100 >= percent * (na + nb - overlap)`` even so goes. Behind the last fragment
    nothing is left to gain, so those that remain are the links.
    """
    state = pairs.withColumn("overlap", F.lit(0).cast("long"))
    for fragment in range(FRAGMENTS):
        counted = _counted(state, parts.where(F.col("fragment") == fragment))
        state = state.join(counted, ["a", "b"]).withColumn("overlap", F.col("overlap") + F.col("common"))
        reachable = (100 + percent) * (F.col("overlap") + F.col("gain")) >= percent * (F.col("na") + F.col("nb"))
        state = stored(state.where(reachable).select("a", "b", "na", "nb", "overlap"), "overlaps")
    return state.select("a", "b")


def _compatible(na: str, nb: str, percent: int):
    """Sets whose sizes differ too much can't reach the threshold."""
    low, high = F.least(na, nb), F.greatest(na, nb)
    return 100 * low >= percent * high


def _mixed(held: DataFrame, round_: int) -> DataFrame:
    """(h, s, q, v2, n2, c2) of the n-grams held by several classes: members, the sum of squares of each class's
    members, and a leader, which is one of the vertices and another in each round. The first one has the fewest
    rarer n-grams, as the text has that the others are copies of."""
    rank = F.xxhash64("v", F.lit(round_))
    lead = F.min(F.struct(
        (F.col("place") if round_ == 0 else F.lit(0).cast("long")).alias("place"), rank.alias("r"),
        F.col("v").alias("v2"), F.col("n").alias("n2"), F.col("c").alias("c2"),
    ))
    by_class = held.groupBy("h", "c").agg(F.count(F.lit(1)).alias("k"), lead.alias("lead"))
    whole = by_class.groupBy("h").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("q"), F.min("lead").alias("lead"))
    return whole.where("q < s * s").select("h", "s", "q", "lead.v2", "lead.n2", "lead.c2")


def _pairs(joined: DataFrame, percent: int, enough=None) -> DataFrame:
    """(a, b, na, nb) of vertices that share ``enough`` n-grams of ``joined``, a below b."""
    swap = F.col("v") > F.col("v2")

    def either(one: str, two: str):
        return F.when(swap, F.col(two)).otherwise(F.col(one))

    pairs = joined.where(_compatible("n", "n2", percent)).select(
        F.least("v", "v2").alias("a"), F.greatest("v", "v2").alias("b"), either("n", "n2").alias("na"), either("n2", "n").alias("nb")
    )
    if enough is None:
        return pairs.distinct()
    return pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= enough).drop("k")


def _differing(one: str, two: str):
    """Buckets in which two sketches differ; both sets together have at least so many n-grams not in common."""
    bits = [F.bit_count(F.col(one)[k].bitwiseXOR(F.col(two)[k])) for k in range(SKETCH // 64)]
    return sum(bits[1:], bits[0])


def _reachable(held: DataFrame, percent: int) -> DataFrame:
    """Of the pairs of different classes in ``held`` (h, v, n, c, place, before, sketch), joined on h, those that can link.

    A pair is told by the first n-gram that its prefixes share. Other rows of it go where they are known: those whose n-grams
    one place before are equal. From the first shared n-gram on, two sets have in common at most the smaller rest.
    """
    other = held.select("h", *[F.col(name).alias(f"{name}2") for name in ("v", "n", "c", "place", "before", "sketch")])
    both = F.col("n") + F.col("n2")
    room = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
    first = (F.col("place") == 0) | (F.col("place2") == 0) | (F.col("before") != F.col("before2"))
    return held.join(other, "h").where("c < c2").where((100 + percent) * room >= percent * both).where(first).where(
        (100 + percent) * _differing("sketch", "sketch2") <= (100 - percent) * both
    )


def _labelled(vertices: DataFrame, labels: DataFrame) -> DataFrame:
    """``vertices`` with their class c of ``labels`` (v, c); one without a link is a class of its own."""
    return vertices.join(labels, "v", "left").withColumn("c", F.coalesce("c", "v"))


def classes(vertices: DataFrame, parts_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame | None:
    """(v, c) of all vertices that have a link, from ``vertices`` (v, n, prefix, sketch).

    ``parts_of`` gives the segments of given vertices (v). Classes are joined to vertices, a row each, before
    the prefixes are laid out, once a round and stored, as a round reads them two or three times.
    """
    labels, links, tested, round_, last, merging = None, None, None, 0, False, True
    while not last:
        classed = vertices.withColumn("c", F.col("v")) if labels is None else (
            stored(_labelled(vertices.select("v", "n", "prefix"), labels), "classed")
        )
        some = entries_of(classed, LEAD_GRAMS)
        mixed = stored(_mixed(some, round_), "mixed")
        left, members = mixed.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2), F.sum("s")).first()
        last = not left or left <= PAIRS_PER_MEMBER * members or round_ == LEADER_ROUNDS or not merging
        round_ += 1
        if last:
            # Only the postings of n-grams that still are in several classes are joined with each other.
            held = entries_of(classed)
            several = held.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("h")
            held = held.join(stored(several, "several"), "h").join(vertices.select("v", "sketch"), "v")
            pairs = _pairs(_reachable(stored(held, "held"), percent), percent)
        else:
            joined = some.join(mixed.drop("s", "q"), "h").where("c <> c2")
            pairs = _pairs(joined, percent, F.least(F.lit(LEAD_SHARED), "na", "nb"))
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if labels is not None:
            discard(classed)
        count = pairs.count()
        if not count:
            continue
        parts = parts_of(pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct())
        found = verified(pairs, parts, percent)
        discard(parts)
        merging = last or found.count() * MERGING >= count
        links = found if links is None else links.unionByName(found)
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        labels = components(links)
    return labels


def _classified(texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sets, known): the sets of ``texts`` (doc_id, text, key) and (v, c, first_id), the class and smallest id of each vertex."""
    order = frequent_order(texts, n)
    sets = stored(make_sets(texts, n, percent, order), "sets")
    vertices = sets.where("v IS NOT NULL").groupBy("v").agg(F.min("doc_id").alias("first_id"))
    vertices = stored(vertices, "vertices")
    # Of the documents with one set, one speaks for all.
    own = sets.where("v IS NOT NULL").groupBy("v").agg(*[F.first(name).alias(name) for name in ("n", "prefix", "sketch")])
    own = stored(own, "own")

    def parts_of(compared: DataFrame) -> DataFrame:
        return stored(segments(texts, n, order, vertices.join(compared, "v")), "segments")

    labels = classes(own, parts_of, percent)
    if labels is None:
        return sets, vertices.withColumn("c", F.col("v"))
    return sets, stored(_labelled(vertices, labels), "known")


def similarity_classes(
    docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``."""
    sets, known = _classified(_texts(docs, id_column, text_column), n, percent)
    smallest = known.groupBy("c").agg(F.min("first_id").alias("component_id"))
    known = stored(known.join(smallest, "c").select("v", "component_id"), "classes")
    return sets.select("doc_id", "v", "n").join(known, "v", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of each class of near duplicates the row with the smallest id; rows with an empty set all stay.

    Rows are told apart by their place in the files, not by their id: a null id is larger than all others,
    and of rows with one id any one stays, with its own text.
    """
    rows = located(docs)
    texts = rows.texts(id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    sets, known = _classified(texts, n, percent)
    classed = stored(sets.where("v IS NOT NULL").select("v", "doc_id", "key").join(known.select("v", "c"), "v"), "classed")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))).getField("key")
    stays = classed.groupBy("c").agg(first.alias("key"))
    gone = stored(classed.select("key").join(stays.select("key"), "key", "left_anti"), "gone")
    return rows.without(gone)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
         ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.c >= 80 * (na.n + nb.n - p.c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
