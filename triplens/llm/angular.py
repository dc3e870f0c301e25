"""Hard negatives by angular triangle filtering.

Vectors are made integer, and a score is an integer inner product. Each row keeps its norm and its
angles to some reference directions. For two rows the difference of their angles to a reference
bounds their own angle from below, and the sum from above; the cosines of these bounds times the norms,
widened by more than all rounding, bound their score. Only rows whose bounds overlap the
window of wanted scores are scored.

Rows lie in blocks of neighbours (nearest reference, then the angle to it), each with its ranges of
angles and norms. An anchor visits the blocks whose bounds overlap its window, and inside a
block the rows whose bounds do. Its first window is opened by the rows of its own block: the k-th best
positive there is a score that any better one must reach. Blocks stay where they are shuffled to once,
and anchors stream by them; a block visited by very many anchors is repeated for each share of them.

References are a bounded sample (``SAMPLE`` rows); they only decide how much is skipped, never what is found.

Defined results: rows with a null label, a null or empty vector, null or non-finite components, or a vector
of another length than most take no part, nor do those whose integer norm is 2**30 or more, as
their scores would not fit a long; rows of one id are rows of their own; a null id is no anchor, and
comes last among ties; ties of score and id go by the place in the table; an anchor without positive, or
a pair without negative, gives no rows; an empty table gives none; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplens.llm.common import stored, table
from triplens.llm.meet import meet

REFERENCES, SAMPLE = 16, 2000
BLOCK_ROWS, BLOCK_VISITS, CHUNK_BLOCKS = 4096, 65_536, 1024
#: Radians that bounds are widened by: an arc cosine near 1 is exact to some 1e-7 only.
SLACK = 1e-6
_TOGETHER = 64  # anchors scored at a time


def integer_rows(vectors: DataFrame, label: Column, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(row, id, label, x) of the rows that take part; ``x`` is floor(scale * component)."""
    as_double = F.col(vector_column).cast("array<double>")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
        label.cast("long").alias("label"), as_double.alias("vector"),
    ).where("label IS NOT NULL AND size(vector) > 0")
    rows = rows.where("forall(vector, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))")
    rows = rows.where(f"aggregate(vector, 0D, (s, v) -> s + ({scale} * abs(v) + 1) * ({scale} * abs(v) + 1)) < pow(2D, 60)")
    rows = rows.withColumn("x", F.expr(f"transform(vector, v -> try_cast(floor({scale} * v) AS INT))")).drop("vector")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (lengths.d if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def scores(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows held as doubles."""
    # No partial sum exceeds the product of the norms, so below 2**53 doubles are exact in any order.
    largest = np.sqrt((one * one).sum(axis=1).max(initial=0) * (two * two).sum(axis=1).max(initial=0))
    if largest < 2**52:
        return (one @ two.T).astype(np.int64)
    return one.astype(np.int64) @ two.astype(np.int64).T


def choose_references(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit directions far from each other: each next one is farthest from those already chosen."""
    norms = np.sqrt((sample * sample).sum(axis=1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.eye(1, max(1, sample.shape[1]))
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < count and nearest.min() < 1 - 1e-6:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(rows: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles in radians, 0 for a zero row, whose scores the norm bounds anyway."""
    cosines = rows @ references.T / np.where(norms > 0, norms, 1)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0.0)


def score_bounds(norm, angles, norm_low, norm_high, low, high) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score of each anchor (rows) with each block or row (columns).

    ``low`` and ``high`` are the columns' ranges of angles, equal for a single row.
    """
    least, most = np.zeros((len(norm), len(low))), np.full((len(norm), len(low)), np.pi)
    for k in range(angles.shape[1]):
        mine = angles[:, k : k + 1]
        np.maximum(least, low[:, k] - mine, out=least)
        np.maximum(least, mine - high[:, k], out=least)
        np.minimum(most, mine + high[:, k], out=most)
        np.minimum(most, 2 * np.pi - mine - low[:, k], out=most)
    near, far = np.cos(np.maximum(least - SLACK, 0)), np.cos(np.minimum(np.maximum(most, least) + SLACK, np.pi))
    # A negative cosine is least with the longest norm, and largest with the shortest.
    largest = norm[:, None] * np.where(near > 0, near * norm_high, near * norm_low)
    smallest = norm[:, None] * np.where(far < 0, far * norm_high, far * norm_low)
    room = 1e-9 * norm[:, None] * norm_high + 1e-3
    return smallest - room, largest + room


def best(found: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of the places ``found`` by score, id and row."""
    if len(found) > k:
        found = found[score[found] >= np.partition(score[found], -k)[-k]]
    return found[np.lexsort((rows[found], ids[found], -score[found]))[:k]]


def _ids(column: pa.Array) -> np.ndarray:
    """Ids to sort by; null comes last."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


class Block:
    """Rows of a block, and the scoring of anchors against them."""

    def __init__(self, held: pa.RecordBatch):
        self.row, self.label, self.norm = (held.column(name).to_numpy() for name in ("row", "label", "norm"))
        self.id, self.order = held.column("id"), _ids(held.column("id"))
        self.x, self.angles = matrix(held.column("x")), matrix(held.column("angles"))

    def overlapping(self, asked: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor's place, rows whose bounds overlap its window, scores of all rows scored) anchor by anchor."""
        x, angles, norm = matrix(asked.column("x")), matrix(asked.column("angles")), asked.column("norm").to_numpy()
        low, high = asked.column("low").to_numpy(), asked.column("high").to_numpy()
        for begin in range(0, len(x), _TOGETHER):
            part = slice(begin, begin + _TOGETHER)
            least, largest = score_bounds(norm[part], angles[part], self.norm, self.norm, self.angles, self.angles)
            open_ = (largest >= low[part][:, None]) & (least <= high[part][:, None])
            columns = np.flatnonzero(open_.any(axis=0))
            exact = scores(x[part], self.x[columns])
            for at in range(len(exact)):
                full = np.zeros(len(self.row), np.int64)
                full[columns] = exact[at]
                yield begin + at, np.flatnonzero(open_[at]), full


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` with norm, angles, and the cell and ring that neighbours share."""
    sample = rows.orderBy(F.xxhash64("row")).limit(SAMPLE).select("x").toArrow().column("x").combine_chunks()
    references = choose_references(matrix(sample), REFERENCES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = matrix(batch.column("x"))
                norms = np.sqrt((x * x).sum(axis=1))
                angles = angles_to(x, norms, references)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * angles.shape[1]), pa.array(angles.ravel()))
                cell = angles.argmin(axis=1)
                added = [pa.array(norms), lists, pa.array(cell.astype(np.int32)), pa.array(angles.min(axis=1))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "norm", "angles", "cell", "ring"])

    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema.fields)
    return rows.mapInArrow(measure, f"{kinds}, norm double, angles array<double>, cell int, ring double")


def in_blocks(rows: DataFrame, is_anchor: Callable[[Column], Column], k: int) -> DataFrame:
    """``rows`` with their block; anchors get ``low``, the k-th best positive's score in the block (or minus infinity)."""
    names = ["row", "id", "label", "x", "norm", "angles", "anchor"]
    ordered = rows.withColumn("anchor", F.coalesce(is_anchor(F.col("id")), F.lit(False))).repartitionByRange(
        "cell", "ring", "row"
    ).sortWithinPartitions("cell", "ring", "row").select(*names)
    size = BLOCK_ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            while len(batch):
                taken = batch.slice(0, size - held)
                batch = batch.slice(len(taken))
                waiting.append(taken)
                held += len(taken)
                if held == size:
                    yield closed(waiting, number)
                    waiting, held, number = [], 0, number + 1
        if waiting:
            yield closed(waiting, number)

    def closed(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        block = Block(whole)
        low = np.full(len(whole), -np.inf)
        anchors = np.flatnonzero(whole.column("anchor").to_numpy(zero_copy_only=False))
        for begin in range(0, len(anchors), _TOGETHER):
            some = anchors[begin : begin + _TOGETHER]
            for at, score in zip(some, scores(block.x[some], block.x)):
                same = (block.label == block.label[at]) & (block.row != block.row[at])
                if same.sum() >= k:
                    low[at] = np.partition(score[same], -k)[-k]
        blocks = pa.array(np.full(len(whole), number, np.int64))
        return pa.RecordBatch.from_arrays([blocks, *whole.columns, pa.array(low)], ["block", *whole.schema.names, "low"])

    return ordered.mapInArrow(
        cut, "block long, row long, id long, label long, x array<int>, norm double, angles array<double>, anchor boolean, low double"
    )


def ranges_of(blocks: DataFrame, references: int) -> DataFrame:
    """One row per block: the ranges of its rows' norms and angles."""
    each = [F.col("angles")[i] for i in range(references)]
    return blocks.groupBy("block").agg(
        F.min("norm").alias("norm_low"), F.max("norm").alias("norm_high"),
        F.array(*map(F.min, each)).alias("angle_low"), F.array(*map(F.max, each)).alias("angle_high"),
    )


def visits(anchors: DataFrame, ranges: DataFrame, count: int) -> DataFrame:
    """``anchors`` (with ``low`` and ``high``) once for each block whose bounds overlap their window.

    Ranges are dealt in chunks, and each chunk meets all anchors: the asked rows against all blocks.
    """
    chunks = -(-count // CHUNK_BLOCKS)

    def build(held: pa.RecordBatch):
        return [held.column("block").to_numpy()] + [held.column(n).to_numpy() for n in ("norm_low", "norm_high")] + [
            matrix(held.column(n)) for n in ("angle_low", "angle_high")
        ]

    def work(held, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block, *bounds = held
        angles, norm = matrix(asked.column("angles")), asked.column("norm").to_numpy()
        low, high = asked.column("low").to_numpy(), asked.column("high").to_numpy()
        for begin in range(0, len(asked), _TOGETHER):
            part = slice(begin, begin + _TOGETHER)
            least, largest = score_bounds(norm[part], angles[part], *bounds)
            at, where = np.nonzero((largest >= low[part][:, None]) & (least <= high[part][:, None]))
            taken = asked.slice(begin, _TOGETHER).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(block[where]), *taken.columns], ["block", *taken.schema.names])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return meet(
        ranges.withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks))),
        anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))),
        ["chunk"], build, work, f"block long, {kinds}",
    )


def visited(blocks: DataFrame, visits: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(Block, anchors)`` of every block and the anchors that visit it."""
    busy = visits.groupBy("block").count().where(F.col("count") > BLOCK_VISITS)
    busy = stored(busy.select("block", F.ceil(F.col("count") / BLOCK_VISITS).alias("shares")), "busy")
    rows = blocks.drop("anchor", "low")
    if busy.isEmpty():
        rows, visits = (frame.withColumn("share", F.lit(0).cast("long")) for frame in (rows, visits))
    else:
        shares = F.coalesce("shares", F.lit(1).cast("long"))
        rows = rows.join(busy, "block", "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)))
        visits = visits.join(busy, "block", "left").withColumn("share", F.pmod(F.xxhash64("row"), shares))
        rows, visits = rows.drop("shares"), visits.drop("shares")
    return meet(rows, visits, ["block", "share"], Block, work, schema)


def mine(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], label: Column, positives: int = 5, negatives: int = 5,
    low_percent: int = 80, high_percent: int = 100, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Of each anchor's first ``positives`` other rows of its label, the first ``negatives`` rows of other
    labels with ``low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score``.
    """
    rows = stored(integer_rows(vectors, label, id_column, vector_column, scale), "integers")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], result)
    blocks = stored(in_blocks(measured(rows), is_anchor, positives), "blocks")
    references = len(blocks.select("angles").first().angles)
    ranges = stored(ranges_of(blocks, references), "ranges")
    count = ranges.count()
    anchors = blocks.where("anchor").select("row", "id", "label", "x", "norm", "angles", "low", F.lit(float("inf")).alias("high"))

    def same_label(block: Block, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, label_, low = (asked.column(name).to_numpy() for name in ("row", "label", "low"))
        at, found, won = [], [], []
        for place, near, score in block.overlapping(asked):
            near = near[(block.label[near] == label_[place]) & (block.row[near] != row[place]) & (score[near] >= low[place])]
            near = best(near, score, block.order, block.row, positives)
            at += [place] * len(near)
            found += near.tolist()
            won += score[near].tolist()
        columns = [pa.array(row[at]), pa.array(block.row[found]), block.id.take(pa.array(found, pa.int64())), pa.array(won, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "other", "id", "score"])

    met = visited(blocks, stored(visits(anchors, ranges, count), "visits"), same_label, "row long, other long, id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "other")
    ranked = met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    # At most `positives` a row.
    ranked = ranked.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("positive_id"), "score"))).alias("positives"))
    own = stored(ranked.select("row", "positives.positive_id", F.col("positives.score").alias("positive_score")), "positives")
    # The widest window of the anchor's positives; each has its own within.
    window = own.withColumn("low", F.array_min("positive_score") * low_percent / 100 - 1).withColumn(
        "high", F.array_max("positive_score") * high_percent / 100 + 1
    )
    asking = anchors.drop("low", "high").join(window, "row")

    def other_label(block: Block, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, label_ = asked.column("row").to_numpy(), asked.column("label").to_numpy()
        wanted = asked.column("positive_score").to_pylist()
        at, places, found, won = [], [], [], []
        for place, near, score in block.overlapping(asked):
            near = near[block.label[near] != label_[place]]
            for p, positive in enumerate(wanted[place]):
                least, most = -(-low_percent * positive // 100), high_percent * positive // 100
                fit = best(near[(score[near] >= least) & (score[near] <= most)], score, block.order, block.row, negatives)
                at += [place] * len(fit)
                places += [p] * len(fit)
                found += fit.tolist()
                won += score[fit].tolist()
        taken = asked.select(["row", "id", "positive_id", "positive_score"]).take(pa.array(at, pa.int64()))
        more = [pa.array(places, pa.int32()), pa.array(block.row[found]), block.id.take(pa.array(found, pa.int64())), pa.array(won, pa.int64())]
        yield pa.RecordBatch.from_arrays([*taken.columns, *more], [*taken.schema.names, "place", "other", "negative_id", "negative_score"])

    met = visited(
        blocks, stored(visits(asking, ranges, count), "visits"), other_label,
        "row long, id long, positive_id array<long>, positive_score array<long>, place int, other long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last(), "other")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("id").alias("anchor_id"), F.col("positive_id")[F.col("place")].alias("positive_id"), "rank", "negative_id",
        F.col("positive_score")[F.col("place")].alias("positive_score"), "negative_score",
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 take the next label first; anchors are those divisible by 100."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return mine(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, label)


OP12_SQL = """
WITH r AS (SELECT row_number() OVER () AS row, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
           FROM embeddings
           WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.row, a.id, a.label, b.row AS other, b.id AS other_id, b.label AS other_label,
             list_dot_product(a.x, b.x)::BIGINT AS score
      FROM r a JOIN r b ON a.id % 100 = 0 AND a.row <> b.row),
p AS (SELECT row, id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY row ORDER BY score DESC, other_id, other) AS place
      FROM s WHERE label = other_label QUALIFY place <= 5),
n AS (SELECT p.row, p.id AS anchor_id, positive_id, s.other_id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.row, p.place ORDER BY s.score DESC, s.other_id, s.other) AS rank
      FROM p JOIN s ON s.row = p.row AND s.label <> s.other_label AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
