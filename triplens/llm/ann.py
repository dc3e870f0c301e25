"""Nearest neighbours by an inverted multi-index.

Unit vectors are cut in two halves, and each half is quantised by its own codebook. A cell is a
pair of centroids. A query walks the pairs in the order of their summed distances, by a heap over
the two sorted centroid lists, until the cells it has passed hold the wanted share of all rows;
their entries are reranked by the exact cosine. Codebooks and share are fitted on a bounded sample:
the share is the smallest tried that finds ``TARGET`` of the sample's true neighbours. Every row is
indexed.

Entries lie in blocks of a first-half centroid, large ones split by hash of the id. Every entry is
sent once, to its block; the visits of the queries go to the blocks they look into and stream by,
so a task holds one block of entries and one batch of visits.

Defined results: vectors that are null, of another length than most, zero or with null or
non-finite components take no part; rows with the query's own id are not its neighbours; a query
id that occurs twice is searched once; ties go to the smaller id; with fewer candidates than
wanted all are returned; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplens.llm.common import stored, table
from triplens.llm.meet import meet

#: Rows that codebooks and share are fitted on, in the mean, and the queries tried among them.
SAMPLE, SAMPLE_QUERIES = 10_000, 300
CENTROIDS = 32
#: Recall aimed at on the sample, and the shares tried.
TARGET = 0.97
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.85, 1.0)
BLOCK_ENTRIES = 4096


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def squared_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((rows * rows).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids * centroids).sum(1), 0)


def fit_codebook(rows: np.ndarray, size: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct rows."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(rows, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(size, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = squared_distances(rows, centroids).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, rows)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Pairs (i, j) by growing ``first[i] + second[j]`` until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    one, two = first[a].tolist(), second[b].tolist()
    heap, reached, cells, found = [(one[0] + two[0], 0, 0)], [0] * len(one), [], 0
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        cells.append((int(a[i]), int(b[j])))
        found += int(counts[a[i], b[j]])
        # A pair enters the heap when both the pair before it in its row and in its column have left.
        reached[i] = j + 1
        if j + 1 < len(two) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
        if i + 1 < len(one) and reached[i + 1] == j:
            heapq.heappush(heap, (one[i + 1] + two[j], i + 1, j))
    return cells


class MultiIndex:
    """Two codebooks and the share of the rows that a query looks at."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS, k: int = 5):
        rows = unit(sample)
        self.half = rows.shape[1] // 2
        self.books = [fit_codebook(rows[:, : self.half], centroids, 1), fit_codebook(rows[:, self.half :], centroids, 2)]
        self.share = self._fit_share(rows, k)

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = unit(vectors)
        return squared_distances(rows[:, : self.half], self.books[0]), squared_distances(rows[:, self.half :], self.books[1])

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.distances(vectors)
        return first.argmin(axis=1), second.argmin(axis=1)

    def _fit_share(self, rows: np.ndarray, k: int) -> float:
        queries = np.random.default_rng(3).permutation(len(rows))[:SAMPLE_QUERIES]
        near = rows[queries] @ rows.T
        near[np.arange(len(queries)), queries] = -2
        true = np.argsort(-near, axis=1)[:, :k]
        c1, c2 = self.cells(rows)
        counts = np.zeros((len(self.books[0]), len(self.books[1])), np.int64)
        np.add.at(counts, (c1, c2), 1)
        first, second = self.distances(rows[queries])
        # Entries that a query has passed before it comes to the cell of a true neighbour.
        needed = []
        for q in range(len(queries)):
            order = walk(first[q], second[q], counts, len(rows) + 1)
            before = np.zeros_like(counts)
            total = 0
            for cell in order:
                before[cell] = total
                total += counts[cell]
            needed += before[c1[true[q]], c2[true[q]]].tolist()
        needed = np.array(needed) / len(rows)
        return next(share for share in SHARES if share == 1.0 or (needed < share).mean() >= TARGET)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, the components as doubles."""
    as_double = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), as_double.alias("vector")).where("id IS NOT NULL AND size(vector) > 0")
    rows = rows.where("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(vector, x -> x <> 0)")
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (lengths.d if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, rough: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The k nearest among ``rows``, exactly; ``rough`` are their cosines up to rounding."""
    if len(rough) > k:
        some = np.flatnonzero(rough >= np.partition(rough, -k)[-k] - 1e-9)
        ids, rows = ids[some], rows[some]
    exact = (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))
    order = np.lexsort((ids, -exact))[:k]
    return list(zip(ids[order].tolist(), exact[order].tolist()))


def search(
    vectors: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    centroids: int = CENTROIDS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row where ``is_query(id)`` holds."""
    rows = stored(usable(vectors, id_column, vector_column), "vectors")
    total = rows.count()
    result = "query_id long, vec_id long, score double"
    if not total:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = 1_000_000
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < -(-parts * SAMPLE // total)).select("vector").toPandas()
    if sample.empty:
        sample = rows.select("vector").limit(1).toPandas()
    index = MultiIndex(np.stack(sample["vector"].to_numpy()).astype(float), centroids, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                first, second = index.cells(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["id", "vector", "c1", "c2"]
                )

    entries = stored(rows.mapInArrow(place, "id long, vector array<double>, c1 long, c2 long"), "entries")
    counts = np.zeros((len(index.books[0]), len(index.books[1])), np.int64)
    for row in entries.groupBy("c1", "c2").count().collect():
        counts[row.c1, row.c2] = row["count"]
    enough = max(k + 1, int(np.ceil(index.share * total)))
    blocks = np.maximum(1, -(-counts.sum(axis=1) // BLOCK_ENTRIES)).tolist()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            first, second = index.distances(_matrix(batch.column(1)))
            at, lists, ones, twos = [], [], [], []
            for q in range(len(batch)):
                by_first: dict[int, list[int]] = {}
                for i, j in walk(first[q], second[q], counts, enough):
                    if counts[i, j]:
                        by_first.setdefault(i, []).append(j)
                for i, cells in by_first.items():
                    at.append(q)
                    ones.append(i)
                    twos.append(cells)
                    lists.append(list(range(blocks[i])))
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(ones, pa.int64()), pa.array(twos, pa.list_(pa.int64())), pa.array(lists, pa.list_(pa.int64()))],
                ["id", "vector", "c1", "cells", "blocks"],
            )

    queries = rows.where(is_query(F.col("id"))).dropDuplicates(["id"])
    visits = queries.mapInArrow(visit, "id long, vector array<double>, c1 long, cells array<long>, blocks array<long>")
    visits = visits.select(F.col("id").alias("query_id"), "vector", "c1", "cells", F.explode("blocks").alias("block"))
    block_count = F.array(*[F.lit(b) for b in blocks])[F.col("c1").cast("int")]
    held = entries.select("id", "vector", "c1", "c2", F.pmod(F.xxhash64("id"), block_count).cast("long").alias("block"))

    def block_of(batch: pa.RecordBatch) -> tuple:
        vectors = _matrix(batch.column("vector"))
        return batch.column("id").to_numpy(), batch.column("c2").to_numpy(), vectors, unit(vectors)

    def rerank(block: tuple, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, cell, vectors, directions = block
        given = _matrix(batch.column("vector"))
        rough = unit(given) @ directions.T
        found = []
        for at, (query_id, cells) in enumerate(zip(batch.column("query_id").to_pylist(), batch.column("cells"))):
            open_cells = np.zeros(counts.shape[1], bool)
            open_cells[cells.values.to_numpy()] = True
            seen = open_cells[cell] & (ids != query_id)
            if seen.any():
                best = _best(ids[seen], vectors[seen], given[at], rough[at][seen], k)
                found += [(query_id, vec_id, score) for vec_id, score in best]
        if found:
            arrays = [pa.array(x, kind) for x, kind in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    found = meet(held, visits, ["c1", "block"], block_of, rerank, result)
    place_of = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place_of.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)
