"""Held rows and passing rows of equal keys, brought together in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def meet(held: DataFrame, passing: DataFrame, keys: list[str], build: Callable, work: Callable, schema: str) -> DataFrame:
    """Rows of ``work(built, batch)`` for each batch of passing rows, where ``built`` is ``build(held rows)``.

    Both sides are shuffled once by ``keys`` (non-null longs) and sorted so that a key's held rows come
    first. Only these are kept; however many rows pass, they stream by. The caller bounds the held
    rows of a key. Passing rows without held rows give nothing.
    """
    ours, theirs = ([c for c in frame.columns if c not in keys] for frame in (held, passing))
    kinds = [frame.select(F.struct(*names)).schema[0].dataType for frame, names in ((held, ours), (passing, theirs))]
    both = held.select(
        *keys, F.lit(0).alias("side"), F.struct(*ours).alias("held"), F.lit(None).cast(kinds[1]).alias("passing")
    ).unionByName(
        passing.select(*keys, F.lit(1).alias("side"), F.lit(None).cast(kinds[0]).alias("held"), F.struct(*theirs).alias("passing"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, built = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in range(len(keys) + 1)])
            turns = (np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist()
            for a, b in zip([0, *turns], [*turns, len(batch)]):
                *key, passes = marks[:, a].tolist()
                if key != current:
                    current, parts, built = key, [], None
                rows = batch.column(len(keys) + 1 + passes).slice(a, b - a)
                if not passes:
                    parts.append(rows)
                elif parts:
                    if built is None:
                        built = build(pa.RecordBatch.from_struct_array(pa.concat_arrays(parts)))
                    yield from work(built, pa.RecordBatch.from_struct_array(rows))

    return both.repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(run, schema)
