"""The rows whose text takes the fewest edits to become one of some targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplens.functions.text import byte_levenshtein, least_edits


def closest(rows: DataFrame, text: str, targets: Sequence[str], k: int, name: str, id_column: str) -> DataFrame:
    """``rows`` with ``name``, their byte edit distance to the nearest target; the ``k`` smallest, ties by id.

    The ``k`` rows of the smallest bound are compared in full. Nothing farther than the worst of them
    is among the closest, so rows whose bound is higher are passed over, and the others are compared only up to
    that distance. Texts that are null come last.
    """
    if not targets:
        raise ValueError("at least one target is needed")
    worst = _kth_distance(rows, text, targets, k)
    if worst is None:
        near = rows.withColumn(name, _least([byte_levenshtein(F.col(text), F.lit(t)) for t in targets]))
    else:
        near = within(rows, text, targets, worst)
        compared = [F.nullif(byte_levenshtein(F.col(text), F.lit(t), worst), F.lit(-1)) for t in targets]
        near = near.withColumn(name, _least(compared)).where(F.col(name).isNotNull())
    return near.orderBy(F.asc_nulls_last(name), id_column).limit(k)


def within(rows: DataFrame, text: str, targets: Sequence[str], most: int) -> DataFrame:
    """The rows that may be within ``most`` edits of a target, by their bounds."""
    return rows.where(_bound(text, targets) <= most)


def _bound(text: str, targets: Sequence[str]):
    return _least([least_edits(F.col(text), target) for target in targets])


def _least(columns: list):
    return F.least(*columns) if len(columns) > 1 else columns[0]


def _kth_distance(rows: DataFrame, text: str, targets: Sequence[str], k: int) -> int | None:
    """The largest distance among the ``k`` rows of the smallest bound; None if there are fewer."""
    first = rows.select(text).where(F.col(text).isNotNull()).orderBy(_bound(text, targets)).limit(k)
    distance = _least([byte_levenshtein(F.col(text), F.lit(target)) for target in targets])
    count, worst = first.select(distance.alias("d")).agg(F.count("d"), F.max("d")).first()
    return worst if count == k and k else None
