"""Documents holding all query tokens, and their location, distance and frequency scores.

The scores are defined over every combination of one position per token. They are computed
without building the combinations: the smallest position sum is the sum of the smallest
positions, the number of combinations is the product of the counts, and the smallest chain of
gaps comes from one running minimum in each direction per step of the chain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: guards the divisions of the rescaling.
SMALLEST = 0.00001


@dataclass(frozen=True)
class Weights:
    """Weights of the location, distance and frequency scores."""

    location: float
    distance: float
    frequency: float


# The weights used for posts and for pages.
POST_WEIGHTS = Weights(4.0, 3.5, 1.0)
PAGE_WEIGHTS = Weights(2.0, 3.5, 4.0)

SCORES = {
    "location": "rescaled_location_score",
    "distance": "rescaled_dist_score",
    "frequency": "rescaled_tokens_count",
}


def occurrences(
    index: DataFrame,
    tokens: Sequence[str],
    id_column: str = "post_id",
    strict: bool = False,
) -> DataFrame:
    """Rows (id, step, steps, location) of the documents that hold all query tokens.

    ``index`` has (word, id, location). ``step`` is a token's place among the counted tokens
    and ``steps`` their number. With ``strict`` a token missing from the whole index leaves
    no document; otherwise such tokens do not count, which takes a look at the index to see
    which tokens exist.
    """
    tokens = list(dict.fromkeys(tokens))
    wanted = index.where(F.col("word").isin(tokens))
    asked = F.array(*[F.lit(token) for token in tokens]) if tokens else F.array().cast("array<string>")
    if strict:
        counted = asked
    else:
        # One row: the asked tokens that exist, in the order they were asked.
        known = F.collect_set("word")
        counted = wanted.agg(
            F.filter(asked, lambda token: F.array_contains(known, token)).alias("known")
        ).scalar()
    wanted = wanted.withColumn("_counted", counted)
    in_document = Window.partitionBy(id_column)
    return (
        wanted.select(
            id_column,
            (F.array_position("_counted", F.col("word")) - 1).cast("int").alias("step"),
            F.size("_counted").alias("steps"),
            "location",
        )
        .withColumn("_held", F.size(F.collect_set("step").over(in_document)))
        .where(F.col("_held") == F.col("steps"))
        .drop("_held")
    )


def _chain_costs(rows: DataFrame, id_column: str, length: int) -> DataFrame:
    """Add ``cost``: the smallest chain of gaps from the first token to this occurrence.

    Step i takes the cheapest occurrence of token i - 1 on either side. All windows share the
    documents' partitioning; reading directions alternate so that a sort serves two windows.
    """
    document = Window.partitionBy(id_column)
    upward = document.orderBy("location").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    downward = document.orderBy(F.desc("location")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    at, cost = F.col("location"), F.col("cost")
    rows = rows.withColumn("cost", F.when(F.col("step") == 0, F.lit(0).cast("long")))
    for step in range(1, length):
        previous = F.col("step") == step - 1
        below = ("_below", F.min(F.when(previous, cost - at)).over(upward))
        above = ("_above", F.min(F.when(previous, cost + at)).over(downward))
        for name, value in (below, above) if step % 2 else (above, below):
            rows = rows.withColumn(name, value)
        reached = F.least(F.col("_below") + at, F.col("_above") - at)
        rows = rows.withColumn("cost", F.when(F.col("step") == step, reached).otherwise(cost)).drop(
            "_below", "_above"
        )
    return rows


def score(
    index: DataFrame,
    tokens: Sequence[str],
    id_column: str = "post_id",
    strict: bool = False,
) -> DataFrame:
    """``location_score``, ``dist_score`` and ``tokens_count`` per document with all tokens.

    One shuffle, by document, of the query tokens' occurrences only.
    """
    tokens = list(dict.fromkeys(tokens))
    rows = occurrences(index, tokens, id_column, strict)
    rows = _chain_costs(rows, id_column, len(tokens))
    last = F.col("step") == F.col("steps") - 1
    per_token = rows.groupBy(id_column, "step", "steps").agg(
        F.min("location").alias("first_location"),
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(last, F.col("cost"))).alias("cost"),
    )
    distance = F.when(F.first("steps") == 1, F.lit(1.0)).otherwise(F.min("cost").cast("double"))
    return per_token.groupBy(id_column).agg(
        F.sum("first_location").alias("location_score"),
        distance.alias("dist_score"),
        # A product of counts outgrows 64 bits quickly; doubles keep its order of magnitude.
        F.product(F.col("n").cast("double")).alias("tokens_count"),
    )


def rescale(value: Column, smallest: Column, largest: Column, small_is_better: bool) -> Column:
    """Bring a score into [0, 1] with high values best.

    When the smallest value is 0, every small-is-better score becomes 0.
    """
    value = value.cast("double")
    if small_is_better:
        return smallest.cast("double") / F.greatest(value, F.lit(SMALLEST))
    largest = largest.cast("double")
    return value / F.when(largest == 0, F.lit(SMALLEST)).otherwise(largest)


def rescale_scores(scores: DataFrame) -> DataFrame:
    """Add the three rescaled scores; the global extremes come from a one-row subquery."""
    extremes = scores.agg(
        F.struct(
            F.min("location_score").alias("low_location"),
            F.max("location_score").alias("high_location"),
            F.min("dist_score").alias("low_distance"),
            F.max("dist_score").alias("high_distance"),
            F.min("tokens_count").alias("low_count"),
            F.max("tokens_count").alias("high_count"),
        ).alias("extremes")
    )
    known = F.col("_extremes")
    return (
        scores.withColumn("_extremes", extremes.scalar())
        .withColumn(
            SCORES["location"],
            rescale(F.col("location_score"), known.low_location, known.high_location, True),
        )
        .withColumn(
            SCORES["distance"],
            rescale(F.col("dist_score"), known.low_distance, known.high_distance, True),
        )
        .withColumn(
            SCORES["frequency"],
            rescale(F.col("tokens_count"), known.low_count, known.high_count, False),
        )
        .drop("_extremes")
    )


def rank(
    rescaled: DataFrame,
    id_column: str = "post_id",
    weights: Weights = POST_WEIGHTS,
    k: int | None = None,
) -> DataFrame:
    """Weighted sum of the rescaled scores, best first; the best ``k`` when given."""
    ranking = (
        F.col(SCORES["location"]) * weights.location
        + F.col(SCORES["distance"]) * weights.distance
        + F.col(SCORES["frequency"]) * weights.frequency
    )
    ranked = rescaled.withColumn("ranking", ranking).orderBy(F.desc("ranking"), id_column)
    return ranked if k is None else ranked.limit(k)


def leaderboard(rescaled: DataFrame, by: str, id_column: str = "post_id", k: int = 5) -> DataFrame:
    """The best ``k`` documents by one rescaled score: location, distance or frequency."""
    column = SCORES[by]
    return rescaled.select(id_column, column).orderBy(F.desc(column), id_column).limit(k)
