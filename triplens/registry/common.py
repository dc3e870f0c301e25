"""Inputs the registered queries share, and the same derivations in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from triplens.functions.text import ENGLISH_STOP_WORDS
from triplens.session import shared_dir
from triplens.sources.tables import read_parquet

# Unicode whitespace as Python and (with the four ASCII separators) the tokeniser see it.
SQL_SPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", spread)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/triplens-{name}-{uuid.uuid4().hex}"


def quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def tokens_cte(
    source: str,
    id_expr: str,
    text_expr: str,
    id_name: str,
    stops: Sequence[str] = tuple(ENGLISH_STOP_WORDS),
    max_len: int | None = None,
    name: str = "tok",
) -> str:
    """CTEs giving ``name`` (id, word, location), the tokeniser without stemming."""
    condition = "w <> ''"
    if stops:
        condition += f" AND NOT list_contains([{quoted(stops)}], w)"
    if max_len is not None:
        condition += f" AND length(w) < {max_len}"
    return f"""
{name}_raw AS (
  SELECT {id_expr} AS {id_name},
         list_filter(string_split_regex(lower({text_expr}), '[{SQL_SPACE}]+'),
                     lambda w: {condition}) AS arr
  FROM {source}),
{name}_pos AS (
  SELECT {id_name}, unnest(arr) AS raw, generate_subscripts(arr, 1) - 1 AS location FROM {name}_raw),
{name} AS MATERIALIZED (
  SELECT * FROM (
    SELECT {id_name}, regexp_replace(raw, '[^0-9A-Za-z_]+', '', 'g') AS word,
           CAST(location AS BIGINT) AS location FROM {name}_pos)
  WHERE word <> '')"""


def naive_scores_cte(
    tokens: Sequence[str], id_name: str, source: str = "tok", name: str = "scores"
) -> str:
    """The k-way positional self-join and its three scores, as defined."""
    count = len(tokens)
    tables = ", ".join(f"{source} t{i}" for i in range(count))
    where = " AND ".join(
        [f"t{i}.word = '{token}'" for i, token in enumerate(tokens)]
        + [f"t{i}.{id_name} = t{i + 1}.{id_name}" for i in range(count - 1)]
    )
    total = " + ".join(f"t{i}.location" for i in range(count))
    gaps = " + ".join(f"abs(t{i}.location - t{i + 1}.location)" for i in range(count - 1)) or "1.0"
    return f"""
{name} AS MATERIALIZED (
  SELECT t0.{id_name} AS {id_name}, CAST(min({total}) AS BIGINT) AS location_score,
         CAST(min({gaps}) AS DOUBLE) AS dist_score, CAST(count(*) AS DOUBLE) AS tokens_count
  FROM {tables} WHERE {where} GROUP BY t0.{id_name})"""


def rescaled_cte(source: str = "scores", name: str = "rescaled") -> str:
    return f"""
{name} AS (
  SELECT s.*,
         CAST(e.low_location AS DOUBLE) / greatest(CAST(location_score AS DOUBLE), 0.00001)
           AS rescaled_location_score,
         e.low_distance / greatest(dist_score, 0.00001) AS rescaled_dist_score,
         tokens_count / CASE WHEN e.high_count = 0 THEN 0.00001 ELSE e.high_count END
           AS rescaled_tokens_count
  FROM {source} s, (SELECT min(location_score) AS low_location, min(dist_score) AS low_distance,
                           max(tokens_count) AS high_count FROM {source}) e)"""


def ranking_sql(location: float, distance: float, frequency: float) -> str:
    return (
        f"rescaled_location_score * CAST({location} AS DOUBLE)"
        f" + rescaled_dist_score * CAST({distance} AS DOUBLE)"
        f" + rescaled_tokens_count * CAST({frequency} AS DOUBLE)"
    )
