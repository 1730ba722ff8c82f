"""Repeated and missing keys, and their summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_key(rows: DataFrame, key: str, group_columns: Sequence[str]) -> DataFrame:
    """The groups of one key and equal group columns that hold more than one row."""
    return (
        rows.where(f"{key} is not null")
        .groupBy(key, *group_columns)
        .agg(F.count(F.lit(1)).alias("repeats"))
        .where("repeats > 1")
        .drop("repeats")
    )


def rows_missing_key(rows: DataFrame, key: str, extra: str = "true") -> DataFrame:
    """Object ids of the rows without the key, with the number of such rows."""
    return rows.where(f"{key} is null and {extra}").groupBy("objectid").agg(F.count(F.lit(1)).alias("total"))


def matched_totals(left: DataFrame, right: DataFrame, key: str, matches: Mapping[str, str]) -> DataFrame:
    """Per key of the left side, NULL among them, its rows as `_rows`, and for each name the joined rows on `key` whose
    right side meets the condition; NULL where nothing is joined.

    Each side is counted by key first, so the join pairs counts, not rows.
    """
    counted = [F.expr(f"count_if({condition})").alias(f"_{name}") for name, condition in matches.items()]
    lefts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    rights = right.where(f"{key} is not null").groupBy(F.col(key).alias("_key")).agg(*counted)
    pairs = [f"_rows * `_{name}` as `{name}`" for name in matches]
    return lefts.join(rights, F.col(key) == F.col("_key"), "left").selectExpr(key, "_rows", *pairs)


def conditional_summary(rows: DataFrame, sums: Mapping[str, str]) -> DataFrame:
    """One row: the sum of each expression, NULL over nothing."""
    return rows.agg(*[F.expr(f"sum({value})").alias(name) for name, value in sums.items()])
