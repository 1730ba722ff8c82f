"""Joins that stay whole and spread out when one key, or NULL, holds much of a table.

Plain inner joins need no help: both sides reach them through a fresh shuffle, so AQE splits a hot
key over tasks. What AQE cannot split by itself is handled below.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_PIECE = 1_000
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
NULL_SPREAD = 4096
HOT_ROWS = 10_000
HOT_SHARE = 64
KEY_BUCKETS = 4096


def most_rows(rows: DataFrame, key: str) -> tuple[int, int]:
    """A bound of the rows that any one key has, NULL being a key, and the number of all rows.

    Rows are counted by buckets of keys, so only as many counts as there are buckets are shuffled.
    """
    buckets = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))).agg(F.count(F.lit(1)).alias("n"))
    row = buckets.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    return row["most"], row["total"]


def is_hot(most: int, total: int) -> bool:
    """Whether a key with so many of the rows is more than one task should do."""
    return most > max(HOT_ROWS, total // HOT_SHARE)


def inner_join(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Pairs of rows with equal keys, without the right side's key column."""
    return left.join(right, F.col(key) == F.col(right_key)).drop(right_key)


def spread_join(
    many: DataFrame, one: DataFrame, key: str, one_key: str, row_id: str, how: str = "left", hot: bool = True
) -> DataFrame:
    """`many` with the matching rows of `one`, for a `one` that may be an aggregate by its key.

    Both sides are joined on a second key as well, which is 0 wherever the first can match. It deals
    the rows with a NULL key over many tasks. And since no aggregate is partitioned by both keys,
    both sides get a fresh shuffle, so AQE can split a hot key of `many` too. Where no key of `many`, nor NULL, was
    measured as hot, an aggregate is joined where it lies, without that second shuffle.
    """
    if not hot:
        return many.join(one, F.col(key) == F.col(one_key), how).drop(one_key)
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(row_id), F.lit(NULL_SPREAD))).otherwise(F.lit(0))
    zero = F.pmod(F.xxhash64(one_key), F.lit(1))
    return many.join(one, (F.col(key) == F.col(one_key)) & (spread == zero), how).drop(one_key)


def broadcast_left_join(many: DataFrame, one: DataFrame, key: str, one_key: str) -> DataFrame:
    """As `spread_join`, for a right side known to be small: no shuffle, so nothing to spread."""
    return many.join(F.broadcast(one), F.col(key) == F.col(one_key), "left").drop(one_key)


def repeat_rows(rows: DataFrame, copies: str, row_id: str, hot: bool = True) -> DataFrame:
    """Each row as often as its column `copies` says, without that column; 0 drops the row.

    Rows are cut into pieces of few copies and dealt out before they are copied, so a row wanted a billion times is
    the work of many tasks and of small arrays. Pieces go by a hash, which a retried task repeats without the sort that
    a round-robin deal needs. The number of tasks is given: AQE sees the pieces' size, not that of their copies, and
    would merge them into one task. Where what the copies count was measured and none is `hot`, every row is copied
    where it lies, piece by piece too: nothing is shuffled.
    """
    rest = f"least({COPIES_PER_PIECE}, {copies} - _piece * {COPIES_PER_PIECE})"
    pieces = rows.where(f"{copies} > 0").selectExpr("*", f"explode(sequence(0L, ({copies} - 1) div {COPIES_PER_PIECE})) as _piece")
    if hot:
        pieces = pieces.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), row_id, "_piece")
    return pieces.selectExpr("*", f"explode(array_repeat(true, cast({rest} as int))) as _copy").drop(copies, "_piece", "_copy")


def _fits(frame: DataFrame, key: str, value: str) -> bool:
    """Whether the two columns are within the broadcast bounds; an empty table counts as one row."""
    texts = [F.octet_length(F.col(name).cast("string")) for name in (key, value)]
    size = F.coalesce(texts[0], F.lit(0)) + F.coalesce(texts[1], F.lit(0))
    row = (
        frame.limit(BROADCAST_ROWS + 1)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(size), F.lit(0)).alias("size"),
        )
        .first()
    )
    return max(row["n"], 1) <= BROADCAST_ROWS and row["size"] <= BROADCAST_BYTES


class Lookup:
    """A lookup table of `key` and `value`, measured once before it is broadcast."""

    def __init__(self, frame: DataFrame, key: str, value: str):
        self.frame = frame.where(F.col(key).isNotNull()).select(key, value)
        self.key = key
        self.value = value

    @cached_property
    def fits(self) -> bool:
        """Whether the whole table is within the broadcast bounds."""
        return _fits(self.frame, self.key, self.value)

    def _counted(self, absent: int) -> DataFrame:
        """How often each key occurs, without the keys that occur as often as an absent one counts."""
        counted = self.frame.groupBy(F.col(self.key).alias("_lookup_key")).agg(F.count(F.lit(1)).alias("_entries"))
        return counted.where(F.col("_entries") != absent)

    @cached_property
    def repeated_fit(self) -> bool:
        """Whether the counts of the keys that occur more than once are within the broadcast bounds."""
        return _fits(self._counted(1), "_lookup_key", "_entries")

    @cached_property
    def most(self) -> int:
        """How often the most frequent key occurs, 1 at least."""
        return self._counted(1).agg(F.max("_entries")).first()[0] or 1

    def join_rows(self, many: DataFrame, key: str, row_id: str, value: str) -> DataFrame:
        """`many` with each matching row's value as `value`; a repeated lookup key repeats the row."""
        one = self.frame.select(F.col(self.key).alias("_lookup_key"), F.col(self.value).alias(value))
        if self.fits:
            return broadcast_left_join(many, one, key, "_lookup_key")
        return spread_join(many, one, key, "_lookup_key", row_id)

    def join_value(self, many: DataFrame, key: str, row_id: str, value: str) -> DataFrame:
        """`many` with one value per key, so that no row repeats.

        A lookup beyond the broadcast bounds is shuffled once, and AQE splits a hot key's rows.
        """
        one = self.frame.groupBy(F.col(self.key).alias("_lookup_key")).agg(F.min(self.value).alias(value))
        return self._join_one(many, key, row_id, one, self.fits)

    def join_count(self, many: DataFrame, key: str, row_id: str, count: str, absent: int = 1) -> DataFrame:
        """`many` with how often the lookup holds each row's key, `absent` if not at all. Rows never multiply.

        With an `absent` of 1 only the keys that the lookup repeats are looked up: most catalogs repeat few, however
        many keys they have.
        """
        fits = self.fits or absent == 1 and self.repeated_fit
        joined = self._join_one(many, key, row_id, self._counted(absent).withColumnRenamed("_entries", count), fits)
        return joined.withColumn(count, F.coalesce(F.col(count), F.lit(absent).cast("long")))

    def _join_one(self, many: DataFrame, key: str, row_id: str, one: DataFrame, fits: bool) -> DataFrame:
        if fits:
            return broadcast_left_join(many, one, key, "_lookup_key")
        return spread_join(many, one, key, "_lookup_key", row_id)
