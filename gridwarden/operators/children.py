"""Parents against their children: totals, repeats and wrong parents.

Children are summed up by foreign key before they meet their parents. A parent with a third of all
children then costs one row per map task, and the join sees one row per parent.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwarden.operators.joins import Lookup, spread_join


def child_totals(children: DataFrame, foreign_key: str, **totals: str) -> DataFrame:
    """The totals per parent key, which is named `_child_key`."""
    return (
        children.where(f"{foreign_key} is not null")
        .groupBy(F.col(foreign_key).alias("_child_key"))
        .agg(*[F.expr(total).alias(name) for name, total in totals.items()])
    )


def with_child_totals(
    parents: DataFrame, key: str, children: DataFrame, foreign_key: str, hot: bool = True, **totals: str
) -> DataFrame:
    """Every parent once, with the children's totals; NULL totals for a parent without children.

    `hot` says whether a key, or NULL, may hold many parents.
    """
    return spread_join(parents, child_totals(children, foreign_key, **totals), key, "_child_key", "objectid", hot=hot)


def with_repeated_values(
    parents: DataFrame,
    key: str,
    children: DataFrame,
    foreign_key: str,
    value: str,
    of_repeats: Mapping[str, str],
    codes: Sequence[int] | None = None,
    hot: bool = True,
    **totals: str,
) -> DataFrame:
    """As `with_child_totals`, with `repeated`: the values that several children of a parent share, as an array of
    `value` and `repeats`; NULL is a value.

    Children are counted per parent and value, and those counts are summed up again per parent. So the totals must be
    counts or sums. A parent's array holds as many entries as it has values, such as codes, that repeat.

    `of_repeats` are sums over a parent's values of an expression of `_value` and `_repeats`. Where all values are NULL or
    one of few `codes`, each code is counted in a column of its own, and the children are shuffled once, by their parent
    only.
    """
    if codes is not None:
        counts = {f"_of_{code}": f"count_if({value} = {code})" for code in codes}
        summed = child_totals(children, foreign_key, _of_null=f"count_if({value} is null)", **counts, **totals)
        pairs = [("cast(null as bigint)", "_of_null"), *[(f"{code}L", f"_of_{code}") for code in codes]]
        entries = ", ".join(f"named_struct('value', {code}, 'repeats', {count})" for code, count in pairs)

        def total(expression: str) -> str:
            return " + ".join(f"({re.sub('_repeats', count, re.sub('_value', code, expression))})" for code, count in pairs)

        summed = summed.selectExpr(
            "_child_key",
            f"filter(array({entries}), x -> x.repeats > 1) as repeated",
            *[f"{total(expression)} as {name}" for name, expression in of_repeats.items()],
            *totals,
        )
        return spread_join(parents, summed, key, "_child_key", "objectid", hot=hot)
    counted = (
        children.where(f"{foreign_key} is not null")
        .groupBy(F.col(foreign_key).alias("_child_key"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_repeats"), *[F.expr(total).alias(name) for name, total in totals.items()])
    )
    repeated = "collect_list(if(_repeats > 1, named_struct('value', _value, 'repeats', _repeats), null))"
    summed = counted.groupBy("_child_key").agg(
        F.expr(repeated).alias("repeated"),
        *[F.expr(f"sum({expression})").alias(name) for name, expression in of_repeats.items()],
        *[F.sum(name).alias(name) for name in totals],
    )
    return spread_join(parents, summed, key, "_child_key", "objectid", hot=hot)


def wrong_parent(children: DataFrame, parent_key: str, parents: Lookup, count: str) -> DataFrame:
    """The children with the number of `parents` that they hang from, 0 for none."""
    return parents.join_count(children, parent_key, "objectid", count, absent=0)
