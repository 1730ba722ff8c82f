"""A count of filled values per layer, for the layers that the catalog says have the column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.functions import values
from gridwarden.functions.text import literal
from gridwarden.sources.catalog import quoted


def select_layers(
    tables: DataFrame,
    columns: DataFrame,
    layers: DataFrame,
    owner: str = values.CENSUS_OWNER,
    column: str = values.CENSUS_COLUMN,
    exclude: str = values.CENSUS_EXCLUDED,
) -> DataFrame:
    """Names of the owner's tables that have the column and are registered layers.

    `tables` has owner and table_name, `columns` table_name and column_name, `layers` table_name.
    Names are matched across owners, and a name that matches more than once is left out.
    """
    return (
        tables.where((F.col("owner") == owner) & ~F.col("table_name").rlike(exclude))
        .join(columns.where(F.col("column_name") == column).select("table_name"), "table_name")
        .join(layers.select("table_name"), "table_name")
        .groupBy("owner", "table_name")
        .agg(F.count(F.lit(1)).alias("matches"))
        .where("matches = 1")
        .select("table_name")
    )


def non_null_census(
    spark: SparkSession,
    layers: DataFrame,
    load: Callable[[str], DataFrame],
    column: str = values.CENSUS_COLUMN,
    view: str | None = None,
) -> DataFrame:
    """Per layer its name as `feat` and the number of rows with the column filled as `ots`.

    Only the layers' names, which are catalog entries, come to the driver.
    """
    names = sorted(row["table_name"] for row in layers.select("table_name").distinct().collect())
    counts = [load(name).agg(F.lit(name).alias("feat"), F.count(column).alias("ots")) for name in names]
    # A count from the footers of no file at all is NULL, and only a nullable aggregate keeps the coalesce around it.
    ots = F.coalesce(F.max("ots"), F.lit(0).cast("long")).alias("ots")
    census = (
        reduce(DataFrame.unionByName, counts).groupBy("feat").agg(ots)
        if counts
        else spark.createDataFrame([], "feat string, ots long")
    )
    if view:
        census.createOrReplaceTempView(view)
    return census


def lasting_census(
    spark: SparkSession, layers: DataFrame, database: str, view: str = values.CENSUS_VIEW, column: str = values.CENSUS_COLUMN
) -> DataFrame:
    """The census as a view of the catalog, over the database's own tables, which any session can read; an old one is replaced.

    The view counts when it is read, so it follows the tables; a session that has read them before lists their files anew
    after REFRESH TABLE, as Spark has it. Layers' names are distinct, so their rows are put together without a shuffle. A
    layer that is dropped later breaks the view until the next call.
    """
    names = sorted(row["table_name"] for row in layers.select("table_name").distinct().collect())
    counts = [
        f"select {literal(name)} as feat, count({quoted(column)}) as ots from {quoted(database, name)}" for name in names
    ]
    nothing = "select cast(null as string) as feat, cast(null as bigint) as ots where false"
    spark.sql(f"create or replace view {quoted(database, view)} as {' union all '.join(counts) or nothing}")
    return spark.table(quoted(database, view))
