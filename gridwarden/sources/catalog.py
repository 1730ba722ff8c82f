"""Spark's own catalog as the tables that the census reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def quoted(*names: str) -> str:
    """A name of one or more parts as SQL writes it."""
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def catalog_frames(spark: SparkSession, databases: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The tables (owner, table_name) and columns (owner, table_name, column_name) of the databases.

    Names are in upper case, as the census expects them; a database is an owner. This is metadata
    only: one row per column of a catalog.
    """
    found = []
    for database in databases:
        for table in spark.catalog.listTables(database):
            if not table.isTemporary:
                columns = spark.catalog.listColumns(quoted(database, table.name))
                found += [(database.upper(), table.name.upper(), column.name.upper()) for column in columns]
    columns = spark.createDataFrame(found, "owner string, table_name string, column_name string")
    return columns.select("owner", "table_name").distinct(), columns


def registered_layers(spark: SparkSession, registry: str) -> DataFrame:
    """The layers' names in the registry table, in upper case; rows without a name are left out.

    `registry` is a table of the catalog with a column `table_name`. A layer that is registered more than once stays
    more than one row, which the selection of layers counts.
    """
    names = spark.table(registry).select(F.upper("table_name").alias("table_name"))
    return names.where("table_name is not null")


def create_database(spark: SparkSession, name: str, views: dict[str, str], tables: dict[str, str] | None = None) -> None:
    """A database of the session's catalog with Parquet tables at their paths and views over them; an old one goes first.

    Only the catalog's entries are replaced, never the tables' files. Views name their tables with the database.
    """
    spark.sql(f"create database if not exists {quoted(name)}")
    for old in spark.catalog.listTables(quoted(name)):
        if not old.isTemporary:
            spark.sql(f"drop {'view' if old.tableType == 'VIEW' else 'table'} if exists {quoted(name, old.name)}")
    for table, path in (tables or {}).items():
        spark.catalog.createTable(quoted(name, table), path, "parquet")
    for view, query in views.items():
        spark.sql(f"create or replace view {quoted(name, view)} as {query}")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same catalog whose counts of stored Parquet columns come from the files' footers.

    For `non_null_census` with a `load` that reads paths by this session. A count is taken from footers where the column
    is read as it is stored and no row is filtered; any other plan scans as always, with the same numbers.
    """
    session = spark.newSession()
    scanned_first = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in scanned_first if name != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session
