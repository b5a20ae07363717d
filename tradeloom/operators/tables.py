"""Names for derived tables, so that they can be queried with SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tradeloom import schemas


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Session views under the registered names; returns the names."""
    names = []
    for name, rows in tables.items():
        view = schemas.GOLD_TABLES.get(name, name)
        rows.createOrReplaceTempView(view)
        names.append(view)
    return names


def register_tables(spark: SparkSession, locations: Mapping[str, str], database: str = "gold") -> list[str]:
    """External parquet tables over written folders; a second call moves a name to its new folder.

    A managed table of that name is refused, because its files would go with it. A name whose columns stay
    the same is moved in place, so readers always find it; where the layout changes, or folders carry
    partitions, the definition is replaced, which leaves the files alone.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, path in locations.items():
        table = f"`{database}`.`{schemas.GOLD_TABLES.get(name, name)}`"
        names.append(table.replace("`", ""))
        if spark.catalog.tableExists(table):
            if spark.catalog.getTable(table).tableType != "EXTERNAL":
                raise ValueError(f"{table} is not an external table")
            columns = spark.catalog.listColumns(table)
            plain = not any(column.isPartition for column in columns)
            if plain and [c.name for c in columns] == spark.read.parquet(path).columns:
                spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                spark.catalog.refreshTable(table)
                continue
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, path=path, source="parquet")
        if any(column.isPartition for column in spark.catalog.listColumns(table)):
            spark.catalog.recoverPartitions(table)
    return names
