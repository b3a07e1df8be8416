"""Names for the tables of a root that follow its loads.

A root has one database. Each table of the last load is a view there over the folders that hold it; publication
replaces the views. Spark resolves a view's text whenever it is read, so SQL over these names, and views that others put on them,
answer with the load that was published last. With a shared metastore that holds for all sessions, else for
the session that publishes. A name whose table the new load lacks is gone, rather than answering from an old load.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidelane.sources.loads import FOLLOWERS, Load

#: Tables that only the library reads, and the start of names that are no tables.
INNER, OWN = {"line_keys", "rollups"}, "v_"


def database_of(root: str) -> str:
    return f"tidelane_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:12]}"


def plain_columns(schema: T.StructType) -> str:
    """A select list with amounts as doubles."""
    kinds = {f.name: isinstance(f.dataType, T.DecimalType) for f in schema.fields}
    return ", ".join(f"CAST(`{n}` AS DOUBLE) AS `{n}`" if amount else f"`{n}`" for n, amount in kinds.items())


def _names(spark: SparkSession, database: str) -> set[str]:
    return {row.viewName for row in spark.sql(f"SHOW VIEWS IN {database}").collect() if not row.isTemporary}


def place(load: Load) -> str:
    """Point the names of a root's database at the tables of a load; the database is made if there is none."""
    spark, database = load.spark, database_of(load.root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{load.root}/catalog'")
    names = set(load.tables) - INNER
    for name in sorted(names):
        paths = load.paths(name)
        columns = "*" if len(paths) == 1 else ", ".join(f"`{c}`" for c in spark.read.parquet(paths[0]).columns)
        parts = " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{path}`" for path in paths)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {parts}")
    for name in _names(spark, database) - names:
        if not name.startswith(OWN):
            spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
    return database


def move(load: Load) -> None:
    """Let the names of a root follow a new load, if they were asked for in this catalog."""
    if load.spark.catalog.databaseExists(database_of(load.root)):
        place(load)


FOLLOWERS.append(move)
