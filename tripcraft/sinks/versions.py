"""Published versions: several tables that change together.

A version's tables are written under a folder of their own. Publishing writes
one small row that names them; readers take the newest published version. Until
that row is committed they see the version before, complete and unchanged, so a
failure between two tables leaves nothing half done.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTERS = "_published"
_SCHEMA = "version long, tables string"


def current(spark: SparkSession, base: str) -> tuple[int, dict]:
    """(version, what it names) of the newest published version; (-1, {}) before the first."""
    try:
        rows = spark.read.schema(_SCHEMA).json(f"{base.rstrip('/')}/{POINTERS}/*")
        newest = rows.agg(F.max(F.struct("version", "tables")).alias("p")).first()["p"]
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in (exc.getCondition() or ""):
            raise
        newest = None
    return (-1, {}) if newest is None else (newest["version"], json.loads(newest["tables"]))


def publish(spark: SparkSession, base: str, version: int, tables: dict) -> None:
    """Make ``tables`` the version that readers see; one row in one file, committed by its rename."""
    row = spark.createDataFrame([(version, json.dumps(tables))], _SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{base.rstrip('/')}/{POINTERS}/{version}")


def write_together(
    spark: SparkSession, base: str, write: Callable[[str], dict[str, str]]
) -> dict[str, str]:
    """Let ``write(folder)`` write the tables of the next version and publish their paths.

    A version that failed before it was published is overwritten by the next try.
    """
    version = current(spark, base)[0] + 1
    paths = write(f"{base.rstrip('/')}/version={version}")
    publish(spark, base, version, paths)
    return paths


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` of the newest published version."""
    return spark.read.parquet(current(spark, base)[1][name])
