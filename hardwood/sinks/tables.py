"""Writing and reading the staging and star tables, and exporting results."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import fields
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hardwood.plans.star import Staging, Star
from hardwood.sinks import versions
from hardwood.sources import schemas

logger = logging.getLogger(__name__)

STAGING_SCHEMAS = {
    "teams": schemas.STAGING_TEAMS,
    "game_log": schemas.STAGING_GAME_LOG,
    "team_stats_base": schemas.STAGING_STATS_BASE,
    "team_stats_advanced": schemas.STAGING_STATS_ADVANCED,
}
STAR_SCHEMAS = {
    "dim_team": schemas.DIM_TEAM,
    "dim_season": schemas.DIM_SEASON,
    "dim_game": schemas.DIM_GAME,
    "fact_team_game": schemas.FACT_TEAM_GAME,
    "fact_team_season": schemas.FACT_TEAM_SEASON,
}

# The tables that grow with the number of games.
LARGE_TABLES = ("dim_game", "fact_team_game")

_MANIFEST = "name string, uri string, rows long, schema string, star string"


def write_table(df: DataFrame, uri: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite the Parquet table at ``uri`` and return its rows, counted during the write."""
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(uri)
    return written.get["rows"]


def read_table(spark: SparkSession, uri: str, schema: StructType) -> DataFrame:
    """Read a written table with its columns in declared order."""
    return spark.read.schema(schema).parquet(uri).select(*schema.names)


def write_staging(staging: Staging, base: str) -> dict[str, int]:
    """Write the staging tables and return their numbers of rows; an empty one is warned about."""
    counts = {
        field.name: write_table(getattr(staging, field.name), f"{base}/{field.name}")
        for field in fields(Staging)
    }
    for table, rows in counts.items():
        logger.info("staging %s: %d rows", table, rows)
        if rows == 0:
            logger.warning("staging %s is empty", table)
    return counts


def read_staging(spark: SparkSession, base: str) -> Staging:
    return Staging(
        **{name: read_table(spark, f"{base}/{name}", s) for name, s in STAGING_SCHEMAS.items()}
    )


def write_star(star: Star, base: str, by_season: bool = False) -> dict[str, int]:
    """Write the star tables and return their numbers of rows.

    None of the analyses selects single seasons, so by default tables are written as they were
    computed, without a further shuffle. ``by_season`` puts the large tables into one folder
    per season, for users who read single seasons: the rebalance hint lets adaptive execution
    gather small seasons into few files and split a hot season between many tasks.
    """
    counts = {}
    for field in fields(Star):
        df, partition_by = getattr(star, field.name), []
        if by_season and field.name in LARGE_TABLES:
            df, partition_by = df.hint("rebalance", "season_id"), ["season_id"]
        counts[field.name] = write_table(df, f"{base}/{field.name}", partition_by)
    return counts


def read_star(spark: SparkSession, base: str) -> Star:
    """The star at ``base``: its current version, or the tables themselves where none was committed."""
    folder = versions.current(spark, base) or base
    return Star(
        **{name: read_table(spark, f"{folder}/{name}", s) for name, s in STAR_SCHEMAS.items()}
    )


class Exported(NamedTuple):
    uri: str
    rows: int
    schema: str


def export(df: DataFrame, base: str, theme: str, name: str) -> Exported:
    """Write one result under ``base/theme/name``; returns that URI, the rows written and their schema.

    ``base`` is any location Spark can write to, such as an object-store URI. Executors write
    the files themselves.
    """
    uri = f"{base.rstrip('/')}/{theme}/{name}"
    return Exported(uri, write_table(df, uri), df.schema.json())


def publish_catalog(
    spark: SparkSession, base: str, folder: str, results: Mapping[str, Exported], star: str
) -> None:
    """Commit the results written under ``folder`` as the catalog of ``base``.

    Its manifest, one row per result, is written with them: name, URI, rows, schema and the version
    of the star they come from.
    """
    rows = [(name, *result, star) for name, result in results.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    versions.commit(spark, base, folder)


def read_catalog(spark: SparkSession, base: str) -> dict[str, Exported]:
    """The results of the last catalog that was published whole at ``base``, by name."""
    folder = versions.current(spark, base)
    if folder is None:
        return {}
    rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").collect()  # a row per analysis
    return {row.name: Exported(row.uri, row.rows, row.schema) for row in rows}


def read_result(spark: SparkSession, result: Exported) -> DataFrame:
    """A published result, with the columns and types it was written with."""
    return spark.read.schema(StructType.fromJson(json.loads(result.schema))).parquet(result.uri)
