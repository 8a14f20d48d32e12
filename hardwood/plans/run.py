"""The full run: landed JSON to staging tables, star schema and exported results."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from hardwood.plans.analyses import ANALYSES, side_totals
from hardwood.plans.star import Staging, Star, build_star, require_valid
from hardwood.sinks import versions
from hardwood.sinks.scratch import keep, release
from hardwood.sinks.tables import (
    Exported,
    export,
    publish_catalog,
    read_staging,
    read_star,
    write_staging,
    write_star,
)
from hardwood.sources import landed

logger = logging.getLogger(__name__)


@contextmanager
def _phase(name: str) -> Iterator[None]:
    started = time.monotonic()
    yield
    logger.info("%s took %.1f s", name, time.monotonic() - started)


def load(spark: SparkSession, landing: str, out: str, lines: bool = False) -> Staging:
    """Read the landed files into staging tables under ``out/staging``, replacing older ones."""
    staging = Staging(
        teams=landed.read_teams(spark, f"{landing}/team_static", lines),
        game_log=landed.read_game_log(spark, f"{landing}/game_logs", lines),
        team_stats_base=landed.read_team_stats_base(spark, f"{landing}/team_stats", lines),
        team_stats_advanced=landed.read_team_stats_advanced(spark, f"{landing}/team_stats", lines),
    )
    write_staging(staging, f"{out}/staging")
    return read_staging(spark, f"{out}/staging")


def transform(spark: SparkSession, staging: Staging, out: str) -> Star:
    """Build and write the star schema, check what was written, and commit it at ``out/star``.

    The tables are written once, beside the older star, and checked as written: the checks read a
    few columns and derive nothing again. A failure at any step leaves the older star as it is.
    """
    base = f"{out}/star"
    candidate = versions.new_version(base)
    for table, rows in write_star(build_star(staging), candidate).items():
        logger.info("%s: %d rows", table, rows)
    require_valid(read_star(spark, candidate))
    versions.commit(spark, base, candidate)
    return read_star(spark, base)


def export_all(star: Star, base: str, star_version: str = "") -> dict[str, Exported]:
    """Export every analysis in order and publish all together; returns URI, rows and schema by name.

    The first failure raises, and the catalog published before stays. The facts are reduced once to
    the totals that most analyses start from.
    """
    spark = star.dim_team.sparkSession
    folder = versions.new_version(base)
    totals = keep(side_totals(star), "side_totals")
    exported = {}
    for name, analysis in ANALYSES.items():
        exported[name] = export(analysis.run(star, totals), folder, analysis.theme, name)
        logger.info("%s: %d rows written to %s", name, exported[name].rows, exported[name].uri)
    publish_catalog(spark, base, folder, exported, star_version)
    return exported


def run(spark: SparkSession, landing: str, out: str, lines: bool = False) -> dict[str, Exported]:
    with _phase("load"):
        staging = load(spark, landing, out, lines)
    with _phase("transform"):
        star = transform(spark, staging, out)
    with _phase("export"):
        version = versions.version_name(versions.current(spark, f"{out}/star"))
        return export_all(star, f"{out}/exports", version)


def main(arguments: list[str]) -> None:
    lines = "--lines" in arguments
    places = [argument for argument in arguments if argument != "--lines"]
    if len(places) != 2:
        raise SystemExit("usage: spark-submit ... hardwood/plans/run.py [--lines] LANDING_URI OUTPUT_URI")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = (
        SparkSession.builder.appName("hardwood")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run(spark, *places, lines=lines)
    release(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
