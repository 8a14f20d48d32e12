"""Readers of landed JSON files: teams, game logs and season stats.

A landed file is one indented JSON array of objects, which one task must read whole. Large
landings should be JSON Lines instead (``lines=True``), which Spark splits between tasks.

Everything that a file holds is read or refused. Each line must be one object, and each array file
one array of objects; anything before or after it, a cut value, a null in an object's place, an array
file without content, or a key that is present in two spellings raises an error that names the file.
Of a key that is repeated in one spelling the last value counts, as JSON readers have it. A key in a
third spelling beside one that is filled in lower or upper case is ignored like any other key. Empty
lines and empty line files (as writers leave them) hold nothing, and an empty array has no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, StructField, StructType

from hardwood.sources import schemas
from hardwood.sources.schemas import conform

_MAPS = "map<string,string>"


def _raise(text: str, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{text} in "), F.col("file_name"))).cast(kind)


def _require_content(texts: DataFrame, path: str) -> None:
    """Raise for a file of no bytes: it is listed, but no scan gives a row for it.

    Only names are compared; no content is read.
    """
    base = lambda uri: uri.rstrip("/").rsplit("/", 1)[-1]
    filled = texts.sparkSession.read.format("binaryFile").load(path).select("path", "length")
    listed, found = texts.inputFiles(), [row.path for row in filled.select("path").collect()]
    if len(listed) > len(found):
        empty = Counter(map(base, listed)) - Counter(map(base, found))
        raise ValueError(f"damaged JSON in {', '.join(sorted(empty))}: the file is empty")


def _as_parsed(kind: DataType) -> DataType:
    """Whole numbers may be landed as ``41.0``."""
    return DoubleType() if isinstance(kind, IntegerType) else kind


def _any_spelling(maps: str, schema: StructType) -> Column:
    """Rows of ``schema`` from maps of texts, by lower-cased keys; a key in two spellings raises."""
    keys = "transform(map_keys(m), k -> lower(k))"
    twice = f"CAST(raise_error(concat('key in two spellings in ', file_name)) AS {_MAPS})"
    lowered = (
        f"CASE WHEN size(array_distinct({keys})) < size(map_keys(m)) THEN {twice} "
        f"ELSE map_from_arrays({keys}, map_values(m)) END"
    )
    fields = ", ".join(
        f"'{field.name}', CAST(element_at(m, '{field.name}') AS {_as_parsed(field.dataType).simpleString()})"
        for field in schema.fields
    )
    return F.expr(f"transform(transform({maps}, m -> {lowered}), m -> named_struct({fields}))")


def _read(
    spark: SparkSession,
    path: str,
    schema: StructType,
    lines: bool,
    chosen: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rows of landed JSON objects, with their columns by lower-cased key and ``file_name``.

    Keys may be in any case, also mixed within a landing. Values are taken as written and cast:
    a whole number may be landed as ``41.0``. Nothing is guessed from samples and nothing is
    dropped. Keys beyond the schema are ignored, and a missing key gives NULL.

    Objects are parsed once, with fields for the lower-case and the upper-case spelling of each key.
    One that fills all fields of one spelling, and none of the other, is taken as it is. Only the
    others, those with a NULL, a number written as a string, or keys in another spelling, are parsed
    again as a map.
    """
    names = schema.names
    spelled = StructType([
        StructField(spelling, _as_parsed(field.dataType))
        for field in schema.fields for spelling in (field.name, field.name.upper())
    ])
    # Fields are read by place, as their names differ in case only.
    kinds = [_as_parsed(field.dataType).simpleString() for field in schema.fields]
    by_place = "struct<" + ",".join(f"{side}{i}:{kind}" for i, kind in enumerate(kinds) for side in "ab") + ">"
    texts = spark.read.text(path, wholetext=not lines)
    if not lines:
        _require_content(texts, path)
    texts = texts.select("value", F.col("_metadata.file_name").alias("file_name"))
    if chosen is not None:
        texts = texts.filter(chosen(F.col("file_name")))
    if lines:
        texts = texts.filter(F.trim(F.translate("value", "\r\n\t", "   ")) != "")

    # Within added brackets the parser takes the whole text or nothing: it must be one element.
    bracketed = "concat('[', value, ']')"
    kind, held, maps = spelled, by_place, f"from_json({bracketed}, 'array<{_MAPS}>')"
    if not lines:
        kind, held = ArrayType(spelled), f"array<{by_place}>"
        maps = f"get(from_json({bracketed}, 'array<array<{_MAPS}>>'), 0)"
    texts = texts.withColumn("parsed", F.from_json(F.expr(bracketed), ArrayType(kind)).cast(f"array<{held}>"))
    one = F.get("parsed", F.lit(0))
    whole = (F.size("parsed") == 1) & one.isNotNull()
    if not lines:
        whole = whole & ~F.exists(F.coalesce(one, F.array()), lambda element: element.isNull())
    whole = F.coalesce(whole, F.lit(False))
    texts = texts.withColumn("found", F.when(whole, one).otherwise(_raise("damaged JSON", held)))

    # Long lists of fields are built as SQL text, which is parsed at once.
    def filled(row: str, side: str, other: str) -> str:
        return " AND ".join(
            f"{row}.{side}{i} IS NOT NULL AND {row}.{other}{i} IS NULL" for i in range(len(names))
        )

    def of(row: str, side: str) -> str:
        return "named_struct(" + ", ".join(f"'{name}', {row}.{side}{i}" for i, name in enumerate(names)) + ")"

    if lines:
        again = F.get(_any_spelling(maps, schema), F.lit(0))
        row = "CASE WHEN {} THEN {} WHEN {} THEN {} END"
        sides = filled("found", "a", "b"), of("found", "a"), filled("found", "b", "a"), of("found", "b")
        taken = F.expr(row.format(*sides))
        rows = texts.select("file_name", F.coalesce(taken, again).alias("row"))
    else:
        again = _any_spelling(maps, schema)
        lower, upper = (F.expr(f"forall(found, x -> {filled('x', *sides)})") for sides in ("ab", "ba"))
        taken = F.when(lower, F.expr(f"transform(found, x -> {of('x', 'a')})"))
        taken = taken.when(upper, F.expr(f"transform(found, x -> {of('x', 'b')})"))
        rows = texts.select("file_name", F.explode(taken.otherwise(again)).alias("row"))
    narrowed = [
        f"CAST(rint(row.{f.name}) AS INT) AS {f.name}" if isinstance(f.dataType, IntegerType) else f"row.{f.name}"
        for f in schema.fields
    ]
    return rows.selectExpr(*narrowed, "file_name")


def read_teams(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return conform(_read(spark, path, schemas.STAGING_TEAMS, lines), schemas.STAGING_TEAMS)


def read_game_log(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return conform(_read(spark, path, schemas.STAGING_GAME_LOG, lines), schemas.STAGING_GAME_LOG)


def season_of_file(name: Column) -> Column:
    """The season label that a stats file's name starts with."""
    return F.substring(name, 1, 7)


def location_of_file(name: Column) -> Column:
    """Home or Road as found in a stats file's name, NULL when it says neither."""
    return F.when(name.contains("Home"), "Home").when(name.contains("Road"), "Road")


def is_base_file(name: Column) -> Column:
    return name.contains("Base")


def is_advanced_file(name: Column) -> Column:
    """A name that says both counts as base; a name that says neither is in no table."""
    return ~is_base_file(name) & name.contains("Advanced")


def _read_stats(
    spark: SparkSession,
    path: str,
    file_schema: StructType,
    schema: StructType,
    chosen: Callable[[Column], Column],
    lines: bool,
) -> DataFrame:
    name = F.col("file_name")
    rows = _read(spark, path, file_schema, lines, chosen)
    tagged = rows.select(
        "*", season_of_file(name).alias("season"), location_of_file(name).alias("location")
    )
    return conform(tagged, schema)


def read_team_stats_base(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _read_stats(
        spark, path, schemas.STATS_BASE_FILE, schemas.STAGING_STATS_BASE, is_base_file, lines
    )


def read_team_stats_advanced(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return _read_stats(
        spark,
        path,
        schemas.STATS_ADVANCED_FILE,
        schemas.STAGING_STATS_ADVANCED,
        is_advanced_file,
        lines,
    )
