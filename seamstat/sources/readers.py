"""Table readers (SRC-01, SRC-10 .. SRC-12, SET-02).

Reads use declared schemas (no inference) and select only the columns a
caller needs, so Parquet scans read those columns and receive the pushed
predicates. Many landed files (e.g. weekly chunks) are one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

_L, _I, _S, _D = LongType(), IntegerType(), StringType(), DoubleType()

# FIXED VALUES: the 42 pitch-level columns that are loaded, with their types.
PITCHES = StructType([StructField(name, kind) for name, kind in [
    ("game_pk", _L), ("at_bat_number", _I), ("pitch_number", _I), ("pitcher", _L), ("batter", _L),
    ("pitch_type", _S), ("pitch_name", _S), ("release_speed", _D), ("release_pos_x", _D),
    ("release_pos_z", _D), ("release_spin_rate", _D), ("spin_axis", _D), ("pfx_x", _D),
    ("pfx_z", _D), ("plate_x", _D), ("plate_z", _D), ("zone", _I), ("p_throws", _S),
    ("stand", _S), ("balls", _I), ("strikes", _I), ("outs_when_up", _I), ("inning", _I),
    ("inning_topbot", _S), ("events", _S), ("description", _S), ("type", _S),
    ("launch_speed", _D), ("launch_angle", _D), ("hit_distance_sc", _D), ("hc_x", _D),
    ("hc_y", _D), ("estimated_ba_using_speedangle", _D), ("estimated_woba_using_speedangle", _D),
    ("bb_type", _S), ("on_1b", _L), ("on_2b", _L), ("on_3b", _L), ("if_fielding_alignment", _S),
    ("of_fielding_alignment", _S), ("sz_top", _D), ("sz_bot", _D)]])
GAMES = StructType([StructField("game_pk", LongType()), StructField("game_date", DateType()),
                    StructField("game_type", StringType()), StructField("home_team", StringType()),
                    StructField("away_team", StringType())])


def from_text(x: Column, to: DataType) -> Column:
    """A value of an untyped text column. A whole number may be written with
    a fraction of zeros (``3.0``); what does not parse, and a fraction where a
    whole number is due, is null. A text with a point goes to the decimal at
    once: a cast that fails costs an exception."""
    if isinstance(to, (IntegerType, LongType)):
        number = x.try_cast("decimal(38,10)")
        whole = F.when(number == F.floor(number), number)
        return F.coalesce(F.when(~x.contains("."), x.try_cast(to)), whole.try_cast(to))
    return x.try_cast(to)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, line): the first line of every file below ``paths``. One
    distributed pass over the files as text, whatever their number; only the
    split at a file's start is looked at, and its lines are numbered in order."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("value"), F.monotonically_increasing_id().alias("place"))
    return (lines.where(F.col("at") == 0).groupBy("file")
            .agg(F.min_by("value", "place").alias("line")))


def header_columns(line: str) -> tuple[str, ...]:
    """Column names of a header line (quoted names may hold commas)."""
    import csv
    return tuple(next(csv.reader([line.lstrip("\ufeff")]), []))


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """CSV files with a header each, matched by column name: files are grouped
    by their header, each group is one scan, and a file whose header differs
    from its group's fails instead of shifting columns. Absent columns are
    null, further ones are not kept. The headers come from one pass over all
    files; one row a file reaches the driver, which lists the files anyway."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(first_lines(spark, paths).collect(), key=lambda r: r["file"]):
        groups.setdefault(header_columns(r["line"]), []).append(r["file"])
    out = spark.createDataFrame([], schema) if not groups else None
    for header, files in groups.items():
        raw = StructType([StructField(name, StringType()) for name in header])
        df = spark.read.schema(raw).option("header", True).option("enforceSchema", False).csv(files)
        df = df.select(*[(from_text(F.col(f"`{f.name}`"), f.dataType) if f.name in header
                          else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
        out = df if out is None else out.unionByName(df)
    return out


def read_pitches(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                 schema: StructType = PITCHES) -> DataFrame:
    """Pitch events from one or many landed files, typed by the declared
    schema; CSV columns are matched by name and text that does not parse is
    null."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        return read_csv_by_name(spark, paths, schema)
    return spark.read.schema(schema).format(fmt).load(paths)


def read_games(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(GAMES).format(fmt).load(paths)


def scan(df: DataFrame, cols: Sequence[str | Column], where: Column | None = None) -> DataFrame:
    """Filtered, projected read (SRC-10 / SRC-11): the predicate and the
    column list reach the Parquet scan."""
    if where is not None:
        df = df.where(where)
    return df.select(*cols)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature matrix (SRC-12)."""
    return spark.read.parquet(path)
