"""Flatten landed JSON payloads into rows (SRC-02 .. SRC-09).

Payloads are read as text (one document per row) and parsed with an explicit
schema, then flattened with struct access and ``explode``; a file with a
million documents is a million-row scan split across tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from seamstat.functions import codes as K
from seamstat.functions.exprs import map_lookup, py_round, safe_num
from seamstat.sources.readers import from_text, read_csv_by_name
from seamstat.sources.schemas import SPRINT_SPEED

SPEED_CSV = StructType([f for f in SPRINT_SPEED.fields if f.name != "season"])


def parse(df: DataFrame, text_col: str, schema) -> DataFrame:
    """Parse a JSON text column with a declared schema into ``doc``."""
    return df.withColumn("doc", F.from_json(F.col(text_col), schema))


def read_landed(spark, path: str, schema) -> DataFrame:
    """Landed JSON files, one document per line, declared schema."""
    return spark.read.schema(schema).json(path)


def json_field(text_col: str, path: str, default=None, to: str | None = None) -> Column:
    """A value at a JSON path of a text column, with a default (SCA-17)."""
    v = F.get_json_object(F.col(text_col), path)
    if to is not None:
        v = v.try_cast(to)
    return v if default is None else F.coalesce(v, F.lit(default))


def first_split(doc: Column) -> Column:
    """``stats[0].splits[0]``; null where a payload has none."""
    return F.get(F.get(doc["stats"], 0)["splits"], 0)


def flatten_season_stats(doc: Column, fields: Mapping[str, str]) -> list[Column]:
    """First split only (``stats[0].splits[0].stat``), one column per field
    (SRC-02, SRC-03; T17)."""
    stat = first_split(doc)["stat"]
    return [stat[src].alias(dst) for dst, src in fields.items()]


def official_lines(df: DataFrame, fields: list[tuple[str, str]], player: str = "player_id",
                   season: str = "season") -> DataFrame:
    """Official season lines of parsed payloads (SRC-02, SRC-03): the asked
    player and season, the team of the first split, and one column per
    (column, field). A payload without a split gives no row."""
    split = first_split(F.col("doc"))
    return df.where(split.isNotNull()).select(
        F.col(player).cast("bigint").alias("player_id"), F.col(season).cast("int").alias("season"),
        split["team"]["id"].alias("team_id"), split["team"]["name"].alias("team_name"),
        *[split["stat"][src].alias(dst) for dst, src in fields])


def people(df: DataFrame) -> DataFrame:
    """Biographies of parsed people payloads; one without people gives no row."""
    return df.where(F.get(F.col("doc")["people"], 0).isNotNull()).select(*flatten_bio(F.col("doc")))


def flatten_bio(doc: Column) -> list[Column]:
    """People record: nested position, bat side and pitch hand (SRC-04)."""
    p = F.get(doc["people"], 0)
    return [p["id"].alias("player_id"), p["fullName"].alias("full_name"),
            p["firstName"].alias("first_name"), p["lastName"].alias("last_name"),
            F.to_date(p["birthDate"]).alias("birth_date"),
            p["currentAge"].cast("int").alias("current_age"),
            p["birthCity"].alias("birth_city"), p["birthStateProvince"].alias("birth_state"),
            p["birthCountry"].alias("birth_country"),
            p["height"].alias("height"), p["weight"].cast("int").alias("weight"),
            p["primaryPosition"]["abbreviation"].alias("primary_position"),
            p["primaryPosition"]["type"].alias("position_type"),
            p["batSide"]["code"].alias("bat_side"), p["pitchHand"]["code"].alias("pitch_hand"),
            p["draftYear"].cast("int").alias("draft_year"),
            F.to_date(p["mlbDebutDate"]).alias("mlb_debut_date"), p["active"].alias("active")]


def explode_splits(df: DataFrame, doc_col: str = "doc") -> DataFrame:
    """One row per split of ``stats[0].splits`` (SRC-05, SRC-06, SRC-08)."""
    return df.withColumn("split", F.explode(F.get(F.col(doc_col)["stats"], 0)["splits"]))


def flatten_milb_batting(df: DataFrame, sport_id: str = "sport_id",
                         season: str = "season") -> DataFrame:
    """Minor-league batting rows; level from the sport id, missing counts
    0, rate text parsed with sentinels as null (SRC-05, SCA-15)."""
    s = F.col("split")["stat"]
    z = lambda f: F.coalesce(s[f], F.lit(0)).cast("int")
    return explode_splits(df).select(
        F.col("split")["player"]["id"].alias("player_id"), F.col(season).cast("int").alias("season"),
        map_lookup(F.col(sport_id), K.SPORT_LEVEL).alias("level"),
        F.col("split")["team"]["name"].alias("team_name"), s["age"].cast("int").alias("age"),
        z("gamesPlayed").alias("games"), z("plateAppearances").alias("pa"),
        z("atBats").alias("ab"), z("hits").alias("hits"), z("doubles").alias("doubles"),
        z("triples").alias("triples"), z("homeRuns").alias("hr"), z("runs").alias("runs"),
        z("rbi").alias("rbi"), z("stolenBases").alias("sb"), z("caughtStealing").alias("cs"),
        z("baseOnBalls").alias("bb"), z("strikeOuts").alias("so"), z("hitByPitch").alias("hbp"),
        z("totalBases").alias("tb"),
        *[safe_num(s[x], "decimal(6,3)").alias(x) for x in ("avg", "obp", "slg", "ops", "babip")])


def milb_pitching_rates(df: DataFrame, constants: DataFrame | None = None) -> DataFrame:
    """Per-nine rates and FIP of minor-league lines (DOM-24): k_9 = so*9/ip
    (2 decimals), k_bb = k_9 - bb_9 (a difference), FIP without HBP plus the
    season constant or 3.10; null when innings are missing or zero. Rounded
    as the language rounds floats, on the exact binary value."""
    ip = F.when(F.col("ip") > 0, F.col("ip").cast("double"))
    if constants is not None:
        df = df.join(constants.select("season", F.col("cfip").cast("double").alias("__cf")), "season", "left")
    else:
        df = df.withColumn("__cf", F.lit(None).cast("double"))
    per9 = lambda x: py_round(F.col(x) * 9 / ip, 2)
    out = df.withColumns({"k_9": per9("so"), "bb_9": per9("bb"), "hr_9": per9("hr")})
    fip = (13 * F.col("hr") + 3 * F.col("bb") - 2 * F.col("so")) / ip + \
        F.coalesce(F.col("__cf"), F.lit(K.MILB_FIP_CONSTANT_DEFAULT))
    return out.withColumns({"k_bb": py_round(F.col("k_9") - F.col("bb_9"), 2),
                            "fip": py_round(fip, 2)}).drop("__cf")


def flatten_milb_pitching(df: DataFrame, constants: DataFrame | None = None,
                          sport_id: str = "sport_id", season: str = "season") -> DataFrame:
    """Minor-league pitching rows with derived rates (SRC-06)."""
    s = F.col("split")["stat"]
    z = lambda f: F.coalesce(s[f], F.lit(0)).cast("int")
    rows = explode_splits(df).select(
        F.col("split")["player"]["id"].alias("player_id"), F.col(season).cast("int").alias("season"),
        map_lookup(F.col(sport_id), K.SPORT_LEVEL).alias("level"),
        F.col("split")["team"]["name"].alias("team_name"), s["age"].cast("int").alias("age"),
        z("gamesPlayed").alias("games"), z("gamesStarted").alias("games_started"),
        z("wins").alias("wins"), z("losses").alias("losses"), z("saves").alias("saves"),
        safe_num(s["inningsPitched"]).alias("ip"), z("hits").alias("hits"),
        z("homeRuns").alias("hr"), z("baseOnBalls").alias("bb"), z("strikeOuts").alias("so"),
        z("hitByPitch").alias("hbp"), safe_num(s["era"]).alias("era"),
        safe_num(s["whip"]).alias("whip"), safe_num(s["avg"]).alias("avg_against"),
        safe_num(s["obp"]).alias("obp_against"))
    return milb_pitching_rates(rows, constants)


def flatten_game_log(df: DataFrame, entity: str = "player_id",
                     season: str = "season") -> DataFrame:
    """Per-game pitching rows: games started (missing 0), innings as a
    number, earned runs (missing stays null) (SRC-08)."""
    s = F.col("split")["stat"]
    return explode_splits(df).select(
        F.col(entity), F.col(season),
        F.coalesce(s["gamesStarted"], F.lit(0)).alias("games_started"),
        safe_num(F.coalesce(s["inningsPitched"], F.lit("0"))).alias("innings"),
        s["earnedRuns"].alias("earned_runs"))


def flatten_rosters(df: DataFrame, team: str = "team", team_name: str = "team_name",
                    season: str = "season", doc_col: str = "doc",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per roster entry; nested fields may be missing (SRC-09).
    ``roster_pos`` is the entry's position in its payload; ``keep`` columns
    of the document row are carried along."""
    r = F.posexplode(F.col(doc_col)["roster"]).alias("roster_pos", "r")
    return df.select(F.col(season), F.col(team), F.col(team_name), *keep, r).select(
        *keep, F.col("roster_pos"),
        F.col("r")["person"]["id"].cast("int").alias("player_id"),
        F.col(season).cast("int").alias("season"), F.col(team), F.col(team_name),
        F.col("r")["person"]["fullName"].alias("full_name"),
        F.col("r")["position"]["abbreviation"].alias("position"),
        F.col("r")["status"]["description"].alias("status"))


def read_sprint_speed(spark, paths: Mapping[int, str]) -> DataFrame:
    """Per-season CSV files: project five columns by name and tag the season
    (SRC-07)."""
    out = None
    for season, path in paths.items():
        df = read_csv_by_name(spark, [path], SPEED_CSV).withColumn("season", F.lit(season).cast("int"))
        out = df if out is None else out.unionByName(df)
    return out.select(*[f.name for f in SPRINT_SPEED.fields])


def read_sprint_speed_root(spark, root: str) -> DataFrame:
    """The same from one folder per season below ``root`` (``season=2024``):
    one scan of all seasons, the season being the partition column. Columns
    are matched by name; every file must have the first one's header."""
    header = spark.read.option("header", True).csv(root).columns
    raw = StructType([StructField(x, StringType()) for x in header])
    df = spark.read.schema(raw).option("header", True).option("enforceSchema", False).csv(root)
    typed = {f.name: f.dataType for f in SPRINT_SPEED.fields}
    return df.select(*[from_text(F.col(x).cast("string"), t).alias(x) for x, t in typed.items()])
