"""Declared schemas of landed payloads and stored tables (SNK-10).

Key contracts are checked with ``quality.duplicate_keys`` rather than
enforced by a storage engine.
"""

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType,
                               DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from seamstat.functions import codes as K


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# Landed JSON: season statistics (batting or pitching) for one player; every
# field of both official lines.
SEASON_STAT_TEXT = K.OFFICIAL_TEXT
SEASON_STAT_FIELDS = [f for f in dict.fromkeys(
    field for _, field in K.OFFICIAL_BATTING + K.OFFICIAL_PITCHING) if f not in SEASON_STAT_TEXT]

STAT = _s(*[(f, LongType()) for f in SEASON_STAT_FIELDS],
          *[(f, StringType()) for f in SEASON_STAT_TEXT])
TEAM = _s(("id", LongType()), ("name", StringType()))
PERSON = _s(("id", LongType()), ("fullName", StringType()))
SPLIT = _s(("season", StringType()), ("stat", STAT), ("team", TEAM), ("player", PERSON),
           ("date", StringType()))
STATS_PAYLOAD = _s(("stats", ArrayType(_s(("splits", ArrayType(SPLIT))))))

# Game logs: only the fields a quality-start count reads are declared, so
# the parser materialises three values per split.
GAME_LOG_STAT = _s(("gamesStarted", LongType()), ("inningsPitched", StringType()),
                   ("earnedRuns", LongType()))
GAME_LOG_PAYLOAD = _s(("stats", ArrayType(_s(("splits", ArrayType(_s(("stat", GAME_LOG_STAT))))))))

PEOPLE_PAYLOAD = _s(("people", ArrayType(_s(
    ("id", LongType()), ("fullName", StringType()), ("firstName", StringType()),
    ("lastName", StringType()), ("birthDate", StringType()), ("currentAge", LongType()),
    ("birthCity", StringType()), ("birthStateProvince", StringType()),
    ("birthCountry", StringType()), ("height", StringType()), ("weight", LongType()),
    ("draftYear", LongType()), ("active", BooleanType()),
    ("primaryPosition", _s(("abbreviation", StringType()), ("type", StringType()))),
    ("batSide", _s(("code", StringType()))), ("pitchHand", _s(("code", StringType()))),
    ("mlbDebutDate", StringType())))))

ROSTER_PAYLOAD = _s(("roster", ArrayType(_s(
    ("person", PERSON), ("position", _s(("abbreviation", StringType()))),
    ("status", _s(("description", StringType())))))))

# Stored tables with declared keys.
MILB_BATTING = _s(("player_id", LongType()), ("season", IntegerType()), ("level", StringType()),
                  ("team_name", StringType()), ("age", IntegerType()), ("games", IntegerType()),
                  ("pa", IntegerType()), ("ab", IntegerType()), ("hits", IntegerType()),
                  ("doubles", IntegerType()), ("triples", IntegerType()), ("hr", IntegerType()),
                  ("runs", IntegerType()), ("rbi", IntegerType()), ("sb", IntegerType()),
                  ("cs", IntegerType()), ("bb", IntegerType()), ("so", IntegerType()),
                  ("hbp", IntegerType()), ("tb", IntegerType()), ("avg", DecimalType(6, 3)),
                  ("obp", DecimalType(6, 3)), ("slg", DecimalType(6, 3)),
                  ("ops", DecimalType(6, 3)), ("babip", DecimalType(6, 3)))
MILB_BATTING_KEY = ["player_id", "season", "level", "team_name"]
MILB_PITCHING = _s(("player_id", LongType()), ("season", IntegerType()), ("level", StringType()),
                   ("team_name", StringType()), ("age", IntegerType()), ("games", IntegerType()),
                   ("games_started", IntegerType()), ("wins", IntegerType()),
                   ("losses", IntegerType()), ("saves", IntegerType()), ("ip", DoubleType()),
                   ("hits", IntegerType()), ("hr", IntegerType()), ("bb", IntegerType()),
                   ("so", IntegerType()), ("hbp", IntegerType()), ("era", DoubleType()),
                   ("whip", DoubleType()), ("k_9", DoubleType()), ("bb_9", DoubleType()),
                   ("hr_9", DoubleType()), ("k_bb", DoubleType()), ("avg_against", DoubleType()),
                   ("obp_against", DoubleType()), ("fip", DoubleType()))
MILB_PITCHING_KEY = MILB_BATTING_KEY
SPRINT_SPEED = _s(("player_id", IntegerType()), ("season", IntegerType()),
                  ("sprint_speed", DecimalType(5, 2)), ("hp_to_1b", DecimalType(5, 2)),
                  ("bolts", IntegerType()), ("competitive_runs", IntegerType()))
SPRINT_SPEED_KEY = ["player_id", "season"]
QUALITY_STARTS = _s(("player_id", LongType()), ("season", IntegerType()),
                    ("games_started", IntegerType()), ("quality_starts", IntegerType()))
QUALITY_STARTS_KEY = ["player_id", "season"]
ACTIVE_40_MAN = _s(("player_id", IntegerType()), ("season", IntegerType()), ("team", StringType()),
                   ("team_name", StringType()), ("full_name", StringType()),
                   ("position", StringType()), ("status", StringType()))
ACTIVE_40_MAN_KEY = ["player_id", "season"]
PLAYER_BIO = _s(("player_id", LongType()), ("full_name", StringType()),
                ("first_name", StringType()), ("last_name", StringType()),
                ("birth_date", DateType()), ("current_age", IntegerType()),
                ("birth_city", StringType()), ("birth_state", StringType()),
                ("birth_country", StringType()),
                ("height", StringType()), ("weight", IntegerType()),
                ("primary_position", StringType()), ("position_type", StringType()),
                ("bat_side", StringType()), ("pitch_hand", StringType()),
                ("draft_year", IntegerType()), ("mlb_debut_date", DateType()),
                ("active", BooleanType()))
