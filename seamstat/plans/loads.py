"""Warehouse loads: the maintenance rule of each stored table, composed from
the table operators (SNK-01 .. SNK-09). Each function returns the table's
new contents; ``operators.tables.write_table`` (or the streaming reload)
persists it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from seamstat.functions import codes as K
from seamstat.operators import tables as TB
from seamstat.sources import schemas as S


def load_pitches(stored: DataFrame, incoming: DataFrame, key: str = "game_pk") -> DataFrame:
    """Reloading a game replaces all its pitches (SNK-03)."""
    return TB.replace_keys(stored, incoming, [key])


def load_games(stored: DataFrame, incoming: DataFrame, key: str = "game_pk") -> DataFrame:
    """Games are written once; a known game keeps its row (SNK-05)."""
    return TB.insert_absent(stored, incoming.dropDuplicates([key]), [key])


def load_players(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A stored non-null name wins over a newly resolved one (SNK-08)."""
    return TB.upsert_coalesce(stored, incoming, ["player_id"], ["player_name"])


def load_milb_batting(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Minor-league batting lines: on a known key only the refreshed columns
    take the new value (age, doubles, triples, runs, rbi, cs, hbp and babip
    stay as stored) (SNK-07)."""
    return TB.upsert(stored, incoming, S.MILB_BATTING_KEY, K.MILB_BATTING_REFRESHED)


def load_milb_pitching(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Minor-league pitching lines: every column but age is refreshed."""
    cols = [c for c in stored.columns if c not in S.MILB_PITCHING_KEY + K.MILB_PITCHING_KEPT]
    return TB.upsert(stored, incoming, S.MILB_PITCHING_KEY, cols)


def load_quality_starts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    return TB.upsert(stored, incoming, S.QUALITY_STARTS_KEY)


def load_sprint_speed(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A season's file replaces that season (SNK-04)."""
    return TB.replace_partitions(stored, incoming, "season")


def load_rosters(stored: DataFrame, incoming: DataFrame, order: str = "entry_seq") -> DataFrame:
    """``order`` may be a struct (load, position in the payload). The loaded season is replaced; a player listed twice keeps the last
    entry in load order (SNK-04, SNK-06, T18)."""
    kept = stored.join(incoming.select("season").distinct(), "season", "left_anti")
    empty = incoming.sparkSession.createDataFrame([], incoming.drop(order).schema)
    latest = TB.upsert(empty, incoming, S.ACTIVE_40_MAN_KEY, order=order)
    return kept.unionByName(latest.select(*stored.columns))
