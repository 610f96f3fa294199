"""Landed JSON payloads parsed once as variants (SRC-02 .. SRC-06, SCA-17).

A declared schema drops what it does not name. Here a payload is parsed into a
variant, declared fields are taken from it by path and type, and the rest of
the flattened object is kept as a map of texts, so that a field that a source
begins to send is in the table from its first day. A payload that is no JSON
has no fields; a value of another type than declared is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.functions.exprs import map_lookup, safe_num

FIRST_SPLIT = "$.stats[0].splits[0]"


def parse(df: DataFrame, text_col: str, doc: str = "doc") -> DataFrame:
    """``df`` with the payload as a variant; null where it is no JSON."""
    return df.withColumn(doc, F.try_parse_json(F.col(text_col)))


def at(doc: Column, path: str, to: str = "string") -> Column:
    """The value at a path as ``to``; null where it is absent or another type."""
    return F.try_variant_get(doc, path, to)


def rest(obj: Column, declared: Sequence[str]) -> Column:
    """The fields of a variant object that are not ``declared``, as texts; an
    empty map where there are none."""
    every = F.try_variant_get(obj, "$", "map<string,variant>")
    more = F.map_filter(every, lambda k, v: ~k.isin(list(declared)))
    texts = F.transform_values(more, lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    return F.coalesce(texts, F.create_map().cast("map<string,string>"))


def official_lines(df: DataFrame, fields: Sequence[tuple[str, str]], player: str = "player_id",
                   season: str = "season", extra: str | None = "extra") -> DataFrame:
    """As ``landed_json.official_lines``, with the undeclared fields of the
    first split's line in ``extra``."""
    doc = F.col("doc")
    stat = F.try_variant_get(doc, FIRST_SPLIT + ".stat", "variant")
    cols = [at(doc, f"{FIRST_SPLIT}.stat.{src}", "string" if src in K.OFFICIAL_TEXT else "bigint").alias(dst) for dst, src in fields]
    out = df.where(F.try_variant_get(doc, FIRST_SPLIT, "variant").isNotNull()).select(
        F.col(player).cast("bigint").alias("player_id"), F.col(season).cast("int").alias("season"),
        at(doc, FIRST_SPLIT + ".team.id", "bigint").alias("team_id"), at(doc, FIRST_SPLIT + ".team.name").alias("team_name"),
        *cols, *([rest(stat, [src for _, src in fields]).alias(extra)] if extra else []))
    return out


BIO_TEXT = {"full_name": "fullName", "first_name": "firstName", "last_name": "lastName", "birth_city": "birthCity",
            "birth_state": "birthStateProvince", "birth_country": "birthCountry", "height": "height",
            "primary_position": "primaryPosition.abbreviation", "position_type": "primaryPosition.type",
            "bat_side": "batSide.code", "pitch_hand": "pitchHand.code"}
BIO_INT = {"current_age": "currentAge", "weight": "weight", "draft_year": "draftYear"}
BIO_DATE = {"birth_date": "birthDate", "mlb_debut_date": "mlbDebutDate"}


def people(df: DataFrame, extra: str | None = "extra") -> DataFrame:
    """As ``landed_json.people``, with the undeclared fields of the person."""
    doc, p = F.col("doc"), "$.people[0]"
    person = F.try_variant_get(doc, p, "variant")
    declared = {x.split(".")[0] for d in (BIO_TEXT, BIO_INT, BIO_DATE) for x in d.values()} | {"id", "active"}
    return df.where(person.isNotNull()).select(
        at(doc, f"{p}.id", "bigint").alias("player_id"),
        *[at(doc, f"{p}.{x}").alias(c) for c, x in BIO_TEXT.items()],
        *[at(doc, f"{p}.{x}", "int").alias(c) for c, x in BIO_INT.items()],
        *[F.to_date(at(doc, f"{p}.{x}")).alias(c) for c, x in BIO_DATE.items()],
        at(doc, f"{p}.active", "boolean").alias("active"),
        *([rest(person, sorted(declared)).alias(extra)] if extra else []))


# Column and field of a minor-league batting line.
MILB_COUNTS = {"games": "gamesPlayed", "pa": "plateAppearances", "ab": "atBats", "hits": "hits", "doubles": "doubles",
               "triples": "triples", "hr": "homeRuns", "runs": "runs", "rbi": "rbi", "sb": "stolenBases",
               "cs": "caughtStealing", "bb": "baseOnBalls", "so": "strikeOuts", "hbp": "hitByPitch", "tb": "totalBases"}
MILB_RATES = ["avg", "obp", "slg", "ops", "babip"]


def milb_batting(df: DataFrame, sport_id: str = "sport_id", season: str = "season", extra: str | None = "extra") -> DataFrame:
    """As ``landed_json.flatten_milb_batting``: a row a split of the page, with
    its line's undeclared fields."""
    splits = F.try_variant_get(F.col("doc"), "$.stats[0].splits", "array<variant>")
    rows = df.withColumn("split", F.explode(splits))
    s = F.col("split")
    stat = F.try_variant_get(s, "$.stat", "variant")
    return rows.select(
        at(s, "$.player.id", "bigint").alias("player_id"), F.col(season).cast("int").alias("season"),
        map_lookup(F.col(sport_id), K.SPORT_LEVEL).alias("level"), at(s, "$.team.name").alias("team_name"),
        at(s, "$.stat.age", "int").alias("age"),
        *[F.coalesce(at(s, f"$.stat.{x}", "int"), F.lit(0)).alias(c) for c, x in MILB_COUNTS.items()],
        *[safe_num(at(s, f"$.stat.{x}"), "decimal(6,3)").alias(x) for x in MILB_RATES],
        *([rest(stat, [*MILB_COUNTS.values(), *MILB_RATES, "age"]).alias(extra)] if extra else []))
