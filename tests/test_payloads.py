"""Payloads as variants against the declared-schema readers."""
import json

import pytest
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.sources import landed_json as LJ
from seamstat.sources import payloads as P
from seamstat.sources import schemas as S

STAT = {"homeRuns": 3, "gamesPlayed": 9, "avg": ".300", "odd": {"a": [1, 2]}, "later": 7, "rbi": "x"}
DOCS = [
    {"stats": [{"splits": [{"stat": STAT, "team": {"id": 5, "name": "T"}, "player": {"id": 8}},
                           {"stat": {"homeRuns": 1, "avg": ".---"}, "team": {"name": "U"}, "player": {"id": 9}}]}],
     "people": [{"id": 4, "fullName": "A B", "birthDate": "1990-01-02", "currentAge": 30, "active": True, "batSide": {"code": "L"},
                 "nick": "Ace", "primaryPosition": {"abbreviation": "C", "type": "Catcher"}}]},
    {"stats": [], "people": []}, {"stats": [{"splits": []}]}, {"stats": [{"splits": None}], "people": None}, {}]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [json.dumps(d) for d in DOCS] + ["not json", None]
    return spark.createDataFrame([(i, 2000 + i, 11, t) for i, t in enumerate(texts)],
                                 "player_id long, season int, sport_id int, payload string")


def test_official_lines_and_people_keep_what_is_not_declared(docs):
    out = P.official_lines(P.parse(docs, "payload"), K.OFFICIAL_BATTING).collect()
    want = LJ.official_lines(LJ.parse(docs, "payload", S.STATS_PAYLOAD), K.OFFICIAL_BATTING)
    assert len(out) == 1 and out[0]["home_runs"] == 3 and out[0]["team_name"] == "T" and out[0]["rbi"] is None
    assert set(want.columns) == set(out[0].asDict()) - {"extra"}
    assert out[0]["extra"] == {"odd": '{"a":[1,2]}', "later": "7"}
    bio = P.people(P.parse(docs, "payload")).collect()
    plain = LJ.people(LJ.parse(docs, "payload", S.PEOPLE_PAYLOAD)).collect()
    assert [r["extra"] for r in bio] == [{"nick": "Ace"}]
    assert [{k: v for k, v in r.asDict().items() if k != "extra"} for r in bio] == [r.asDict() for r in plain]


def test_minor_league_pages(docs):
    out = P.milb_batting(P.parse(docs, "payload"), extra=None)
    well = docs.where(F.col("player_id") < 5).withColumn("payload", F.regexp_replace("payload", '"rbi": "x"', '"rbi": null'))
    want = LJ.flatten_milb_batting(LJ.parse(well, "payload", S.STATS_PAYLOAD))
    assert sorted(map(tuple, out.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    extra = [r["extra"] for r in P.milb_batting(P.parse(docs, "payload")).orderBy("player_id").collect()]
    assert extra == [{"odd": '{"a":[1,2]}', "later": "7"}, {}]
