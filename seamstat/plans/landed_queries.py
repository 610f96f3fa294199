"""Driver queries of the landed-file readers and the ordered upsert.

The landed documents and CSV files are made by Spark from the driver tables,
row for row; each oracle computes the expected rows from the same tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamstat.functions import codes as K
from seamstat.plans import testdata as T
from seamstat.plans.queries import _dbl, _store, register
from seamstat.session import checkpoint_table_path, small_methods
from seamstat.sources import landed_json as LJ
from seamstat.sources import schemas as S
from seamstat.sources.readers import PITCHES

# A payload field's test value: how many items of a supplier and year have
# (line number + quantity) divisible by the field's place plus two. Text
# fields are that count in thousandths, or the sentinel where it is 0.


def _empty(player, season):
    return (player + season) % 7 == 0


def _official_docs(spark, sf_dir, fields) -> DataFrame:
    """One payload per supplier and ship year; a second split must be
    ignored, and one payload in seven has no split."""
    li = T.read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber") + F.col("l_quantity").cast("int")
    g = li.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season")).agg(
        *[F.count_if(n % (i + 2) == 0).alias(f"n{i}") for i in range(len(fields))])

    def value(i, field):
        x = F.col(f"n{i}")
        if field in K.OFFICIAL_TEXT:
            x = F.when(x == 0, ".---").otherwise(F.format_string("%.3f", x / 1000.0))
        return x.alias(field)

    first = F.struct(F.struct(*[value(i, f) for i, (_, f) in enumerate(fields)]).alias("stat"),
                     F.struct((F.col("player_id") % 30).alias("id"),
                              F.concat(F.lit("Team "), (F.col("player_id") % 30).cast("string")).alias("name")).alias("team"))
    second = F.struct(F.struct(*[F.lit("0" if f in K.OFFICIAL_TEXT else 0).cast(
        "string" if f in K.OFFICIAL_TEXT else "bigint").alias(f) for _, f in fields]).alias("stat"),
        F.struct(F.lit(-1).cast("bigint").alias("id"), F.lit("other").alias("name")).alias("team"))
    splits = F.when(_empty(F.col("player_id"), F.col("season")), F.array().cast(
        g.select(F.array(first)).schema[0].dataType)).otherwise(F.array(first, second))
    return g.select("player_id", "season", F.to_json(F.struct(F.array(F.struct(splits.alias("splits"))).alias("stats")))
                    .alias("payload"))


def _official(spark, sf_dir, fields):
    docs = LJ.parse(_official_docs(spark, sf_dir, fields), "payload", S.STATS_PAYLOAD)
    return LJ.official_lines(docs, fields).withColumn("season", F.col("season").cast("bigint"))


def _duck_official(fields) -> str:
    cols = []
    for i, (name, field) in enumerate(fields):
        n = f"count(*) FILTER (WHERE (l_linenumber + CAST(l_quantity AS INTEGER)) % {i + 2} = 0)"
        cols.append(f"CASE WHEN {n} = 0 THEN '.---' ELSE printf('%.3f', {n} / 1000.0) END AS {name}"
                    if field in K.OFFICIAL_TEXT else f"CAST({n} AS BIGINT) AS {name}")
    return f"""SELECT CAST(l_suppkey AS BIGINT) AS player_id, CAST(year(l_shipdate) AS BIGINT) AS season,
       CAST(l_suppkey % 30 AS BIGINT) AS team_id, 'Team ' || (l_suppkey % 30) AS team_name, {', '.join(cols)}
FROM lineitem GROUP BY l_suppkey, year(l_shipdate) HAVING (l_suppkey + year(l_shipdate)) % 7 <> 0"""


@register("q_official_batting", _duck_official(K.OFFICIAL_BATTING))
def q_official_batting(spark, sf_dir):
    """Official batting lines, all 38 columns (SRC-02, T17)."""
    return _official(spark, sf_dir, K.OFFICIAL_BATTING)


@register("q_official_pitching", _duck_official(K.OFFICIAL_PITCHING))
def q_official_pitching(spark, sf_dir):
    """Official pitching lines, all 64 columns (SRC-03, T17)."""
    return _official(spark, sf_dir, K.OFFICIAL_PITCHING)


@register("q_json_empty_payloads", """
WITH d AS (SELECT s_suppkey AS id, s_name, s_suppkey % 5 AS kind FROM supplier)
SELECT 'bio' AS source, CAST(id AS BIGINT) AS player_id, s_name AS name, CAST(NULL AS BIGINT) AS n FROM d WHERE kind = 4
UNION ALL SELECT 'batting', id, NULL, id FROM d WHERE kind = 4
UNION ALL SELECT 'log', id, NULL, 1 FROM d WHERE kind = 4""")
def q_json_empty_payloads(spark, sf_dir):
    """Payloads with no people, no stats, no splits and null lists among
    whole ones: they give no row and no error (SRC-02..06, SRC-08)."""
    s = T.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("player_id"), "s_name",
                                                 (F.col("s_suppkey") % 5).alias("kind"))
    who = F.col("player_id").cast("string")
    whole = F.concat(F.lit('{"people":[{"id":'), who, F.lit(',"fullName":"'), F.col("s_name"),
                     F.lit('"}],"stats":[{"splits":[{"stat":{"homeRuns":'), who, F.lit(',"gamesStarted":1}}]}]}'))
    docs = s.withColumn("payload", F.when(F.col("kind") == 4, whole).otherwise(F.try_element_at(
        F.array(F.lit("{}"), F.lit('{"people":[],"stats":[]}'), F.lit('{"stats":[{"splits":[]}]}'),
                F.lit('{"people":null,"stats":[{"splits":null}]}')), (F.col("kind") + 1).cast("int")))) \
        .withColumn("season", F.lit(2000))
    bio = LJ.people(LJ.parse(docs, "payload", S.PEOPLE_PAYLOAD)).select(
        F.lit("bio").alias("source"), "player_id", F.col("full_name").alias("name"), F.lit(None).cast("bigint").alias("n"))
    bat = LJ.official_lines(LJ.parse(docs, "payload", S.STATS_PAYLOAD), K.OFFICIAL_BATTING).select(
        F.lit("batting").alias("source"), "player_id", F.lit(None).cast("string").alias("name"), F.col("home_runs").alias("n"))
    log = LJ.flatten_game_log(LJ.parse(docs, "payload", S.GAME_LOG_PAYLOAD)).select(
        F.lit("log").alias("source"), "player_id", F.lit(None).cast("string").alias("name"),
        F.col("games_started").alias("n"))
    return bio.unionByName(bat).unionByName(log)


def _pitch_columns() -> dict[str, str]:
    """An SQL expression over ``lineitem`` for each of the 42 pitch columns,
    the same in both engines; some are null by a rule of their own."""
    out = {"game_pk": "CAST(l_orderkey AS BIGINT)", "at_bat_number": "CAST(l_linenumber AS INTEGER)",
           "pitcher": "CAST(l_suppkey AS BIGINT)", "batter": "CAST(l_suppkey + 1 AS BIGINT)",
           "inning_topbot": "CASE WHEN l_linestatus = 'F' THEN 'Top' ELSE 'Bot' END"}
    for i, f in enumerate(PITCHES.fields):
        if f.name in out:
            continue
        n = f"(l_partkey * {i + 2} + l_linenumber * {2 * i + 3} + l_suppkey)"
        kind = f.dataType.typeName()
        value = {"double": f"CAST({n} % 1021 - 400 AS DOUBLE) / 8", "string": f"concat('{f.name[:2]} ', CAST({n} % 7 AS VARCHAR(9)))",
                 "integer": f"CAST({n} % 40 AS INTEGER)", "long": f"CAST({n} AS BIGINT)"}[kind]
        out[f.name] = f"CASE WHEN {n} % {i % 9 + 5} = 0 THEN NULL ELSE {value} END"
    return {f.name: out[f.name] for f in PITCHES.fields}


PITCH_COLUMNS = _pitch_columns()


@register("q_landed_pitches_csv", "SELECT " + ", ".join(f"{x} AS {c}" for c, x in PITCH_COLUMNS.items()) + " FROM lineitem")
def q_landed_pitches_csv(spark, sf_dir):
    """Pitch events, all 42 columns, landed as CSV in two deliveries with
    different column orders, one writing whole numbers as ``3.0`` and with a
    further column, read as one table by column name (SRC-01, SET-02)."""
    from seamstat.sources.readers import read_pitches
    run = checkpoint_table_path(spark, f"landed_pitches/{uuid.uuid4().hex}")
    p = T.read(spark, sf_dir, "lineitem").select(*[F.expr(x).alias(c) for c, x in PITCH_COLUMNS.items()])
    top, bot = (os.path.join(run, x) for x in ("top", "bot"))
    floats = _dbl(p.where("inning_topbot <> 'Top'"), ["batter", "at_bat_number", "zone", "on_1b"])
    with small_methods(spark):
        p.where("inning_topbot = 'Top'").write.option("header", True).csv(top)
        floats.select(F.lit("x").alias("extra"), *reversed(p.columns)).write.option("header", True).csv(bot)
    return read_pitches(spark, [top, bot], "csv")


@register("q_upsert_ordered", """
WITH inc AS (
  SELECT o_custkey AS player_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE year(o_orderdate) END AS loaded,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status, o_orderkey AS v FROM orders),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY loaded DESC NULLS LAST,
                   status DESC NULLS LAST, v DESC NULLS LAST) AS rk FROM inc) t WHERE rk = 1),
st AS (SELECT c_custkey AS player_id, 1990 AS loaded, c_mktsegment AS status, -c_custkey AS v FROM customer)
SELECT coalesce(l.player_id, st.player_id) AS player_id,
       CAST(CASE WHEN l.player_id IS NOT NULL THEN l.loaded ELSE st.loaded END AS BIGINT) AS loaded,
       CASE WHEN l.player_id IS NOT NULL THEN l.status ELSE st.status END AS status,
       CASE WHEN l.player_id IS NOT NULL THEN l.v ELSE st.v END AS v
FROM st FULL OUTER JOIN last l ON l.player_id = st.player_id""")
def q_upsert_ordered(spark, sf_dir):
    """Upsert with several incoming rows a key, some with a null order and
    many with a tied one (SNK-06): null is lowest, ties go to the greatest
    row."""
    o = T.read(spark, sf_dir, "orders")
    incoming = o.select(
        F.col("o_custkey").alias("player_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.year("o_orderdate")).cast("bigint").alias("loaded"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("v"))
    stored = T.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"), F.lit(1990).cast("bigint").alias("loaded"),
        F.col("c_mktsegment").alias("status"), (-F.col("c_custkey")).alias("v"))
    return _store(stored, ["player_id"], "upsert_ordered").upsert(incoming, order="loaded").read().select(
        "player_id", "loaded", "status", "v")


# --------------------------------------------------- files of any header --
@register("q_impute", """
WITH r AS (SELECT l_returnflag, l_linestatus,
                  CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / l_tax END AS price_tax,
                  CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END AS qty_discount FROM lineitem)
SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
       count(*) FILTER (WHERE price_tax IS NULL) AS price_zeros, count(*) FILTER (WHERE qty_discount IS NULL) AS qty_zeros,
       round(sum(coalesce(price_tax, 0)) / count(*), 4) AS price_mean, round(sum(coalesce(qty_discount, 0)) / count(*), 4) AS qty_mean
FROM r GROUP BY 1, 2""")
def q_impute(spark, sf_dir):
    """Ratios whose zero denominators give infinities (of either sign) and
    not-a-numbers, read as 0 before a model sees them (MLO-03, SCA-12)."""
    from seamstat.operators.modeling import impute_zero
    li = T.read(spark, sf_dir, "lineitem")

    def ratio(num, den, odd):
        bad = F.when(F.col("l_linenumber") == 1, float("nan")).when(F.col("l_linenumber") == 2, float("-inf")).otherwise(odd)
        return F.when(F.col(den) == 0, bad).otherwise(F.try_divide(F.col(num), F.col(den)))

    df = li.withColumns({"price_tax": ratio("l_extendedprice", "l_tax", float("inf")),
                         "qty_discount": ratio("l_quantity", "l_discount", None)})
    out = impute_zero(df, ["price_tax", "qty_discount"])
    zeros = lambda c: F.count_if(F.col(c) == 0).cast("bigint")
    return out.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), zeros("price_tax").alias("price_zeros"),
        zeros("qty_discount").alias("qty_zeros"),
        F.round(F.sum("price_tax") / F.count(F.lit(1)), 4).alias("price_mean"),
        F.round(F.sum("qty_discount") / F.count(F.lit(1)), 4).alias("qty_mean"))


@register("q_python_round", """
SELECT l_orderkey, l_linenumber, CAST(printf('%.2f', l_extendedprice / 8) AS DOUBLE) AS price,
       CAST(printf('%.2f', l_quantity / 16 + l_tax / 2) AS DOUBLE) AS mixed, CAST(printf('%.1f', -l_quantity / 20) AS DOUBLE) AS below,
       CAST(printf('%.3f', l_discount * l_quantity / 3) AS DOUBLE) AS third, CAST(printf('%.0f', l_quantity / 2) AS DOUBLE) AS whole
FROM lineitem""")
def q_python_round(spark, sf_dir):
    """The language's own float rounding, decided on the exact binary value,
    on tie-prone eighths, sixteenths and decimals (SCA-03)."""
    from seamstat.functions.exprs import py_round
    q, x = F.col("l_quantity"), F.col("l_extendedprice")
    return T.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", py_round(x / 8, 2).alias("price"),
        py_round(q / 16 + F.col("l_tax") / 2, 2).alias("mixed"), py_round(-q / 20, 1).alias("below"),
        py_round(F.col("l_discount") * q / 3, 3).alias("third"), py_round(q / 2, 0).alias("whole"))


@register("q_bucketed_join", T.duck_with(T.DUCK_GAMES, T.DUCK_PITCHES) + """
SELECT g.home_team, CAST(year(g.game_date) AS INTEGER) AS season, count(*) AS n_pitches,
       count(p.events) AS n_events, count(DISTINCT p.game_pk) AS n_games
FROM pitches_v p JOIN games_v g ON g.game_pk = p.game_pk GROUP BY 1, 2""")
def q_bucketed_join(spark, sf_dir):
    """Pitches and games stored in buckets of the game, joined and combined
    per game without an exchange (JON-01)."""
    from seamstat.sources.bucketed import write_bucketed
    run = uuid.uuid4().hex
    stored = {}
    for name, df in (("pitches", T.pitches(spark, sf_dir).select("game_pk", "events")),
                     ("games", T.games(spark, sf_dir).select("game_pk", "home_team", "game_date"))):
        path = checkpoint_table_path(spark, f"bucketed/{name}-{run}")
        stored[name] = write_bucketed(df, f"seamstat_{name}_{run}", path, ["game_pk"], 8)
    return games_joined(stored["pitches"], stored["games"])


def games_joined(pitches: DataFrame, games: DataFrame) -> DataFrame:
    per_game = pitches.hint("merge").join(games, "game_pk").groupBy("game_pk", "home_team", "game_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("events").alias("e"))
    return per_game.groupBy("home_team", F.year("game_date").alias("season")).agg(
        F.sum("n").alias("n_pitches"), F.sum("e").alias("n_events"), F.count(F.lit(1)).alias("n_games"))


@register("q_payload_extras", _duck_official(K.OFFICIAL_BATTING).replace("\nFROM lineitem", """,
       CAST(sum(l_linenumber) AS VARCHAR) AS new_count, CASE WHEN count(*) % 2 = 0 THEN 'even' END AS new_text,
       CASE WHEN count(*) % 2 = 0 THEN 3 ELSE 2 END AS n_extra
FROM lineitem"""))
def q_payload_extras(spark, sf_dir):
    """Official batting lines of payloads that hold fields nobody declared:
    parsed once as variants, all 38 declared columns and the rest kept
    (SRC-02, SCA-17)."""
    from seamstat.sources import payloads as P
    li = T.read(spark, sf_dir, "lineitem")
    more = li.groupBy(F.col("l_suppkey").alias("player_id"), F.year("l_shipdate").alias("season")).agg(
        F.sum("l_linenumber").alias("newCount"), F.when(F.count(F.lit(1)) % 2 == 0, "even").alias("newText"))
    docs = _official_docs(spark, sf_dir, K.OFFICIAL_BATTING).join(more, ["player_id", "season"])
    added = F.concat(F.lit('"stat":{"newCount":'), F.col("newCount").cast("string"), F.lit(',"newList":[1,{"a":2}]'),
                     F.coalesce(F.concat(F.lit(',"newText":"'), F.col("newText"), F.lit('"')), F.lit("")), F.lit(","))
    # Only the first split's line is touched: the marker is replaced once.
    cut = F.instr("payload", '"stat":{')
    payload = F.when(cut > 0, F.concat(F.substring("payload", F.lit(1), cut - 1), added,
                                       F.substring("payload", cut + 8, F.length("payload")))).otherwise(F.col("payload"))
    out = P.official_lines(P.parse(docs.withColumn("payload", payload), "payload"), K.OFFICIAL_BATTING)
    return out.withColumn("season", F.col("season").cast("bigint")).withColumns({
        "new_count": F.col("extra")["newCount"], "new_text": F.col("extra")["newText"],
        "n_extra": F.size("extra")}).drop("extra")
