"""Driver queries of storing and re-reading tables, column projections,
leaderboards and the minor-league payload readers, each through the engine
function that a job would call."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamstat.operators import projections as PR
from seamstat.operators import tables as TB
from seamstat.plans import testdata as T
from seamstat.plans.oracle_sql import exact
from seamstat.plans.queries import (_CUST_SEASON, _PIT_WITH, _cust_season, _duck_pitching_select, _pitching, register)
from seamstat.sources import landed_json as LJ
from seamstat.sources import readers
from seamstat.sources import schemas as S


@register("q_append_aligned", """
SELECT o_custkey AS player_id, CAST(year(o_orderdate) AS BIGINT) AS season, o_orderpriority AS team, NULL AS note
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT), NULL, o_clerk FROM
  (SELECT *, 'n' || CAST(o_custkey % 9 AS VARCHAR) AS o_clerk FROM orders) WHERE o_orderstatus = 'P'""")
def q_append_aligned(spark, sf_dir):
    """New rows cut to the stored table's columns (a generated id is left
    out) and appended (SNK-01, SNK-09, SET-05)."""
    o = T.read(spark, sf_dir, "orders").withColumns({
        "player_id": F.col("o_custkey"), "season": F.year("o_orderdate").cast("bigint")})
    stored = o.where("o_orderstatus <> 'P'").select("player_id", "season", F.col("o_orderpriority").alias("team"),
                                                    F.lit(None).cast("string").alias("note"))
    new = o.where("o_orderstatus = 'P'").select(
        F.col("o_orderkey").alias("id"), "player_id", "season", F.lit(1).alias("not_stored"),
        F.concat(F.lit("n"), (F.col("o_custkey") % 9).cast("string")).alias("note"))
    aligned = TB.align_to_schema(new, ["id", "player_id", "season", "note", "not_stored"], ["id", *stored.columns])
    return TB.append(stored, aligned)


@register("q_feature_store", T.duck_with(_CUST_SEASON) + """
SELECT player_id, season + 1 AS season, lines AS lines_prior, qty AS qty_prior, 'R' AS source
FROM cs WHERE season BETWEEN 1996 AND 1999""")
def q_feature_store(spark, sf_dir):
    """A feature table written over its earlier contents and read back:
    range scan, prior-season key, templated names, dropped helper columns
    (SNK-02, SRC-10, SRC-12, FLT-03, PRJ-02, PRJ-04, PRJ-07, PRJ-08)."""
    import uuid

    from seamstat.session import checkpoint_table_path
    path = checkpoint_table_path(spark, f"features/{uuid.uuid4().hex}")
    cs = _cust_season(spark, sf_dir).withColumn("lg_lines", F.lit(1.0))
    TB.write_table(cs.limit(0), path)
    TB.write_table(cs, path)
    stored = readers.scan(readers.read_features(spark, path), ["player_id", "season", "lines", "qty", "lg_lines"],
                          F.col("season").between(1996, 1999))
    out = PR.drop_matching(PR.shift_key(stored), prefix="lg_")
    return PR.with_literal(PR.rename_template(out, ["lines", "qty"], "{}_prior"), "source", "R")


@register("q_numeric_features", """
SELECT l_returnflag, sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
       round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax
FROM lineitem GROUP BY l_returnflag""")
def q_numeric_features(spark, sf_dir):
    """Numeric columns by schema, keys excluded, summed a flag (PRJ-05)."""
    from seamstat.operators.modeling import numeric_features
    li = T.read(spark, sf_dir, "lineitem")
    cols = numeric_features(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return li.groupBy("l_returnflag").agg(*[
        (F.sum(c) if c == "l_quantity" else F.round(F.sum(c), 2)).alias(c) for c in cols])


@register("q_role_leaders", _PIT_WITH + ", full_lines AS (" + _duck_pitching_select() + """)
SELECT * FROM (SELECT 'starter' AS role, pitcher AS player_id, season, ip FROM full_lines
  WHERE split_type = 'total' AND ip >= 50 ORDER BY ip DESC, pitcher, season LIMIT 30)
UNION ALL SELECT * FROM (SELECT 'reliever', pitcher, season, ip FROM full_lines
  WHERE split_type = 'total' AND ip < 100 ORDER BY ip DESC, pitcher, season LIMIT 30)""")
def q_role_leaders(spark, sf_dir):
    """Leaders of two roles, each under its innings filter (FLT-07, MLO-15)."""
    from seamstat.operators.modeling import leaderboard
    p = _pitching(spark, sf_dir).where("split_type = 'total'").select(F.col("pitcher").alias("player_id"), "season", "ip")
    tie = ("player_id", "season")
    top = [leaderboard(p, "ip", 30, cond, tie).select(F.lit(role).alias("role"), "player_id", "season", "ip")
           for role, cond in (("starter", F.col("ip") >= 50), ("reliever", F.col("ip") < 100))]
    return top[0].unionByName(top[1])


@register("q_name_lookup", """
SELECT c_custkey AS player_id, c_name AS player_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def q_name_lookup(spark, sf_dir):
    """Stored names of a set of ids (JON-15)."""
    from seamstat.operators.joins import lookup
    ids = T.read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("player_id"))
    names = T.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"))
    return lookup(ids, names)


# A page a (sport, season): one split a supplier. Field values are counts of
# the supplier's items; the sport follows from the order's priority.
def _milb_pages(spark, sf_dir, fields: dict[str, str]):
    li = T.read(spark, sf_dir, "lineitem")
    o = T.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    g = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        (F.substring("o_orderpriority", 1, 1).cast("int") + 10).alias("sport_id"),
        F.year("l_shipdate").alias("season"), "l_suppkey").agg(*[F.expr(sql).alias(f) for f, sql in fields.items()])
    split = F.struct(F.struct(F.col("l_suppkey").alias("id")).alias("player"),
                     F.struct(F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("name")).alias("team"),
                     F.struct(*fields).alias("stat"))
    doc = F.to_json(F.struct(F.array(F.struct(F.collect_list(split).alias("splits"))).alias("stats")))
    # A page holds at most a hundred players.
    return g.withColumn("page", F.floor(F.col("l_suppkey") / 100)).groupBy("sport_id", "season", "page").agg(doc.alias("payload"))


_BAT_FIELDS = {"gamesPlayed": "count(*)", "plateAppearances": "count(*) * 2", "homeRuns": "nullif(count_if(l_quantity > 45), 0)",
               "avg": "if(count_if(l_quantity > 30) = 0, '.---', format_string('%.3f', count_if(l_quantity > 30) / 1000.0D))"}
_BAT_NAMES = ["ab", "hits", "doubles", "triples", "runs", "rbi", "sb", "cs", "bb", "so", "hbp", "tb"]


@register("q_milb_json_batting", """
WITH g AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 10 AS sport_id, year(l_shipdate) AS season, l_suppkey, count(*) AS n,
         count(*) FILTER (WHERE l_quantity > 45) AS hr, count(*) FILTER (WHERE l_quantity > 30) AS av
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
SELECT CAST(l_suppkey AS BIGINT) AS player_id, CAST(season AS BIGINT) AS season,
       CASE sport_id WHEN 11 THEN 'AAA' WHEN 12 THEN 'AA' WHEN 13 THEN 'High-A' WHEN 14 THEN 'Single-A' END AS level,
       'T' || l_suppkey AS team_name, CAST(n AS BIGINT) AS games, CAST(2 * n AS BIGINT) AS pa, CAST(hr AS BIGINT) AS hr,
       """ + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in _BAT_NAMES) + """,
       CASE WHEN av > 0 THEN CAST(printf('%.3f', av / 1000.0) AS DOUBLE) END AS avg
FROM g""")
def q_milb_json_batting(spark, sf_dir):
    """Minor-league batting pages flattened: level of the sport, missing
    counts 0, sentinels null (SRC-05, SCA-15)."""
    docs = LJ.parse(_milb_pages(spark, sf_dir, _BAT_FIELDS), "payload", S.STATS_PAYLOAD)
    out = LJ.flatten_milb_batting(docs)
    return out.select("player_id", F.col("season").cast("bigint").alias("season"), "level", "team_name",
                      *[F.col(c).cast("bigint").alias(c) for c in ["games", "pa", "hr", *_BAT_NAMES]],
                      F.col("avg").cast("double").alias("avg"))


_PIT_FIELDS = {"gamesPlayed": "count(*)", "inningsPitched": "if(count(*) < 2, '-', format_string('%d.0', count(*)))",
               "strikeOuts": "count_if(l_quantity > 30)", "baseOnBalls": "nullif(count_if(l_quantity < 10), 0)",
               "homeRuns": "count_if(l_quantity > 45)", "era": "'-.--'"}


@register("q_milb_json_pitching", T.duck_with(T.duck_constants()) + """,
g AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 10 AS sport_id, year(l_shipdate) AS season, l_suppkey, count(*) AS n,
         CASE WHEN count(*) >= 2 THEN CAST(count(*) AS DOUBLE) END AS ip, count(*) FILTER (WHERE l_quantity > 30) AS so,
         count(*) FILTER (WHERE l_quantity < 10) AS bb, count(*) FILTER (WHERE l_quantity > 45) AS hr
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)
SELECT CAST(l_suppkey AS BIGINT) AS player_id, CAST(g.season AS BIGINT) AS season,
       CASE sport_id WHEN 11 THEN 'AAA' WHEN 12 THEN 'AA' WHEN 13 THEN 'High-A' WHEN 14 THEN 'Single-A' END AS level,
       CAST(n AS BIGINT) AS games, ip, CAST(so AS BIGINT) AS so, CAST(bb AS BIGINT) AS bb, CAST(hr AS BIGINT) AS hr,
       CAST(NULL AS DOUBLE) AS era, """ + f"""{exact('so * 9 / ip', 2)} AS k_9, {exact('bb * 9 / ip', 2)} AS bb_9,
       {exact('hr * 9 / ip', 2)} AS hr_9, {exact(exact('so * 9 / ip', 2) + ' - ' + exact('bb * 9 / ip', 2), 2)} AS k_bb,
       {exact('(13 * hr + 3 * bb - 2 * so) / ip + coalesce(CAST(c.cfip AS DOUBLE), 3.10)', 2)} AS fip
FROM g LEFT JOIN constants_v c ON c.season = g.season""")
def q_milb_json_pitching(spark, sf_dir):
    """Minor-league pitching pages flattened, with per-nine rates and FIP
    (SRC-06, DOM-24)."""
    docs = LJ.parse(_milb_pages(spark, sf_dir, _PIT_FIELDS), "payload", S.STATS_PAYLOAD)
    out = LJ.flatten_milb_pitching(docs, T.constants(spark).select("season", "cfip"))
    return out.select("player_id", F.col("season").cast("bigint").alias("season"), "level",
                      *[F.col(c).cast("bigint").alias(c) for c in ("games", "so", "bb", "hr")],
                      "ip", "era", "k_9", "bb_9", "hr_9", "k_bb", "fip")
