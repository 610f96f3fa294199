"""Document fingerprints: Merkle tree over sections and paragraphs (native).

A text is cut after blank lines into sections, after line ends into
paragraphs, and a paragraph into leaves of 4, 4, 8, 16, 32 and then 64
characters, so that the leaves in order are the text itself and a short text
still has several. A node's hash is the hash of its
children's. Equal roots mean equal texts; where two trees differ, the
differing branches say which section, paragraph and leaf was edited.

The fingerprint is ``root:tree``: 32 hex digits of the root, then 6 hex
digits a leaf, leaves joined by ``,``, paragraphs by ``;``, sections by ``/``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, read_table

LEAF_CHARS = 64
# Leaves double from 4 characters at a paragraph's start to LEAF_CHARS.
LEAF = (r"(?s)\A.{1,4}|" + "|".join(rf"(?<=\A.{{{n}}}).{{1,{n}}}" for n in (4, 8, 16, 32))
        + rf"|.{{1,{LEAF_CHARS}}}")
LEAF_HEX = 6
RANGE_ROWS = 2_000      # documents a range of ids
MAX_FAN = 256           # at most MAX_FAN * MAX_FAN ranges


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


def sections(text: Column) -> Column:
    """Sections (array) of paragraphs (array) of leaves (array of strings)."""
    def cut(c, pattern):
        return F.filter(F.split(c, pattern), lambda x: x != "")

    return F.transform(
        cut(F.coalesce(text, F.lit("")), r"(?<=\n\n)"),
        lambda s: F.transform(cut(s, r"(?<=\n)"),
                              lambda p: F.regexp_extract_all(p, F.lit(LEAF), F.lit(0))))


def tree(text: Column) -> Column:
    """Leaf hashes in the shape of ``sections``."""
    return F.transform(sections(text), lambda s: F.transform(s, lambda p: F.transform(p, _md5)))


def root(leaves: Column) -> Column:
    """Root hash of a tree: paragraph, section and document nodes in turn."""
    return _md5(F.array_join(F.transform(
        leaves, lambda s: _md5(F.array_join(F.transform(s, lambda p: _md5(F.array_join(p, ","))), ";"))), "/"))


def serialise(leaves: Column) -> Column:
    return F.concat(root(leaves), F.lit(":"), F.array_join(F.transform(
        leaves, lambda s: F.array_join(F.transform(
            s, lambda p: F.array_join(F.transform(p, lambda h: F.substring(h, 1, LEAF_HEX)), ",")), ";")), "/"))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column (null text: empty)."""
    t = free_name([*df.columns, name], "merkle_tree")
    return df.withColumn(t, tree(F.col(f"`{text}`"))).withColumn(name, serialise(F.col(t))).drop(t)


def leaves_of(fingerprint: Column) -> Column:
    return F.filter(F.split(F.substring_index(fingerprint, ":", -1), "[,;/]"), lambda x: x != "")


def likeness(a: Column, b: Column) -> Column:
    """Shared leaves of two fingerprints: 2 * common / (leaves of both), over
    distinct leaves. Equal roots give 1 (two empty texts too)."""
    x, y = F.array_distinct(leaves_of(a)), F.array_distinct(leaves_of(b))
    same = F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)
    return F.when(same, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(F.lit(2.0) * F.size(F.array_intersect(x, y)), (F.size(x) + F.size(y)).cast("double")),
                   F.lit(0.0)))


def edited_branches(a: Column, b: Column) -> Column:
    """Where two fingerprints differ: array of (section, paragraph) from 0, by
    descending only into branches whose nodes differ. Empty if roots agree."""
    def parts(fp, sep):
        return F.split(fp, sep)

    def differing(x, y, sep):
        x, y = parts(x, sep), parts(y, sep)
        return F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(x), F.size(y)) - 1), lambda i: F.struct(
            i.alias("at"), F.coalesce(F.get(x, i), F.lit("")).alias("x"), F.coalesce(F.get(y, i), F.lit("")).alias("y"))),
            lambda n: n["x"] != n["y"])

    ta, tb = F.substring_index(a, ":", -1), F.substring_index(b, ":", -1)
    return F.flatten(F.transform(differing(ta, tb, "/"), lambda s: F.transform(
        differing(s["x"], s["y"], ";"), lambda p: F.struct(s["at"].alias("section"), p["at"].alias("paragraph")))))


def id_ranges(df: DataFrame, id: str, tie: str, range_rows: int = RANGE_ROWS) -> Column:
    """Range number, ascending with the id and then with ``tie`` (a hash, so
    its values are spread evenly); null ids have negative numbers. Cut points
    are the id's quantiles: an id that many rows share is a cut point many
    times over, and its rows are dealt by ``tie`` to that many ranges more.
    The number of ranges follows the number of rows, up to ``MAX_FAN ** 2`` cut
    points on the driver. The look-up is four scans of the square root of
    that."""
    rows, nulls = df.agg(F.count(F.lit(1)), F.count_if(F.col(f"`{id}`").isNull())).first()
    fan = min(MAX_FAN, max(2, math.ceil(math.sqrt(rows / range_rows))))
    n = fan * fan
    cuts = df.select(F.percentile_approx(F.col(f"`{id}`"), [k / n for k in range(1, n)], 20 * n)).first()[0]
    v, even = F.col(f"`{id}`"), F.col(f"`{tie}`").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)

    def share(parts):
        return F.least(F.floor(even * parts), parts - 1).cast("int")

    spare = min(MAX_FAN * MAX_FAN, max(1, math.ceil(nulls / range_rows)))
    at_null = share(F.lit(spare)) - F.lit(spare)
    if not cuts:
        return at_null
    coarse = F.array(*[F.lit(c) for c in cuts[fan - 1::fan]])
    fine = F.array(*[F.array(*[F.lit(c) for c in cuts[k * fan:k * fan + fan - 1]]) for k in range(fan)])

    def count(test):
        top = F.size(F.filter(coarse, test))
        return top * fan + F.size(F.filter(F.get(fine, top), test))

    below, upto = count(lambda c: c < v), count(lambda c: c <= v)
    return F.when(v.isNull(), at_null).otherwise(below + share(upto - below + 1))


def next_in_order(df: DataFrame, id: str, columns: dict[str, str], tie: str,
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """For rows in descending order of ``id`` (nulls last, then ``tie``
    descending), add ``columns`` (source -> name) of the next row; the last
    row's next is the first.

    Rows are grouped by ranges of ids and ties, so that null ids, or an id that
    many rows share, are spread like the rest. Each range also gets a copy of
    the first row of the range after it, so one window over a bounded range
    sees every row's successor and the texts move once.
    """
    rng, mark = free_name(df.columns, "order_range"), free_name(df.columns, "order_guest")
    ranged = df.withColumn(rng, id_ranges(df, id, tie, range_rows))
    heads = ranged.groupBy(rng).agg(F.max(F.struct(F.col(f"`{id}`").alias("i"), F.col(tie).alias("t"))).alias("h"))
    heads = heads.select(F.col(rng).alias("h_range"), F.col("h.i").alias("h_id"), F.col("h.t").alias("h_tie"))
    # One row a range.
    after = Window.orderBy(F.col("h_range").desc())
    hosts = heads.withColumn("h_host", F.coalesce(
        F.lag("h_range").over(after),
        F.min("h_range").over(Window.partitionBy(F.lit(0)))))
    guests = (ranged.join(F.broadcast(hosts), F.col(rng).eqNullSafe(F.col("h_range"))
                          & F.col(f"`{id}`").eqNullSafe(F.col("h_id")) & (F.col(tie) == F.col("h_tie")))
              .withColumn(rng, F.col("h_host")).select(*ranged.columns))
    # Of repeated first rows one is enough; they are equal in every column used.
    both = ranged.withColumn(mark, F.lit(0)).unionByName(guests.withColumn(mark, F.lit(1)))
    w = Window.partitionBy(rng).orderBy(mark, F.col(f"`{id}`").desc_nulls_last(), F.col(tie).desc())
    for source, name in columns.items():
        both = both.withColumn(name, F.lead(f"`{source}`").over(w))
    return both.where(F.col(mark) == 0).drop(mark, rng)


def edited_text(text: Column, following: Column) -> Column:
    """``text`` whose last floor(n / 2) characters are replaced by the first
    as many of ``following`` (all of it, if shorter)."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def fingerprints_with_edits(docs: DataFrame, id: str = "doc_id", text: str = "text",
                            range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: ``n_chars``, ``fingerprint``, and the edited
    text's ``edited_sha256``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (likeness to the edited text and to the next document).

    A null text is empty; an empty text has the root of no sections. Whole
    texts are hashed, however long. Null ids come after all others. Rows with equal ids are in order of a hash of
    their text; repeated rows give repeated results. A single row is its own
    next. Extra columns are not read. An empty table gives an empty result.
    """
    df = docs.select(F.col(f"`{id}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    df = df.withColumn("tie", F.xxhash64("text"))
    df = with_fingerprint(df, "text", "fingerprint")
    df = next_in_order(df, "key", {"text": "next_text", "fingerprint": "next_fp"}, "tie", range_rows)
    df = df.withColumn("edited", edited_text(F.col("text"), F.col("next_text"))).drop("next_text")
    df = with_fingerprint(df, "edited", "edited_fingerprint")
    return df.select(F.col("key").alias(id), F.char_length("text").cast("long").alias("n_chars"),
                     F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                     "fingerprint", "edited_fingerprint",
                     likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                     likeness(F.col("fingerprint"), F.col("next_fp")).alias("near_next"))


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(read_table(spark, sf_dir, "documents"))


def _duck_prints(name: str, src: str) -> str:
    """CTEs up to ``<name>_f`` (id, fingerprint, distinct leaves) of the texts (id, t) in ``src``."""
    return rf"""{name}_p AS (
  SELECT id, i, par, sum(CASE WHEN i > 1 AND par = chr(10) THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sec
  FROM (SELECT id, unnest(ps) AS par, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT id, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ps FROM {src}))),
{name}_l AS (
  SELECT id, i, coalesce(sec, 0) AS sec, list_transform(list_filter([0, 4, 8, 16, 32] || range(64, greatest(length(par), 64), 64), lambda o: o < length(par)),
         lambda o: md5(substr(par, o + 1, CASE WHEN o < 4 THEN 4 WHEN o < 64 THEN o ELSE 64 END))) AS h FROM {name}_p),
{name}_s AS (
  SELECT id, sec, md5(string_agg(md5(array_to_string(h, ',')), ';' ORDER BY i)) AS sh,
         string_agg(array_to_string(list_transform(h, lambda y: substr(y, 1, 6)), ','), ';' ORDER BY i) AS ss FROM {name}_l GROUP BY id, sec),
{name}_r AS (SELECT id, md5(string_agg(sh, '/' ORDER BY sec)) || ':' || string_agg(ss, '/' ORDER BY sec) AS f FROM {name}_s GROUP BY id),
{name}_f AS (SELECT s.id, coalesce(r.f, md5('') || ':') AS f,
             list_distinct(list_filter(regexp_split_to_array(split_part(coalesce(r.f, ':'), ':', 2), '[,;/]'), lambda y: y <> '')) AS ls
      FROM {src} s LEFT JOIN {name}_r r USING (id))"""


def _duck_likeness(a: str, b: str) -> str:
    return (f"CASE WHEN split_part({a}.f, ':', 1) = split_part({b}.f, ':', 1) THEN 1.0::DOUBLE WHEN len({a}.ls) + len({b}.ls) = 0 THEN 0.0::DOUBLE "
            f"ELSE 2.0::DOUBLE * len(list_intersect({a}.ls, {b}.ls)) / (len({a}.ls) + len({b}.ls))::DOUBLE END")


ORACLE = rf"""
WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents),
o AS (SELECT id, t, coalesce(lead(id) OVER w, first_value(id) OVER w) AS nid FROM d
      WINDOW w AS (ORDER BY id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
n AS (SELECT o.id, o.nid, o.t, length(o.t) AS c, substr(o.t, 1, length(o.t) - length(o.t) // 2) || substr(x.t, 1, length(o.t) // 2) AS e
      FROM o JOIN d x ON x.id = o.nid),
e AS (SELECT id, e AS t FROM n),
{_duck_prints('a', 'd')},
{_duck_prints('b', 'e')}
SELECT n.id AS doc_id, n.c::BIGINT AS n_chars, sha256(n.e) AS edited_sha256, x.f AS fingerprint, y.f AS edited_fingerprint,
       {_duck_likeness('x', 'y')} AS near_edited, {_duck_likeness('x', 'z')} AS near_next
FROM n JOIN a_f x ON x.id = n.id JOIN b_f y ON y.id = n.id JOIN a_f z ON z.id = n.nid
"""
