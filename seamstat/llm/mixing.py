"""Mixing sources to target weights by systematic sampling (native).

Every source gets a target number of words; each of its documents is expected
``target / source size`` times. Documents are laid out along a line per
source, the running sum of expected copies is shifted by one random offset,
and a document is emitted once for every integer boundary its stretch
crosses. The line runs by word count (in classes of 1/16 octave) and by a
hash of the id and the text within a class, so that neighbours have nearly equal sizes
and the words taken follow the target closely.

The running sum is a two-level prefix sum: a count per (source, class, hash
range) first, then a rank inside each of those small buckets. The number of
hash ranges follows the number of rows. No window of rows ever spans a source,
so a source with a third of all rows is spread like the rest, and so are rows
that share an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, hash60, landed, without, word_count

# FIXED VALUES: weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
HASH_RANGE_BITS = 5     # 32 hash ranges a (source, class), and twice as many ...
RANGE_ROWS = 20_000     # ... until all rows are this many to a range
OFFSET_HEX = 5          # offsets are multiples of 2**-20


def size_class(size: Column) -> Column:
    """Word count with all but its five leading bits cleared."""
    shift = F.greatest(F.length(F.bin(size)) - F.lit(5), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def source_targets(sizes: DataFrame, key: str, size: str, weights=WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Target per source from one row per source (``key`` in mixing order).

    Sources share the total by weight; a target stops at ``max_repeat`` times
    its source and the excess is shared again by weight until none is above.
    That fixed point is ``min(max_repeat * size, level * weight)`` with one
    common level: ordered by the level at which each source stops, the level
    after k stops follows from prefix sums, and the sources that stop are a
    prefix of that order. Adds ``target``.
    """
    every = Window.orderBy(key)
    r = sizes.withColumn("w", F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int")).cast("long"))
    r = r.withColumn("cap", F.col(size) * F.lit(max_repeat))
    by_stop = Window.orderBy(F.col("cap") / F.col("w"), key)
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    level = ((F.sum(size).over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))).cast("double"))
    r = r.withColumn("level", level)
    # The first source that does not stop fixes the level of all after it.
    r = r.withColumn("level", F.min(
        F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col(key), F.col("level")))
    ).over(whole)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("w"))
    return r.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select(key, size, "target")


def range_bits(rows: int) -> int:
    """Leading bits of the hash that name a range."""
    return min(40, max(HASH_RANGE_BITS, (max(1, rows) // RANGE_ROWS).bit_length()))


def systematic_mix(docs: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id",
                   weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target``,
    ``copies`` (how often the mix takes the document) and ``taken``.

    A null source is a source of its own, last in the order. A null text has
    size 0 and takes 0 words; a source without words has target 0 and its
    documents 0 copies. Repeated rows are sampled one by one. Rows with equal
    ids are told apart by a hash of their text, so reruns agree. Input columns named like an output column are
    replaced. An empty table gives an empty result.
    """
    df = docs.withColumn(n_size := free_name(docs.columns, "mix_size"), word_count(F.col(text)))
    df = df.withColumn(n_tie := free_name(df.columns, "mix_tie"), F.xxhash64(F.col(text)))
    df = df.withColumn(n_src := free_name(df.columns, "mix_source"),
                       F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1")))
    df = df.withColumn(n_hash := free_name(df.columns, "mix_hash"),
                       hash60(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")), F.lit(":"),
                                       F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("")))))
    df = df.withColumn(n_cls := free_name(df.columns, "mix_class"), size_class(F.col(n_size)))
    df = df.withColumn(n_sub := free_name(df.columns, "mix_range"),
                       F.shiftright(F.col(n_hash), 60 - range_bits(docs.count())))
    bucket = [n_src, n_cls, n_sub]

    # Used twice below; landing it spares a second pass over the texts.
    counts = landed(df.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(n_size).alias("words")), "mix-counts")
    totals = counts.groupBy(n_src).agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, n_src, "source_size", weights, max_repeat)
    line = Window.partitionBy(n_src).orderBy(n_cls, n_sub).rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("mix_before", F.coalesce(F.sum("n").over(line), F.lit(0)))
              .join(targets, n_src)
              .select(*[F.col(c).alias(f"b_{c}") for c in bucket], "mix_before",
                      F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")))

    rank = F.row_number().over(Window.partitionBy(*bucket).orderBy(n_hash, id, n_size, n_tie))
    df = df.withColumn(n_rank := free_name(df.columns, "mix_rank"), rank)
    on = [F.col(c) == F.col(f"b_{c}") for c in bucket]
    df = df.join(starts, on).drop(*[f"b_{c}" for c in bucket])

    at = F.col("mix_before") + F.col(n_rank)
    rate = F.coalesce(F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")), F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:offset:"), F.col(n_src)).cast("binary")), 1, OFFSET_HEX),
                    16, 10).cast("double") / F.lit(float(16 ** OFFSET_HEX))
    crossed = F.floor(offset + at * rate) - F.floor(offset + (at - 1) * rate)
    copies = F.least(crossed, F.lit(max_repeat)).cast("long")
    kept = without(docs, "size", "source_size", "target", "copies", "taken").columns
    return df.select(*[F.col(f"`{c}`") for c in kept],
                     F.col(n_size).alias("size"), F.col("mix_source_size").alias("source_size"),
                     F.col("mix_target").alias("target"), copies.alias("copies"),
                     (copies * F.col(n_size)).cast("long").alias("taken"))


def take_mix(mixed: DataFrame, columns) -> DataFrame:
    """The mix itself: each document ``copies`` times, with ``columns`` only."""
    return (mixed.where(F.col("copies") > 0)
            .withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"`{c}`") for c in columns]))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return systematic_mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')), 1, 15))::BIGINT AS h
  FROM documents),
c AS (SELECT *, greatest(length(bin(size)) - 5, 0) AS shift FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY (size >> shift) << shift, h, doc_id, size) AS pos FROM c),
s AS (SELECT src, sum(size)::BIGINT AS source_size,
             [5, 2, 1][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS w
      FROM d GROUP BY src),
p AS (SELECT *, 3 * source_size AS cap,
             (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
             / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS lvl
      FROM s WINDOW before AS (ORDER BY 3 * source_size / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT lvl FROM p WHERE lvl * w <= cap ORDER BY cap / w, src LIMIT 1),
t AS (SELECT src, source_size,
             coalesce(least(cap::DOUBLE, (SELECT lvl FROM l) * w), cap::DOUBLE) AS target,
             ('0x' || substr(md5('mix:offset:' || src), 1, 5))::BIGINT::DOUBLE / 1048576.0::DOUBLE AS u
      FROM p),
x AS (SELECT doc_id, size, source_size, target, pos, u,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
      FROM r JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       (least(floor(u + pos * rate) - floor(u + (pos - 1) * rate), 3)::BIGINT * size)::BIGINT AS taken
FROM x
"""
