"""Shard placement by a permutation-filled lookup table (native).

Every shard has a preference order over the slots of a prime-sized table
(``(offset + i * skip) mod slots``). Shards take turns; each turn claims the
shard's next preferred slot that is still free, until the table is full. Every
shard owns almost the same number of slots, and removing a shard moves few
other slots. A row's slot is a hash of its key; the table is broadcast, so a
placement is one constant-time lookup and no row is shuffled.

The table depends on the list of shards only, never on the data: ``slots``
rows of two integers is the proven bound of the broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, hash60, without

SLOTS = 4099            # prime, over 100 slots a shard at 32 shards
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
MAX_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The filled table: columns ``slot`` and ``shard``, one row per slot.

    The two hashes of a shard's preference order are computed by Spark; the
    turns themselves are a loop over the configuration (``slots`` steps).
    """
    if not _is_prime(slots) or not len(set(shards)) == len(shards) or not 0 < len(shards) <= slots <= MAX_SLOTS:
        raise ValueError("slots must be a prime of at least the number of distinct shards, "
                         f"at most {MAX_SLOTS}")
    name = F.explode(F.array(*[F.lit(s) for s in shards])).alias("shard")
    prefs = (spark.range(1).select(name)
             .select("shard", (hash60(F.concat(F.col("shard"), F.lit(":offset"))) % slots).alias("offset"),
                     (hash60(F.concat(F.col("shard"), F.lit(":skip"))) % (slots - 1) + 1).alias("skip")))
    by_name = {r["shard"]: (r["offset"], r["skip"]) for r in prefs.toLocalIterator()}
    owner: list[int] = [-1] * slots
    at = [by_name[s][0] for s in shards]
    step = [by_name[s][1] for s in shards]
    for turn in range(slots):
        k = turn % len(shards)
        while owner[at[k]] >= 0:
            at[k] = (at[k] + step[k]) % slots
        owner[at[k]] = k
    owners = F.array(*[F.lit(k) for k in owner])
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "k"))
            .select(F.col("slot").cast("long").alias("slot"),
                    F.element_at(F.array(*[F.lit(s) for s in shards]), F.col("k") + 1).alias("shard")))


def place(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``.

    A null key is placed like an empty one, so every row gets a shard. Equal
    keys get equal shards. Input columns named ``slot`` or ``shard`` are
    replaced (the key itself may be one of them). An empty table gives an
    empty result.
    """
    n_slot = free_name([*df.columns, "slot", "shard"], "place_slot")
    keyed = df.withColumn(n_slot, hash60(F.coalesce(F.col(key).cast("string"), F.lit(""))) % slots)
    kept = without(df, "slot", "shard").columns
    table = lookup_table(df.sparkSession, shards, slots).select(
        F.col("slot").alias("b_slot"), F.col("shard").alias("b_shard"))
    return (keyed.select(*[F.col(f"`{c}`") for c in kept], n_slot)
            .join(F.broadcast(table), F.col(n_slot) == F.col("b_slot"))
            .select(*[F.col(f"`{c}`") for c in kept], F.col("b_slot").alias("slot"), F.col("b_shard").alias("shard")))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS, files_per_shard: int = 4) -> None:
    """Write ``df`` partitioned by shard, each shard in ``files_per_shard``
    files (rows of a shard are dealt by slot, so no task holds a shard)."""
    placed = place(df, key, shards, slots)
    salt = (F.col("slot") % files_per_shard).alias("salt")
    (placed.repartition(len(shards) * files_per_shard, "shard", salt)
     .write.mode("error").partitionBy("shard").parquet(path))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs).select("doc_id", "slot", "shard")


ORACLE = f"""
WITH RECURSIVE p AS (
  SELECT i AS k, printf('shard-%02d', i) AS shard,
         ('0x' || substr(md5(printf('shard-%02d', i) || ':offset'), 1, 15))::BIGINT % {SLOTS} AS o,
         ('0x' || substr(md5(printf('shard-%02d', i) || ':skip'), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS s
  FROM range({len(SHARDS)}) t(i)),
pref AS (SELECT list(o ORDER BY k) AS os, list(s ORDER BY k) AS ss FROM p),
fill(turn, taken, slot) AS (
  SELECT 0::BIGINT, [(SELECT os[1] FROM pref)], (SELECT os[1] FROM pref)
  UNION ALL
  SELECT turn + 1, list_append(taken, nxt), nxt FROM (
    SELECT turn, taken, list_extract(list_filter(
             list_transform(range({SLOTS}), lambda i: (os[(turn + 1) % {len(SHARDS)} + 1] + i * ss[(turn + 1) % {len(SHARDS)} + 1]) % {SLOTS}),
             lambda x: NOT list_contains(taken, x)), 1) AS nxt
    FROM fill, pref WHERE turn + 1 < {SLOTS})),
owner AS (SELECT slot, turn % {len(SHARDS)} AS k FROM fill)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
JOIN owner USING (slot) JOIN p USING (k)
"""
