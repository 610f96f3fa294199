"""Incremental, idempotent loads with Structured Streaming.

Event data is reloaded game by game: the rows of the loaded games are
replaced (SNK-03). Landed files are a streaming source and the table is
partitioned by season and by a bucket of the key, so a micro-batch rewrites
only the buckets of the games it carries, not their whole seasons.

A batch is applied in two steps (``store.change_partitions``). Its new bucket
contents are staged under the batch's number, closed by a marker; then they
replace the touched partitions, which are the only ones read. A replay of the
batch finds the staged contents and publishes them again without reading the
table, so a failure between or during the steps neither loses stored rows nor
doubles new ones.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from seamstat.operators.store import BUCKETS, change_partitions, with_bucket
from seamstat.operators.tables import replace_keys
from seamstat.session import ensure_checkpoint_dir


def apply_batch(batch: DataFrame, table_path: str, key: Sequence[str], partition_col: str = "season",
                row_key: Sequence[str] | None = None, staging: str | None = None,
                batch_id: int = 0, buckets: int = BUCKETS) -> None:
    """Replace the keys of ``batch`` inside the partitions it touches.

    The partition column must be a function of the key (a game belongs to
    one season), so every stored row of a replaced key is in a touched
    partition. With ``row_key`` a row delivered twice in a batch is stored
    once.
    """
    spark = batch.sparkSession
    staging = staging or os.path.join(ensure_checkpoint_dir(spark), "staged",
                                      os.path.basename(table_path.rstrip("/")))
    if row_key:
        batch = batch.dropDuplicates(list(row_key))

    def contents(current, new):
        return new if current is None else replace_keys(current.select(*new.columns), new, key)

    change_partitions(spark, table_path, with_bucket(batch, key, buckets), [partition_col, "bucket"], contents,
                      staging, str(batch_id))


def start_reload(spark: SparkSession, source_path: str, schema: StructType, table_path: str,
                 key: Sequence[str], partition_col: str = "season",
                 checkpoint_location: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None, row_key: Sequence[str] | None = None):
    """Start the incremental load; returns the StreamingQuery."""
    ckpt = checkpoint_location or os.path.join(ensure_checkpoint_dir(spark), "streams",
                                               os.path.basename(table_path.rstrip("/")))
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(source_path)
    w = (src.writeStream.foreachBatch(lambda df, n: apply_batch(
            df, table_path, key, partition_col, row_key, f"{ckpt}-staged", n))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
