"""Bytes of text columns as numpy arrays, and bounded labelled samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name


def text_bytes(column):
    """(bytes, offsets) of an Arrow string column: text ``i`` is
    ``bytes[offsets[i]:offsets[i + 1]]``; a null text is empty."""
    import numpy as np
    import pyarrow as pa

    col = column.cast(pa.binary())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def windows(offsets, width: int, step: int):
    """Windows of ``width`` bytes that cover every text, ``step`` apart; the
    last one of a text ends with it. Returns (text, start, fresh): ``fresh``
    is how many bytes at a window's end no earlier window of the text has
    when ``step`` is ``width``. Texts shorter than ``width`` have one window
    that starts before the text; empty texts have none."""
    import numpy as np

    sizes = np.diff(offsets)
    counts = np.where(sizes == 0, 0, 1 + np.maximum(0, -(-(sizes - width) // step)))
    text = np.repeat(np.arange(len(sizes)), counts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = k == counts[text] - 1
    end = np.where(last, sizes[text], k * step + width)
    before = np.where(k == 0, 0, (k - 1) * step + width)
    return text, offsets[text] + end - width, end - before


def stratified_rows(df: DataFrame, label: str, key: Column, per_label: int,
                    max_rows: int | None = None) -> DataFrame | None:
    """About ``per_label`` rows of every label, one at least, chosen by a hash
    of ``key``, with the hash as ``point``; at most ``2 * per_label`` rows a
    label. None without a labelled row. With more labels than ``max_rows``
    allows at ``per_label`` rows each, every label has fewer rows.

    Rows with a null label are not drawn. The counts cover all rows.
    """
    point = F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(1 << 30))
    counts = (df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label"))
              .agg(F.count(F.lit(1)).alias("n"), F.min(point).alias("least")).collect())
    if not counts:
        return None
    if max_rows is not None:
        per_label = max(1, min(per_label, max_rows // len(counts)))
    cuts = [(r["label"], max(r["least"] + 1, min(1 << 30, int((1 << 30) * per_label / r["n"]) + 1))) for r in counts]
    name, cut, place = (free_name(df.columns, c) for c in ("cut_label", "cut_point", "cut_place"))
    schema = T.StructType([T.StructField(name, df.schema[label].dataType), T.StructField(cut, T.LongType())])
    cuts = F.broadcast(df.sparkSession.createDataFrame(cuts, schema))
    drawn = df.withColumn("point", point).join(cuts, (F.col(label) == F.col(name)) & (F.col("point") < F.col(cut)))
    first = Window.partitionBy(label).orderBy("point")
    return (drawn.withColumn(place, F.row_number().over(first)).where(F.col(place) <= 2 * per_label)
            .drop(name, cut, place).orderBy("point", label))


def stratified_sample(df: DataFrame, label: str, columns: list[Column], key: Column, per_label: int,
                      max_labels: int) -> list:
    """The same as a list on the driver: ``label``, ``point`` and ``columns``;
    every label is drawn, and about ``per_label * max_labels`` rows in all."""
    rows = stratified_rows(df.select(F.col(label).alias("label"), *columns, key.alias("k")), "label", F.col("k"),
                           per_label, per_label * max_labels)
    return [] if rows is None else rows.collect()


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str,
                  part: Callable[[Column, Column], Column], train_if: Column,
                  per_label: int) -> tuple[DataFrame | None, dict[int, int]]:
    """((point, l_label, part) of a bounded sample, label counts of all
    training rows) for labels 0 and 1; ``part`` takes the text and the id, and
    a null part is left out. No rows come with None.

    An id that the labels state with both values is not learned from. The ids
    are drawn from the labels alone; at most ``4 * per_label`` of them are
    broadcast to fetch their texts. An id with several rows is learned from
    once, by the row with the smallest hash of its text, so the sample is
    bounded whatever the ids are.
    """
    one = (labels.where(F.col(label).isin(0, 1) & train_if & F.col(f"`{id}`").isNotNull())
           .groupBy(F.col(f"`{id}`").alias("l_id")).agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
           .where("lo = hi").select("l_id", F.col("lo").cast("int").alias("l_label")))
    drawn = stratified_rows(one, "l_label", F.col("l_id"), per_label)
    if drawn is None:
        return None, {}
    counts = {r["l_label"]: r["count"] for r in one.groupBy("l_label").count().collect()}
    own = docs.select(F.col(f"`{id}`").alias("d_id"), F.col(f"`{text}`").alias("d_text"))
    rows = (own.join(F.broadcast(drawn.select("l_id", "l_label", "point")), F.col("d_id") == F.col("l_id"))
            .where("d_text IS NOT NULL").withColumn("d_hash", F.xxhash64("d_text")))
    # The text is cut first: what the aggregate carries is bounded a row.
    cut = rows.select("l_id", "l_label", "point", "d_hash", part(F.col("d_text"), F.col("d_id")).alias("part")).where("part IS NOT NULL")
    return (cut.groupBy("l_id").agg(F.min_by(F.struct("point", "l_label", "part"), F.struct("d_hash", "part")).alias("r"))
            .select("r.point", "r.l_label", "r.part")), counts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id: str, text: str,
                    part: Callable[[Column, Column], Column], train_if: Column, per_label: int) -> tuple[list[tuple[int, str]], dict[int, int]]:
    """``labelled_rows`` as a list of (label, text part) on the driver."""
    rows, counts = labelled_rows(docs, labels, label, id, text, part, train_if, per_label)
    found = [] if rows is None else sorted((r["point"], r["l_label"], r["part"]) for r in rows.collect())
    return [(y, t) for _, y, t in found], counts
