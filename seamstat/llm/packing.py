"""Packing documents into token sequences by hierarchical best fit.

``tokenise`` turns every text into pieces of at most ``capacity`` token ids.
``pack`` places the pieces: they are dealt at random into groups of a bounded
number of items, each group is packed best-fit decreasing on its own, nearly
full bins are final, and the underfull bins go on as items of the next round
with fewer groups, until one group is left or a round no longer helps. A
group never holds more than about ``items_per_group`` rows of a few numbers,
whatever the table's size, and each round is landed in the shared folder.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import for_workers, free_name, landed, read_table, without

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
ITEMS_PER_GROUP = 16_384
SLACK = 2               # a bin with at most this much room left is final
FAN_IN = 8              # groups merged into one from round to round

# FIXED VALUE: the split pattern of this vocabulary's byte-level pre-tokenizer.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The split pattern steps back over white space and gives up at a million
# characters of it, so a long run is cut out before the pattern sees it.
LONG_RUN = 100_000
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=2)
def load_encoding(tokenizer: str):
    """The byte-level BPE of a tokenizer file, as a tiktoken encoding.

    The file's merges are in order of their ids, which is what a rank table
    states, so both libraries give the same ids; the file is refused if that
    does not hold. ``encode`` gives the file's added tokens their ids.
    """
    import json

    import tiktoken

    path = tokenizer
    if "/" not in tokenizer:
        import public_tokenizers
        path = public_tokenizers.path(tokenizer)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    if any(t.get(k) for t in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{tokenizer}: added tokens that depend on the text around them")
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    for i, m in enumerate(merges):
        if vocab["".join(m.split(" ") if isinstance(m, str) else m)] != 256 + i:
            raise ValueError(f"{tokenizer}: merges and ids are in different orders")
    if spec.get("normalizer") or spec["pre_tokenizer"].get("type") != "ByteLevel":
        raise ValueError(f"{tokenizer}: not a plain byte-level BPE")
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding(tokenizer, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode(enc, text: str) -> list[int]:
    """Ids of a text as the tokenizer file gives them: its added tokens first
    (the longest where two begin), then the text between them."""
    added = sorted(enc.special_tokens_set, key=len, reverse=True)
    if not any(a in text for a in added):
        return encode_between(enc, text)
    ids = []
    for i, part in enumerate(re.split("(" + "|".join(map(re.escape, added)) + ")", text)):
        ids += [enc.encode_single_token(part)] if i % 2 else encode_between(enc, part)
    return ids


def encode_between(enc, text: str) -> list[int]:
    """Ids of a text of any length without added tokens. The split pattern
    takes a run of white space up to its last character as one piece (at the
    end of the text the whole run), so such a piece may be encoded alone."""
    ids, at = [], 0
    if len(text) >= LONG_RUN:
        for run in re.finditer(f"[{SPACES}]{{{LONG_RUN},}}", text):
            end = run.end() - (run.end() < len(text))
            ids += enc.encode_ordinary(text[at:run.start()])
            ids += enc._encode_single_piece(text[run.start():end])
            at = end
    return ids + enc.encode_ordinary(text[at:])


PIECE_FIELDS = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]


def piece_spans(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all but the first are full."""
    first = n - (math.ceil(n / capacity) - 1) * capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenise(docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
             end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length`` and ``ids``
    (little-endian unsigned 32-bit). A null or empty text is one piece that
    holds ``end_id`` alone. Only texts of over ``capacity`` ids are cut; the
    first piece takes the remainder. Other input columns are not read."""
    for_workers(docs.sparkSession)
    keyed = docs.select(F.col(f"`{id}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType([T.StructField("key", keyed.schema["key"].dataType), *PIECE_FIELDS])

    def pieces(batches):
        import numpy as np
        import pyarrow as pa

        enc = load_encoding(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, piece, start, length, ids = [], [], [], [], []
                for row, t in enumerate(part.column(1).to_pylist()):
                    own = encode(enc, t) if t else []
                    own.append(end_id)
                    raw = np.array(own, dtype="<u4").tobytes()
                    for k, (s, n) in enumerate(piece_spans(len(own), capacity)):
                        rows.append(row)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        ids.append(raw[4 * s:4 * (s + n)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["key", "piece", "start", "length", "ids"])

    return keyed.mapInArrow(pieces, schema).withColumnRenamed("key", id)


def best_fit(lengths, capacity: int):
    """Best-fit decreasing. Returns the bin's first item, the offset in the
    bin and the bin's fill for each item (equal lengths keep their order).
    Bit ``r`` of ``rooms`` is set if some bin has room ``r`` left, so the
    tightest bin that fits is the lowest set bit from the length upward."""
    import numpy as np

    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    first = [0] * len(sizes)
    offset = [0] * len(sizes)
    fill: dict[int, int] = {}
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in order:
        n = sizes[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            bins = with_room[room]
            b = bins.pop()
            if not bins:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, i
        first[i], offset[i] = b, capacity - room
        left = room - n
        fill[b] = capacity - left
        if left:
            with_room[left].append(b)
            rooms |= 1 << left
    return np.array(first, dtype=np.int64), np.array(offset, dtype=np.int64), \
        np.array([fill[b] for b in first], dtype=np.int64)


def _round(items: DataFrame, uid: str, length: str, groups: int, salt: int, capacity: int) -> DataFrame:
    """Pack the items of each of ``groups`` random groups; adds ``bin`` (the
    ``uid`` of the bin's first item), ``bin_offset`` and ``bin_fill``."""
    schema = T.StructType([*items.schema.fields, T.StructField("bin", T.LongType()),
                           T.StructField("bin_offset", T.LongType()), T.StructField("bin_fill", T.LongType())])

    columns = items.columns

    def fit(table):
        import numpy as np
        import pyarrow as pa

        table = table.select(columns).sort_by(uid)
        uids = table.column(uid).to_numpy()
        first, offset, fill = best_fit(table.column(length).to_numpy().astype(np.int64), capacity)
        return (table.append_column("bin", pa.array(uids[first], pa.int64()))
                .append_column("bin_offset", pa.array(offset, pa.int64()))
                .append_column("bin_fill", pa.array(fill, pa.int64())))

    group = F.pmod(F.xxhash64(F.col(uid), F.lit(salt)), F.lit(groups)).alias("pack_group")
    return items.groupBy(group).applyInArrow(fit, schema)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY,
         items_per_group: int = ITEMS_PER_GROUP, slack: int = SLACK) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Every row is placed on its own, so repeated rows are packed repeatedly. A
    sequence is gapless from 0 and holds at most ``capacity``. Lengths must
    be 1 to ``capacity``; rows with a null or other length cannot be placed
    and raise an error. Input columns named like an output column are
    replaced. An empty table gives an empty result.
    """
    for_workers(pieces.sparkSession)
    own = without(pieces, "sequence_id", "offset")
    uid = free_name(own.columns, "pack_uid")
    ok = F.col(length).between(1, capacity)
    checked = own.withColumn(length, F.when(F.coalesce(ok, F.lit(False)), F.col(length).cast("long")).otherwise(
        F.raise_error(F.lit(f"a length is null or outside 1 to {capacity}")).cast("long")))
    base = landed(checked.withColumn(uid, F.monotonically_increasing_id()), "pieces")
    whole = base.where(F.col(length) == capacity)
    items = base.where(F.col(length) < capacity)

    groups = max(1, math.ceil(items.count() / items_per_group))
    placed = landed(_round(items, uid, length, groups, 0, capacity), "packed")

    def underfull(r: DataFrame) -> DataFrame:
        return r.where((F.col("bin_offset") == 0) & (F.col("bin_fill") < capacity - slack)).select(
            F.col("bin").alias("child"), F.col("bin_fill").alias("fill"))

    moves, r = None, 1
    left = underfull(placed)
    n = left.count()
    while groups > 1 and n > 1:
        groups = max(math.ceil(n / items_per_group), min(groups, math.ceil(groups / FAN_IN)))
        step = landed(_round(left, "child", "fill", groups, r, capacity), "merged")
        step_to = step.select("child", F.col("bin").alias("parent"), F.col("bin_offset").alias("shift"))
        if moves is None:
            moves = step_to
        else:
            nxt = step_to.select(F.col("child").alias("c2"), F.col("parent").alias("p2"), F.col("shift").alias("s2"))
            moves = (moves.join(nxt, F.col("parent") == F.col("c2"), "left")
                     .select("child", F.coalesce("p2", "parent").alias("parent"),
                             (F.col("shift") + F.coalesce("s2", F.lit(0))).alias("shift")))
        left = underfull(step)
        n, before = left.count(), n
        if groups > 1 and n > 0.98 * before:
            break
        r += 1
    if moves is None:
        done = placed.select(*own.columns, F.col("bin").alias("sequence_id"), F.col("bin_offset").alias("offset"))
    else:
        done = (placed.join(moves, F.col("bin") == F.col("child"), "left")
                .select(*[F.col(f"`{c}`") for c in own.columns],
                        F.coalesce("parent", "bin").alias("sequence_id"),
                        (F.col("bin_offset") + F.coalesce("shift", F.lit(0))).alias("offset")))
    return done.unionByName(whole.select(*own.columns, F.col(uid).alias("sequence_id"),
                                         F.lit(0).cast("long").alias("offset")))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``length`` and ``ids``
    (the pieces' ids by offset; a sequence holds at most ``capacity``)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def digest_pieces(docs: DataFrame) -> DataFrame:
    return tokenise(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack(digest_pieces(read_table(spark, sf_dir, "documents")))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
