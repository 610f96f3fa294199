"""Phrases whose words occur together more often than their parts suggest.

The words of every piece of text are numbered, and each word's place is a
suffix pointer. A multikey three-way quicksort orders the pointers by
language, first word, second word, ... to the maximum depth; the size of an
equal partition is the count of its phrase. A map task sorts the pointers of
a block of text and sends each phrase with its count in the block, routed by
all of the phrase's leading words, so that no frequent word or phrase makes a
large bucket. A bucket is sorted the same way over the blocks' phrases, and
partitions that cannot reach the least count are abandoned on the way.

Scores then come from joins of the frequent phrases with their own parts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import for_workers, landed, read_table

WORDS = 3
LEAST = 10              # occurrences of a candidate
INSIDE_PERCENT = 50     # a longer phrase with this share of its part replaces it
REPORTED = 2000
UNDETERMINED = "und"
BLOCK_BYTES = 6 << 20   # text sorted at a time by a map task
BUCKET_BYTES = 8 << 20  # text whose phrases make up a bucket
SALTS = 8               # of a part that many candidates share

# FIXED VALUES: the characters that end a piece of text.
BREAKS = ".,;:!?\n\x0b\x0c\r"

PAYLOAD = "bucket int, phrases binary"


def equal_partitions(keys, weights=None, least: int = 1):
    """(row, depth, weight) of every equal partition of a multikey three-way
    quicksort of rows by the columns of ``keys`` (integers; negative: the row
    ends there). The row is one of the partition's, whose first ``depth`` keys
    name it. Partitions of less weight than ``least`` are abandoned, with all
    that is in them.

    All open partitions of a depth are split in the same step: rows below and
    above the partition's pivot go to two new ones, those equal to it to the
    next depth. So a step costs a few passes over the open rows, and an
    infrequent partition leaves them at once.
    """
    import numpy as np

    limit, n = keys.shape
    w = np.ones(n, np.int64) if weights is None else weights
    rows = np.arange(n if n and w.sum() >= least else 0, dtype=np.int32)
    sizes = np.array([n], np.int32)
    found = []

    def emit(row, depth, weight):
        if len(row):
            found.append((row, np.full(len(row), depth, np.int32), weight))

    def alone(row, depth):
        """A partition of one row needs no splitting: its prefixes follow."""
        for d in range(depth, limit):
            row = row[keys[d, row] >= 0]
            emit(row, d + 1, w[row])

    for d in range(limit):
        key, deeper = keys[d][rows], []
        while len(rows):
            one = sizes == 1
            if one.any():
                own = np.repeat(one, sizes)
                alone(rows[own], d)
                rows, key, sizes = rows[~own], key[~own], sizes[~one]
                if not len(rows):
                    break
            starts = np.cumsum(sizes) - sizes
            middle = starts + sizes // 2
            pivot = key[middle]
            own = np.repeat(pivot, sizes)
            below, equal = key < own, key == own
            n_below, n_equal = (np.add.reduceat(m, starts, dtype=np.int32) for m in (below, equal))
            n_above = sizes - n_below - n_equal
            heavy = n_below, n_equal, n_above
            if weights is not None:
                weight = w[rows]
                heavy = [np.add.reduceat(weight * m, starts) for m in (below, equal)]
                heavy.append(np.add.reduceat(weight, starts) - heavy[0] - heavy[1])
            named = (pivot >= 0) & (heavy[1] >= least)
            emit(rows[middle[named]], d + 1, heavy[1][named].astype(np.int64))
            if d + 1 < limit and named.any():
                deeper.append((rows[equal & np.repeat(named, sizes)], n_equal[named]))
            parts = []
            for m, count, heavier in ((below, n_below, heavy[0]), (~(below | equal), n_above, heavy[2])):
                keep = (count > 0) & (heavier >= least)
                m = m if (keep | (count == 0)).all() else m & np.repeat(keep, sizes)
                parts.append((rows[m], key[m], count[keep]))
            rows, key, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        rows, sizes = (np.concatenate([np.zeros(0, np.int32), *x]) for x in zip(*deeper, strict=True)) if deeper else \
            (rows[:0], sizes[:0])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def may_be_frequent(keys, counts, least: int):
    """Rows whose every key has ``least`` occurrences in all: no other can be in
    an equal partition of that size. Each pass may rule out more."""
    import numpy as np

    left = np.arange(keys.shape[1])
    while len(left):
        ok = np.ones(len(left), bool)
        for k in keys:
            own = k[left]
            ok &= np.bincount(own, weights=counts[left])[own] >= least
        if ok.sum() > 0.9 * len(left):
            return left[ok]
        left = left[ok]
    return left


def _tables():
    """Byte tables: lower-cased with every separator as a space, whether a
    byte separates words, and whether it ends a piece."""
    import numpy as np

    breaks = BREAKS.encode()
    lower = bytes(32 if c in breaks or c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
    gap = np.zeros(256, bool)
    gap[list(breaks + b"\t ")] = True
    end = np.zeros(256, bool)
    end[list(breaks)] = True
    return lower, gap, end


def suffix_keys(texts: list[bytes], langs: list[bytes], depth: int):
    """(names, keys): the distinct words of a block of texts, then the
    languages, as an Arrow array; and for every word in the block its suffix
    as places in ``names``: language, word, next word, ... up to ``depth``
    words, and -1 from the end of the word's piece on."""
    import numpy as np
    import pyarrow as pa

    lower, gap, end = _tables()
    raw = b"\n".join(texts)
    at = np.frombuffer(raw, np.uint8)
    gaps = gap[at]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gaps, [True]]).astype(np.int8)))
    start, size = edge[::2], edge[1::2] - edge[::2]
    piece = np.cumsum(end[at], dtype=np.int32)[start]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    letters = np.frombuffer(raw.translate(lower), np.uint8)[~gaps]
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    word, names = coded.indices.to_numpy(), coded.dictionary
    tags = {x: len(names) + i for i, x in enumerate(dict.fromkeys(langs))}
    text_end = np.cumsum([len(t) + 1 for t in texts])
    tag = np.array([tags[x] for x in langs], np.int32)
    keys = np.full((depth + 1, len(word)), -1, np.int32)
    if len(word):
        keys[0] = tag[np.searchsorted(text_end, start, side="right")]
    for d in range(min(depth, len(word))):
        keys[d + 1, :len(word) - d] = np.where(piece[d:] == piece[:len(piece) - d], word[d:], -1)
    # A language is a name that no word can be.
    return pa.concat_arrays([names, pa.array([b"\n" + x for x in tags], pa.binary())]), keys


def _mixed(h):
    import numpy as np

    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _places(own, size: int):
    """(distinct values, each value's place among them) of integers below ``size``."""
    import numpy as np

    if len(own) * 8 < size:
        return np.unique(own, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[own] = True
    used = np.flatnonzero(seen)
    place = np.zeros(size, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    return used, place[own]


def _small(values):
    """The same integers in the narrowest unsigned type that holds them."""
    import numpy as np

    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _pack(names, groups) -> bytes:
    """Names (an Arrow array) and, by number of keys, (columns of places in
    the names, counts), compressed."""
    import pickle

    import numpy as np
    import pyarrow as pa

    _, offsets, raw = names.buffers()
    at = np.frombuffer(offsets, np.int32)[names.offset:names.offset + len(names) + 1]
    raw = raw.to_pybytes()[at[0]:at[-1]] if raw is not None else b""
    data = (_small(np.diff(at)), raw, [([_small(c) for c in keys], _small(n)) for keys, n in groups])
    return pa.Codec("zstd", compression_level=1).compress(pickle.dumps(data, protocol=5), asbytes=True)


def _unpack(packed: bytes):
    """What ``_pack`` was given; names as an Arrow array."""
    import pickle

    import numpy as np
    import pyarrow as pa
    import zstandard

    sizes, raw, groups = pickle.loads(zstandard.ZstdDecompressor().decompress(packed))
    offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]), groups


def _routed(names, keys, row, depth, weight, buckets: int):
    """Rows, one a bucket, of counted phrases. The bucket follows from all of
    a phrase's keys, by their bytes. Phrases lie ordered by number of keys and
    first word, which compresses well."""
    import zlib

    import numpy as np
    import pyarrow as pa

    code = np.array([zlib.crc32(x) | zlib.crc32(x, 1) << 32 for x in names.to_pylist()], np.uint64)
    h = depth.astype(np.uint64)
    for d in range(keys.shape[0]):
        own = depth > d
        h[own] = _mixed(h[own] * np.uint64(0x9E3779B97F4A7C15) + code[keys[d, row[own]]])
    bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    kinds = keys.shape[0] + 1
    first = keys[min(1, kinds - 2), row]
    order = np.argsort((bucket * kinds + depth) * (len(names) + 1) + first, kind="stable")
    bucket, row, depth, weight = bucket[order], row[order], depth[order], weight[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, int)
    packed = []
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        ends = s + np.cumsum(np.bincount(depth[s:e], minlength=kinds))
        spans = [(d, ends[d - 1], ends[d]) for d in range(1, kinds)]
        own = np.concatenate([keys[:d, row[x:y]].ravel() for d, x, y in spans])
        used, place = _places(own, len(names))
        groups, at = [], 0
        for d, x, y in spans:
            n = int(y - x)
            groups.append((place[at:at + d * n].reshape(d, n), weight[x:y]))
            at += d * n
        packed.append(_pack(names.take(pa.array(used)), groups))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts[:-1]] if len(bucket) else [], pa.int32()), pa.array(packed, pa.binary())],
        ["bucket", "phrases"])


def block_phrases(docs: DataFrame, buckets: int, depth: int) -> DataFrame:
    """Counts of all phrases of up to ``depth`` words within blocks of about
    ``BLOCK_BYTES``, packed a row per bucket. Texts come as (lang, text)."""
    def blocks(batches):
        def flush(texts, langs):
            names, keys = suffix_keys(texts, langs, depth)
            return _routed(names, keys, *equal_partitions(keys), buckets)

        texts, langs, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for lang, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t:
                        texts.append(t)
                        langs.append(lang)
                        size += len(t)
                    if size >= BLOCK_BYTES:
                        yield flush(texts, langs)
                        texts, langs, size = [], [], 0
        if texts:
            yield flush(texts, langs)

    return docs.select(F.col("lang").cast("binary"), F.col("text").cast("binary")).mapInArrow(blocks, PAYLOAD)


COUNTS = "lang string, words int, phrase string, f long"


def frequent_phrases(blocks: DataFrame, buckets: int, depth: int, least: int) -> DataFrame:
    """(lang, words, phrase, f) of the phrases with ``least`` occurrences at
    least, and a row with 0 words that counts all words of the language."""
    def merge(table):
        import numpy as np
        import pyarrow as pa

        parts = [_unpack(x) for x in table.column("phrases").to_pylist()]
        coded = pa.concat_arrays([n for n, _ in parts]).dictionary_encode()
        number, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        grouped: list[list] = [[] for _ in range(depth + 2)]
        at = 0
        for own, groups in parts:
            for d, (keys, counts) in enumerate(groups, 1):
                if len(counts):
                    grouped[d].append((np.stack([number[at + k.astype(np.int64)] for k in keys]), counts.astype(np.int64)))
            at += len(own)
        lang, words, phrase, f = [], [], [], []
        for d in range(1, depth + 2):
            if not grouped[d]:
                continue
            keys = np.concatenate([k for k, _ in grouped[d]], axis=1)
            counts, own_least = np.concatenate([c for _, c in grouped[d]]), least if d > 1 else 1
            left = may_be_frequent(keys, counts, own_least)
            keys, counts = keys[:, left], counts[left]
            row, at, weight = equal_partitions(keys, counts, own_least)
            whole = at == d
            for i, n in zip(keys[:, row[whole]].T.tolist(), weight[whole].tolist(), strict=True):
                lang.append(names[i[0]][1:])
                words.append(d - 1)
                phrase.append(b" ".join(names[j] for j in i[1:]))
                f.append(n)
        return pa.table([pa.array(lang, pa.binary()).cast(pa.string()), pa.array(words, pa.int32()),
                         pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(f, pa.int64())],
                        names=["lang", "words", "phrase", "f"])

    return blocks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(merge, COUNTS)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = WORDS,
                  least: int = LEAST) -> DataFrame:
    """Frequent phrases of 1 to ``depth`` words by language, as
    ``frequent_phrases`` returns them."""
    for_workers(docs.sparkSession)
    t = F.col(f"`{text}`")
    own = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNDETERMINED)).alias("lang"), t.alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    return frequent_phrases(block_phrases(own, buckets, depth), buckets, depth, least)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in 38-digit integers."""
    wide = [x.cast("decimal(18,0)") for x in (a, a, left, right)]
    return F.call_function("div", wide[0] * wide[1] * F.lit(1_000_000).cast("decimal(7,0)"), wide[2] * wide[3])


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", depth: int = WORDS, least: int = LEAST,
                 reported: int = REPORTED, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first
    ``reported`` phrases of 2 to ``depth`` words.

    A null language is ``und`` (with documents that say so); a null or empty
    text has no words. Texts are read whole. Repeated rows count repeatedly.
    Other input columns are not read. Equal scores are ordered by falling a,
    then by the phrase's bytes. An empty table gives an empty result.
    """
    counts = landed(phrase_counts(docs, text, lang, depth, least), "phrases")
    total = counts.where("words = 0").select(F.col("lang").alias("t_lang"), F.col("f").alias("n"))
    candidates = counts.where("words > 1")

    # Phrases in a longer one that has a large share of their occurrences.
    word = F.split("phrase", " ", -1)
    spans = [(k, i) for k in range(2, depth) for i in range(1, depth - k + 2)]
    covered = None
    if spans:
        inner = F.array(*[F.when((F.col("words") > k) & (F.col("words") >= i + k - 1),
                                 F.array_join(F.slice(word, i, k), " ")) for k, i in spans])
        covered = (counts.where("words > 2").select(F.col("lang").alias("c_lang"), "f", F.explode(inner).alias("c_phrase"))
                   .where("c_phrase IS NOT NULL").groupBy("c_lang", "c_phrase").agg(F.max("f").alias("most")))
        candidates = (candidates.join(covered, (F.col("lang") == F.col("c_lang")) & (F.col("phrase") == F.col("c_phrase")), "left")
                      .where(F.col("most").isNull() | (100 * F.col("most") < inside_percent * F.col("f"))))

    # Every cut, with the counts of both parts; a part's row is there once a salt.
    cuts = (candidates.select("lang", "words", "phrase", F.col("f").alias("a"),
                              F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
            .select("lang", "phrase", "a", "cut", F.array_join(F.slice(word, F.lit(1), F.col("cut")), " ").alias("left"),
                    F.array_join(F.slice(word, F.col("cut") + 1, F.col("words") - F.col("cut")), " ").alias("right"),
                    F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")))
    parts = counts.where(F.col("words").between(1, depth - 1)).select(
        F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("f").alias("count"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("p_salt"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts, (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("part"))
                         & (F.col("salt") == F.col("p_salt"))).withColumn(name, F.col("count")).drop(*parts.columns)
    best = (cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r"))).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
            .select("lang", "phrase", "a", "low.l", "low.r", "low.score"))

    scored = landed(best, "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within groups of a hash, so that no window holds a language's candidates.
    groups = max(1, math.isqrt(scored.count() // reported))
    salt = F.pmod(F.xxhash64("phrase", F.lit("rank")), F.lit(groups))
    place = F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    some = scored.withColumn("group", salt).withColumn("place", place).where(F.col("place") <= reported)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (some.withColumn("rank", rank).where(F.col("rank") <= reported).join(total, F.col("lang") == F.col("t_lang"))
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (
  SELECT row_number() OVER () AS id, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
  FROM w, (VALUES (1), (2), (3)) AS s(k)),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM g GROUP BY lang, k, array_to_string(g, ' ')),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= 10),
cover AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, array_to_string(g[1:2], ' ') AS phrase, f FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(g[2:3], ' '), f FROM c WHERE k = 3)
  GROUP BY lang, phrase),
kept AS (
  SELECT c.* FROM c LEFT JOIN cover ON c.k = 2 AND c.lang = cover.lang AND c.phrase = cover.phrase
  WHERE cover.most IS NULL OR 100 * cover.most < 50 * c.f),
cut AS (
  SELECT lang, phrase, f AS a, i, array_to_string(g[1:i], ' ') AS x, array_to_string(g[i + 1:], ' ') AS y
  FROM kept, (VALUES (1), (2)) AS s(i) WHERE i < k),
scored AS (
  SELECT cut.lang, cut.phrase, a, i, fx.f AS l, fy.f AS r,
         ((1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f))::BIGINT AS score
  FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = cut.x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = cut.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, rank::INTEGER AS rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
