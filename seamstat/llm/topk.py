"""Exact top-k inner-product search by ball trees.

The rows are dealt into shards of bounded size and every shard builds a ball
tree once. A tree is searched branch and bound: nodes come in order of the
upper bound ``q . centre + |q| * radius``, and a node is skipped as soon as its
bound is under the query's current k-th score. That score is shared: each
query first meets the shard that holds it, its k-th score from there is the
bar everywhere else, and within a task it carries on from shard to shard.

Queries go in blocks against groups of shards, so a task holds one block and
one shard at a time. Partial results are at most k rows a query and group.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import for_workers, landed, read_table

SCALE = 64
K = 20
QUERY_STEP = 20
SHARD_ROWS = 8_192
QUERY_BLOCK = 512
SHARDS_PER_GROUP = 4
LEAF = 128

PART = "kind int, number long, asked long, query_id long, vec_id long, score long, payload binary"
ASK_BITS = 32           # a query's number: its shard, then its place there
SAFE = float(1 << 53)   # sums of integers below this are exact in doubles


def build_tree(points):
    """Ball tree of rows of ``points`` (doubles). Returns (order, nodes) with
    nodes as (centre, radius, first, last, left, right); leaves have left -1.
    A node is cut at the median along the line between two far points."""
    import numpy as np

    order, nodes = np.arange(len(points)), []
    stack = [(0, len(points), -1, 0)]
    while stack:
        first, last, parent, side = stack.pop()
        own = points[order[first:last]]
        centre = own.mean(axis=0)
        radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
        me = len(nodes)
        nodes.append([centre, radius, first, last, -1, -1])
        if parent >= 0:
            nodes[parent][4 + side] = me
        if last - first > LEAF and radius > 0:
            a = own[((own - centre) ** 2).sum(axis=1).argmax()]
            b = own[((own - a) ** 2).sum(axis=1).argmax()]
            mid = (first + last) // 2
            order[first:last] = order[first:last][np.argsort(own @ (b - a), kind="stable")]
            stack += [(mid, last, me, 1), (first, mid, me, 0)]
    return order, nodes


class Shard:
    """A searchable shard: integer vectors, their ids and the tree."""

    def __init__(self, ids, points, centres, radii, links):
        """Arrays as ``arrays`` gives them, rows in the tree's order; ``links``
        has first, last, left and right of every node."""
        import numpy as np

        self.ids, self.points = ids.astype(np.int64), points.astype(np.int64)
        self.centres, self.radii, self.links = centres, radii, links
        self.real = self.points.astype(np.float64)
        self.largest = float(np.abs(self.real).max(initial=0))

    def arrays(self):
        import numpy as np

        small = np.int16 if self.largest < 1 << 15 else np.int64
        return self.ids, self.points.astype(small), self.centres, self.radii, self.links

    @classmethod
    def build(cls, ids, vectors, k: int) -> Shard:
        import numpy as np

        if not len(ids):
            return cls(ids, vectors, np.zeros((0, vectors.shape[1])), np.zeros(0), np.zeros((0, 4), np.int64))
        # Of equal vectors the k + 1 smallest ids can matter (one may be the query).
        by_id = np.lexsort((ids, *vectors.T))
        v, i = vectors[by_id], ids[by_id]
        same = np.concatenate([[False], (v[1:] == v[:-1]).all(axis=1)])
        repeat = same & np.concatenate([[False], i[1:] == i[:-1]])
        v, i, same = v[~repeat], i[~repeat], same[~repeat]
        start = np.maximum.accumulate(np.where(same, 0, np.arange(len(v))))
        keep = np.arange(len(v)) - start <= k
        i, v = i[keep], v[keep]
        order, nodes = build_tree(v.astype(np.float64))
        return cls(i[order], v[order], np.stack([n[0] for n in nodes]), np.array([n[1] for n in nodes]),
                   np.array([n[2:] for n in nodes], np.int64))

    def scores(self, queries, real, first, last):
        import numpy as np

        d = self.points.shape[1]
        if float(np.abs(real).max(initial=0)) * self.largest * d < SAFE:
            return real @ self.real[first:last].T
        return queries @ self.points[first:last].T

    def search(self, query_ids, queries, top, top_ids):
        """Merge this shard into ``top`` (n, k scores, descending) and
        ``top_ids``; ``top[:, -1]`` is each query's bar."""
        import heapq

        import numpy as np

        if not len(self.radii) or not len(queries):
            return
        real = queries.astype(np.float64)
        norm = np.sqrt((real ** 2).sum(axis=1))
        k = top.shape[1]

        def bound(node, who):
            c, r = self.centres[node], self.radii[node]
            b = real[who] @ c + norm[who] * r
            return b + 1e-6 + 1e-9 * norm[who] * (np.sqrt((c ** 2).sum()) + r)

        everyone = np.arange(len(queries))
        ub = bound(0, everyone)
        heap = [(-ub.max(), 0, everyone, ub)]
        while heap:
            _, node, who, ub = heapq.heappop(heap)
            who = who[ub >= top[who, -1]]
            if not len(who):
                continue
            first, last, left, right = self.links[node]
            if left >= 0:
                for child in (left, right):
                    b = bound(child, who)
                    some = b >= top[who, -1]
                    if some.any():
                        heapq.heappush(heap, (-b[some].max(), child, who[some], b[some]))
                continue
            s = self.scores(queries[who], real[who], first, last).astype(np.int64)
            ids = self.ids[first:last]
            ok = (s >= top[who, -1][:, None]) & (ids[None, :] != query_ids[who][:, None])
            hit = ok.any(axis=1)
            who, s, ok = who[hit], s[hit], ok[hit]
            if len(who):
                all_s = np.concatenate([top[who], np.where(ok, s, NONE)], axis=1)
                all_i = np.concatenate([top_ids[who], np.where(ok, ids[None, :], MAX_ID)], axis=1)
                best = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                top[who] = np.take_along_axis(all_s, best, axis=1)
                top_ids[who] = np.take_along_axis(all_i, best, axis=1)


NONE = -(1 << 62)       # score of an empty place
MAX_ID = (1 << 63) - 1


def empty_top(n: int, k: int):
    import numpy as np

    return np.full((n, k), NONE, np.int64), np.full((n, k), MAX_ID, np.int64)


def pack_arrays(*arrays) -> bytes:
    import io

    import numpy as np

    f = io.BytesIO()
    for a in arrays:
        np.save(f, a, allow_pickle=False)
    return f.getvalue()


def unpack_arrays(raw: bytes, n: int):
    import io

    import numpy as np

    f = io.BytesIO(raw)
    return [np.load(f, allow_pickle=False) for _ in range(n)]


def vectors_of(table, dims: int, scale: int):
    """(ids, integer vectors) of valid rows of an Arrow table (id, vector);
    shorter vectors are filled with zeros. A component so large that a sum of
    products could pass 62 bits raises an error."""
    import numpy as np
    import pyarrow as pa

    col = table.column(1).combine_chunks() if isinstance(table.column(1), pa.ChunkedArray) else table.column(1)
    out = np.zeros((len(col), dims))
    for i, v in enumerate(col.to_numpy(zero_copy_only=False)):
        out[i, :len(v)] = v
    whole = np.floor(scale * out)
    if whole.size and np.abs(whole).max() > math.isqrt((1 << 62) // max(1, dims)) - 1:
        raise ValueError("a vector's component is too large for exact 64-bit scores")
    return table.column(0).to_numpy().astype(np.int64), whole.astype(np.int64)


def valid_rows(df: DataFrame, id: str, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(F.col(f"`{id}`").isNotNull() & v.isNotNull() & fine).select(
        F.col(f"`{id}`").cast("long").alias("id"), v.cast("array<double>").alias("v"))


def top_k(df: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = K,
          query_step: int = QUERY_STEP, scale: int = SCALE, shard_rows: int = SHARD_ROWS,
          query_block: int = QUERY_BLOCK, shards_per_group: int = SHARDS_PER_GROUP) -> DataFrame:
    """The ``k`` best rows of every query: ``query_id``, ``rank`` (from 1),
    ``vec_id`` and ``score``.

    Queries are the rows whose id is divisible by ``query_step``, candidates
    all rows with another id. Scores are inner products of
    ``floor(scale * x)``; ties go to the smaller id. Rows with a null id, a
    null vector or a null or non-finite component take no part; a shorter
    vector counts as filled with zeros. A row repeated with the same id and
    vector counts once. Rows of one id with different vectors are queries of
    their own, each with its own list (under the one ``query_id``), and
    candidates of their own for other ids. A component for which sums of
    products could pass 62 bits raises an error. Extra columns are not read.
    An empty table gives an empty result.
    """
    for_workers(df.sparkSession)
    rows = valid_rows(df, id, vector)
    n, dims, n_q = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("id") % query_step == 0, 1)), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard_rows))
    blocks = max(1, math.ceil(n_q / query_block))
    groups = max(1, math.ceil(shards / shards_per_group))

    def home(key, table):
        """A shard's row, its queries' rows, and what they find at home."""
        import numpy as np
        import pyarrow as pa

        ids, vec = vectors_of(table.select(["id", "v"]), dims, scale)
        shard = Shard.build(ids, vec, k)
        out = {c: [] for c in ("kind", "number", "asked", "query_id", "vec_id", "score", "payload")}

        def put(*row):
            for c, x in zip(out, row, strict=True):
                out[c].append(x)

        # Kind 0: a shard; 1: a query with its bar; 2: a result.
        put(0, key[0].as_py(), None, None, None, None, pack_arrays(*shard.arrays()))
        asks = np.flatnonzero(ids % query_step == 0)
        asks = asks[np.lexsort((*vec[asks].T, ids[asks]))] if len(asks) and dims else asks
        asks = [a for j, a in enumerate(asks) if not j or ids[a] != ids[asks[j - 1]] or (vec[a] != vec[asks[j - 1]]).any()]
        top, top_ids = empty_top(len(asks), k)
        shard.search(ids[asks], vec[asks], top, top_ids)
        for j, a in enumerate(asks):
            asked = (key[0].as_py() << ASK_BITS) + j
            put(1, key[0].as_py(), asked, int(ids[a]), None, int(top[j, -1]), pack_arrays(vec[a]))
            for s, i in zip(top[j].tolist(), top_ids[j].tolist(), strict=True):
                if s != NONE:
                    put(2, None, asked, int(ids[a]), i, s, None)
        return pa.table(out, schema=pa.schema([
            ("kind", pa.int32()), ("number", pa.int64()), ("asked", pa.int64()), ("query_id", pa.int64()),
            ("vec_id", pa.int64()), ("score", pa.int64()), ("payload", pa.binary())]))

    dealt = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"))
    at_home = landed(dealt.applyInArrow(home, PART), "shards")

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    trees = at_home.where("kind = 0").select(
        "number", "payload", F.pmod(F.col("number"), F.lit(groups)).cast("int").alias("group"), every_block)
    asks = at_home.where("kind = 1").select(
        "asked", "query_id", "number", "score", "payload",
        F.pmod(F.xxhash64("asked", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), every_group)

    def away(_key, some, shards_of_group):
        """A block of queries against the shards of a group, one by one."""
        import numpy as np
        import pyarrow as pa

        out = pa.schema([("asked", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not some.num_rows or not shards_of_group.num_rows:
            return out.empty_table()
        some = some.sort_by("asked")
        asked = some.column("asked").to_numpy()
        ids = some.column("query_id").to_numpy()
        at = some.column("number").to_numpy()
        bar = some.column("score").to_numpy()
        vec = np.stack([unpack_arrays(p, 1)[0] for p in some.column("payload").to_pylist()])
        top, top_ids = empty_top(len(ids), k)
        top[:] = bar[:, None]
        for number, payload in sorted(zip(shards_of_group.column("number").to_pylist(),
                                          shards_of_group.column("payload").to_pylist(), strict=True)):
            shard = Shard(*unpack_arrays(payload, 5))
            who = np.flatnonzero(at != number)
            t, i = top[who], top_ids[who]
            shard.search(ids[who], vec[who], t, i)
            top[who], top_ids[who] = t, i
        real = top_ids != MAX_ID
        return pa.table([np.broadcast_to(asked[:, None], top.shape)[real], np.broadcast_to(ids[:, None], top.shape)[real],
                         top_ids[real], top[real]], schema=out)

    if groups == 1 and shards == 1:
        found = at_home.where("kind = 2").select("asked", "query_id", "vec_id", "score")
    else:
        found = at_home.where("kind = 2").select("asked", "query_id", "vec_id", "score").unionByName(
            asks.groupBy("block", "group").cogroup(trees.groupBy("block", "group"))
            .applyInArrow(away, "asked long, query_id long, vec_id long, score long"))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
