"""Near-duplicate documents: chosen-path set similarity join.

A document is the set of its distinct five-word shingles. Documents with equal
sets are one class. Class representatives walk down independent trees: at a node a document follows the branch of its minwise token (the
smallest under the node's hash). A node of at most ``SMALL`` documents is
compared exhaustively; a larger one branches again, by ``BRANCH`` minwise
tokens chosen from the node's path, so that a similar pair meets in some leaf
with the target recall. A node that branching cannot break up after
``LEVELS`` is compared by pairs of blocks instead, so nothing is capped. The
link bound sets the number of trees and the agreement asked of signatures.

Inside a compared cell, signatures name likely pairs. First the pairs of a
maximum spanning forest are confirmed on full sets and joined into components;
then every likely pair that still lies between two components is confirmed on
full sets, which travel to the cells only for the documents of such pairs. A
cell reports a spanning forest of its links, never all pairs of a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_workers, landed, read_table

SHINGLE_WORDS = 5
LINK_PERCENT = 85       # link if 100 * common >= LINK_PERCENT * union
BRANCH = 2
LEVELS = 4
SMALL = 2048            # documents compared exhaustively
LOCAL_EDGES = 200_000   # edges joined by one task at a time
SIGNATURE = 128         # minwise values, a byte each, of a signature
UNMET = 1e-6            # chance that a pair at the link bound meets in no tree ...
UNLIKE = 1e-5           # ... and that its signatures agree too little to be confirmed

# Hash constants: odd 64-bit numbers drawn from a fixed seed by rule below.
SEED = 20240229

PROFILE = "doc_id long, text_key binary, n_shingles long, set_key binary, roots array<long>, signature binary"


def trees(percent: int) -> int:
    """Trees for a pair at the link bound to meet but with chance UNMET, if it
    has to pass all levels: a branch goes on with the pair's similarity."""
    same, lost = percent / 100, 0.0
    for _ in range(LEVELS):
        lost = (1 - same + same * lost) ** BRANCH
    apart = 1 - same * (1 - lost)
    return max(1, math.ceil(math.log(UNMET) / math.log(apart))) if apart > 0 else 1


def agreement(percent: int) -> int:
    """Places of a signature in which a pair at the link bound agrees but with
    chance UNLIKE (a lower binomial tail)."""
    same, below = percent / 100, 0.0
    for k in range(SIGNATURE):
        below += math.comb(SIGNATURE, k) * same ** k * (1 - same) ** (SIGNATURE - k)
        if below > UNLIKE:
            return k
    return SIGNATURE


def _constants(n_trees: int):
    import numpy as np

    rng = np.random.default_rng(SEED)
    def odd(n):
        return rng.integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return {"byte": odd(1)[0], "word": odd(SHINGLE_WORDS + 1), "min": odd(n_trees + SIGNATURE),
            "add": odd(n_trees + SIGNATURE), "key": odd(2)}


def _mix(h):
    """A 64-bit finaliser: every input bit reaches every output bit."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Shingle hashes of texts. A word's hash is the sum, modulo 2**64, of a
    mixed number for each byte (lower-cased A-Z) and its place in the word, so
    no two patterns of bytes cancel by construction; a shingle's is a mix of
    its words' hashes by place."""

    SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
    PLACES = 32             # places of a word whose numbers are tabled

    def __init__(self, n_trees: int = 1):
        import numpy as np

        self.c = _constants(n_trees)
        self.lower = np.arange(256, dtype=np.int64)
        self.lower[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[list(self.SPACE)] = True
        self.table = self.numbers(np.repeat(np.arange(self.PLACES), 256), np.tile(self.lower, self.PLACES))

    def numbers(self, place, byte):
        """The mixed number of a byte (lower-cased) at a place of its word."""
        import numpy as np

        return _mix((place.astype(np.uint64) * np.uint64(256) + byte.astype(np.uint64)) * self.c["byte"] + self.c["key"][1])

    def words(self, raw):
        """Hashes of the words of ``raw`` (bytes as numpy array)."""
        import numpy as np

        gap = self.space[raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        size = end - start
        if not len(size):
            return np.zeros(0, np.uint64)
        letters = raw[~gap].astype(np.int64)
        first = np.cumsum(size) - size
        place = np.arange(len(letters)) - np.repeat(first, size)
        far = place >= self.PLACES
        number = self.table[np.where(far, 0, place) * 256 + letters]
        if far.any():
            number[far] = self.numbers(place[far], self.lower[letters[far]])
        value = np.add.reduceat(number, first)
        return _mix(value ^ (end - start).astype(np.uint64) * self.c["key"][0])

    def shingles(self, raw):
        """Sorted distinct shingle hashes; a text with fewer words than a
        shingle has one of all its words, a text without words none."""
        import numpy as np

        w, k = self.words(raw), self.c["word"]
        if not len(w):
            return w
        if len(w) < SHINGLE_WORDS:
            parts = np.append(w * k[:len(w)], np.full(len(w), k[SHINGLE_WORDS]))
            return _mix(parts.sum(dtype=np.uint64, keepdims=True))
        n = len(w) - SHINGLE_WORDS + 1
        h = w[:n] * k[0]
        for i in range(1, SHINGLE_WORDS):
            h += w[i:i + n] * k[i]
        return np.unique(_mix(h))

    def minima(self, s):
        """Minwise values of a set under all hash functions."""
        import numpy as np

        out = np.full(len(self.c["min"]), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(s), 512):
            out = np.minimum(out, (s[at:at + 512, None] * self.c["min"] + self.c["add"]).min(axis=0))
        return out

    def set_key(self, s):
        import numpy as np

        return b"".join(int(_mix(s ^ k).sum(dtype=np.uint64)).to_bytes(8, "little") for k in self.c["key"]) \
            + np.uint64(len(s)).tobytes()


def profiles(docs: DataFrame, n_trees: int) -> DataFrame:
    """Set size, set key (equal sets have equal keys), one branch a tree and
    the signature of every document; whole texts, one row a row. Documents
    come as (doc_id, text_key, text)."""
    for_workers(docs.sparkSession)

    def profile(batches):
        import numpy as np
        import pyarrow as pa

        from .byteops import text_bytes
        sh = Shingler(n_trees)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                raw, off = text_bytes(part.column(2))
                n, key, roots, sig = [], [], [], []
                for j in range(part.num_rows):
                    s = sh.shingles(raw[off[j]:off[j + 1]])
                    n.append(len(s))
                    m = _mix(sh.minima(s)) if len(s) else None
                    key.append(sh.set_key(s) if len(s) else None)
                    roots.append(m[:n_trees].view(np.int64) if len(s) else None)
                    sig.append(m[n_trees:].astype(np.uint8).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                     pa.array(roots, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["doc_id", "text_key", "n_shingles", "set_key", "roots", "signature"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(profile, PROFILE)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc, set) from (doc, text): sorted distinct shingle hashes, eight bytes each."""
    def sets(batches):
        import pyarrow as pa

        from .byteops import text_bytes
        sh = Shingler()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                raw, off = text_bytes(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([sh.shingles(raw[off[j]:off[j + 1]]).tobytes()
                                               for j in range(part.num_rows)], pa.binary())], ["doc", "set"])

    return docs.select("doc", "text").mapInArrow(sets, "doc long, set binary")


def leaves(reps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows (node, doc, n) of the small nodes, and of those that stay large.

    Only the node and the document's number move while nodes are counted;
    signatures are fetched for documents that share a node with another.
    """
    rows = reps.select("doc", F.posexplode("roots").alias("tree", "token")).select(
        "doc", F.xxhash64("tree", "token").alias("node"))
    small, stuck = [], None
    for level in range(LEVELS + 1):
        counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        live = landed(rows.join(counts, "node"), f"nodes-{level}")
        small.append(live.where(F.col("n") <= SMALL))
        large = live.where(F.col("n") > SMALL)
        if large.isEmpty():
            break
        if level == LEVELS:
            stuck = large
            break
        place = F.pmod(F.xxhash64("node", "branch"), F.lit(SIGNATURE)).cast("int")
        rows = (large.join(reps.select("doc", "signature"), "doc")
                .withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(BRANCH - 1))))
                .select("doc", F.xxhash64("node", "branch", F.substring("signature", place + 1, F.lit(1))).alias("node")))
    out = small[0]
    for more in small[1:]:
        out = out.unionByName(more)
    return out.select("node", "doc"), stuck


def block_cells(stuck: DataFrame) -> DataFrame:
    """Cells (cell, doc) of nodes too large for one cell: all pairs of blocks.

    Rows come as (node, doc, label). Documents of a large label have blocks
    of their own, and two blocks of one label are never paired, as they are
    in one component already.
    """
    half = SMALL // 2
    sizes = stuck.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    rows = stuck.join(sizes, ["node", "label"]).withColumn("own", F.col("n") > half)
    mixed = rows.where("NOT own").groupBy("node").agg(F.count(F.lit(1)).alias("rest"))
    rows = rows.join(mixed, "node", "left")
    rows = rows.select(
        "node", "doc", F.when(F.col("own"), F.col("label")).alias("one"),
        F.pmod(F.xxhash64("doc", "node"), F.ceil(F.when(F.col("own"), F.col("n")).otherwise(F.col("rest")) / half)).alias("b"))
    rows = landed(rows.withColumn("block", F.xxhash64("one", "b")), "blocks")
    blocks = rows.groupBy("node", "block").agg(F.first("one").alias("one"))
    other = blocks.select(F.col("node").alias("node2"), F.col("block").alias("block2"), F.col("one").alias("one2"))
    pairs = blocks.join(other, (F.col("node") == F.col("node2")) & (F.col("block") <= F.col("block2"))
                        & ~(F.coalesce(F.col("one") == F.col("one2"), F.lit(False))))
    cell = F.xxhash64("node", "block", "block2").alias("cell")
    ends = pairs.select("node", cell, F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"))
    return rows.join(ends, ["node", "block"]).select("cell", "doc")


def _runs(batches):
    """Tables of whole cells from batches sorted by cell."""
    import numpy as np
    import pyarrow as pa

    held = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        cell = t.column(0).to_numpy()
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        if held and len(cell) and held[-1].column(0)[0].as_py() != cell[0]:
            yield pa.concat_tables(held)
            held = []
        if len(cuts):
            held.append(t.slice(0, int(cuts[-1])))
            yield pa.concat_tables(held)
            held = [t.slice(int(cuts[-1]))]
        elif len(cell):
            held.append(t)
    if held:
        yield pa.concat_tables(held)


def _cells(batches):
    """(table, first, last) of every cell of two rows at least."""
    import numpy as np

    for t in _runs(batches):
        cell = t.column(0).to_numpy()
        start = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
        yield t, start[:-1], start[1:]


def likely_pairs(sig, need: int):
    """(i, j, agreement) of rows of ``sig`` that agree in ``need`` places."""
    import numpy as np

    out = []
    for a in range(0, len(sig), 64):
        own = sig[a:a + 64]
        same = (own[:, None, :] == sig[None, a:, :]).sum(axis=2, dtype=np.int16)
        i, j = np.nonzero(same >= need)
        keep = i < j
        out.append((i[keep] + a, j[keep] + a, same[i[keep], j[keep]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def forest(n, i, j):
    """Indices of the edges (in order) that join two trees."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kept = []
    for k, (a, b) in enumerate(zip(i, j, strict=True)):
        a, b = top(int(a)), top(int(b))
        if a != b:
            up[a] = b
            kept.append(k)
    return kept


def _dealt(cells: DataFrame) -> DataFrame:
    """Rows of a cell together and in order; cells are bounded by SMALL rows."""
    return cells.repartition("cell").sortWithinPartitions("cell", "doc")


def spanning_pairs(cells: DataFrame, need: int) -> DataFrame:
    """Maximum spanning forest of the likely pairs of each cell: distinct
    (a, b). Cells come as (cell, doc, signature)."""
    def pairs(batches):
        import numpy as np
        import pyarrow as pa

        for t, first, last in _cells(batches):
            doc = t.column(1).to_numpy()
            sig = np.frombuffer(b"".join(t.column(2).to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            a, b = [], []
            two = first[last - first == 2]
            if len(two):
                hit = two[(sig[two] == sig[two + 1]).sum(axis=1) >= need]
                a.append(doc[hit])
                b.append(doc[hit + 1])
            for s, e in zip(first[last - first > 2], last[last - first > 2], strict=True):
                i, j, same = likely_pairs(sig[s:e], need)
                order = np.lexsort((doc[s + j], doc[s + i], -same))
                kept = order[forest(e - s, i[order], j[order])] if len(order) else order
                a.append(doc[s + i[kept]])
                b.append(doc[s + j[kept]])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return _dealt(cells).select("cell", "doc", "signature").mapInArrow(pairs, "a long, b long").distinct()


def linked(x, y, percent: int = LINK_PERCENT) -> bool:
    """Whether two sorted sets are linked (exact, in integers)."""
    import numpy as np

    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    at = np.searchsorted(x, y)
    common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are linked."""
    def check(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent)
                  for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))],
                                             ["a", "b"])

    left = sets.select(F.col("doc").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("set").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def links_between(cells: DataFrame, percent: int) -> DataFrame:
    """Links inside cells between documents of different labels, confirmed on
    full sets: pairs of labels (a, b), a spanning forest of a cell's. Cells
    come as (cell, doc, label, set)."""
    def find(batches):
        import numpy as np
        import pyarrow as pa

        for t, first, last in _cells(batches):
            label, raw = t.column(2).to_numpy(), t.column(3).to_pylist()
            a, b = [], []
            for s, e in zip(first, last, strict=True):
                sets = [np.frombuffer(r, np.uint64) for r in raw[s:e]]
                size = np.array([len(x) for x in sets])
                token = np.concatenate(sets)
                owner = np.repeat(np.arange(e - s), size)
                order = np.argsort(token, kind="stable")
                token, owner = token[order], owner[order]
                # Only tokens of two documents at least can be in common.
                edge = np.concatenate([[True], token[1:] != token[:-1]])
                rank = np.cumsum(edge) - 1
                keep = np.bincount(rank)[rank] > 1
                owner, rank = owner[keep], np.unique(rank[keep], return_inverse=True)[1]
                common = np.zeros((e - s, e - s), np.float32)
                width = rank[-1] + 1 if len(rank) else 0
                for w in range(0, width, 4096):
                    lo, hi = np.searchsorted(rank, [w, w + 4096])
                    have = np.zeros((e - s, 4096), np.float32)
                    have[owner[lo:hi], rank[lo:hi] - w] = 1
                    common += have @ have.T
                common = common.astype(np.int64)
                i, j = np.nonzero(np.triu(100 * common >= percent * (size[:, None] + size[None, :] - common), 1))
                names, lab = np.unique(label[s:e], return_inverse=True)
                for k in forest(len(names), lab[i], lab[j]):
                    a.append(names[lab[i[k]]])
                    b.append(names[lab[j[k]]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _dealt(cells).select("cell", "doc", "label", "set").mapInArrow(find, "a long, b long").distinct()


def doubtful(cells: DataFrame, need: int) -> DataFrame:
    """(cell, doc, label) of documents that have a likely partner with another
    label in the cell. Cells come as (cell, doc, label, signature)."""
    def find(batches):
        import numpy as np
        import pyarrow as pa

        for t, first, last in _cells(batches):
            label = t.column(2).to_numpy()
            sig = np.frombuffer(b"".join(t.column(3).to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            mark = np.zeros(len(label), bool)
            for s, e in zip(first, last, strict=True):
                if e - s > 1 and (label[s:e] != label[s]).any():
                    i, j, _ = likely_pairs(sig[s:e], need)
                    differ = label[s + i] != label[s + j]
                    mark[s + i[differ]] = True
                    mark[s + j[differ]] = True
            yield from t.select([0, 1, 2]).filter(pa.array(mark)).to_batches()

    return _dealt(cells).select("cell", "doc", "label", "signature").mapInArrow(find, "cell long, doc long, label long")


def joined_here(edges: DataFrame) -> DataFrame:
    """(u, v) edges of the same components, at most one a document: those of a
    task's edges are joined where they lie, and each document points at the
    smallest of its part. Fewer edges and shorter paths are left to the steps
    between tasks."""
    def local(batches):
        up: dict[int, int] = {}

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if len(up) > 2 * LOCAL_EDGES:
                yield flush(up, top)
                up.clear()
        if up:
            yield flush(up, top)

    def flush(up, top):
        import pyarrow as pa

        ends = [(x, top(x)) for x in list(up)]
        ends = [(x, y) for x, y in ends if x != y]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([y for _, y in ends], pa.int64())],
                                          ["u", "v"])

    return edges.select("u", "v").mapInArrow(local, "u long, v long")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(doc, label): the smallest document of each connected component, for
    documents with an edge. Each task first joins the edges it holds. While
    there are more than ``LOCAL_EDGES`` edges, large-star and small-star steps
    alternate, which halve distances, until the edges no longer change; a
    smaller number of edges is joined by one task."""
    def low(e):
        return e.groupBy("u").agg(F.min("v").alias("m"))

    e = landed(joined_here(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")), label)
    if e.count() <= LOCAL_EDGES:
        return landed(joined_here(e.coalesce(1)), label).select(F.col("u").alias("doc"), F.col("v").alias("label"))
    while True:
        # Large star: every larger neighbour of u goes to the least of u's neighbourhood.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = low(both).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("c")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: u and its smaller neighbours go to the least of them.
        ends = low(large).select(F.col("u").alias("c"), "m")
        step = large.join(ends, F.col("u") == F.col("c"))
        new = landed(step.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(ends.select(F.col("c").alias("u"), F.col("m").alias("v")))
                     .where("u > v").distinct(), label)
        # Done when every document points at one root that points nowhere.
        roots = new.select(F.col("v").alias("r")).distinct()
        if new.join(roots, F.col("u") == F.col("r"), "left_semi").isEmpty() and \
                new.groupBy("u").count().where("count > 1").isEmpty():
            return new.select(F.col("u").alias("doc"), F.col("v").alias("label"))
        e = new


def text_key(text) -> Column:
    """Sixteen bytes that tell texts apart (null text: null)."""
    return F.unhex(F.md5(text.cast("binary")))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    percent: int = LINK_PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per row.

    A null text, or one without words, has an empty set and is linked with
    nothing. Rows are linked by their texts alone: rows with equal ids, or
    null ones, are documents of their own. ``component_id`` is the smallest id
    of the component; a null id is the smallest there is (component_id is null
    then). Equal texts are always in one component. Extra columns are not
    read. An empty table gives an empty result.
    """
    return grouped(docs, id, text, percent).select("doc_id", "n_shingles", "component_id", "kept")


def grouped(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = LINK_PERCENT) -> DataFrame:
    """``near_duplicates`` with ``text_key`` and ``component``, a number for
    each component (null without words), which ids do not tell apart."""
    null_id = -(1 << 63)
    own = docs.select(F.coalesce(F.col(f"`{id}`").cast("long"), F.lit(null_id)).alias("doc_id"),
                      text_key(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text"))
    need = agreement(percent)
    every = landed(profiles(own, trees(percent)), "profiles")
    some = every.where("n_shingles > 0")
    # One row stands for its class of equal sets, under a number of its own.
    classes = some.groupBy(F.col("set_key").alias("k")).agg(F.min(F.struct("doc_id", "text_key")).alias("rep"))
    reps = landed(some.join(classes, (F.col("set_key") == F.col("k")) & (F.col("doc_id") == F.col("rep.doc_id"))
                            & (F.col("text_key") == F.col("rep.text_key")))
                  .dropDuplicates(["set_key"])
                  .select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text_key", "set_key", "roots",
                          "signature"), "classes")

    small, stuck = leaves(reps)
    sig = reps.select("doc", "signature")
    cells = small.withColumnRenamed("node", "cell")
    first = cells
    if stuck is not None:
        # Blocks of a large node, each with the node's pivot, which ties them together.
        pivots = stuck.groupBy("node").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
        part = F.pmod(F.xxhash64("doc", "node"), F.ceil(F.col("n") / (SMALL // 2)))
        tied = stuck.select("node", F.xxhash64("node", part).alias("cell"), "doc")
        first = first.unionByName(tied.select("cell", "doc").unionByName(
            tied.select("node", "cell").distinct().join(pivots, "node").select("cell", "doc")).distinct())
    pairs = landed(spanning_pairs(first.join(sig, "doc").select("cell", "doc", "signature"), need), "pairs")

    asked = pairs.select(F.col("a").alias("d")).unionByName(pairs.select(F.col("b").alias("d"))).distinct()
    sets = landed(_sets_of(own, asked, reps), "sets")
    links = confirmed(pairs, sets, percent)
    links = landed(links, "links")
    label = components(links)

    def labelled(rows):
        return rows.join(label.withColumnRenamed("doc", "l_doc"), F.col("doc") == F.col("l_doc"), "left").withColumn(
            "label", F.coalesce("label", "doc")).drop("l_doc")

    # Cells that still hold two components.
    now = labelled(cells)
    again = now.join(now.groupBy("cell").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                     .where("lo < hi").select("cell"), "cell")
    if stuck is not None:
        wide = labelled(stuck.select("node", "doc"))
        more = block_cells(wide.select("node", "doc", "label"))
        again = again.select("cell", "doc", "label").unionByName(labelled(more).select("cell", "doc", "label"))
    open_rows = landed(doubtful(again.join(sig, "doc").select("cell", "doc", "label", "signature"), need), "doubtful")
    # Documents whose likely partners all lie in other blocks have been in no pair so far.
    new = open_rows.select(F.col("doc").alias("d")).distinct().join(
        sets.select(F.col("doc").alias("d")), "d", "left_anti")
    if stuck is not None:
        sets = sets.unionByName(landed(_sets_of(own, new, reps), "more-sets"))
    found = links_between(open_rows.join(sets, "doc")
                          .select("cell", "doc", "label", "set"), percent)
    # The late links join components of the first ones; only those are joined again.
    over = components(found, "merged").select(F.col("doc").alias("o_doc"), F.col("label").alias("o_label"))
    member = labelled(reps).join(over, F.col("label") == F.col("o_doc"), "left").select(
        F.col("set_key").alias("k"), F.col("doc_id").alias("least"), F.coalesce("o_label", "label").alias("component"))
    roots = member.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("root"))
    member = member.join(roots, F.col("component") == F.col("c")).select("k", "component", "root")
    rows = some.select("doc_id", "text_key", "n_shingles", "set_key").join(member, F.col("set_key") == F.col("k"))
    out = rows.select("doc_id", "text_key", "n_shingles", "component", "root").unionByName(
        every.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component"),
                                             F.col("doc_id").alias("root")))
    return out.select(F.when(F.col("doc_id") != null_id, F.col("doc_id")).alias("doc_id"), "text_key", "n_shingles",
                      "component", F.when(F.col("root") != null_id, F.col("root")).alias("component_id"),
                      (F.col("doc_id") == F.col("root")).alias("kept"))


def _sets_of(own: DataFrame, asked: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc, set) of the asked classes, from a text of each class's own row."""
    wanted = asked.join(reps.select("doc", "doc_id", "text_key"), F.col("d") == F.col("doc")).select(
        "doc", F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"))
    texts = own.join(wanted, (F.col("doc_id") == F.col("r_id")) & (F.col("text_key") == F.col("r_key")))
    return shingle_sets(texts).dropDuplicates(["doc"])


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
c AS (SELECT min(doc_id) AS rep, len(any_value(g)) AS n, list_sort(g) AS k FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
x AS (SELECT rep, n, unnest(k) AS t FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS m, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM x a JOIN x b ON a.t = b.t AND a.rep < b.rep GROUP BY a.rep, b.rep),
l AS (SELECT a, b FROM p WHERE 100 * m >= 85 * (na + nb - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(u, v) AS (SELECT rep, rep FROM c UNION SELECT r.u, e.b FROM r JOIN e ON r.v = e.a),
m AS (SELECT u AS rep, min(v) AS component FROM r GROUP BY u)
SELECT s.doc_id, coalesce(len(g), 0)::BIGINT AS n_shingles, coalesce(m.component, s.doc_id) AS component_id,
       s.doc_id = coalesce(m.component, s.doc_id) AS kept
FROM s LEFT JOIN c ON len(s.g) > 0 AND list_sort(s.g) = c.k LEFT JOIN m ON m.rep = c.rep
"""
