"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes.

Every n-gram of a lower-cased text (3 to 6 characters, hashed to ``2**BITS``
buckets) has a log-count ratio: how much more often toxic training documents
hold it than others. A document's features are its n-gram frequencies times
the ratios; a logistic regression learns one weight a bucket, and the product
of ratio and weight is all that scoring needs. Ratios and weights come from a
bounded sample of labelled rows, the odds from all of them; a very long text of
the sample is learned from by several windows. The fit is one task of a worker,
which returns the weights alone. Texts are scored whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byteops import labelled_rows
from .common import for_workers, read_table, without
from .quality import held_out

SIZES = (3, 4, 5, 6)
BITS = 19
MIN_DOCS = 10           # buckets of fewer training documents are left out
MIN_RATIO = 0.1         # and those of nearly equal odds
PER_LABEL = 4_000       # bound of the sample: rows a label ...
SAMPLE_CHARS = 20_000   # ... and characters a row: of a longer text as many in ...
WINDOWS = 8             # ... windows, evenly spaced from its start to its end
EPOCHS, RATE, DECAY = 8, 0.3, 3e-4
THRESHOLD = 0.3
PIECE = 1 << 18         # characters hashed at a time


def buckets(text: str):
    """Yield the bucket numbers of a text's n-grams, piece by piece; pieces
    overlap so that every n-gram of the text is there once."""
    import numpy as np

    low = " " + text.lower()
    reach = max(SIZES) - 1
    for at in range(0, len(low), PIECE):
        c = np.frombuffer(low[at:at + PIECE + reach].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = c.copy()
        for n in range(1, max(SIZES) + 1):
            if n > 1:
                if len(c) < n:
                    break
                h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:]
            if n in SIZES:
                mixed = (h[:PIECE] ^ np.uint32((n * 0x9E3779B9) & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                yield (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)


def log_count_ratios(sample):
    """Log-count ratio of every bucket over (label, text) pairs; 0 for buckets
    that are left out."""
    import numpy as np

    have = np.ones((2, 1 << BITS))
    for y, t in sample:
        own = np.zeros(1 << BITS, bool)
        for b in buckets(t):
            own[b] = True
        have[y] += own
    ratio = np.log((have[1] / have[1].sum()) / (have[0] / have[0].sum()))
    ratio[(have.sum(axis=0) < MIN_DOCS + 2) | (np.abs(ratio) < MIN_RATIO)] = 0
    return ratio.astype(np.float32)


def features(text: str, known):
    """(distinct known buckets, n-gram count / sqrt of all n-grams)."""
    import numpy as np

    ids, counts, total = [], [], 0
    for b in buckets(text):
        total += len(b)
        u, c = np.unique(b[known[b]], return_counts=True)
        ids.append(u)
        counts.append(c)
    if not ids:
        return np.zeros(0, np.uint32), np.zeros(0, np.float32)
    u, inv = np.unique(np.concatenate(ids), return_inverse=True)
    return u, (np.bincount(inv, weights=np.concatenate(counts), minlength=len(u)) / np.sqrt(total)).astype(np.float32)


def learn(ratio, sample, odds: float, seed: int = 0):
    """Weights (one a bucket, ratio included) and bias by adaptive stochastic
    gradient descent on the sample, moved to the labels' real odds."""
    import math

    import numpy as np

    known, rows = ratio != 0, []
    for y, t in sample:
        if t:
            u, f = features(t, known)
            rows.append((y, u.astype(np.uint32), f * ratio[u]))
    w, grad = np.zeros(len(ratio), np.float32), np.full(len(ratio), 1e-3, np.float32)
    pos = sum(y for y, *_ in rows)
    own_odds = math.log((pos + 1) / (len(rows) - pos + 1))
    b, gb, rng = own_odds, 1e-3, np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            y, u, v = rows[i]
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(v @ w[u]) + b)))) - y
            step = g * v + DECAY * w[u]
            grad[u] += step * step
            w[u] -= RATE * step / np.sqrt(grad[u])
            gb += g * g
            b -= RATE * g / math.sqrt(gb)
    return (w * ratio).astype(np.float32), b + odds - own_odds


def windowed(t, chars: int = SAMPLE_CHARS, parts: int = WINDOWS):
    """A text of at most ``chars`` characters whole, of a longer one ``parts``
    windows of ``chars / parts``, the first at its start and the last at its
    end. A space goes between windows."""
    n, size = F.char_length(t), chars // parts
    steps = [F.substring(t, F.floor((n - size) * i / (parts - 1)).cast("int") + 1, F.lit(size)) for i in range(parts)]
    return F.when(n <= chars, t).otherwise(F.concat_ws(" ", *steps))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text"):
    """(weights or None, bias). None if the training rows lack a label.

    No labelled row is left out for its length. Rows with a null id or text
    are not learned from, an id with several rows is learned from once.
    """
    import math

    import numpy as np

    for_workers(docs.sparkSession)
    rows, n = labelled_rows(docs, labels, label, id, text, lambda t, _: windowed(t), ~held_out(id), PER_LABEL)
    odds = math.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1))
    if len(n) < 2:
        return None, odds

    def train(batches):
        import numpy as np
        import pyarrow as pa

        found = sorted(r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
        sample = [(y, t) for _, y, t in found]
        if len({y for y, _ in sample}) == 2:
            weights, bias = learn(log_count_ratios(sample), sample, odds)
            at = np.flatnonzero(weights).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at.tobytes()], pa.binary()), pa.array([weights[at].tobytes()], pa.binary()),
                 pa.array([bias], pa.float64())], ["place", "weight", "bias"])

    # The sample is bounded in rows and characters, so one task holds it.
    model = rows.coalesce(1).mapInArrow(train, "place binary, weight binary, bias double").collect()
    if not model:
        return None, odds
    weights = np.zeros(1 << BITS, np.float32)
    weights[np.frombuffer(model[0]["place"], np.uint32)] = np.frombuffer(model[0]["weight"], np.float32)
    return weights, model[0]["bias"]


def score_toxicity(docs: DataFrame, weights, bias: float, text: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``.

    A null or empty text has the score of the bias alone, and so has every
    text if nothing could be learned. Input columns named like an output
    column are replaced. Equal texts get equal scores.
    """
    import numpy as np

    for_workers(docs.sparkSession)
    own = without(docs, "score", "predicted")
    columns, at = own.columns, own.columns.index(text)
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(
        np.zeros(1 << BITS, np.float32) if weights is None else weights)  # 2**BITS numbers

    def score(batches):
        import numpy as np
        import pyarrow as pa

        w = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                z = np.full(part.num_rows, bias)
                for k, t in enumerate(part.column(at).to_pylist()):
                    if t:
                        total, n = 0.0, 0
                        for b in buckets(t):
                            total += float(w[b].sum(dtype=np.float64))
                            n += len(b)
                        z[k] += total / np.sqrt(max(n, 1))
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.round(p, 5))], [*columns, "score"])

    return own.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights, bias = fit(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, weights, bias).select("doc_id", held_out().alias("held_out"), "score", "predicted")
