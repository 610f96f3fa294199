"""Quality classifier: a byte-level convolutional network in numpy.

A text is read in overlapping chunks that cover it whole. In a chunk, learned
filters slide over embedded bytes; each filter's strongest response in the
chunk is kept (max-pooling), a hidden layer turns the responses into a logit,
and the mean of the chunks' logits gives one probability. It is trained by
backpropagation on a bounded sample of labelled documents; every document is
then scored over all its chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byteops import labelled_sample, text_bytes, windows
from .common import crc_mod, for_workers, read_table, without

CHUNK, STEP = 256, 192          # bytes of a chunk, and from chunk to chunk
WIDTH, STRIDE = 16, 4           # bytes of a filter, and from place to place
EMBED, FILTERS, HIDDEN = 6, 24, 12
BLOCK = 256                     # chunks computed together
PER_LABEL = 2_000               # bound of the sample: rows a label ...
SAMPLE_CHARS = 4_000            # ... and characters drawn from each text
STEPS, BATCH, CHUNKS, RATE = 900, 48, 4, 0.01
THRESHOLD = 0.7
PLACES = (CHUNK - WIDTH) // STRIDE + 1


class ByteCNN:
    def __init__(self, params):
        self.p = params

    @staticmethod
    def initial(seed: int = 5):
        import numpy as np

        rng = np.random.default_rng(seed)
        f = WIDTH * EMBED
        return {k: v.astype(np.float32) for k, v in {
            "e": rng.normal(scale=0.5, size=(256, EMBED)),
            "w": rng.normal(scale=f ** -0.5, size=(f, FILTERS)), "wb": np.zeros(FILTERS),
            "h": rng.normal(scale=FILTERS ** -0.5, size=(FILTERS, HIDDEN)), "hb": np.zeros(HIDDEN),
            "o": rng.normal(scale=HIDDEN ** -0.5, size=HIDDEN), "ob": np.zeros(1)}.items()}

    def patches(self, chunks):
        """(n, places, width * embed) embedded bytes under each filter place."""
        import numpy as np

        emb = self.p["e"][chunks].reshape(len(chunks), CHUNK * EMBED)
        view = np.lib.stride_tricks.sliding_window_view(emb, WIDTH * EMBED, axis=1)
        return np.ascontiguousarray(view[:, ::STRIDE * EMBED])

    def logits(self, chunks, keep=False):
        import numpy as np

        p, x = self.p, self.patches(chunks)
        conv = (x.reshape(-1, x.shape[2]) @ p["w"]).reshape(len(chunks), PLACES, FILTERS)
        place = conv.argmax(axis=1) if keep else None
        top = np.tanh(conv.max(axis=1) + p["wb"])
        hid = np.tanh(top @ p["h"] + p["hb"])
        z = hid @ p["o"] + p["ob"][0]
        return (z, x, place, top, hid) if keep else z

    def gradients(self, chunks, group, n_groups, target):
        """Loss and gradients of the cross-entropy of documents whose logit is
        the mean over their chunks (``group`` names a chunk's document)."""
        import numpy as np

        p = self.p
        z, x, place, top, hid = self.logits(chunks, keep=True)
        count = np.bincount(group, minlength=n_groups).astype(np.float32)
        doc = np.bincount(group, weights=z, minlength=n_groups) / count
        prob = 1 / (1 + np.exp(-doc))
        loss = -np.mean(target * np.log(prob + 1e-9) + (1 - target) * np.log(1 - prob + 1e-9))
        dz = (((prob - target) / n_groups / count)[group]).astype(np.float32)
        g = {"o": hid.T @ dz, "ob": dz.sum(keepdims=True)}
        dh = dz[:, None] * p["o"] * (1 - hid * hid)
        g["h"], g["hb"] = top.T @ dh, dh.sum(axis=0)
        dt = (dh @ p["h"].T) * (1 - top * top)
        g["wb"] = dt.sum(axis=0)
        n = np.arange(len(chunks))
        g["w"], ge = np.empty_like(p["w"]), np.zeros_like(p["e"])
        for f in range(FILTERS):
            at = place[:, f]
            g["w"][:, f] = x[n, at].T @ dt[:, f]
            own = chunks[n[:, None], at[:, None] * STRIDE + np.arange(WIDTH)]
            de = dt[:, f, None, None] * p["w"][:, f].reshape(WIDTH, EMBED)
            np.add.at(ge, own, de)
        g["e"] = ge
        return loss, g


def cut_chunks(raw, offsets):
    """(document, chunk bytes) of all texts; a text shorter than a chunk is
    filled with zero bytes before its start."""
    import numpy as np

    text, start, _ = windows(offsets, CHUNK, STEP)
    padded = np.concatenate([np.zeros(CHUNK, np.uint8), raw])
    at = np.arange(CHUNK)
    own = np.diff(offsets)

    def block(i, j):
        out = padded[(start[i:j] + CHUNK)[:, None] + at]
        short = own[text[i:j]]
        if (short < CHUNK).any():
            out = np.where(at >= CHUNK - np.minimum(short, CHUNK)[:, None], out, 0)
        return out

    return text, block


def train(samples, seed: int = 3, steps: int = STEPS) -> ByteCNN | None:
    """Fit on (label, text) pairs, labels drawn evenly; the output is then
    moved to the labels' real odds. None if a label has no text."""
    import numpy as np

    by = {k: [t.encode("utf-8") for y, t in samples if y == k and t] for k in (0, 1)}
    if not all(by.values()):
        return None
    net, rng = ByteCNN(ByteCNN.initial()), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        target = rng.integers(2, size=BATCH)
        chunks, group = [], []
        for i, k in enumerate(target):
            raw = by[k][rng.integers(len(by[k]))]
            for _ in range(min(CHUNKS, 1 + len(raw) // CHUNK)):
                at = rng.integers(max(1, len(raw) - CHUNK + 1))
                part = raw[at:at + CHUNK]
                chunks.append(np.frombuffer(part.rjust(CHUNK, b"\0"), np.uint8))
                group.append(i)
        _, g = net.gradients(np.stack(chunks), np.array(group), BATCH, target.astype(np.float64))
        rate = RATE * min(1.0, 3 * (1 - step / (steps + 1)))
        for k in net.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
            net.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                         / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def probabilities(net: ByteCNN, column, prior_logit: float = 0.0):
    """Probability of label 1 of each text of an Arrow string column."""
    import numpy as np

    raw, offsets = text_bytes(column)
    text, block = cut_chunks(raw, offsets)
    n = len(offsets) - 1
    z = np.concatenate([np.zeros(0, np.float32),
                        *(net.logits(block(i, i + BLOCK)) for i in range(0, len(text), BLOCK))])
    total = np.bincount(text, weights=z, minlength=n) if len(text) else np.zeros(n)
    mean = total / np.maximum(np.bincount(text, minlength=n), 1)
    return 1 / (1 + np.exp(-np.clip(mean + prior_logit, -40, 40)))


def held_out(id: str = "doc_id"):
    return F.coalesce(crc_mod(F.col(f"`{id}`"), 4) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text"):
    """(network or None, log odds of label 1 over all training labels)."""
    import math

    def part(t, i):
        at = F.pmod(F.xxhash64(i), F.greatest(F.char_length(t) - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
        return F.substring(t, at, F.lit(SAMPLE_CHARS))

    sample, counts = labelled_sample(docs, labels, label, id, text, part, ~held_out(id), PER_LABEL)
    return train(sample), math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))


def score_quality(docs: DataFrame, net: ByteCNN | None, prior_logit: float, text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``.

    A null or empty text has the score of the labels' odds alone, and so has
    every text if nothing could be learned. Input columns named like an
    output column are replaced. Equal texts get equal scores.
    """
    for_workers(docs.sparkSession)
    own = without(docs, "score", "predicted")
    columns, at = own.columns, own.columns.index(text)
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType())])

    def score(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                p = np.full(part.num_rows, 1 / (1 + np.exp(-prior_logit))) if net is None \
                    else probabilities(net, part.column(at), prior_logit)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.round(p, 5))], [*columns, "score"])

    return own.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    net, odds = fit(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, net, odds).select("doc_id", held_out().alias("held_out"), "score", "predicted")
