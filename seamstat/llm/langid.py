"""Language identification by a bidirectional gated recurrent network.

The network reads bytes in windows, forwards and backwards, labels every
position with a language, and a document's probabilities are the mean of its
positions' probabilities. It is trained in numpy by backpropagation through
time on windows of a bounded sample of labelled documents; every document is
then read whole, window by window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .byteops import stratified_sample
from .common import crc_mod, for_workers, free_name, read_table, without

WINDOW = 128            # bytes a recurrent state runs over
HIDDEN = 8              # units a direction
BLOCK = 512             # windows computed together
PER_LANG = 800          # bound of the sample: documents a language ...
FULL_LANGS = 64         # ... fewer with more languages than this, all are learned ...
SAMPLE_CHARS = 2_000    # ... and characters drawn from each document
STEPS, BATCH, TRAIN_WINDOW, RATE = 700, 128, 48, 0.02
UNDETERMINED = "und"


class ByteGRU:
    """Both directions side by side: a state of 2 * hidden units with a
    block-diagonal recurrent matrix. Gates use the hard sigmoid
    ``clip(x, -1, 1) / 2 + 1/2``; the candidate uses tanh."""

    def __init__(self, labels, params):
        self.labels, self.p = list(labels), params

    @staticmethod
    def initial(n_labels: int, hidden: int = HIDDEN, seed: int = 7):
        import numpy as np

        rng, s = np.random.default_rng(seed), 2 * hidden
        u = np.zeros((s, 3 * s), np.float32)
        for g in range(3):
            for d in range(2):
                q, _ = np.linalg.qr(rng.normal(size=(hidden, hidden)))
                u[d * hidden:(d + 1) * hidden, g * s + d * hidden:g * s + (d + 1) * hidden] = 0.8 * q
        return {"x": rng.normal(scale=0.4, size=(256, 3 * s)).astype(np.float32), "u": u,
                "b": np.zeros(3 * s, np.float32),
                "v": rng.normal(scale=0.3, size=(s, n_labels)).astype(np.float32),
                "c": np.zeros(n_labels, np.float32)}

    def states(self, seq, keep=False):
        """``seq`` (steps, n) bytes -> states (steps, n, 2 * hidden), the
        backward half at the position it has just read."""
        import numpy as np

        p, steps, n = self.p, *seq.shape
        s = p["u"].shape[0]
        half = s // 2
        fwd = np.tile(np.repeat([True, False], half), 3)
        xf, xb = (np.where(m, p["x"] + p["b"], 0).astype(np.float32) for m in (fwd, ~fwd))
        h = np.zeros((n, s), np.float32)
        out = np.empty((steps, n, s), np.float32)
        tape = []
        a, y = np.empty((n, 3 * s), np.float32), np.empty((n, 3 * s), np.float32)
        for t in range(steps):
            np.take(xf, seq[t], axis=0, out=a, mode="clip")
            np.take(xb, seq[steps - 1 - t], axis=0, out=y, mode="clip")
            a += y
            np.matmul(h, p["u"], out=y)
            g = a[:, :2 * s] + y[:, :2 * s]
            np.clip(g, -1, 1, out=g)
            g *= 0.5
            g += 0.5
            z, r = g[:, :s], g[:, s:]
            m = r * y[:, 2 * s:]
            m += a[:, 2 * s:]
            np.tanh(m, out=m)
            new = h - m
            new *= z
            new += m
            if keep:
                tape.append((h, z, r, y[:, 2 * s:].copy(), m))
            h = new
            out[t, :, :half] = h[:, :half]
            out[steps - 1 - t, :, half:] = h[:, half:]
        return (out, tape) if keep else out

    def probabilities(self, seq):
        """(steps, n, labels) probabilities of every position."""
        import numpy as np

        out = self.states(seq)
        z = out.reshape(-1, out.shape[2]) @ self.p["v"]
        z += self.p["c"]
        np.exp(np.minimum(z, 30, out=z), out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z.reshape(*seq.shape, -1)

    def gradients(self, seq, target, mask):
        """Loss and gradients of the masked mean cross-entropy by position."""
        import numpy as np

        p, (steps, n) = self.p, seq.shape
        s = p["u"].shape[0]
        half = s // 2
        out, tape = self.states(seq, keep=True)
        z = out @ p["v"] + p["c"]
        z -= z.max(axis=2, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(axis=2, keepdims=True)
        share = mask / mask.sum()
        loss = -(np.log(prob[:, np.arange(n), target] + 1e-9) * share).sum()
        prob[:, np.arange(n), target] -= 1
        dz = (prob * share[:, :, None]).astype(np.float32)
        g = {"v": out.reshape(-1, s).T @ dz.reshape(-1, dz.shape[2]), "c": dz.sum(axis=(0, 1)),
             "u": np.zeros_like(p["u"]), "x": np.zeros_like(p["x"])}
        dout = dz @ p["v"].T
        dh = np.zeros((n, s), np.float32)
        fwd = np.tile(np.repeat([True, False], half), 3)
        for t in reversed(range(steps)):
            h, zg, r, yn, m = tape[t]
            dh[:, :half] += dout[t, :, :half]
            dh[:, half:] += dout[steps - 1 - t, :, half:]
            dm = dh * (1 - zg) * (1 - m * m)
            da = np.concatenate([dh * (h - m) * 0.5 * ((zg > 0) & (zg < 1)),
                                 dm * yn * 0.5 * ((r > 0) & (r < 1)), dm], axis=1)
            dy = da.copy()
            dy[:, 2 * s:] = dm * r
            g["u"] += h.T @ dy
            np.add.at(g["x"], seq[t], np.where(fwd, da, 0))
            np.add.at(g["x"], seq[steps - 1 - t], np.where(fwd, 0, da))
            dh = dh * zg + dy @ p["u"].T
        g["b"] = g["x"].sum(axis=0)
        g["u"] *= p["u"] != 0
        return loss, g


def train(samples, seed: int = 11, steps: int = STEPS) -> ByteGRU | None:
    """Fit on (label, text) pairs, classes drawn evenly; with more than
    FULL_LANGS classes in more steps, so that none is read less. None without
    any pair."""
    import numpy as np

    by: dict[str, list[bytes]] = {}
    for label, text in samples:
        if text and text.strip():
            by.setdefault(label, []).append(text.encode("utf-8"))
    labels = sorted(by)
    if not labels:
        return None
    steps = steps * max(len(labels), FULL_LANGS) // FULL_LANGS
    net = ByteGRU(labels, ByteGRU.initial(len(labels)))
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        target = rng.integers(len(labels), size=BATCH)
        seq = np.full((TRAIN_WINDOW, BATCH), 32, np.uint8)
        mask = np.zeros((TRAIN_WINDOW, BATCH), np.float32)
        for i, k in enumerate(target):
            own = by[labels[k]]
            raw = own[rng.integers(len(own))]
            at = rng.integers(max(1, len(raw) - TRAIN_WINDOW + 1))
            part = np.frombuffer(raw[at:at + TRAIN_WINDOW], np.uint8)
            seq[TRAIN_WINDOW - len(part):, i] = part
            mask[TRAIN_WINDOW - len(part):, i] = 1
        _, g = net.gradients(seq, target, mask)
        rate = RATE * min(1.0, 3 * (1 - step / (steps + 1)))
        for k in net.p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.99 * v2[k] + 0.01 * g[k] ** 2
            net.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                         / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def predict_batch(net: ByteGRU, column):
    """(label index, probability) of each text of an Arrow string column."""
    import numpy as np

    from .byteops import text_bytes, windows

    raw, offsets = text_bytes(column)
    # Texts before the first byte read as spaces, as in training.
    raw = np.concatenate([np.full(WINDOW, 32, np.uint8), raw])
    text, start, fresh = windows(offsets, WINDOW, WINDOW)
    own = np.diff(offsets)
    total = np.zeros((len(own), len(net.labels)))
    at = np.arange(WINDOW)
    block = max(1, BLOCK * FULL_LANGS // max(len(net.labels), FULL_LANGS))
    for i in range(0, len(text), block):
        t, s, f = text[i:i + block], start[i:i + block], fresh[i:i + block]
        seq = raw[(s + WINDOW)[None, :] + at[:, None]]
        # A short text's window reaches before it: not its neighbour's bytes.
        new = at[:, None] >= WINDOW - np.minimum(f, own[t])[None, :]
        short = own[t] < WINDOW
        if short.any():
            seq[:, short] = np.where(at[:, None] >= WINDOW - own[t][short][None, :], seq[:, short], 32)
        p = net.probabilities(seq)
        np.add.at(total, t, np.einsum("tnl,tn->nl", p, new.astype(np.float32)))
    mean = total / np.maximum(own, 1)[:, None]
    best = mean.argmax(axis=1)
    return best, mean[np.arange(len(best)), best]


def training_rows(docs: DataFrame, id: str, text: str, lang: str, train_if) -> list:
    n = F.char_length(F.col(f"`{text}`"))
    at = F.pmod(F.xxhash64(F.col(f"`{id}`")), F.greatest(n - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    part = F.substring(F.col(f"`{text}`"), at, F.lit(SAMPLE_CHARS))
    own = docs.where(F.coalesce(train_if, F.lit(False)) & F.col(f"`{text}`").rlike(r"\p{L}"))
    key = F.coalesce(F.col(f"`{id}`").cast("string"), F.xxhash64(F.col(f"`{text}`")).cast("string"))
    return stratified_sample(own, lang, [part.alias("part")], key, PER_LANG, FULL_LANGS)


def identify(docs: DataFrame, net: ByteGRU | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    A null text, or one without any letter, is ``und`` with score 0; so is
    every text if nothing could be learned (no labelled row). Input columns
    named like an output column are replaced. Equal texts get equal labels.
    """
    for_workers(docs.sparkSession)
    own = without(docs, "lang_pred", "score")
    flag = free_name(own.columns, "has_letter")
    given = own.withColumn(flag, F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)))
    columns, at = own.columns, own.columns.index(text)
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def label(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                letters = part.column(len(columns)).to_numpy(zero_copy_only=False).astype(bool)
                names, score = np.full(part.num_rows, UNDETERMINED, dtype=object), np.zeros(part.num_rows)
                if net is not None:
                    best, p = predict_batch(net, part.column(at))
                    names[letters] = np.array(net.labels, dtype=object)[best[letters]]
                    score[letters] = np.round(p[letters], 5)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(columns)], pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    [*columns, "lang_pred", "score"])

    return given.mapInArrow(label, schema)


def held_out(id: str = "doc_id"):
    return F.coalesce(crc_mod(F.col(f"`{id}`"), 3) == 1, F.lit(False))


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteGRU | None:
    rows = training_rows(docs, id, text, lang, ~held_out(id))
    return train([(r["label"], r["part"]) for r in rows])


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = fit(docs.select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
