"""Scores of the classifiers against one loop per document, with no arrays of
documents, windows or positions."""
import math

import numpy as np
import pytest

from seamstat.llm import langid, quality, toxicity

from .conftest import prose

TEXTS = ["", None, "a", "kurz", "é ü \U0001F600 ñ", prose(1, 6), prose(2, 40), prose(3, 200), prose(4, 9) + "\n" + prose(5, 70),
         "x" * 128, "y" * 129, "z" * 255, "w" * 256, "v" * 257, prose(6, 900)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)


def plain_toxicity(weights, bias, text):
    mask, z = 0xFFFFFFFF, bias
    if text:
        points = [ord(c) for c in " " + text.lower()]
        total, n = 0.0, 0
        for size in toxicity.SIZES:
            for i in range(len(points) - size + 1):
                h = points[i]
                for p in points[i + 1:i + size]:
                    h = (h * 0x01000193 + p) & mask
                h = ((h ^ (size * 0x9E3779B9 & mask)) * 0x9E3779B1) & mask
                h = ((h ^ (h >> 15)) * 0x85EBCA6B) & mask
                total += float(weights[h >> (32 - toxicity.BITS)])
                n += 1
        z += total / math.sqrt(max(n, 1))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def test_toxicity_scores(docs):
    weights = np.random.default_rng(1).normal(scale=0.2, size=1 << toxicity.BITS).astype(np.float32)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, weights, -0.3).collect()}
    for i, t in enumerate(TEXTS):
        assert abs(got[i] - plain_toxicity(weights, -0.3, t)) < 1e-4


def chunk_starts(n, width, step):
    """Starts of windows that cover ``n`` bytes; the last ends with them."""
    starts, at = [], 0
    while at + width < n:
        starts.append(at)
        at += step
    return [*starts, n - width]


def plain_quality(p, text, prior):
    raw = (text or "").encode()
    zs = []
    for s in chunk_starts(len(raw), quality.CHUNK, quality.STEP) if raw else []:
        chunk = [raw[i] if i >= 0 else 0 for i in range(s, s + quality.CHUNK)]
        top = []
        for f in range(quality.FILTERS):
            own = p["w"][:, f].reshape(quality.WIDTH, quality.EMBED)
            places = range(0, quality.CHUNK - quality.WIDTH + 1, quality.STRIDE)
            best = max(sum(float(own[k] @ p["e"][chunk[at + k]]) for k in range(quality.WIDTH)) for at in places)
            top.append(math.tanh(best + float(p["wb"][f])))
        hid = [math.tanh(sum(t * float(p["h"][i, j]) for i, t in enumerate(top)) + float(p["hb"][j]))
               for j in range(quality.HIDDEN)]
        zs.append(sum(h * float(o) for h, o in zip(hid, p["o"], strict=True)) + float(p["ob"][0]))
    z = (sum(zs) / len(zs) if zs else 0.0) + prior
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def test_quality_scores(docs):
    net = quality.train([(0, prose(7, 60)), (1, "spam " * 80), (0, prose(8, 30)), (1, "buy now " * 40)], steps=12)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, net, 0.4).collect()}
    for i, t in enumerate(TEXTS[:-1]):
        assert abs(got[i] - plain_quality(net.p, t, 0.4)) < 1e-4, i


def plain_language(net, text):
    """Mean probability of each label over the bytes of a text: both networks
    step over each window byte by byte."""
    p, raw = net.p, (text or "").encode()
    s = p["u"].shape[0]
    half, total, done = s // 2, [0.0] * len(net.labels), 0

    def sides(window, first):
        own = [first + i for i in range(half)]
        h, out = np.zeros(half), []
        x, u, b = (np.concatenate([m[..., g * s + first:g * s + first + half] for g in range(3)], axis=-1)
                   for m in (p["x"], p["u"][own], p["b"]))
        for byte in window:
            a, y = x[byte] + b, h @ u
            z, r = (np.clip(a[g * half:(g + 1) * half] + y[g * half:(g + 1) * half], -1, 1) / 2 + 0.5 for g in (0, 1))
            m = np.tanh(a[2 * half:] + r * y[2 * half:])
            h = m + z * (h - m)
            out.append(h)
        return out

    for start in chunk_starts(len(raw), langid.WINDOW, langid.WINDOW) if raw else []:
        window = [raw[i] if i >= 0 else 32 for i in range(start, start + langid.WINDOW)]
        ahead, back = sides(window, 0), sides(window[::-1], half)[::-1]
        for k in range(max(done - start, -start, 0), langid.WINDOW):
            z = np.concatenate([ahead[k], back[k]]) @ p["v"] + p["c"]
            e = np.exp(np.minimum(z, 30))
            total = [t + float(v) for t, v in zip(total, e / e.sum(), strict=True)]
        done = start + langid.WINDOW
    return [t / max(1, len(raw)) for t in total]


def test_language_scores(docs):
    net = langid.train([("a", prose(9, 60)), ("b", "der die das und nicht " * 20), ("c", "ñandú é ü " * 30)], steps=15)
    got = {r["doc_id"]: r for r in langid.identify(docs, net).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        if not any(c.isalpha() for c in t or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        mean = plain_language(net, t)
        assert abs(r["score"] - max(mean)) < 1e-4, i
        assert mean[net.labels.index(r["lang_pred"])] > max(mean) - 1e-4
