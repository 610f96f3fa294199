"""Classifiers: gradients, held-out accuracy and awkward input."""
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seamstat.llm import byteops, langid, quality, toxicity

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def numeric(loss, p, key, at, eps=1e-3):
    old = p[key][at]
    p[key][at] = old + eps
    up = loss()
    p[key][at] = old - eps
    down = loss()
    p[key][at] = old
    return (up - down) / (2 * eps)


def test_recurrent_gradients():
    rng = np.random.default_rng(1)
    net = langid.ByteGRU(["a", "b", "c"], {k: v.astype(np.float64) for k, v in langid.ByteGRU.initial(3, 3).items()})
    seq, target = rng.integers(97, 101, size=(7, 4)), rng.integers(3, size=4)
    mask = np.ones((7, 4))
    mask[:3, 0] = 0
    _, g = net.gradients(seq, target, mask)
    for key in ("x", "u", "v", "c", "b"):
        flat = np.argwhere(np.abs(g[key]) > 1e-4)
        for at in flat[rng.permutation(len(flat))[:6]]:
            # States are kept in single precision, hence the tolerance.
            n = numeric(lambda: net.gradients(seq, target, mask)[0], net.p, key, tuple(at))
            assert abs(n - g[key][tuple(at)]) < 2e-2 * max(0.05, abs(n))


def test_convolution_gradients():
    rng = np.random.default_rng(2)
    net = quality.ByteCNN({k: v.astype(np.float64) for k, v in quality.ByteCNN.initial().items()})
    chunks = rng.integers(97, 110, size=(5, quality.CHUNK))
    group, target = np.array([0, 0, 1, 2, 2]), np.array([1.0, 0.0, 1.0])
    _, g = net.gradients(chunks, group, 3, target)
    for key in ("w", "wb", "h", "hb", "o", "ob", "e"):
        flat = np.argwhere(np.abs(g[key]) > 1e-3)
        for at in flat[rng.permutation(len(flat))[:5]]:
            n = numeric(lambda: net.gradients(chunks, group, 3, target)[0], net.p, key, tuple(at), 1e-5)
            assert abs(n - g[key][tuple(at)]) < 3e-2 * max(0.01, abs(n))


@pytest.mark.parametrize("sizes", [[0, 1, 127, 128, 129, 300], [], [0, 0]])
@pytest.mark.parametrize("width,step", [(128, 128), (256, 192)])
def test_windows_cover_every_byte(sizes, width, step):
    off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    text, start, fresh = byteops.windows(off, width, step)
    seen = np.zeros(off[-1], int)
    for t, s in zip(text, start, strict=True):
        assert s + width <= off[t + 1] or sizes[t] < width
        seen[max(s, off[t]):s + width] += 1
    assert (seen >= 1).all()
    if width == step:
        new = np.zeros(off[-1], int)
        for t, s, f in zip(text, start, fresh, strict=True):
            new[max(off[t], s + width - f):s + width] += 1
        assert (new == 1).all()


def test_text_bytes_of_slices():
    col = pa.array(["skip", "é", None, "", "ab"]).slice(1)
    raw, off = byteops.text_bytes(col)
    assert raw.tobytes() == "éab".encode() and off.tolist() == [0, 2, 2, 2, 4]


def test_ngrams_do_not_depend_on_pieces(monkeypatch):
    text = "The quick bröwn 😀 fox. " * 40
    whole = np.sort(np.concatenate(list(toxicity.buckets(text))))
    monkeypatch.setattr(toxicity, "PIECE", 37)
    assert (np.sort(np.concatenate(list(toxicity.buckets(text)))) == whole).all()


def test_short_text_does_not_see_its_neighbour():
    net = langid.train([("a", "aab aba baa " * 20), ("b", "xyz zyx yxz " * 20)], steps=60)
    alone = langid.predict_batch(net, pa.array(["aab"]))
    beside = langid.predict_batch(net, pa.array(["zzz zzz " * 50, "aab", "", "xyz " * 100]))
    assert alone[0][0] == beside[0][1] and abs(alone[1][0] - beside[1][1]) < 1e-6
    cnn = quality.ByteCNN(quality.ByteCNN.initial())
    one = quality.probabilities(cnn, pa.array(["abc"]))[0]
    assert abs(one - quality.probabilities(cnn, pa.array(["x" * 900, "abc", None]))[1]) < 1e-6


@needs_data
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    truth = docs.select("doc_id", "lang", "text").toPandas().set_index("doc_id")
    own = {f: f(spark, SF).toPandas().set_index("doc_id") for f in
           (langid.op5_langid, quality.op7_quality, toxicity.op4_toxicity)}
    for f, got in own.items():
        assert len(got) == len(truth) and got.score.between(0, 1).all()
        mod = 3 if f is langid.op5_langid else 4
        assert (got.held_out == [zlib.crc32(str(i).encode()) % mod == (1 if mod == 3 else 2) for i in got.index]).all()
    lang = own[langid.op5_langid]
    held = lang[lang.held_out]
    assert (held.lang_pred == truth.lang[held.index]).mean() > 0.97
    for f, label, least in ((quality.op7_quality, "quality", 0.93), (toxicity.op4_toxicity, "toxic", 0.88)):
        held = own[f][own[f].held_out].join(labels, how="inner")
        assert ((held.predicted == held[label]).mean()) > least
        assert (own[f].predicted == (own[f].score >= (0.7 if label == "quality" else 0.3))).all()


def test_language_of_awkward_rows(messy, no_docs, messy_rows):
    net = langid.fit(messy)
    got = langid.identify(messy, net).select("doc_id", "text", "lang_pred", "score", "size").collect()
    assert len(got) == len(messy_rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1 and r["size"] == "own size"
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (0, 1)}) == 1
    assert langid.identify(no_docs, net).count() == 0
    assert langid.fit(no_docs) is None
    unknown = langid.identify(messy, None).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in unknown] == [("und", 0.0)]


@pytest.mark.parametrize("module,score", [(quality, quality.score_quality), (toxicity, toxicity.score_toxicity)])
def test_scores_of_awkward_rows(spark, messy, no_docs, messy_rows, module, score):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2, "own") for i in range(12)] + [(3, None, None, "own"), (None, 1, 1, "own"), (5, 0, 0, "own")],
        "doc_id long, quality int, toxic int, text string")
    model = module.fit(messy, labels)
    got = score(messy, *model).select("doc_id", "text", "score", "predicted", "size").collect()
    assert len(got) == len(messy_rows) and all(0 <= r["score"] <= 1 and r["size"] == "own size" for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1)}) == 1
    assert score(no_docs, *model).count() == 0
    nothing = module.fit(no_docs, labels.limit(0))
    assert nothing[0] is None and score(messy, *nothing).count() == len(messy_rows)


def test_long_labelled_texts_are_learned_from(spark):
    """Every labelled text is longer than what is learned of one, and the words
    that tell the labels apart lie at its end or in its middle."""
    r = random.Random(6)
    calm, rude = "river stone maple quiet window".split(), "grub snarl vex spite gnash".split()
    rows, labels = [], []
    for i in range(120):
        y = i % 2
        text = [r.choice(calm) for _ in range(6000)]
        at = 5900 if i % 3 else 2500
        text[at:at + 100] = [r.choice(rude if y else calm) for _ in range(100)]
        rows.append((i, " ".join(text)))
        labels.append((i, y))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert min(len(t) for _, t in rows) > toxicity.SAMPLE_CHARS
    weights, bias = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert weights is not None
    tests = [(0, " ".join(rude * 5)), (1, " ".join(calm * 5))]
    got = {q["doc_id"]: q["score"] for q in toxicity.score_toxicity(
        spark.createDataFrame(tests, "doc_id long, text string"), weights, bias).collect()}
    assert got[0] > 0.7 > 0.3 > got[1]


def test_windows_of_a_long_text(spark):
    n = toxicity.SAMPLE_CHARS
    texts = ["a" * n, "a" * 10 + "b" * n + "c" * 10, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(toxicity.windowed(F.col("t"))).collect()]
    assert got[0] == texts[0] and got[2] == ""
    assert len(got[1]) == n + toxicity.WINDOWS - 1 and got[1].startswith("a" * 10 + "b") and got[1].endswith("b" + "c" * 10)


def test_one_row_is_learned_from_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(3, "other"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    rows, counts = byteops.labelled_rows(docs, labels, "toxic", "doc_id", "text", lambda t, _: t, F.lit(True), 10)
    assert sorted(r["l_label"] for r in rows.collect()) == [0, 1] and counts == {0: 1, 1: 1}


def test_labels_that_disagree_are_left_out(spark, messy):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (1, 1), (2, 2), (7, 0), (99, 1), (None, 1)],
                                   "doc_id long, quality int")
    sample, counts = byteops.labelled_sample(messy, labels, "quality", "doc_id", "text", lambda _, i: i.cast("string"),
                                             ~quality.held_out(), 50)
    train = {k: v for k, v in {1: 1, 7: 0, 99: 1}.items() if zlib.crc32(str(k).encode()) % 4 != 2}
    assert sorted(sample) == sorted((v, str(k)) for k, v in train.items() if k != 99)
    assert counts == {v: list(train.values()).count(v) for v in set(train.values())}


def test_sample_is_bounded_and_stratified(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 50 == 0, "rare").when(
        F.col("id") % 7 != 0, "often").alias("label"))
    rows = byteops.stratified_sample(df, "label", [F.col("id")], F.col("id"), 80, 5)
    by = {k: sum(r["label"] == k for r in rows) for k in ("rare", "often")}
    assert 50 <= by["rare"] <= 110 and 50 <= by["often"] <= 110 and len(rows) == sum(by.values())


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 2)
    rows = [(None if k == 150 else 1000 * k + j, f"l{k}", f"text {k} {j}") for k in range(151)
            for j in range(1 if k % 10 == 0 else 30)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    train = {lang for i, lang, _ in rows if i is None or zlib.crc32(str(i).encode()) % 3 != 1}
    monkeypatch.setattr(langid, "PER_LANG", 8)
    drawn = langid.training_rows(df, "doc_id", "text", "lang", ~langid.held_out())
    assert {r["label"] for r in drawn} == train and len(train) > 64
    assert len(drawn) <= 2 * 8 * 64
    assert langid.train([(r["label"], r["part"]) for r in drawn], steps=2).labels == sorted(train)
