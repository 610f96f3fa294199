"""Near duplicates, exact search and the pipeline against brute force."""
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamstat.llm import neardup, topk

from .conftest import prose

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            linked = a and b and 100 * len(a & b) >= percent * len(a | b)
            if linked or rows[i][0] == rows[j][0]:
                up[top(i)] = top(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[top(i)] = min(low.get(top(i), k), k)
    return sorted((k, len(sets[i]), low[top(i)], k == low[top(i)]) for i, (k, _) in enumerate(rows))


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def copies(seed, groups=12, each=14):
    """Chains and stars of copies with a few words changed, plus exact ones."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(seed * 100 + g, r.choice([3, 12, 60, 140])).split()
        text = list(base)
        for _ in range(r.randint(1, each)):
            source = text if g % 2 else list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                source[r.randrange(len(source))] = f"new{r.randrange(10 ** 6)}"
            text = source
            rows.append(" ".join(text) if r.random() < 0.9 else " ".join(text).upper() + "\n")
    ids = list(range(len(rows)))
    r.shuffle(ids)
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("seed,small", [(1, 512), (2, 6), (3, 2)])
def test_components_against_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "LEVELS", 1 if small < 10 else 4)
    rows = copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(neardup.near_duplicates(df)) == brute(rows)


def edited(seed, pairs, n=300):
    """Pairs of texts of ``n`` shingles of which 30 differ: Jaccard 270 / 330."""
    rows = []
    for p in range(pairs):
        words = [f"{seed}w{p}x{k}" for k in range(n + 4)]
        other = list(words)
        for k in range(6):
            other[20 + 45 * k] = f"new{p}x{k}"
        rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(other))]
    return rows


def test_candidates_follow_the_bound(spark, messy):
    import corpus_pipeline as cp

    rows = edited(1, 1500)
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.80 < len(a & b) / len(a | b) < 0.85
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert neardup.near_duplicates(df).where("kept").count() == 3000
    assert neardup.near_duplicates(df, percent=80).where("kept").count() == 1500
    assert cp.one_of_each(spark, df, SF).count() == 1500
    assert cp.one_of_each(spark, df, SF, 85).count() == 3000
    # Signatures of pairs at a bound fall short of the agreement asked hardly ever.
    assert (neardup.agreement(85), neardup.trees(85)) == (90, 8)
    rng = np.random.default_rng(3)
    for percent in (85, 80, 70, 50):
        same = rng.binomial(neardup.SIGNATURE, percent / 100, size=200_000)
        assert (same < neardup.agreement(percent)).mean() < 5e-5 and neardup.trees(percent) >= neardup.trees(85)


@pytest.mark.parametrize("percent", [80, 60])
def test_components_at_other_bounds(spark, percent):
    rows = copies(4, groups=20)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(neardup.near_duplicates(df, percent=percent)) == brute(rows, percent)


def test_pairs_that_meet_in_blocks_only(spark, monkeypatch):
    """One tree, no branching and small cells: partners lie in other blocks."""
    monkeypatch.setattr(neardup, "trees", lambda percent: 1)
    monkeypatch.setattr(neardup, "LEVELS", 0)
    monkeypatch.setattr(neardup, "SMALL", 8)
    sh, hot = neardup.Shingler(1), prose(5, 30)

    def least(t):
        return sh.minima(sh.shingles(np.frombuffer(t.encode(), np.uint8)))[0]

    # Unlike documents whose minwise token is in the shared sentence, each with one near copy.
    pairs = [(f"{hot} {body} end", f"{hot} {body} stop{k}") for k, body in
             ((k, prose(900 + k, 40).replace(" ", f"{k} ")) for k in range(1000))]
    pairs = [p for p in pairs if least(p[0]) == least(p[1]) == least(hot)][:60]
    assert len(pairs) == 60
    rows = [(2 * k + i, t) for k, p in enumerate(pairs) for i, t in enumerate(p)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(neardup.near_duplicates(df)) == brute(rows)


def test_near_duplicates_of_awkward_rows(messy, no_docs, messy_rows):
    out = neardup.near_duplicates(messy).collect()
    null = -1 << 63
    want = brute([(null if r["doc_id"] is None else r["doc_id"], r["text"]) for r in messy_rows])
    have = sorted((null if r["doc_id"] is None else r["doc_id"], r["n_shingles"],
                   null if r["component_id"] is None else r["component_id"], r["kept"]) for r in out)
    assert have == want
    assert neardup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("same_id", [None, 3])
def test_rows_of_one_id_are_documents_of_their_own(spark, messy, same_id):
    import corpus_pipeline as cp

    texts = [prose(700 + k, 60) for k in range(40)]
    rows = [(same_id, t) for t in texts] + [(100, texts[0] + " more"), (101, texts[1] + " more"), (same_id, texts[2]),
                                            (same_id, None), (same_id, " "), (102, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes = neardup.grouped(df).where("component IS NOT NULL").groupBy("component").count().collect()
    assert sorted(r["count"] for r in sizes) == [1] * 36 + [2] * 4
    kept = sorted((r["text"] or "", r["doc_id"] or -1) for r in cp.one_of_each(spark, df, SF).collect())
    assert kept == sorted([*((t, same_id or -1) for t in texts), ("", same_id or -1), (" ", same_id or -1)])


def test_shingle_hashes_tell_texts_apart():
    sh = neardup.Shingler()
    texts = ["a b c d e", "a b c d f", "b a c d e", "a b c d", "a b c", "a", "b", "ab", "a b", "ab c d e f", "a bc d e f",
             "a\0b c d e f", "É b c d e", "é b c d e"]
    keys = [sh.set_key(sh.shingles(np.frombuffer(t.encode(), np.uint8))) for t in texts]
    assert len(set(keys)) == len(texts)
    again = sh.shingles(np.frombuffer(b"  A\tB\x0b\x0cC d E\r\n", np.uint8))
    assert sh.set_key(again) == keys[0] and len(again) == 1
    assert len(sh.shingles(np.frombuffer(b" \t\n", np.uint8))) == 0
    # A word of two letters in the pattern that cancels in polynomials modulo powers of two.
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    long = [thue, thue.translate(str.maketrans("ab", "ba")), thue[::-1] + "a", "a" * 1024, "a" * 1023 + "b", "b" + "a" * 1023]
    assert len({int(sh.words(np.frombuffer(w.encode(), np.uint8))[0]) for w in long}) == len(long)


def test_words_that_differ_in_a_pattern_are_not_linked(spark):
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    other = thue.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{thue} b c d e f"), (2, f"{other} b c d e f"), (3, thue), (4, other), (5, thue.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(neardup.near_duplicates(df)) == brute(rows)


def test_words_alone_hash_as_they_do_in_a_text():
    sh = neardup.Shingler()
    r = random.Random(2)
    words = ["".join(r.choice("abcXYZ") for _ in range(r.choice([1, 3, 31, 32, 33, 90]))) for _ in range(200)]
    whole = sh.words(np.frombuffer(" ".join(words).encode(), np.uint8))
    assert whole.tolist() == [int(sh.words(np.frombuffer(w.lower().encode(), np.uint8))[0]) for w in words]


def test_forest_joins_once():
    assert neardup.forest(4, [0, 1, 0, 2], [1, 2, 2, 3]) == [0, 1, 3]


@pytest.mark.parametrize("edges_here", [200_000, 10])
def test_components_of_a_long_chain(spark, monkeypatch, edges_here):
    monkeypatch.setattr(neardup, "LOCAL_EDGES", edges_here)
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    out = {r["doc"]: r["label"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, n)}, 1001: 1000, 1002: 1000}


def brute_top(rows, k, step, scale=64):
    use = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            use.setdefault((i, tuple(int(np.floor(scale * float(x))) for x in v)), None)
    out = []
    for q, qv in use:
        if q % step == 0:
            s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in use if i != q)
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed,kw", [(0, {}), (1, dict(shard_rows=30, query_block=3, shards_per_group=2)),
                                     (2, dict(shard_rows=64, query_block=100, shards_per_group=1))])
def test_search_against_brute_force(spark, monkeypatch, seed, kw):
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = np.random.default_rng(seed)
    vec = rng.normal(size=(260, 6)).astype(np.float32)
    vec[100:160] = vec[100]                 # one vector many times
    vec[200:220] = np.round(vec[200:220])   # ties
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vec)]
    rows += [(None, rows[0][1]), (300, None), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (340, [float("nan")] * 6),
             (360, [float("inf")] + [0.0] * 5), (380, [0.0] * 6), (40, rows[40][1]), (-20, [3.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, "own", 1.5) for r in rows],
                               "vec_id long, embedding array<float>, query_id string, score double").repartition(4)
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, **kw).collect())
    assert out == brute_top(rows, 20, 20)


def test_search_of_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (20, [0.5])], schema)
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df).collect())
    assert out == [(0, 1, 1, 8192), (0, 2, 20, 2048), (20, 1, 1, 4096), (20, 2, 0, 2048)]
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 1")).count() == 0


@pytest.mark.parametrize("kw", [{}, dict(shard_rows=8, query_block=2, shards_per_group=1)])
def test_rows_of_one_id_are_queries_of_their_own(spark, kw):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(40)]
    rows += [(0, [2.0, 0.0, 1.0]), (0, [2.0, 0.0, 1.0]), (20, [0.0, -3.0, 0.0]), (7, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, **kw).collect())
    assert out == brute_top(rows, 20, 20) and len(out) == 4 * 20


def test_components_beyond_exact_scores_raise(spark):
    schema = "vec_id long, embedding array<double>"
    with pytest.raises(Exception, match="too large for exact"):
        topk.top_k(spark.createDataFrame([(0, [1e300, 0.0]), (1, [1.0, 1.0])], schema)).collect()
    near = [(0, [2.0 ** 23, -(2.0 ** 23)]), (1, [2.0 ** 23, 2.0 ** 23 - 1.0]), (2, [1.0, 0.0])]
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in
                 topk.top_k(spark.createDataFrame(near, schema)).collect())
    assert out == brute_top(near, 20, 20)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline_stages_on_awkward_rows(spark, messy, no_docs, messy_rows):
    import corpus_pipeline as cp

    docs = messy
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, no_docs, SF).count() == 0, name
        docs = out.cache()
    last = cp.STAGES[-1][1]
    assert last(spark, no_docs, SF).count() == 0
    assert last(spark, messy, SF).where("piece = 0").count() == len(messy_rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline_stages_keep_what_they_should(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = cp.one_of_each(spark, docs, SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, _, _, own in brute(rows, 80) if own]
    spoken = cp.language(spark, docs, SF).count()
    assert spoken >= 0.97 * len(rows)
    mixed = cp.mixed(spark, docs, SF)
    words = mixed.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert 0.5 < words / sum(len((t or "").split()) for _, t in rows) < 1.5
    out = cp.run(spark, SF)
    assert out.count() > 0 and out.columns[:2] == ["doc_id", "piece"]
