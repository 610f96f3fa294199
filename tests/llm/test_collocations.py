import re
from collections import Counter

import numpy as np
import pytest

from seamstat.llm import collocations as C

from .conftest import SF


def plain_phrases(rows, least=10, depth=3):
    """(lang -> number of words, (lang, phrase) -> count) straight from the definition."""
    n, f = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return n, f


def plain_collocations(rows, least=10, depth=3, reported=2000, inside=50):
    n, f = plain_phrases(rows, least, depth)
    cand = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        if any(lang == l2 and len(q) > len(p) and 100 * b >= inside * a
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in cand.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        s, k = min(cuts)
        out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:reported], 1))


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def counted(found, keys):
    return {tuple(keys[:d, r].tolist()): w for r, d, w in zip(*(x.tolist() for x in found))}


@pytest.mark.parametrize("least", [1, 3])
def test_quicksort_counts_prefixes(least):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 900):
        keys = rng.integers(-1, 6, size=(3, n)).astype(np.int32)
        keys[0] = np.abs(keys[0])
        keys[2][keys[1] < 0] = -1
        weights = rng.integers(1, 4, size=n)
        want = Counter()
        for j in range(n):
            for d in range(1, 4):
                if keys[d - 1, j] < 0:
                    break
                want[tuple(keys[:d, j].tolist())] += int(weights[j])
        got = counted(C.equal_partitions(keys, weights, least), keys)
        assert got == {k: v for k, v in want.items() if v >= least}


TEXTS = [("en", "New York City is big. New York, new york! The York is new"), ("en", None), (None, "a b a b a b"),
         ("und", "a b c"), ("fr", ""), ("fr", "oui\toui oui  oui;oui oui"), ("en", "é É \x00 x")]


@pytest.mark.parametrize("depth,least", [(3, 2), (2, 1), (4, 2)])
def test_small_texts(spark, depth, least):
    df = spark.createDataFrame(TEXTS * 3, "lang string, text string").repartition(3)
    want = plain_collocations(TEXTS * 3, least, depth)
    assert rows_of(C.collocations(df, depth=depth, least=least)) == want and want


def test_many_blocks_and_buckets_give_the_same(spark, monkeypatch):
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    want = plain_collocations(docs)
    assert rows_of(C.collocations(df)) == want
    monkeypatch.setattr(C, "BUCKET_BYTES", 4000)
    counts = C.phrase_counts(df)
    n, f = plain_phrases(docs)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in counts.where("words > 0").collect()}
    assert got == {k: v for k, v in f.items() if v >= 10}
    assert {r["lang"]: r["f"] for r in counts.where("words = 0").collect()} == dict(n)


def test_report_ends_at_its_limit_with_ties(spark):
    rows = [("en", f"{a}{b} x{a}{b}") for a in "abcdefgh" for b in "abcdefgh"] * 10
    df = spark.createDataFrame(rows, "lang string, text string")
    got = rows_of(C.collocations(df, reported=7))
    assert [r[2] for r in got] == [f"a{b} xa{b}" for b in "abcdefg"]
    assert got == plain_collocations(rows, reported=7)


def test_score_is_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_019, 9_000_000_001, 8_999_999_993
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(C.score(df["a"], df["l"], df["r"])).first()[0] == 1_000_000 * a * a // (l * r)


def test_messy_documents(messy, messy_rows, no_docs):
    got = rows_of(C.collocations(messy, least=3))
    assert got == plain_collocations([(r["lang"], r["text"]) for r in messy_rows], least=3) and got
    empty = C.collocations(no_docs)
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_equals_its_sql(spark, duck):
    want = duck(SF).execute(C.ORACLE).fetchall()
    names = [d[0] for d in duck(SF).execute(C.ORACLE).description]
    place = [names.index(c) for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    assert rows_of(C.op12_collocations(spark, SF)) == sorted(tuple(r[i] for i in place) for r in want)
