"""Sharding, fingerprints and mixing: SQL, brute force and awkward input."""
import hashlib
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seamstat.llm import merkle, mixing, sharding
from seamstat.llm.queries import ORACLE, QUERIES

from .conftest import SF

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def same_rows(got, want):
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = [sorted(map(tuple, x[cols].astype(object).where(x[cols].notna(), None).values.tolist()), key=repr)
            for x in (got, want)]
    assert rows[0] == rows[1]


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    same_rows(QUERIES[name](spark, SF).toPandas(), duck(SF).execute(ORACLE[name]).df())


def md60(x):
    return int(hashlib.md5(x.encode()).hexdigest()[:15], 16)


def test_lookup_table_follows_turns(spark):
    shards, slots = ("red", "green", "blue"), 13
    prefs = {s: [(md60(f"{s}:offset") % slots + i * (md60(f"{s}:skip") % (slots - 1) + 1)) % slots for i in range(slots)]
             for s in shards}
    owner = {}
    while len(owner) < slots:
        for s in shards:
            if len(owner) < slots:
                owner[next(p for p in prefs[s] if p not in owner)] = s
    got = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, shards, slots).collect()}
    assert got == owner
    assert max(Counter(got.values()).values()) - min(Counter(got.values()).values()) <= 1


def test_lookup_table_moves_little(spark):
    names = [f"n{i}" for i in range(10)]
    before, after = ({r["slot"]: r["shard"] for r in sharding.lookup_table(spark, n, 1009).collect()}
                     for n in (names, names[:-1]))
    moved = sum(before[s] != after[s] for s in before if before[s] != "n9")
    assert moved < 0.15 * len(before)


@pytest.mark.parametrize("shards,slots", [(("a", "a"), 7), (("a",), 8), ((), 7), (("a",) * 8, 7)])
def test_lookup_table_refuses(spark, shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, shards, slots)


def test_placement_of_awkward_rows(messy, no_docs, messy_rows):
    got = sharding.place(messy).select("doc_id", "slot", "shard", "size").collect()
    assert len(got) == len(messy_rows) and all(r["shard"].startswith("shard-") for r in got)
    assert len({r["slot"] for r in got if r["doc_id"] == 10}) == 1
    assert all(r["size"] == "own size" for r in got)
    assert sharding.place(no_docs).count() == 0


def test_write_shards_keeps_all_rows(spark, messy, messy_rows, tmp_path):
    own = messy.select("doc_id", "text")
    sharding.write_shards(own, str(tmp_path / "s"), files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(messy_rows)


def py_tree(text):
    import re
    out = []
    for sec in [s for s in re.split(r"(?<=\n\n)", text) if s]:
        paragraphs = []
        for par in [p for p in re.split(r"(?<=\n)", sec) if p]:
            leaves, at, n = [], 0, 4
            for n in (4, 4, 8, 16, 32):
                if at < len(par):
                    leaves.append(par[at:at + n])
                    at += n
            while at < len(par):
                leaves.append(par[at:at + 64])
                at += 64
            paragraphs.append([hashlib.md5(x.encode()).hexdigest() for x in leaves])
        out.append(paragraphs)
    return out


def py_fingerprint(text):
    t = py_tree(text)
    md = lambda x: hashlib.md5(x.encode()).hexdigest()
    root = md("/".join(md(";".join(md(",".join(p)) for p in s)) for s in t))
    return root + ":" + "/".join(";".join(",".join(h[:6] for h in p) for p in s) for s in t)


def test_fingerprints_against_brute_force(messy, messy_rows):
    got = merkle.fingerprints_with_edits(messy, range_rows=3).collect()
    rows = [r for r in messy_rows if r["doc_id"] not in (9, None)]
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(messy_rows)
    for r in rows:
        g, text = by_id[r["doc_id"]], r["text"] or ""
        assert g["n_chars"] == len(text) and g["fingerprint"] == py_fingerprint(text)
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1
    # In descending order 2 comes before 1, 1 before 0, and the null id is last.
    text = {r["doc_id"]: r["text"] or "" for r in rows}
    for a, b in ((2, 1), (1, 0), (8, 7), (4, 3), (7, 6)):
        half = len(text[a]) // 2
        edited = text[a][:len(text[a]) - half] + text[b][:half]
        assert by_id[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[a]["edited_fingerprint"] == py_fingerprint(edited)
    last = text[0][:len(text[0]) - len(text[0]) // 2]
    after = next(r["text"] for r in messy_rows if r["doc_id"] is None)
    assert by_id[0]["edited_sha256"] == hashlib.sha256((last + after[:len(text[0]) // 2]).encode()).hexdigest()
    first = "tail퟿ \U0001F600 smile\n\n\nend"
    null = next(r for r in got if r["doc_id"] is None)
    half = len(after) // 2
    assert null["edited_sha256"] == hashlib.sha256((after[:len(after) - half] + first[:half]).encode()).hexdigest()
    assert by_id[1]["near_next"] == 1.0 and by_id[1]["fingerprint"] == by_id[0]["fingerprint"]
    assert by_id[2]["near_next"] > 0.8 and by_id[7]["near_edited"] > 0.4


def shared_ids(spark, n=240):
    """A third of the rows without an id, a third with one id, all texts unlike."""
    ids = [None] * n + [7] * n + list(range(1000, 1000 + n // 2)) + list(range(-n // 2, 0))
    rows = [(i, f"text {k} {k * 7919 % 1000003}") for k, i in enumerate(ids)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_rows_that_share_an_id_are_spread_and_in_order(spark):
    rows, df = shared_ids(spark)
    tied = df.withColumn("tie", F.xxhash64("text"))
    sizes = [r["count"] for r in tied.groupBy(merkle.id_ranges(tied, "doc_id", "tie", 20).alias("r")).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 4 * 20
    tie = {r["text"]: r["tie"] for r in tied.collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]), reverse=True)
    got = {r["edited_sha256"] for r in merkle.fingerprints_with_edits(df, range_rows=20).collect()}
    want = set()
    for (_, a), (_, b) in zip(order, order[1:] + order[:1]):
        half = len(a) // 2
        want.add(hashlib.sha256((a[:len(a) - half] + b[:half]).encode()).hexdigest())
    assert got == want


def test_mix_of_rows_that_share_an_id(spark, monkeypatch):
    rows, df = shared_ids(spark)
    df = df.withColumn("source", F.lit("one"))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    monkeypatch.setattr(mixing, "HASH_RANGE_BITS", 1)
    assert mixing.range_bits(len(rows)) == 6 and mixing.range_bits(0) == 1
    out = mixing.systematic_mix(df, weights=(1,), max_repeat=3)
    got = out.agg(F.sum("taken"), F.max("target")).first()
    assert abs(got[0] - got[1]) <= 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "MapInArrow" not in plan
    again = sorted(map(tuple, mixing.systematic_mix(df.repartition(2), weights=(1,)).select("text", "taken").collect()))
    assert again == sorted(map(tuple, out.select("text", "taken").collect()))
    # A hash range of the line holds about as many rows as any other.
    key = mixing.hash60(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5("text")))
    sizes = [r["count"] for r in df.groupBy(F.shiftright(key, 60 - 6)).count().collect()]
    assert max(sizes) <= 4 * len(rows) / 64


def test_fingerprint_of_no_rows_and_one_row(no_docs, messy):
    assert merkle.fingerprints_with_edits(no_docs).count() == 0
    one = merkle.fingerprints_with_edits(messy.where("doc_id = 2")).first()
    assert one["near_next"] == 1.0


def test_edited_branches(spark):
    a, b = "one\ntwo\n\nthree\nfour\n", "one\ntwo\n\nthree\nFOUR\nfive\n"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    r = df.select(merkle.edited_branches(F.col("fa"), F.col("fb")).alias("e"),
                  merkle.edited_branches(F.col("fa"), F.col("fa")).alias("none")).first()
    assert [(x["section"], x["paragraph"]) for x in r["e"]] == [(1, 1), (1, 2)] and r["none"] == []


def brute_targets(sizes, weights=(5, 2, 1)):
    """Reshare by weight, round by round, until none is above its stop."""
    w = [weights[i % 3] for i in range(len(sizes))]
    left, open_, t = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        share = left / sum(w[i] for i in open_)
        over = {i for i in open_ if share * w[i] > 3 * sizes[i]}
        if not over:
            for i in open_:
                t[i] = share * w[i]
            return t
        for i in over:
            t[i] = 3.0 * sizes[i]
            left -= 3 * sizes[i]
        open_ -= over
    return t


@pytest.mark.parametrize("sizes", [[10, 100, 1000, 5, 50], [1], [0, 0], [3, 0, 9], [1, 1000, 1, 1000, 1, 1]])
def test_targets_against_rounds(spark, sizes):
    df = spark.createDataFrame([(f"s{i:02d}", n) for i, n in enumerate(sizes)], "k string, n long")
    got = {r["k"]: r["target"] for r in mixing.source_targets(df, "k", "n").collect()}
    want = brute_targets(sizes)
    assert all(math.isclose(got[f"s{i:02d}"], want[i], abs_tol=1e-9) for i in range(len(sizes)))


def test_mix_of_awkward_rows(messy, no_docs, messy_rows):
    mixed = mixing.systematic_mix(messy)
    got = mixed.collect()
    assert len(got) == len(messy_rows)
    for r in got:
        assert r["size"] == len((r["text"] or "").split(" ") if r["text"] == "12 34 !!" else (r["text"] or "").split())
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        assert r["piece"] == "own piece"
    again = {(r["doc_id"], r["text"], r["taken"]) for r in mixing.systematic_mix(messy.repartition(2)).collect()}
    assert again == {(r["doc_id"], r["text"], r["taken"]) for r in got}
    taken = mixing.take_mix(mixed, ["doc_id", "text"])
    assert taken.columns == ["doc_id", "text"] and taken.count() == sum(r["copies"] for r in got)
    assert mixing.systematic_mix(no_docs).count() == 0


def test_mix_comes_near_its_targets(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)).alias("source"),
        F.repeat(F.lit("w "), (F.pmod(F.xxhash64("id"), F.lit(300)) + 1).cast("int")).alias("text"))
    for r in mixing.systematic_mix(df).groupBy("source").agg(
            F.sum("taken").alias("taken"), F.max("target").alias("target"), F.sum("size").alias("size"),
            F.max("source_size").alias("stated")).collect():
        assert abs(r["taken"] - r["target"]) < 0.02 * r["target"] and r["size"] == r["stated"]
