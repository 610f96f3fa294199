"""Packing and web archives: round trips and awkward input."""
import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seamstat.llm import packing, warc

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def reference_ids():
    import public_tokenizers
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tok.encode_special_tokens = True
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_ids_equal_the_tokenizer_files(reference_ids):
    rng = random.Random(5)
    enc = packing.load_encoding(packing.TOKENIZER)
    texts = ["", " ", "\n\n  a", "it's 12,345 o'clock <|endoftext|>", "é ßñ 漢字 \U0001F600‍", "x" * 3000, "  tab\t\r\n"]
    texts += ["".join(rng.choice("ab Z9'!\n\té漢😀́_") for _ in range(200)) for _ in range(60)]
    for t in texts:
        assert [*enc.encode_ordinary(t), packing.END_ID] == reference_ids(t), repr(t)


def test_ids_of_long_runs_equal_the_tokenizer_files(spark, reference_ids):
    runs = [" " * 3_000_000, "\n" * 1_500_000, "a " + " \n\t\u3000\xa0\x85" * 300_000 + "b", "x\n" + "\n" * 1_200_000 + ".",
            "\t" * 1_100_000 + "7 c" + " " * 1_100_000 + "é  d", "\x1c" * 200_000 + " " * 150_000 + "'s", "y" * 1_500_000]
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    got = {}
    for r in packing.tokenise(df).orderBy("doc_id", "piece").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    for i, t in enumerate(runs):
        assert got[i] == b"".join(k.to_bytes(4, "little") for k in reference_ids(t)), i


def test_added_tokens_have_the_ids_of_the_tokenizer_as_loaded(spark):
    import public_tokenizers
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"  {end}\n\n{end}  x", f"it{end}'s <|endoftext|", f"<|{end}|>", f"{end} " * 2000,
             " " * 120_000 + end + "\n" * 120_000, "none"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in packing.tokenise(df).orderBy("doc_id", "piece").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    for i, t in enumerate(texts):
        want = [*tok.encode(t, add_special_tokens=False).ids, packing.END_ID]
        assert got[i] == b"".join(k.to_bytes(4, "little") for k in want), t[:60]
    assert got[0] == b"".join(k.to_bytes(4, "little") for k in (64, 220, 50256, 275, packing.END_ID))


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return by


def test_pack_round_trip_of_awkward_rows(messy, no_docs, messy_rows, reference_ids):
    pieces = packing.tokenise(messy)
    packed = packing.pack(pieces, items_per_group=6)
    rows = packed.collect()
    by = check_places(rows, packing.CAPACITY)
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    want = sorted(b"".join(i.to_bytes(4, "little") for i in reference_ids(r["text"])) for r in messy_rows)
    docs = {}
    for seq, own in by.items():
        for r in own:
            raw = joined[seq][4 * r["offset"]:4 * (r["offset"] + r["length"])]
            assert raw == bytes(r["ids"])
            docs.setdefault((r["doc_id"], r["start"], r["piece"]), []).append(raw)
    assert sum(len(x) for x in joined.values()) == sum(map(len, want))
    # One document from its pieces: the long one.
    long = sorted((k, v[0]) for k, v in docs.items() if k[0] == 7)
    assert b"".join(v for _, v in long) == b"".join(i.to_bytes(4, "little") for i in reference_ids(
        next(r["text"] for r in messy_rows if r["doc_id"] == 7)))
    assert [len(v) // 4 for _, v in long][1:] == [1024] * (len(long) - 1)
    assert len(by) <= -(-sum(map(len, want)) // 4096) + 1
    empty = packing.pack(packing.tokenise(no_docs))
    assert empty.count() == 0


def test_piece_spans():
    assert packing.piece_spans(1, 4) == [(0, 1)]
    assert packing.piece_spans(4, 4) == [(0, 4)]
    assert packing.piece_spans(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_against_plain_search(seed):
    import numpy as np
    rng = np.random.default_rng(seed)
    lengths, cap = rng.integers(1, 33, size=300), 32
    first, offset, fill = packing.best_fit(lengths, cap)
    bins, got = [], {}
    for i in sorted(range(300), key=lambda i: (-lengths[i], i)):
        fits = [b for b in bins if b[0] + lengths[i] <= cap]
        if fits:
            max(fits, key=lambda b: b[0])[0] += lengths[i]
        else:
            bins.append([lengths[i]])
    for f, x in zip(first, fill, strict=True):
        got[f] = x
    assert sorted(got.values()) == sorted(b[0] for b in bins)


def test_underfull_bins_are_merged_over_rounds(spark):
    df = spark.range(4000).select("id", (F.pmod(F.xxhash64("id"), F.lit(40)) + 1).alias("length"),
                                  F.lit("x").alias("sequence_id"))
    packed = packing.pack(df, capacity=64, items_per_group=50, slack=0)
    rows = packed.collect()
    by = check_places(rows, 64)
    assert len(rows) == 4000 and packed.columns == ["id", "length", "sequence_id", "offset"]
    total = sum(r["length"] for r in rows)
    assert len(by) <= 1.03 * total / 64


@pytest.mark.parametrize("bad", [None, 0, 65])
def test_pack_refuses_lengths_it_cannot_place(spark, bad):
    df = spark.createDataFrame([(1, 5), (2, bad)], "id long, length long")
    with pytest.raises(Exception, match="outside 1 to 64"):
        packing.pack(df, capacity=64).collect()


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("payload_bytes", T.StringType()),
                      T.StructField("refers_to", T.StringType())])
BIG = "<p>ünï 😀</p>\r\n\r\nWARC/1.1\r\n" * 20


def pages(spark):
    rows = [(5, "http://a/", BIG), (3, "http://b/\r\nX: y", BIG), (9, None, BIG), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (6, "u", ""), (7, "u", "line\n" * 50_000), (8, "u", "\n"), (None, "u", BIG), (9, None, BIG),
            (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "x" * 100), (13, "u", "x" * 100)]
    return spark.createDataFrame([(*r, "own", "own") for r in rows], PAGES), rows


def test_archive_round_trip(spark):
    df, rows = pages(spark)
    got = warc.archive_pages(df.repartition(3)).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    for g in got:
        own = [h or "" for i, _, h in rows if i == g["page_id"]]
        raw = own[0].encode()
        assert g["payload_bytes"] == len(raw) and g["payload_digest"] == hashlib.sha256(raw).hexdigest()
        first = min(x for x in groups[own[0]] if x is not None)
        revisit = len(raw) >= 100 and g["page_id"] != first
        assert (g["record_type"], g["refers_to"]) == (("revisit", first) if revisit else ("response", None))
        assert g["payload"] is None if revisit else bytes(g["payload"]) == raw


def test_null_id_is_not_minus_one(spark):
    big = "y" * 200
    df = spark.createDataFrame([(-1, None, big), (None, None, big), (0, None, big)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in
           warc.with_revisits(df.withColumn("r_first", F.lit("own"))).collect()}
    assert got == {-1: ("response", None), None: ("revisit", -1), 0: ("revisit", -1)}


def test_archive_of_no_pages(spark):
    df, _ = pages(spark)
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_normalised_members_stand_alone(spark, tmp_path):
    df, rows = pages(spark)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_monolithic(df.coalesce(1), raw)
    files = warc.normalise(spark, raw, out).collect()
    assert sum(f["records"] for f in files) == len(rows)
    for f in files:
        data = open(f["archive"], "rb").read()
        seen = b""
        for line in open(f["index"]):
            at, n, rid = line.split()
            member = gzip.decompress(data[int(at):int(at) + int(n)])
            assert member.startswith(b"WARC/1.1\r\n") and rid.encode() in member
            seen += member
        source = [p for p in (tmp_path / "raw").glob("*.gz")]
        assert seen in [gzip.decompress(p.read_bytes()) for p in source]


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_streams_are_cut_anywhere(size):
    record = b"WARC/1.1\r\nContent-Length: 6\r\n\r\nab\r\n\r\n\r\n\r\n"
    text = record * 3
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = z.compress(text) + z.flush()

    class Slow:
        def __init__(self, data):
            self.data = data

        def read(self, _):
            out, self.data = self.data[:size], self.data[size:]
            return out
    assert list(warc.split_records(warc.inflated(Slow(packed)))) == [record] * 3
    assert list(warc.split_records(warc.inflated(Slow(packed + gzip.compress(record))))) == [record] * 4
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflated(Slow(packed[:-12]))))
    with pytest.raises(ValueError):
        list(warc.split_records([text[:-1]]))
