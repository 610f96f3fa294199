import random
import struct

import pytest

from seamstat.llm import merge_pieces as M


@pytest.fixture(scope="module")
def vocabulary():
    return M.load(M.MODEL)


def library_ids(v, t):
    return v.library.encode(t, add_bos=True, add_eos=True)


def raw(ids):
    ids = list(ids)
    return struct.pack(f"<{len(ids)}I", *ids)


def own_ids(v, t):
    return [i for i, in struct.iter_unpack("<I", v.encode([t])[0])]


@pytest.mark.parametrize("text", [
    "", " ", "  a  b ", "▁x", "a▁b", "<s> hi</s>", "<0x41>", "a\x00b", "ﬁ Ａ é", "\t\n x", "\U0001F600", "a\r\nb\n\n",
    "퟿￿", "梦梦", "é‍", "1234567890.5,6"])
def test_ids_and_text_equal_the_librarys(vocabulary, text):
    ids = own_ids(vocabulary, text)
    assert ids == library_ids(vocabulary, text)
    assert vocabulary.decode(raw(ids)) == vocabulary.library.decode(ids)


def test_random_texts_and_ids(vocabulary):
    r = random.Random(3)
    letters = "ab \t\n▁é\U0001F600ﬁ的한\x00\x85<>s/0x41  tion"
    some = [0, 1, 2, 3, 100, 198, 230, 240, 131, 159, 259, 260, 264, 300, 28705, 31999]
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert own_ids(vocabulary, text) == library_ids(vocabulary, text)
        ids = [r.choice(some) for _ in range(r.randint(0, 9))]
        assert vocabulary.decode(raw(ids)) == vocabulary.library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 60_000, "ab" * 40_000, "é\n" * 20_000, "the cat sat " * 8_000])
def test_long_runs(vocabulary, text):
    ids = own_ids(vocabulary, text)
    assert ids == library_ids(vocabulary, text)
    assert vocabulary.decode(raw(ids)) == vocabulary.library.decode(ids)


def plain_merge(score, text):
    """The best pair of all adjacent ones again and again, the first on ties."""
    symbols = list(text)
    while True:
        pairs = [(-score[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in score]
        if not pairs:
            return symbols
        _, i = min(pairs)
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]


def test_agendas_merge_as_the_plain_rule_does(vocabulary):
    r = random.Random(5)
    for n in (1, 2, 5, 30, M.SHORT, M.SHORT + 1, 200):
        for _ in range(20):
            text = "".join(r.choice("▁▁theraions") for _ in range(n))
            want = plain_merge(vocabulary.score, text)
            assert vocabulary.merged(text) == want
            assert vocabulary.merge_words([text, "", text]) == [raw(vocabulary.id_of[s] for s in want), b"", raw(vocabulary.id_of[s] for s in want)]


def test_bytes_that_are_no_text():
    assert M.bytes_text(b"\xc3\xa9\xc3") == "é�"
    assert M.bytes_text(b"\xf0\x9f\x98\x80\x80a") == "\U0001F600�a"


def test_messy_documents(messy, messy_rows, vocabulary, spark):
    got = M.encode(messy).collect()
    assert len(got) == len(messy_rows) and all(r["agrees"] for r in got)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(library_ids(vocabulary, r["text"] or ""))) for r in messy_rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == want
    none = next(r for r in got if r["doc_id"] == 3)
    assert (none["n_tokens"], bytes(none["ids"]), none["decoded"]) == (2, b"\1\0\0\0\2\0\0\0", "")


def test_empty_table(no_docs):
    assert M.encode(no_docs).columns == ["doc_id", "n_tokens", "ids", "decoded", "agrees"]
    assert M.encode(no_docs).count() == 0


def test_query_digests(spark, vocabulary):
    import hashlib

    from .conftest import SF
    got = {r["doc_id"]: r for r in M.op11_sentencepiece(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library_ids(vocabulary, d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(vocabulary.library.decode(ids).encode()).hexdigest()


def test_other_kinds_of_model_are_refused(tmp_path):
    import io

    import sentencepiece
    out = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(["some words to learn from " * 5] * 20), model_writer=out, vocab_size=30,
        model_type="unigram", hard_vocab_limit=False, minloglevel=2)
    path = tmp_path / "u.model"
    path.write_bytes(out.getvalue())
    with pytest.raises(ValueError, match="merge-type"):
        M.MergeVocabulary(str(path))
