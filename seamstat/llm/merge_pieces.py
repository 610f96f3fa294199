"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as its model states and cut into characters. All adjacent
pairs whose join is a piece wait in an agenda ordered by score, then by place;
the best pair is joined, which puts the pairs with its neighbours on the
agenda, until none is left. Characters that are no piece become their bytes
(or the unknown id). Where no piece of the vocabulary has a space mark after
another character, no pair ever reaches across the start of a word, nor into
a character that is in no longer piece, so words are encoded one by one and
remembered.

Every batch's ids and decoded texts are compared with the sentencepiece
library's own (``agrees``).
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import for_workers, read_table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"        # FIXED VALUE: the mark that stands for a space in pieces
UNKNOWN_SURFACE = " ⁇ "    # FIXED VALUE: what an unknown id decodes to
REMEMBERED = 600_000    # words a worker remembers, at most
SHORT = 48              # characters of a word that is remembered; longer texts have a heap
NEVER = 1 << 30         # rank of a pair whose join is no piece
PAD = 0xFFFF            # no symbol
ROWS = 256

# FIXED VALUES: numbers of the model file's fields and of its piece types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
BPE = 2


def fields(raw: bytes):
    """(number, value) of the fields of a protocol buffer message; lengths of
    bytes are read, 32-bit values stay bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, raw[at:at + size]
        at += size


class MergeVocabulary:
    """Pieces, scores and the encoder of one model file."""

    def __init__(self, path: str):
        import struct

        import numpy as np
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = list(fields(f.read()))
        pieces = [dict(fields(v)) for k, v in model if k == 1]
        trainer = dict(fields(next((v for k, v in model if k == 2), b"")))
        normalizer = dict(fields(next((v for k, v in model if k == 3), b"")))
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != BPE or {USER_DEFINED, UNUSED} & set(kinds) or len(pieces) > PAD:
            raise ValueError(f"{path}: not a plain merge-type vocabulary")
        self.prefix = bool(normalizer.get(3, 1))
        self.strips = bool(normalizer.get(4, 1))
        self.pieces = [p[1].decode() for p in pieces]
        self.kinds = kinds
        self.score = {p[1].decode(): struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0]
                      for p, k in zip(pieces, kinds, strict=True) if k == NORMAL}
        self.id_of = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == BYTE}
        self.byte_of = np.zeros(len(pieces), np.uint8)
        self.byte_of[list(self.byte_id.values())] = list(self.byte_id)
        self.falls_back = bool(trainer.get(35, 0))
        self.unknown = kinds.index(UNKNOWN)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.first, self.last = (struct.pack("<I", i) for i in (self.begin, self.end))
        self.shown = np.array([p.replace(SPACE, " ") for p in self.pieces], dtype=object)
        self.kind_of = np.array(kinds, np.uint8)
        # Every pair of pieces whose join is a piece, by key; equal scores have equal
        # ranks. The last row stands for all other pairs.
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = sorted((a << 16 | b, order[self.score[p]], i) for p, i in self.id_of.items() for k in range(1, len(p))
                       if (a := self.id_of.get(p[:k])) is not None and (b := self.id_of.get(p[k:])) is not None)
        self.pair_key, self.pair_rank, self.pair_join = (
            np.array([row[c] for row in pairs] + [end], kind)
            for c, end, kind in ((0, 0xFFFFFFFF, np.uint32), (1, NEVER, np.int32), (2, 0, np.uint16)))
        self.first_id = np.full(0x110000, self.unknown, np.uint16)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.first_id[ord(p)] = i
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        joined = {c for p in self.score if len(p) > 1 for c in p}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        self.words = None if any(inner.search(p) for p in self.score) else \
            re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known: dict[str, bytes] = {}

    def pairs_of(self, a, b):
        """Place in the table of pairs of each pair of symbols, or its end."""
        import numpy as np

        key = a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32)
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, at, len(self.pair_key) - 1)

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of many short texts. Each has its agenda, a row with the rank
        of every adjacent pair, of which the first of the best is next; the
        agendas of all texts move on together, a join each at a time."""
        import numpy as np

        out: list[bytes] = [b""] * len(words)
        odd: list[int] = []
        size = np.array([len(w) for w in words])
        for block in np.array_split(np.argsort(size, kind="stable"), max(1, -(-len(words) // 4096))) if words else ():
            own, n = [words[k] for k in block], size[block]
            points = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
            inside = np.arange(n.max()) < n[:, None]
            ids = np.full(inside.shape, PAD, np.uint16)
            ids[inside] = self.first_id[points]
            who, pair = block, self.pairs_of(ids[:, :-1], ids[:, 1:])
            while True:
                rank = self.pair_rank[pair]
                i = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(who), np.int64)
                go = rank[np.arange(len(who)), i] < NEVER if rank.shape[1] else np.zeros(len(who), bool)
                done = ids[~go]
                real = done != PAD
                raw, ends = done[real].astype("<u4").tobytes(), (4 * real.sum(axis=1).cumsum()).tolist()
                start = 0
                for k, end in zip(who[~go].tolist(), ends, strict=True):
                    out[k] = raw[start:end]
                    start = end
                odd += who[~go][(done == self.unknown).any(axis=1)].tolist()
                if not go.any():
                    break
                who, ids, pair, i = who[go], ids[go], pair[go], i[go]
                row, at = np.arange(len(who)), np.arange(ids.shape[1] - 1)
                join = self.pair_join[pair[row, i]]
                ids = np.take_along_axis(ids, at + (at > i[:, None]), axis=1)
                ids[row, i] = join
                at = at[:-1]
                pair = np.take_along_axis(pair, at + (at >= i[:, None]), axis=1)
                some = np.flatnonzero(i > 0)
                pair[some, i[some] - 1] = self.pairs_of(ids[some, i[some] - 1], join[some])
                some = np.flatnonzero(i < pair.shape[1])
                pair[some, i[some]] = self.pairs_of(join[some], ids[some, i[some] + 1])
        # A character that is no piece: its bytes take its place.
        for k in odd:
            out[k] = self.raw_ids(words[k])
        return out

    def merged(self, text: str) -> list[str]:
        """Symbols of a normalised text after all joins."""
        from heapq import heapify, heappop, heappush


        score, symbol = self.score, list(text)
        n = len(symbol)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            s = score.get(symbol[i] + symbol[i + 1])
            if s is not None:
                agenda.append((-s, i, symbol[i] + symbol[i + 1], i + 1))
        heapify(agenda)
        while agenda:
            _, i, piece, j = heappop(agenda)
            # Out of date if either side was joined since; a taken side is empty.
            if not symbol[i] or not symbol[j] or after[i] != j or len(symbol[i]) + len(symbol[j]) != len(piece):
                continue
            symbol[i], symbol[j] = piece, ""
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
                s = score.get(piece + symbol[k])
                if s is not None:
                    heappush(agenda, (-s, i, piece + symbol[k], k))
            h = before[i]
            if h >= 0:
                s = score.get(symbol[h] + piece)
                if s is not None:
                    heappush(agenda, (-s, h, symbol[h] + piece, i))
        return [s for s in symbol if s]

    def raw_ids(self, part: str) -> bytes:
        """Ids of a part of a normalised text."""
        from struct import pack

        ids = []
        for s in self.merged(part):
            i = self.id_of.get(s)
            if i is not None:
                ids.append(i)
            elif self.falls_back:
                ids += [self.byte_id[b] for b in s.encode()]
            else:
                ids.append(self.unknown)
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, with the begin and end ids, as little-endian unsigned
        32-bit integers. Words not met before are encoded together."""
        parts = [[n] if self.words is None else self.words.findall(n) for n in map(self.library.normalize, texts)]
        known = self.known
        found = [list(map(known.get, words)) for words in parts]
        new = dict.fromkeys(w for words, own in zip(parts, found, strict=True) if None in own
                            for w, x in zip(words, own, strict=True) if x is None)
        if new:
            short = [w for w in new if len(w) <= SHORT]
            new.update(zip(short, self.merge_words(short), strict=True))
            for w, raw in new.items():
                if raw is None:
                    new[w] = self.raw_ids(w)
            for words, own in zip(parts, found, strict=True):
                if None in own:
                    own[:] = [new[w] if x is None else x for w, x in zip(words, own, strict=True)]
            if len(known) + len(short) > REMEMBERED:
                known.clear()
            known.update((w, new[w]) for w in short)
        out = [b"".join([self.first, *own, self.last]) for own in found]
        return out if self.falls_back else [self.one_unknown(raw) for raw in out]

    def one_unknown(self, raw: bytes) -> bytes:
        """A run of unknown characters is one id."""
        import numpy as np

        ids = np.frombuffer(raw, "<u4")
        again = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
        return ids[~again].tobytes()

    def decode(self, raw: bytes) -> str:
        """Text of ids: byte ids in a row are UTF-8 (a byte that is not part
        of a character is U+FFFD), control ids are nothing, and the space
        that normalising puts in front is taken off."""
        import numpy as np

        ids = np.frombuffer(raw, "<u4")
        kinds = self.kind_of[ids]
        text, started = [], False
        # Runs of ids of one kind; controls are runs too, as they end a run of bytes.
        cuts = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1], [True]])) if len(ids) else [0]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            kind, own = kinds[s], ids[s:e]
            if kind == CONTROL:
                continue
            if kind == BYTE:
                text.append(bytes_text(bytes(self.byte_of[own])))
                started = True
                continue
            shown = self.shown[own].tolist() if kind == NORMAL else [UNKNOWN_SURFACE] * len(own)
            for k, x in enumerate(shown):
                if started:
                    break
                if kind == NORMAL and (self.prefix or self.strips) and x[:1] == " ":
                    x = shown[k] = x[1:]
                    started = not self.strips
                started = started or bool(x)
            text += shown
        return "".join(text)


def bytes_text(run: bytes) -> str:
    """UTF-8 text of bytes; each byte outside a whole character is U+FFFD."""
    run = bytes(run)
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at:at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


@lru_cache(maxsize=2)
def load(model: str) -> MergeVocabulary:
    """Vocabulary of a model file: a path, or the name of a public one."""
    if "/" not in model:
        import public_tokenizers
        model = public_tokenizers.path(model)
    return MergeVocabulary(model)


FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
          T.StructField("decoded", T.StringType()), T.StructField("agrees", T.BooleanType())]


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """The id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), the
    ``decoded`` text and ``agrees``: whether the library gives the same ids
    and the same decoded text. One row per row.

    Whole texts are encoded, in time near linear in their length, whatever
    runs or words they hold. A null or empty text is the begin and end ids,
    and decodes to an empty text. Ids may repeat or be null; other input
    columns are not read. An empty table gives an empty result.
    """
    for_workers(docs.sparkSession)
    keyed = docs.select(F.col(f"`{id}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", keyed.schema["key"].dataType), *FIELDS])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        v = load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n, raw, back, same = [], [], [], []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for t, own in zip(texts, v.encode(texts), strict=True):
                    raw.append(own)
                    back.append(v.decode(own))
                    ids = np.frombuffer(own, "<u4").tolist()
                    n.append(len(ids))
                    same.append(v.library.encode(t, add_bos=True, add_eos=True) == ids and v.library.decode(ids) == back[-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(raw, pa.binary()), pa.array(back, pa.string()),
                     pa.array(same, pa.bool_())], ["key", "n_tokens", "ids", "decoded", "agrees"])

    return keyed.mapInArrow(run, schema).withColumnRenamed("key", id)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")
