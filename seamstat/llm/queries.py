"""Driver queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    collocations,
    langid,
    merge_pieces,
    merkle,
    mixing,
    neardup,
    packing,
    quality,
    sharding,
    topk,
    toxicity,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_neardup": neardup.op2_neardup,
    "op3_topk": topk.op3_topk,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_langid": langid.op5_langid,
    "op6_sharding": sharding.op6_sharding,
    "op7_quality": quality.op7_quality,
    "op8_fingerprints": merkle.op8_fingerprints,
    "op9_warc": warc.op9_warc,
    "op10_mixing": mixing.op10_mixing,
    "op11_sentencepiece": merge_pieces.op11_sentencepiece,
    "op12_collocations": collocations.op12_collocations,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE: dict[str, str] = {
    "op2_neardup": neardup.ORACLE,
    "op3_topk": topk.ORACLE,
    "op6_sharding": sharding.ORACLE,
    "op8_fingerprints": merkle.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op12_collocations": collocations.ORACLE,
}
