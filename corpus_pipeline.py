"""Corpus pipeline: language, toxicity, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
every stage's rows as Parquet in the shared folder and reads them again as the
next stage's documents, so a stage works on all that its predecessor kept and
a lost executor never reaches back beyond the last stage. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamstat.llm import langid, mixing, neardup, packing, toxicity
from seamstat.llm.common import WORD_PATTERN, free_name, landed, read_table

OVER_CHANCE = 0.25      # of the way from chance to certainty that the best language has to go
NEAR_PERCENT = 80       # similarity of near duplicates

# Trained classifiers decide in the first stages, which SQL cannot express.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language. Texts without a letter (null and
    empty ones too) go, and those in which no language stands out: the mean
    probability of the best one has to pass chance (1 / number of languages)
    by ``OVER_CHANCE`` of the rest. Repeated rows are judged alike."""
    net = langid.fit(docs)
    out = langid.identify(docs, net)
    chance = 1 / max(1, len(net.labels)) if net is not None else 1.0
    least = chance + OVER_CHANCE * (1 - chance)
    keep = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= round(least, 5))
    return out.where(keep).select(*[F.col(f"`{c}`") for c in docs.columns])


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not mark. Null and empty
    texts have the labels' odds as their score, and stay."""
    weights, bias = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, weights, bias).where("predicted = 0").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = NEAR_PERCENT) -> DataFrame:
    """The first row of each near-duplicate group (shingle sets at least
    ``percent`` alike), whatever the ids of its rows. Documents without words are in no group, and stay."""
    first = (neardup.grouped(docs, percent=percent).where("component IS NOT NULL").groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "text_key")).alias("first"))
             .select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key")))
    key = free_name(docs.columns, "text_key")
    words = F.coalesce(F.col("text").rlike(WORD_PATTERN), F.lit(False))
    own = docs.where(words).withColumn(key, neardup.text_key(F.col("text"))).alias("own")
    kept = own.join(first.alias("first"), F.col("own.doc_id").eqNullSafe(F.col("first.kept_id"))
                    & (F.col(f"own.{key}") == F.col("first.kept_key")), "left_semi").dropDuplicates(["doc_id", key])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns).unionByName(docs.where(~words).select(*columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document taken more than once has repeated rows;
    a document without words is taken or left like its source's others."""
    return mixing.take_mix(mixing.systematic_mix(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each taken document lies in the token sequences;
    repeated rows are packed repeatedly, an empty text is one end token."""
    return packing.pack(packing.digest_pieces(docs)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language),
    ("toxicity", non_toxic),
    ("near_dedup", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
