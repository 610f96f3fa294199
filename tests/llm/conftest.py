import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that operators use for their own columns.
CLASHES = ("size copies target taken source_size piece start length ids ids_crc32 sequence_id offset score "
           "predicted lang_pred slot shard fingerprint component_id kept label doc cell key tie rank "
           "mix_size mix_rank pack_uid payload has_letter l_label value").split()

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n)) + "."


LONG = "\n".join(prose(k, 400) for k in range(60))      # about 140,000 characters


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with every awkward case, and clashing extra columns."""
    base = prose(1, 120)
    rows = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (2, base + " omega", "en", None, 1),
        (3, None, None, "b", None), (4, "", "fr", "b", 0), (5, " \t\n ", "fr", "b", 3), (6, "12 34 !!", None, "b", 8),
        (7, LONG, "en", "c", len(LONG)), (None, prose(2, 40), "en", "c", 5), (8, "x", None, None, 1),
        (9, "a" * 50_000, "en", "c", 50_000), (9, prose(3, 30), "en", "d", 1), (10, prose(4, 30), "fr", "d", 1),
        (10, prose(4, 30), "fr", "d", 1), (11, "tail퟿ \U0001F600 smile\n\n\nend", "en", "", 1),
    ]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES]).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def messy_rows(messy):
    return [r.asDict() for r in messy.collect()]


@pytest.fixture(scope="session")
def duck():
    """DuckDB over the tables of a scale."""
    duckdb = pytest.importorskip("duckdb")

    def at(sf):
        con = duckdb.connect()
        for t in "documents embeddings pages labels".split():
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
        return con
    return at


SF = "/root/testdata/sf0.001"
