import random

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("spans", T.StringType()), T.StructField("region", T.LongType()),
])


def edge_documents():
    """Missing and empty texts, very long ones, copies, near copies, repeated rows and ids, odd white space."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(60)
    base = words(150)
    texts = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join([*base[:140], "changed", *base[141:]])),
             (4, None), (5, ""), (6, "   \n\t "), (7, "one"), (8, "One"), (9, "one two three"), (10, "one two  THREE"),
             (11, " ".join([*words(40), *passage, *words(30)])), (12, " ".join([*words(5), *passage, *words(80)])),
             (13, "\n".join([" ".join(passage), " ".join(passage)])), (14, "ab" * 300), (15, "ab" * 250),
             (16, " ".join(words(30_000))), (17, "x" * 300_000), (18, "Äpfel und Ölß 日本語 ▁   ☃"), (19, "12 34 !!"),
             (20, " ".join(["same"] * 400)), (20, " ".join(["same"] * 400)), (21, " ".join(words(60))), (21, " ".join(words(60))),
             (None, " ".join(passage)), (None, None)]
    return [(i, t, "en", "s", len(t or ""), "clash", 7) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_documents(), DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session", autouse=True)
def workers_have_the_package(spark):
    from clickmill.llm.common import ship

    ship(spark)
