"""A document pipeline of the text operators: each stage reads what the one before kept.

1. Language ID: documents without a letter, or whose language the network cannot tell, go.
2. N-gram Jaccard join: of each group of linked documents the one with the smallest doc_id
   stays; on repeated rows of that id, the first text.
3. Suffix-array dedup: passages of 50 words or more that stand earlier are removed.
4. Benchmark decontamination: passages of benchmark items are removed.
5. SentencePiece: each text is encoded; the result has its ids and the text decoded from them.

Stages 1 to 4 return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import scratch, ship, table
from clickmill.llm.op3_decontamination import decontaminate
from clickmill.llm.op7_sentencepiece import encode_and_decode
from clickmill.llm.op8_suffix_array import suffix_array_text
from clickmill.llm.op9_language_id import keep_languages
from clickmill.llm.op10_jaccard_join import one_of_each

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_languages(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_array_text(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_pieces and the text decoded from the ids."""
    ship(spark)
    rows = encode_and_decode(docs.select("doc_id", "lang", "source", "text"))
    return rows.select("doc_id", "lang", "source", F.col("decoded").alias("text"), "ids",
                       F.size("ids").cast("long").alias("n_pieces"))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", pieces),
]

#: A trained network and a tokenizer have no SQL form; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
