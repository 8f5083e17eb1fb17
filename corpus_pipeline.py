"""From raw documents to token ids: five stages, each one operator of ``tidegauge.llm``.

Each stage reads what the one before wrote. All but the last return the columns of
``documents``; the last returns the ids of each document. Null texts are dropped by the first
stage. An empty table passes through as one.
"""

from pyspark.sql import functions as F

from tidegauge.llm import mixing, neardup, pieces, quality, spandedup
from tidegauge.llm.common import keep

# Expectation-maximisation, banding and shortest paths are not SQL: see tests/llm.
ORACLE_SQL = None


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the rules' posterior reject go."""
    return quality.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each class of near-duplicates the document of the smallest id stays."""
    return neardup.keep_one(docs)


def suffix_dedup(spark, docs, sf_dir):
    """Bytes of passages that an earlier document has go, and documents left empty."""
    cut = spandedup.cut_documents(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Documents come as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark, docs, sf_dir):
    """Token ids of each document; one row for each copy."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
