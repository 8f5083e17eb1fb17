import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
# Names that operators use inside, as columns of the input: they must not meet.
CLASHING = ("h", "bin", "slot", "shard", "size", "rate", "copies", "g", "d", "first", "n", "votes",
            "kept", "class_id", "bucket", "node", "leader", "ids", "_block", "_k", "digest", "score",
            "licence", "dir", "target", "source_size", "id", "url", "payload")
PROSE = ("the river of the north was wide and the people in it had not been seen by any of the "
         "others for a long time because the winter that came with the wind was on its way to them "
         "and it is said that no one who went there ever came back from the hills of the east")


def tricky():
    """Nulls in every column, empty, short and very long texts, ties and repeated rows."""
    words = PROSE.split()
    near = PROSE.replace("winter", "summer")
    return [
        (1, PROSE, "en", "a", len(PROSE)), (2, PROSE, "en", "a", len(PROSE)),
        (2, PROSE, "en", "a", len(PROSE)), (3, near + " and more of it", "en", "b", 1),
        (4, None, "en", "b", None), (5, "", "de", "b", 0), (6, "  \n\t ", None, None, 4),
        (None, PROSE + " end", "fr", "c", 9), (None, None, None, None, None),
        (7, "one two", "en", "c", 7), (8, "été 日本 \U0001f600 x" * 3, "fr", "c", 3),
        (9, " ".join(words[i * 7 % len(words)] + str(i) for i in range(30000)), "en", "d", 5),
        (10, "a" * 20000, "en", "d", 5), (11, "x y " * 5000, "en", None, 5),
        (12, PROSE[40:200] + "\n" + "\n".join(["again and again"] * 9), "en", "a", 5),
        (12, "another text under a known id, of a few words only", "en", "a", 5),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(tricky(), DOCS)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' as {name}")
    return df.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
