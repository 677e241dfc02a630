import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Nulls, empty and blank texts, ties, repeated rows and ids, one very long text, characters beyond ASCII.
ODD = [
    (1, "The MIT License applies here. Same words again.", "en", "a", 47),
    (2, "The MIT License applies  here.\tSame words again.", "en", "a", 48),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, "   \n\t ", "en", None, 6),
    (6, "word", "en", "a", 4),
    (7, "WORD", "en", "a", 4),
    (8, "É ßtraße 中文 <|endoftext|> don't I'VE é", "de", "b", 40),
    (8, "É ßtraße 中文 <|endoftext|> don't I'VE é", "de", "b", 40),
    (None, "a text without an id", "en", "a", 20),
    (9, "x" * 3000, "en", "a", 3000),
    (10, "apache, LICENSE general public\nlicense " * 400, "en", "a", 15600),
    (11, " ".join(f"w{i % 700}" for i in range(20000)), "en", "a", 100000),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def clashing(odd):
    """Extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = ["keep_id", "group_size", "kept", "component_id", "n_shingles", "n_tokens", "score", "labels", "sequence_id", "piece", "row", "label", "order", "_len", "media", "payload"]
    return odd.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sample(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
