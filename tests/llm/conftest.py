import pytest
from pyspark.sql import functions as F

from emporia.llm.common import prepare

LONG = "lorem ipsum dolor sit amet " * 12_000


@pytest.fixture(scope="session")
def spark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, blank, wordless, very long, repeated texts; columns with the names of results."""
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "!!! ... ???"), (5, "A"), (6, LONG),
            (7, "The quick brown fox jumps over the lazy dog."), (7, "The quick brown fox jumps over the lazy dog."),
            (8, "The quick brown fox jumps over the lazy dog."), (None, "The quick brown fox jumps over the lazy dog."),
            (9, "naïve café 你好 \u0000 😀 \n\n x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    clash = ["score", "predicted", "fingerprint", "root", "component_id", "items", "severity", "toxic", "lang_pred",
             "n_tokens", "ids_sha256", "n_entities", "license", "dice", "value", "kind", "h", "target", "used"]
    return df.withColumns({c: F.lit(f"old {c}") for c in clash})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
