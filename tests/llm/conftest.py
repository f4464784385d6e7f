import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

#: Columns of ``documents`` and names that the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("key", "id", "row", "words", "w", "label", "shard", "n_words", "score")],
])


@pytest.fixture(scope="session", autouse=True)
def _importable(spark):
    from cadence.llm.common import importable
    importable(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text) rows with all other columns null, one of them clashing."""
    def make(rows):
        return spark.createDataFrame([(d, t, None, "src0", None, "x", "y", *[None] * 7) for d, t in rows], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    prose = " ".join(f"word{i % 97}x{i}" for i in range(400))
    passage = " ".join(f"shared{i}" for i in range(60))
    return [
        (1, prose), (2, prose), (2, prose), (3, prose + " end"), (4, None), (5, ""), (6, " \n\t "), (None, "no id here"),
        (None, prose), (7, "short"), (7, "short text"), (8, "a b c d"), (9, "a b\nc d"),
        (10, "one two three " + passage + " four five"), (11, passage + " other words follow"),
        (12, "la " * 3000), (13, "line of a few words\n" * 40), (14, "x" * 20000), (15, "é   　z\r\n12 345 don't"),
        (16, "<|endoftext|> in a text"),
    ]
