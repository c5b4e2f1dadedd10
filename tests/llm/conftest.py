import pytest
from pyspark.sql import types as T

from quarterbill.llm.common import ship

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("size", T.StringType()),
        T.StructField("fp", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % 12] + str((i * 13 + seed) % 97) for i in range(n))


def rows() -> list[tuple]:
    texts = {
        1: prose(1, 120), 2: prose(1, 120), 3: prose(1, 119) + " other", 4: None, 5: "", 6: " \t\n",
        7: "one", 8: prose(2, 80) + "\n" + prose(1, 40), 9: prose(3, 9000), 10: "spam spam spam " * 60,
        11: "Café 你好 \U0001f600 naïve ß " + prose(4, 60), 12: "*** ### " * 40,
    }
    out = [(i, t, "en" if i % 2 else None, ["a", "b", "é", None][i % 4], len(t) if t else 0, "x", i, "k") for i, t in texts.items()]
    return [*out, out[0], (None, prose(5, 60), "en", "a", 1, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(shipped):
    return shipped.createDataFrame(rows(), DOCS).coalesce(2)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
