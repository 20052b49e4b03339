import re
import string

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

LONG = " ".join(f"w{i % 7}x{i}" for i in range(30_000))
#: null id, null and empty texts, repeated rows and ids, ties, odd blanks, a long text, one very long word
EDGE = [
    (1, "The cat sat on the mat. The dog sat on the log."), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "), (5, "one"),
    (6, "two words"), (None, "a row without an id."), (None, None), (7, "Ünïcödé wörds — 漢字かな, ﬁne.\x85　x"),
    (8, LONG), (9, "z" * 20_000), (10, "The cat sat on the mat. The dog sat on the log."),
    (1, "The cat sat on the mat. The dog sat on the log."), (11, "tie tie tie tie"), (12, "a|b <|endoftext|> it's  x\n\n y"),
]


def words(text):
    return WORD.findall((text or "").translate(_LOWER))


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from driftlog.llm.ship import shipped

    shipped(spark)


@pytest.fixture(scope="session")
def edge(spark):
    """EDGE as a table in two partitions, with columns whose names the operators use themselves."""
    rows = spark.createDataFrame(EDGE, "doc_id bigint, text string")
    return rows.withColumns({c: F.lit("clash") for c in
                             ("score", "n", "key", "node", "row", "size", "id", "w", "shard", "digest", "label", "lang")}) \
        .repartition(2)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
