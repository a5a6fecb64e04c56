import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def read(spark):
    """A table of the small test data, as rows."""
    from tests.conftest import SF_SMALL
    return lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()


@pytest.fixture
def frame(spark):
    def build(rows, ddl="doc_id long, text string"):
        return spark.createDataFrame(rows, ddl).repartition(3)
    return build


@pytest.fixture
def odd_docs():
    """Null, empty, blank and very long texts, null ids, repeated rows, ties."""
    rng = random.Random(5)
    word = lambda: rng.choice("alpha beta gamma delta of the and License MIT é 日本 x1".split())
    long = " ".join(word() for _ in range(30_000))
    rows = [(1, None), (2, ""), (3, "   \n\t"), (4, long), (4, long), (5, "one"), (6, "one"), (None, "no id here at all"),
            (None, "no id here at all"), (None, None), (7, "Under the MIT License and the mit  license."), (8, "a\x00b �")]
    return rows + [(10 + i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(40)]
