import random

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents with every column the table has, and clashing extra ones."""
    schema = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "id bigint, node bigint, size bigint, component_id string, start bigint, kept boolean"
    )

    def make(*rows):
        full = [(i, t, "en", "s", None, 7, 7, 7, "c", 7, None) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def given(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture
def words():
    """Random texts over a small vocabulary."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(300)]
    return lambda n: draw.choices(vocabulary, k=n)
