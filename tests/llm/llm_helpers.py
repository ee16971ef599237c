import random

import pytest


@pytest.fixture
def rng():
    return random.Random(17)


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) rows, with columns that clash by name."""
    def make(rows, **more):
        schema = "doc_id long, text string, n long, key string, lang string, n_chars long"
        full = [(i, t, 1, "k", more.get("lang"), None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(3)
    return make


#: Nulls, empty and blank texts, one long text, ties and repeated rows.
EDGE_ROWS = [(None, "a text without an id, not too short to be a line"), (1, None), (2, ""),
             (3, " \n\t "), (4, "one"), (5, "same words in two rows of one id " * 3),
             (5, "same words in two rows of one id " * 3), (6, "été à Paris \U0001F600"),
             (7, "long " * 40_000), (8, "x")]


@pytest.fixture
def edge_rows():
    return list(EDGE_ROWS)
