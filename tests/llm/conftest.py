import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = "lorem ipsum " * 20_000
ROWS = [
    (5, "One two three four five six seven eight.\nRight here.\n", "en", "a"),
    (5, "One two three four five six seven eight.\nRight here.\n", "en", "a"),  # a repeated row
    (2, "one two THREE four five six seven eight.\nright here.", "en", "b"),
    (3, None, None, None),
    (4, "", "de", "a"),
    (None, "No key at all in this row", "de", "b"),
    (7, " \t\n ", "en", None),
    (8, LONG, "en", "a"),
    (9, "Émile s'élève; été, œuvre 12345 $$ <|endoftext|>  \n\n x", "fr", "b"),
    (10, "short", None, "a"),
    (11, "12345 !!! 67890", "fr", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
