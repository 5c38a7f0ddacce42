import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Literal documents with columns whose names clash with the operators' own."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, row_id long, kept string, fp string, body string, size string, key string"
        full = [(i, t, "en", *(rest or ["s"]), None, 7, "x", None, "b", "z", "k") for i, t, *rest in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make
