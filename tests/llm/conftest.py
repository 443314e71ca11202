"""Frames of the odd documents."""

import pytest
from cases import CLASHES, ODD
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def documents_of(spark):
    def make(rows=ODD, clashes=True):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        if clashes:
            frame = frame.withColumns({name: F.lit(f"clash {name}") for name in CLASHES})
        return frame

    return make


@pytest.fixture(scope="session")
def odd(documents_of):
    return documents_of()


@pytest.fixture(scope="session")
def none(documents_of):
    return documents_of([])
