from __future__ import annotations

import importlib
import uuid

import pytest
from odd_rows import ODD_ROWS


@pytest.fixture(scope="session")
def write(spark, tmp_path_factory):
    """Rows written as a Parquet table (operators read their input more than once) and read back."""
    def make(rows, schema, partitions=3):
        path = str(tmp_path_factory.mktemp("table") / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).repartition(partitions).write.parquet(path)
        return spark.read.parquet(path)
    return make


@pytest.fixture(scope="session")
def odd(write):
    """The odd rows with further columns whose names the operators use themselves."""
    clash = ["row", "cls", "key", "bucket", "rejected", "leaks", "ids", "severity", "text_hash", "__text"]
    return write([(*r, *["x"] * len(clash)) for r in ODD_ROWS], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def tokenizer_path():
    return importlib.import_module("public_tokenizers").path("byte_bpe_50k.json")
